"""Recipe rules as a decision table: a pure function of metrics, recipe and history, in which the first match wins.

A rule is a row of conditions and changes. Only numbers about the last runs are involved, so this is plain Python on
the driver; ``threadloom.plans.gates`` measures the metrics.
"""

from __future__ import annotations

import operator
from dataclasses import dataclass, field, replace

OPS = {">": operator.gt, "<": operator.lt, ">=": operator.ge, "<=": operator.le, "==": operator.eq}


@dataclass(frozen=True)
class Test:
    """``where`` is metric, recipe or data; ``default`` stands for a value that is not there (None fails the test)."""

    where: str
    name: str
    op: str
    bound: float
    default: float | None = None

    def holds(self, state: State, metrics: dict) -> bool:
        source = {"metric": metrics, "recipe": state.recipe, "data": state.data}[self.where]
        v = source.get(self.name)
        v = self.default if v is None else v
        return v is not None and OPS[self.op](float(v), self.bound)


@dataclass(frozen=True)
class Rule:
    name: str
    tests: tuple[tuple[Test, ...], ...]  # any of these groups, all tests of a group
    recipe: dict = field(default_factory=dict)
    data: dict = field(default_factory=dict)
    special: str = ""  # a test of the history

    def matches(self, state: State, metrics: dict) -> bool:
        past = not self.special or SPECIAL[self.special](state, metrics)
        return past and (not self.tests or any(all(t.holds(state, metrics) for t in g) for g in self.tests))


@dataclass(frozen=True)
class State:
    cycle: int = 0
    recipe: dict = field(default_factory=dict)
    data: dict = field(default_factory=dict)
    history: tuple[dict, ...] = ()
    spent: float = 0.0
    stop: str | None = None


def _moved(history: tuple[dict, ...], metric: str = "bigram_jsd") -> float | None:
    """How far the metric went over the last two entries; None where it is not known."""
    if len(history) < 2:
        return None
    a, b = (h["metrics"].get(metric) for h in history[-2:])
    return None if a is None or b is None else abs(b - a)


def _data_bound(state: State, metrics: dict) -> bool:
    """The last two cycles changed no recipe and moved the metric by less than 0.005."""
    moved = _moved(state.history)
    return moved is not None and moved < 0.005 and not any(h.get("recipe") for h in state.history[-2:])


def _followed_up(state: State, metrics: dict) -> bool:
    """A cycle after the switch has already failed."""
    return any(h.get("rule") == "R7_FOLLOWUP" and (h["metrics"].get("bigram_jsd") or 0) > 0.15 for h in state.history[-2:])


def _near(state: State, metrics: dict) -> bool:
    """Three metrics or more within a tenth below their bounds."""
    bounds = {"bigram_jsd": 0.15, "length_kl": 0.10, "digit_density_delta": 0.03, "english_density_delta": 0.02}
    return sum(0.9 * t < (metrics.get(k) or 0) <= t for k, t in bounds.items()) >= 3


SPECIAL = {"data_bound": _data_bound, "followed_up": _followed_up, "near": _near}

# Names, bounds and changes of the rules, in the order they are tried.
_m, _r, _d = (lambda n, op, b, default=0.0, w=w: Test(w, n, op, b, default) for w in ("metric", "recipe", "data"))
_HIGH = _m("bigram_jsd", ">", 0.15)
_FULL, _RANK, _DORA, _EPOCHS = "CPT_FULL_FT", "LORA_R", "CPT_USE_DORA", "CPT_NUM_EPOCHS"
RULES = [
    Rule("R8", (), data={"REGEN_DATA": 1, "REGEN_REASON": "stagnation", "REGEN_ENABLE_MINHASH": 1, "REGEN_ENABLE_ENTROPY_FILTER": 1, "REGEN_MIN_ENTROPY": "5.5"}, special="data_bound"),
    Rule("R7_EXHAUSTED", ((_r(_FULL, "==", 1), _HIGH),), special="followed_up"),
    Rule("R7_FOLLOWUP", ((_r(_FULL, "==", 1), _HIGH),)),
    Rule("R7", ((_HIGH, _r(_RANK, ">=", 128, 64), _r(_DORA, "==", 1), _r(_EPOCHS, ">=", 2, 1)),), {_FULL: 1, _RANK: 256, "LORA_ALPHA": 256}),
    Rule("R1", ((_HIGH, _r(_EPOCHS, "==", 1, 1)),), {_EPOCHS: 2}),
    Rule("R1b", ((_HIGH, _r(_RANK, "<", 128, 64)),), {_RANK: 128, "LORA_ALPHA": 128}),
    Rule("R1c", ((_HIGH, _r(_DORA, "==", 0)),), {_DORA: 1}),
    Rule("R1_EXHAUSTED", ((_HIGH,),)),
    Rule("R2", ((_m("length_kl", ">", 0.10), _d("OVERSAMPLE_LG_XXL", "<", 3, 2)),), data={"OVERSAMPLE_LG_XXL": 3}),
    Rule("R2b", ((_m("length_kl", ">", 0.10), _d("OVERSAMPLE_LG_XXL", "<", 4, 2)),), {"SEQ_LEN": 2048}, {"OVERSAMPLE_LG_XXL": 4}),
    Rule("R3", tuple((_m(k, ">", b), _d("OVERSAMPLE_DIGIT_ENG", "<", 4, 2)) for k, b in (("digit_density_delta", 0.03), ("english_density_delta", 0.02))), data={"OVERSAMPLE_DIGIT_ENG": 4}),
    Rule("R4", ((_m("mauve_score", "<", 0.80, None), _r(_DORA, "==", 0)),), {_DORA: 1}),
    Rule("R4b", ((_m("mauve_score", "<", 0.80, None), _r("SFT_NUM_EPOCHS", "==", 2, 2)),), {"SFT_NUM_EPOCHS": 3}),
    Rule("R5", ((_r(_EPOCHS, "==", 1, 1),),), {_EPOCHS: 2}, special="near"),
    Rule("R6", ((_r(_RANK, "<", 128, 64),),), {_RANK: 128, "LORA_ALPHA": 128}),
    Rule("NO_RULE", ()),
]
RULES_V2 = [
    Rule("R7", ((_m("domain_keyword_alignment", "<", 0.40, 1.0), _r("SFT_LOSS_WEIGHT_ARGOT", "<", 2.0, 1.5)),), {"SFT_LOSS_WEIGHT_ARGOT": 2.0}),
    Rule("R8", ((_m("reply_depth_kl", ">", 0.20), _r("SEQ_LEN", "<", 3072, 2048)),), {"SEQ_LEN": 3072}),
    Rule("R9", ((_m("persona_consistency", "<", 0.75, 1.0), _r("SFT_PERSONA_BOOST", "<", 2.0, 1.0)),), {"SFT_PERSONA_BOOST": 2.0}),
    Rule("R10", ((_m("punct_ratio_match", ">", 0.20), _r("DROP_FORMAL_PROMO", "==", 0)),), {"DROP_FORMAL_PROMO": 1}),
    Rule("R11", ((_m("initial_marker_match", ">", 0.25), _r("REGEN_SFT_FORCE_ARGOT", "==", 0)),), {"REGEN_SFT_FORCE_ARGOT": 1}),
    Rule("R7-R11_NOOP", ()),
]
FINAL = {"NO_RULE", "R7_EXHAUSTED"}  # nothing is left to change


def first_match(metrics: dict, state: State, rules: list[Rule] = RULES) -> Rule:
    return next(r for r in rules if r.matches(state, metrics))


def step(metrics: dict, state: State, passed: bool = False, cycles: int = 5, cap: float = 25.0, converged: float = 0.04, rules: list[Rule] = RULES) -> State:
    """The next state. It stops, in this order, on the number of cycles, the budget, a metric that moved by less than
    0.01 over the last two cycles, and convergence; a passed gate changes nothing; else the first rule is applied."""
    moved = _moved(state.history)
    if state.cycle >= cycles:
        return replace(state, stop="cycles")
    if state.spent >= cap:
        return replace(state, stop="budget")
    if moved is not None and moved < 0.01:
        return replace(state, stop="stagnation")
    if passed:
        return replace(state, stop="converged" if metrics.get("bigram_jsd", 1) < converged else state.stop)
    rule = first_match(metrics, state, rules)
    if rule.name in FINAL:
        return replace(state, stop=rule.name)
    cycle = state.cycle + bool(rule.recipe or rule.data)
    entry = {"cycle": cycle, "rule": rule.name, "metrics": dict(metrics), "recipe": dict(rule.recipe), "data": dict(rule.data)}
    return replace(state, cycle=cycle, recipe=state.recipe | rule.recipe, data=state.data | rule.data, history=(*state.history, entry))
