"""Every registered query of the core: name -> (callable, SQL for the same result or None)."""

from __future__ import annotations

from . import audit, building, corpus, events, files, gates, hierarchy, links, shapes

QUERIES: dict = {}
for _module in (hierarchy, corpus, audit, building, events, gates, shapes, files, links):
    QUERIES.update(_module.QUERIES)
