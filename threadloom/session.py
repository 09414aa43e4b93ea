"""Session helpers: where tables live, and how lineage is cut."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_OWN_DIR: str | None = None


def build(app: str = "threadloom", cores: int | str = 8, partitions: int | None = None) -> SparkSession:
    """A local session with the settings the library expects (adaptive execution, UTC, Arrow)."""
    parts = partitions or (cores if isinstance(cores, int) else 8)
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("THREADLOOM_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def ship(spark: SparkSession) -> None:
    """Sends the package to the executors' Python workers, once per application."""
    sc = spark.sparkContext
    if getattr(sc, "_threadloom_shipped", False):
        return
    here = Path(__file__).resolve().parent
    path = Path(tempfile.mkdtemp(prefix="threadloom-code-")) / "threadloom_code.zip"
    with zipfile.ZipFile(path, "w") as z:
        for p in sorted(here.rglob("*.py")):
            z.write(p, p.relative_to(here.parent))
    sc.addPyFile(str(path))
    sc._threadloom_shipped = True


def wide(df: DataFrame, rows: int, *keys: str, per: int = 2_000_000) -> DataFrame:
    """Partitioned by the keys for ``rows`` rows, ``per`` a partition, where the session's own number is too small for that;
    else left to the planner. Adaptive execution joins small partitions but cannot cut large ones apart."""
    n = -(-rows // per)
    return df.repartition(n, *keys) if n > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def ship_file(path: str) -> None:
    """Sends a file to the executors, once per application; workers find it by ``SparkFiles.get``."""
    spark = SparkSession.getActiveSession()
    if spark is None:
        return
    sent = spark.sparkContext.__dict__.setdefault("_threadloom_files", set())
    if path not in sent:
        spark.sparkContext.addFile(path)
        sent.add(path)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """One input table; naming the columns keeps the scan's ReadSchema to them."""
    ship(spark)
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def spread(df: DataFrame) -> DataFrame:
    """A scan in fewer partitions than there are cores, spread over all of them, for work that is heavy per row.

    Large inputs come in more partitions than that and are left as they are, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    have = df._jdf.queryExecution().toRdd().getNumPartitions()
    return df if have >= cores else df.repartition(cores)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in spark.checkpoint.dir.

    Only where the setting is absent on a local master (tests, local runs) a folder of our own is made; on a cluster
    its absence is an error, since a machine's own folder is not shared.
    """
    global _OWN_DIR
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if _OWN_DIR is None:
        _OWN_DIR = "file://" + tempfile.mkdtemp(prefix="threadloom-")
        spark.sparkContext.setCheckpointDir(_OWN_DIR)
    return _OWN_DIR


class Stage:
    """Written intermediate tables of one run of an iterative operator.

    ``cut`` writes a table to the shared folder and reads it back, which ends its lineage: a lost
    executor costs one stage, not the whole loop. ``drop`` removes tables that no later step reads.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/threadloom/{name}-{uuid.uuid4().hex}"
        tidy_at_exit(spark, self.root)
        self._n = 0
        self._paths: dict[int, str] = {}

    def cut(self, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{self._n}"
        self._n += 1
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(out)] = path
        return out

    def cut_counted(self, df: DataFrame) -> tuple[DataFrame, int]:
        """``cut``, and the number of rows written, without a job of its own."""
        seen = Observation()
        out = self.cut(df.observe(seen, F.count(F.lit(1)).alias("n")))
        return out, seen.get["n"]

    def add(self, df: DataFrame, name: str) -> tuple[DataFrame, int]:
        """Appends to the table ``name`` and reads all of it: ``(table, rows added)``. Its plan stays one scan."""
        seen = Observation()
        path = f"{self.root}/{name}"
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path), seen.get["n"]

    def drop(self, *dfs: DataFrame) -> None:
        for df in dfs:
            path = self._paths.pop(id(df), None)
            if path:
                _delete(self.spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


_LEFT: list[tuple[SparkSession, str]] = []


def tidy_at_exit(spark: SparkSession, root: str) -> None:
    """Results may be read as long as the application lives; then its tables go."""
    if not _LEFT:
        atexit.register(_tidy)
    _LEFT.append((spark, root))


def _tidy() -> None:
    for spark, root in _LEFT:
        try:
            _delete(spark, root)
        except Exception:  # noqa: BLE001  the application is gone, and its folder is the cluster's to clean
            return
