"""Session helpers: building a local session for tests/bench and resolving the
checkpoint folder that iterative jobs use to cut lineage."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # remove reliable checkpoint files once their DataFrames are garbage-collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "wordloom") -> SparkSession:
    """A local session with the settings the tests and bench assume."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("WORDLOOM_DRIVER_MEMORY", "16g"))
    for k, v in _LOCAL_DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only when none is named.

    On a cluster the folder must be shared storage named by
    ``spark.checkpoint.dir``; a machine-local temporary folder is only used
    when the session runs in local mode and names no folder itself.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if named:
        sc.setCheckpointDir(named)
        return sc.getCheckpointDir()
    if not re.match(r"local(\[|$)", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running iterative jobs")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="wordloom-ckpt-"))
    return sc.getCheckpointDir()


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting of the session while something runs here."""
    old = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if old is None else spark.conf.set(name, old)


def ship_package(spark: SparkSession) -> None:
    """Give the workers this package, once per application: they may start elsewhere than the driver."""
    sc = spark.sparkContext
    if getattr(sc, "_wordloom_shipped", False):
        return
    package = Path(__file__).resolve().parent
    zipped = Path(tempfile.mkdtemp(prefix="wordloom-")) / "wordloom.zip"
    with zipfile.ZipFile(zipped, "w") as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, p.relative_to(package.parent))
    sc.addPyFile(str(zipped))
    sc._wordloom_shipped = True  # type: ignore[attr-defined]


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` into the reliable checkpoint folder and return a
    DataFrame that reads it back (survives executor loss; bounded lineage).

    An eager checkpoint computes the plan once, while it writes (a test counts
    that), so no cached copy is held or written beside it.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, what: str) -> DataFrame:
    """``df`` written as a Parquet table under the shared checkpoint folder and read back: as durable as :func:`cut_lineage`,
    compressed, but its partitions may be others."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/tables/{what}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ensure_parallel(df: DataFrame, key: str | None = None, at_least: int | None = None) -> DataFrame:
    """Spread a CPU-heavy input over ``at_least`` tasks when its scan gives fewer; the caller decides the number
    (None: the scan is left as it is).

    A large scan already has many splits and is left alone (no shuffle); a
    file with a single row group would otherwise run all tokenization in one
    task. Hash partitioning on a unique key keeps retries deterministic
    without the sort a round-robin repartition needs.

    Meant for file scans, where counting partitions is planning only; on a
    plan that already contains a shuffle, adaptive execution would run the
    upstream stages to answer, so callers apply it right after the read.
    """
    if df.isStreaming or at_least is None or df.rdd.getNumPartitions() >= at_least:
        return df
    return df.repartition(at_least, key) if key else df.repartition(at_least)


def tasks_for(spark: SparkSession, path: str, per_task: int) -> int:
    """Tasks that a table at ``path`` is dealt to for ``per_task`` of its bytes each, as many as there are cores at least."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    size = folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()
    return max(spark.sparkContext.defaultParallelism, -(-size // per_task))
