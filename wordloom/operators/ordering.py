"""Order-as-data helpers.

Spark keeps no row order, so every operator whose result depends on order
(numbering, first-seen ties, positional pairing) takes explicit order keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, written

_LOCAL_BITS = 33  # monotonically_increasing_id = partition << 33 | row-in-partition

# ---------------------------------------------------------------------------
# First-seen order keys
# ---------------------------------------------------------------------------
# "Seen first" ties need the earliest (batch, doc_id, position) of a group. A
# struct minimum has a variable-width buffer, which forces a sort-based
# aggregate over every occurrence; packing the triple into one exact
# DECIMAL(38,0) keeps the buffer fixed-width, so the aggregate is a hash
# aggregate with map-side combine.
_DEC = "decimal(38,0)"


def _d(v: int) -> Column:
    return F.lit(str(v)).cast(_DEC)


_POS_SPAN = 10**12  # positions within a document
_DOC_SPAN = 10**20  # shifted doc ids: doc_id + 2^63 < 10^20
_DOC_SHIFT = 2**63
MAX_BATCH = 10**6 - 1


def first_key(batch: Column, doc_id: Column, i: Column) -> Column:
    """``(batch, doc_id, i)`` as one order-preserving DECIMAL(38,0); batches 0 to ``MAX_BATCH`` fit."""
    shifted = doc_id.cast(_DEC) + _d(_DOC_SHIFT)
    return ((batch.cast(_DEC) * _d(_DOC_SPAN) + shifted) * _d(_POS_SPAN) + i.cast(_DEC)).cast(_DEC)


def key_at(base: Column, batch: int, i: Column) -> Column:
    """``first_key(batch, doc_id, i)`` from ``base = first_key(0, doc_id, 0)``."""
    if batch:
        base = base + _d(batch * _DOC_SPAN * _POS_SPAN)
    return (base + i.cast(_DEC)).cast(_DEC)


# A key is read by its digits: 6 of the batch, 20 of the shifted document and 12 of the position.
def _digits(key: Column, start: int, n: int) -> Column:
    return F.substring(F.lpad(key.cast("string"), 38, "0"), start, n)


def key_pos(key: Column) -> Column:
    return _digits(key, 27, 12).cast("bigint").cast("int")


def key_doc(key: Column) -> Column:
    return (_digits(key, 7, 20).cast("decimal(20,0)") - _d(_DOC_SHIFT)).cast("bigint")


def key_batch(key: Column) -> Column:
    return _digits(key, 1, 6).cast("int")


def dense_index(
    df: DataFrame,
    order: Sequence[str | Column],
    name: str = "idx",
    start: int = 1,
    partitions: int | None = None,
) -> DataFrame:
    """Number rows ``start, start+1, ...`` in ``order`` without a single-task sort.

    ``order`` must identify rows uniquely (ties would make numbering
    arbitrary). Rows are range-partitioned on the order keys, sorted inside each
    partition and written with their places (so partition membership and order are
    fixed even if an executor is lost and tasks re-run; as Parquet, a checkpoint
    of such rows takes several times the bytes); per-partition counts (one row per
    partition) give each partition's offset. This is the DataFrame form of
    ``zipWithIndex``: two passes, no global single-partition window.
    """
    spark = df.sparkSession
    if partitions is None:
        partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    ranged = (
        df.repartitionByRange(partitions, *cols)
        .sortWithinPartitions(*cols)
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    ranged = written(ranged, "ranged")
    ranged = ranged.withColumn("_part", F.shiftright(F.col("_mid"), _LOCAL_BITS)).withColumn(
        "_local", F.col("_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    )
    # One row per partition: the size of this table is the partition count.
    counts = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_part",
        (F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))).alias("_off"),
    ).fillna(0, subset=["_off"])
    out = ranged.join(F.broadcast(offsets), "_part").withColumn(
        name, F.col("_off") + F.col("_local") + F.lit(start)
    )
    return out.drop("_mid", "_part", "_local", "_off")


def prefix_sum(df: DataFrame, order: Sequence[str], value: str, name: str, partitions: int | None = None) -> DataFrame:
    """The sum of ``value`` over all rows before each row in ``order`` (unique), without a single-task sort.

    Rows are range-partitioned and checkpointed; partition sums (one row per
    partition) give each partition's offset and a window runs inside it. They
    are checkpointed before as well: finding the ranges reads them once more.
    """
    df = cut_lineage(df)
    if partitions is None:
        partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut_lineage(df.repartitionByRange(partitions, *order).withColumn("_part", F.spark_partition_id()))
    offsets = ranged.groupBy("_part").agg(F.sum(value).alias("_s")).select(
        "_part", F.coalesce(F.sum("_s").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off")
    )
    local = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = ranged.withColumn("_loc", F.coalesce(F.sum(value).over(local), F.lit(0)))
    return out.join(F.broadcast(offsets), "_part").withColumn(name, F.col("_off") + F.col("_loc")).drop("_part", "_off", "_loc")


def running_sum(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    value: str,
    name: str = "before",
    partitions: int | None = None,
) -> DataFrame:
    """Per ``key``, the sum of ``value`` over the rows before each row in
    ``order`` (exclusive prefix sum), plus the key's ``{name}_total`` and
    ``{name}_rows``, without a whole key in one task.

    Rows are range-partitioned on ``(key, *order)``, so a key holding a large
    share of the rows is split into several chunks. Per (key, chunk) sums --
    at most ``partitions`` rows per key -- give each chunk's offset; running
    sums are taken inside each chunk. ``(key, *order)`` must be unique. The
    chunked table is checkpointed so chunk ids are fixed across retries.
    """
    spark = df.sparkSession
    if partitions is None:
        partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(partitions, key, *order).withColumn("_chunk", F.spark_partition_id())
    ranged = cut_lineage(ranged)
    chunks = ranged.groupBy(key, "_chunk").agg(F.sum(value).alias("_s"), F.count(F.lit(1)).alias("_n"))
    per_key = Window.partitionBy(key)
    offsets = chunks.select(
        key, "_chunk",
        F.coalesce(
            F.sum("_s").over(per_key.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_off"),
        F.sum("_s").over(per_key).alias(f"{name}_total"),
        F.sum("_n").over(per_key).alias(f"{name}_rows"),
    )
    local = Window.partitionBy(key, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = ranged.withColumn("_loc", F.coalesce(F.sum(value).over(local), F.lit(0)))
    out = out.join(offsets, [key, "_chunk"]).withColumn(name, F.col("_off") + F.col("_loc"))
    return out.drop("_chunk", "_off", "_loc")
