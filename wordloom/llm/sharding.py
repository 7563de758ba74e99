"""Sharding by a two-pass external shuffle.

Pass 1 scatters the rows uniformly into buckets by a seeded hash of the row's
place in the input, so equal rows and hot keys spread like any others; the
number of buckets follows the input's bytes, so that one fits in memory. It is
written to the shared folder, so that the buckets' sizes and pass 2 see one and
the same scatter, however the input is computed. Pass 2 shuffles each bucket
with Fisher-Yates, seeded by the bucket, and writes it. The buckets one after another are a uniform random order of all rows; it is
cut into shards at equal numbers of rows (law ``rows``), so a bucket goes to one
shard or to a few neighbours.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm import common as C

BUCKET_BYTES = 16 << 20
ROW_BYTES = 16


def fisher_yates(n: int, rng: np.random.Generator) -> np.ndarray:
    """A uniform permutation of 0..n-1 (numpy's in-place Fisher-Yates)."""
    order = np.arange(n)
    rng.shuffle(order)
    return order


def record_size(text_col: str):
    return (F.coalesce(F.octet_length(text_col), F.lit(0)) + ROW_BYTES).cast("bigint")


def shuffle_to_shards(df: DataFrame, path: str, shards: int, text_col: str = "text", seed: int = 0, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Write all rows of ``df`` under ``path``, partitioned by ``_shard``, with ``_slot`` and ``_size``
    added, and return them as read back.

    ``_shard`` is 0 to shards - 1 and counts differ by one at most; ``_slot`` counts 0, 1, ... within a shard without
    gaps. Nulls stay null (a null text has 16 bytes), repeated rows are all kept, an empty table gives none; a text
    larger than a bucket makes that one bucket larger. Columns whose names begin with ``_shard``, ``_slot``, ``_size``
    or ``_bucket`` are refused.
    """
    own = {"_shard", "_slot", "_size", "_bucket"}
    if clash := own & {c.lower() for c in df.columns}:
        raise ValueError(f"columns {sorted(clash)} are taken")
    spark = df.sparkSession
    C.ship(spark)
    sized = df.withColumn("_size", record_size(text_col))
    total = sized.agg(F.sum("_size").alias("b")).first()["b"] or 0
    buckets = max(1, -(-int(total) // bucket_bytes))
    place = F.xxhash64(F.lit(seed), F.monotonically_increasing_id())
    scratch = C.Scratch(spark, "scatter")
    scattered = sized.withColumn("_bucket", F.pmod(place, F.lit(buckets)))
    scattered.write.option("compression", "zstd").parquet(scratch.path("rows"))
    dealt = spark.read.schema(scattered.schema).parquet(scratch.path("rows"))
    counts = dict(dealt.groupBy("_bucket").count().collect())  # one number per bucket
    n = np.array([counts.get(b, 0) for b in range(buckets)], np.int64)
    offset = np.concatenate(([0], np.cumsum(n)))
    cut = (np.arange(shards + 1, dtype=object) * int(offset[-1]) // shards).astype(np.int64)
    layout = spark.sparkContext.broadcast((offset, cut))  # 8 bytes for each bucket

    def write(key, table):
        offset, cut = layout.value
        b = key[0].as_py()
        table = table.take(pa.array(fisher_yates(len(table), np.random.default_rng([seed, b]))))
        at = offset[b] + np.arange(len(table))
        shard = np.searchsorted(cut, at, "right") - 1
        return table.drop_columns(["_bucket"]).append_column("_shard", pa.array(shard, pa.int32())).append_column("_slot", pa.array(at - cut[shard]))

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in sized.schema), "_shard int, _slot bigint"])
    done = dealt.groupBy("_bucket").applyInArrow(write, schema)
    done.write.mode("overwrite").option("compression", "zstd").partitionBy("_shard").parquet(path)
    scratch.drop("rows")
    return spark.read.schema(done.schema).parquet(path)
