"""Incremental n-gram counting over a stream of documents.

Training is additive (a further ``train`` call adds counts without bridging
sequences), so a micro-batch is counted by itself and its counts are added to
what is there: they are a folder of a table, or, with :func:`start_ngram_parts`,
a part of a store, where parts are merged every few batches. What is kept
between batches is that table, as large as the model; a streaming aggregate
would keep the model a second time, in its executors' memory and its checkpoint.
A replayed batch takes the place of its first run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.ngram import train_ngram
from ..sources.parts import Keyed, PartStore

DOC_SCHEMA = "doc_id bigint, text string"


def stream_documents(
    spark: SparkSession, path: str, fmt: str = "parquet", max_files: int | None = None, base_path: str | None = None
) -> DataFrame:
    """Documents arriving as files under ``path`` (a folder or a glob below ``base_path``)."""
    reader = spark.readStream.schema(DOC_SCHEMA).format(fmt)
    if base_path:
        reader = reader.option("basePath", base_path)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def start_ngram_counts(
    docs: DataFrame, n: int, table_path: str, checkpoint_path: str, available_now: bool = True
) -> StreamingQuery:
    """Start the counting query; every batch adds ``context, word, cnt, first`` of its own documents as a folder ``batch_id=``."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        train_ngram(batch, n).counts.write.mode("overwrite").parquet(f"{table_path}/batch_id={batch_id}")

    writer = docs.select("doc_id", "text").writeStream.option("checkpointLocation", checkpoint_path).foreachBatch(sink)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def current_counts(spark: SparkSession, table_path: str) -> DataFrame:
    """The model as of the last batch: the counts of all batches together. One batch is that already."""
    folders = spark._jvm.org.apache.hadoop.fs.Path(f"{table_path}/batch_id=*")
    batches = folders.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(folders)
    rows = spark.read.parquet(table_path).select("context", "word", "cnt", "first")
    if len(batches) == 1:
        return rows
    return rows.groupBy("context", "word").agg(F.sum("cnt").alias("cnt"), F.min("first").alias("first"))


def counts_store(spark: SparkSession, path: str, buckets: int = 64) -> PartStore:
    """Counts of a stream: a part has the counts of its batch, which add up."""
    spec = Keyed("context string, word string, cnt bigint, first decimal(38,0)", ("context", "word"), (("cnt", "sum"), ("first", "min")))
    return PartStore(spark, path, {"counts": spec}, buckets)


def start_ngram_parts(
    docs: DataFrame, n: int, store: PartStore, checkpoint_path: str, compact_every: int = 8, available_now: bool = True
) -> StreamingQuery:
    """Start the counting query with a store as its sink. A batch is one part, tagged with its number, so a replayed one
    changes nothing; ``compact_every`` parts become one and the old ones are deleted."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        if batch_id <= store.version().tag:
            return
        counts = train_ngram(batch, n).training.counts(store.buckets, store.tables["counts"].keys)
        if len(store.append({"counts": counts}, tag=batch_id, dealt=("counts",)).parts) >= compact_every:
            store.compact()
            store.vacuum()

    writer = docs.select("doc_id", "text").writeStream.option("checkpointLocation", checkpoint_path).foreachBatch(sink)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()
