"""Word n-gram next-word model as DataFrames.

``n`` is the context length: the ``n`` preceding tokens of a sequence predict
the token that follows. Each document is one sequence (no bridging between
documents, no padding); a document with at most ``n`` tokens only adds to the
vocabulary.

Model tables
------------
``counts``: ``context STRING`` (context tokens joined by one space -- tokens
never contain whitespace), ``word STRING``, ``cnt BIGINT`` and
``first DECIMAL(38,0)``: the earliest occurrence of the (context, word) pair,
which is the reference's "seen first" tie order. ``first`` packs
``(batch, doc_id, i)`` into one exact number (:func:`first_key`) so the
counting aggregate keeps a fixed-width buffer and runs as a hash aggregate
(a struct minimum would force a sort-based aggregate over every occurrence).

``vocab``: ``word STRING``.

All steps are built-in expressions. Training is lazy: counts and vocabulary are
one aggregation each (partial aggregation before the exchange absorbs hot
contexts), and a query that needs only one of them computes only that one.
``NgramModel.materialize`` writes both where a model is used more than once.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import grams
from ..functions.text import split_whitespace, word_tokens
from ..session import cut_lineage, ensure_checkpoint_dir, setting, ship_package
from ..sources.parts import Keyed, PartStore, Version
from .ordering import MAX_BATCH, dense_index, first_key, key_at, key_batch, key_doc, key_pos, running_sum  # noqa: F401  (re-exported)

# Statuses of a prediction / generation row.
STATUS_OK = "ok"
STATUS_OOV = "oov"
STATUS_UNSEEN = "unseen_context"
STATUS_BAD_ARITY = "bad_arity"


def _tokens(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), word_tokens(text_col).alias("t"))


def ngram_events(docs: DataFrame, n: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per (context, next word) occurrence: ``doc_id, i, context, word``."""
    return _events(docs, n, id_col, text_col).drop("base")


def _events(docs: DataFrame, n: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """:func:`ngram_events` and ``base``, the order key of the document's place 0 in batch 0."""
    return _windows(_tokens(docs, id_col, text_col), n, F.lit(0), "int")


def _windows(toks: DataFrame, n: int, shift: Column, kind: str) -> DataFrame:
    """``doc_id, base, i, context, word`` of every word of the token array ``t`` that has n tokens before it; ``i`` counts from ``shift``.

    The array is zipped with itself, shifted by 1 to n words, and the generator
    takes that apart, so the token array is not copied into every output row
    (output is linear in the text); strings are joined in the rows that come
    out. A text of at most n words gives empty slices: a Filter on the token
    array would be pushed below the fan-out repartition and run the regex
    twice, once in the scan task. The order key's wide arithmetic is done once
    a document, and an occurrence adds its place.
    """
    t = F.col("t")
    m = F.greatest(F.size(t) - n, F.lit(0))
    zipped = F.arrays_zip(*[F.slice(t, k + 1, m).alias(f"w{k}") for k in range(n + 1)])
    base = first_key(F.lit(0), F.col("doc_id"), F.lit(0)).alias("base")
    flat = toks.select("doc_id", base, shift.alias("shift"), "t").select("doc_id", "base", "shift", F.posexplode(zipped).alias("p", "x"))
    context = F.concat_ws(" ", *[F.col(f"x.w{k}") for k in range(n)])
    return flat.select("doc_id", "base", (F.col("p") + F.lit(n) + F.col("shift")).cast(kind).alias("i"), context.alias("context"), F.col(f"x.w{n}").alias("word"))


@dataclass(frozen=True)
class Training:
    """Token arrays (``doc_id, shift, t``: the place of the first token) that n-grams are counted from.

    N-grams of a text are nearly all distinct, so a shuffle of counted rows is several times the text. Tasks count some
    millions of words at once and give one row per slot, in which the words are listed once (:mod:`..functions.grams`);
    that is about a third of the bytes, and a task merges the rows of a slot.
    """

    toks: DataFrame
    n: int
    batch: int = 0
    slots: int = 1024  # that are merged one by one, at least: for memory, where there are few partitions

    def _merged(self, parts: int, keys: Sequence[str], kind: str = "counts") -> DataFrame:
        """Partition p of ``parts`` has the n-grams that Spark's own hash of ``keys`` puts there."""
        ship_package(self.toks.sparkSession)
        t, n = F.col("t"), self.n
        zipped = F.arrays_zip(*[F.slice(t, k + 1, F.size(t)).alias(f"w{k}") for k in range(n + 1)])
        flat = self.toks.select("doc_id", "shift", F.posexplode(zipped).alias("p", "x"))
        values = {"context": F.concat_ws(" ", *[F.col(f"x.w{k}") for k in range(n)]), "word": F.col(f"x.w{n}")}
        slots = parts * max(1, -(-self.slots // parts))
        slot = F.when(values["word"].isNotNull(), F.pmod(F.hash(*[values[k] for k in keys]), F.lit(slots)))
        words = flat.select("doc_id", (F.col("p") + F.col("shift")).cast("bigint").alias("pos"), F.col("x.w0").alias("word"), slot.alias("slot"))
        blocks = words.mapInArrow(grams.count_grams(n), grams.BLOCK)
        dealt = blocks.repartitionById(parts, F.pmod("slot", F.lit(parts))).sortWithinPartitions("slot")
        return dealt.mapInArrow(grams.merge_grams(n, kind), grams.ROWS[kind][0])

    def counts(self, parts: int | None = None, keys: Sequence[str] = ("context",)) -> DataFrame:
        """Counts per (context, word) with the first occurrence."""
        rows = self._merged(parts or _shuffles(self.toks), keys)
        first = first_key(F.lit(self.batch), F.col("doc_id"), F.col("pos"))
        return rows.select("context", "word", "cnt", first.alias("first"))

    def located(self) -> DataFrame:
        """:meth:`counts` with the first occurrence as ``first_doc, first_pos``."""
        rows = self._merged(_shuffles(self.toks), ("context",))
        return rows.select("context", "word", "cnt", F.col("doc_id").alias("first_doc"), F.col("pos").cast("int").alias("first_pos"))

    def top1(self, parts: int | None = None) -> DataFrame:
        """A task that has all n-grams of a context takes its most frequent word."""
        return self._merged(parts or _shuffles(self.toks), ["context"], "top")

    def intervals(self, parts: int | None = None) -> DataFrame:
        """A8 support: a task that has all n-grams of a context adds them up in first-seen order."""
        return self._merged(parts or _shuffles(self.toks), ["context"], "intervals")


#: Bytes of the input whose n-grams are merged at once, as Spark's plan estimates them.
_SLOT_BYTES = 4 << 20
_MOST_SLOTS = 8192


def _shuffles(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _slots(df: DataFrame) -> int:
    """Slots for the n-grams of a table, by the bytes that Spark's plan gives for what it is made of (not for the table:
    that of a join is a product); as many as a large table has if it does not know."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return min(-(-size // _SLOT_BYTES), _MOST_SLOTS) if size < 1 << 50 else Training.slots


#: Words that a counting task takes.
_COUNTED = 2_000_000


def chunk_events(chunks: DataFrame, n: int) -> DataFrame:
    """W1 over files cut into chunks (``file, block, seq, text``): ``doc_id, base, i, context, word``."""
    return _windows(_chunk_tokens(chunks, n), n, F.col("shift"), "bigint")


def _chunk_tokens(chunks: DataFrame, n: int) -> DataFrame:
    """Token arrays of files cut into chunks: ``doc_id, shift, t``.

    ``doc_id`` numbers the files in path order. A chunk gets the last ``n``
    words before it, so that a context that crosses a cut is met once, by the
    chunk that holds its next word, and the number of words before it, so that
    places are those in the file. Both come from a table of one small row per
    chunk; the texts themselves are met by the key of their chunk, which is one
    row each, however large a file is.
    """
    key = ["file", "block", "seq"]
    words = chunks.select(*key, word_tokens("text").alias("t"))
    ends = cut_lineage(words.select(*key, F.size("t").cast("bigint").alias("n"), F.slice("t", F.greatest(F.size("t") - n + 1, F.lit(1)), n).alias("end")).where("n > 0"))
    total = ends.agg(F.sum("n")).first()[0] or 0
    before = Window.partitionBy("file").orderBy("block", "seq")
    # every chunk here has a word, so that n chunks hold n words
    last = F.flatten(F.collect_list("end").over(before.rowsBetween(-n, -1)))
    halo = F.slice(last, F.greatest(F.size(last) - n + 1, F.lit(1)), n)
    ends = ends.select(*key, halo.alias("halo"), F.coalesce(F.sum("n").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("past"))
    files = dense_index(chunks.select("file").distinct(), ["file"], "doc_id", start=0).select("file", "doc_id")
    spark = chunks.sparkSession
    # a fixed number of tasks, not one by bytes: their words become n-grams, which are counted in memory
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // _COUNTED))
    # texts are moved and taken apart again: their words, one by one, are several times the bytes
    each = chunks.select(*key, "text").repartition(tasks, *key).join(ends.join(files, "file").hint("merge"), key)
    return each.select("doc_id", (F.col("past") - F.size("halo")).alias("shift"), F.concat("halo", word_tokens("text")).alias("t"))


def count_events(events: DataFrame, batch: int = 0) -> DataFrame:
    """Counts per (context, word) with the first occurrence."""
    if "base" in events.columns:
        first = key_at(F.col("base"), batch, F.col("i"))
    else:
        first = first_key(F.lit(batch), F.col("doc_id"), F.col("i"))
    return events.groupBy("context", "word").agg(F.count(F.lit(1)).alias("cnt"), F.min(first).alias("first"))


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """G1: distinct tokens (short documents included)."""
    toks = _tokens(docs, id_col, text_col)
    return toks.select(F.explode("t").alias("word")).distinct()


@dataclass
class NgramModel:
    n: int
    counts: DataFrame
    vocab: DataFrame
    training: Training | None = None  # what counts are made from, in a model that was only trained

    # ---- derived tables -------------------------------------------------
    def located(self) -> DataFrame:
        """``counts`` with the document and place of the first occurrence in columns of their own, not packed into one number."""
        if self.training:
            return self.training.located()
        return self.counts.select("context", "word", "cnt", key_doc(F.col("first")).alias("first_doc"), key_pos(F.col("first")).alias("first_pos"))

    def totals(self) -> DataFrame:
        """``context, total``."""
        return self.counts.groupBy("context").agg(F.sum("cnt").alias("total"))

    def probabilities(self) -> DataFrame:
        """``cnt / total`` per (context, word).

        Totals come from a partial aggregate joined back on ``context`` (not a
        window, which would hold a hot context in one task; AQE can split a
        skewed join partition, and broadcasts the totals when they are small).
        """
        return self.counts.join(self.totals(), "context").select(
            "context", "word", "cnt", "first", "total", (F.col("cnt") / F.col("total")).alias("prob")
        )

    def top1(self) -> DataFrame:
        """Most frequent next word per context, first-seen on ties.

        A model that was only trained takes it where the counts are made. Others:
        one aggregate (``min_by`` over ``(-cnt, first)``), partial-aggregated
        before the shuffle, so a hot context costs one row per map task.
        """
        if self.training:
            return self.training.top1()
        return self.counts.groupBy("context").agg(
            F.min_by("word", F.struct((-F.col("cnt")).alias("neg"), F.col("first"))).alias("word"),
            F.max("cnt").alias("cnt"),
            F.sum("cnt").alias("total"),
        )

    def intervals(self) -> DataFrame:
        """A8 support: each word's ``[lo, lo + cnt)`` slice of ``[0, total)`` in
        first-seen order, with the context's ``total`` and word count ``nwords``.
        Of a model that was only trained, they are made where the counts are;
        else by :func:`running_sum`, so a hot context is split over tasks."""
        if self.training:
            return self.training.intervals()
        iv = running_sum(self.counts.select("context", "word", "cnt", "first"), "context", ["first"], "cnt", "lo")
        return iv.select("context", "word", "cnt", "lo", F.col("lo_total").alias("total"), F.col("lo_rows").alias("nwords"))

    def materialize(self) -> "NgramModel":
        """Both tables written under the shared checkpoint folder and read back."""
        spark = self.counts.sparkSession
        path = _scratch(spark, "ngram-model")
        self.save(path)
        return NgramModel.load(spark, path)

    # ---- training -------------------------------------------------------
    def update(self, docs: DataFrame, batch: int, id_col: str = "doc_id", text_col: str = "text") -> "NgramModel":
        """Add a further training batch (no bridge between batches)."""
        delta = train_ngram(docs, self.n, id_col, text_col, batch)
        counts = (
            self.counts.unionByName(delta.counts)
            .groupBy("context", "word")
            .agg(F.sum("cnt").alias("cnt"), F.min("first").alias("first"))
        )
        vocab = self.vocab.unionByName(delta.vocab).distinct()
        return NgramModel(self.n, counts, vocab)

    # ---- persistence (S7) ----------------------------------------------
    def save(self, path: str) -> None:
        spark = self.counts.sparkSession
        self.counts.write.mode("overwrite").parquet(f"{path}/counts")
        self.vocab.write.mode("overwrite").parquet(f"{path}/vocab")
        spark.createDataFrame([(self.n,)], "n int").write.mode("overwrite").parquet(f"{path}/meta")

    @staticmethod
    def load(spark, path: str) -> "NgramModel":
        n = spark.read.parquet(f"{path}/meta").first()["n"]
        return NgramModel(n, spark.read.parquet(f"{path}/counts"), spark.read.parquet(f"{path}/vocab"))


class NgramStore:
    """A saved model that further training adds to, without reading or rewriting what is there.

    Every training batch is a part of the store (counts and vocabulary); counts add up and the earliest place stays.
    """

    def __init__(self, spark, path: str, n: int, buckets: int = 64) -> None:
        self.n = n
        counts = Keyed("context string, word string, cnt bigint, first decimal(38,0)", ("context", "word"), (("cnt", "sum"), ("first", "min")))
        self.parts = PartStore(spark, path, {"counts": counts, "vocab": Keyed("word string", ("word",))}, buckets)

    def train(self, docs: DataFrame, batch: int, id_col: str = "doc_id", text_col: str = "text") -> Version:
        """Add a training batch; a batch whose number is not above the last one's is there already, and nothing is done."""
        delta = train_ngram(docs, self.n, id_col, text_col, batch)
        counts = delta.training.counts(self.parts.buckets, self.parts.tables["counts"].keys)
        return self.parts.append({"counts": counts, "vocab": delta.vocab}, tag=batch, dealt=("counts",))

    def model(self, version: int | None = None) -> NgramModel:
        return NgramModel(self.n, self.parts.read("counts", version), self.parts.read("vocab", version))


def train_ngram(docs: DataFrame, n: int, id_col: str = "doc_id", text_col: str = "text", batch: int = 0) -> NgramModel:
    """Train on a table of documents; each document is one sequence. Nothing runs until a table is used."""
    if n < 1:
        raise ValueError("n must be >= 1")
    if not 0 <= batch <= MAX_BATCH:
        raise ValueError(f"batch must be 0 to {MAX_BATCH}")
    training = Training(_tokens(docs, id_col, text_col).select("doc_id", F.lit(0).alias("shift"), "t"), n, batch, _slots(docs))
    return NgramModel(n, training.counts(), vocabulary(docs, id_col, text_col), training)


def train_ngram_chunks(chunks: DataFrame, n: int, batch: int = 0) -> NgramModel:
    """A7 over files cut into chunks; equal to :func:`train_ngram` over the same files whole."""
    if n < 1:
        raise ValueError("n must be >= 1")
    if not 0 <= batch <= MAX_BATCH:
        raise ValueError(f"batch must be 0 to {MAX_BATCH}")
    vocab = chunks.select(F.explode(word_tokens("text")).alias("word")).distinct()
    training = Training(_chunk_tokens(chunks, n), n, batch)
    return NgramModel(n, training.counts(), vocab, training)


def _scratch(spark, what: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{what}-{uuid.uuid4().hex}"


# ---------------------------------------------------------------------------
# Prompts and prediction
# ---------------------------------------------------------------------------

def normalize_prompts(prompts: DataFrame, text_col: str = "text") -> DataFrame:
    """Lower-case and whitespace-split (not the tokenizer: ``a,`` stays ``a,``)."""
    return prompts.withColumn("words", split_whitespace(F.lower(F.col(text_col))))


def _check_prompts(model: NgramModel, prompts: DataFrame) -> DataFrame:
    """P12 + P14: ``prompt_id, words, status, oov_word`` (status null = usable)."""
    exploded = prompts.select("prompt_id", F.posexplode("words").alias("pos", "word"))
    oov = (
        exploded.join(model.vocab, "word", "left_anti")
        .groupBy("prompt_id")
        .agg(F.min_by("word", "pos").alias("oov_word"))
    )
    checked = prompts.select("prompt_id", "words").join(oov, "prompt_id", "left")
    status = (
        F.when(F.col("words").isNull() | (F.size("words") != model.n), F.lit(STATUS_BAD_ARITY))
        .when(F.col("oov_word").isNotNull(), F.lit(STATUS_OOV))
    )
    return checked.withColumn("status", status).withColumn(
        "oov_word", F.when(F.col("status") == STATUS_OOV, F.col("oov_word"))
    )


def uniform_draw(seed: int, prompt_id: Column, step: Column, total: Column) -> Column:
    """A8 draw: an integer in ``[0, total)`` from ``md5(seed:prompt:step)``.

    ``r = (u32 * total) >> 32`` in exact integer arithmetic, the same in any
    engine that has md5. The product is formed in two 16-bit halves so it
    stays within 64 bits for any total below 2^47.
    """
    key = F.concat_ws(":", F.lit(str(seed)), prompt_id.cast("string"), step.cast("string"))
    u32 = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")
    t = total.cast("bigint")
    hi = F.shiftright(u32, 16)
    lo = u32.bitwiseAND(F.lit(0xFFFF))
    return F.shiftright(hi * t + F.shiftright(lo * t, 16), 16)


def _width() -> Column:
    """Bucket width of a context: ceil(total / nwords), exact integer arithmetic."""
    return F.expr("(total + nwords - 1) div nwords")


#: Elements of an array that one row may explode into at once.
_RUN = 1 << 16


def bucketed_intervals(intervals: DataFrame) -> DataFrame:
    """Intervals keyed by ``(context, bucket)`` for an equi-join lookup of a draw.

    A context's mass ``[0, total)`` is cut into ``nwords`` buckets of width
    ``w = ceil(total / nwords)``; each interval is copied to every bucket it
    overlaps (at most ``3 * nwords`` copies per context in all). A draw ``r``
    joins bucket ``r div w`` only and meets at most ``w + 2`` intervals. An
    interval over many buckets is unrolled in two steps, so no row holds an
    array of them all.
    """
    spans = intervals.withColumn("w", _width()).select(
        "context", "word", "lo", "cnt", "total", "w", F.expr("lo div w").alias("b0"), F.expr("(lo + cnt - 1) div w").alias("b1")
    )
    runs = spans.withColumn("s", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(b1 - b0) div {_RUN}"))))
    bucket = F.explode(F.sequence(F.expr(f"b0 + s * {_RUN}"), F.expr(f"least(b1, b0 + (s + 1) * {_RUN} - 1)")))
    return runs.select("context", "word", "lo", "cnt", "total", "w", bucket.alias("bucket"))


class Lookups:
    """Lookup tables of one prediction job, bucketed on their join keys under the shared checkpoint folder.

    A table is written once, bucket by bucket; every later join reads it as it
    lies, so only the (distinct) keys that are asked for are shuffled; all are
    bucketed on the context, that of a join on more keys too (:func:`_as_it_lies`).
    ``drop`` removes the tables.
    """

    def __init__(self, model: NgramModel, mode: str) -> None:
        self.spark = model.counts.sparkSession
        self.parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.tables: dict[str, str] = {}
        self.mode = mode
        trained = model.training
        if mode == "top1":
            top = trained.top1(self.parts) if trained else model.top1()
            self._write("top1", top.select("context", F.col("word").alias("next_word")), ["context"], bool(trained))
        elif mode == "sample":
            iv = trained.intervals(self.parts) if trained else model.intervals()
            self._write("buckets", bucketed_intervals(iv), ["context"], bool(trained))
            first = self.table("buckets").where("lo = 0 AND bucket = 0")  # one row of each context
            self._write("totals", first.select("context", "total", "w"), ["context"], False)
        else:
            raise ValueError(f"unknown mode {mode!r}")

    def _write(self, name: str, df: DataFrame, keys: list[str], dealt: bool) -> None:
        """``dealt``: every partition is a bucket already, in order of its keys; it is written as it comes, neither shuffled nor sorted."""
        path = _scratch(self.spark, name)
        table = f"wordloom_{path.rsplit('/', 1)[1].replace('-', '_')}"
        self.tables[name] = table
        if dealt:
            with setting(self.spark, "spark.sql.maxConcurrentOutputFileWriters", "2"):
                df.write.bucketBy(self.parts, *keys).option("path", path).saveAsTable(table)
        else:  # the same hash as the bucketing: one task writes one bucket
            df.repartition(self.parts, *keys).write.bucketBy(self.parts, *keys).sortBy(*keys).option("path", path).saveAsTable(table)

    def table(self, name: str) -> DataFrame:
        return self.spark.table(self.tables[name])

    def drop(self) -> None:
        jvm = self.spark._jvm
        for table in self.tables.values():
            where = self.spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").first()["data_type"]
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
            path = jvm.org.apache.hadoop.fs.Path(where)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


#: Join keys that one context's prompts are spread over.
SALTS = 16


def _answer(queries: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """Left join of ``queries(prompt_id, ...)`` with a lookup table on ``keys``.

    The table meets the distinct keys only; what they find is copied
    ``SALTS`` times, and a prompt takes the copy of its own hash. A context that
    a third of the prompts are at is one lookup and ``SALTS`` join keys.
    """
    found = queries.select(*keys).distinct().join(table, keys)
    copies = found.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = queries.withColumn("_salt", F.pmod(F.xxhash64("prompt_id"), F.lit(SALTS)).cast("int"))
    return salted.join(copies, [*keys, "_salt"], "left").drop("_salt")


def _as_it_lies(spark):
    """While lookups are planned: a table that is bucketed on one of the keys of a join stays where it is."""
    return setting(spark, "spark.sql.requireAllClusterKeysForCoPartition", "false")


def _next_words(queries: DataFrame, lookups: Lookups, seed: int) -> DataFrame:
    """``queries(prompt_id, step, context, ...)`` with ``next_word`` (NULL where the context is unseen)."""
    if lookups.mode == "top1":
        return _answer(queries, lookups.table("top1"), ["context"])
    q = _answer(queries, lookups.table("totals"), ["context"]).where(F.col("total").isNotNull())
    q = q.withColumn("r", uniform_draw(seed, F.col("prompt_id"), F.col("step"), F.col("total"))).withColumn("bucket", F.expr("r div w"))
    hit = _answer(q.select("prompt_id", "context", "bucket", "r"), lookups.table("buckets").drop("total", "w"), ["context", "bucket"])
    drawn = hit.where((F.col("lo") <= F.col("r")) & (F.col("r") < F.col("lo") + F.col("cnt")))
    # One query per prompt within a step: the prompt id alone is the key.
    return queries.join(drawn.select("prompt_id", F.col("word").alias("next_word")), "prompt_id", "left")


def _require_n(model: NgramModel, expect_n: int | None) -> None:
    """A model trained with one context length cannot serve another."""
    if expect_n is not None and expect_n != model.n:
        raise ValueError(f"model has context length n={model.n}, not n={expect_n}")


def predict(model: NgramModel, prompts: DataFrame, mode: str = "top1", seed: int = 0,
            expect_n: int | None = None) -> DataFrame:
    """One next word per prompt, with a status.

    ``prompts(prompt_id, text)``; result ``prompt_id, words, status, oov_word,
    next_word``. ``expect_n`` (optional) rejects a model of another context length.
    """
    _require_n(model, expect_n)
    # Materialised once: feeds the prediction and the final join.
    checked = cut_lineage(_check_prompts(model, normalize_prompts(prompts)))
    usable = checked.where(F.col("status").isNull()).select(
        "prompt_id", F.array_join("words", " ").alias("context"), F.lit(0).alias("step")
    )
    lookups = Lookups(model, mode)
    try:
        with _as_it_lies(lookups.spark):
            pred = cut_lineage(_next_words(usable, lookups, seed).select("prompt_id", "next_word"))
    finally:
        lookups.drop()
    out = checked.join(pred, "prompt_id", "left")
    status = F.coalesce(
        F.col("status"), F.when(F.col("next_word").isNull(), F.lit(STATUS_UNSEEN)).otherwise(F.lit(STATUS_OK))
    )
    return out.select("prompt_id", "words", status.alias("status"), "oov_word", "next_word")


def generate(
    model: NgramModel,
    prompts: DataFrame,
    nwords: int,
    mode: str = "top1",
    seed: int = 0,
    expect_n: int | None = None,
) -> DataFrame:
    """A10 + A11: generate up to ``nwords`` words per prompt, sliding the context.

    A driver loop of ``nwords`` steps; each step looks the distinct contexts of
    the still-active prompts up in the bucketed model table and hands the
    answers to the prompts (finished prompts leave the loop). Every
    step's rows ``(prompt_id, ctx, next_word)`` are written as partition
    ``step=s`` of a table in the shared checkpoint folder and the next step
    reads its active prompts back from it, so lineage and plan size stay
    constant however many steps run, and a lost executor only re-runs the
    current step.

    Result: ``prompt_id, words (prompt + generated), n_generated, status,
    oov_word, output`` where ``output`` is the space-joined text only when at
    least one word was generated (the reference prints nothing otherwise).
    """
    _require_n(model, expect_n)
    n = model.n
    spark = prompts.sparkSession
    # Materialised once: used to seed the loop and again for the final result.
    checked = cut_lineage(_check_prompts(model, normalize_prompts(prompts)))
    lookups = Lookups(model, mode)
    table = _scratch(spark, "generate")
    try:
        active = checked.where(F.col("status").isNull()).select("prompt_id", F.col("words").alias("ctx"))
        for step in range(nwords):
            queries = active.select("prompt_id", F.array_join("ctx", " ").alias("context"), F.lit(step).alias("step"), "ctx")
            res = _next_words(queries, lookups, seed).select("prompt_id", "ctx", "next_word")
            with _as_it_lies(spark):
                res.write.mode("overwrite").parquet(f"{table}/step={step}")
            done = spark.read.parquet(f"{table}/step={step}")
            tail = F.slice("ctx", 2, n - 1) if n > 1 else F.array().cast("array<string>")
            active = done.where(F.col("next_word").isNotNull()).select(
                "prompt_id", F.concat(tail, F.array("next_word")).alias("ctx")
            )
            if active.isEmpty():
                break
        if nwords > 0:
            steps = spark.read.parquet(table).select("prompt_id", F.col("step").cast("int").alias("step"), "next_word")
        else:
            steps = spark.createDataFrame([], "prompt_id bigint, step int, next_word string")
        # Per prompt at most nwords rows: bounded by the parameter, not the data.
        gathered = steps.groupBy("prompt_id").agg(
            F.transform(
                F.array_sort(F.collect_list(F.when(F.col("next_word").isNotNull(), F.struct("step", "next_word")))),
                lambda x: x["next_word"],
            ).alias("generated"),
            F.max(F.col("next_word").isNull().cast("int")).alias("halted"),
        )
        out = checked.join(gathered, "prompt_id", "left")
        generated = F.coalesce(F.col("generated"), F.array().cast("array<string>"))
        words = F.concat(F.col("words"), generated)
        status = F.coalesce(
            F.col("status"), F.when(F.col("halted") == 1, F.lit(STATUS_UNSEEN)), F.lit(STATUS_OK)
        )
        result = cut_lineage(out.select(
            "prompt_id",
            words.alias("words"),
            F.size(generated).alias("n_generated"),
            status.alias("status"),
            "oov_word",
            F.when(F.size(generated) > 0, F.array_join(words, " ")).alias("output"),
        ))
        return result
    finally:
        lookups.drop()
        folder = spark._jvm.org.apache.hadoop.fs.Path(table)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
