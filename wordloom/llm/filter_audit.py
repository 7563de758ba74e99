"""Filter interaction audit: what each filter of a set removes, in every order of application.

Every document gets one bit per filter that it fails. Four filters look at the text alone; the last, E, fails a text
that a smaller doc_id has too, which is an existential self-join: texts that occur twice are found by their hash, and a
left-semi join on hash, exact text and smaller doc_id marks the rest. The marked ids are united with the other
failures and added up per document; then documents are counted per part and combination of bits. Any order of the
filters is an addition over these few counts, so texts are read for the bits only, never once per order.

Only copies are shuffled with their text. The other side of the join is one row per repeated text. A text that holds
a large share of all rows is cut into pieces: its row is copied under as many salts as it has pieces, and each copy of
the text takes one salt. Texts that are that frequent are fewer than the bound below, so that their list is broadcast.

Defined results:

* a null text is empty: it fails A (no words) and no filter that needs a character; 100 * 0 < 80 * 0 is false, so it
  passes B; equal null and empty texts are copies of each other for E;
* a null doc_id is smaller than none and none is smaller than it, so it neither fails E nor makes others fail;
* rows that repeat a doc_id count as documents of their own; among equal ids none is smaller;
* a document without label is neither good nor toxic; labels that repeat a doc_id count as good (toxic) if one is;
* a null part is the empty text; no documents give no rows; other columns of the input are not read.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.llm import common as C

#: Failure conditions over ``_t`` (the text, null: empty) and ``_w`` (its words), by letter.
TEXT_FILTERS = {
    "A": "size(_w) < 100",
    "B": "100 * size(array_distinct(_w)) < 80 * size(_w)",
    "C": "100 * regexp_count(_t, '[A-Z]') > 10 * char_length(_t)",
    "D": "_t rlike '[#$%&*|]'",
}
COPY_FILTER = "E"
WORD_BREAK = r"[\x20\x09-\x0D]+"
#: A text is cut into pieces if it holds more than one part in PIECES of all rows; fewer than PIECES texts can.
PIECES = 1000
#: Hashes that occur twice are broadcast up to this number (16 MB); beyond it they are joined by a shuffle.
BROADCAST_ROWS = 500_000


def _measured(docs: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), text.alias("_t"), F.xxhash64(text).alias("hash"))


def copies(rows: DataFrame, scratch: C.Scratch) -> DataFrame:
    """The ``rows`` (``doc_id, part, _t, hash``) whose text a smaller doc_id has too: ``doc_id, part, hash``.

    Reads tables ``met`` and ``again`` of ``scratch``, which it writes: hashes that occur twice, and the rows that
    have one.
    """
    rows = rows.where("doc_id is not null")
    met = scratch.table(rows.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "met")
    wanted = met.select("hash")
    wanted = F.broadcast(wanted) if met.count() <= BROADCAST_ROWS else wanted
    pieces = F.ceil(F.col("n") * PIECES / F.lit(max(rows.count(), 1))).cast("int")
    hot = F.broadcast(met.select("hash", pieces.alias("pieces")).where("pieces > 1"))  # fewer than PIECES rows
    again = scratch.table(rows.join(wanted, "hash", "left_semi"), "again")
    again = again.join(hot, "hash", "left").withColumn("pieces", F.coalesce("pieces", F.lit(1)))
    first = again.groupBy("hash", "_t", "pieces").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    first = first.select(F.col("hash").alias("_h"), F.col("_t").alias("_same"), "first", F.explode(F.sequence(F.lit(1), F.col("pieces"))).alias("_piece"))
    dealt = again.withColumn("piece", 1 + F.pmod(F.xxhash64("doc_id"), F.col("pieces")).cast("int"))
    same = (F.col("hash") == F.col("_h")) & (F.col("piece") == F.col("_piece")) & (F.col("_t") == F.col("_same")) & (F.col("first") < F.col("doc_id"))
    return dealt.join(first, same, "left_semi").select("doc_id", "part", "hash")


def failures(docs: DataFrame, scratch: C.Scratch, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """``doc_id, part, bits, n``: documents (n of them, equal rows together) with one bit per failed filter, A lowest."""
    rows = _measured(docs, id_col, text_col, part_col)
    bits = " + ".join(f"if({fails}, {1 << i}, 0)" for i, fails in enumerate(TEXT_FILTERS.values()))
    words = F.array_remove(F.split("_t", WORD_BREAK), "")
    own = rows.withColumn("_w", words).select("doc_id", "part", "hash", F.expr(bits).cast("int").alias("bits"), F.lit(1).cast("bigint").alias("n"))
    marked = copies(rows, scratch).select("doc_id", "part", "hash", F.lit(1 << len(TEXT_FILTERS)).alias("bits"), F.lit(0).cast("bigint").alias("n"))
    one = own.unionByName(marked).groupBy("doc_id", "part", "hash")
    return one.agg(F.bit_or("bits").alias("bits"), F.sum("n").alias("n")).drop("hash")


def combinations(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, bits, n, good, toxic``: numbers of documents by combination of failed filters."""
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max(F.expr("int(quality <=> 1)")).alias("_good"), F.max(F.expr("int(toxic <=> 1)")).alias("_toxic"))
    named = failed.where("doc_id is not null").join(marks, "doc_id", "left")
    nameless = failed.where("doc_id is null").withColumns({"_good": F.lit(0), "_toxic": F.lit(0)})
    those = lambda mark: F.sum(F.col("n") * F.coalesce(mark, F.lit(0))).alias(mark.strip("_"))
    return named.unionByName(nameless).groupBy("part", "bits").agg(F.sum("n").alias("n"), those("_good"), those("_toxic"))


def _steps() -> list[tuple[str, int, int, int]]:
    """(filter_order, step, bit of its filter, bits of those before it) of every step of every order."""
    letters = [*TEXT_FILTERS, COPY_FILTER]
    bit = {c: 1 << i for i, c in enumerate(letters)}
    return [("".join(o), i + 1, bit[c], sum(bit[x] for x in o[:i])) for o in permutations(letters) for i, c in enumerate(o)]


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """One row per part, order of the filters and step.

    ``kept`` pass this step's filter and those before it; ``removed`` fail it and pass those before; ``redundant`` fail
    it but were removed before; ``unique_fails`` fail it only; ``good_lost`` and ``toxic_lost`` are removed here and
    labelled so; ``shapley`` is what the filter removes in all orders together, at whatever step.
    """
    scratch = C.Scratch(docs.sparkSession, "audit")
    failed = scratch.table(failures(docs, scratch, id_col, text_col, part_col), "failed")  # numbers, no texts
    combos = scratch.table(combinations(failed, labels), "combinations")
    scratch.drop("met", "again", "failed")
    steps = F.array(*(F.struct(*(F.lit(v).alias(k) for k, v in zip(("filter_order", "step", "_bit", "_before"), row))) for row in _steps()))
    # a part has 32 combinations at most: kept as one array, over which every step is a sum
    parts = combos.groupBy("part").agg(F.collect_list(F.struct("bits", "n", "good", "toxic")).alias("_c"))
    each = parts.select("part", "_c", F.inline(steps))

    def total(what: str, where: str) -> Column:
        return F.expr(f"aggregate(filter(_c, x -> {where}), 0L, (s, x) -> s + x.{what})")

    here = "(x.bits & _bit) != 0 and (x.bits & _before) = 0"
    out = each.select(
        "part",
        "filter_order",
        "step",
        "_bit",
        total("n", "(x.bits & (_bit | _before)) = 0").alias("kept"),
        total("n", here).alias("removed"),
        total("n", "(x.bits & _bit) != 0 and (x.bits & _before) != 0").alias("redundant"),
        total("n", "x.bits = _bit").alias("unique_fails"),
        total("good", here).alias("good_lost"),
        total("toxic", here).alias("toxic_lost"),
    )
    shapley = out.groupBy("part", "_bit").agg(F.sum("removed").alias("shapley"))
    return out.join(shapley, ["part", "_bit"]).drop("_bit")
