"""Inputs derived from the driver tables.

Every registered query reads the given parquet tables (or data Spark derives
from them), so its work grows with the tables. The derivations here are
mirrored one-for-one by the SQL in :mod:`wordloom.plans.oracle`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import split_whitespace
from ..session import ensure_parallel, tasks_for

# Prompt ids: item_id * PROMPT_STRIDE is the whole benchmark text as one prompt;
# item_id * PROMPT_STRIDE + pos + 1 is the n-word window starting at word ``pos``.
PROMPT_STRIDE = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Bytes of the stored documents that a counting task takes at most where the scan gives fewer tasks. It counts some
# millions of words at once, so its memory does not depend on this.
COUNT_BYTES = 32 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus scan, fanned out when the file gives fewer splits than the
    cluster has cores (CPU-heavy tokenisation follows)."""
    return ensure_parallel(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", spark.sparkContext.defaultParallelism)


def counted_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus scan where n-grams are counted: a task takes ``COUNT_BYTES`` or, where the scan is cut finer, less."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ensure_parallel(docs, "doc_id", count_tasks(spark, sf_dir))


def count_tasks(spark: SparkSession, sf_dir: str) -> int:
    return tasks_for(spark, f"{sf_dir}/documents.parquet", COUNT_BYTES)


def prompts(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    """Prompt table from ``benchmark``: every window of ``n`` whitespace-separated
    words of every item (raw case and punctuation, so OOV and unseen contexts
    occur naturally), plus each whole item text (wrong arity unless it has
    exactly ``n`` words)."""
    bench = table(spark, sf_dir, "benchmark").select("item_id", "text")
    ws = split_whitespace(F.col("text"))
    whole = bench.select((F.col("item_id") * PROMPT_STRIDE).alias("prompt_id"), "text")
    windows = (
        bench.select("item_id", ws.alias("ws"))
        .where(F.size("ws") >= n)
        .select(
            "item_id",
            F.inline(
                F.transform(
                    F.sequence(F.lit(0), F.size("ws") - n),
                    lambda p: F.struct(p.alias("pos"), F.array_join(F.slice("ws", p + 1, n), " ").alias("text")),
                )
            ),
        )
        .select((F.col("item_id") * PROMPT_STRIDE + F.col("pos") + 1).alias("prompt_id"), "text")
    )
    return whole.unionByName(windows)


# ---------------------------------------------------------------------------
# Grading results (input of the scoring job)
# ---------------------------------------------------------------------------

# Number of verdict / line shapes; shape = doc_id % GRADE_SHAPES (every row kept).
GRADE_SHAPES = 17
# The two graded "models" and the label each one's verdict follows.
GRADE_MODELS = (("model_a", "quality"), ("model_b", "toxic"))


def _json_string(c):
    """A JSON string literal of ``c`` (``to_json`` needs a container; strip the brackets)."""
    arr = F.to_json(F.array(c))
    return F.substring(arr, 2, F.length(arr) - 2)


def grading_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch-result lines, one per (label row, model): ``model, line_no, line``.

    The verdict text takes one of the shapes the scorer must handle (plain,
    fenced, bad escapes, string score, blank, unparsable, missing score ...),
    the score follows the label. Some lines are not JSON, lack the response or
    have no choices.
    """
    labels = table(spark, sf_dir, "labels")
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    base = labels.join(docs, "doc_id")
    parts = []
    for k, (model, label) in enumerate(GRADE_MODELS):
        parts.append(
            base.select(
                F.lit(model).alias("model"),
                (F.col("doc_id") * len(GRADE_MODELS) + k).alias("line_no"),
                "doc_id",
                F.when(F.col(label) == 1, F.lit("true")).otherwise(F.lit("false")).alias("b"),
                F.concat(F.lit("doc "), F.col("doc_id").cast("string"), F.lit(" ("), F.col("lang"), F.lit(")")).alias("e"),
            )
        )
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    b, e = F.col("b"), F.col("e")
    plain = F.concat(F.lit('{"explanation": "'), e, F.lit('", "score": '), b, F.lit("}"))
    shape = F.col("doc_id") % GRADE_SHAPES
    content = (
        F.when(shape == 0, plain)
        .when(shape == 1, F.concat(F.lit("```json\n"), plain, F.lit("\n```")))
        .when(shape == 2, F.concat(F.lit("```\n"), plain, F.lit("\n```")))
        .when(shape == 3, F.concat(F.lit('{"explanation": "see \\q in '), e, F.lit('", "score": '), b, F.lit("}")))
        .when(shape == 4, F.concat(F.lit('{"explanation": "'), e, F.lit('", "score": "'), b, F.lit('"}')))
        .when(shape == 5, F.lit(" \t "))
        .when(shape == 9, F.concat(F.lit('{"score": '), b, F.lit("} trailing")))
        .when(shape == 10, F.concat(F.lit("{'score': "), b, F.lit("}")))
        .when(shape == 11, F.concat(F.lit('{"explanation": "'), e, F.lit('"}')))
        .when(shape == 12, F.concat(F.lit('```json\n{"score": '), b, F.lit("}\n```\n")))
        .when(shape == 13, F.concat(F.lit('{"score": '), b, F.lit("}]")))
        .when(shape == 14, F.concat(F.lit('{"score": '), b, F.lit("}] junk")))
        .otherwise(plain)
    )
    cid = F.concat(F.lit('{"custom_id": "doc-'), F.col("doc_id").cast("string"), F.lit('"'))
    good = F.concat(
        cid,
        F.lit(', "response": {"status_code": 200, "body": {"choices": [{"message": {"role": "assistant", "content": '),
        F.when(shape == 16, F.concat(F.lit('{"score": '), b, F.lit("}"))).otherwise(_json_string(content)),
        F.lit("}}]}}}"),
        F.when(shape == 15, F.lit("]")).otherwise(F.lit("")),
    )
    line = (
        F.when(shape == 6, F.concat(F.lit("not json "), F.col("doc_id").cast("string")))
        .when(shape == 7, F.concat(cid, F.lit(', "error": {"message": "failed"}}')))
        .when(shape == 8, F.concat(cid, F.lit(', "response": {"status_code": 200, "body": {"choices": []}}}')))
        .otherwise(good)
    )
    return rows.select("model", "line_no", line.alias("line"))


# ---------------------------------------------------------------------------
# QA files and responses (inputs of the request / grading jobs)
# ---------------------------------------------------------------------------

# How a document becomes a QA file.
SENTENCE_PATTERN = r"[^.!?]+[.!?]*"
ANSWER_TEXT = (("quality", "Yes", "No"), ("toxic", "Toxic", "Clean"))


def qa_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One QA file per document: a single article whose paragraphs are the
    document's lines and whose questions are each line's sentences. Labelled
    documents answer every question with two answers; unlabelled ones have
    none (unanswerable). Built per row, no grouping."""
    from ..functions.text import ustrip

    docs = ensure_parallel(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", spark.sparkContext.defaultParallelism)
    labels = table(spark, sf_dir, "labels")
    src = docs.join(labels, "doc_id", "left")
    answers = F.when(
        F.col("quality").isNotNull(),
        F.array(*[
            F.struct(F.when(F.col(lab) == 1, F.lit(yes)).otherwise(F.lit(no)).alias("text"))
            for lab, yes, no in ANSWER_TEXT
        ]),
    ).otherwise(F.array().cast("array<struct<text:string>>"))
    paragraphs = F.transform(
        F.split(F.col("text"), "\n"),
        lambda par: F.struct(
            F.transform(
                F.filter(
                    F.transform(F.regexp_extract_all(par, F.lit(SENTENCE_PATTERN), 0), lambda s: ustrip(s)),
                    lambda s: s != "",
                ),
                lambda s: F.struct(s.alias("question"), answers.alias("answers")),
            ).alias("qas")
        ),
    )
    return src.select(F.col("doc_id").alias("file_id"), F.array(F.struct(paragraphs.alias("paragraphs"))).alias("data"))


def conversation_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user turn and the assistant turn right after it: ``conv_id, turn, question, response``."""
    conv = table(spark, sf_dir, "conversations")
    u = conv.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("question"))
    a = conv.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("response")
    )
    return u.join(a, ["conv_id", "turn"])


# What the two models answer, by question number; every GAP-th answer of the first model is missing.
RESPONSES = ("Yes", "No", "Toxic", "I do not know.")
GAP = 11


def responses(numbered: DataFrame) -> DataFrame:
    """One response for every numbered question: ``idx, question, response``."""
    answer = F.element_at(F.array(*map(F.lit, RESPONSES)), (F.col("idx") % len(RESPONSES) + 1).cast("int"))
    return numbered.select("idx", "question", answer.alias("response"))


def answer_batch_lines(numbered: DataFrame) -> DataFrame:
    """Batch-result lines of the first model, with gaps: ``custom_id`` is ``"{idx}. {question}"``."""
    pairs = responses(numbered).where(F.col("idx") % GAP != 0)
    cid = F.concat(F.col("idx").cast("string"), F.lit(". "), F.col("question"))
    rec = F.struct(
        cid.alias("custom_id"),
        F.struct(
            F.struct(
                F.array(F.struct(F.struct(F.lit("assistant").alias("role"), F.col("response").alias("content")).alias("message"))).alias("choices")
            ).alias("body")
        ).alias("response"),
    )
    return pairs.select(F.to_json(rec).alias("line"))
