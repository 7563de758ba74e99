"""Question-answering evaluation jobs (C1, C2) as DataFrame operators.

Order is data: every question carries ``(file_id, a, p, q)`` -- file, article,
paragraph and question positions -- and numbering follows that key. The
running index ``idx`` (from 1) is assigned *before* unanswerable questions are
dropped, so ids keep their gaps.
"""

from __future__ import annotations

import string
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.jsonx import LINE_FIELDS, once, strict_json, string_of
from ..functions.text import ustrip
from .ordering import dense_index, prefix_sum

# ---------------------------------------------------------------------------
# Request constants and prompt templates (must equal the
# reference's text for identical request files).
# ---------------------------------------------------------------------------
REQUEST_METHOD = "POST"
REQUEST_URL = "/v1/chat/completions"
ANSWER_MODEL = "gpt-4o-mini"
GRADER_MODEL = "gpt-4o"
TEMPERATURE = 0.2
QUESTION_CAP = 5000

ANSWER_SYSTEM = (
    "You are an intelligent AI Model. Answer the question, and make sure that your response "
    "is short and concise. Prioritize accuracy above all else."
)
ANSWER_USER = "Answer the question concisely and factually. Prioritize accuracy above all else: {question}"
RAW_USER = "{question}"

GRADE_SYSTEM_STRICT = (
    "You are a teacher tasked with determining whether a student's answer to a question was "
    "correct, based on a set of possible correct answers. You must only use the provided possible "
    "correct answers to determine if the student's response was correct."
)
GRADE_SYSTEM_LENIENT = (
    "You are a teacher tasked with determining whether a student's answer to a question was "
    "correct, based on a set of possible correct answers."
)
GRADE_USER = """Question: {question})
    Student's Response: {student_response}
    Possible Correct Answers: {correct_answers}
    Your response should be a valid JSON in the following format:
    {{
    "explanation": "A short explanation of why the student's answer was correct or incorrect.",
    "score": true or false (boolean)
    }}"""

QA_SCHEMA = (
    "data array<struct<paragraphs: array<struct<qas: array<struct<question: string, "
    "answers: array<struct<text: string>>>>>>>>"
)

# Custom ids look like "12. question"; the leading number is the index.
_ID_INDEX = r"^(\d+)\. "


# ---------------------------------------------------------------------------
# Template fill and request rows
# ---------------------------------------------------------------------------

def fill_template(template: str, **values: Column) -> Column:
    """``str.format`` in one pass: literal parts and placeholder values are
    concatenated, so braces or placeholder names inside the data are never
    expanded again (chained ``replace`` would)."""
    parts: list[Column] = []
    for literal, field, _spec, _conv in string.Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if field is not None:
            parts.append(values[field].cast("string"))
    return F.concat(*parts) if parts else F.lit("")


def chat_request(custom_id: Column, model: str, system: str, user: Column, temperature: float | None) -> Column:
    """One batch request as a struct; ``to_json`` omits a null temperature."""
    body = F.struct(
        F.lit(model).alias("model"),
        (F.lit(temperature).cast("double") if temperature is not None else F.lit(None).cast("double")).alias("temperature"),
        F.array(
            F.struct(F.lit("system").alias("role"), F.lit(system).alias("content")),
            F.struct(F.lit("user").alias("role"), user.alias("content")),
        ).alias("messages"),
    )
    return F.struct(
        custom_id.alias("custom_id"),
        F.lit(REQUEST_METHOD).alias("method"),
        F.lit(REQUEST_URL).alias("url"),
        body.alias("body"),
    )


def request_id(idx: Column, question: Column) -> Column:
    """``"{idx}. {question}"``."""
    return F.concat(idx.cast("string"), F.lit(". "), question)


def id_index(custom_id: Column) -> Column:
    """The index at the front of a custom id (NULL when there is none)."""
    s = F.regexp_extract(custom_id, _ID_INDEX, 1)
    return F.when(s != "", s.cast("bigint"))


# ---------------------------------------------------------------------------
# Flatten, gold answers, cap, numbering
# ---------------------------------------------------------------------------

def flatten_qa(files: DataFrame, file_col: str = "file_id") -> DataFrame:
    """One row per question: ``file_id, a, p, q, question, answers``.

    Three ``posexplode`` (not ``_outer``), so empty articles, paragraphs and
    question lists give no rows. ``files`` has one row per QA file (or shard
    of one) with the ``data`` column of :data:`QA_SCHEMA`.
    """
    art = files.select(F.col(file_col).alias("file_id"), F.posexplode("data").alias("a", "article"))
    par = art.select("file_id", "a", F.posexplode("article.paragraphs").alias("p", "paragraph"))
    qas = par.select("file_id", "a", "p", F.posexplode("paragraph.qas").alias("q", "qa"))
    return qas.select("file_id", "a", "p", "q", F.col("qa.question").alias("question"), F.col("qa.answers").alias("answers"))


def flatten_numbered(files: DataFrame, file_col: str = "file_id") -> DataFrame:
    """P1 + W7: the questions of :func:`flatten_qa` with ``idx`` from 1 in document order.

    Only (file, number of questions) is ordered: a running sum over files gives
    each file's offset, and a question's index is the offset plus its place in
    the file. The nested files are joined with the offsets once, before they
    are flattened; question texts are neither sorted nor range-sampled.
    ``file_col`` identifies files.
    """
    paragraphs = lambda art: art["paragraphs"]
    count = F.aggregate(
        F.flatten(F.transform("data", paragraphs)), F.lit(0).cast("bigint"), lambda n, p: n + F.greatest(F.size(p["qas"]), F.lit(0))
    )
    sizes = files.select(F.col(file_col).alias("file_id"), F.coalesce(count, F.lit(0).cast("bigint")).alias("n"))
    offsets = prefix_sum(sizes, ["file_id"], "n", "before")
    rows = files.select(F.col(file_col).alias("file_id"), "data").join(offsets.select("file_id", "before"), "file_id")
    per_file = F.flatten(F.transform("data", lambda art, a: F.flatten(F.transform(
        art["paragraphs"], lambda par, p: F.transform(
            par["qas"], lambda qa, q: F.struct(a.alias("a"), p.alias("p"), q.alias("q"), qa["question"].alias("question"), qa["answers"].alias("answers"))
        )
    ))))
    flat = rows.select("file_id", "before", F.posexplode(per_file).alias("pos", "x"))
    return flat.select((F.col("before") + F.col("pos") + 1).alias("idx"), "file_id", "x.*")


def gold_of(numbered: DataFrame) -> DataFrame:
    """``idx, question, gold`` of numbered questions (gold NULL when unanswerable)."""
    return numbered.select("idx", "question", gold_answer(F.col("answers")).alias("gold"))


def gold_answer(answers: Column) -> Column:
    """First answer's text, lower-cased; NULL when there is no answer."""
    return F.lower(F.get(answers, 0)["text"])


def number_questions(questions: DataFrame, limit: int | None = None) -> DataFrame:
    """W6 + W7: number the questions from 1 in document order and keep the
    first ``limit``; the numbering is distributed (:func:`dense_index`) with or
    without a limit."""
    numbered = dense_index(questions, ["file_id", "a", "p", "q"], "idx")
    return numbered if limit is None else numbered.where(F.col("idx") <= limit)


def gold_table(questions: DataFrame, limit: int | None = None) -> DataFrame:
    """``idx, question, gold`` for every question (gold NULL when unanswerable)."""
    return gold_of(number_questions(questions, limit))


def answerable(gold: DataFrame) -> DataFrame:
    """Drop unanswerable questions after numbering (ids keep gaps)."""
    return gold.where(F.col("gold").isNotNull())


# ---------------------------------------------------------------------------
# Answer requests
# ---------------------------------------------------------------------------

def answer_requests(numbered: DataFrame, template: str = ANSWER_USER, system: str = ANSWER_SYSTEM,
                    model: str = ANSWER_MODEL, temperature: float | None = TEMPERATURE) -> DataFrame:
    """``idx, custom_id, request`` (struct) and ``line`` (JSON text)."""
    cid = request_id(F.col("idx"), F.col("question"))
    user = fill_template(template, question=F.col("question"))
    req = chat_request(cid, model, system, user, temperature)
    return numbered.select("idx", cid.alias("custom_id"), req.alias("request")).withColumn(
        "line", F.to_json("request")
    )


def raw_answer_requests(numbered: DataFrame, model: str = ANSWER_MODEL) -> DataFrame:
    """The user message is the question itself and no temperature is sent."""
    return answer_requests(numbered, RAW_USER, ANSWER_SYSTEM, model, None)


# ---------------------------------------------------------------------------
# Responses
# ---------------------------------------------------------------------------

def batch_responses(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """P9 for answer batches: ``custom_id, idx, response`` from result lines.

    Lines that are not JSON or lack the content are dropped (the reference
    raises on them while building grading requests). A generator gives the
    rows that stay: filters on its columns are not pushed below it, so that a
    line is parsed once.
    """
    def fields(parsed: Column) -> Column:
        content = F.get(parsed["response"]["body"]["choices"], 0)["message"]["content"]
        return F.struct(parsed["custom_id"].alias("custom_id"), once(content, string_of).alias("response"))

    parsed = strict_json(ustrip(F.col(line_col)), f"custom_id: string, {LINE_FIELDS}")
    each = F.transform(F.array(parsed), fields)
    kept = F.filter(each, lambda x: x["custom_id"].isNotNull() & x["response"].isNotNull())
    return lines.select(F.inline(kept)).withColumn("idx", id_index(F.col("custom_id")))


def response_rows(df: DataFrame) -> DataFrame:
    """P10: ``question, response, input_tokens, output_tokens``."""
    return df.select(
        F.col("question").cast("string"), F.col("response").cast("string"),
        F.col("input_tokens").cast("bigint"), F.col("output_tokens").cast("bigint"),
    )


ANSWER_OUTPUT = "question string, response string, input_tokens bigint, output_tokens bigint"


def answer_with(questions: DataFrame, fn: Callable[[pd.Series], pd.DataFrame]) -> DataFrame:
    """Apply a caller-supplied model function to every question.

    ``fn`` gets a pandas Series of questions (one Arrow batch) and returns a
    frame with ``response, input_tokens, output_tokens`` in the same order.
    Runs in ``mapInPandas``: one Python worker per partition, batches of rows,
    no per-row round trip. Extra key columns of ``questions`` are kept. A frame
    with another number of rows than questions is an error.
    """
    keys = [c for c in questions.columns if c != "question"]
    key_types = {f.name: f.dataType.simpleString() for f in questions.schema.fields if f.name in keys}
    schema = ", ".join([f"{k} {key_types[k]}" for k in keys] + [ANSWER_OUTPUT])

    def run(batches):
        for pdf in batches:
            res = fn(pdf["question"]).reset_index(drop=True)
            if len(res) != len(pdf):
                raise ValueError(f"the answer function returned {len(res)} rows for {len(pdf)} questions")
            out = pdf[keys + ["question"]].reset_index(drop=True)
            out["response"] = res["response"].astype(object)
            out["input_tokens"] = res["input_tokens"].astype("int64")
            out["output_tokens"] = res["output_tokens"].astype("int64")
            yield out

    return questions.mapInPandas(run, schema)


# ---------------------------------------------------------------------------
# Alignment of gold answers and responses
# ---------------------------------------------------------------------------

def align_by_id(gold: DataFrame, responses: DataFrame) -> DataFrame:
    """J1 by id: inner join on the index parsed from ``custom_id``.

    ``responses`` has ``idx, question, response`` where ``question`` is what
    the grader is shown (for batch results, the earlier custom id).
    """
    return gold.select("idx", "gold").join(responses.select("idx", "question", "response"), "idx")


def align_by_position(gold: DataFrame, responses: DataFrame, order: list[str]) -> DataFrame:
    """J1 by position: number responses in file order, then join on the index
    (the inner join truncates to the shorter side, like ``zip``)."""
    numbered = dense_index(responses, order, "idx")
    return gold.select("idx", "gold").join(numbered.select("idx", "question", "response"), "idx")


# ---------------------------------------------------------------------------
# Grading requests
# ---------------------------------------------------------------------------

def grade_requests(aligned: DataFrame, strict: bool = True, model: str = GRADER_MODEL,
                   temperature: float | None = TEMPERATURE) -> DataFrame:
    """P3 + P7 / P8: one grading request per aligned, answerable question.

    The custom id is ``"{idx}. {question}"`` with the *response's* question,
    so batch results (whose question is already ``"{idx}. ..."``) come out
    doubly numbered exactly as in the reference.
    """
    rows = answerable(aligned)
    user = fill_template(
        GRADE_USER,
        question=F.col("question"),
        student_response=F.col("response"),
        correct_answers=F.col("gold"),
    )
    system = GRADE_SYSTEM_STRICT if strict else GRADE_SYSTEM_LENIENT
    cid = request_id(F.col("idx"), F.col("question"))
    req = chat_request(cid, model, system, user, temperature)
    return rows.select("idx", cid.alias("custom_id"), req.alias("request")).withColumn("line", F.to_json("request"))
