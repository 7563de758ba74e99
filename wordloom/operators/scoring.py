"""Scoring of grading results (C3): lines -> outcome per line -> accuracy.

Every line gets exactly one outcome, so skipped rows are accounted for:

* ``bad_line``   -- the line is not one JSON value of the result shape
* ``no_content`` -- no ``response.body.choices[0].message.content`` string
* ``empty``      -- content is blank after stripping
* ``bad_json``   -- the cleaned verdict is not one JSON object
* ``correct``    -- verdict ``score`` is the JSON boolean ``true``
* ``incorrect``  -- any other parsed verdict (counted in the denominator)

The whole pass is a projection (no shuffle) until the final small aggregate,
so it streams through whole-stage codegen like the reference's line loop.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.jsonx import clean_verdict, line_content, line_is_json, score_is_true, verdict
from ..functions.text import ustrip

# Outcome names.
BAD_LINE = "bad_line"
NO_CONTENT = "no_content"
EMPTY = "empty"
BAD_JSON = "bad_json"
CORRECT = "correct"
INCORRECT = "incorrect"


def score_lines(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """Add ``content``, ``cleaned`` and ``outcome`` columns to a table of result lines."""
    line = F.col(line_col)
    df = lines.withColumn("_ok", line_is_json(line)).withColumn("content", line_content(line))
    blank = ustrip(F.col("content")) == ""
    df = df.withColumn("cleaned", F.when(~blank, clean_verdict(F.col("content"))))
    df = df.withColumn("_v", verdict(F.col("cleaned")))
    outcome = (
        F.when(~F.col("_ok"), F.lit(BAD_LINE))
        .when(F.col("content").isNull(), F.lit(NO_CONTENT))
        .when(blank, F.lit(EMPTY))
        .when(F.col("_v").isNull(), F.lit(BAD_JSON))
        .when(score_is_true(F.col("_v")), F.lit(CORRECT))
        .otherwise(F.lit(INCORRECT))
    )
    return df.withColumn("outcome", outcome).drop("_ok", "_v")


def outcome_counts(scored: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Rows per outcome (per group)."""
    keys = (by or []) + ["outcome"]
    return scored.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def percent_text(share: Column) -> Column:
    """A share as a percentage with two decimals; NULL stays NULL."""

    def text(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if pd.isna(x) else f"{x * 100:.2f}%")

    return F.pandas_udf(text, "string")(share)


def accuracy(scored: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Correct / parsed verdicts; NULL when nothing was parsed.

    ``percent`` is the two-decimal percentage text. Python rounds the binary
    value, which no built-in function does, so the few aggregated rows (one per
    group) are formatted there.
    """
    correct = F.count_if(F.col("outcome") == CORRECT)
    answered = F.count_if(F.col("outcome").isin(CORRECT, INCORRECT))
    grouped = scored.groupBy(*(by or []))
    out = grouped.agg(correct.alias("correct"), answered.alias("answered"))
    acc = F.try_divide(F.col("correct").cast("double"), F.col("answered").cast("double"))
    out = out.withColumn("accuracy", acc)
    return out.withColumn("percent", percent_text(F.col("accuracy")))
