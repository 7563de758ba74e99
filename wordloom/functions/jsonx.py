"""Strict JSON handling for grading results (Column -> Column).

Spark's ``from_json`` alone accepts trailing junk and several non-standard
forms: it stops at the first bracket that closes the value. The text is
therefore parsed as the first element of ``[ text, sentinel ]``, where the
sentinel carries the md5 of the text: only if exactly these two elements come
out did the text hold one value and nothing else. The JSON options reject
single quotes, leading zeros and raw control characters, like Python's
``json.loads``. Duplicate keys resolve to the last value, as in Python.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import ustrip

# Code-fence marks stripped from a verdict, in this order.
FENCE_JSON = "```json"
FENCE = "```"

_STRICT = {
    "allowSingleQuotes": "false",
    "allowNumericLeadingZeros": "false",
    "allowUnquotedControlChars": "false",
    "allowUnquotedFieldNames": "false",
    "allowBackslashEscapingAnyCharacter": "false",
    "allowComments": "false",
}

#: Fields of the values that are parsed. Content is a variant: only a JSON string counts as content.
LINE_FIELDS = "response: struct<body: struct<choices: array<struct<message: struct<content: variant>>>>>"
VERDICT_FIELDS = "score: variant"

# A backslash that does not start a valid JSON escape is doubled.
_BAD_ESCAPE = r'\\(?!["\\/bfnrt])'
_DOUBLED = r"\\\\"

_SENTINEL = "__end_of_value__"
_STRING = r'"(?:[^"\\]|\\.)*+"'


def once(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn(value)`` with ``value`` computed once a row, however often ``fn`` names it."""
    return F.get(F.transform(F.array(value), fn), 0)


def strict_json(text: Column, fields: str) -> Column:
    """Parse one JSON object strictly; NULL unless ``text`` is exactly one value with these (optional) fields.

    Numbers written ``INF`` or with a plus sign, which Spark takes and Python does not, are rejected too. The text is
    computed and parsed once; callers that read several fields do so under :func:`once` too, since a filter or a second
    column that names the result would parse again.
    """

    def marked(t: Column) -> Column:
        mark = F.md5(t)
        whole = F.concat(F.lit("["), t, F.lit(f', {{"{_SENTINEL}": "'), mark, F.lit('"}]'))
        arr = F.from_json(whole, f"array<struct<{fields}, {_SENTINEL}: string>>", _STRICT)
        # one JSON value without these letters has none outside its strings either
        bare = F.when(t.contains("INF") | t.contains("+I"), F.regexp_replace(t, _STRING, "")).otherwise(F.lit(""))
        return F.struct(arr.alias("arr"), mark.alias("mark"), bare.rlike(r"INF|\+I").alias("odd"))

    def whole_value(x: Column) -> Column:
        one = (F.size(x["arr"]) == 2) & (F.get(x["arr"], 1)[_SENTINEL] == x["mark"]) & ~x["odd"]
        return F.when(one, F.get(x["arr"], 0))

    return once(once(text, marked), whole_value)


def string_of(value: Column) -> Column:
    """A variant's string; NULL for anything that is not a JSON string."""
    return F.when(F.schema_of_variant(value) == F.lit("STRING"), F.try_variant_get(value, "$", "string"))


def line_content(line: Column) -> Column:
    """``response.body.choices[0].message.content`` of a strictly parsed line, if it is a string."""
    parsed = strict_json(ustrip(line), LINE_FIELDS)
    return string_of(F.get(parsed["response"]["body"]["choices"], 0)["message"]["content"])


def line_is_json(line: Column) -> Column:
    return strict_json(ustrip(line), LINE_FIELDS).isNotNull()


def strip_fences(content: Column) -> Column:
    """two ordered steps, each testing the value left by the previous one."""
    c1 = F.when(F.startswith(content, F.lit(FENCE_JSON)), ustrip(F.replace(content, F.lit(FENCE_JSON), F.lit("")))).otherwise(content)
    return F.when(F.endswith(c1, F.lit(FENCE)), ustrip(F.replace(c1, F.lit(FENCE), F.lit("")))).otherwise(c1)


def repair_escapes(text: Column) -> Column:
    """double every backslash that does not begin a valid JSON escape."""
    return F.regexp_replace(text, _BAD_ESCAPE, _DOUBLED)


def clean_verdict(content: Column) -> Column:
    return repair_escapes(strip_fences(content))


def verdict(text: Column) -> Column:
    """F8: the parsed verdict object (NULL when not a single JSON object)."""
    return strict_json(text, VERDICT_FIELDS)


def score_is_true(parsed: Column) -> Column:
    """True only for the JSON boolean ``true`` (not ``"true"``, ``1`` or null)."""
    score = parsed["score"]
    return F.coalesce(
        (F.schema_of_variant(score) == F.lit("BOOLEAN")) & F.try_variant_get(score, "$", "boolean"),
        F.lit(False),
    )
