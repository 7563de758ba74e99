"""Text functions (Column -> Column), all JVM-side built-ins.

The character classes spell out Python's ``str`` regex classes explicitly:
Java's ``\\w`` is ASCII-only and ``\\b`` is defined differently, so neither is
used.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The character classes that define tokens.
# Python ``\w`` over str  == letters, numbers and underscore.
WORD_CLASS = r"\p{L}\p{N}_"
# Python ``\s`` over str  == separators plus the C0/C1 whitespace controls.
SPACE_CLASS = r"\p{Z}\x09-\x0d\x1c-\x1f\x85"

# Word tokens: maximal runs of word characters.
WORD_PATTERN = "[" + WORD_CLASS + "]+"
# BPE pre-tokens: words, plus one non-word non-space character that directly
# follows a word character. Neither begins at a space, and a run is never given
# back: both are said for speed.
PRETOKEN_PATTERN = "(?! )(?:" + WORD_PATTERN + "+|(?<=[" + WORD_CLASS + "])[^" + WORD_CLASS + SPACE_CLASS + "])"
# Leading/trailing whitespace in the same (Unicode) sense.
_STRIP_PATTERN = r"\A[" + SPACE_CLASS + r"]+|[" + SPACE_CLASS + r"]+\z"
_WS_SPLIT_PATTERN = "[" + SPACE_CLASS + "]+"

# Fixed value: end-of-word marker appended to every BPE word.
END_OF_WORD = "</w>"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def word_tokens(text) -> Column:
    """Lower-case, then every maximal run of word characters (F1)."""
    return F.regexp_extract_all(F.lower(_col(text)), F.lit(WORD_PATTERN), 0)


def bpe_pretokens(text) -> Column:
    """Lower-case, then words and word-attached punctuation characters (F2)."""
    return F.regexp_extract_all(F.lower(_col(text)), F.lit(PRETOKEN_PATTERN), 0)


def ustrip(text) -> Column:
    """Strip Unicode whitespace from both ends (Spark ``trim`` strips spaces only)."""
    return F.regexp_replace(_col(text), _STRIP_PATTERN, "")


def split_whitespace(text) -> Column:
    """``str.split()``: split on runs of whitespace, no empty pieces."""
    stripped = ustrip(text)
    return F.when(stripped == "", F.array().cast("array<string>")).otherwise(
        F.split(stripped, _WS_SPLIT_PATTERN)
    )


def word_symbols(word) -> Column:
    """A word as its characters followed by the end-of-word marker."""
    w = _col(word)
    return F.concat(F.split(w, ""), F.array(F.lit(END_OF_WORD)))


def wrap_symbols(symbols) -> Column:
    """Encode a symbol array as ``TAB sym SPACE`` repeated.

    Symbols never contain whitespace, so a merge of the pair (l, r) is the plain
    left-to-right ``replace('\\tl \\tr ', '\\tlr ')`` over this string: whole
    symbols only, non-overlapping, exactly like the reference's merge.
    """
    return F.concat(F.lit("\t"), F.array_join(_col(symbols), " \t"), F.lit(" "))


def unwrap_symbols(wrapped) -> Column:
    """Inverse of :func:`wrap_symbols`."""
    w = _col(wrapped)
    inner = F.substring(w, 2, F.length(w) - 2)
    return F.when(F.length(w) <= 2, F.array().cast("array<string>")).otherwise(F.split(inner, " \t", -1))
