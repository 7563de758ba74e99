"""Quality rules as a bitmask ledger, in DataFrame functions only.

Every rule is evaluated once per document. The ledger keeps the measurements and
one bit per failed rule; a policy is a versioned set of rules, i.e. a mask, and
is applied to the ledger without reading a text again. Ablations add up bits.
Everything about one document is computed inside its row: no row is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD_BREAK = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"


@dataclass(frozen=True)
class Rule:
    """A document fails if ``fails`` (SQL over the measurements) is true; ``bit`` never changes its meaning."""

    bit: int
    name: str
    fails: str


#: Rules keep their bits for ever; a changed limit is a new rule with a new bit.
RULES = (
    Rule(0, "few_words", "n_words < 50"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "symbol_words", "10 * n_symbols > n_words"),
    Rule(3, "duplicate_lines", "n_lines >= 10 and 2 * n_dup_lines > n_lines"),
    Rule(4, "capital_letters", "100 * n_upper > 30 * n_letters"),
    Rule(5, "few_letters", "100 * n_letters < 60 * word_chars"),
    Rule(6, "long_words", "word_chars > 15 * n_words"),
    Rule(7, "short_words", "word_chars < 2 * n_words"),
)
BASE = ("few_words", "repeated_windows")


@dataclass(frozen=True)
class Policy:
    """A versioned set of rules; a document is kept if it fails none of them."""

    version: str
    rules: tuple[str, ...]

    def mask(self, rules: tuple[Rule, ...] = RULES) -> int:
        bits = {r.name: r.bit for r in rules}
        return sum(1 << bits[name] for name in set(self.rules))


POLICY_BASE = Policy("base", BASE)
POLICY_V1 = Policy("v1", (*BASE, "symbol_words", "duplicate_lines", "capital_letters", "few_letters", "long_words", "short_words"))


def measure(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add the measurements to ``docs``; a null or empty text has zero of each.

    n_repeat_words counts the words inside three-word windows that occur twice or more, the first occurrence
    included. Windows are compared by a 64-bit hash of their words, sorted only for documents that have a
    repeated one, so the work is n log n for any text. The columns that this adds replace columns of the same name.
    """
    zero = F.lit(0).cast("bigint")
    words = F.array_remove(F.split("_t", WORD_BREAK), "")
    lines = F.filter(F.split("_t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = docs.withColumn("_t", F.coalesce(F.col(text_col), F.lit("")))
    out = out.withColumns({"_w": words, "_l": lines})
    gram = F.expr("transform(slice(_w, 1, greatest(size(_w) - 2, 0)), (w, i) -> xxhash64(w, _w[i + 1], _w[i + 2]))")
    out = out.withColumns({"_g": gram, "n_words": F.size("_w").cast("bigint")})
    again = F.size(F.array_distinct("_g")) < F.size("_g")
    ranked = F.when(again, F.expr("sort_array(transform(_g, (g, i) -> struct(g, i)))"))
    out = out.withColumn("_r", ranked)
    same = "(i > 0 and _r[i - 1].g = x.g) or (i + 1 < size(_r) and _r[i + 1].g = x.g)"
    out = out.withColumn("_p", F.expr(f"sort_array(transform(filter(_r, (x, i) -> {same}), x -> x.i))"))
    # each repeated window covers three words, or up to where the next one begins
    covered = F.expr("aggregate(zip_with(_p, slice(_p, 2, greatest(size(_p), 1)), (a, b) -> least(3, coalesce(b - a, 3))), 0L, (s, x) -> s + x)")
    joined = F.concat_ws("", "_w")
    out = out.withColumns(
        {
            "word_chars": F.char_length(joined).cast("bigint"),
            "n_symbols": F.regexp_count("_t", F.lit(SYMBOLS)).cast("bigint"),
            "n_lines": F.size("_l").cast("bigint"),
            "n_dup_lines": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("bigint"),
            "n_repeat_words": F.coalesce(covered, zero),
            "n_upper": F.regexp_count("_t", F.lit(r"\p{Lu}")).cast("bigint"),
            "n_letters": F.regexp_count("_t", F.lit(r"\p{L}")).cast("bigint"),
        }
    )
    return out.drop("_t", "_w", "_l", "_g", "_r", "_p")


MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_letters")


def fail_bits(rules: tuple[Rule, ...] = RULES) -> Column:
    """Bit b is set where rule b fails, over the columns of ``measure``.

    The value depends on a row number in form only, which makes it count as non-deterministic: else the optimizer
    would move a filter on it below the measurements and write each of them out once for every place it is used.
    """
    bits: Column = F.when(F.monotonically_increasing_id() < 0, F.lit(1)).otherwise(F.lit(0)).cast("bigint")
    for r in rules:
        bits = bits.bitwiseOR(F.when(F.expr(r.fails), F.lit(1 << r.bit)).otherwise(F.lit(0)).cast("bigint"))
    return bits


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``id_col``, the measurements, and ``fail_bits`` (bit b set: rule b failed), one row per row of ``docs``.

    Null ids and repeated rows keep a row each; other columns are not read.
    """
    measured = measure(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")), "_text")
    return measured.select(F.col("_id").alias(id_col), *MEASURES, fail_bits(rules).alias("fail_bits"))


def failed(policy: Policy, rules: tuple[Rule, ...] = RULES) -> Column:
    """Bits of the policy's rules that a ledger row failed."""
    return F.col("fail_bits").bitwiseAND(F.lit(policy.mask(rules)).cast("bigint"))


def apply_policy(entries: DataFrame, policy: Policy, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Add ``kept`` and ``policy`` to a ledger."""
    return entries.withColumn("kept", failed(policy, rules) == 0).withColumn("policy", F.lit(policy.version))


def ablations(entries: DataFrame, policy: Policy, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per rule of the policy: documents that fail it, that fail only it (kept without the rule), and all that are kept.

    Documents are first added up by their masked bits, at most 2**rules groups, each of one row per task.
    """
    names = [r for r in rules if r.name in policy.rules]
    sums = entries.select(failed(policy, rules).alias("m")).groupBy("m").agg(F.count(F.lit(1)).alias("n"))
    one = F.explode(F.array(*(F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("bigint").alias("b")) for r in names)))
    each = sums.select("m", "n", one.alias("r")).select("m", "n", "r.rule", "r.b")
    count = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0)).alias
    return each.groupBy("rule").agg(
        count(F.col("m").bitwiseAND(F.col("b")) != 0)("n_failed"),
        count(F.col("m") == F.col("b"))("n_only"),
        count(F.col("m") == 0)("n_kept"),
        count((F.col("m") == 0) | (F.col("m") == F.col("b")))("n_kept_without"),
    )
