"""Summarise the physical plans of the headline queries into PLANS.md.

Usage: python scripts/plan_report.py [SF_DIR]
For each query: scans with their read schema and pushed filters, shuffles,
join strategies, aggregate kinds and windows, taken from ``explain("formatted")``.
Iterative queries show the plan of their final DataFrame (earlier rounds are
checkpointed and appear as ``Scan ExistingRDD``).
"""

from __future__ import annotations

import collections
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from wordloom.plans import catalog  # noqa: E402
from wordloom.session import local_session  # noqa: E402

OPERATORS = [
    "Exchange", "BroadcastExchange", "HashAggregate", "SortAggregate", "ObjectHashAggregate",
    "SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct",
    "Window", "Generate", "TakeOrderedAndProject", "MapInPandas", "Scan parquet", "Scan ExistingRDD",
]


def explain(spark, df) -> str:
    return spark.sparkContext._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def summarise(text: str) -> tuple[collections.Counter, list[str]]:
    tree = text.split("\n\n")[0]
    counts = collections.Counter()
    for line in tree.splitlines():
        for op in OPERATORS:
            if re.search(r"(^|[\s+\-:])" + re.escape(op) + r"\b", line) and not (op == "Exchange" and "BroadcastExchange" in line):
                counts[op] += 1
    scans = []
    for block in text.split("\n\n"):
        if block.lstrip().startswith("(") and "Scan parquet" in block.splitlines()[0]:
            schema = re.search(r"ReadSchema: (.*)", block)
            pushed = re.search(r"PushedFilters: (.*)", block)
            loc = re.search(r"Location: \w+ \[?([^\]\n]*)", block)
            scans.append(
                f"`{os.path.basename(loc.group(1)) if loc else '?'}` ReadSchema `{schema.group(1) if schema else '?'}`"
                + (f", PushedFilters `{pushed.group(1)}`" if pushed and pushed.group(1) != "[]" else "")
            )
    return counts, scans


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    out = ["# PLANS", "", f"Physical plans of the headline queries at `{sf}` (generated by `scripts/plan_report.py`).", ""]
    for name in HEADLINE:
        df = catalog.REGISTRY[name](spark, sf)
        counts, scans = summarise(explain(spark, df))
        ops = ", ".join(f"{k} ×{v}" for k, v in counts.items() if v)
        out.append(f"## {name}")
        out.append("")
        out.append(f"* operators: {ops}")
        for s in scans:
            out.append(f"* scan: {s}")
        out.append("")
    out.append("## Inner passes (before their checkpoints)")
    out.append("")
    from wordloom.operators import bpe, ngram
    from wordloom.plans import inputs

    docs = inputs.documents(spark, sf)
    model = ngram.train_ngram(docs, 1)
    inner = {
        "n-gram counts": ngram.train_ngram(docs, 2).counts,
        "n-gram top-1 from the model": model.top1(),
        "BPE word types": bpe.word_types(docs),
        "BPE initial pair statistics": bpe.type_pairs(bpe.with_symbols(bpe.word_types(docs))).groupBy("l", "r").sum("w"),
        "sampling step (bucketed lookups)": ngram._next_words(
            model.counts.select("context").distinct().selectExpr("xxhash64(context) AS prompt_id", "context", "0 AS step"),
            ngram.Lookups(model, "sample"),
            7,
        ),
    }
    for label, df in inner.items():
        counts, scans = summarise(explain(spark, df))
        out.append(f"### {label}")
        out.append("")
        out.append("* operators: " + ", ".join(f"{k} ×{v}" for k, v in counts.items() if v))
        for s_ in scans:
            out.append(f"* scan: {s_}")
        out.append("")
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(out))
    print("\n".join(out))


if __name__ == "__main__":
    main()
