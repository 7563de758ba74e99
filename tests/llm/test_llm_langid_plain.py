"""Language models against a plain version: counts in dictionaries, probabilities by recursion."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from math import log2

import numpy as np
import pyarrow as pa
import pytest

from wordloom.llm import langid
from wordloom.llm.lm import discounts

SF = "/root/testdata/sf0.001"
N = langid.ORDER


class Plain:
    """Interpolated modified Kneser-Ney over the letters of words, by the definition."""

    def __init__(self, words: Counter) -> None:
        counts = [Counter() for _ in range(N)]
        for w, n in words.items():
            for i, x in enumerate(w + "$"):
                counts[N - 1][("^" * (N - 1) + w)[i : i + N - 1] + x] += n
        for k in range(N - 2, -1, -1):
            counts[k] = Counter(g[1:] for g in counts[k + 1])
        self.levels = []
        for c in counts:
            sizes = Counter(c.values())
            d = (0.0, *discounts(*(sizes[i] for i in (1, 2, 3, 4))))
            total, left = defaultdict(int), defaultdict(float)
            for g, n in c.items():
                total[g[:-1]] += n
                left[g[:-1]] += d[min(n, 3)]
            self.levels.append((c, d, total, left))
        self.alphabet = len(counts[0])

    def prob(self, context: str, x: str) -> float:
        p = 1 / (self.alphabet + 1)
        for k, (c, d, total, left) in enumerate(self.levels):
            ctx = context[len(context) - k :]
            if ctx in total:
                n = c.get(ctx + x, 0)
                p = max(n - d[min(n, 3)], 0) / total[ctx] + left[ctx] / total[ctx] * p
        return p

    def bits(self, word: str) -> float:
        padded = "^" * (N - 1) + word
        return -sum(log2(self.prob(padded[i : i + N - 1], x)) for i, x in enumerate(word + "$"))


def letters(text: str | None) -> list[str]:
    return re.findall(r"[^\W\d_]+", (text or "").lower())


@pytest.fixture(scope="module")
def corpus(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("text", "lang").collect()
    by = {lang: Counter() for lang in sorted({r["lang"] for r in rows if r["lang"]})}
    for r in rows:
        if r["lang"]:
            by[r["lang"]].update(letters(r["text"]))
    return [r["text"] for r in rows], by


def test_cross_entropy_is_the_plain_one(corpus):
    texts, by = corpus
    assert len(by) > 1
    fitted = [langid.fit_language([w.encode() for w in c], np.array(list(c.values()))) for c in by.values()]
    models, plain = langid.Models(list(by), fitted).index(), [Plain(c) for c in by.values()]
    texts = [*(t for t in texts if t and re.fullmatch(r"[\x00-\x7f]*", t))][:60] + ["zzqx jjj", "a", "", None]
    got, size = models.entropy(pa.array(texts, pa.large_string()))
    memo = [{} for _ in plain]
    for i, t in enumerate(texts):
        words = letters(t)
        assert size[i] == sum(len(w) + 1 for w in words)
        for j, m in enumerate(plain):
            for w in set(words) - memo[j].keys():
                memo[j][w] = m.bits(w)
            want = sum(memo[j][w] for w in words) / max(1, size[i])
            assert got[i, j] == pytest.approx(want, rel=2e-6, abs=1e-9)


def test_probabilities_sum_to_one(corpus):
    for counts in corpus[1].values():
        m = Plain(counts)
        symbols = [*m.levels[0][0], "一"]  # the last stands for all that was not learned
        seen = ["".join(g[:-1]) for g in list(m.levels[N - 1][0])[:40]]
        for context in [*seen, "^^^^", "zqzq", "^^^一"]:
            assert sum(m.prob(context, x) for x in symbols) == pytest.approx(1, abs=1e-9)
