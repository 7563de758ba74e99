"""The delta-maintained merge loop against a full recount every round (small table, many merges)."""

import regex

from wordloom.operators import bpe as bp

SF = "/root/testdata/sf0.001"
K = 40


def _recount_bpe(texts, k):
    """Plain recount: pair counts from scratch each round, ties to the pair met first."""
    pre = regex.compile(r"\w+|(?<=\w)[^\w\s]")
    order, freq = [], {}
    for text in texts:
        for w in pre.findall(text.lower()):
            if w not in freq:
                order.append(w)
                freq[w] = 0
            freq[w] += 1
    segs = {w: list(w) + ["</w>"] for w in order}
    merges = []
    for _ in range(k):
        counts, first = {}, {}
        for rank, w in enumerate(order):
            s = segs[w]
            for i in range(len(s) - 1):
                p = (s[i], s[i + 1])
                counts[p] = counts.get(p, 0) + freq[w]
                first.setdefault(p, (rank, i))
        if not counts:
            break
        best = min(counts, key=lambda p: (-counts[p], first[p]))
        merges.append((best[0], best[1], counts[best]))
        for w in order:
            s, out, i = segs[w], [], 0
            while i < len(s):
                if i + 1 < len(s) and (s[i], s[i + 1]) == best:
                    out.append(s[i] + s[i + 1])
                    i += 2
                else:
                    out.append(s[i])
                    i += 1
            segs[w] = out
    vocab = sorted({t for s in segs.values() for t in s})
    return merges, vocab


def test_merge_loop_equals_recount(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    texts = [r["text"] for r in docs.orderBy("doc_id").collect()]
    want_merges, want_vocab = _recount_bpe(texts, K)
    model = bp.train_bpe(docs, K)
    got = [(r["l"], r["r"], r["cnt"]) for r in model.merges.orderBy("rank").collect()]
    assert got == want_merges
    vocab = {r["token"]: r["id"] for r in model.vocab.collect()}
    assert vocab == {t: i for i, t in enumerate(want_vocab)}
