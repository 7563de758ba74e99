"""Each operator against a plain version written here, over the smallest tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from wordloom.llm import queries as Q

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def rows(spark, name):
    return Q.QUERIES[name](spark, SF).collect()


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def words(t):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(t))


def test_decontamination(spark, texts):
    bench = {r["item_id"]: words(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    got = {r["doc_id"]: r for r in rows(spark, "op1_decontamination")}
    assert len(got) == len(texts)
    for i, r in texts.items():
        w = words(r["text"])
        hit, items = set(), set()
        for item, b in bench.items():
            for a in range(max(1, len(b) - 12) if b else 0):
                win = b[a : a + 13]
                for at in range(len(w) - len(win) + 1):
                    if w[at] == win[0] and w[at : at + len(win)] == win:
                        hit.update(range(at, at + len(win)))
                        items.add(str(item))
        sha = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
        assert tuple(got[i])[1:] == (len(w), len(hit), len(items), sha, bool(hit) and 20 * len(hit) >= len(w))
    assert any(r["contaminated"] for r in got.values())


def test_lm_score(spark, texts):
    tokens = lambda t: re.findall("[^\x20\x09-\x0d]+", lower(t))
    fold = {i: zlib.crc32(str(i).encode()) % 7 for i in texts}
    uni, bi, starts = Counter(), Counter(), 0
    for i, r in texts.items():
        if fold[i] != 2:
            seq = ["<s>", *tokens(r["text"]), "</s>"]
            starts += 1
            uni.update(seq[1:])
            bi.update(zip(seq, seq[1:]))
    n, v = sum(uni.values()), len(uni)
    before, follow = Counter(w for _, w in bi), {}
    for (u, _), c in bi.items():
        follow.setdefault(u, Counter())[min(c, 3)] += 1

    def disc(c):
        a = Counter(c.values())
        y = a[1] / (a[1] + 2 * a[2])
        d = [1 - 2 * y * a[2] / a[1], 2 - 3 * y * a[3] / a[2], 3 - 4 * y * a[4] / a[3]]
        return [0.0, *(min(max(x, 0.05), k - 0.05) for k, x in enumerate(d, 1))]

    d2, d1 = disc(bi), disc(before)
    left = sum(d1[min(c, 3)] for c in before.values()) / len(bi)
    p1 = lambda w: max(before[w] - d1[min(before[w], 3)], 0) / len(bi) + left / (v + 1)

    def p2(u, w):
        total = starts if u == "<s>" else uni[u]
        if not total:
            return p1(w)
        c = bi[(u, w)]
        return max(c - d2[min(c, 3)], 0) / total + sum(d2[k] * m for k, m in follow[u].items()) / total * p1(w)

    assert abs(sum(p2("the", w) for w in uni) + p2("the", "?unseen?") - 1) < 1e-9
    for r in rows(spark, "op2_lm_score"):
        seq = ["<s>", *tokens(texts[r["doc_id"]]["text"]), "</s>"]
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (fold[r["doc_id"]] == 2, len(seq) - 1, n)
        assert r["n_known"] == sum(uni[w] > 0 for w in seq[1:])
        assert math.isclose(r["base_score"], sum(math.log10((uni[w] + 1) / (n + v + 1)) for w in seq[1:]), rel_tol=1e-9)
        assert math.isclose(r["score"], sum(math.log10(p2(u, w)) for u, w in zip(seq, seq[1:])), rel_tol=1e-9)


def test_sharding(spark, texts):
    got = rows(spark, "op4_sharding")
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    by = {}
    for r in got:
        by.setdefault(r["shard"], []).append(r["slot"])
        t = (texts[r["doc_id"]]["text"] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(t) + 16, zlib.crc32(t), "rows", None)
    assert set(by) == set(range(40)) and all(sorted(v) == list(range(len(v))) for v in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1


def test_html(spark):
    import html

    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in rows(spark, "op6_html_extract"):
        body = re.search(r"<article>(.*?)(?:</article>|<footer>|\Z)", pages[r["page_id"]], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^<>]*>", "", b)).split()) for b in re.split(r"</?(?:h1|p)>", body)]
        assert r["text"] == "\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


def test_warc(spark):
    pages = {r["page_id"]: (r["html"] or "").encode() for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    last = {}
    for i, p in sorted(pages.items()):
        last[p] = i
    got = rows(spark, "op7_warc")
    assert len(got) == len(pages)
    for r in got:
        p = pages[r["page_id"]]
        again = len(p) >= 1000 and last[p] != r["page_id"]
        assert tuple(r)[1:] == (len(p), hashlib.sha1(p).hexdigest(), "revisit" if again else "response", last[p] if again else None)


def test_quality(spark, texts):
    for r in rows(spark, "op8_quality"):
        t = texts[r["doc_id"]]["text"] or ""
        w = re.findall("[^\x20\x09-\x0d]+", t)
        grams = Counter(zip(w, w[1:], w[2:]))
        again = {k for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for k in (i, i + 1, i + 2)}
        lines = [x for x in t.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
        assert (r["n_words"], r["word_chars"], r["n_symbols"]) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)))
        assert (r["n_dup_lines"], r["n_repeat_words"]) == (len(lines) - len(set(lines)), len(again))
        assert r["base_failed"] == (len(w) < 50 or 100 * len(again) > 50 * len(w)) and not (r["base_failed"] and r["kept"])


def test_language(spark, texts):
    got = rows(spark, "op9_language_id")
    held = [r for r in got if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in texts if zlib.crc32(str(i).encode()) % 3 == 1}
    right = sum(r["lang_pred"] == texts[r["doc_id"]]["lang"] for r in held)
    assert right >= 0.97 * len(held) and all(0 <= r["score"] <= 1 for r in got)


def test_token_counts(spark, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for r in rows(spark, "op10_token_counts"):
        t = texts[r["doc_id"]]["text"] or ""
        n = len(tok.encode(t, add_special_tokens=False).ids)
        assert tuple(r)[1:] == (len(t.encode()), n, n > 512)


def plain_classes(docs: dict, limit=0.8):
    bags = {}
    for i, t in docs.items():
        w = words(t)
        bags[i] = Counter(tuple(w[a : a + 5]) for a in range(max(1, len(w) - 4) if w else 0))
    where = {}
    for i, b in bags.items():
        for g in b:
            where.setdefault(g, []).append(i)
    root = {i: i for i in docs}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    same = {}
    for i, t in docs.items():
        a, b = find(same.setdefault(t or "", i)), find(i)
        root[max(a, b)] = min(a, b)
    for i, b in bags.items():
        for j in {j for g in b for j in where[g] if j < i}:
            low = sum((b & bags[j]).values())
            if low >= limit * (sum(b.values()) + sum(bags[j].values()) - low):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in docs}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_near_duplicates(spark, sf):
    path = f"/root/testdata/{sf}"
    want = plain_classes({r["doc_id"]: r["text"] for r in spark.read.parquet(f"{path}/documents.parquet").collect()})
    got = {r["doc_id"]: r["class_id"] for r in Q.QUERIES["op5_near_duplicates"](spark, path).collect()}
    assert got == want and len(set(want.values())) < len(want)


def test_segmentation(spark, texts):
    got = rows(spark, "op3_sentencepiece")
    assert len(got) == len(texts) and all(r["decoded"] and r["n_samples"] == 2 and r["ids_crc32"][0] != r["ids_crc32"][1] for r in got)
