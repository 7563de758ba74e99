"""Nulls, empty and very long texts, ties and repeated rows, empty tables and clashing columns, for every operator."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from wordloom.llm import common as C
from wordloom.llm import decontamination, html_extract, langid, lm, neardup, pieces, quality, sharding, tokencount, warc

LONG = " ".join(f"w{i % 977}x{i}" for i in range(120_000))
ONE_WORD = "ab" * 700_000
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def odd(spark):
    en = "the quick brown fox jumps over the lazy dog and runs far away from here today with all of its friends " * 4
    de = "der schnelle braune fuchs springt ueber den faulen hund und laeuft heute weit weg von hier mit freunden " * 4
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, LONG, "en", "s", 1), (4, en, "en", "s", 1), (4, en, "en", "s", 1),
            (None, en + "tail", "en", None, 1), (5, de, "de", "s", 1), (6, "!!! ... 123", None, "s", 1), (7, " \t\n ", "de", "s", 1),
            (8, "naïve café ☕ \U0001f600\x00 x", "en", "s", 1), (9, en, None, "t", None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_word_hashes_equal_plain_words():
    texts = [None, "", "A b", "b a", ONE_WORD, "é É x", "x" + ONE_WORD, ONE_WORD, " lead", "tail "]
    h, s, e, b = C.words(*C.text_bytes(pa.array(texts)), C.NONSPACE_LOWER)
    plain = [w for t in texts for w in (t or "").translate(str.maketrans("AB", "ab")).split()]
    assert len(plain) == len(h) and b[-1] == len(h)
    assert len(set(plain)) == len(set(h.tolist()))
    first = {}
    assert all(first.setdefault(w, x) == x for w, x in zip(plain, h.tolist()))


def test_decontamination(spark, odd, none):
    w = LONG.split()
    bench = spark.createDataFrame([(1, " ".join(w[90_000:90_040])), (2, "THE Quick"), (3, None), (4, "..."), (None, "lazy dog"), (2, "the quick")], "item_id bigint, text string")
    got = sorted(decontamination.decontaminate(odd, bench, block=3).collect(), key=lambda r: (r["doc_id"] or 0, r["n_words"]))
    assert len(got) == odd.count()
    by = {r["doc_id"]: r for r in got}
    assert by[1]["n_words"] == by[2]["n_words"] == by[6]["n_hit"] == 0 and by[6]["n_words"] == 1
    assert (by[3]["n_words"], by[3]["n_hit"], by[3]["items"], by[3]["contaminated"]) == (120_000, 40, ["1"], False)
    assert by[3]["spans"][0].asDict() == {"a": 90_000, "b": 90_040}
    assert by[4]["items"] == ["2"] and by[4]["n_hit"] == 4 * 4 and by[4]["contaminated"]
    assert decontamination.decontaminate(none, bench).count() == 0
    assert decontamination.decontaminate(odd, bench.limit(0)).where("contaminated").count() == 0
    assert decontamination.clean_rows(odd.withColumn("hits", F.lit(1)), bench).columns == [*odd.columns, "hits"]


def test_lm(spark, odd, none):
    got = lm.lm_score(odd, F.col("doc_id") != 5).collect()
    assert len(got) == odd.count() and all(r["n_tokens"] >= 1 and r["score"] < 0 for r in got)
    by = {r["doc_id"]: r for r in got}
    assert by[1]["n_tokens"] == by[2]["n_tokens"] == by[7]["n_tokens"] == 1 and by[3]["n_tokens"] == 120_001
    assert by[1]["n_known"] == 1 and by[5]["n_known"] == 1  # the end token
    empty = lm.lm_score(odd, F.lit(False)).collect()
    assert all(r["score"] == 0 and r["base_score"] == 0 and r["train_tokens"] == 0 and r["n_known"] == 0 for r in empty)
    assert lm.lm_score(none, F.lit(True)).count() == 0
    again = lm.Model.load(got[0]["model_dir"]).score(odd).collect()
    assert sorted(r["score"] for r in again) == sorted(r["score"] for r in got)


def test_segmentation(spark, odd, none):
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    got = pieces.segment(odd.where("doc_id <> 3 or doc_id is null"), path, k=5, seed=1).collect()
    for r, t in zip(got, [r["text"] for r in odd.where("doc_id <> 3 or doc_id is null").collect()]):
        segs = [tuple(s["ids"]) for s in r["samples"]]
        assert len(set(segs)) == len(segs) == (5 if (t or "").strip() else len(segs))
        bound = [s["perturbed"] for s in r["samples"]]
        assert bound == sorted(bound, reverse=True) and all(s["log_inclusion"] <= 1e-12 for s in r["samples"])
        assert all(sp.decode(list(s)) == (t or "") for s in segs)
    assert pieces.segment(none, path).count() == 0
    same = odd.where("doc_id = 4")
    a, b = pieces.segment(same, path, k=3, seed=9).collect()
    assert a == b  # equal rows, equal samples


def test_segmentation_law():
    """First samples follow the lattice's distribution, and pairs without replacement follow the sequential law."""
    import public_tokenizers

    voc = pieces.Vocabulary.load(public_tokenizers.path("piece_bpe_32k.model"))
    s = pieces.Sampler(voc, 2, 3)
    n = 6000
    s.load(pa.array(["to be"] * n))
    drawn, _ = s.sample(0, np.arange(n, dtype=np.uint64))
    (ids0, off0), (ids1, off1) = (s.ids(d) for d in drawn)
    first = [tuple(ids0[off0[i] : off0[i + 1]]) for i in range(n)]
    second = [tuple(ids1[off1[i] : off1[i + 1]]) for i in range(n)]
    p = {a: np.exp(x) for a, x in zip(first, drawn[0].logp)} | {a: np.exp(x) for a, x in zip(second, drawn[1].logp)}
    assert abs(sum(p.values()) - 1) < 0.02 and all(a != b for a, b in zip(first, second))
    for a, q in p.items():
        assert abs(first.count(a) / n - q) < 4 * np.sqrt(q * (1 - q) / n) + 1e-3
        want = sum(x * q / (1 - x) for b, x in p.items() if b != a)
        assert abs(second.count(a) / n - want) < 5 * np.sqrt(want / n) + 2e-3


def test_sharding(spark, odd, none, tmp_path):
    got = sharding.shuffle_to_shards(odd, f"file://{tmp_path}/a", 4, bucket_bytes=1000).collect()
    assert len(got) == odd.count() and sorted(r["_slot"] for r in got if r["_shard"] == 0) == [0, 1]
    assert sorted(str(r["text"]) for r in got) == sorted(str(r["text"]) for r in odd.collect())
    again = sharding.shuffle_to_shards(odd, f"file://{tmp_path}/b", 4, bucket_bytes=1000).collect()
    assert sorted((str(r["doc_id"]), r["_shard"], r["_slot"]) for r in got) == sorted((str(r["doc_id"]), r["_shard"], r["_slot"]) for r in again)
    assert sharding.shuffle_to_shards(none, f"file://{tmp_path}/c", 4).count() == 0
    with pytest.raises(ValueError):
        sharding.shuffle_to_shards(odd.withColumn("_slot", F.lit(1)), f"file://{tmp_path}/d", 4)


def test_neardup(spark, odd, none):
    got = neardup.classes(odd).collect()
    assert len(got) == odd.count()
    by = {r["doc_id"]: r for r in got}
    assert by[4]["class_id"] == by[9]["class_id"] == by[None]["class_id"] == 4 and by[4]["class_size"] == 4
    assert by[1]["class_id"] == by[2]["class_id"] == 1 and by[6]["class_size"] == by[7]["class_size"] == 1
    kept = neardup.keep_one(odd.withColumn("class_id", F.lit(0)))
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 4, 5, 6, 7, 8] and kept.columns == [*odd.columns, "class_id"]
    assert neardup.classes(none).count() == 0 and neardup.keep_one(none).count() == 0


def test_bag_min_hash_estimates_weighted_jaccard():
    rng = np.random.default_rng(0)
    keys = rng.integers(1, 1 << 62, 300).astype(np.uint64)
    a, b = rng.integers(0, 40, 300), rng.integers(0, 40, 300)
    sh, doc, w = np.concatenate((keys[a > 0], keys[b > 0])), np.repeat([0, 1], [(a > 0).sum(), (b > 0).sum()]), np.concatenate((a[a > 0], b[b > 0]))
    sig = neardup.bag_min_hash(sh, doc, w, 2, 4000)
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((sig[0] == sig[1]).mean() - want) < 4 * np.sqrt(want * (1 - want) / 4000)


def test_html(spark, none):
    page = """<html><head><title>t</title><style>p{}</style></head><body><header><h1>Site</h1></header><nav><a href=x>menu</a></nav>
      <div class="cookie-notice">We use cookies</div><main><article class="post p-12"><h1>A &amp; B</h1><p>One  two&nbsp;three<br>four <b>five
      <p>Six<script>var x="</p>"</script> seven</p><ul><li>eight<li>nine</ul><aside>side</aside><div class="advert">buy</div><form>f<input></form></article>
      <section id="comments"><p>first comment, a long one that goes on and on and on and on</p></section></main><footer>foot</footer></body></html>"""
    rows = spark.createDataFrame([(1, "http://a.com/1", page), (2, "http://a.com/2", None), (3, None, ""), (None, "junk", "<p>plain &lt;p&gt; text"),
                                  (5, "http://a.com/5", "no tags at all"), (6, "http://b.com", "<" * 5000 + "<a href='x" * 2000), (1, "http://a.com/1", page)], "page_id bigint, url string, html string")
    got = html_extract.extract(rows.withColumn("text", F.lit("clash"))).collect()
    by = {(r["page_id"], r["url"]): r["text"] for r in got}
    assert len(got) == 7 and by[(1, "http://a.com/1")] == "A & B\nOne two three four five\nSix seven\neight\nnine"
    assert by[(2, "http://a.com/2")] == by[(3, None)] == "" and by[(None, "junk")] == "plain <p> text" and by[(5, "http://a.com/5")] == "no tags at all"
    assert html_extract.extract(rows.limit(0)).count() == 0


def test_warc(spark, tmp_path):
    big = "<p>é" * 600
    rows = spark.createDataFrame([(1, "http://a\r\nX: y", big), (2, None, big), (3, "u", None), (4, "u", "s"), (5, "u", "s"), (None, "u", big), (2, "v", big), (7, "u", ONE_WORD)],
                                 "page_id bigint, url string, html string")
    warc.write_archives(rows.withColumn("payload", F.lit(1)), f"file://{tmp_path}/w")
    back = warc.read_warc(spark, f"file://{tmp_path}/w")
    got = back.collect()
    kinds = sorted((r["record_id"], r["record_type"], r["refers_to"]) for r in got)
    assert kinds == sorted([("<urn:page:1>", "revisit", "<urn:page:2>"), ("<urn:page:2>", "response", None), ("<urn:page:2>", "response", None), ("<urn:page:3>", "response", None),
                            ("<urn:page:4>", "response", None), ("<urn:page:5>", "response", None), ("<urn:page:>", "revisit", "<urn:page:2>"), ("<urn:page:7>", "response", None)])
    for r in got:
        if r["record_type"] == "response":
            assert hashlib.sha1(r["payload"]).hexdigest() == r["payload_digest"] and len(r["payload"]) == r["payload_bytes"]
        else:
            assert r["payload"] is None and r["payload_bytes"] == len(big.encode())
    some = back.where("record_type = 'revisit' and payload_digest = '%s'" % hashlib.sha1(big.encode()).hexdigest())
    assert some.count() == 2
    assert warc.read_warc(spark, f"file://{tmp_path}/w", payload=False).where("payload is not null").count() == 0
    reader = warc.WarcReader({"path": f"file://{tmp_path}/w"})
    from pyspark.sql.datasource import EqualTo, GreaterThan

    rest = list(reader.pushFilters([EqualTo(("record_type",), "revisit"), GreaterThan(("payload_bytes",), 1)]))
    assert len(rest) == 1 and reader.want == {"WARC-Type": {"revisit"}}
    assert sum(b.num_rows for p in reader.partitions() for b in reader.read(p)) == 2
    warc.write_archives(rows.limit(0), f"file://{tmp_path}/e")
    assert warc.read_warc(spark, f"file://{tmp_path}/e").count() == 0


def test_quality(spark, odd, none):
    extra = spark.createDataFrame([(10, "a b c " * 100), (11, "x\n" * 60), (12, None)], "doc_id bigint, text string")
    entries = quality.ledger(extra.withColumn("n_words", F.lit(-1)).withColumn("_g", F.lit(0)))
    by = {r["doc_id"]: r for r in quality.apply_policy(entries, quality.POLICY_V1).collect()}
    assert (by[10]["n_words"], by[10]["n_repeat_words"]) == (300, 300) and by[11]["n_dup_lines"] == 59 and not by[12]["kept"]
    assert quality.ledger(odd).count() == odd.count() and quality.ledger(none).count() == 0
    table = {r["rule"]: r for r in quality.ablations(entries, quality.POLICY_V1).collect()}
    assert table["few_words"]["n_failed"] == 1 and table["few_words"]["n_only"] == 1 and table["few_words"]["n_kept_without"] == 1
    assert {r.bit for r in quality.RULES} == set(range(len(quality.RULES)))


def test_language(spark, odd, none):
    got = langid.identify(odd, F.lit(True)).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == odd.count() and by[4]["lang_pred"] == by[9]["lang_pred"] == "en" and by[5]["lang_pred"] == "de"
    assert all(by[k]["lang_pred"] == "und" and by[k]["score"] == 0 and by[k]["rejected"] for k in (1, 2, 6, 7))
    assert {r["lang_pred"] for r in langid.identify(odd, F.lit(False)).collect()} == {"und"}
    assert langid.identify(none, F.lit(True)).count() == 0 and langid.filter_rows(none, F.lit(True)).count() == 0
    kept = langid.filter_rows(odd.withColumn("h", F.lit(1)), F.lit(True))
    assert kept.columns == [*odd.columns, "h"] and {1, 2, 6, 7}.isdisjoint({r["doc_id"] for r in kept.collect()})


def test_language_model_sums_to_one():
    words = [b"abba", b"bab", b"cab", b"\xc3\xa9a"]
    m = langid.Models(["x"], [langid.fit_language(words, np.array([3, 2, 1, 1]))]).index()
    letters = [b"a", b"b", b"c", "é".encode(), b"z"]  # z stands for every unseen letter
    for context in (b"", b"a", b"ab", b"abb", b"zz"):
        base, _ = m.bits([context + x for x in letters] + [context])
        prefix = [m.bits([context[:i]])[0][0, 0] for i in range(len(context) + 1)]
        assert np.isfinite(base).all() and np.isfinite(prefix).all() and (base > 0).all()


def test_token_counts(spark, odd, none):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    spaces = "".join(chr(c) for c in range(0x3100) if chr(c).isspace()) + "᠎​﻿"
    texts = ["a<|endoftext|>b <|endoftext|>", "<|endoftext|>", " ", "\n\n x", "it's we'LL 12 ½ ²", *(f"a{c}b{c}{c} {c}" for c in spaces), spaces, "x" * 5000, "é" * 300, "\U0001f600 \x00 \x1c\x85"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string").unionByName(odd.select("doc_id", "text"))
    for r, t in zip(tokencount.count_tokens(rows.coalesce(1).withColumn("n_tokens", F.lit(0)), path).collect(), [r["text"] for r in rows.coalesce(1).collect()]):
        assert r["n_tokens"] == len(tok.encode(t or "", add_special_tokens=False).ids) and r["n_bytes"] == len((t or "").encode()), repr(t)
    assert tokencount.count_tokens(none, path).count() == 0


def test_pipeline(spark, odd, none, tmp_path):
    odd.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "the quick brown fox")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = odd
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == odd.columns, name
    ids = [r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    assert sorted(ids) == sorted(r["doc_id"] for r in docs.collect())
    empty = none
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, str(tmp_path))
        assert empty.count() == 0
