"""Cases in which an operator once did less than its whole job."""

from __future__ import annotations

import hashlib
import io
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from wordloom.llm import common as C
from wordloom.llm import html_extract, langid, neardup, pieces, queries, warc

SF = "/root/testdata/sf0.001"

LANGS = {"de", "en", "es", "fr"}


def noise(seed: int, letters: int) -> str:
    return " ".join("".join(map(chr, w)) for w in np.random.default_rng(seed).integers(97, 123, (letters // 6, 6)).tolist())


@pytest.mark.parametrize("out", sorted(LANGS))
def test_language_that_was_not_learned_is_rejected(spark, out):
    """Also where a few labelled rows are long and no language; texts in the learned languages stay."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    held = C.fold(F.col("doc_id"), 3) == 1
    wrong = spark.createDataFrame([(-i, noise(i, 20_000), "en") for i in range(1, 10) if out != "en"], docs.schema)
    letters = spark.createDataFrame([(-i, noise(1000 + i, 50), "noise") for i in range(100)], docs.schema)
    asked = docs.where((F.col("lang") == out) | held).unionByName(letters).withColumn("learn", F.lit(False))
    rows = docs.where((F.col("lang") != out) & ~held).unionByName(wrong).withColumn("learn", F.lit(True)).unionByName(asked)
    keyed = rows.withColumn("doc_id", F.struct("doc_id", "lang", "learn"))
    got = langid.identify(keyed, F.col("learn")).where("not doc_id.learn").select("doc_id.lang", "rejected").collect()
    kept = {x: [not r["rejected"] for r in got if r["lang"] == x] for x in (*LANGS, "noise")}
    assert sum(kept[out]) <= 0.03 * len(kept[out]) and sum(kept["noise"]) <= 2, {k: (sum(v), len(v)) for k, v in kept.items()}
    assert all(sum(kept[x]) >= 0.98 * len(kept[x]) for x in LANGS - {out}), {k: (sum(v), len(v)) for k, v in kept.items()}
    left = langid.filter_rows(keyed, F.col("learn")).where("not learn").groupBy("lang").count().collect()
    assert {r["lang"]: r["count"] for r in left} == {k: sum(v) for k, v in kept.items() if any(v)}


def test_segmentations_are_returned(spark):
    """From the query and from the pipeline's last stage: ids that decode to the text, with the plain probability."""
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    sp, voc = sentencepiece.SentencePieceProcessor(model_file=path), pieces.Vocabulary.load(path)
    logp = {voc.strings[i]: p for i, p in zip(voc.ids.tolist(), voc.logp.tolist())}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    got = queries.QUERIES["op3_sentencepiece"](spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = [s["ids"] for s in r["samples"]]
        assert [sp.decode(x) for x in ids] == [texts[r["doc_id"]]] * r["n_samples"]
        assert r["ids_crc32"] == [zlib.crc32(np.array(x, np.int32).tobytes()) for x in ids] and r["n_pieces"] == [len(x) for x in ids]
        assert r["log_prob"] == [s["log_prob"] for s in r["samples"]] and r["log_inclusion"] == [s["log_inclusion"] for s in r["samples"]]
    for r in sorted(got, key=lambda r: len(texts[r["doc_id"]]))[:40]:
        t = texts[r["doc_id"]].replace(" ", pieces.SPACE)
        t = pieces.SPACE + t if t and voc.prefix else t
        lost = lambda c: voc.byte_logp * len(c.encode())
        mass = [0.0]  # of all ways to the first characters
        for z in range(1, len(t) + 1):
            ways = [mass[a] + logp[t[a:z]] for a in range(max(0, z - voc.longest), z) if t[a:z] in logp]
            mass.append(np.logaddexp.reduce(ways + ([] if t[z - 1] in logp else [mass[z - 1] + lost(t[z - 1])])))
        for s in r["samples"]:
            n_bytes = sum(voc.strings[i] == "" for i in s["ids"])
            want = sum(logp[voc.strings[i]] for i in s["ids"] if voc.strings[i]) + n_bytes * voc.byte_logp - mass[-1]
            assert abs(s["log_prob"] - want) < 1e-6 * max(1, len(s["ids"]))
    key = lambda rows: sorted(map(str, rows))
    assert key(corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()) == key(got)
    blank = corpus_pipeline.STAGES[-1][1](spark, docs.limit(1).withColumn("text", F.lit(None).cast("string")), SF).collect()
    assert [(s["ids"], s["log_prob"]) for r in blank for s in r["samples"]] == [([], 0.0)] and blank[0]["decoded"]


def test_warc_headers_of_any_length(spark, tmp_path):
    """Long addresses with small payloads and with revisits come back whole."""
    sizes = [*range(1700, 2600, 50), 4000, 4090, 5000, 10_000]
    long = "<p>a payload that two pages have</p>" * 40
    rows = []
    for n in sizes:
        for uri in (noise(n, 2 * n).replace(" ", "/")[:n], "ab" * (n // 2)):
            rows += [(len(rows) + i, uri, html) for i, html in enumerate((noise(len(rows), 1500), "s", None, long))]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").coalesce(2)
    warc.write_archives(pages, f"file://{tmp_path}/w")
    got = {r["record_id"]: r for r in warc.read_warc(spark, f"file://{tmp_path}/w").collect()}
    assert len(got) == len(rows)
    for i, uri, html in rows:
        r, want = got[f"<urn:page:{i}>"], (html or "").encode()
        assert (r["target_uri"], r["payload_bytes"], r["payload_digest"]) == (uri, len(want), hashlib.sha1(want).hexdigest())
        again = html == long and i != rows[-1][0]
        assert (r["record_type"], r["payload"], r["refers_to"]) == (("revisit", None, f"<urn:page:{rows[-1][0]}>") if again else ("response", want, None))
    some = warc.read_warc(spark, f"file://{tmp_path}/w", payload=False).where("record_type = 'revisit'")
    assert some.count() == 2 * len(sizes) - 1


def test_warc_members_of_any_shape():
    """Lengths at which the inflater ends a turn inside a match, or with nothing left to read."""
    for n in range(1, 9000, 7):
        for body in (b"", b"x" * (n % 300)):
            data = warc.member(warc.record("response", "<urn:page:1>", "u" * n, "d", len(body), body, None), 9)
            ((head, payload),) = warc.records(io.BytesIO(data), {}, True)
            assert (len(head["WARC-Target-URI"]), payload) == (n, body)
    with pytest.raises((ValueError, KeyError)):
        list(warc.records(io.BytesIO(data[:40]), {}, True))


def test_html_wrappers_and_leads(spark):
    """A page in a wrapper with a boilerplate name or in one form has the text of the same page without it."""
    p = [f"Paragraph {i} has a few words of its own, and some more of them." for i in range(20)]
    inner = "".join(f"<p>{x}</p>" for x in p)
    chrome = "<header>site</header><nav><a href=x>menu</a></nav>"
    after = "<div class=sidebar><p>side one</p></div><form><p>mail us</p></form><section id=comments><article><p>a comment</p></article></section>"
    article = f"{chrome}<article><h1>Title</h1>{inner}</article>{after}"
    plain = f"{chrome}<h1>Title</h1><p>Lead.</p><div class=text>{inner}</div>{after}"
    wraps = ["<div id=page class='no-sidebar'>{}</div>", "<div class=has-menu>{}</div>", "<form action=/x>{}</form>", "<div class='page header-promo'><form>{}</form></div>", "<div id=sidebar-layout>{}</div>", "{}"]
    want = {}
    rows = []
    for wrap in wraps:
        for body, text in ((article, ["Title", *p]), (plain, ["Title", "Lead.", *p])):
            want[len(rows)] = "\n".join(text)
            rows.append((len(rows), f"http://h{len(rows)}.com/", f"<html><body>{wrap.format(body)}</body></html>"))
    rows.append((len(rows), "http://i.com/", f"<body><div class=outer><h1>{'Long title ' * 5}</h1><div><p>{'word ' * 260}</p></div></div></body>"))
    want[len(rows) - 1] = f"{('Long title ' * 5).strip()}\n{('word ' * 260).strip()}"
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_extract.extract(pages).collect()}
    assert {i: t for i, t in got.items() if t != want[i]} == {}


def test_estimate_loses_fewer_pairs_than_the_bands():
    n, p = neardup.BANDS * neardup.ROWS, neardup.THRESHOLD + (1 - neardup.THRESHOLD) / 16
    most = int(n * (1 - p + neardup.MARGIN * math.sqrt(p * (1 - p) / n)))
    tail = sum(math.comb(n, k) * (1 - p) ** k * p ** (n - k) for k in range(most + 1, n + 1))
    assert tail < (1 - neardup.THRESHOLD**neardup.ROWS) ** neardup.BANDS
