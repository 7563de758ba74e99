"""Personal data: base spans against Python's patterns, the models on known answers, and odd inputs."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

from wordloom.llm import common as C
from wordloom.llm import pii
from wordloom.llm import queries as Q

SF = "/root/testdata/sf0.001"


def plain(text):
    """Base spans by kind and start, as the contract words them."""
    t, out = text or "", []
    out += [("email", m) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", m) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(c) for c in m[0] if c.isdigit()][::-1]
        if 13 <= len(d) <= 19 and (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0:
            out.append(("card", m))
    out += [("phone", m) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return [f"{k}:{m.start()}:{m.end()}" for k, m in out]


def names(spans):
    return [f"{pii.KINDS[s['kind']]}:{s['start']}:{s['end']}" for s in spans]


def test_query_equals_plain(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r["doc_id"]: r for r in Q.QUERIES["op13_personal_data"](spark, SF).collect()}
    assert len(got) == len(texts)
    for i, t in texts.items():
        want = plain(t)
        n = [sum(s.startswith(k + ":") for s in want) for k in pii.KINDS[:4]]
        assert [got[i][f"n_{k}"] for k in pii.KINDS[:4]] == n
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert set(want) <= set(got[i]["spans"].split(",")) | {""}
    assert any(r["spans"] for r in got.values())


ODD = [
    None, "", "a@b.c_x@y.org z@z", "x@a.b.c.d@e.f", "é\U0001f600 1.2.3.4.5.6.7.8.9 256.1.1.1 000255.0.0.001", "1.2.3", "....", "+1 +1 (234) 567-8901)", "+123456789", "+12(3) ",
    "4111 1111 1111 1111", "4111-1111-1111-1111-", "4111  1111 1111 1111", "41111111111111111111111", "x4111111111111111y", "4111 1111 1111 1112",
    "+1 4111111111111111", "a+b@c.de.", "%@-.-", "٣.٣.٣.٣ １.１.１.１", "\n\n7.7.7.7\n+49 30 1234567\r\nq@q.q", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7 8",
    "a" * 2_000, "7" * 2_000, "1." * 2_000, "a@" * 2_000, "a@b.c " * 2_000, "+1 " + "(" * 2_000 + "1",
]
#: Long texts (Python's search of the same patterns takes quadratic time) and their numbers of base spans.
LONG = {"a" * 200_000: 0, "7" * 200_000: 0, "1." * 20_000: 5_000, "a@" * 50_000: 0, "a@b.c " * 5_000: 5_000, "+1 " + "(" * 50_000 + "1": 0}


def test_odd_texts(spark):
    rng = random.Random(4)
    soup = ["".join(rng.choice(["a", "b.", "@", "1", "22.", "+", "-", " ", "(", ")", "é", "%", "411111111111111", "1\n"]) for _ in range(60)) for _ in range(300)]
    texts = [*ODD, *soup, *LONG]
    df = spark.createDataFrame([(i, t, "x", None) for i, t in enumerate(texts)], "doc_id int, text string, base string, _t string").repartition(8)
    found = C.Scratch(spark, "t").table(pii.find(df), "found").collect()
    assert len(found) == len(texts)
    for r in found:
        t = texts[r["doc_id"]]
        if t in LONG:
            assert len(r["base"]) == LONG[t] and all(a["end"] <= b["start"] for a, b in zip(r["base"], r["base"][1:]))
        else:
            assert names(r["base"]) == plain(t), t


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghilmnorstu") for _ in range(rng.randint(2, 9)))
    prose = lambda: " ".join(word() for _ in range(30)) + ". "
    rows, want = [], {}
    for i in range(240):
        t = prose()
        kind = i % 8
        if kind == 0:
            t += f"mail {word()}@{word()}.com "
        elif kind == 1:
            t += f"call +1 (234) 555-{1000 + i} "
        elif kind == 2:
            at = len(t) + len("Please phone: ")
            t += f"Please phone: (0234) 555-{1000 + i} "
            want[i] = [f"phone:{at}:{at + 15}"]
        elif kind == 3:
            key = "".join(rng.choice("0123456789abcdef") for _ in range(40))
            t += 'api_key = "'
            want[i] = [f"secret:{len(t)}:{len(t) + 40}"]
            t += f'{key}" '
        elif kind == 4:
            t += "dear "
            want[i] = [f"name:{len(t)}:{len(t) + 11}"]
            t += "Maria Ullin, "
        elif kind == 5:
            t += "contact "
            s = f"{word()} at {word()} dot com"
            want[i] = [f"email:{len(t)}:{len(t) + len(s)}"]
            t += s + " "
        elif kind == 6:
            t += f"invoice 7234567890123{i % 10}{i // 10 % 10}{(i + 1) % 10} version 1.2.300.4 commit {'ab12' * 6} "
        rows.append((i, t + prose()))
    return rows, want


def test_added_spans(spark, corpus):
    rows, want = corpus
    got = pii.detect(spark.createDataFrame(rows, "doc_id int, text string")).collect()
    assert len(got) == len(rows)
    for r in got:
        base, spans = names(r["base"]), names(r["spans"])
        assert base == plain(dict(rows)[r["doc_id"]])
        assert sorted(set(spans) - set(base)) == sorted(want.get(r["doc_id"], [])), rows[r["doc_id"]]
        assert set(base) <= set(spans)
        assert spans == sorted(spans, key=lambda s: (pii.KINDS.index(s.split(":")[0]), int(s.split(":")[1])))


def test_estimates_recover_reliabilities():
    rng, true = random.Random(2), [0.95, 0.9, 0.8, 0.7]
    count = {}
    for _ in range(30_000):
        y = rng.random() < 0.4
        votes = [2 if (rng.random() < q) == y else 0 for q in true]
        key = (0, (*votes, *[1] * (len(pii.FEATURES) - 4)), False)
        count[key] = count.get(key, 0) + 1
    prob, rel = pii.estimate([(*k, n) for k, n in sorted(count.items())], rounds=200)
    assert all(abs(a - q) < 0.03 for a, q in zip(rel.right, true))
    assert abs(rel.share[0] - 0.4) < 0.03 and all(0 <= p <= 1 for p in prob)
    w = pii.fit([(*k, n) for k, n in sorted(count.items())], prob)
    for (kind, f, _), p in zip(sorted(count), prob):
        z = w[kind][0] + sum(w[kind][1 + j * 4 + c] for j, c in enumerate(f))
        assert (z > 0) == (p > 0.5)


def test_no_rows_and_equal_rows(spark):
    schema = "doc_id bigint, text string, spans string"
    assert pii.detect(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, "a@b.c", ""), (None, "a@b.c", ""), (1, "a@b.c", ""), (1, None, None)]
    got = pii.detect(spark.createDataFrame(rows, schema)).collect()
    assert sorted(str((r["doc_id"], names(r["base"]))) for r in got) == sorted(str((i, plain(t))) for i, t, _ in rows)
