"""Kept lattices and the search over them."""

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from wordloom.llm import pieces

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def voc():
    return pieces.Vocabulary.load(public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def texts():
    odd = ["", None, " ", "  ", "a", "\u0000", "€\U0001f600 \U0001f600߿", "x" * 3000, "a▁b"]
    return [*pq.read_table(f"{SF}/documents.parquet")["text"].to_pylist(), *odd, *odd]


def drawn(voc, texts, size, k, keep):
    """ids, log-probability and bound of every sample, and the threshold, text by text, loaded ``size`` texts at a time."""
    s, out = pieces.Sampler(voc, k, 5, keep), []
    for i in range(0, len(texts), size):
        part = texts[i : i + size]
        s.load(pa.array(part, pa.large_string()))
        got, threshold = s.sample(0, np.arange(i, i + len(part)).astype(np.uint64))
        ids = [s.ids(d) for d in got]
        for t in range(len(part)):
            one = [(x[off[t] : off[t + 1]].tolist(), d.logp[t], d.bound[t]) for (x, off), d in zip(ids, got) if not np.isnan(d.logp[t])]
            out.append((one, threshold[t]))
    return out


def test_kept_words_change_nothing(voc, texts):
    """One batch, many batches with every word kept, some kept, and none kept."""
    want = drawn(voc, texts, len(texts), 3, 3 << 20)
    for size, keep in ((17, 3 << 20), (17, 20_000), (5, 0)):
        assert drawn(voc, texts, size, 3, keep) == want


def test_forgetting_keeps_used_words(voc):
    s = pieces.Sampler(voc, 1, 1, 60)
    for words in ("alpha beta", "alpha gamma", "alpha " + "delta" * 9):
        s.load(pa.array([words], pa.large_string()))
    assert len(s.known) == 2 and len(s.lat.first) == 2  # alpha, and the last batch's other word
    assert (np.diff(s.known.astype(np.float64)) > 0).all() and sorted(s.place) == [0, 1]


def test_samples_are_distinct_and_ordered(voc, texts):
    for one, threshold in drawn(voc, texts, 50, 6, 3 << 20):
        assert len({tuple(ids) for ids, _, _ in one}) == len(one) >= 1
        bounds = [b for _, _, b in one] + [threshold]
        assert bounds == sorted(bounds, reverse=True)


def test_second_sample_follows_the_law(voc):
    """Of one short word: P(second = b) = sum over a of p(a) p(b) / (1 - p(a)), over 20,000 keys."""
    s, n = pieces.Sampler(voc, 2, 3), 20_000
    s.load(pa.array(["the"] * n, pa.large_string()))
    (a, b), _ = s.sample(0, np.arange(n).astype(np.uint64))
    p, second = {}, {}
    for d, count in ((a, None), (b, second)):
        ids, off = s.ids(d)
        for t in range(n):
            path = tuple(ids[off[t] : off[t + 1]].tolist())
            p[path] = np.exp(d.logp[t])
            if count is not None:
                count[path] = count.get(path, 0) + 1
    assert abs(sum(p.values()) - 1) < 0.01
    for path, got in second.items():
        want = sum(q * p[path] / (1 - q) for o, q in p.items() if o != path)
        assert abs(got / n - want) < 5 * np.sqrt(want * (1 - want) / n) + 0.005
