"""Language identification by character language models.

One interpolated modified Kneser-Ney model of character 5-grams per language,
over words of letters with start and end marks, kept as sorted hash arrays that
all languages share (a column per language). A text gets the language with the
lowest cross-entropy per character; a text that fits its language far worse
than nearly all labelled texts of its length that were set aside is rejected.

Models are fitted on a bounded sample of the labelled rows: about
``SAMPLE_CHARS`` characters per language, chosen by a hash of the row, so the
arrays that are broadcast have a bound that does not depend on the input. All
texts are scored whole; in a batch each distinct word is scored once.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.llm import common as C
from wordloom.llm.lm import discounts

ORDER = 5
SAMPLE_CHARS = 1_500_000
MOST_LANGUAGES = 1000  # each has a model of its own
ODD = 1.6  # a rejected text needs so many times the usual bits per symbol of its language, too
HELD_BACK = 5  # one sampled row in five calibrates and has no part in the models that it calibrates
SURE, BEYOND = 0.9, 1.4  # a rejected text has so many times the bits of this share of the set-aside texts of its length
BANDS = 16  # of lengths in symbols, each twice as long as the one before; the last is open
LEAST = 20  # set-aside texts that make a band's limit
TEMPERATURES = (0.5, 1.0, 2.0, 4.0, 8.0)
UNDETERMINED = "und"
_START, _END = 2, 3


def _letters(col: pa.Array) -> pa.Array:
    """Lower case, every run of characters that are no letters turned into a space."""
    col = pc.utf8_lower(pc.fill_null(col.cast(pa.large_string()), ""))
    return pc.replace_substring_regex(col, r"\PL+", " ")


def _code_points(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)


def _padded(words: list[bytes] | tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all words, each as start marks, letters, end mark; which symbols are predicted; word of each symbol."""
    text = b"\n".join(words) + b"\n" if words else b""
    cp = _code_points(text)
    ends = np.flatnonzero(cp == 10)
    pad = ORDER - 1
    n = np.diff(np.concatenate(([-1], ends))) + pad  # letters, the end mark and the pad
    word = np.repeat(np.arange(len(ends)), n)
    first = np.cumsum(n) - n
    within = np.arange(len(word)) - first[word]
    out = np.full(len(word), _START, np.uint64)
    inner = within >= pad
    sym = cp.astype(np.uint64)
    sym[ends] = _END
    out[inner] = sym
    return out, inner, word


def _grams(sym: np.ndarray) -> list[np.ndarray]:
    """Hash of the k symbols that end at each position, k = 1 .. ORDER (positions before k have junk)."""
    one = C.mix(sym + np.uint64(0x100000001))
    out = [one]
    for _ in range(ORDER - 1):
        prev = out[-1]
        out.append(C.pair(np.concatenate((prev[:1], prev[:-1])), one))
    return out


def fit_language(words: list[bytes], weight: np.ndarray) -> dict[str, np.ndarray]:
    """Per order k: sorted n-gram hashes with discounted probability, sorted context hashes with the mass left over."""
    sym, inner, word = _padded(words)
    grams = _grams(sym)
    at = np.flatnonzero(inner)
    out: dict[str, np.ndarray] = {}
    upper: tuple[np.ndarray, np.ndarray] | None = None
    for k in range(ORDER, 0, -1):
        if upper is None:
            o = at[np.argsort(grams[k - 1][at], kind="stable")]
            key = grams[k - 1][o]
            first = C.runs(key)
            count = np.add.reduceat(weight[word[o]], first) if len(first) else np.zeros(0, np.int64)
        else:  # continuation counts: distinct longer n-grams that end in this one
            o = upper[0][np.argsort(grams[k - 1][upper[0]], kind="stable")]
            key = grams[k - 1][o]
            first = C.runs(key)
            count = np.diff(np.append(first, len(key)))
        rep = o[first]
        upper = (rep, count)
        d = np.array([0.0, *discounts(*((count == c).sum() for c in (1, 2, 3, 4)))])
        cls = np.minimum(count, 3)
        ctx = grams[k - 2][rep - 1] if k > 1 else np.zeros(len(rep), np.uint64)
        co = np.argsort(ctx, kind="stable")
        cfirst = C.runs(ctx[co])
        total = np.add.reduceat(count[co], cfirst).astype(float) if len(cfirst) else np.zeros(0)
        left = np.add.reduceat(d[cls[co]], cfirst) if len(cfirst) else np.zeros(0)
        mine = np.empty(len(rep))
        mine[co] = np.repeat(total, np.diff(np.append(cfirst, len(co))))
        out[f"g{k}"], out[f"p{k}"] = key[first], (np.maximum(count - d[cls], 0) / mine).astype(np.float32)
        out[f"c{k}"], out[f"b{k}"] = ctx[co][cfirst], (left / total).astype(np.float32)
    out["alphabet"] = np.array([len(out["g1"])])
    return out


class Models:
    """The languages' models over common keys: row = n-gram or context, column = language."""

    def __init__(self, langs: list[str], fitted: list[dict[str, np.ndarray]]) -> None:
        self.langs = langs
        self.alphabet = np.array([float(f["alphabet"][0]) for f in fitted])
        self.tables = []
        for k in range(1, ORDER + 1):
            self.tables.append((*self._merge([f[f"g{k}"] for f in fitted], [f[f"p{k}"] for f in fitted], 0.0), *self._merge([f[f"c{k}"] for f in fitted], [f[f"b{k}"] for f in fitted], 1.0)))

    @staticmethod
    def _merge(keys: list[np.ndarray], values: list[np.ndarray], absent: float) -> tuple[np.ndarray, np.ndarray]:
        union = np.unique(np.concatenate(keys))
        out = np.full((len(union) + 1, len(keys)), absent, np.float32)  # the last row stands for what is absent
        for j, (k, v) in enumerate(zip(keys, values)):
            out[np.searchsorted(union, k), j] = v
        return union, out

    def index(self) -> "Models":
        self.found = [(C.HashIndex(g), p, C.HashIndex(c), b) for g, p, c, b in self.tables]
        return self

    def bits(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(bits of each word under each language, symbols predicted in it)."""
        sym, inner, word = _padded(words)
        grams = _grams(sym)
        at = np.flatnonzero(inner)
        p = np.broadcast_to(1.0 / (self.alphabet + 1), (len(at), len(self.langs))).astype(np.float32)
        for k, (g, own, c, left) in enumerate(self.found, 1):
            ctx = grams[k - 2][at - 1] if k > 1 else np.zeros(len(at), np.uint64)
            p = own[g.find(grams[k - 1][at])] + left[c.find(ctx)] * p
        lost = -np.log2(np.maximum(p, 1e-30))
        first = C.runs(word[at])
        return (np.add.reduceat(lost, first, axis=0) if len(first) else np.zeros((0, len(self.langs)))), np.bincount(word[at], minlength=len(words))

    def entropy(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(bits per symbol of each text under each language, symbols of it)."""
        data, off = C.text_bytes(_letters(col))
        h, s, e, b = C.words(data, off, C.NONSPACE)
        uniq, first, back = np.unique(h, return_index=True, return_inverse=True)
        raw = data.tobytes()
        bits, n = self.bits([raw[x:y] for x, y in zip(s[first].tolist(), e[first].tolist())])
        out = np.zeros((len(b) - 1, len(self.langs)))
        size = np.zeros(len(b) - 1, np.int64)
        some = np.flatnonzero(np.diff(b))
        if len(some):
            for j in range(len(self.langs)):
                out[some, j] = np.add.reduceat(bits[back, j], b[some], dtype=np.float64)
            size[some] = np.add.reduceat(n[back], b[some])
        return out / np.maximum(size, 1)[:, None], size


def sample(labelled: DataFrame, chars: int) -> DataFrame:
    """About ``chars`` characters of each language (all where it has fewer), whole rows, by a hash of the row.

    The share of each language is one number; texts are filtered where they lie."""
    totals = labelled.groupBy("lang").agg(F.sum(F.char_length("text")).alias("all")).limit(MOST_LANGUAGES + 1).collect()
    if len(totals) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} labels: these are no languages")
    if not totals:
        return labelled.limit(0)
    share = (F.xxhash64("id", "text").cast("double") / float(1 << 63) + 1) / 2
    total = F.create_map(*(x for r in totals for x in (F.lit(r["lang"]), F.lit(float(r["all"])))))[F.col("lang")]
    return labelled.where(share * total < chars)


def fit(labelled: DataFrame, chars: int = SAMPLE_CHARS) -> "tuple[Models | None, dict]":
    """Models of all sampled rows (id, text, lang), and the calibration, made with models of four fifths of them. The
    languages are the distinct labels."""
    C.ship(labelled.sparkSession)
    scratch = C.Scratch(labelled.sparkSession, "langid")
    rows = scratch.table(sample(labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull()), chars), "sample")
    back = F.pmod(F.xxhash64("text", "id"), F.lit(HELD_BACK)) == 0

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter = Counter()
            for text, lang, aside in zip(_letters(batch.column("text")).to_pylist(), batch.column("lang").to_pylist(), batch.column("back").to_pylist()):
                found.update((lang, w, aside) for w in text.split())
            yield pa.record_batch([pa.array([k[0] for k in found], pa.string()), pa.array([k[1] for k in found], pa.string()), pa.array(list(found.values()), pa.int64()), pa.array([0 if k[2] else n for k, n in found.items()], pa.int64())], ["lang", "word", "n", "part"])

    def learn(key, table):
        names, data = [], []
        for which in ("n", "part"):
            n = np.array(table[which])
            some = np.flatnonzero(n)
            if len(some):
                model = fit_language([w.as_py().encode() for w in table["word"].take(pa.array(some))], n[some])
                names += [f"{which} {x}" for x in model]
                data += [v.tobytes() for v in model.values()]
        return pa.table({"lang": pa.array([key[0].as_py()] * len(names)), "name": names, "data": pa.array(data, pa.binary())})

    words = rows.select("text", "lang", back.alias("back")).mapInArrow(count, "lang string, word string, n bigint, part bigint").groupBy("lang", "word").agg(F.sum("n").alias("n"), F.sum("part").alias("part"))
    kinds = {"g": np.uint64, "c": np.uint64, "p": np.float32, "b": np.float32, "a": np.int64}
    fitted: dict[str, dict[str, dict[str, np.ndarray]]] = {"n": {}, "part": {}}
    for r in words.groupBy("lang").applyInArrow(learn, "lang string, name string, data binary").collect():  # bounded by the sample
        which, name = r["name"].split(" ")
        fitted[which].setdefault(r["lang"], {})[name] = np.frombuffer(bytes(r["data"]), kinds[name[0]])
    if not fitted["n"]:
        scratch.drop("sample")
        return None, {}
    models, part = (Models(sorted(x), [x[k] for k in sorted(x)]) if x else None for x in fitted.values())
    calibration = calibrate(part, rows.where(back)) if part else {"temperature": 1.0, "limit": {}}
    scratch.drop("sample")
    return models, calibration


def calibrate(models: Models, rows: DataFrame) -> dict:
    """From labelled rows that trained nothing: the temperature that makes the scores most likely, and for each language
    the bits per symbol beyond which a text is rejected, by length band.

    Usual is the median of the language's own texts. A band's limit is ``BEYOND`` times the ``SURE`` quantile of its
    texts' bits, and ``ODD`` times the usual ones at least, so that no few long, noisy or mislabelled rows set it. Each
    text counts whole and by runs of 1, 2, 4, ... of its words, so that short bands have as many texts as long ones.
    """
    words = F.split(F.trim(F.regexp_replace("text", r"\PL+", " ")), " ")
    size = F.explode(F.expr(f"array_append(transform(filter(sequence(0, {BANDS}), x -> shiftleft(1, x) < size(w)), x -> shiftleft(1, x)), 0)"))
    cut = rows.select("id", "text", "lang", words.alias("w")).select("id", "text", "lang", "w", size.alias("take"))
    start = F.expr("cast(pmod(xxhash64(text, take), size(w) - take + 1) as int) + 1")
    text = F.when(F.col("take") == 0, F.col("text")).otherwise(F.array_join(F.slice("w", start, F.col("take")), " "))
    got = entropies(models, cut.select("lang", (F.col("take") == 0).alias("whole"), text.alias("text"))).where("n > 0")
    lang = F.expr("element_at(h, cast(array_position(langs, lang) as int))")
    got = got.withColumn("langs", F.array(*map(F.lit, models.langs))).where(F.expr("array_contains(langs, lang)")).withColumn("own", lang)
    norm = {t: F.log(F.expr(f"aggregate(transform(h, x -> exp(-(x - own) * {t}D)), 0D, (s, x) -> s + x)")) for t in TEMPERATURES}
    band = F.least(F.length(F.bin("n")) - 1, F.lit(BANDS - 1))
    stats = got.groupBy("lang", band.alias("band")).agg(
        F.percentile("own", F.lit(SURE)).alias("sure"), F.count(F.lit(1)).alias("n"),
        F.collect_list(F.when(F.col("whole"), F.col("own"))).alias("whole"),  # bounded by the sample
        *(F.sum(F.when(F.col("whole"), x)).alias(f"t{i}") for i, x in enumerate(norm.values())),
    ).collect()
    loss = [sum(r[f"t{i}"] or 0.0 for r in stats) for i in range(len(TEMPERATURES))]
    limit = {}
    for name in {r["lang"] for r in stats}:
        mine = sorted((r for r in stats if r["lang"] == name), key=lambda r: r["band"])
        usual = float(np.median([x for r in mine for x in r["whole"]]))
        known = [r for r in mine if r["n"] >= LEAST] or [max(mine, key=lambda r: r["sure"])]
        # a band with few texts has the limit of the next shorter one, which is no stricter as a rule
        at = [max([i for i, r in enumerate(known) if r["band"] <= b], default=0) for b in range(BANDS)]
        limit[name] = [max(ODD * usual, BEYOND * known[i]["sure"]) for i in at]
    return {"temperature": TEMPERATURES[int(np.argmin(loss))] if stats else 1.0, "limit": limit}


def _limits(models: Models, calibration: dict) -> np.ndarray:
    """Bits per symbol beyond which a text is rejected: row = language, column = length band."""
    return np.array([calibration["limit"].get(x, [np.inf] * BANDS) for x in models.langs])


def _odd(h: np.ndarray, n: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """Texts without a letter, and those beyond the limit of their best language and length."""
    band = np.clip(np.frexp(n.astype(float))[1] - 1, 0, BANDS - 1)
    return (n == 0) | (h.min(1) > limits[h.argmin(1), band])


def entropies(models: Models, rows: DataFrame, calibration: dict | None = None) -> DataFrame:
    """Replace ``text`` by h (bits per symbol under each language) and n (symbols; 0 where there is no letter), and with
    a calibration by whether it is rejected, too."""
    C.ship(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(models)  # bounded by SAMPLE_CHARS and the number of languages
    names = [c for c in rows.columns if c != "text"]
    limits = None if calibration is None else _limits(models, calibration)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value.index()
        for batch in batches:
            for part in C.slices(batch, "text", 2 << 20):
                h, n = own.entropy(part.column("text"))
                more = [] if limits is None else [pa.array(_odd(h, n, limits))]
                yield pa.record_batch([*(part.column(c) for c in names), pa.array(list(h), pa.list_(pa.float64())), pa.array(n), *more], [*names, "h", "n", *["rejected"] * len(more)])

    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in names)
    return rows.mapInArrow(scan, f"{kinds}, h array<double>, n bigint" + (", rejected boolean" if calibration is not None else ""))


def identify(docs: DataFrame, train_on: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", chars: int = SAMPLE_CHARS) -> DataFrame:
    """``id_col``, lang_pred, score (0 to 1), cross_entropy, rejected of every row.

    Languages are learned from the rows for which ``train_on`` holds and whose label is not null. A text that is null
    or has no letter is ``und`` with score 0, and rejected; so is every text if nothing was learned. On a tie the
    language that sorts first wins. A rejected text keeps its best language in lang_pred. Null and repeated ids keep a
    row each; other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    models, cal = fit(docs.where(train_on).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")), chars)
    if models is None:
        return rows.select(F.col("id").alias(id_col), F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(None).cast("double").alias("cross_entropy"), F.lit(True).alias("rejected"))
    got = entropies(models, rows, cal).withColumn("best", F.array_min("h"))
    some = F.col("n") > 0
    lang = F.element_at(F.array(*map(F.lit, models.langs)), F.array_position("h", F.col("best")).cast("int"))
    score = 1 / F.expr(f"aggregate(transform(h, x -> exp(-(x - best) * {cal['temperature']}D)), 0D, (s, x) -> s + x)")
    got = got.withColumns({"lang_pred": F.when(some, lang).otherwise(F.lit(UNDETERMINED)), "score": F.when(some, score).otherwise(F.lit(0.0))})
    return got.select(F.col("id").alias(id_col), "lang_pred", "score", F.when(some, F.col("best")).alias("cross_entropy"), "rejected")


def filter_rows(docs: DataFrame, train_on: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", chars: int = SAMPLE_CHARS) -> DataFrame:
    """The rows of ``docs`` that ``identify`` does not reject, with all their columns; no row is shuffled or joined."""
    models, cal = fit(docs.where(train_on).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")), chars)
    if models is None:
        return docs.where(F.lit(False))
    shared = docs.sparkSession.sparkContext.broadcast(models)
    limits = _limits(models, cal)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value.index()
        for batch in batches:
            for part in C.slices(batch, text_col, 2 << 20):
                h, n = own.entropy(part.column(text_col))
                yield part.filter(pa.array(~_odd(h, n, limits)))

    return docs.mapInArrow(scan, docs.schema)
