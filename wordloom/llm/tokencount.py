"""Token counts with a whole-token shortcut.

Offline, once per vocabulary, the driver lets the library encode every vocabulary
string alone; those that come out as one token are *proven*, and that set, as
large as the vocabulary at most, goes to the workers. A text is then split
into pre-tokens, proven ones count as one token each, and only the distinct rest
of a batch is merged by the library. A pre-token's merges do not look beyond it,
and a pre-token encoded alone is one pre-token again, so the counts are the
library's own for the whole text.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm import common as C

#: fixed values: the pre-token pattern of byte-level vocabularies, with the class of white space that the library's
#: regular expressions use spelled out
_SPACE = r"\t\n\x0b\x0c\r\x20\x85\xa0  -     　"
PRETOKEN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
CACHE = 200_000  # pre-tokens whose counts a task remembers
AT_ONCE = 1_000  # pre-tokens encoded in one call, whose whole encodings are held


def proven_tokens(tokenizer) -> frozenset[str]:
    """Vocabulary strings that the library encodes alone as exactly one token."""
    ids = sorted(tokenizer.get_vocab(with_added_tokens=False).values())
    strings = [s for s in tokenizer.decode_batch([[i] for i in ids]) if "\ufffd" not in s]
    return frozenset(s for s, e in zip(strings, tokenizer.encode_batch(strings, add_special_tokens=False)) if len(e.ids) == 1)


class Vocabulary:
    """A vocabulary file and its proven strings. A worker builds its tokenizer once, for all of its tasks."""

    def __init__(self, model: str) -> None:
        self.model = model
        self.proven = proven_tokens(self.tokenizer)

    @cached_property
    def tokenizer(self):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task is one core; threads have memory of their own
        return Tokenizer.from_str(self.model)

    def __getstate__(self) -> dict:
        return {"model": self.model, "proven": self.proven}


def count_tokens(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 512) -> DataFrame:
    """``id_col``, n_bytes, n_tokens, n_shortcut (tokens counted without merging), over_limit of every row.

    The vocabulary must be byte-level without a prefix space, and its added tokens must stand for their own strings alone
    (none that takes white space beside it, or matches whole words only); others are refused. Null and empty texts have no tokens. Strings of special
    tokens inside a text are special tokens, the library's default. Whole texts are counted; one without spaces is a
    single pre-token and is merged as such. Repeated or null ids keep a row each.
    """
    C.ship(docs.sparkSession)
    with open(model_path) as f:
        model = f.read()
    spec = json.loads(model)
    pre = spec.get("pre_tokenizer") or {}
    if (pre.get("type"), pre.get("add_prefix_space"), spec.get("normalizer")) != ("ByteLevel", False, None):
        raise ValueError(f"{model_path}: not a plain byte-level vocabulary")
    added = spec.get("added_tokens", [])
    if any(t.get(flag) for t in added for flag in ("lstrip", "rstrip", "single_word")):
        raise ValueError(f"{model_path}: an added token matches more or less than its own string")
    specials = [t["content"] for t in added]
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary(model))  # the file and its strings, of fixed size

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        tok, proven = vocabulary.value.tokenizer, vocabulary.value.proven
        split = regex.compile(PRETOKEN).findall
        marks = regex.compile("|".join(map(regex.escape, sorted(specials, key=len, reverse=True)))) if specials else None
        known: dict[str, int] = {}
        for batch in batches:
            texts = batch.column("text").to_pylist()
            n_tokens, n_short, rests = [], [], []
            for t in texts:
                found = marks.findall(t or "") if marks else []
                pieces = [p for s in (marks.split(t) if found else [t or ""]) for p in split(s)]
                rest = [p for p in pieces if p not in proven]
                n_short.append(len(pieces) - len(rest))
                n_tokens.append(n_short[-1] + len(found))
                rests.append(rest)
            new = list({p for rest in rests for p in rest if p not in known})
            if len(known) + len(new) > CACHE:
                known = {}
                new = list({p for rest in rests for p in rest})
            for at in range(0, len(new), AT_ONCE):
                part = new[at : at + AT_ONCE]
                known.update(zip(part, (len(e.ids) for e in tok.encode_batch(part, add_special_tokens=False))))
            n_tokens = [n + sum(map(known.__getitem__, rest)) for n, rest in zip(n_tokens, rests)]
            size = [len((t or "").encode()) for t in texts]
            yield pa.record_batch([batch.column("id"), pa.array(size, pa.int64()), pa.array(n_tokens, pa.int64()), pa.array(n_short, pa.int64())], ["id", "n_bytes", "n_tokens", "n_shortcut"])

    def sliced(batches):
        return scan(part for batch in batches for part in C.slices(batch, "text"))

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = rows.mapInArrow(sliced, f"id {rows.schema['id'].dataType.simpleString()}, n_bytes bigint, n_tokens bigint, n_shortcut bigint")
    return out.withColumnRenamed("id", id_col).withColumn("over_limit", F.col("n_tokens") > limit)
