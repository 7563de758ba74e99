"""SentencePiece segmentation by Gumbel top-k sampling without replacement, and decoding.

A text's segmentations are the paths of a lattice whose edges are vocabulary
pieces. Pieces never go past the start of a word (a space that follows another
character), so the lattice is a chain of words; each distinct word of a batch
is built and summed once, which gives every edge its probability given its node.
A task keeps the words it has built, up to a number of bytes; beyond that it
keeps those that more than one batch used, and none if these are too many.

Sampling searches the tree of paths best first, with perturbed bounds: the root
has a Gumbel; a child's bound is its share of the parent's mass, perturbed and
conditioned on the parent's bound. Going down always follows the child that has
the parent's own bound; what is left at each node (all other edges) gets the
bound of its mass, truncated there. The search takes the highest bound next, so
the k paths that come out are distinct and are a sample without replacement
in the order of their perturbed log-probabilities. The next bound after the
k-th is the threshold of the inclusion scores.

All draws are hashes of (seed, row key, sample, word, step): a row gets the same
segmentations in any batch, partition or retry.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from wordloom.llm import common as C

SPACE = "▁"
_MARK = np.frombuffer(SPACE.encode(), np.uint8)
_BITS = 20
_STEP = np.uint64(0x9E3779B97F4A7C15)
_ALL = (1 << 64) - 1


@dataclass
class Vocabulary:
    """Pieces by id; log-probabilities are normalised over the pieces that can be sampled."""

    strings: list[str]  # what each id decodes to; byte pieces are "" here
    byte_ids: np.ndarray  # id of each byte's piece, or -1
    ids: np.ndarray  # ids that the lattice may use, in the order of their hashes
    hashes: np.ndarray  # not finalised
    logp: np.ndarray
    byte_logp: float
    longest: int  # code points
    unknown: int
    prefix: bool

    @property
    def short(self) -> int:
        """Bytes of a word whose least likely segmentation is still a normal number."""
        return int(700 / -min(float(self.logp.min()), self.byte_logp))

    @staticmethod
    def load(path: str, alpha: float = 1.0) -> "Vocabulary":
        """Read a ``.model`` file of type unigram or BPE. A unigram piece weighs exp(alpha * score); a BPE piece, whose
        score is its rank, rank ** -alpha. Only models that leave characters as they are can be used."""
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        proto = pb.ModelProto()
        proto.ParseFromString(sp.serialized_model_proto())
        norm = proto.normalizer_spec
        if norm.name != "identity" or norm.remove_extra_whitespaces or proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError(f"{path}: the model rewrites its input ({norm.name})")
        n = sp.get_piece_size()
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i) for i in range(n)]
        strings = ["" if s else sp.id_to_piece(i) for i, s in enumerate(special)]
        usable = np.array([i for i in range(n) if not special[i]], np.int64)
        if any(SPACE in strings[i].lstrip(SPACE) for i in usable):
            raise ValueError(f"{path}: a piece spans words")
        score = np.array([sp.get_score(int(i)) for i in usable])
        bpe = proto.trainer_spec.model_type == pb.TrainerSpec.BPE
        weight = -alpha * np.log(np.maximum(-score, 0) + 2) if bpe else alpha * score
        total = np.logaddexp.reduce(weight)
        raw = [strings[i].encode() for i in usable]
        ends = np.cumsum([len(r) for r in raw])
        h = C.span_hashes(np.frombuffer(b"".join(raw), np.uint8), ends - [len(r) for r in raw], ends, final=False)
        o = np.argsort(h)
        byte_ids = np.full(256, -1)
        for i in range(n):
            if sp.is_byte(i):
                byte_ids[int(sp.id_to_piece(i)[3:5], 16)] = i
        return Vocabulary(strings, byte_ids, usable[o], h[o], (weight - total)[o], float(weight.min() - total), max(len(strings[i]) for i in usable), sp.unk_id(), norm.add_dummy_prefix)


class _Pieces:
    """Finds hashes among the pieces': by their leading bits, then along the few that share them."""

    def __init__(self, keys: np.ndarray) -> None:
        top = (keys >> np.uint64(64 - _BITS)).astype(np.int64)
        self.keys = keys  # sorted
        self.some = np.zeros(1 << _BITS, bool)
        self.some[top] = True
        self.first = np.searchsorted(top, np.arange(1 << _BITS)).astype(np.int32)
        self.most = int(np.bincount(top).max())

    def find(self, h: np.ndarray) -> np.ndarray:
        """Position of each hash whose leading bits are some key's, or -1."""
        at = self.first[(h >> np.uint64(64 - _BITS)).astype(np.int32)]
        out = np.where(self.keys[at] == h, at, -1)
        for step in range(1, self.most):
            miss = np.flatnonzero(out < 0)
            next_ = np.minimum(at[miss] + step, len(self.keys) - 1)
            ok = self.keys[next_] == h[miss]
            out[miss[ok]] = next_[ok]
        return out


_NARROW = {
    "first": np.int32, "last": np.int32, "to": np.int32, "begin": np.int32, "piece": np.int32, "cond": np.float64, "cum": np.float32, "rest": np.float32,
}


def _spans(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The numbers of many spans, one after another."""
    to = np.cumsum(n)
    return np.arange(to[-1] if len(to) else 0) + np.repeat(start - to + n, n)


def _cut(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return data[_spans(start, end - start)]


class _Lattice:
    """Edges of distinct words in CSR form by their first node, with conditional probabilities.

    Nodes are character boundaries; a word's first node is ``first[word]`` and its last ``last[word]``, which has no
    edges. A character without a piece of its own has one edge of its byte pieces (or of the unknown piece), whose
    ``piece`` is -1 less its code point.
    """

    def __init__(self, data: np.ndarray, off: np.ndarray, voc: Vocabulary, index: "_Pieces") -> None:
        lead = (data & 0xC0) != 0x80
        at = np.flatnonzero(lead)  # byte of each character
        word = np.searchsorted(off, at, "right") - 1
        chars = np.bincount(word, minlength=len(off) - 1)
        n_words = len(chars)
        self.first = np.cumsum(chars + 1) - chars - 1
        self.last = self.first + chars
        node = np.arange(len(at)) + word  # one more node per word
        end_char = np.cumsum(chars)[word]
        byte_end = np.append(at, len(data))
        rel = np.arange(len(data)) - np.repeat(off[:-1], np.diff(off))
        power, inverse = C.powers(int(np.diff(off).max()) + 1 if n_words else 1)
        p = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(C._BYTE[data] * power[rel], out=p[1:])
        starts, lens, found = [], [], []
        own = np.zeros(len(at), bool)
        n = len(at)
        at_p, at_inv, end_p, room = p[at], inverse[rel[at]], p[byte_end], end_char - np.arange(n)
        live = None
        for k in range(1, min(voc.longest, int(chars.max()) if n_words else 0) + 1):
            if live is None:  # most positions are still inside a word: whole arrays, no look-ups
                h = (end_p[k : n + 1] - at_p[: n + 1 - k]) * at_inv[: n + 1 - k]
                maybe = np.flatnonzero(index.some[(h >> np.uint64(64 - _BITS)).astype(np.int32)] & (room[: n + 1 - k] >= k))
                h = h[maybe]
                if k >= 5:
                    live = np.flatnonzero(room > k)
            else:
                live = live[room[live] >= k]
                h = (end_p[live + k] - at_p[live]) * at_inv[live]
                some = index.some[(h >> np.uint64(64 - _BITS)).astype(np.int32)]
                maybe, h = live[some], h[some]
            hit = index.find(h)
            ok = hit >= 0
            starts.append(maybe[ok])
            lens.append(np.full(int(ok.sum()), k))
            found.append(hit[ok])
            if k == 1:
                own[maybe[ok]] = True
        raw = np.flatnonzero(~own)
        # longer pieces first at each node: they are likelier, so that a draw meets its edge sooner
        start = np.concatenate([*starts[::-1], raw])
        length = np.concatenate([*lens[::-1], np.ones(len(raw), np.int64)])
        piece = np.concatenate([*found[::-1], np.full(len(raw), -1)])
        o = np.argsort(start, kind="stable")  # a few ascending runs
        start, length, piece = start[o], length[o], piece[o]
        self.piece, logp = voc.ids[piece], voc.logp[piece]
        raw = np.flatnonzero(piece < 0)
        if len(raw):
            a, z = at[start[raw]], byte_end[start[raw] + 1]
            spelled = np.frombuffer(_cut(data, a, z).tobytes().decode().encode("utf-32-le"), "<u4")
            self.piece[raw], logp[raw] = -1 - spelled.astype(np.int64), voc.byte_logp * (z - a)
        from_ = node[start]
        self.to = from_ + length
        nodes = len(at) + n_words
        self.begin = np.concatenate(([0], np.cumsum(np.bincount(from_, minlength=nodes))))
        # mass from each node to its word's end, by characters left: every edge leads to fewer. Short words cannot
        # underflow, so their sums need no logarithms
        short = n_words and int(np.diff(off).max()) <= voc.short
        mass = np.exp(logp) if short else logp
        beta = np.ones(nodes) if short else np.zeros(nodes)
        left = (end_char - np.arange(n))[start]
        o = np.argsort(left.astype(np.uint16) if n_words and chars.max() < 1 << 16 else left, kind="stable")
        cut = np.searchsorted(left[o], np.arange(1, int(left.max()) + 2)) if len(left) else np.zeros(1, np.int64)
        for a, z in zip(cut[:-1], cut[1:]):
            e = o[a:z]
            if len(e):
                at_ = from_[e]
                r = C.runs(at_)
                beta[at_[r]] = np.add.reduceat(mass[e] * beta[self.to[e]], r) if short else np.logaddexp.reduceat(mass[e] + beta[self.to[e]], r)
        if short:
            prob = mass * beta[self.to] / beta[from_]
            self.cond = np.log(prob)  # log-probability of each edge given its node
        else:
            self.cond = mass + beta[self.to] - beta[from_]
            prob = np.exp(self.cond)
        # whole numbers of 2**-40: a sum over a node is the same wherever the node is in the batch
        total = np.concatenate(([0], np.cumsum(np.rint(prob * 2.0**40).astype(np.int64))))
        deg = np.diff(self.begin)
        self.cum = (total[1:] - np.repeat(total[self.begin[:-1]], deg)) * 2.0**-40
        with np.errstate(divide="ignore"):  # mass of the node's other edges
            self.rest = np.log(np.where(np.repeat(deg == 1, deg), 0.0, np.maximum(1 - prob, 0)))

    @staticmethod
    def blocks(data: np.ndarray, off: np.ndarray, voc: Vocabulary, index: "_Pieces", limit: int = 1 << 18) -> Iterator["_Lattice"]:
        """Lattices of words that are ordered by length, each of about ``limit`` bytes and kept in narrow types."""
        word = 0
        change = int(np.searchsorted(np.diff(off), voc.short, "right"))  # no word is summed in two ways
        while word < len(off) - 1:
            end = max(word + 1, int(np.searchsorted(off, off[word] + limit, "right")) - 1)
            end = min(end, change) if word < change else end
            b = _Lattice(data[off[word] : off[end]], off[word : end + 1] - off[word], voc, index)
            for name, kind in _NARROW.items():
                setattr(b, name, getattr(b, name).astype(kind))
            yield b
            word = end

    @staticmethod
    def join(blocks: list["_Lattice"]) -> "_Lattice":
        """One lattice of all words of some, in order; empties these."""
        out = _Lattice.__new__(_Lattice)
        nodes = np.cumsum([0] + [len(b.begin) - 1 for b in blocks])
        edges = np.cumsum([0] + [len(b.piece) for b in blocks])
        add = {"first": nodes, "last": nodes, "to": nodes, "begin": edges}
        for name, kind in _NARROW.items():
            parts = [b.__dict__.pop(name)[: -1 if name == "begin" and i + 1 < len(blocks) else None] for i, b in enumerate(blocks)]
            setattr(out, name, np.concatenate([p + kind(add[name][i]) if name in add else p for i, p in enumerate(parts)]))
        return out

    def take(self, words: np.ndarray) -> "_Lattice":
        """The lattice of some of the words."""
        out = _Lattice.__new__(_Lattice)
        first, n = self.first[words].astype(np.int64), (self.last[words] - self.first[words] + 1).astype(np.int64)
        edge, m = self.begin[first].astype(np.int64), (self.begin[first + n - 1] - self.begin[first]).astype(np.int64)
        nodes, edges = _spans(first, n), _spans(edge, m)
        to = np.cumsum(n) - n
        out.first = to.astype(np.int32)
        out.last = (to + n - 1).astype(np.int32)
        out.to = (self.to[edges] + np.repeat(to - first, m)).astype(np.int32)
        out.begin = np.append(self.begin[nodes] + np.repeat(np.cumsum(m) - m - edge, n), m.sum()).astype(np.int32)
        for name in ("piece", "cond", "cum", "rest"):
            setattr(out, name, getattr(self, name)[edges])
        return out

    def node(self, edge: np.ndarray) -> np.ndarray:
        """The node that each edge leaves."""
        return np.searchsorted(self.begin, edge, "right") - 1

    def draw(self, node: np.ndarray, u: np.ndarray) -> np.ndarray:
        """An edge of each node by its probabilities."""
        e, stop = self.begin[node].copy(), self.begin[node + 1] - 1
        live = np.flatnonzero((e < stop) & (self.cum[e] < u))
        while len(live):
            e[live] += 1
            live = live[(e[live] < stop[live]) & (self.cum[e[live]] < u[live])]
        return e


def _sorted(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    o = np.argsort(h, kind="stable")  # two ascending runs
    return h[o], o


def _u(h: np.ndarray) -> np.ndarray:
    return ((C.mix(h) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


class Sampler:
    """Draws k segmentations of each text of a batch."""

    def __init__(self, voc: Vocabulary, k: int, seed: int, keep: int = 3 << 20) -> None:
        self.voc, self.k, self.seed = voc, k, seed
        self.index = _Pieces(voc.hashes)
        self.keep = keep  # bytes of words whose lattice may be kept
        self.lat: _Lattice | None = None
        self.known = np.zeros(0, np.uint64)  # hashes of the lattice's words, in order
        self.place, self.size, self.used = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def load(self, col: pa.Array) -> None:
        """Cut the texts into words; build the lattice of the distinct ones."""
        col = pc.fill_null(col.cast(pa.large_string()), "")
        col = pc.replace_substring(col, " ", SPACE)
        if self.voc.prefix:
            col = pc.if_else(pc.equal(pc.binary_length(col), 0), pa.scalar("", pa.large_string()), pc.binary_join_element_wise(pa.scalar(SPACE, pa.large_string()), col, pa.scalar("", pa.large_string())))
        data, off = C.text_bytes(col)
        mark = np.zeros(len(data) + 3, bool)
        if len(data) > 2:
            mark[3:-2] = (data[:-2] == _MARK[0]) & (data[1:-1] == _MARK[1]) & (data[2:] == _MARK[2])
        begin = mark[3:] & ~mark[:-3]  # a space mark after another character
        begin[off[:-1][np.diff(off) > 0]] = True
        start = np.flatnonzero(begin[: len(data)])
        end = np.append(start[1:], len(data)) if len(start) else start
        self.all_off = np.searchsorted(start, off)  # words of each text
        h = C.span_hashes(data, start, end)
        u, first, back = np.unique(h, return_index=True, return_inverse=True)
        new = np.flatnonzero(C.find(self.known, u) < 0)
        n = (end - start)[first]
        if self.size.sum() + n[new].sum() > self.keep:
            self._forget(int(self.keep - n.sum()))
            new = np.flatnonzero(C.find(self.known, u) < 0)
        new = new[np.argsort(n[new], kind="stable")]  # words of like length together
        s, size = start[first[new]], n[new]
        blocks = _Lattice.blocks(_cut(data, s, s + size), np.concatenate(([0], np.cumsum(size))), self.voc, self.index)
        old = len(self.known)
        parts = [*([self.lat] if old else []), *blocks]
        if len(parts) > 1 or not old:
            self.lat = _Lattice.join(parts) if parts else _Lattice(data[:0], np.zeros(1, np.int64), self.voc, self.index)
        self.known, o = _sorted(np.concatenate((self.known, u[new])))
        self.place = np.concatenate((self.place, np.arange(old, old + len(new), dtype=np.int32)))[o]
        self.size, self.used = np.concatenate((self.size, size))[o], np.concatenate((self.used, np.zeros(len(new), np.int32)))[o]
        at = np.searchsorted(self.known, u)
        self.used[at] += 1
        self.all_words = self.place[at][back]

    def _forget(self, room: int) -> None:
        """Keep the words that more than one batch used, if they fit."""
        keep = self.used > 1
        if self.size[keep].sum() > room:
            keep[:] = False
        o = np.argsort(self.place[keep])
        words = self.place[keep][o]
        self.lat = self.lat.take(words) if len(words) else None
        self.known, self.size, self.used = self.known[keep], self.size[keep], np.minimum(self.used[keep], 1)
        self.place = np.empty(len(words), np.int32)
        self.place[o] = np.arange(len(words))

    def descend(self, occ: np.ndarray, node: np.ndarray, base: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Follow drawn edges from each node to its word's end: (index into occ, step, edge) of every piece."""
        lat, out = self.lat, []
        last = lat.last[self.words[occ]]
        live, step = np.flatnonzero(node < last), 0
        node = node[live]
        while len(live):
            e = lat.draw(node, _u(base[live] + np.uint64(step * int(_STEP) & _ALL)))
            out.append((live, np.full(len(live), step, np.int32), e))
            node = lat.to[e]
            keep = node < last[live]
            live, node, step = live[keep], node[keep], step + 1
        if not out:
            return (np.zeros(0, np.int64),) * 3
        return tuple(np.concatenate(x) for x in zip(*out))  # type: ignore[return-value]

    def sample(self, lo: int, keys: np.ndarray) -> tuple[list["Drawn"], np.ndarray]:
        """k samples of texts ``lo`` and on (one for each key) of the loaded ones, and the next bound of each (-inf
        where no segmentation is left)."""
        lat, n = self.lat, len(keys)
        self.text_off = self.all_off[lo : lo + n + 1] - self.all_off[lo]
        self.words = self.all_words[self.all_off[lo] : self.all_off[lo + n]]
        text_of = np.repeat(np.arange(n), np.diff(self.text_off))
        within = (np.arange(len(text_of)) - self.text_off[:-1][text_of]).astype(np.uint64)
        row = C.pair(C.mix(keys + np.uint64(self.seed)), np.full(n, 77, np.uint64))
        bound = -np.log(-np.log(_u(row)))
        heaps: list[list] = [[] for _ in range(n)]  # (bound, sample, piece, edges that are taken) of open nodes
        out: list[Drawn] = []
        have = np.ones(n, bool)
        occ, node = np.arange(len(text_of)), lat.first[self.words]
        none = np.zeros(0, np.int64)
        kept = (none, none, none)  # text, edge and word of the pieces that a sample shares with the one it left
        for r in range(self.k):
            base = C.pair(row[text_of[occ]] + np.uint64(r + 1), within[occ])
            i, step, edge = self.descend(occ, node, base)
            per = np.bincount(i, minlength=len(occ))
            where = (np.cumsum(per) - per)[i] + step
            count = np.add.reduceat(per, C.runs(text_of[occ])) if len(occ) else per
            own = np.empty((3, len(i)), np.int32)
            own[0] = np.repeat(text_of[occ[C.runs(text_of[occ])]], count) if len(occ) else 0
            own[1, where], own[2, where] = edge, occ[i]
            fresh = np.ones(len(i), bool)
            if r:
                # in each text the shared pieces come first
                mine, theirs = np.bincount(own[0], minlength=n), np.bincount(kept[0], minlength=n)
                first = np.cumsum(mine + theirs) - mine - theirs
                old = np.arange(len(kept[0])) + (first - np.cumsum(theirs) + theirs)[kept[0]]
                new = np.arange(len(i)) + (first + theirs - np.cumsum(mine) + mine)[own[0]]
                both = np.empty((3, len(old) + len(new)), np.int32)
                for a, b, c in zip(both, kept, own):
                    a[old], a[new] = b, c
                fresh = np.zeros(both.shape[1], bool)
                fresh[new] = True
                own = both
            text, edge, word = own
            off = np.searchsorted(text, np.arange(n + 1))
            # whole numbers of 2**-36 again: a text's sums do not depend on the texts before it
            run = np.concatenate(([0], np.cumsum(np.rint(lat.cond[edge] * 2.0**36).astype(np.int64))))
            rest = (run[:-1] - run[off[:-1]][text]) * 2.0**-36 + lat.rest[edge]  # log-mass of the other edges at each piece's node
            open_ = np.flatnonzero(fresh & np.isfinite(rest))
            g = np.full(len(text), -np.inf)
            t = text[open_]
            nth = (open_ - off[t]).astype(np.uint64)
            g[open_] = _truncated(rest[open_], bound[t], _u(row[t] + np.uint64((r + 1) * int(_STEP) & _ALL) + nth * np.uint64(0xD1B54A32D192ED03)))
            out.append(Drawn(edge, word, off, np.where(have, (run[off[1:]] - run[off[:-1]]) * 2.0**-36, np.nan), np.where(have, bound, np.nan)))
            self._push(heaps, g, text, edge, off, r)
            for heap in heaps:
                heap.sort(reverse=True)
            bound = np.array([h[0][0] if h else -np.inf for h in heaps])
            if r + 1 < self.k:
                have = np.isfinite(bound)
                kept, occ, node = self._next(heaps, out, row, r)
        return out, bound

    def _push(self, heaps: list[list], g: np.ndarray, text: np.ndarray, edge: np.ndarray, off: np.ndarray, r: int) -> None:
        """Open the nodes with the highest bounds of each text, as many as can still be taken and one for the threshold."""
        some = np.flatnonzero(np.diff(off))
        for _ in range(self.k - r):
            best = np.full(len(off) - 1, np.inf)
            if len(some):
                best[some] = np.maximum.reduceat(g, off[some])
            hit = np.flatnonzero((g == best[text]) & np.isfinite(g))
            hit = hit[C.runs(text[hit])]
            for t, p, e in zip(text[hit].tolist(), hit.tolist(), edge[hit].tolist()):
                heaps[t].append((float(g[p]), r, p - int(off[t]), (e,)))
            g[hit] = -np.inf

    def _next(self, heaps: list[list], out: list["Drawn"], row: np.ndarray, r: int):
        """Take each text's highest bound: the pieces before that node, another edge there, and the words that follow."""
        lat = self.lat
        text = np.array([t for t, heap in enumerate(heaps) if heap], np.int64)
        if not len(text):
            none = np.zeros(0, np.int64)
            return (none, none, none), none, none
        top = [heaps[t].pop(0) for t in text.tolist()]
        bound, src, at = (np.array([h[i] for h in top]) for i in range(3))
        # what the new sample shares with the one it leaves, and room for the new edge
        to = np.cumsum(at + 1) - at - 1
        edge, word = np.empty((2, int((at + 1).sum())), np.int64)
        for i, s in enumerate(out):
            of = np.flatnonzero(src == i)
            mine, theirs = _spans(to[of], at[of] + 1), _spans(s.off[text[of]], at[of] + 1)
            edge[mine], word[mine] = s.edge[theirs], s.word[theirs]
        new = to + at
        start = lat.node(edge[new])
        # one of the edges of that node that are not taken; whole numbers, so that a row's draw is the same in any batch
        degree = (lat.begin[start + 1] - lat.begin[start]).astype(np.int64)
        others, head = _spans(lat.begin[start].astype(np.int64), degree), np.cumsum(degree) - degree
        gone = np.array([len(h[3]) for h in top])
        free = np.ones(len(others), bool)
        free[np.array([e for h in top for e in h[3]]) + np.repeat(head - lat.begin[start], gone)] = False
        cond = np.where(free, lat.cond[others], -np.inf)
        most = np.maximum.reduceat(cond, head)
        share = np.maximum(np.rint(np.exp(cond - np.repeat(most, degree)) * 2.0**40).astype(np.int64), free)
        run = np.cumsum(share)
        before = run[head] - share[head]
        total = run[head + degree - 1] - before
        u, v = (_u(row[text] + np.uint64(i * 1_000_003 * (r + 1))) for i in (1, 2))
        pick = np.searchsorted(run, before + (u * total).astype(np.int64), "right")
        edge[new] = others[pick]
        # what is left at the node
        steps = np.rint(lat.cond[edge] * 2.0**36).astype(np.int64)
        steps[new] = 0
        path = np.add.reduceat(steps, to) * 2.0**-36
        rest = np.flatnonzero((degree - gone > 1) & np.isfinite(most))
        mass = np.log((total - share[pick])[rest] * 2.0**-40) + most[rest] + path[rest]
        for i, g in zip(rest.tolist(), _truncated(mass, bound[rest], v[rest]).tolist()):
            heaps[text[i]].append((g, top[i][1], top[i][2], (*top[i][3], int(edge[new[i]]))))
        n = self.text_off[text + 1] - word[new]
        occ = _spans(word[new], n)
        node = lat.first[self.words[occ]].astype(np.int64)
        node[np.cumsum(n) - n] = lat.to[edge[new]]
        return (np.repeat(text, at + 1), edge, word), occ, node

    def ids(self, d: "Drawn") -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all texts and their offsets; a character without a piece gives one id per byte."""
        ids, voc = self.lat.piece[d.edge], self.voc
        raw = np.flatnonzero(ids < 0)
        if not len(raw):
            return ids, d.off
        chars = (-1 - ids[raw]).astype("<u4")
        n = np.ones(len(ids), np.int64)
        n[raw] += (chars > 0x7F).astype(np.int64) + (chars > 0x7FF) + (chars > 0xFFFF)
        ids = np.repeat(ids, n)
        spelled = voc.byte_ids[np.frombuffer(chars.tobytes().decode("utf-32-le").encode(), np.uint8)]
        ids[ids < 0] = np.where(spelled >= 0, spelled, voc.unknown)
        return ids, np.concatenate(([0], np.cumsum(n)))[d.off]


@dataclass
class Drawn:
    """One sample of every text: edge and word of each piece, offsets by text, log-probability and perturbed bound of
    each text (NaN where the text has fewer segmentations)."""

    edge: np.ndarray
    word: np.ndarray
    off: np.ndarray
    logp: np.ndarray
    bound: np.ndarray


def _truncated(mu, top, u):
    """A Gumbel at location ``mu``, conditioned on being ``top`` at most."""
    return mu - np.log(np.exp(np.minimum(mu - top, 700.0)) - np.log(u))


def log_inclusion(logp: np.ndarray, threshold: np.ndarray) -> np.ndarray:
    """log(1 - exp(-exp(logp - threshold))): the inclusion score of a segmentation; 0 where nothing was left out."""
    with np.errstate(over="ignore", divide="ignore", invalid="ignore"):
        x = np.exp(np.minimum(logp - threshold, 50.0))
        return np.where(np.isfinite(threshold), np.where(x < 1e-12, logp - threshold, np.log(-np.expm1(-x))), np.where(np.isnan(logp), np.nan, 0.0))


class Decoder:
    """Bytes of each piece id, joined per text."""

    def __init__(self, voc: Vocabulary) -> None:
        raw = [s.replace(SPACE, " ").encode() for s in voc.strings]
        for b, i in enumerate(voc.byte_ids):
            if i >= 0:
                raw[i] = bytes([b])
        self.size = np.array([len(r) for r in raw])
        self.start = np.cumsum(self.size) - self.size
        self.raw, self.prefix = np.frombuffer(b"".join(raw), np.uint8), voc.prefix

    def decode(self, ids: np.ndarray, off: np.ndarray) -> pa.Array:
        """Texts of id sequences; the space before the first word is not part of a text. Byte pieces that are no
        UTF-8 become replacement characters."""
        n = self.size[ids]
        to = np.concatenate(([0], np.cumsum(n)))
        data = self.raw[np.arange(to[-1]) + np.repeat(self.start[ids] - to[:-1], n)]
        cut = to[off]
        if self.prefix:
            full = np.flatnonzero(np.diff(cut))
            lead = np.ones(len(data), bool)
            lead[cut[full]] = data[cut[full]] != 32
            cut = np.concatenate(([0], np.cumsum(lead)))[cut]
            data = data[lead]
        texts = pa.Array.from_buffers(pa.large_binary(), len(off) - 1, [None, pa.py_buffer(cut.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes())])
        try:
            return texts.cast(pa.large_string())
        except pa.ArrowInvalid:
            return pa.array([t.as_py().decode("utf-8", "replace") for t in texts], pa.large_string())


def segment(docs: DataFrame, model_path: str, k: int = 2, seed: int = 0, alpha: float = 1.0, id_col: str = "doc_id", text_col: str = "text", finish=None, schema: str | None = None) -> DataFrame:
    """``id_col`` and k distinct sampled segmentations of every row's text, in the order of their perturbed
    log-probabilities (fewer where the text has fewer; null and empty texts have the empty one).

    ``finish`` may turn the samples of a batch into the columns of ``schema`` inside the task: it gets the texts, the
    (ids, offsets) of each sample, the ``Drawn`` of each, and the thresholds. Rows with equal ids and texts get equal
    samples; a null id is a key of its own. Whole texts are used, whatever their length; other columns are not read.
    """
    C.ship(docs.sparkSession)
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(model_path, alpha))  # the model file's size
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.coalesce(F.xxhash64(F.col(id_col).cast("string")), F.lit(0)).alias("key"))
    schema = schema if finish else SAMPLES
    names = DataType.fromDDL(schema).names

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(vocabulary.value, k, seed)
        if hasattr(finish, "vocabulary"):
            finish.vocabulary(vocabulary.value)  # the one copy of this worker
        for batch in batches:
            for large in C.slices(batch, "text", 3 << 20):  # whose distinct words are built once
                sampler.load(large.column("text"))
                lo = 0
                for part in C.slices(large, "text", 1 << 20):
                    drawn, threshold = sampler.sample(lo, np.array(part.column("key")).view(np.uint64))
                    lo += part.num_rows
                    got = [sampler.ids(d) for d in drawn]
                    yield pa.record_batch([part.column("id"), *(finish or _samples)(part.column("text"), got, drawn, threshold)], ["id", *names])

    return rows.mapInArrow(scan, f"id {rows.schema['id'].dataType.simpleString()}, {schema}").withColumnRenamed("id", id_col)


SAMPLES = "samples array<struct<ids:array<int>,log_prob:double,perturbed:double,log_inclusion:double>>"
DIGEST = "n_samples int, n_pieces array<int>, ids_crc32 array<bigint>, log_prob array<double>, log_inclusion array<double>, decoded boolean"


def _by_text(got: list, drawn: list[Drawn], threshold: np.ndarray) -> tuple[np.ndarray, pa.ListArray, list[np.ndarray]]:
    """Samples in the order of their texts: offsets of the texts, ids of each sample, and its log-probability, perturbed
    bound and inclusion score. What a text has not is left out."""
    n = len(threshold)
    there = ~np.isnan(np.stack([d.logp for d in drawn], axis=1))
    at = np.flatnonzero(there)
    order = at % len(drawn) * n + at // len(drawn)
    base = np.cumsum([0] + [len(ids) for ids, _ in got])
    off = np.concatenate([o[:-1] + b for (_, o), b in zip(got, base)] + [base[-1:]])
    ids = pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(np.concatenate([ids for ids, _ in got]), pa.int32())).take(pa.array(order))
    scores = [[d.logp for d in drawn], [d.bound for d in drawn], [log_inclusion(d.logp, threshold) for d in drawn]]
    return np.concatenate(([0], np.cumsum(there.sum(1)))), ids, [np.concatenate(x)[order] for x in scores]


def _lists(off: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(off, pa.int32()), values)


def _structs(off: np.ndarray, ids: pa.ListArray, scores: list[np.ndarray]) -> pa.Array:
    return _lists(off, pa.StructArray.from_arrays([ids, *map(pa.array, scores)], ["ids", "log_prob", "perturbed", "log_inclusion"]))


def _samples(texts: pa.Array, got: list, drawn: list[Drawn], threshold: np.ndarray) -> list[pa.Array]:
    return [_structs(*_by_text(got, drawn, threshold))]


def checked(voc_path: str):
    """A ``finish`` that gives the samples, and their counts, checksums and scores, after decoding each sample and
    comparing it with the text. ``segment`` hands it the vocabulary that it has; else it is read from ``voc_path``."""
    import zlib

    state: dict = {}

    def finish(texts, got, drawn, threshold):
        if "d" not in state:
            state["d"] = Decoder(Vocabulary.load(voc_path))
        want = pc.replace_substring(pc.fill_null(texts.cast(pa.large_string()), ""), SPACE, " ")
        ok = np.ones(len(threshold), bool)
        for (ids, off), d in zip(got, drawn):
            ok &= np.isnan(d.logp) | np.array(pc.equal(state["d"].decode(ids, off), want))
        off, ids, scores = _by_text(got, drawn, threshold)
        raw, cut = np.asarray(ids.values).tobytes(), (4 * np.asarray(ids.offsets)).tolist()
        crc = pa.array([zlib.crc32(raw[a:z]) for a, z in zip(cut, cut[1:])], pa.int64())
        digest = [_lists(off, x) for x in (pc.list_value_length(ids), crc, pa.array(scores[0]), pa.array(scores[2]))]
        return [_structs(off, ids, scores), pa.array(np.diff(off), pa.int32()), *digest, pa.array(ok)]

    finish.vocabulary = lambda voc: state.setdefault("d", Decoder(voc))  # type: ignore[attr-defined]
    return finish
