"""SentencePiece encoding by forward filtering and backward sampling, and
lossless decoding.

The lattice of a text has an arc for every vocabulary piece that matches
somewhere.  Forward filtering sums the weight of all segmentations up to
every place; backward sampling then walks from the end, choosing each arc with
its exact posterior probability, so a segmentation is drawn in proportion to
the product of its pieces' probabilities.  The draws are a counter-based hash
of the row key, so the same row always gets the same pieces, on any machine,
in any order; another ``seed`` gives another sample.

A piece never crosses a line break, and white-space marks only stand at its
start or make up all of it, so the lattice falls apart at every run of spaces
and line break: equal stretches share one filtered lattice per slice, and all
walks of a slice step together in numpy.  Characters without a piece are
spelt in byte pieces, which makes decoding exact for every text.

The vocabulary is a public tokenizer's file, given by path and read on the
driver; it has ranks instead of probabilities, which are set by Zipf's law.

Defined results: null and empty texts have no pieces (decoded as empty);
a row without a key is seeded by its text; repeated rows get equal pieces;
texts of any length are encoded whole, in memory linear in the longest text.
Extra columns are passed by.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructField, StructType

from .common import column, mixed, slices, task

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
SEED = 1
#: Exponent on the piece probabilities: above 1 sharper, below 1 flatter.
SHARPNESS = 1.0

#: Text whose lattices a task holds at once.
SLICE_BYTES = 1 << 20

_MARK = "▁"
_ESCAPED = "\ud800"              # stands for a mark character of the text itself; no valid text holds it
_SEGMENT = re.compile(f"\n|{_MARK}+[^{_MARK}\n]*|[^{_MARK}\n]+")
_U = np.uint64


class Vocabulary(NamedTuple):
    pieces: tuple[str, ...]
    ranks: tuple[float, ...]     # 0 for the most frequent piece
    byte_first: int              # id of the piece of byte 0; the others follow


def load(path: str = MODEL_PATH) -> Vocabulary:
    """Read a SentencePiece model file (with byte pieces)."""
    import sentencepiece
    m = sentencepiece.SentencePieceProcessor(model_file=path)
    n = m.get_piece_size()
    special = [m.is_control(i) or m.is_unknown(i) or m.is_unused(i) or m.is_byte(i) for i in range(n)]
    order = sorted((i for i in range(n) if not special[i]), key=lambda i: (-m.get_score(i), i))
    rank = {i: r for r, i in enumerate(order)}
    first = next(i for i in range(n) if m.is_byte(i))
    if [m.id_to_piece(first + b) for b in range(256)] != [f"<0x{b:02X}>" for b in range(256)]:
        raise ValueError("the vocabulary needs one piece per byte, in order")
    return Vocabulary(tuple("" if special[i] else m.id_to_piece(i) for i in range(n)),
                      tuple(float(rank.get(i, -1)) for i in range(n)), first)


class Codec:
    """Lattices and walks over one vocabulary."""

    def __init__(self, vocabulary: Vocabulary, sharpness: float = SHARPNESS) -> None:
        self.v = vocabulary
        ranks = np.array(vocabulary.ranks)
        real = ranks >= 0
        weight = np.where(real, 1.0 / (ranks + 2.7), 0.0)
        weight[~real] = weight[real].min() / 8          # byte pieces
        self.log_p = sharpness * np.log(weight / weight.sum())
        self._trie(vocabulary.pieces)
        spelt = [p.replace(_MARK, " ").encode() for p in vocabulary.pieces]
        for b in range(256):
            spelt[vocabulary.byte_first + b] = bytes([b])
        self.flat = np.frombuffer(b"".join(spelt), np.uint8)
        self.length = np.array([len(s) for s in spelt], np.int64)
        self.start = np.cumsum(self.length) - self.length

    # ---- lattice

    def _trie(self, pieces: tuple[str, ...]) -> None:
        """The pieces as a trie: ``child[node, class of the next character]``
        (0 where there is none) for the nodes that have children; class 0
        stands for every character that no piece holds."""
        letters = sorted({c for p in pieces for c in p})
        self.letters = np.array([ord(c) for c in letters], np.int64)
        class_of = {c: i + 1 for i, c in enumerate(letters)}
        edges: dict[tuple[int, int], int] = {}
        self.piece_at = [-1, -1]                # by node; node 0 is none, node 1 the root
        inner = {1}
        for i, p in enumerate(pieces):
            node = 1
            for n, c in enumerate(p):
                got = edges.get((node, class_of[c]))
                if got is None:
                    got = edges[node, class_of[c]] = len(self.piece_at)
                    self.piece_at.append(-1)
                if n < len(p) - 1:
                    inner.add(got)
                node = got
            if p:
                self.piece_at[node] = i
        self.piece_at = np.array(self.piece_at, np.int64)
        # the root has every letter; below it only a few classes occur: number those densely
        deep = sorted({k for (n, k) in edges if n != 1})
        self.root = np.zeros(len(letters) + 1, np.int64)
        self.narrow = np.zeros(len(letters) + 1, np.int64)
        self.narrow[deep] = np.arange(len(deep)) + 1
        self.inner = np.zeros(len(self.piece_at), np.int64)
        below = sorted(inner - {1})
        self.inner[below] = np.arange(len(below)) + 1
        self.child = np.zeros((len(below) + 1, len(deep) + 1), np.int32)
        for (n, k), to in edges.items():
            if n == 1:
                self.root[k] = to
            else:
                self.child[self.inner[n], self.narrow[k]] = to

    def lattices(self, segments: list[str]):
        """(last row, first row) of each segment and, for every arc in row
        order: row + cumulative posterior, row before, piece."""
        sizes = np.array([len(s) for s in segments], np.int64)
        code = np.frombuffer("".join(segments).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        found = np.minimum(np.searchsorted(self.letters, code), len(self.letters) - 1)
        letter = np.where(self.letters[found] == code, found + 1, 0)
        alone = self.piece_at[self.root[letter]] >= 0      # the character is a piece of its own
        # rows: one before each segment's first character and one after each character or byte
        odd = np.flatnonzero(~alone)
        kinds, kind = np.unique(code[odd], return_inverse=True)
        spelt = [_MARK.encode() if chr(c) == _ESCAPED else chr(c).encode() for c in kinds]
        width = np.ones(len(code), np.int64)
        width[odd] = np.array([len(x) for x in spelt], np.int64)[kind] if len(odd) else 0
        begin = np.cumsum(sizes) - sizes
        owner = np.repeat(np.arange(len(segments)), sizes)
        before = np.cumsum(width) - width + owner          # row before each character
        stop = np.repeat(begin + sizes, sizes)             # end of its segment
        after = before + width
        last = after[begin + sizes - 1]
        first = before[begin]
        tail, head, piece = [], [], []
        at = np.arange(len(code))
        node, size = self.root[letter], 1
        while len(at):
            to = at + size
            got = self.piece_at[node]
            hit = got >= 0
            tail.append(after[to[hit] - 1])
            head.append(before[at[hit]])
            piece.append(got[hit])
            go = (self.inner[node] > 0) & (to < stop[at])
            at, node, to = at[go], node[go], to[go]
            node = self.child[self.inner[node], self.narrow[letter[to]]].astype(np.int64)
            at, node, size = at[node > 0], node[node > 0], size + 1
        for k in range(max((len(x) for x in spelt), default=0)):
            byte = np.array([x[k] if k < len(x) else -1 for x in spelt], np.int64)[kind]
            here = before[odd[byte >= 0]]
            tail.append(here + k + 1)
            head.append(here + k)
            piece.append(self.v.byte_first + byte[byte >= 0])
        narrow = [np.concatenate(x, dtype=np.int32) for x in (tail, head, piece)]      # a slice has far fewer than 2**31 rows
        del tail, head, piece, at, node, got, to, go, hit, owner, stop, before, after, letter, found, alone, code
        return self._filtered(*narrow, first, last, int(last[-1]) + 1)

    def _filtered(self, tail, head, piece, first, last, rows):
        order = np.argsort(tail, kind="stable")
        tail, head, piece = tail[order], head[order], piece[order]
        width = np.zeros(rows + 1, np.int64)
        width[1:] = np.bincount(tail, minlength=rows)
        at = np.cumsum(width)                             # arcs into row r: at[r]:at[r + 1]
        place = np.arange(rows) - np.repeat(first, np.append(first[1:], rows) - first)
        by_place = np.argsort(place, kind="stable")         # every row but a segment's first has an arc
        ends = np.cumsum(np.bincount(place))
        alpha, share = np.zeros(rows), np.empty(len(piece))
        for p in range(1, len(ends)):                     # all segments' p-th places at once
            r = by_place[ends[p - 1]: ends[p]]
            n = at[r + 1] - at[r]
            group = np.cumsum(n) - n
            arcs = np.arange(int(n.sum())) + np.repeat(at[r] - group, n)
            w = alpha[head[arcs]] + self.log_p[piece[arcs]]
            top = np.maximum.reduceat(w, group)
            e = np.exp(w - np.repeat(top, n))
            total = np.add.reduceat(e, group)
            alpha[r] = top + np.log(total)
            e /= np.repeat(total, n)
            share[arcs] = e
        # cumulative share inside each row, then the row's number added: one sorted array for all draws
        mass = np.cumsum(share)
        mass -= np.where(at[tail] > 0, mass[np.maximum(at[tail] - 1, 0)], 0.0)
        np.minimum(mass, 1.0, out=mass)
        mass[at[1:][width[1:] > 0] - 1] = 1.0              # the last arc into a row, whatever the rounding
        mass += tail
        return last, first, mass, head, piece

    # ---- walks

    def encode(self, texts: list[str], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds): the pieces of text i are ``ids[bounds[i]:bounds[i + 1]]``."""
        number: dict[str, int] = {}
        codes, counts = [], []
        for t in texts:
            if not t:
                counts.append(0)
                continue
            t = _MARK + (t.replace(_MARK, _ESCAPED) if _MARK in t else t).replace(" ", _MARK)
            found = _SEGMENT.findall(t)
            counts.append(len(found))
            codes += [number.setdefault(s, len(number)) for s in found]
        counts = np.array(counts, np.int64)
        if not codes:
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        last, first, mass, head, piece = self.lattices(list(number))
        codes = np.array(codes, np.int64)
        bounds = np.cumsum(counts) - counts
        local = np.arange(len(codes)) - np.repeat(bounds, counts)
        key = mixed(np.repeat(keys, counts) + local.astype(np.uint64) * _U(0x9E3779B97F4A7C15))
        state, stop = last[codes], first[codes]
        active, steps = np.argsort(codes, kind="stable"), []     # equal segments walk side by side: near memory
        taken = np.zeros(len(codes), np.int64)
        while len(active):
            turn = _U(0xD1B54A32D192ED03 * (len(steps) + 1) % (1 << 64))
            u = (mixed(key[active] + turn) >> _U(11)).astype(np.float64) * 2.0 ** -53
            arc = np.searchsorted(mass, state[active] + u, side="right")
            arc = np.minimum(arc, len(mass) - 1)
            steps.append((active, piece[arc]))
            taken[active] += 1
            state[active] = head[arc]
            active = active[head[arc] > stop[active]]
        end = np.cumsum(taken)
        ids = np.empty(int(end[-1]), np.int32)
        for n, (who, what) in enumerate(steps):           # walks run backwards
            ids[end[who] - 1 - n] = what
        doc_end = np.concatenate([[0], end])[np.concatenate([[0], np.cumsum(counts)])]
        return ids, doc_end

    def spell(self, ids: np.ndarray) -> bytes:
        """The bytes that pieces stand for (each text with its leading space)."""
        n = self.length[ids]
        to = np.cumsum(n)
        if not len(to):
            return b""
        return self.flat[np.arange(int(to[-1])) + np.repeat(self.start[ids] - (to - n), n)].tobytes()

    def decode(self, ids) -> str:
        return self.spell(np.asarray(ids, np.int64))[1:].decode()


_CODECS: dict[int, Codec] = {}


def _codec(vocabulary: Vocabulary, sharpness: float) -> Codec:
    """One codec a worker: building it costs more than a batch."""
    key = hash((vocabulary, sharpness))
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(vocabulary, sharpness)
    return _CODECS[key]


def row_keys(ids: list, texts: list[str | None], seed: int) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(b"t" + (t or "").encode() if i is None else b"i%d" % i, seed)
                     for i, t in zip(ids, texts)], dtype=np.uint64)


def encoded(df: DataFrame, vocabulary: Vocabulary, seed: int = SEED, with_ids: bool = True) -> DataFrame:
    """(doc_id, n_pieces, n_byte_pieces, ids_sha256, lossless[, piece_ids]):
    one row per row of ``df``; the hash is over the ids as little-endian
    32-bit numbers, ``lossless`` that decoding gives the text back."""
    first = vocabulary.byte_first
    names = ["doc_id", "n_pieces", "n_byte_pieces", "ids_sha256", "lossless", *["piece_ids"] * with_ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(vocabulary, SHARPNESS)
        for b in slices(batches, "t", SLICE_BYTES):
            texts = b.column(1).to_pylist()
            ids, bounds = codec.encode(texts, row_keys(b.column(0).to_pylist(), texts, seed))
            spelt = codec.spell(ids)
            place = np.concatenate([[0], np.cumsum(codec.length[ids])])[bounds]
            as_bytes = ((ids >= first) & (ids < first + 256)).astype(np.int64)
            n_bytes = np.concatenate([[0], np.cumsum(as_bytes)])[bounds]
            raw = ids.astype("<i4").tobytes()
            digests, lossless = [], []
            for i, t in enumerate(texts):
                digests.append(hashlib.sha256(raw[4 * bounds[i]: 4 * bounds[i + 1]]).hexdigest())
                lossless.append(spelt[place[i]: place[i + 1]] == (b" " + t.encode() if t else b""))
            out = [b.column(0), pa.array(np.diff(bounds)), pa.array(np.diff(n_bytes)), pa.array(digests, pa.string()),
                   pa.array(lossless)]
            if with_ids:
                out.append(pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids)))
            yield pa.RecordBatch.from_arrays(out, names=names)

    schema = "doc_id long, n_pieces long, n_byte_pieces long, ids_sha256 string, lossless boolean"
    return df.select(column(df, "doc_id").cast("long").alias("doc_id"), column(df, "text").cast("string").alias("t")).mapInArrow(
        task(run), schema + (", piece_ids array<int>" if with_ids else ""))


def decoded(df: DataFrame, vocabulary: Vocabulary, *keep: str) -> DataFrame:
    """(columns ``keep``, text) of rows with ``piece_ids``; ``doc_id`` alone
    is kept where none is named."""
    keep = keep or ("doc_id",)
    names = [*keep, *["piece_ids"] * ("piece_ids" not in keep)]
    at = names.index("piece_ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(vocabulary, SHARPNESS)
        for whole in batches:
            sizes = pc.fill_null(pc.list_value_length(whole.column(at)), 0).to_numpy(zero_copy_only=False)
            done = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
            row = 0
            while row < whole.num_rows:                   # a bounded number of pieces at once, no row cut
                to = max(int(np.searchsorted(done, done[row] + SLICE_BYTES, side="right")) - 1, row + 1)
                b = whole.slice(row, to - row)
                ids = b.column(at).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                spelt = codec.spell(ids)
                place = np.concatenate([[0], np.cumsum(codec.length[ids])])[done[row: to + 1] - done[row]]
                texts = [spelt[i + 1: j].decode() for i, j in zip(place[:-1], place[1:])]
                yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array(texts, pa.string())], names=[*keep, "text"])
                row = to

    rows = df.select(*[column(df, n) for n in names])
    return rows.mapInArrow(task(run), StructType([*rows.schema.fields[: len(keep)], StructField("text", StringType())]))
