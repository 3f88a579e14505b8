import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest

from duetlog.llm import pieces, queries
from duetlog.llm.common import read
from .conftest import SF001

V = pieces.load()
C = pieces.Codec(V)


def keys(n, start=0):
    return np.arange(start, start + n, dtype=np.uint64)


def segmentations(text):
    """All segmentations of a text and their probabilities, by recursion."""
    index = {p: i for i, p in enumerate(V.pieces) if p}
    marked = "▁" + text.replace("▁", "\0").replace(" ", "▁")

    def walk(at):
        if at == len(marked):
            yield (), 0.0
            return
        arcs = [((index[marked[at:j]],), j) for j in range(at + 1, len(marked) + 1) if marked[at:j] in index]
        if marked[at] not in index:
            raw = "▁".encode() if marked[at] == "\0" else marked[at].encode()
            arcs.append((tuple(V.byte_first + b for b in raw), at + 1))
        for ids, j in arcs:
            for rest, lp in walk(j):
                yield ids + rest, lp + sum(C.log_p[i] for i in ids)
    out = {ids: math.exp(lp) for ids, lp in walk(0)}
    total = sum(out.values())
    return {k: v / total for k, v in out.items()}


@pytest.mark.parametrize("text", ["the cat", "a  b", "thé ▁x", "漢\n字a", " "])
def test_samples_follow_the_exact_posterior(text):
    want = segmentations(text)
    n = 20000
    ids, bounds = C.encode([text] * n, keys(n))
    got = Counter(tuple(ids[bounds[i]: bounds[i + 1]].tolist()) for i in range(n))
    assert set(got) <= set(want)
    for k, p in want.items():
        assert abs(got[k] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-3, (k, p, got[k] / n)


def test_lossless_and_reproducible():
    rng = random.Random(4)
    texts = ["".join(rng.choice(["a", "the", " ", "  ", "\n", "\t", "▁", "é", "漢", "😀", "\0", "\r\n", "ing", "ﬁ", ""])
                     for _ in range(rng.randint(0, 60))) for _ in range(500)]
    texts += ["", " ", "\n", "▁", "x" * 50000, " " * 20000]
    ids, bounds = C.encode(texts, keys(len(texts)))
    for i, t in enumerate(texts):
        mine = ids[bounds[i]: bounds[i + 1]]
        assert (C.decode(mine) if len(mine) else "") == t
        alone, _ = C.encode([t], keys(1, i))             # whatever else is in the batch
        assert alone.tolist() == mine.tolist()
    other, _ = C.encode(texts, keys(len(texts), 10**6))
    assert other.tolist() != ids.tolist()


def test_whole_table(spark):
    docs = read(spark, SF001, "documents")
    got = {r.doc_id: r for r in queries.QUERIES["op6_piece_sampling"](spark, SF001).collect()}
    assert len(got) == docs.count() and all(r.lossless for r in got.values())
    full = pieces.encoded(docs, V)
    for r in full.collect():
        raw = np.array(r.piece_ids, "<i4").tobytes()
        assert hashlib.sha256(raw).hexdigest() == got[r.doc_id].ids_sha256 and len(r.piece_ids) == got[r.doc_id].n_pieces
    back = {r.doc_id: r.text for r in pieces.decoded(full, V).collect()}
    assert back == {r.doc_id: r.text for r in docs.collect()}
    assert {r.ids_sha256 for r in pieces.encoded(docs, V, seed=2).collect()} != {r.ids_sha256 for r in got.values()}


def test_odd_rows(spark, odd_docs, no_docs):
    got = pieces.encoded(odd_docs.withColumn("piece_ids", odd_docs["key"]), V).collect()
    assert len(got) == odd_docs.count() and all(r.lossless for r in got)
    by = {r.doc_id: r for r in got}
    assert by[3].n_pieces == by[4].n_pieces == 0 and by[3].piece_ids == []
    twice = [tuple(r.piece_ids) for r in got if r.doc_id == 7]
    assert twice[0] == twice[1]
    assert pieces.encoded(no_docs, V).count() == 0


def test_query_returns_pieces_and_decoded_text(spark):
    texts = {r.doc_id: r.text for r in read(spark, SF001, "documents").collect()}
    got = queries.QUERIES["op6_piece_sampling"](spark, SF001).collect()
    assert len(got) == len(texts)
    for r in got:
        assert len(r.piece_ids) == r.n_pieces and C.decode(r.piece_ids) == r.text == texts[r.doc_id]


def test_decoding_odd_rows(spark, odd_docs, no_docs):
    got = pieces.decoded(pieces.encoded(odd_docs, V), V, "doc_id", "lossless")
    assert got.columns == ["doc_id", "lossless", "text"] and pieces.decoded(pieces.encoded(no_docs, V), V).count() == 0
    assert sorted(map(repr, ((r.doc_id, r.text) for r in got.collect()))) == sorted(
        repr((r.doc_id, r.text or "")) for r in odd_docs.collect())
