import hashlib
import random
import re

import numpy as np
import pytest

from duetlog.llm import debruijn, queries
from duetlog.llm.common import read, word_hashes, word_spans, string_buffers
from .conftest import SF01

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window):
    """(doc_id, n_words, n_removed, kept_sha256) by one dictionary of windows."""
    words = [(i if i is not None else 1 << 62, WORD.findall(t or "")) for i, t in rows]
    first = {}
    for i, w in words:
        for s in range(len(w) - window + 1):
            k = tuple(w[s: s + window])
            first[k] = min(first.get(k, (i, s)), (i, s))
    out = []
    for (i, t), (order, w) in zip(rows, words):
        gone = set()
        for s in range(len(w) - window + 1):
            if first[tuple(w[s: s + window])] < (order, s):
                gone.update(range(s, s + window))
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def rows(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()), key=repr)


def test_whole_table_equals_brute_force(spark):
    docs = read(spark, SF01, "documents")
    got = rows(queries.QUERIES["op3_de_bruijn_dedup"](spark, SF01))
    want = brute([(r.doc_id, r.text) for r in docs.collect()], 20)
    assert got == want and sum(r[2] for r in want) > 10000


@pytest.mark.parametrize("seed", [1, 2])
def test_dense_repeats(spark, seed):
    rng = random.Random(seed)
    texts = []
    for i in range(120):
        if texts and rng.random() < 0.4:               # parts of earlier texts, glued
            text = []
            for _ in range(rng.randint(1, 3)):
                w = rng.choice(texts)
                a = rng.randrange(len(w) + 1)
                text += w[a: a + rng.randint(0, 40)]
        else:
            text = [rng.choice("abcd") for _ in range(rng.randint(0, 60))]
        texts.append(text)
    ids = list(range(120))
    rng.shuffle(ids)
    data = [(i, "  ".join(t)) for i, t in zip(ids, texts)]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(5)
    assert rows(debruijn.removed(df, 6, 3)) == brute(data, 6)


def test_hot_passage_and_periodic_texts(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    data = [(i, f"own{i} words{i} {passage} tail{i}") for i in range(60)]
    data += [(100 + i, "line of words again " * (5 + 40 * i)) for i in range(4)] + [(200, passage)]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(6)
    assert rows(debruijn.removed(df)) == brute(data, 20)


def test_odd_rows(spark, odd_docs, no_docs):
    data = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert rows(debruijn.removed(odd_docs)) == brute(data, 20)
    assert debruijn.removed(no_docs).count() == 0
    kept = debruijn.removed(odd_docs, with_text=True)
    assert all(hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256 for r in kept.collect())


def test_same_id_with_other_text_is_not_cut_at_wrong_places(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(40)) for c in "ab")
    none = debruijn.removed(spark.createDataFrame([(None, a), (None, b), (None, a + " x"), (3, b)], "doc_id long, text string"))
    by = sorted((r.n_words, r.n_removed) for r in none.collect())
    assert [n for n, _ in by] == [40, 40, 40, 41] and sum(r for _, r in by) == 80    # one of the two a texts, and b without an id
    data = [(1, a), (5, a), (5, b)]
    got = rows(debruijn.removed(spark.createDataFrame(data, "doc_id long, text string")))
    assert got == brute(data, 20)


def test_paths_cover_every_edge_once():
    import pyarrow as pa
    rng = random.Random(0)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 300))) for _ in range(40)]
    off, data = string_buffers(pa.array(texts))
    s, e, bounds = word_spans(off, data)
    p = debruijn.paths(word_hashes(data, s, e), bounds)
    seen = sorted((t, x) for t, a, n in zip(p.text, p.start, p.size) for x in range(a, a + n))
    assert seen == [(i, x) for i, t in enumerate(texts) for x in range(max(0, len(t.split()) - 19))]
    assert p.size.max() <= debruijn.WINDOW - debruijn.ANCHOR + 1
    flat = np.concatenate([word_hashes(*[np.frombuffer(w.encode(), np.uint8), np.array([0]), np.array([len(w)])])
                           for t in texts for w in t.split()])
    assert np.array_equal(flat, word_hashes(data, s, e))


def thue_morse(n, letters):
    return "".join(letters[bin(i).count("1") % 2] for i in range(n))


def test_colliding_words_are_compared_with_the_source(spark):
    # a sequence and its complement collide for every polynomial hash modulo 2**64 with an odd radix
    a, b = thue_morse(2048, "ab"), thue_morse(2048, "ba")
    raw = [np.frombuffer(w.encode(), np.uint8) for w in (a, b)]
    one, two = (word_hashes(r, np.array([0]), np.array([len(r)]))[0] for r in raw)
    assert a != b and one == two
    around = [f"w{i}" for i in range(40)]
    texts = [" ".join(around[:20] + [x] + around[20:]) for x in (a, b)]
    data = [(1, texts[0]), (2, " ".join(around[:19] + [b] + around[21:]).replace("w", "v")),
            (3, " ".join(around[:19] + [a] + around[21:]).replace("w", "v")), (4, texts[0])]
    df = spark.createDataFrame(data, "doc_id long, text string")
    assert rows(debruijn.removed(df)) == brute(data, 20)          # only the true copy goes
    pair = [(1, texts[0]), (2, texts[1])]
    assert [r[2] for r in rows(debruijn.removed(spark.createDataFrame(pair, "doc_id long, text string")))] == [0, 0]


def test_only_unbranched_links_compact(spark):
    link = spark.createDataFrame(
        [(1, 0, 5, 10, 11, True), (1, 5, 5, 11, 12, True), (1, 10, 5, 12, None, False),
         (2, 0, 5, 10, 11, True), (2, 5, 5, 11, 13, False), (2, 10, 5, 13, None, False)],
        "doc long, start int, size int, node long, next long, onward boolean")
    assert [r.node for r in debruijn.unbranched(link).collect()] == [10]      # 11 goes on to 12 and to 13
    nodes = spark.createDataFrame([(n, bytes([n])) for n in (10, 11, 12, 13)], "node long, digest binary")
    got = {(r.doc, r.start): [p.size for p in r.parts] for r in debruijn.compacted(link, nodes).collect()}
    assert got == {(1, 0): [5, 5], (1, 10): [5], (2, 0): [5, 5], (2, 10): [5]}
