import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from duetlog.llm import lexical
from duetlog.llm.common import read, string_buffers
from .conftest import SF01
from .oracle_check import compare

TERM = re.compile(lexical.TERM)


def _terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def _brute(docs, items, top=20):
    """The contract, read literally."""
    bags = [(d, Counter(_terms(t))) for d, t in docs]
    total, length = sum(1 for _, b in bags if b), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for i, text in items:
        found = []
        for d, b in bags:
            m = 75 + (25 * sum(b.values()) * total) // max(length, 1)
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((1000000000 * b[t]) // (1000 * b[t] + 12 * m))
                        for t in _terms(text) if b[t])
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        out += [(i, n, x[3], -x[0]) for n, x in enumerate(sorted(found)[:top], 1)]
    return sorted(out, key=repr)


def test_whole_table_equals_duckdb(spark):
    assert compare("op13_lexical_search", spark, SF01) == 800


def _tables(n_docs=300, n_items=40):
    rng = random.Random(5)
    words = [f"{w}{i}" for i in range(60) for w in ("Ab", "é", "日本", "x")] + ["the", "THE", "a-b", "😀"]
    text = lambda k: "".join(rng.choice(words) + rng.choice([" ", ", ", "_", "\n", "\0", "--"]) for _ in range(rng.randrange(k)))
    return [(i, text(50)) for i in range(n_docs)], [(i, text(12)) for i in range(n_items)]


@pytest.mark.parametrize("rounds", [1, 4])
def test_random_tables_equal_brute_force(spark, rounds):
    docs, items = _tables()
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    size = lexical.item_terms(b).agg(F.sum(F.octet_length("term"))).first()[0]
    got = lexical.ranked(d, b, round_bytes=-(-size // rounds)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == _brute(docs, items)


def test_small_tiles_keep_the_best(spark, monkeypatch):
    docs, items = _tables()
    monkeypatch.setattr(lexical, "TILE", 7)
    got = lexical.ranked(spark.createDataFrame(docs, "doc_id long, text string"),
                         spark.createDataFrame(items, "item_id long, text string"), top=3).collect()
    assert sorted((tuple(r) for r in got), key=repr) == _brute(docs, items, 3)


def test_scan_counts_neighbours_and_boundaries():
    texts = ["the the the", "", "The.theme the", None, "the", "xthe thé THE"]
    n, doc, word, count = lexical.scan(*string_buffers(pa.array(texts)), lexical.automaton(["the", "thé"]))
    assert n.tolist() == [3, 0, 3, 0, 1, 3]
    assert list(zip(doc.tolist(), word.tolist(), count.tolist())) == [(0, 0, 3), (2, 0, 2), (4, 0, 1), (5, 0, 1), (5, 1, 1)]
    assert np.array_equal(lexical.scan(*string_buffers(pa.array(texts)), lexical.automaton([]))[0], n)


def test_odd_rows(spark, odd_docs, no_docs):
    items = [(1, None), (2, ""), (3, "The CAT, the moon"), (None, "word no id"), (5, "zzz unseen"), (6, "a b c é ünïcode"), (6, "a b c é ünïcode"),
             (7, "one two two")]
    b = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, term string")
    clash = odd_docs.withColumn("n", F.lit("x")).withColumn("words", F.lit(1)).withColumn("t", F.lit(2))
    want = _brute([(r.doc_id, r.text) for r in odd_docs.collect()], list(dict.fromkeys(items)))
    assert sorted((tuple(r) for r in lexical.ranked(clash, b).collect()), key=repr) == want
    assert {r[0] for r in want} == {3, None, 6, 7} and any(r[2] is None for r in want)
    assert lexical.ranked(no_docs, b).count() == 0
    assert lexical.ranked(odd_docs, b.limit(0)).count() == 0
    two = spark.createDataFrame([(1, "cat moon"), (1, "sat")], "item_id long, text string")
    one = spark.createDataFrame([(1, "cat moon sat")], "item_id long, text string")
    assert sorted(map(tuple, lexical.ranked(odd_docs, two).collect())) == sorted(map(tuple, lexical.ranked(odd_docs, one).collect()))


def test_every_document_is_scanned_once_a_round(spark):
    counts = lexical.scanned(read(spark, SF01, "documents"), ["the", "of"])
    assert counts.count() == 1000 and "Exchange" not in counts._jdf.queryExecution().toString()
