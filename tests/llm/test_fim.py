import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from duetlog.llm import fim, queries
from duetlog.llm.common import string_buffers
from .conftest import SF01
from .oracle_check import compare

UNIT = re.compile("[ \t-\r]*[^ \t-\r]+|[ \t-\r]+")


def _plain(key, text):
    """The contract, read literally."""
    text = text or ""
    units = UNIT.findall(text)
    h = fim.draws("" if key is None else str(key), 42)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return len(units), "plain", None, None, text
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 80:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def _random_texts(n):
    rng = random.Random(3)
    pieces = ["a", "é", "日本", "😀", " ", "  ", "\n", "\t\x0b", " ", "long" * 90, "<P", "P>", "<", ">", "<S", "<M>"]
    return ["".join(rng.choice(pieces) for _ in range(rng.randrange(60))) for _ in range(n)]


def test_whole_table_equals_duckdb(spark):
    assert compare("op11_fill_in_middle", spark, SF01) == 1000


def test_random_texts_equal_the_plain_form(spark):
    rows = list(enumerate(_random_texts(600)))
    rows += [(1000 + i, "w " * 50_000 + "x" * 40_000 + " z" * 30_000) for i in range(8)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.key: r for r in fim.restored(fim.transformed(df)).collect()}
    assert len(got) == len(rows)
    for k, t in rows:
        r = got[k]
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == _plain(k, t)
        assert r.restored == t == fim.rebuild(r.output, r.form)
    assert {r.form for r in got.values()} == {"plain", "spm", "psm"}


def test_index_is_exact_and_its_error_bounded():
    texts = _random_texts(300) + ["", "x", " ", "a " * 40_000 + "b" * 9_000 + " c" * 50]
    offsets, data = string_buffers(pa.array(texts))
    places, bounds = fim.boundaries(offsets, data)
    for error in (0, 3, 127):
        x = fim.RankIndex(places, bounds, error)
        assert np.abs(x.residual.astype(int)).max() <= error
        for i, t in enumerate(texts):
            want = np.cumsum([0, *map(len, UNIT.findall(t))])
            assert len(want) == bounds[i + 1] - bounds[i]
            ranks = range(len(want)) if len(want) < 500 else range(0, len(want), 997)
            assert [x.place(i, r) for r in ranks] == [want[r] for r in ranks]
    assert len(x.start) < len(places) / 20          # lines, not a list of boundaries


def test_index_rows_predict_every_boundary(spark):
    texts = [(i, t) for i, t in enumerate(_random_texts(50))]
    for r in fim.rank_index(spark.createDataFrame(texts, "doc_id long, text string")).collect():
        want = np.cumsum([0, *map(len, UNIT.findall(texts[r.key][1]))])
        residual = np.frombuffer(bytes(r.residuals), np.int8)
        s = np.searchsorted(r.starts, np.arange(r.n + 1), side="right") - 1
        line = np.floor(np.array(r.slopes)[s] * (np.arange(r.n + 1) - np.array(r.starts)[s]) + 0.5)
        assert np.array_equal(np.array(r.bases)[s] + line + residual, want)


def test_odd_rows(spark, odd_docs, no_docs):
    clash = odd_docs.withColumn("n", F.lit("x")).withColumn("form", F.lit(1)).withColumn("t", F.lit(2)).withColumn("k", F.lit(3))
    got = sorted((str(r.key), r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in fim.transformed(clash).collect())
    want = sorted((str(r.doc_id), *_plain(r.doc_id, r.text)) for r in odd_docs.collect())
    assert got == want
    assert fim.digests(no_docs).count() == 0 and fim.rank_index(no_docs).count() == 0
    assert queries.QUERIES["op11_fill_in_middle"](spark, SF01).columns == [
        "doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
