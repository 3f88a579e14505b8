import random
import re

from pyspark.sql import functions as F

from duetlog.llm import decontam, queries
from .conftest import SF01
from .oracle_check import compare


def test_whole_table_equals_duckdb(spark):
    assert compare("op7_benchmark_decontamination", spark, SF01) > 5


def _texts(n, size, seed):
    rng = random.Random(seed)
    return [" ".join(f"w{rng.randrange(5000)}" for _ in range(size)) for _ in range(n)]


def test_substitutions_are_found_and_clean_documents_left(spark):
    items = _texts(20, 30, 1)
    rng, docs = random.Random(2), []
    for i, t in enumerate(items):
        w = t.upper().split()
        for at in rng.sample(range(30), 3):
            w[at] = f"other{at}"
        docs.append((i, "start here. " + ", ".join(w) + " and the end"))
        docs.append((100 + i, " ".join(_texts(1, 200, 50 + i))))
        docs.append((200 + i, " ".join(t.split()[:9]) + " and something else altogether here now"))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = sorted((r.doc_id, r.item_id) for r in decontam.contaminated(d, b).collect())
    assert got == [(i, i) for i in range(20)]
    assert sorted(r.doc_id for r in decontam.cleaned(d, b).collect()) == sorted(i for i, _ in docs if i >= 100)


def test_shuffle_path_equals_broadcast(spark, monkeypatch):
    from duetlog.llm.common import read
    d, b = read(spark, SF01, "documents"), read(spark, SF01, "benchmark")
    want = sorted(map(tuple, decontam.contaminated(d, b).collect()))
    monkeypatch.setattr(decontam, "MAX_BROADCAST_SEEDS", 0)
    assert sorted(map(tuple, decontam.contaminated(d, b).collect())) == want


def test_no_python_in_the_plan(spark):
    plan = queries.QUERIES["op7_benchmark_decontamination"](spark, SF01)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan) and "CartesianProduct" not in plan


def test_odd_rows(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "too short seed"), (4, "the cat sat on the mat and looked at the moon for a while"),
                                   (4, "the cat sat on the mat and looked at the moon for a while"), (5, "word " * 40)],
                                  "item_id long, text string")
    got = sorted((r.doc_id, r.item_id) for r in decontam.contaminated(odd_docs, items).collect())
    assert got == [(1, 4), (2, 4), (10, 5)]
    assert decontam.contaminated(no_docs, items).count() == 0
    assert decontam.contaminated(odd_docs, items.limit(0)).count() == 0
    clash = odd_docs.withColumn("item_id", F.lit(1)).withColumn("seed", F.lit("x")).withColumn("tokens", F.lit(2)).withColumn(
        "_bad_id", F.lit(1)).withColumn("hits", F.lit("h")).withColumn("text_hash", F.lit(3))
    kept = decontam.cleaned(clash, items)
    assert kept.columns == clash.columns
    assert kept.count() == odd_docs.count() - 3 and kept.where("doc_id is null").count() == 1


def _replaced(words, at):
    return [f"new{i}" if i in at else w for i, w in enumerate(words)]


def test_short_items_with_every_placement_of_replaced_words(spark):
    """Items of 8 to 16 tokens, 0, 1 and 2 words replaced: all are found."""
    from itertools import combinations
    items, docs = [], []
    for n in range(8, 17):
        words = [f"t{n}x{i}" for i in range(n)]
        items.append((n, " ".join(words)))
        for r in (0, 1, 2):
            for at in combinations(range(n), r):
                docs.append((len(docs), n, f"before it {' '.join(_replaced(words, at))} and behind"))
    d = spark.createDataFrame(docs, "doc_id long, n int, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.contaminated(d, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == {(i, n) for i, n, _ in docs}


def test_recall_over_planted_items(spark):
    """Longer items, up to a quarter of the words replaced at random; half
    items; and documents that share single words only."""
    rng = random.Random(9)
    items = [(i, " ".join(f"w{rng.randrange(400)}" for _ in range(rng.randrange(8, 60)))) for i in range(150)]
    docs, planted = [], set()
    for i, t in items:
        w = t.split()
        for _ in range(4):
            at = set(rng.sample(range(len(w)), rng.randrange(0, len(w) // 4 + 1)))
            planted.add((len(docs), i))
            docs.append((len(docs), " ".join(_texts(1, 50, len(docs)) + _replaced(w, at) + _texts(1, 50, len(docs) + 10**6))))
        docs.append((len(docs), " ".join(rng.sample(w, len(w)) + _texts(1, 30, len(docs)))))
    got = {(r.doc_id, r.item_id) for r in decontam.contaminated(spark.createDataFrame(docs, "doc_id long, text string"),
                                                                spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert len(got & planted) >= 0.99 * len(planted) and len(got - planted) <= 2


def test_every_fourth_word_replaced(spark):
    words = [f"w{i}" for i in range(40)]
    docs = [(k, "x " + " ".join(_replaced(words, set(range(k, 40, 4)))) + " y") for k in range(4)]
    got = decontam.contaminated(spark.createDataFrame(docs, "doc_id long, text string"),
                                spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")).collect()
    assert sorted(r.doc_id for r in got) == [0, 1, 2, 3]


def test_repeated_words_stay_linear(spark):
    """An item and a text of one word: rows in proportion to the text."""
    d = spark.createDataFrame([(1, "word " * 20_000)], "doc_id long, text string")
    b = spark.createDataFrame([(1, "word " * 60)], "item_id long, text string")
    assert [tuple(r) for r in decontam.contaminated(d, b).collect()] == [(1, 1, 60)]
    short = spark.createDataFrame([(1, "a b c d"), (2, "a b c"), (3, "a b c d e f g")], "item_id long, text string")
    texts = spark.createDataFrame([(1, "z a b c d z"), (2, "a b x d e f g")], "doc_id long, text string")
    assert [tuple(r) for r in decontam.contaminated(texts, short).collect()] == [(1, 1, 4)]
