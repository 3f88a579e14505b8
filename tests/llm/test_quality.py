"""Quality rules against a plain reading of the contract, and odd rows."""

import random
import re

from pyspark.sql import functions as F

from duetlog.llm import quality
from .conftest import SF01
from .oracle_check import compare

COLUMNS = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def _plain(doc_id, text):
    text = text or ""
    words = [w for w in re.split("[ \t-\r]+", text) if w]
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if re.search("[^ \t-\r]", line):
            dup += line in seen
            seen.add(line)
    triples = {}
    for i in range(len(words) - 2):
        triples.setdefault(tuple(words[i: i + 3]), []).append(i)
    repeat = {j for places in triples.values() if len(places) > 1 for i in places for j in (i, i + 1, i + 2)}
    return (doc_id, len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(repeat),
            len(words) < 50 or 100 * len(repeat) > 50 * len(words))


def test_whole_table_equals_duckdb(spark):
    assert compare("op5_quality_rules", spark, SF01) == 1000


def test_random_texts_equal_the_plain_form(spark):
    rng = random.Random(2)
    pieces = ["the", "of", "a", "w1", "w2", "é", "日本", "😀", "#", "<b>", "|", " ", "\n", "\n\n", "\t", "\x0b", "\u00a0", "..."]
    texts = ["".join(rng.choice(pieces) + rng.choice(["", " ", " "]) for _ in range(rng.randrange(200))) for _ in range(300)]
    rows = list(enumerate(texts)) + [(1000, "x " * 60_000), (1001, "".join(f"w{i} " for i in range(60_000))), (1002, "y" * 300_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in quality.quality(df).collect()}
    for r in rows:
        assert got[r[0]] == _plain(*r), r[1][:80]


def test_verdict_follows_the_table(spark):
    good = "The house is on the hill and it was built by the people of the town in a year that was not easy for them . " * 1
    prose = " ".join(f"{good} year{i} came and the town of place{i} was in it ." for i in range(6))
    rows = [(1, prose), (2, "# " * 30 + prose), (3, " ".join(f"w{i}" for i in range(200))), (4, "1 2 3 4 5 " * 3 + prose.replace("the", "7")),
            (5, "\n".join(f"- {i} the and of" for i in range(40)))]
    got = {r.doc_id: (r.base_failed, r.kept, r.broken_rules) for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, (base, kept, broken) in got.items():
        assert kept == (not base and not broken)
    assert "stop" in " ".join(got[3][2]) and not got[3][1]


def test_odd_rows(spark, odd_docs, no_docs):
    clash = odd_docs.withColumn("n_words", F.lit("x")).withColumn("kept", F.lit(1)).withColumn("words", F.lit(2)).withColumn("w", F.lit(3))
    got = sorted((tuple(r[c] for c in COLUMNS) for r in quality.quality(clash).collect()), key=repr)
    assert got == sorted((_plain(r.doc_id, r.text) for r in odd_docs.collect()), key=repr)
    assert all(r.base_failed and not r.kept for r in quality.quality(odd_docs).where("doc_id IN (3, 4, 5, 6, 7)").collect())
    assert quality.quality(no_docs).count() == 0
    plan = quality.quality(odd_docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


def test_no_text_fails_for_its_length_alone(spark):
    text = "concat_ws(' ', transform(sequence(1, 1100000), i -> concat('the w', i))) AS text"
    df = spark.range(1).selectExpr("id AS doc_id", text)
    r = quality.judge(df).first()
    assert r.n_words == 2200000 and r.kept and r.broken_rules == []
