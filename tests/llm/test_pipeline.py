import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline as cp
from duetlog.llm import decontam, langid, pieces, pii
from duetlog.llm.common import read
from .conftest import SF001
from .test_simhash import brute, plain_fingerprint


def test_stages_and_run_equal_brute_force(spark):
    docs = read(spark, SF001, "documents")
    all_rows = {r.doc_id: r for r in docs.collect()}
    # 1: what the operator itself says of each document
    pred = {r.doc_id: r for r in langid.predict(docs, langid.fit(docs), ["doc_id"]).collect()}
    size = {i: int(np.log2(len((r.text or "").encode()) + 1) // 2) for i, r in all_rows.items()}
    model_languages = len({r.lang for r in all_rows.values() if r.lang is not None})
    right = [i for i, r in all_rows.items() if zlib.crc32(str(i).encode()) % 5 == 0 and pred[i].lang_pred == r.lang]
    # under a thousand held-out documents a length: the share that may go is none of them
    chance, least = 1 / model_languages, {}
    for i in right:
        least[size[i]] = min(least.get(size[i], 1.0), pred[i].score)
    floor = {c: chance + langid.MARGIN * (v - chance) for c, v in least.items()}
    left = [i for i in all_rows if pred[i].lang_pred != "und" and pred[i].score >= floor.get(size[i], chance)]
    assert len(left) >= 0.95 * len(all_rows)
    # 2: fingerprints and groups by brute force
    left = [i for i, _, c in brute([(i, plain_fingerprint(all_rows[i].text)) for i in left]) if i == c]
    # 3: every alignment with four equal tokens, compared token by token
    def tokens(t):
        return [w for w in re.split(r"[\W_]+", t.lower()) if w]

    def overlaps(w, item):
        at = {}
        for i, t in enumerate(item):
            at.setdefault(t, []).append(i)
        shifts = Counter(p - i for p, t in enumerate(w) for i in at.get(t, ()))
        for shift in (x for x, n in shifts.items() if n >= decontam.MIN_TOKENS):
            now = best = 0
            for i in range(max(0, -shift), min(len(item), len(w) - shift)):
                now = max(0, now + (1 if w[i + shift] == item[i] else -decontam.PENALTY))
                best = max(best, now)
            loose = len(item) // 4 if len(item) >= decontam.LOOSE_TOKENS else 0
            if best >= decontam.MIN_SCORE or shifts[shift] >= len(item) - loose:
                return True
        return False
    items = [tokens(r.text) for r in read(spark, SF001, "benchmark").collect()]
    leaked = {i for i in left if any(overlaps(tokens(all_rows[i].text), it) for it in items)}
    left = [i for i in left if i not in leaked]
    got = {r.doc_id: r for r in cp.run(spark, SF001).collect()}
    assert set(got) == set(left)
    # 4 and 5: decoded pieces are the texts with personal data replaced
    codec = pieces.Codec(pieces.load())
    for i in left:
        text, back = all_rows[i].text, codec.decode(np.array(got[i].piece_ids))
        assert got[i].lossless
        spans = pii.base_spans(text)
        assert not any(text[s:e] in back for s, _, e in spans)
        if not re.search("[0-9@]", text):
            assert back == text


def test_stages_keep_the_columns(spark, odd_docs):
    docs = odd_docs.withColumn("n_chars", F.length("text")).withColumn("score", F.lit("clash"))
    for name in ("_t", "_lang", "_score", "c0", "h", "component_id", "_bad_text", "spans", "lang_pred"):
        docs = docs.withColumn(name, F.lit(1))
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, SF001)
        assert out.columns == docs.columns, name
        assert out.dtypes == docs.dtypes, name
        docs = out
    assert "piece_ids" in cp.STAGES[-1][1](spark, docs, SF001).columns


def test_stages_take_an_empty_table(spark, no_docs):
    docs = no_docs
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, SF001)
        assert docs.count() == 0


def test_near_duplicates_keep_every_clean_text(spark):
    near = "the cat sat on the mat and looked at the moon for a while " * 5
    rows = [(1, near), (7, near), (7, "one unique text about ships and harbours far away"), (None, near),
            (None, "a text that has no id and stands alone here"), (None, "a text that has no id and stands alone here"),
            (None, "another lonely text with words of its own"), (9, "an entirely different story"),
            (9, "nothing in common with the row before it at all")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = {rows[0], *rows[2:]} - {(None, near)}
    for parts in (1, 4):
        got = cp.near_duplicates(spark, docs.repartition(parts), SF001)
        assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want)) and got.columns == docs.columns
