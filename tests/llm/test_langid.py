import numpy as np
from pyspark.sql import functions as F

from duetlog.llm import langid
from duetlog.llm.common import read
from .conftest import SF01


def test_back_propagation_equals_numerical_gradient():
    """One Adam step moves every weight against the numerical gradient's sign."""
    rng = np.random.default_rng(0)
    x = rng.integers(97, 123, (6, langid.WINDOW))
    x[2, 40:] = langid.PAD
    y = np.array([0, 1, 2, 0, 1, 2])
    before = langid.train(x, y, ("a", "b", "c"), steps=0, hidden=3)
    after = langid.train(x, y, ("a", "b", "c"), steps=1, hidden=3)
    pick = np.random.default_rng(11)
    for shape, sd in (((2, 257, 6), 0.3), ((2, 3, 6), 0.3), ((6, 3), 0.3)):
        pick.normal(0, sd, shape)
    at = pick.integers(0, 6, 6)                     # the batch that the step drew
    xs, ys = x[at].T, y[at]

    def loss(m):
        p = langid._probabilities(m, langid._states(m, xs)).astype(np.float64)
        real = xs.ravel() != langid.PAD
        return -np.log(p[np.tile(ys, xs.shape[0]), np.arange(xs.size)])[real].mean()

    for name in ("inner", "outer", "bias"):
        w, moved = getattr(before, name), getattr(after, name) - getattr(before, name)
        for i in list(np.ndindex(w.shape))[::5]:
            up, down = w.astype(np.float64).copy(), w.astype(np.float64).copy()
            up[i] += 1e-3
            down[i] -= 1e-3
            slope = (loss(before._replace(**{name: up})) - loss(before._replace(**{name: down}))) / 2e-3
            if abs(slope) > 1e-3:
                assert slope * moved[i] < 0, (name, i, slope, moved[i])
    assert loss(after) < loss(before)


def test_held_out_accuracy_and_rules(spark):
    docs = read(spark, SF01, "documents")
    got = langid.language_id(docs)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    n, right, low, high = got.join(docs.select("doc_id", "lang"), "doc_id").where("held_out").agg(
        F.count("*"), F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.min("score"), F.max("score")).first()
    assert n > 150 and right >= 0.97 and 0 <= low <= high <= 1
    assert got.count() == docs.count()


def test_windows_tile_the_whole_text():
    off = np.array([0, 1, 64, 65, 300])
    data = np.arange(300, dtype=np.int64).astype(np.uint8)
    x, first = langid._windows(off, data)
    flat = [x[:, w][x[:, w] != langid.PAD] for w in range(x.shape[1])]
    assert np.array_equal(np.concatenate(flat), data) and first.tolist() == [0, 1, 2, 3]


def test_odd_rows(spark, odd_docs, no_docs):
    rng = np.random.default_rng(1)
    model = langid.train(rng.integers(97, 123, (20, langid.WINDOW)), np.arange(20) % 2, ("aa", "bb"), steps=3)
    got = langid.predict(odd_docs, model)
    assert got.columns == [*odd_docs.columns, "lang_pred", "score"] and got.count() == odd_docs.count()
    by = {r.doc_id: (r.lang_pred, r.score) for r in got.collect()}
    assert all(by[i] == ("und", 0.0) for i in (3, 4, 5, 12)) and by[9][0] in ("aa", "bb") and by[1] == by[2]
    assert langid.language_id(no_docs).count() == 0
    unlabelled = odd_docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.language_id(unlabelled).collect()} == {"und"}
    labels = langid.position_labels(model, "abc ü")
    assert len(labels) == 6 and set(labels) <= {"aa", "bb"}
    clash = odd_docs.withColumn("lang_pred", F.lit("x")).withColumn("score", F.lit("y")).withColumn("c0", F.lit(1))
    assert set(langid.accepted(clash).columns) >= {"doc_id", "text", "c0"}


def test_the_sample_is_bounded_for_repeated_ids_and_texts(spark):
    rows = [(1 if i < 6000 else i, f"some words number {i % 3 if i < 3000 else i}", "en" if i % 2 else "de") for i in range(7000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    windows, labels, languages = langid.sample(df, docs_per_language=5)
    assert languages == ("de", "en") and len(windows) == 10 and np.bincount(labels).tolist() == [5, 5]
    same = df.where("doc_id = 1").withColumn("text", F.lit("one text"))
    assert len(langid.sample(same, docs_per_language=5)[0]) == 2


def test_too_many_languages_are_refused(spark):
    df = spark.range(200).selectExpr("id AS doc_id", "'x' AS text", "concat('l', id) AS lang")
    try:
        langid.sample(df)
        assert False
    except ValueError as e:
        assert "languages" in str(e)


def test_first_stage_rejects_junk_and_keeps_clean_documents(spark):
    import random
    rng, docs = random.Random(1), read(spark, SF01, "documents").select("doc_id", "text", "lang")
    junk = [" ".join("".join(rng.choice("qxzjkvwbcdfgp") for _ in range(rng.randrange(3, 9))) for _ in range(120)) for _ in range(40)]
    other = ["人人生而自由,在尊严和权利上一律平等。他们赋有理性和良心,并应以兄弟关系的精神相对待。" * 12,
             " ".join("".join(rng.choice("0123456789abcdef") for _ in range(32)) for _ in range(30))]
    added = spark.createDataFrame([(10**6 + i, t, None) for i, t in enumerate(junk + other)], "doc_id long, text string, lang string")
    got = {r.doc_id for r in langid.accepted(docs.unionByName(added)).select("doc_id").collect()}
    clean = {r.doc_id for r in docs.where("text rlike '[a-z]'").collect()}
    assert len(got & clean) >= 0.99 * len(clean)
    assert sum(i >= 10**6 for i in got) <= 0.1 * len(junk + other)


def test_probabilities_equal_a_plain_forward_pass():
    """The recurrence read literally, one byte at a time."""
    rng = np.random.default_rng(3)
    m = langid.train(rng.integers(97, 123, (40, langid.WINDOW)), np.arange(40) % 3, ("a", "b", "c"), steps=5, hidden=4)
    text = np.frombuffer("so many words, in a row: été ".encode() * 5, np.uint8)
    hidden = m.inner.shape[1]

    def direction(window, d):
        h, out = np.zeros(hidden), []
        for byte in (window if d == 0 else window[::-1]):
            pre = m.inputs[d][byte] + h @ m.inner[d]
            s = pre / (1 + np.abs(pre))
            z, c = 0.5 * s[:hidden] + 0.5, s[hidden:]
            h = h + z * (c - h)
            out.append(h)
        return out if d == 0 else out[::-1]

    total = np.zeros(3)
    for at in range(0, len(text), langid.WINDOW):
        window = np.full(langid.WINDOW, langid.PAD)
        window[: len(text[at: at + langid.WINDOW])] = text[at: at + langid.WINDOW]
        ahead, back = direction(window, 0), direction(window, 1)
        for i in range(len(text[at: at + langid.WINDOW])):
            logit = np.concatenate([ahead[i], back[i]]) @ m.outer + m.bias
            e = np.exp(logit - logit.max())
            total += e / e.sum()
    got = langid.document_probabilities(m, np.array([0, len(text)]), text)[0]
    assert np.allclose(got, total / len(text), atol=2e-3), (got, total / len(text))
