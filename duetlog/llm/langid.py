"""Language identification by a bidirectional gated recurrent network over
UTF-8 bytes.

Two gated recurrent layers read every window of ``WINDOW`` bytes, one from
each end; a softmax over both states labels every byte position, and a
document's probabilities are the mean over all its positions.  The windows
tile the whole text, so no byte is left out and a long document costs no more
memory than a short one.  The gate and the candidate use x / (1 + |x|), which
costs a division instead of an exponential.

Training is backpropagation through time in numpy on a bounded, documented
sample: per language ``SAMPLE_DOCS`` training documents (least hash of their
id), ``SAMPLE_WINDOWS`` windows of each at hashed places of the whole text.
Only rows with a text and a language outside the held-out fifth are learned
from; language, source and id never enter a prediction.

Defined results: a null text, an empty text and a text without a letter are
``und`` with score 0; equal texts get equal results whatever their row (to
the last rounded digit); without any labelled row every text is ``und``.
Extra columns are passed by.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import column, saved, slices, string_buffers, task

UNKNOWN = "und"
WINDOW = 64
PAD = 256
HIDDEN = 8
SAMPLE_DOCS = 500
SAMPLE_WINDOWS = 6
SAMPLE_PARTS = 64
#: Languages that one model learns, at most.
MAX_LANGUAGES = 64
STEPS = 500
BATCH = 256
RATE = 0.02
#: Windows a forward pass holds at once.
BLOCK = 1024


class Model(NamedTuple):
    languages: tuple[str, ...]
    inputs: np.ndarray      # (2, 257, 2H): what a byte adds to gate and candidate, per direction
    inner: np.ndarray       # (2, H, 2H)
    outer: np.ndarray       # (2H, C)
    bias: np.ndarray        # (C,)


def held_out(doc_id: Column) -> Column:
    """The fifth of the documents that is never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


# ---------------------------------------------------------------- network

def _squash(x: np.ndarray) -> np.ndarray:
    d = np.abs(x)
    d += 1
    return np.divide(x, d, out=d)


def _states(model: Model, windows: np.ndarray) -> np.ndarray:
    """States (T, n, 2H) of both directions for byte windows (T, n)."""
    steps, n = windows.shape
    hidden = model.inner.shape[1]
    out = np.empty((steps, n, 2 * hidden), np.float32)
    h = np.zeros((2, n, hidden), np.float32)
    for t in range(steps):
        back = steps - 1 - t
        a = np.matmul(h, model.inner)
        a[0] += model.inputs[0].take(windows[t], axis=0)
        a[1] += model.inputs[1].take(windows[back], axis=0)
        s = _squash(a)
        z = s[..., :hidden]
        z *= 0.5
        z += 0.5
        c = s[..., hidden:]
        c -= h
        c *= z
        h += c
        out[t, :, :hidden] = h[0]
        out[back, :, hidden:] = h[1]
    return out


def _probabilities(model: Model, states: np.ndarray) -> np.ndarray:
    """(C, T * n) class probabilities of every position."""
    x = np.matmul(model.outer.T, states.reshape(-1, states.shape[-1]).T)
    x += model.bias[:, None]
    x -= x.max(axis=0)
    np.exp(x, out=x)
    x /= x.sum(axis=0)
    return x


def train(windows: np.ndarray, labels: np.ndarray, languages: tuple[str, ...], steps: int = STEPS,
          hidden: int = HIDDEN, seed: int = 11) -> Model:
    """Fit on byte windows (n, T) and class numbers (n,) by backpropagation
    through time with Adam; the loss is the cross-entropy of every position
    that holds a byte."""
    rng = np.random.default_rng(seed)
    n_class = len(languages)
    p = {
        "inputs": rng.normal(0, 0.3, (2, 257, 2 * hidden)), "inner": rng.normal(0, 0.3, (2, hidden, 2 * hidden)),
        "outer": rng.normal(0, 0.3, (2 * hidden, n_class)), "bias": np.zeros(n_class),
    }
    p = {k: v.astype(np.float32) for k, v in p.items()}
    m1 = {k: np.zeros_like(v) for k, v in p.items()}
    m2 = {k: np.zeros_like(v) for k, v in p.items()}
    for step in range(1, steps + 1):
        pick = rng.integers(0, len(windows), min(BATCH, len(windows)))
        x, y = windows[pick].T, labels[pick]                       # (T, n)
        T, n = x.shape
        model = Model(languages, p["inputs"], p["inner"], p["outer"], p["bias"])
        # forward, keeping what the way back needs
        hs = np.zeros((T + 1, 2, n, hidden), np.float32)
        pre = np.empty((T, 2, n, 2 * hidden), np.float32)
        read = np.stack([x, x[::-1]])                              # byte read by each direction at step t
        for t in range(T):
            a = np.matmul(hs[t], model.inner)
            a[0] += model.inputs[0].take(read[0, t], axis=0)
            a[1] += model.inputs[1].take(read[1, t], axis=0)
            pre[t] = a
            s = _squash(a)
            z = 0.5 * s[..., :hidden] + 0.5
            hs[t + 1] = hs[t] + z * (s[..., hidden:] - hs[t])
        states = np.concatenate([hs[1:, 0], hs[:0:-1, 1]], axis=-1)  # (T, n, 2H), both at the same position
        prob = _probabilities(model, states)
        real = (x.ravel() != PAD).astype(np.float32)
        err = prob.copy()
        err[np.tile(y, T), np.arange(T * n)] -= 1
        err *= real / max(real.sum(), 1)
        g = {k: np.zeros_like(v) for k, v in p.items()}
        flat = states.reshape(-1, 2 * hidden)
        g["outer"] = flat.T @ err.T
        g["bias"] = err.sum(axis=1)
        d_states = (p["outer"] @ err).T.reshape(T, n, 2 * hidden)
        d_h = np.zeros((2, n, hidden), np.float32)
        d_pre = np.empty_like(pre)
        for t in range(T - 1, -1, -1):
            d_h[0] += d_states[t, :, :hidden]
            d_h[1] += d_states[T - 1 - t, :, hidden:]
            den = 1 + np.abs(pre[t])
            s = pre[t] / den
            z, c = 0.5 * s[..., :hidden] + 0.5, s[..., hidden:]
            d_s = np.concatenate([0.5 * d_h * (c - hs[t]), d_h * z], axis=-1)
            d_pre[t] = d_s / (den * den)
            g["inner"] += np.matmul(hs[t].transpose(0, 2, 1), d_pre[t])
            d_h = d_h * (1 - z) + np.matmul(d_pre[t], p["inner"].transpose(0, 2, 1))
        for d in (0, 1):
            np.add.at(g["inputs"][d], read[d].ravel(), d_pre[:, d].reshape(-1, 2 * hidden))
        norm = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
        rate = RATE * (1 - step / (steps + 1)) / max(1.0, norm)
        for k in p:
            m1[k] = 0.9 * m1[k] + 0.1 * g[k]
            m2[k] = 0.99 * m2[k] + 0.01 * g[k] ** 2
            p[k] -= rate * (m1[k] / (1 - 0.9 ** step)) / (np.sqrt(m2[k] / (1 - 0.99 ** step)) + 1e-8)
    return Model(languages, p["inputs"], p["inner"], p["outer"], p["bias"])


# ---------------------------------------------------------------- training sample

def _cut(text: bytes, seed: int, how_many: int) -> list[bytes]:
    """Windows at hashed places of the whole text (all of a short one)."""
    if len(text) <= WINDOW * how_many:
        return [text[i: i + WINDOW] for i in range(0, len(text), WINDOW)]
    return [text[p: p + WINDOW] for p in
            (xxhash.xxh64_intdigest(b"%d:%d" % (seed, i)) % (len(text) - WINDOW + 1) for i in range(how_many))]


def window_rows(texts: list[bytes]) -> np.ndarray:
    out = np.full((len(texts), WINDOW), PAD, np.int64)
    for i, t in enumerate(texts):
        out[i, : len(t)] = np.frombuffer(t, np.uint8)
    return out


def sample(df: DataFrame, docs_per_language: int = SAMPLE_DOCS) -> tuple[np.ndarray, np.ndarray, tuple[str, ...]]:
    """The bounded training sample: windows, class numbers, languages.

    A language gives at most ``docs_per_language`` pairs of id and text (rows
    that repeat a pair are one), and there are at most ``MAX_LANGUAGES``
    languages; more are refused, as the model has a class for each."""
    rows = df.select(column(df, "doc_id").alias("id"), column(df, "lang").alias("lang"), column(df, "text").alias("t"))
    rows = rows.where(F.col("id").isNotNull() & F.col("lang").isNotNull() & F.col("t").isNotNull() & ~held_out(F.col("id")))
    rows = rows.withColumn("h", F.xxhash64("id", "t"))
    picked = rows.select("id", "lang", "h").distinct().withColumn(
        "part", F.pmod(F.col("h"), F.lit(SAMPLE_PARTS)))
    for group in (["lang", "part"], ["lang"]):         # in parts first: a language that most rows share is not one task's
        order = Window.partitionBy(*group).orderBy("h", "id")
        picked = picked.withColumn("r", F.row_number().over(order)).where(F.col("r") <= docs_per_language).drop("r")
    picked = picked.select("id", "lang", "h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cuts = [_cut(t.encode(), i, SAMPLE_WINDOWS) for i, t in zip(b.column(0).to_pylist(), b.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array(cuts, pa.list_(pa.binary()))], names=["id", "lang", "h", "cuts"])

    known = rows.select("lang").distinct().limit(MAX_LANGUAGES + 1).count()
    if known > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages to learn; group the rare ones first")
    # the sample's pairs are bounded by docs_per_language a language; a pair on many rows is one again before it is sent
    got = rows.join(F.broadcast(picked), ["id", "lang", "h"], "left_semi").select("id", "lang", "h", "t").mapInArrow(
        task(run), "id long, lang string, h long, cuts array<binary>").dropDuplicates(["id", "lang", "h"]).orderBy(
        "lang", "id", "h").collect()
    languages = tuple(sorted({r.lang for r in got}))
    texts = [bytes(c) for r in got for c in r.cuts]
    labels = np.array([languages.index(r.lang) for r in got for _ in r.cuts], dtype=np.int64)
    if len(texts):                                      # every language weighs the same
        size = np.bincount(labels, minlength=len(languages))
        again = np.concatenate([np.resize(np.flatnonzero(labels == c), size.max()) for c in range(len(languages)) if size[c]])
        return window_rows(texts)[again], labels[again], languages
    return window_rows(texts), labels, languages


def fit(df: DataFrame) -> Model | None:
    windows, labels, languages = sample(df)
    return train(windows, labels, languages) if len(windows) else None


# ---------------------------------------------------------------- prediction

def _windows(off: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte windows (WINDOW, n) that tile every text, and the first window of
    each text (texts must not be empty)."""
    count = -(-np.diff(off) // WINDOW)
    first = np.cumsum(count) - count
    start = np.repeat(off[:-1] - first * WINDOW, count) + np.arange(int(count.sum())) * WINDOW
    end = np.repeat(off[1:], count)
    place = start[None, :] + np.arange(WINDOW)[:, None]
    x = data[np.minimum(place, len(data) - 1)].astype(np.int64)
    x[place >= end[None, :]] = PAD
    return x, first


def document_probabilities(model: Model, off: np.ndarray, data: np.ndarray) -> np.ndarray:
    """(n, C): mean over all byte positions of each (non-empty) text."""
    x, first = _windows(off, data)
    total = np.empty((len(model.languages), x.shape[1]), np.float64)
    for at in range(0, x.shape[1], BLOCK):
        part = np.ascontiguousarray(x[:, at: at + BLOCK])
        p = _probabilities(model, _states(model, part)).reshape(len(model.languages), *part.shape)
        p *= part != PAD
        total[:, at: at + BLOCK] = p.sum(axis=1)
    return (np.add.reduceat(total, first, axis=1) / np.diff(off)).T


def position_labels(model: Model, text: str) -> list[str]:
    """The language of every UTF-8 byte of ``text``."""
    data = np.frombuffer(text.encode(), np.uint8)
    if not len(data):
        return []
    x, _ = _windows(np.array([0, len(data)]), data)
    best = _probabilities(model, _states(model, x)).argmax(axis=0).reshape(x.shape).T.ravel()[: len(data)]
    return [model.languages[i] for i in best]


def predict(df: DataFrame, model: Model | None, keep: list[str] | None = None,
            out: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """Every row of ``df`` with the language and the score added at the end
    under the names ``out`` (columns of those names in ``keep`` are replaced)."""
    keep = [c for c in (df.columns if keep is None else keep) if c not in out]
    text = column(df, "text")
    if model is None:
        return df.select(*[column(df, c) for c in keep], F.lit(UNKNOWN).alias(out[0]), F.lit(0.0).alias(out[1]))
    names = [f"c{i}" for i in range(len(keep))]
    sent = df.select(*[column(df, c).alias(n) for c, n in zip(keep, names)],
                     F.when(text.rlike("\\p{L}"), text).alias("_t"))   # null where nothing can be told
    sent_kept = sent.drop("_t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "_t", 1 << 20):
            t = b.column(len(names))
            known = np.flatnonzero(t.is_valid().to_numpy(zero_copy_only=False))
            lang, score = np.full(b.num_rows, UNKNOWN, dtype=object), np.zeros(b.num_rows)
            if len(known):
                p = document_probabilities(model, *string_buffers(t.take(pa.array(known))))
                lang[known] = np.array(model.languages, dtype=object)[p.argmax(axis=1)]
                score[known] = np.clip(p.max(axis=1), 0, 1).round(6)
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(len(names))], pa.array(lang, pa.string()),
                                              pa.array(score)], names=[*names, "lang_pred", "score"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in sent_kept.schema)
    got = sent.mapInArrow(task(run), f"{schema + ', ' if names else ''}lang_pred string, score double")
    return got.select(*[F.col(n).alias(c) for n, c in zip(names, keep)], F.col("lang_pred").alias(out[0]), F.col("score").alias(out[1]))


def language_id(df: DataFrame) -> DataFrame:
    """Learn from the training rows of ``df``, predict all of it."""
    model = fit(df)
    got = predict(df, model, ["doc_id"])
    return got.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


#: Share of the rightly told held-out documents of a length that the first
#: stage may reject.
REJECTED_SHARE = 0.001
#: How far the threshold lies from chance towards that score: few held-out
#: documents of a length tell its lowest score only roughly.
MARGIN = 0.75


def _length_class(text: Column) -> Column:
    """Texts of like length have like scores: classes of a factor of four."""
    return F.floor(F.log2(F.octet_length(text) + 1) / 2).cast("int")


def accepted(df: DataFrame) -> DataFrame:
    """Rows of ``df`` in a learned language (the pipeline's first stage).

    A row goes if its text has no letter, or if its score is under the
    threshold of its length.  That lies ``MARGIN`` of the way from chance (one
    over the number of languages) to the score that all but ``REJECTED_SHARE``
    of the labelled held-out documents of that length reach whose language was
    told rightly.  All of them count, so the predictions are written once and
    read twice.  A length without such documents has the threshold of chance."""
    names = tuple(f"_{n}" + "_" * sum(c.startswith(f"_{n}") for c in df.columns) for n in ("lang", "score", "length", "least"))
    model = fit(df)
    if model is None:
        return df.limit(0)
    told = predict(df, model, out=names[:2])
    got = saved(told.withColumn(names[2], _length_class(column(told, "text"))), "language-scores")
    lang, score = F.col(names[0]), F.col(names[1])
    right = got.where(held_out(column(got, "doc_id")) & (column(got, "lang") == lang) & (lang != UNKNOWN))
    least = right.groupBy(names[2]).agg(F.percentile_approx(score, REJECTED_SHARE, 100_000).alias(names[3]))
    rows = got.join(F.broadcast(least), names[2], "left")      # one row a length class, at most 16
    chance = F.lit(1 / len(model.languages))
    floor = chance + MARGIN * F.coalesce(F.col(names[3]) - chance, F.lit(0.0))
    return rows.where((lang != UNKNOWN) & (score >= floor)).select(*[column(rows, c) for c in df.columns])
