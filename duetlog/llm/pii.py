"""Personal data: base patterns plus candidates selected by boosted trees.

Base spans are fixed patterns with their checks (part values, digit counts,
Luhn), leftmost and non-overlapping per kind, without retries.  They miss
spans that touch other numbers ("555-2485 4524132264652876" is one run of 23
digits).  The learned part adds those: generators propose overlapping
candidates with high recall (every run of number tokens of up to
``MAX_DIGITS`` digits, spaced and spelt-out addresses of any length), trees score them by format and
context features, per-kind thresholds calibrated for precision decide, and
the best non-overlapping ones that touch no base span are added.

The trees are fitted on a bounded sample: up to ``SAMPLE_SPANS`` base spans of
at most ``SAMPLE_WIDTH`` characters and ``SAMPLE_OTHER`` other numeric stretches
(at most ``SAMPLE_PER_TEXT`` of a text, cut at ``SAMPLE_CHARS``) of the corpus
(least hash), the spans also set next to each other, spelt out and spaced out, since base patterns never
show them so.  A corpus without base spans gets no model and no added spans.

Defined results: a null text counts as empty; no span gives zero counts, the
hash of the empty string and an empty list; repeated rows are treated alike;
whole texts are scanned in time linear in their length.  Extra columns are
passed by.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import boost
from .common import column, saved, slices, task

KINDS = ("email", "ip", "card", "phone")
SAMPLE_SPANS = 3000
SAMPLE_OTHER = 1500
SAMPLE_WIDTH = 120
SAMPLE_PER_TEXT = 4
SAMPLE_CHARS = 200
CONTEXT = 32
PRECISION = 0.99
#: A numeric stretch proposes every run of up to this many digits.
MAX_DIGITS = 19

# Fixed patterns of the query's contract; the e-mail pattern is applied from
# its "@" outwards so that a long word costs no more than its length.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_NOT_LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")

# Generators of candidates.
_STRETCH = re.compile(r"[+(]?[0-9][0-9 ().+-]*")
_TOKEN = re.compile(r"[^ ]+")
_AT = r"[(\[{] ?(?i:at) ?[)\]}]"
_DOT = r"(?:\.| ?[(\[{] ?(?i:dot) ?[)\]}] ?| (?i:dot) )"
# Loose addresses are read from their "at" outwards, so that a long word costs
# no more than its length and neither side needs a limit.
_LOOSE_AT = re.compile(rf" ?(?:@|{_AT}) ?| (?i:at) ")
_LOOSE_LOCAL = re.compile(r"[\w.%+-]")
_LOOSE_DOMAIN = re.compile(rf"[\w-]+(?:{_DOT}[\w-]+)+")
_IP_DOT = r"(?: ?\. ?| ?[(\[{] ?(?:\.|(?i:dot)) ?[)\]}] ?| (?i:dot) )"
_LOOSE_IP = re.compile(rf"(?<![0-9])[0-9]{{1,3}}(?:{_IP_DOT}[0-9]{{1,3}}){{3}}(?![0-9])")
_SPELT_AT = re.compile(rf" (?i:at) |{_AT}")
_MAIL_HINT = re.compile(rf"@|{_AT}| (?i:at) [\w-]+{_DOT}")
#: A text without any of these holds no span.
_ANY = re.compile(rf"[0-9]|{_MAIL_HINT.pattern}")
#: Context words that speak for or against a kind.
_HINTS = ("mail", "contact", "tel", "phone", "call", "fax", "ip", "host", "server", "card", "visa", "pay", "credit",
          "version", "license", "licence", "password", "token", "key", "isbn", "page", "id")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base spans, in order."""
    out = []
    if "@" in text:
        done, at = 0, text.find("@")
        while at >= 0:
            start = at
            while start > done and _LOCAL.match(text, start - 1, start):
                start -= 1
            m = _DOMAIN.match(text, at + 1) if start < at else None
            if m:
                out.append((start, 0, m.end()))
                done = m.end()
            else:
                done = max(done, at)          # a later local part cannot hold this "@"
            at = text.find("@", max(done, at + 1))
    for m in _DOTTED.finditer(text):
        parts, place = m.group().split("."), m.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i: i + 4]
            size = sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in four):
                out.append((place, 1, place + size))
            place += size + 1
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def candidates(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) proposals; they overlap one another."""
    out = []
    for m in _STRETCH.finditer(text):
        if m.end() - m.start() < 7:
            continue
        tokens = [(t.start(), t.end(), sum(c.isdigit() for c in t.group())) for t in _TOKEN.finditer(text, m.start(), m.end())]
        full = [n for n, t in enumerate(tokens) if t[2]]
        for i in range(len(full)):
            # a run begins and ends with a token that holds a digit, or with the mark next to one ("+ 1", "( 555 )")
            starts = [tokens[full[i]][0]]
            if full[i] and not tokens[full[i] - 1][2]:
                starts.append(tokens[full[i] - 1][0])
            digits = 0
            for j in range(i, len(full)):
                digits += tokens[full[j]][2]
                if digits > MAX_DIGITS:
                    break
                if digits < 4:
                    continue
                b = tokens[full[j]][1]
                while text[b - 1] in ".(-+":
                    b -= 1
                ends = [b]
                after = full[j] + 1
                if after < len(tokens) and not tokens[after][2] and text[tokens[after][0]] == ")":
                    ends.append(tokens[after][0] + 1)
                for a, b in ((a, b) for a in starts for b in ends):
                    word = text[a:b]
                    if word.count(".") == 3 and i == j:
                        out.append((a, 1, b))
                    if 13 <= digits <= MAX_DIGITS and word[0].isdigit():
                        out.append((a, 2, b))
                    if 7 <= digits <= 15:
                        out.append((a, 3, b))
    out += [(m.start(), 1, m.end()) for m in _LOOSE_IP.finditer(text)]
    if _MAIL_HINT.search(text):
        out += loose_mails(text)
    return out


def loose_mails(text: str) -> list[tuple[int, int, int]]:
    """Addresses with a spaced or spelt-out "at" or "dot", whole."""
    out, done, at = [], 0, _LOOSE_AT.search(text)
    while at:
        after, host = at.start() + 1, _LOOSE_DOMAIN.match(text, at.end())
        if host:
            start = at.start()
            while start > done and _LOOSE_LOCAL.match(text, start - 1, start):
                start -= 1
            if start < at.start():
                out.append((start, 0, host.end()))
                after = done = host.end()
        at = _LOOSE_AT.search(text, after)
    return out


def features(text: str, start: int, kind: int, end: int) -> list[float]:
    """Format of the span and of its surroundings."""
    word = text[start:end]
    digits = _NOT_DIGIT.sub("", word)
    groups = [len(g) for g in re.findall("[0-9]+", word)] or [0]
    before, after = text[max(0, start - CONTEXT): start], text[end: end + CONTEXT]
    prev, nxt = before[-1:], after[:1]
    near = before.lower()
    parts = word.split(".")
    tail = re.split(r"[^\w]+", word)[-1]
    return [
        float(kind), len(word), len(digits), len(groups), max(groups), min(groups), groups[0], groups[-1],
        word.count(" "), word.count("-"), word.count("."), word.count("("), word.count("(") - word.count(")"),
        float(word[:1] == "+"), float(digits[:1] == "0"), float(digits[:1] in "3456"),
        float(13 <= len(digits) <= 19 and luhn(digits)),
        float(len(parts) == 4 and all(p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts)),
        float(groups[-1] == 4 and groups[-2:-1] == [3]), float(groups[-3:-2] == [3]),
        float(prev.isalnum() or prev in "_/=\"'+"), float(nxt.isalnum() or nxt in "_/=\"'"),
        float(prev in ".-("), float(nxt in ".-)" and after[1:2].isdigit()),
        float(prev == "+"), float("@" in word), float(bool(_SPELT_AT.search(word))),
        float(tail.isalpha()), len(tail),
        float(kind == 1 and len(groups) == 4 and all(len(g) <= 3 and int(g) <= 255 for g in re.findall("[0-9]+", word))), *[float(h in near) for h in _HINTS],
    ]


# ---------------------------------------------------------------- model

class Model(NamedTuple):
    trees: boost.Trees
    thresholds: tuple[float, ...]


def _spelt(span: str, turn: int) -> str:
    at, dot = ((" at ", " dot "), ("(at)", "(dot)"), (" @ ", "."), ("[at]", "[dot]"), (" AT ", " DOT "), (" at ", "."),
               (" (AT) ", " (dot) "))[turn % 7]
    name, _, host = span.partition("@")
    return name + at + host.replace(".", dot)


def _dotted(ip: str, turn: int) -> str:
    return ip.replace(".", ("[.]", " . ", "(dot)", " dot ", "[dot]", "(.)")[turn % 6])


def _respaced(card: str, turn: int) -> str:
    """The digits of a number in groups of four, or each on its own."""
    digits = _NOT_DIGIT.sub("", card)
    fours = [digits[i: i + 4] for i in range(0, len(digits), 4)]
    return (" - ".join(fours), " ".join(digits), " . ".join(fours))[turn % 3]


def training_rows(spans: list[tuple[str, str, str, str]], others: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels.  ``spans`` are (kind, left, span, right) of base
    spans, ``others`` stretches that hold none.  Besides the span where it
    stood, the trees see pairs of spans side by side and spelt-out addresses."""
    x, y = [], []

    def learn(text: str, true: set[tuple[int, int, int]], area: tuple[int, int]) -> None:
        """Candidates that overlap ``area`` (the rest of the context is not
        labelled); one that is nearly a true span is neither right nor wrong."""
        for c in sorted(set(candidates(text)) | true):
            if c[2] <= area[0] or c[0] >= area[1]:
                continue
            if c in true or not any(c[1] == t[1] and c[0] >= t[0] and c[2] <= t[2] and c[2] - c[0] >= 0.9 * (t[2] - t[0])
                                    for t in true):
                x.append(features(text, *c))
                y.append(float(c in true))

    for n, (kind, left, span, right) in enumerate(spans):
        k, a = KINDS.index(kind), len(left)
        b = a + len(span)
        learn(left + span + right, {(a, k, b)}, (a, b))
        other_kind, _, other, _ = spans[(n * 7 + 3) % len(spans)]
        learn(f"{left}{span} {other}{right}", {(a, k, b), (b + 1, KINDS.index(other_kind), b + 1 + len(other))},
              (a, b + 1 + len(other)))
        if k == 0:
            spelt = _spelt(span, n)
            learn(left + spelt + right, {(a, 0, a + len(spelt))}, (a, a + len(spelt)))
        if k == 2:                          # a number of the same shape that fails the check digit
            wrong = span[:-1] + str((int(span[-1]) + 1 + n % 9) % 10)
            if wrong != span:
                learn(left + wrong + right, set(), (a, b))
            for shape, good in ((_respaced(span, n), True), (_respaced(wrong, n), False)):
                end = a + len(shape)
                learn(f"{left}{shape} {other}{right}", ({(a, k, end)} if good else set())
                      | {(end + 1, KINDS.index(other_kind), end + 1 + len(other))}, (a, end))
        if k == 1:                          # parts over 255
            wrong = ".".join(str(int(p) + 256) for p in span.split("."))
            learn(left + wrong + right, set(), (a, a + len(wrong)))
            for shape, good in ((_dotted(span, n), True), (_dotted(wrong, n), False)):
                learn(left + shape + right, {(a, 1, a + len(shape))} if good else set(), (a, a + len(shape)))
    for text in others:
        learn(text, set(), (0, len(text)))
    return np.array(x, dtype=np.float64), np.array(y)


def train(spans: list[tuple[str, str, str, str]], others: list[str]) -> Model | None:
    """Fit on two thirds of the sample, calibrate probabilities and choose
    the thresholds on the rest."""
    if not spans:
        return None
    part = [i % 3 for i in range(len(spans))]
    x, y = training_rows([s for s, p in zip(spans, part) if p], others[::2])
    trees = boost.fit(x, y)
    cx, cy = training_rows([s for s, p in zip(spans, part) if not p] or spans, others[1::2])
    trees = boost.calibrated(trees, cx, cy)
    return Model(trees, tuple(max(0.5, boost.threshold(trees, cx[cx[:, 0] == k], cy[cx[:, 0] == k], PRECISION))
                              if (cx[:, 0] == k).any() else 2.0 for k in range(len(KINDS))))


def _snippets(df: DataFrame) -> DataFrame:
    """(kind, left, span, right): base spans and, with kind 'none', the
    surroundings of numeric stretches without any."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "t"):
            rows = []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                base = base_spans(t)
                for s, k, e in base:
                    if e - s <= SAMPLE_WIDTH:
                        rows.append((i, s, KINDS[k], t[max(0, s - CONTEXT): s], t[s:e], t[e: e + CONTEXT]))
                if not base:
                    rows += [(i, m.start(), "none", "", t[max(0, m.start() - CONTEXT): m.end() + CONTEXT][:SAMPLE_CHARS], "")
                             for m in islice(_STRETCH.finditer(t), SAMPLE_PER_TEXT)]
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("id", "start", "kind", "l", "span", "r"), r)) for r in rows], schema=schema)

    schema = pa.schema([("id", pa.int64()), ("start", pa.int64()), ("kind", pa.string()), ("l", pa.string()),
                        ("span", pa.string()), ("r", pa.string())])
    some = df.select(column(df, "doc_id").cast("long").alias("id"), column(df, "text").cast("string").alias("t")).where(
        F.col("t").rlike("[0-9@]"))
    return some.mapInArrow(task(run), "id long, start long, kind string, l string, span string, r string")


def fit(df: DataFrame) -> Model | None:
    """Train on the spans and stretches of least hash: a bounded sample, the
    same however the input is split.  The snippets are written once; the cut
    is found from the hashes alone, so no task sends the driver more."""
    rows = saved(_snippets(df).withColumn("h", F.xxhash64("id", "start", "kind")), "snippets")

    def least(part: DataFrame, n: int) -> list:
        last = part.select("h").orderBy("h").limit(n).agg(F.max("h")).first()[0]
        if last is None:
            return []
        return part.where(F.col("h") <= F.lit(last)).orderBy("h", "kind", "l", "span", "r").limit(n).collect()

    spans = [(r.kind, r.l, r.span, r.r) for r in least(rows.where("kind <> 'none'"), SAMPLE_SPANS)]
    others = [r.span for r in least(rows.where("kind = 'none'"), SAMPLE_OTHER)] if spans else []
    return train(spans, others)


# ---------------------------------------------------------------- operator

def all_spans(text: str, model: Model | None) -> tuple[list, list]:
    """(base spans, base and added spans), each (start, kind, end) sorted."""
    base = base_spans(text)
    if model is None:
        return base, base
    some = candidates(text)
    if not some:
        return base, base
    x = np.array([features(text, *c) for c in some], dtype=np.float64)
    p = boost.probabilities(model.trees, x)
    limit = np.array(model.thresholds)[x[:, 0].astype(int)]
    taken = [(s, e) for s, _, e in base]
    out = list(base)
    for i in sorted(np.flatnonzero(p >= limit), key=lambda i: (-p[i], some[i][0] - some[i][2], some[i])):
        s, k, e = some[i]
        if all(e <= a or s >= b for a, b in taken):
            taken.append((s, e))
            out.append((s, k, e))
    return base, sorted(out)


def _written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def find(df: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) per row."""
    names = ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "t"):
            counts, digests, written = [[] for _ in KINDS], [], []
            for t in b.column(1).to_pylist():
                base, every = all_spans(t or "", model)
                for k, c in enumerate(counts):
                    c.append(sum(s[1] == k for s in base))
                digests.append(hashlib.sha256(_written(base).encode()).hexdigest())
                written.append(_written(every))
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, pa.int64()) for c in counts],
                                              pa.array(digests, pa.string()), pa.array(written, pa.string())], names=names)

    return df.select(column(df, "doc_id").cast("long").alias("doc_id"), column(df, "text").cast("string").alias("t")).mapInArrow(
        task(run), "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string")


def personal_data(df: DataFrame) -> DataFrame:
    return find(df, fit(df))


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """``text`` with every span replaced by its kind; overlapping spans are
    replaced as one, under the first one's kind."""
    out, at = [], 0
    for s, k, e in spans:
        if s >= at:
            out += [text[at:s], f"<{KINDS[k].upper()}>"]
        at = max(at, e)
    return "".join(out) + text[at:]


def redacted(df: DataFrame) -> DataFrame:
    """Rows of ``df`` with personal data in ``text`` replaced; ``n_chars``,
    where there is one, follows the new text.  Null texts stay null."""
    model = fit(df)
    names = [f"c{i}" for i in range(len(df.columns))]
    own = df.columns.index("text")
    sent = df.select(*[column(df, c).alias(n) for c, n in zip(df.columns, names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, names[own]):
            clean = [t if t is None or not _ANY.search(t) else redact(t, all_spans(t, model)[1])
                     for t in b.column(own).to_pylist()]
            arrays = list(b.columns)
            arrays[own] = pa.array(clean, arrays[own].type)
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    got = sent.mapInArrow(task(run), sent.schema)
    out = got.select(*[F.col(n).alias(c) for n, c in zip(names, df.columns)])
    if "n_chars" in df.columns:
        out = out.withColumn("n_chars", F.length("text").cast(df.schema["n_chars"].dataType))
    return out
