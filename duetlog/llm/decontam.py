"""Benchmark decontamination by spaced-seed hashing; built-in functions only.

Tokens are maximal runs of letters and digits, in lower case.  A mask is a
fixed pattern over consecutive tokens; only its set places are hashed, so a
substituted word at an ignored place does not hide a match.  Every mask at
every position of every item gives the test seeds; the same of every whole
document is made and probed on the fly, inside one generated stage, and never
shuffled.  A hit fixes a document, an item and how they align.

Verification compares the tokens along the alignment.  A document overlaps an
item when

* all but a quarter of the item's tokens stand in their places (items of
  ``LOOSE_TOKENS`` tokens on; shorter ones must stand whole), or
* the best stretch reaches ``MIN_SCORE``, where a matching token scores +1 and
  another one -``PENALTY``: a part of a long item is enough.

So a passage is found with words replaced, and a few common words in the right
places are not.  The three masks hit every item of 8 to 16 tokens with one or
two tokens replaced, wherever they are, and every item with each fourth token
replaced (``tests/llm/test_decontam.py`` tries all placements).

A seed that an item repeats counts at its first and its last position there,
so repeated words make rows in proportion to their number.  Every hit is a row
of its own; no list of them is gathered.  The seed table is broadcast only if
its counted rows stay under ``MAX_BROADCAST_SEEDS``; beyond that the join
shuffles on the seed (with adaptive skew splitting).

Defined results: null or empty texts and items have no tokens and no hits; an
item of fewer than ``MIN_TOKENS`` tokens is no passage and is not looked for;
repeated documents or items give one row per (doc_id, item_id) with the best
score; documents without an overlap have no row.  Extra columns are passed by.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, saved

#: Fixed masks: 1 = the token counts, 0 = it is ignored.
MASKS = ("1111", "11011", "1100011")
#: The least tokens of an item, and those from which on a quarter may differ.
MIN_TOKENS = 4
LOOSE_TOKENS = 8
PENALTY = 2
MIN_SCORE = 10
MAX_BROADCAST_SEEDS = 1_000_000


def token_hashes(text: Column) -> Column:
    """64-bit hashes of a text's tokens."""
    words = F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), "[^\\p{L}\\p{N}]+")
    return F.transform(F.filter(words, lambda w: w != F.lit("")), lambda w: F.xxhash64(w))


def _seeds(tokens: Column, at: Column) -> Column:
    """The seed of every mask at one position (null past the end)."""
    seeds = []
    for n, mask in enumerate(MASKS):
        taken = [F.get(tokens, at + i) for i, c in enumerate(mask) if c == "1"]
        seeds.append(F.when(taken[-1].isNotNull(), F.xxhash64(F.lit(n), *taken)))
    return F.array(*seeds)


def _positions(df: DataFrame, tokens: str, *keep: str) -> DataFrame:
    """(keep, at, seed): every mask at every position."""
    last = F.size(tokens) - min(map(len, MASKS))     # no filter on the size: it would tokenise a second time below
    at = df.select(*keep, tokens, F.explode(F.when(last >= 0, F.sequence(F.lit(0), last))).alias("at"))
    return at.select(*keep, "at", F.explode(_seeds(F.col(tokens), F.col("at"))).alias("seed")).where(F.col("seed").isNotNull())


def best_stretch(same: Column) -> Column:
    """Score of the best stretch of an array of booleans."""
    zero = F.struct(F.lit(0).alias("now"), F.lit(0).alias("best"))

    def add(state, s):
        now = F.greatest(F.lit(0), state["now"] + F.when(s, F.lit(1)).otherwise(F.lit(-PENALTY)))
        return F.struct(now.alias("now"), F.greatest(state["best"], now).alias("best"))

    return F.aggregate(same, zero, add, lambda a: a["best"])


def overlaps(documents: DataFrame, items: DataFrame, doc_key: str = "doc_id", item_key: str = "item_id",
             text: str = "text") -> DataFrame:
    """(doc_id, text_hash, item_id, score) of every document with a verified
    overlap; ``text_hash`` tells rows with the same id and other texts apart.

    The probe keeps (document, item, shift) only; the texts of documents with
    a hit are read again and meet their hits one by one, each with the few
    tokens along its alignment."""
    test = items.select(column(items, item_key).alias("item_id"), token_hashes(column(items, text)).alias("item"))
    test = test.where(F.size("item") >= MIN_TOKENS).withColumn("item_no", F.xxhash64("item_id", "item")).dropDuplicates(["item_no"])
    test = test.withColumn("n", F.size("item"))
    seeds = _positions(test, "item", "item_no", "n").groupBy("item_no", "n", "seed").agg(F.min("at").alias("a"), F.max("at").alias("b"))
    seeds = seeds.select("item_no", "n", "seed", F.explode(F.array_distinct(F.array("a", "b"))).alias("item_at"))
    id_, whole = column(documents, doc_key), column(documents, text)
    tokens = documents.select(id_.alias("doc_id"), F.xxhash64(whole).alias("text_hash"), token_hashes(whole).alias("tokens"))
    if seeds.limit(MAX_BROADCAST_SEEDS + 1).count() <= MAX_BROADCAST_SEEDS:
        seeds = F.broadcast(seeds)
    hits = _positions(tokens, "tokens", "doc_id", "text_hash").join(seeds, "seed").select(
        "doc_id", "text_hash", "item_no", "n", (F.col("at") - F.col("item_at")).alias("shift")).distinct()
    hits = hits.select(F.col("doc_id").alias("hit_id"), F.col("text_hash").alias("hit_hash"), "item_no", "n", "shift")
    hits = saved(hits, "decontam-hits")                 # probed once; read twice below
    texts = documents.select(id_.alias("doc_id"), whole.alias("text"), F.xxhash64(whole).alias("text_hash"))
    hit_texts = hits.select("hit_id", "hit_hash").distinct()
    again = texts.join(hit_texts, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("text_hash") == F.col("hit_hash")))
    again = again.select("doc_id", "text_hash", "text").dropDuplicates(["doc_id", "text_hash"]).select("doc_id", "text_hash", token_hashes(F.col("text")).alias("tokens"))
    met = again.join(hits, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("text_hash") == F.col("hit_hash")))
    shift = F.col("shift")                              # item token i stands against document token i + shift
    along = met.select("doc_id", "text_hash", "item_no", F.greatest(F.lit(0), -shift).alias("first"), F.slice(
        "tokens", F.greatest(F.lit(0), shift) + 1, F.col("n")).alias("rest"))
    return _verified(along, test)


def _verified(along: DataFrame, test: DataFrame) -> DataFrame:
    """Alignments (``rest``: the document's tokens from item token ``first``
    on) that hold, with their scores."""
    item = F.col("item")
    length = F.least(F.size(item) - F.col("first"), F.size("rest"))
    rows = along.join(test, "item_no")
    same = F.zip_with(F.slice(item, F.col("first") + 1, length), F.slice("rest", F.lit(1), length), lambda a, b: a == b)
    rows = rows.select("doc_id", "text_hash", "item_id", F.size(item).alias("n"), same.alias("same"))
    matched = F.size(F.filter("same", lambda x: x))
    missing = F.when(F.col("n") >= LOOSE_TOKENS, F.floor(F.col("n") / 4)).otherwise(0)
    rows = rows.withColumn("score", best_stretch(F.col("same"))).where(
        (matched >= F.col("n") - missing) | (F.col("score") >= MIN_SCORE))
    return rows.groupBy("doc_id", "text_hash", "item_id").agg(F.max("score").alias("score"))


def contaminated(documents: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, score): the pairs of document and leaked item."""
    return overlaps(documents, items).groupBy("doc_id", "item_id").agg(F.max("score").alias("score"))


def cleaned(documents: DataFrame, items: DataFrame) -> DataFrame:
    """Rows of ``documents`` without any verified overlap."""
    bad = overlaps(documents, items).select(F.col("doc_id").alias("_bad_id"), F.col("text_hash").alias("_bad_text")).distinct()
    own = column(documents, "doc_id"), column(documents, "text")
    return documents.join(bad, own[0].eqNullSafe(bad["_bad_id"]) & (F.xxhash64(own[1]) == bad["_bad_text"]), "left_anti")


def oracle_sql() -> str:
    """Every alignment of every item with every document, tried in DuckDB: no
    masks.  (Those without ``MIN_TOKENS`` equal tokens cannot hold.)"""
    words = "list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda x: x <> '')"
    return f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, {words} AS w FROM documents),
b AS (SELECT row_number() OVER () AS item, item_id, {words} AS v FROM benchmark),
dt AS (SELECT k, unnest(w) AS t, unnest(range(1, len(w) + 1)) AS p FROM d),
bt AS (SELECT item, unnest(v) AS t, unnest(range(1, len(v) + 1)) AS i FROM b WHERE len(v) >= {MIN_TOKENS}),
al AS (SELECT k, item, p - i AS shift, count(*) AS n FROM dt JOIN bt USING (t) GROUP BY ALL HAVING count(*) >= {MIN_TOKENS}),
step AS (SELECT k, item, shift, n, len(v) AS size, i, CASE WHEN w[i + shift] = v[i] THEN 1 ELSE -{PENALTY} END AS s
         FROM (SELECT al.*, d.w, b.v, unnest(range(1, len(b.v) + 1)) AS i FROM al JOIN d USING (k) JOIN b USING (item)
               WHERE n >= {MIN_SCORE} OR n >= len(v) - CASE WHEN len(v) >= {LOOSE_TOKENS} THEN len(v) // 4 ELSE 0 END)
         WHERE i + shift BETWEEN 1 AND len(w)),
run AS (SELECT *, sum(s) OVER (PARTITION BY k, item, shift ORDER BY i) AS t FROM step),
low AS (SELECT *, least(0, min(t) OVER (PARTITION BY k, item, shift ORDER BY i)) AS l FROM run),
best AS (SELECT k, item, shift, n, size, max(t - l) AS score FROM low GROUP BY ALL)
SELECT doc_id, item_id, CAST(max(score) AS INTEGER) AS score FROM best JOIN d USING (k) JOIN b USING (item)
WHERE score >= {MIN_SCORE} OR n >= size - CASE WHEN size >= {LOOSE_TOKENS} THEN size // 4 ELSE 0 END GROUP BY doc_id, item_id"""
