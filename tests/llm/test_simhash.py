import numpy as np
import xxhash
from pyspark.sql import functions as F

from duetlog.llm import simhash
from duetlog.llm.common import read
from .conftest import SF001


def plain_fingerprint(text):
    import re
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    sh = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute(pairs, bits=3):
    """doc ids and fingerprints -> (doc_id, fp, least reachable id)."""
    ids, fp = [p[0] for p in pairs], np.array([p[1] for p in pairs], dtype=np.uint64)
    part = list(range(len(ids)))

    def find(i):
        while part[i] != i:
            part[i] = part[part[i]]
            i = part[i]
        return i
    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(fp ^ fp[i]) <= bits):
            part[find(i)] = find(int(j))
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, int(fp[i]), least.get(find(i))) for i, d in enumerate(ids)), key=repr)


def rows(df):
    return sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in df.collect()), key=repr)


def test_whole_table_equals_brute_force(spark):
    docs = read(spark, SF001, "documents")
    want = brute([(r.doc_id, plain_fingerprint(r.text)) for r in docs.collect()])
    assert rows(simhash.near_duplicates(docs)) == want


def test_odd_rows(spark, odd_docs, no_docs):
    want = brute([(r.doc_id, plain_fingerprint(r.text)) for r in odd_docs.collect()])
    assert rows(simhash.near_duplicates(odd_docs)) == want
    assert simhash.near_duplicates(no_docs).count() == 0
    kept = simhash.representatives(odd_docs)
    assert kept.columns == odd_docs.columns or set(kept.columns) == set(odd_docs.columns)
    assert sorted(r.doc_id for r in kept.collect()) == sorted({d for d, _, c in want if d is not None and d == c})


def _cluster(n, seed, flips=2):
    """Distinct fingerprints around a few centres, plus noise."""
    rng = np.random.default_rng(seed)
    out = set(rng.integers(0, 1 << 63, 200, dtype=np.uint64).tolist())
    for c in rng.integers(0, 1 << 63, 3, dtype=np.uint64).tolist():
        for _ in range(n):
            v = c
            for b in rng.choice(64, rng.integers(0, flips + 1), replace=False):
                v ^= 1 << int(b)
            out.add(v)
    return sorted(out)


def test_crowded_keys_lose_no_link(spark):
    fps = _cluster(150, 5, flips=4)
    classes = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")
    want = brute(list(zip(range(len(fps)), fps)))
    for dense in (4096, 20):        # within a task, then through the hub form
        from duetlog.llm.components import roots
        root = {r.node: r.root for r in roots(simhash.links(classes, 3, dense)).collect()}
        first, got = {}, []
        for i, f in enumerate(fps):
            s = int(np.uint64(f).astype(np.int64))
            first.setdefault(root.get(s, s), i)
            got.append((i, f, first[root.get(s, s)]))
        assert sorted(got, key=repr) == want


def test_every_linked_pair_meets(spark):
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 64, 300, dtype=np.uint64, endpoint=False)
    b = a.copy()
    for i in range(300):
        for bit in rng.choice(64, i % 4, replace=False):
            b[i] ^= np.uint64(1) << np.uint64(bit)
    both = spark.createDataFrame([(int(x),) for x in set(np.concatenate([a, b]).view(np.int64).tolist())], "fp long")
    got = {frozenset((r.a, r.b)) for r in simhash.links(both).collect()}
    for x, y in zip(a.view(np.int64).tolist(), b.view(np.int64).tolist()):
        assert x == y or frozenset((x, y)) in got


def test_query_columns(spark):
    from duetlog.llm import queries
    df = queries.QUERIES["op8_simhash_near_dedup"](spark, SF001)
    assert dict(df.dtypes)["fingerprint"] == "string" and df.columns[:3] == ["doc_id", "fingerprint", "component_id"]
    assert df.where(~F.col("fingerprint").rlike("^[0-9a-f]{16}$")).count() == 0
