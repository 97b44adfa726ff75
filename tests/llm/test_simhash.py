"""SimHash near-dedup against a brute-force version."""

import re

import numpy as np
import xxhash
from pyspark.sql import types as T

from riskspark.llm import simhash
from riskspark.llm.queries import QUERIES, table
from tests.conftest import SF001

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("fp", T.StringType()), T.StructField("target", T.LongType())])


def slow_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(fps, radius=4):
    distinct = sorted(set(fps))
    arr = np.array(distinct, np.uint64)
    root = list(range(len(arr)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(arr)):
        for j in np.flatnonzero(np.bitwise_count(arr[i + 1 :] ^ arr[i]) <= radius):
            a, b = find(i), find(int(j) + i + 1)
            root[max(a, b)] = min(a, b)
    return {fp: find(i) for i, fp in enumerate(distinct)}


def check(rows, docs):
    fps = [slow_fingerprint(t) for _, t in docs]
    comp = slow_components(fps)
    low = {}
    for (d, _), f in zip(docs, fps):
        if d is not None:
            low[comp[f]] = min(low.get(comp[f], d), d)
    want = sorted(((d, f"{f:016x}", low.get(comp[f])) for (d, _), f in zip(docs, fps)), key=repr)
    assert sorted(map(tuple, rows), key=repr) == want


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF001, "documents").collect()]
    check(QUERIES["op10_simhash_near_dedup"](spark, SF001).collect(), docs)


def test_planted_distances_nulls_and_repeats(spark):
    rng = np.random.default_rng(1)
    base = [int(x) for x in rng.integers(0, 1 << 63, 300)]
    fps = list(base)
    for i, f in enumerate(base):  # copies 1 to 7 bits away, chains of two steps
        for k in (1 + i % 7, 4):
            for b in rng.choice(64, k, replace=False):
                f ^= 1 << int(b)
            fps.append(f)
    arr = np.array(fps, np.uint64)
    df = spark.createDataFrame([(i, int(x)) for i, x in enumerate(arr.view(np.int64))], "doc_id long, fp long")
    got = {r.doc_id: r.component_id for r in simhash.with_components(df).collect()}
    comp = slow_components(fps)
    low = {}
    for i, f in enumerate(fps):
        low.setdefault(comp[f], i)
    assert got == {i: low[comp[f]] for i, f in enumerate(fps)}


def test_edge_rows(spark):
    text = "The quick brown fox jumps over the lazy dog again and again until noon"
    docs = [(1, None), (2, ""), (3, " \t\n"), (4, text), (5, text.upper()), (5, text), (None, text), (7, "one"), (8, "é " * 5000), (8, "é " * 5000), (None, None)]
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], DOCS)
    check(simhash.near_duplicates(df).collect(), docs)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == [1, 4, 7, 8]  # copies without an id go, too
    other = "pack my box with five dozen liquor jugs and then some more of them"
    rows = [(None, other, "x", 1), (None, other, "y", 2), (9, text, "x", 1), (9, "nothing like the other text of this id at all", "x", 1)]
    kept = simhash.keep_one(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=repr) == sorted([(None, other), (9, text), (9, rows[3][1])], key=repr)
    assert simhash.near_duplicates(df.limit(0)).collect() == []


def test_rounds_give_the_same_components(spark, monkeypatch):
    monkeypatch.setattr(simhash, "PER_ROUND", 16)
    docs = [(r.doc_id, r.text) for r in table(spark, SF001, "documents").collect()]
    check(QUERIES["op10_simhash_near_dedup"](spark, SF001).collect(), docs)
