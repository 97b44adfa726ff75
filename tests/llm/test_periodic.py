"""Periodic runs: the suffix-array method against plain comparison, the query against a
plain version of its contract, edge rows."""

import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskspark.llm import periodic
from riskspark.llm.queries import QUERIES, table
from tests.conftest import SF001


def brute(t, shortest=24, least=3):
    """Every maximal stretch of each period, the smallest period first."""
    out, seen = [], set()
    for q in range(1, len(t) // least + 1):
        i = 0
        while i + q < len(t):
            s = i
            while i + q < len(t) and t[i] == t[i + q]:
                i += 1
            if i > s and i + q - s >= max(shortest, least * q) and (s, i + q) not in seen:
                seen.add((s, i + q))
                out.append((s, i + q - s, q))
            i += 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def as_tuples(runs):
    return [tuple(r) for r in runs.tolist()]


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 2**32), st.integers(0, 90), st.integers(1, 3), st.sampled_from([(24, 3), (6, 2), (4, 3), (9, 4)]))
def test_runs_against_plain_comparison(seed, n, letters, rule):
    rng = np.random.default_rng(seed)
    t = rng.integers(0, letters, n)
    if n > 4 and seed % 3:
        a, p = int(rng.integers(0, n)), int(rng.integers(1, 12))
        for i in range(a, n):
            t[i] = t[a + (i - a) % p] if rng.random() < 0.99 else t[i]
    assert as_tuples(periodic.runs_of(t, *rule)) == brute(t.tolist(), *rule)


@pytest.mark.parametrize("t, want", [
    ([], []), ([1], []), ([1] * 23, []), ([1] * 24, [(0, 24, 1)]),
    ([0] + [1, 2] * 12 + [3], [(1, 24, 2)]),
    ([*range(8)] * 3, [(0, 24, 8)]), ([*range(9)] * 3 + [0, 1], [(0, 29, 9)]), ([*range(9)] * 2 + [*range(8)], []),
    # a run whose words repeat at a smaller period inside: both are runs
    (([1] * 30 + [2]) * 4, [(0, 30, 1), (0, 124, 31), (31, 30, 1), (62, 30, 1), (93, 30, 1)]),
])
def test_known_runs(t, want):
    assert as_tuples(periodic.runs_of(np.array(t, np.int64))) == want


def test_repeated_windows_are_never_missed():
    rng = np.random.default_rng(5)
    for _ in range(200):
        texts = [rng.integers(0, 2, int(rng.integers(0, 60))) for _ in range(5)]
        found = periodic.repeats(np.concatenate(texts), np.cumsum([len(t) for t in texts]), 8)
        for t, hit in zip(texts, found):
            windows = [tuple(t[i : i + 8]) for i in range(len(t) - 7)]
            assert hit == (len(set(windows)) < len(windows))


def plain(doc_id, text):
    """The query's contract, word for word."""
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    code = {}
    runs = brute([code.setdefault(w, len(code)) for w in words])
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2] or (r[1] * best[2] == best[1] * r[2] and (r[0], r[2]) < (best[0], best[2])):
            best = r
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()), sha(b" ".join(w for i, w in enumerate(words) if i not in gone)))


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def key(row):
    return [(x is not None, x) for x in row]


def test_query_against_its_contract(spark):
    got = QUERIES["op13_periodic_runs"](spark, SF001)
    assert got.columns == COLUMNS and dict(got.dtypes)["exponent_milli"] == "bigint"
    docs = table(spark, SF001, "documents").collect()
    want = [plain(r.doc_id, r.text) for r in docs]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    assert sum(r[1] > 0 for r in want) > 5


def test_edge_rows(spark):
    planted = next(i for i in range(1000) if zlib.crc32(str(i).encode()) % 10 == 0)
    long = " ".join(f"w{i % 50_000}" for i in range(160_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (None, "a b " * 20), (None, "a b " * 20), (4, "x " * 24), (4, "x " * 23), (5, "é\x0bß\x0c" * 12), (planted, None), (planted, " "), (planted, "one"), (planted, " ".join(map(str, range(97)))), (6, "a b " * 30)]
    df = spark.createDataFrame([(i, t, "x", 1, [1]) for i, t in rows], "doc_id long, text string, runs string, n_words int, collapsed array<int>")
    got = sorted(map(tuple, periodic.digest(periodic.detect(periodic.planted(df))).collect()), key=key)
    assert got == sorted((plain(i, t) for i, t in rows), key=key)
    texts = {r.doc_id: r.collapsed for r in periodic.detect(df.where("doc_id in (1, 2, 5)")).collect()}
    assert texts == {1: None, 2: "", 5: "é ß"}
    one = periodic.detect(spark.createDataFrame([(7, long)], "doc_id long, text string")).first()
    assert [tuple(r) for r in one.runs] == [(0, 160_000, 50_000)] and one.n_words == 160_000
    assert periodic.digest(periodic.detect(df.limit(0))).collect() == []


def test_same_rows_for_any_partitions(spark):
    docs = table(spark, SF001, "documents").select("doc_id", F.repeat(F.concat("text", F.lit(" ")), 3).alias("text"))
    a, b = (sorted(map(tuple, periodic.digest(periodic.detect(docs.repartition(n))).collect())) for n in (1, 7))
    assert a == b and sum(r[1] > 0 for r in a) > len(a) // 2
