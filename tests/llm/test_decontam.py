"""Benchmark decontamination against DuckDB, a regex version and edge rows."""

import re

import duckdb
import pytest

from riskspark.llm import decontam
from riskspark.llm.queries import QUERIES, SQL
from tests.conftest import SF01

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
ITEMS = [(1, "What is the one true answer to this very long question, asked twice?"), (2, "Yes."), (2, "No way"), (3, None), (4, "--"), (None, "secret item"), (5, "Ünï cödé")]
DOCS = [
    (1, "he said YES, and no-way; what is THE one true answer to this very long question indeed"),
    (2, None), (3, ""), (4, "?!"), (5, "a secret: item. ünï cödé yes!"), (5, "a secret: item. ünï cödé yes!"), (None, "noway yesterday"), (6, "ÜNÏ CÖDÉ " + "x y " * 50000 + "Yes"),
]


def lower(s):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in s or "")


def slow(text, items, window=10):
    found = [(m.start(), m.end()) for m in WORD.finditer(lower(text))]
    words = WORD.findall(lower(text))
    hit, ids = set(), set()
    for item, t in items:
        own = WORD.findall(lower(t))
        k = min(window, len(own))
        wins = {tuple(own[i : i + k]) for i in range(len(own) - k + 1)} if own else set()
        for i in range(len(words) - k + 1):
            if tuple(words[i : i + k]) in wins:
                hit |= set(range(i, i + k))
                ids |= {str(item)} if item is not None else set()
    spans = []
    for i in sorted(hit):
        if i - 1 in hit:
            spans[-1] = (spans[-1][0], found[i][1])
        else:
            spans.append(found[i])
    return len(words), len(hit), sorted(ids), spans


def tables(spark):
    docs = spark.createDataFrame([(d, t, 9, "x") for d, t in DOCS], "doc_id long, text string, n_hit int, item_id string")
    return docs, spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id long, text string, doc_id string")


@pytest.mark.parametrize("max_bytes", [decontam.MAX_BYTES, 40])
def test_rows_equal_regex_version(spark, max_bytes):
    docs, items = tables(spark)
    got = decontam.matches(docs, items, max_bytes=max_bytes).collect()
    key = lambda r: repr(r)
    have = sorted(((r.doc_id, r.n_words, r.n_hit, list(r.item_ids), [tuple(s) for s in r.spans]) for r in got), key=key)
    want = sorted(((d, w, h, i, s) for d, t in DOCS for w, h, i, s in [slow(t, ITEMS)]), key=key)
    assert have == want
    kept = decontam.keep_clean(docs, items, max_bytes=max_bytes)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == [2, 3, 4, None]


def test_empty_tables(spark):
    docs, items = tables(spark)
    assert decontam.matches(docs.limit(0), items).collect() == []
    got = decontam.digest(decontam.matches(docs, items.limit(0))).collect()
    assert len(got) == len(DOCS) and not any(r.contaminated for r in got) and {r.items_sha256 for r in got} == {decontam.items_sha256([])}
    assert decontam.keep_clean(docs, items.limit(0)).count() == len(DOCS)


def test_query_equals_duckdb(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from read_parquet('{SF01}/{t}.parquet')")
    got = QUERIES["op3_benchmark_decontamination"](spark, SF01)
    rel = con.execute(SQL["op3_benchmark_decontamination"])
    names = [c[0] for c in rel.description]
    assert sorted(names) == sorted(got.columns)
    rows = sorted(map(tuple, got.select(*names).collect()))
    assert rows == sorted(map(tuple, rel.fetchall())) and any(r[-1] for r in rows)
