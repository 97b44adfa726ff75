"""Quality classifier: held-out accuracy, word vectors against plain counting,
edge rows."""

import re

import numpy as np

from riskspark.llm import quality, tokens
from riskspark.llm.queries import QUERIES, table
from tests.conftest import SF01

DOCS = "doc_id long, text string, x string, score string, label int"


def test_query_is_accurate_on_held_out_rows(spark):
    got = {r.doc_id: r for r in QUERIES["op2_quality_classifier"](spark, SF01).collect()}
    labels = {r.doc_id: r.quality for r in table(spark, SF01, "labels").collect()}
    assert len(got) == table(spark, SF01, "documents").count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    held = [(got[d].predicted, y) for d, y in labels.items() if d in got and got[d].held_out]
    assert len(held) > 40 and np.mean([p == y for p, y in held]) >= 0.97


def test_runs_are_those_of_a_regex():
    texts = [b"The cat!! sat, on 3 m\xc3\xa4ts\n\n*** a", None, b"", b"  x ", "é".encode() * 5000]
    r = tokens.runs(texts, tokens.KINDS)
    want = [(i, m) for i, t in enumerate(texts) for m in re.findall(rb"[0-9A-Za-z\x80-\xff]+|[!-/:-@\[-`{-~]+", t or b"")]
    assert [(int(i), bytes(r.data[a:b])) for i, a, b in zip(r.text, r.start, r.end)] == want
    h = r.hashes()
    assert len({(m, int(x)) for (_, m), x in zip(want, h)}) == len({m for _, m in want}) == len(set(h.tolist()))
    assert [r.first[i + 1] - r.first[i] for i in range(len(texts))] == [sum(j == i for j, _ in want) for i in range(len(texts))]


def test_word_vectors_are_sums_over_all_documents(spark):
    texts = ["a b c a", None, "", "c, c b", "a b c a"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    index, want = quality.index_vectors(), np.zeros((quality.BUCKETS, quality.DIM + 1), np.int64)
    for t in texts:
        b, _ = quality.buckets([(t or "").encode()])
        for i in range(len(b)):
            want[b[i], -1] += 1
            for j in range(len(b)):
                if 0 < abs(i - j) <= 2:
                    want[b[i], :-1] += index[b[j]]
    assert (quality.word_vectors(docs) == want).all()


def test_edge_rows(spark):
    rows = [(i, f"good plain words number {i} here", 1) for i in range(40)] + [(100 + i, f"!! $$ %% {i} ##", 0) for i in range(40)]
    docs = spark.createDataFrame([(*r[:2], "x", "y", 5) for r in rows] + [(200, None, "x", "y", 5), (201, "", "x", "y", 5), (None, "x", "x", "y", 5), (3, "twice", "x", "y", 5), (202, "w " * 300000, "x", "y", 5)], DOCS)
    labels = spark.createDataFrame([(r[0], r[2], 0, "z") for r in rows] + [(None, 1, 0, "z"), (1, None, 0, "z"), (2, 7, 0, "z"), (3, 0, 0, "z"), (999, 1, 0, "z")], "doc_id long, quality int, toxic int, text string")
    got = quality.scored(docs, labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    found = got.collect()
    assert len(found) == docs.count() and all(0 <= r.score <= 1 for r in found)
    held = [(r.predicted, int(r.doc_id < 100)) for r in found if r.held_out and r.doc_id is not None and r.doc_id < 200]
    assert all(p == y for p, y in held)
    assert quality.scored(docs.limit(0), labels).collect() == []
    assert {r.score for r in quality.scored(docs, labels.limit(0)).collect()} == {0.5}
    assert {r.score for r in quality.scored(docs, labels.where("quality = 1 and doc_id <> 3")).collect()} == {1.0}
