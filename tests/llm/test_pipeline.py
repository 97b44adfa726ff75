"""The corpus pipeline against brute-force versions of its stages."""

import zlib
from collections import Counter

import __spark_entry__ as entry
import corpus_pipeline as C
from tests.conftest import SF001
from tests.llm.test_decontam import slow as slow_matches
from tests.llm.test_langid import slow_ngrams, slow_order
from tests.llm.test_linededup import slow as slow_lines
from tests.llm.test_packing import check as check_packed
from tests.llm.test_simhash import slow_components, slow_fingerprint


def slow_languages(docs):
    counts = {}
    for d, t, lang in docs:
        if lang and t and (d is None or zlib.crc32(str(d).encode()) % 5):
            counts.setdefault(lang, Counter()).update(slow_ngrams(t))
    assert counts and all(slow_order(c) for c in counts.values())
    return [(d, t) for d, t, _ in docs if any(c.isalpha() for c in t or "")]


def slow_run(docs, items):
    kept = slow_languages(docs)
    kept = [(d, t) for d, _, _, t, _ in slow_lines(kept)]
    fps = [slow_fingerprint(t) for _, t in kept]
    comp, least = slow_components(fps), {}
    for (d, _), f in zip(kept, fps):
        least[comp[f]] = min(least.get(comp[f], d), d)
    kept = [(d, t) for (d, t), f in zip(kept, fps) if least[comp[f]] == d]
    return [(d, t) for d, t in kept if not slow_matches(t, items)[1]]


def test_pipeline_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    want = slow_run([(r.doc_id, r.text, r.lang) for r in docs.collect()], items)
    assert 0 < len(want) < docs.count()
    check_packed(entry.queries()["pipeline"](spark, SF001).collect(), want)


def test_stages_keep_columns_and_take_empty_tables(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").limit(0)
    for name, stage in C.STAGES[:-1]:
        out = stage(spark, docs, SF001)
        assert out.columns == docs.columns and out.collect() == [], name
    assert C.STAGES[-1][1](spark, docs, SF001).collect() == []


def test_stages_take_nulls_and_clashing_columns(spark):
    rows = [(1, "the cat sat on the mat and sat there", "en", None, 3, "x"), (1, "the cat sat on the mat and sat there", "en", None, 3, "x"), (None, "a row without an id", None, "s", 1, "y"), (2, None, "en", "s", None, "z"), (3, "", None, None, 0, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, fp string")
    for name, stage in C.STAGES[:-1]:
        docs = C.cut(stage(spark, docs, SF001), name)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "fp"]
    assert sorted((r.doc_id for r in docs.collect()), key=repr) == [1, None]
    assert {r.doc_id for r in C.STAGES[-1][1](spark, docs, SF001).collect()} == {1, None}
