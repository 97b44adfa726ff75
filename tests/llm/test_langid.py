"""Language identification: held-out accuracy, a plain version, edge rows."""

from collections import Counter

from pyspark.sql import functions as F

from riskspark.llm import langid
from riskspark.llm.queries import QUERIES, table
from tests.conftest import SF01


def slow_ngrams(text):
    s = "".join(c if c.isalpha() else " " for c in text.lower())
    s = f" {' '.join(s.split())} "
    return [s[i : i + n] for n in (1, 2, 3) for i in range(len(s) - n + 1) if s[i : i + n] != " "] if s.strip() else []


def slow_order(counts):
    return sorted(counts, key=lambda g: (-counts[g], len(g), [0 if c == " " else ord(c) for c in g]))[: langid.TOP]


def test_query_equals_plain_version_and_is_accurate(spark):
    docs = table(spark, SF01, "documents").withColumn("held", langid.held_out("doc_id", 5, 0))
    rows = docs.collect()
    counts = {}
    for r in rows:
        if not r.held:
            counts.setdefault(r.lang, Counter()).update(slow_ngrams(r.text))
    place = {lang: {g: i for i, g in enumerate(slow_order(c))} for lang, c in counts.items()}
    got = {r.doc_id: r for r in QUERIES["op4_language_id"](spark, SF01).collect()}
    assert len(got) == len(rows) and {d: r.held_out for d, r in got.items()} == {r.doc_id: r.held for r in rows}
    for r in rows[::7]:
        own = slow_order(Counter(slow_ngrams(r.text)))
        far = {lang: sum(abs(p[g] - i) if g in p else langid.TOP for i, g in enumerate(own)) for lang, p in place.items()}
        assert got[r.doc_id].lang_pred == min(sorted(far), key=far.get)
        assert abs(got[r.doc_id].score - (1 - min(far.values()) / (langid.TOP * len(own)))) < 1e-12
    held = [r for r in rows if r.held]
    assert sum(got[r.doc_id].lang_pred == r.lang for r in held) >= 0.97 * len(held)


def test_edge_rows(spark):
    schema = "doc_id long, text string, lang string, lang_pred string, held_out int, score string"
    rows = [(1, None, "en"), (2, "", "en"), (3, "12 34 !!", "en"), (4, "the cat the dog", "en"), (11, "der hund und die katze", "de"), (4, "the cat the dog", "en"), (None, "the dog", None), (8, "ж" * 200000, None), (9, "the", None)]
    docs = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], schema)
    model = langid.ranker(docs)
    got = langid.identify(docs, model)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    found = got.collect()
    pred = {r.doc_id: r.lang_pred for r in found}
    assert len(found) == len(rows) and pred[1] == pred[2] == pred[3] == "und" and pred[4] == pred[9] == "en" and pred[11] == "de"
    assert all(0 <= r.score <= 1 for r in found) and pred[8] in ("de", "en")
    kept = langid.keep_identified(docs, model)
    assert kept.schema == docs.schema and kept.count() == 6
    none = docs.limit(0)
    assert langid.identify(none, langid.ranker(none)).collect() == []
    assert {r.lang_pred for r in langid.identify(docs, langid.ranker(none)).collect()} == {"und"}


def test_profile_parts_are_merged_whole(spark, monkeypatch):
    docs = table(spark, SF01, "documents").where("lang = 'de'").select("text", "lang")
    want = langid.profiles(docs)
    monkeypatch.setattr(langid, "HELD", 0)
    many = docs.repartition(7)
    got = langid.profiles(many)
    assert list(want) == ["de"] and (want["de"] == got["de"]).all()
    assert many.where(F.col("text").isNull()).count() == 0
