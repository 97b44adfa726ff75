"""Licence scan: phrases and templates against plain searches, edge rows."""

import re

import numpy as np
import pytest

from riskspark.llm import licences
from riskspark.llm.licences import PHRASES, TEMPLATES, Index, words_of
from riskspark.llm.queries import QUERIES, table
from tests.conftest import SF01

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})


def plain_words(text):
    return WORD.findall((text or "").translate(LOWER))


def plain_base(text):
    words, out = plain_words(text), []
    for phrase, label in PHRASES:
        p = phrase.split()
        out += [(i, label) for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
    return len(words), sorted(out)


def stands(words, phrase):
    p = plain_words(phrase)
    return [i for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]


def notices():
    """Texts with notices: whole, within other words, with words changed, in part."""
    rng = np.random.default_rng(1)
    noise = [f"n{i}" for i in range(60)]
    out = []
    for t in TEMPLATES:
        words = t.text.split()
        before, after = (list(rng.choice(noise, int(rng.integers(0, 80)))) for _ in range(2))
        out.append((t.label, True, " ".join([*before, *words, *after])))
        out.append((t.label, False, " ".join([*before, *words[: len(words) // 3], *after])))
        if len(words) > 40:
            middle = len(words) // 2
            out.append((t.label, False, " ".join([*words[:middle], *rng.choice(noise, 900), *words[middle:]])))
    return out


def test_words_are_the_contracts():
    text = "A-b\tÄé_9\x00\x7f\x80 ﬁ İ K 中文,x" + "".join(map(chr, range(300)))
    assert [w.decode() for w in words_of(text)] == plain_words(text)
    assert words_of(None) == words_of("") == []


def test_query_base_columns_against_plain_search(spark):
    got = {r.doc_id: r for r in QUERIES["op11_license_scan"](spark, SF01).collect()}
    docs = table(spark, SF01, "documents").collect()
    assert len(got) == len(docs)
    for d in docs:
        n, base = plain_base(d.text)
        labels = sorted({x for _, x in base})
        r = got[d.doc_id]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (n, len(base), base[0][0] if base else None, base[-1][0] if base else None, ",".join(labels))
        assert set(labels) <= set(r.labels.split(",")) and r.score == (1.0 if base else 0.0)
    assert sum(r.n_base > 0 for r in got.values()) > 10


def test_whole_notices_are_found_and_parts_are_not(spark):
    rows = [(i, t) for i, (_, _, t) in enumerate(notices())]
    got = {r.doc_id: r for r in licences.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, (label, whole, text) in enumerate(notices()):
        found = [m for m in got[i].matches if m.label == label]
        if whole:
            first = next(t for t in TEMPLATES if t.label == label and t.text in text).phrases[0]
            assert [m.start for m in found if m.share == 1.0] == stands(plain_words(text), first)[:1], text
        elif len(plain_words(text)) > 900:
            assert not found, text


def test_matches_against_a_search_of_all_places():
    """Without looking up rare words: each stretch of places, all words counted."""
    index = Index()
    for _, _, text in notices():
        words = words_of(text)
        ids = np.array([index.words.get(w, -1) for w in words])
        want = set()
        for k, t in enumerate(index.templates):
            own, n = words_of(t.text), len(words_of(t.text))
            weight = {w: index.idf[index.words[w]] for w in own}
            looked_up = sorted({w for w in own if w in words}, key=lambda w: index.place[index.words[w]])[: licences.RARE]
            at = [stands([w.decode() for w in words], p) for p in t.phrases]
            best = {}
            for s in range(-n // licences.SLACK - 1, len(words) // licences.SLACK + 1):
                a, b = s * licences.SLACK, (s + 2) * licences.SLACK
                met = {w for w in looked_up for i, x in enumerate(words) if x == w for j, y in enumerate(own) if y == w and a <= i - j < b}
                inside = [[x for x in xs if a <= x < b + n] for xs in at]
                if 2 * len(met) > len(looked_up) and all(inside) and inside:
                    share = sum(weight[w] for w in set(words[max(0, a) : b + n]) if w in weight) / sum(weight.values())
                    if share >= licences.SHARE:
                        best[inside[0][0]] = max(best.get(inside[0][0], 0), share)
            want |= {(t.label, s, round(x, 9)) for s, x in best.items()}
        got = {(label, s, round(x, 9)) for label, s, x in index.scan(words, licences.RARE, licences.SLACK, licences.SHARE)[1]}
        assert got == want


def test_changed_words_within_the_share(spark):
    mit = next(t for t in TEMPLATES if t.label == "mit").text
    changed = mit.replace("copyright notice", "notice of copyright").replace("substantial", "large")
    other = mit.replace("without restriction", "with restrictions")  # a key phrase is gone
    rows = [(1, "Copyright 2020 Ann Other\n" + changed), (2, other), (3, mit + " " + "filler " * 200 + mit)]
    got = {r.doc_id: {(m.label, m.start) for m in r.matches} for r in licences.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: {("mit", 4)}, 2: set(), 3: {("mit", 0), ("mit", len(plain_words(mit)) + 200)}}


def test_edge_rows(spark):
    long = "mit license " * 60_000 + "x"
    rows = [(1, None), (2, ""), (3, "MIT"), (4, "mit\n-- License CC.BY"), (4, "mit\n-- License CC.BY"), (None, "apache license"), (5, "apache licenses"), (6, "mit mit license license"), (7, long), (8, "gnu general public licenße")]
    df = spark.createDataFrame([(i, t, 3, "x", [1]) for i, t in rows], "doc_id long, text string, n_words int, label string, places array<int>")
    got = sorted(((r.doc_id or -1, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in licences.digest(licences.scan(df)).collect()), key=str)
    want = []
    for i, t in rows:
        n, base = plain_base(t)
        want.append((i or -1, n, len(base), base[0][0] if base else None, base[-1][0] if base else None, ",".join(sorted({x for _, x in base}))))
    assert got == sorted(want, key=str)
    assert licences.digest(licences.scan(df.limit(0))).collect() == []


def test_templates_need_key_phrases():
    with pytest.raises(ValueError):
        Index([licences.Template("x", "some text", ())])
