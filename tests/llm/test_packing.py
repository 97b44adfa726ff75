"""Packing: exact round trip of ids, gapless sequences, padding, the dynamic
programme against all choices."""

import itertools
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from riskspark.llm import packing
from riskspark.llm.queries import QUERIES, table
from tests.conftest import SF001

PATH = public_tokenizers.path("word_bpe_49k.json")


def check(rows, docs, size=4096, most_padding=0.02):
    tok = Tokenizer.from_file(PATH)
    ids = [np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], np.uint32) for _, t in docs]
    want, got, per = defaultdict(list), defaultdict(list), defaultdict(list)
    for (d, _), i in zip(docs, ids):
        want[d].append((len(i), zlib.crc32(i.tobytes())))
    for r in rows:
        got[r.doc_id].append(r)
        per[r.sequence_id].append((r.offset, r.length))
    assert set(got) == set(want)
    for d, pieces in got.items():
        whole = [i for (x, _), i in zip(docs, ids) if x == d]
        assert sum(p.length for p in pieces) == sum(map(len, whole))
        for p in pieces:
            assert any(p.doc_tokens == len(i) and zlib.crc32(i[p.start : p.start + p.length].tobytes()) == p.ids_crc32 for i in whole)
        if len(whole) == 1:
            at = 0
            for p in sorted(pieces, key=lambda p: p.start):
                assert p.start == at
                at += p.length
    pad = total = 0
    for own in per.values():
        at = 0
        for o, n in sorted(own):
            assert o == at and n > 0
            at += n
        assert at <= size
        total += at
        pad += 0 if at & (at - 1) == 0 else size - at
    assert pad <= most_padding * total
    return per


def test_query_round_trip(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF001, "documents").collect()]
    check(QUERIES["op9_packing"](spark, SF001).collect(), docs)


def test_edge_rows(spark):
    long = "word, " * 30000
    docs = [(1, None), (2, ""), (3, "  A Über-word… isn't <|endoftext|> 12. !!?? a.b. It's\t\x0bnew line x İstanbul é ΑΣ. "), (4, long), (4, long), (None, "x"), (5, "a" * 30000)]
    df = spark.createDataFrame([(d, t, 3, "y") for d, t in docs], "doc_id long, text string, start int, sequence_id string").coalesce(1)
    check(packing.pack(df, PATH).collect(), docs)
    assert packing.pack(df.limit(0), PATH).collect() == []


@given(st.lists(st.text(st.characters(exclude_categories=("Cs",)), max_size=30), max_size=6))
@settings(max_examples=150, deadline=None)
def test_ids_equal_the_tokenizers(texts):
    ids, n = packing.Ids.of(PATH).texts(pa.array(texts, pa.string()))
    tok = Tokenizer.from_file(PATH)
    want = [tok.encode(t, add_special_tokens=False).ids for t in texts]
    assert n.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


@given(st.lists(st.integers(1, 6), min_size=1, max_size=9), st.data())
@settings(max_examples=100, deadline=None)
def test_cuts_are_the_cheapest(gaps, data):
    size = 8
    ends = np.cumsum(gaps)
    cost = np.array(data.draw(st.lists(st.integers(0, 5), min_size=len(gaps), max_size=len(gaps))))
    pen = dict(zip(ends.tolist(), cost.tolist()))

    def price(chosen):
        at = total = 0
        for p in chosen:
            n = p - at
            if n > size:
                return None
            total += (0 if n in (2, 4) else size - n) + pen[p]
            at = p
        return total

    got = packing.cuts(ends, cost, size)
    best = min(x for k in range(len(ends) + 1) for c in itertools.combinations(ends.tolist(), k) if (not c or c[-1] > ends[-1] - size or c[-1] == ends[-1]) and (c or ends[-1] < size) and (x := price(c)) is not None)
    assert (price(got) if got or ends[-1] < size else None) == best


def test_tail_needs_no_padding():
    for n in range(0, 5000, 37):
        ends = packing.tail_cuts(min(n, 4095), 4096)
        sizes = np.diff([0, *ends])
        assert sum(sizes) == min(n, 4095) and all(s & (s - 1) == 0 or s > 4032 for s in sizes.tolist())
