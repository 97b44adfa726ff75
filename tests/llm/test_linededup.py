"""Line dedup against brute force; the band against plain dynamic programming."""

import random

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from riskspark.llm import linededup as L
from riskspark.llm.queries import QUERIES, table
from tests.conftest import SF001


def slow_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def slow_near(a, b, tau):
    """Plain dynamic programming over the cells at most tau off the diagonal."""
    row = {j: j for j in range(min(tau, len(b)) + 1)}
    for i, x in enumerate(a, 1):
        new = {}
        for j in range(max(0, i - tau), min(len(b), i + tau) + 1):
            best = [row[j] + 1] if j in row else []
            if j and j - 1 in new:
                best.append(new[j - 1] + 1)
            if j and j - 1 in row:
                best.append(row[j - 1] + (x != b[j - 1]))
            new[j] = min(best)
        row = new
    return row.get(len(b), tau + 1) <= tau


def edited(rng, s, n):
    s = list(s)
    for _ in range(n):
        i, k = rng.randrange(len(s) + 1), rng.random()
        if k < 0.35 or i == len(s):
            s.insert(i, rng.choice("abcé "))
        elif k < 0.7:
            del s[i]
        else:
            s[i] = rng.choice("abcé ")
    return "".join(s)


def symbols(line):
    """What a line is compared by, and the threshold's rule."""
    words = line.encode().split()
    if len(words) >= 8:
        return 0, words, lambda n: min(1 + n // 24, 7)
    return 1, list(line), lambda n: 2 if n >= 20 else -1


def slow_linked(a, b):
    (k, x, tau), (k2, y, _) = symbols(a), symbols(b)
    t = tau(min(len(x), len(y)))
    return k == k2 and abs(len(x) - len(y)) <= t and slow_near(x, y, t)


def slow(docs):
    """{(doc_id, line_no): kept place} of the places that go, and texts left."""
    def place(d, t, i):
        key = xxhash.xxh64_intdigest(t.encode(), 42)
        return (d is None, d, key - (key >> 63 << 64), i)

    first = {}
    for d, t in docs:
        for i, line in enumerate((t or "").split("\n")):
            if line.encode().strip():
                p = place(d, t, i)
                first[line] = min(first.get(line, p), p)
    lines = sorted(first)
    root = {x: x for x in lines}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    of = {x: symbols(x) for x in lines}
    for i, a in enumerate(lines):
        for b in lines[i + 1 :]:
            if of[a][0] == of[b][0] and abs(len(of[a][1]) - len(of[b][1])) <= 7 and find(a) != find(b) and slow_linked(a, b):
                root[find(a)] = find(b)
    kept = {}
    for x in lines:
        kept[find(x)] = min(kept.get(find(x), first[x]), first[x])
    out = []
    for d, t in docs:
        own = (t or "").split("\n")
        gone = {i: kept[find(x)] for i, x in enumerate(own) if x in root and kept[find(x)] != place(d, t, i)}
        left = t if not gone else "\n".join(x for i, x in enumerate(own) if i not in gone)
        out.append((d, len(own), len(gone), left, sorted((i, k[1], k[3]) for i, k in gone.items())))
    return out


def check(rows, docs):
    got = [(r.doc_id, r.n_lines, r.n_dropped, r.text, sorted(map(tuple, r.drops))) for r in rows]
    assert sorted(got, key=repr) == sorted(slow(docs), key=repr)


def band(pairs, tau):
    runs = [np.frombuffer(x.encode("utf-32-le"), np.uint32).astype(np.uint64) for p in pairs for x in p]
    size = np.array([len(x) for x in runs], np.int64)
    start = np.cumsum(size) - size
    return L.near(np.concatenate([*runs, np.zeros(1, np.uint64)]), start[::2], size[::2], start[1::2], size[1::2], tau).tolist()


@given(st.text("ab", max_size=14), st.text("ab", max_size=14), st.integers(0, 7))
@settings(max_examples=600, deadline=None)
def test_band_equals_plain_distance(a, b, tau):
    assert band([(a, b)], tau) == [slow_distance(a, b) <= tau]


def test_band_on_many_lengths_at_once():
    rng = random.Random(5)
    base = ["".join(rng.choice("abcdefé ") for _ in range(rng.randrange(3, 90))) for _ in range(300)]
    other = [edited(rng, s, rng.randrange(6)) for s in base]
    for tau in (0, 1, 2, 3, 5, 7):
        assert band(list(zip(base, other)), tau) == [slow_distance(a, b) <= tau for a, b in zip(base, other)]


def swapped(rng, line, n):
    """Words replaced, left out or added."""
    words = line.split()
    for _ in range(n):
        i, k = rng.randrange(len(words)), rng.random()
        if k < 0.6:
            words[i] = rng.choice(["alpha", "beta", "gamma"])
        elif k < 0.8:
            del words[i]
        else:
            words.insert(i, "delta")
    return " ".join(words)


def test_linked_lines_share_a_key():
    rng = random.Random(2)
    seen = 0
    for _ in range(1200):
        if rng.random() < 0.3:
            a = "".join(rng.choice("abc") for _ in range(rng.randrange(18, 60)))
            b = edited(rng, a, rng.randrange(4))
        else:
            a = " ".join(rng.choice("abcdefgh") * 3 for _ in range(rng.randrange(8, 200)))
            b = swapped(rng, a, rng.randrange(1, 9))
        if a == b or not slow_linked(a, b):
            assert L.within([a.encode()], [b.encode()], L.RULE).tolist() == [a == b and symbols(a)[2](len(symbols(a)[1])) >= 0]
            continue
        seen += 1
        sig = L.Signatures([a.encode(), b.encode()], [1, 2], L.RULE)
        of = [np.frombuffer(b"".join(L.by_target(part, 1)[1]), L.ENTRY) for part in (sig.index, sig.probe)]
        x, y, hot = L.candidates(*of)
        assert (x.tolist(), y.tolist(), len(hot)) == ([1], [2], 0), (a, b)
        assert L.within([a.encode()], [b.encode()], L.RULE).tolist() == [True]
    assert seen > 500


def test_swapped_words_are_caught():
    """Near copies with the corpus-wide measure of five-word shingles, similarity 0.8 or more."""
    rng = random.Random(9)
    hit = total = 0
    while total < 2000:
        a = " ".join(f"w{rng.randrange(3000)}" for _ in range(rng.randrange(20, 200)))
        b = swapped(rng, a, rng.randrange(1, 6))
        x, y = ({tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for t in (a, b))
        if a != b and len(x & y) >= 0.8 * len(x | y):
            total += 1
            hit += slow_linked(a, b)
    assert hit >= 0.9 * total


def test_planted_lines_and_edge_rows(spark):
    rng = random.Random(3)
    base = ["".join(rng.choice("abcdefghij  é") for _ in range(rng.randrange(15, 70))) for _ in range(60)]
    docs = [(1, None), (2, ""), (3, " \n\t\n\n"), (4, "short\nshort\nshort!"), (None, "short\nonly here, in a row without an id"), (5, base[0] + "\n" + base[0]), (5, base[0] + "\n" + base[0])]
    for d in range(10, 60):
        docs.append((d, "\n".join(edited(rng, rng.choice(base), rng.choice([0, 0, 1, 2, 3])) for _ in range(rng.randrange(1, 9)))))
    docs.append((70, "x" * 20000 + "\n" + "x" * 20001 + "\n" + "x" * 20004))
    df = spark.createDataFrame([(d, t, 7, "y", 0) for d, t in docs], "doc_id long, text string, h int, drops string, n_chars long")
    check(L.report(df).collect(), docs)
    left = L.dedup(df)
    assert left.columns == df.columns
    want = sorted(((d, t, 7, "y", None if t is None else len(t)) for d, _, _, t, _ in slow(docs)), key=repr)
    assert sorted((tuple(r) for r in left.collect()), key=repr) == want
    assert L.report(df.limit(0)).collect() == []


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF001, "documents").collect()]
    check(QUERIES["op8_line_dedup"](spark, SF001).collect(), docs)


def test_small_blocks_give_the_same_pairs(monkeypatch):
    rng = random.Random(4)
    base = "".join(rng.choice("abcd") for _ in range(40))
    lines = sorted({edited(rng, base, rng.randrange(3)) for _ in range(120)})
    sig = L.Signatures([x.encode() for x in lines], list(range(1, len(lines) + 1)), L.RULE)

    def found(most=1 << 20):
        of = [np.frombuffer(b"".join(L.by_target(part, 1)[1]), L.ENTRY) for part in (sig.index, sig.probe)]
        a, b, hot = L.candidates(*of, most)
        return set(zip(a.tolist(), b.tolist())), hot

    want, hot = found()
    assert not len(hot)
    for n in (1, 7, 100):
        monkeypatch.setattr(L, "AT_ONCE", n)
        assert found()[0] == want
    linked = {(i + 1, j + 1) for i, a in enumerate(lines) for j, b in enumerate(lines) if i < j and slow_linked(a, b)}
    assert linked <= want
    cold, hot = found(20)  # a pair is met as a candidate, or both lines at a hot key
    at = {}
    for k, _, h in hot.tolist():
        at.setdefault(k, set()).add(h)
    assert len(hot) and all(p in cold or any(set(p) <= x for x in at.values()) for p in linked)


def test_hot_keys_are_dealt_to_chunks(spark, monkeypatch):
    monkeypatch.setattr(L, "HOT", 4)
    monkeypatch.setattr(L, "LINES", 7)
    rng = random.Random(6)
    base = [f"page {rng.randrange(300):05d} of the yearly report" for _ in range(80)] + ["".join(rng.choice("abcd") for _ in range(40)) for _ in range(20)]
    base += [f"item {rng.randrange(90)} of list {rng.randrange(9)} was sent to the office in town {rng.randrange(90)}" for _ in range(60)]
    docs = [(d, "\n".join(edited(rng, rng.choice(base), rng.choice([0, 0, 1, 2])) for _ in range(6))) for d in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert L.pairs(df, 400, L.RULE).where("slot is not null").select("slot").distinct().count() > 10
    check(L.report(df).collect(), docs)


def test_a_hot_key_does_not_give_all_pairs(spark):
    lines = [f"page {i:05d} of the yearly report" for i in range(3000)]
    df = spark.createDataFrame([(i, "\n".join(lines[i : i + 50])) for i in range(0, 3000, 50)], "doc_id long, text string")
    assert L.pairs(df, len(lines), L.RULE).count() < 40 * len(lines)
    assert L.classes(df, len(lines)).count() == len(lines) - 1
    assert sum(r.n_dropped for r in L.report(df).collect()) == len(lines) - 1


def test_rows_without_an_id_are_told_apart(spark):
    line = "the same long line stands in three rows without an id"
    docs = [(None, line + "\nand one"), (None, line + "\nand two"), (None, line + "\nand two"), (None, None), (None, "")]
    docs += [(7, "a\nline of the first text of an id that comes twice"), (7, "line of the first text of an id that comes twice")]
    rows = L.report(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    check(rows, docs)
    assert sorted(r.n_dropped for r in rows) in ([0, 0, 0, 0, 0, 1, 1], [0, 0, 0, 0, 1, 1, 1])


def test_words_and_their_hashes():
    """Words as bytes.split has them, and equal hashes of equal words only, whatever their size."""
    lines = [b" a b\x0bc\x0c d\te\r f g  h ", b"\x1ca \xc2\xa0b c\x00 \xff d e f g", b"x y", *(b" ".join([b"w" * n + bytes([65 + k]) + b"v" * m for k in range(8)]) for n in range(18) for m in (0, 1, 9))]
    of = {}
    for x in L.kinds(lines, L.RULE):
        for i, a, n in zip(x.which.tolist(), x.start.tolist(), x.size.tolist()):
            if x.kind == L.WORDS:
                assert n == len(lines[i].split()) >= L.RULE.words
                for word, h in zip(lines[i].split(), x.sym[a : a + n].tolist()):
                    assert of.setdefault(word, h) == h
            else:
                assert len(lines[i].split()) < L.RULE.words
    assert len(set(of.values())) == len(of) > 400


def test_a_hot_group_is_cut_into_words_once(monkeypatch):
    cuts, kinds = [], L.kinds
    monkeypatch.setattr(L, "kinds", lambda *a: cuts.append(1) or kinds(*a))
    monkeypatch.setattr(L, "CHECKED", 4)
    words = [f"w{i}" for i in range(24)]
    lines = [" ".join([*words[:i], f"x{i}", f"y{i}", *words[i + 1 :]]).encode() for i in range(0, 24, 2)]
    a, b = L.spanning(lines, np.arange(12), np.arange(12), L.RULE)
    pairs = [(i, j) for i in range(12) for j in range(i) if L.within([lines[i]], [lines[j]], L.RULE)[0]]
    assert len(cuts) == 1 + 66 and (len(a) == 0) == (not pairs)


@given(st.lists(st.integers(0, 3), min_size=20, max_size=80), st.integers(0, 7), st.integers(0, 9), st.integers(0, 1 << 20))
@settings(max_examples=200, deadline=None)
def test_band_on_long_runs(line, tau, edits, seed):
    """Pairs that are given up on the way, and those whose ends are alike."""
    a = "".join("abc "[i] for i in line)
    b = edited(random.Random(seed), a, edits)
    assert band([(a, b), (b, a), (a, a)], tau) == [slow_near(a, b, tau)] * 2 + [True]


def test_common_ends_are_not_compared(monkeypatch):
    seen, inner = [], L._band
    monkeypatch.setattr(L, "_band", lambda sym, s1, m, *rest: seen.extend(m.tolist()) or inner(sym, s1, m, *rest))
    words = [f"w{i}" for i in range(150)]
    a = " ".join(words).encode()
    b, c = (" ".join([*words[:70], *new, *words[80:]]).encode() for new in (["x", *words[71:79], "y"], [f"x{i}" for i in range(10)]))
    assert L.within([a, a, a], [a, b, c], L.RULE).tolist() == [True, True, False]
    assert sum(seen) <= 10  # the ten words that differ, or none


def test_pairs_of_unlike_counts_are_not_compared(monkeypatch):
    """256 classes tell lines apart that 64 don't."""
    seen, inner = [], L.near
    monkeypatch.setattr(L, "near", lambda sym, s1, *rest: seen.extend(s1.tolist()) or inner(sym, s1, *rest))
    rng = random.Random(3)
    base = [f"w{i}" for i in range(20)]
    lines = [" ".join([*base[:-3], *(f"v{rng.randrange(10**6)}" for _ in range(3))]).encode() for _ in range(300)]
    x = L.Compared(lines, L.RULE)
    a, b = np.triu_indices(300, 1)
    assert not x.linked(a, b).any()
    assert 0 < x.likely(a, b).sum() and len(seen) < x.likely(a, b).sum() / 2


def test_lines_of_large_classes(spark, monkeypatch):
    monkeypatch.setattr(L, "MANY", 3)
    rng = random.Random(8)
    base = ["the long line that comes in many rows of the table, more or less", "a line of a small class that comes twice or so", "ok"]
    docs = [(d if d % 5 else None, "\n".join([edited(rng, base[0], rng.choice([0, 0, 1])), base[1] if d % 9 == 0 else f"own line number {d} of this row", base[2]])) for d in range(30)]
    check(L.report(spark.createDataFrame(docs + docs[:3], "doc_id long, text string")).collect(), docs + docs[:3])
