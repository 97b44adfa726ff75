"""Exact quantiles of a few series, and exact bottom-k cut-offs, by selection: no sort
of the rows and no table of all their values.

A mergeable sketch gives each probability a bracket of values; one scan then counts
the rows below and between the brackets, and one keeps the values of those inside,
each once with its count.  The counts say exactly which bracket holds a wanted
rank, so the sketch's error only decides how many values are kept, never the
result: a rank that falls outside its bracket is looked for in wider ones.  While more
values are kept than the driver takes, they are narrowed in the same way.

A bottom-k cut-off by hash goes down the hash four digits at a time: a histogram of
the next digits, and only the rows of the border bucket are looked at again.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.session import cut_lineage

#: The sketch's accuracy (relative rank error 1 / ACCURACY), and half a bracket's width.
ACCURACY, WIDTH = 10_000, 4e-4
#: Kept values that may come to the driver, and brackets of one narrowing round.
AT_MOST, SPLITS = 1 << 16, 64
#: Hex digits that one round of a bottom-k cut-off looks at.
DIGITS = 4


@dataclass(frozen=True)
class Quantile:
    """``q`` = ``lo + (hi - lo) * frac`` of ``n`` values, lo and hi being neighbours."""

    q: float
    n: int
    lo: float
    hi: float
    frac: float


def select_quantiles(df: DataFrame, series: dict[str, Column], probs: list[float] | dict[str, list[float]], *,
                     at_most: int | None = None, width: float = WIDTH) -> dict[str, dict[float, Quantile]]:
    """Linear-interpolated quantiles (numpy / pandas / DuckDB ``quantile_cont``
    semantics) of each series, exact, nulls skipped: ``{name: {p: Quantile}}``.

    A series is an expression over ``df``; a subset is ``F.when(subset, x)``.
    Series and probabilities (the same for all, or by series) are few.  A series
    without values has no quantiles.  ``df`` is scanned three times.
    """
    names, columns = list(series), [c.cast("double") for c in series.values()]
    probs_of = [list(probs[n]) if isinstance(probs, dict) else list(probs) for n in names]
    if not any(probs_of):
        return {name: {} for name in names}
    while True:
        points = [sorted({min(1.0, max(0.0, p + d)) for p in own or [0.5] for d in (-width, width)}) for own in probs_of]
        sketch = df.agg(*[F.percentile_approx(c, points[i], ACCURACY).alias(f"s{i}") for i, c in enumerate(columns)]).first()
        brackets = [_brackets(dict(zip(points[i], sketch[i] or [])), probs_of[i], width) for i in range(len(names))]
        kept = _kept(df, columns, brackets)
        totals = _totals(kept)
        wanted, missed = _wanted(totals, probs_of)
        if not missed:
            break
        width *= 32  # the sketch was farther off than it says
    values = _values(kept, {(s, b): t for (s, b), t in totals.items() if b % 2}, {x for w in wanted.values() for x in w[2:]}, at_most or AT_MOST)
    out: dict[str, dict[float, Quantile]] = {name: {} for name in names}
    for (s, p), (n, frac, lo, hi) in wanted.items():
        a, b = values[lo], values[hi]
        out[names[s]][p] = Quantile(a + (b - a) * frac, n, a, b, frac)
    return out


def _brackets(at: dict[float, float], probs: list[float], width: float) -> list[tuple[float | None, float | None]]:
    """Disjoint closed intervals of values, ascending; None is no bound."""
    out: list[list[float | None]] = []
    if not at:
        return []
    for p in sorted(set(probs)):
        lo = at[max(0.0, p - width)] if p > width else None
        hi = at[min(1.0, p + width)] if p < 1 - width else None
        if out and (lo is None or out[-1][1] is None or lo <= out[-1][1]):
            out[-1][1] = None if hi is None or out[-1][1] is None else max(hi, out[-1][1])
        else:
            out.append([lo, hi])
    return [(lo, hi) for lo, hi in out]


def _kept(df: DataFrame, columns: list[Column], brackets: list) -> DataFrame:
    """(s, b, v, c): rows c of series s in bucket b; odd buckets are brackets and
    have a row per value, even ones lie between them and have one row.  These and brackets of one value are
    counted in one aggregate; only what is in a wider bracket becomes rows."""
    spark, cols, counted, points, items = df.sparkSession, [], [], {}, []
    for s, (c, own) in enumerate(zip(columns, brackets)):
        b = F.lit(2 * len(own))
        for i, (lo, hi) in reversed(list(enumerate(own))):
            b = b if hi is None else F.when(c > hi, b)
            b = F.lit(2 * i + 1) if hi is None else b.otherwise(2 * i + 1)
            b = b if lo is None else F.when(c < lo, 2 * i).otherwise(b)
        cols += [c.alias(f"x{s}"), F.when(c.isNotNull(), b).alias(f"b{s}")]
        one = {2 * i + 1: lo + 0.0 for i, (lo, hi) in enumerate(own) if lo is not None and lo == hi}  # the sum makes -0.0 0.0
        points |= {(s, b): v for b, v in one.items()}
        counted += [(s, b) for b in (*range(0, 2 * len(own) + 1, 2), *one)]
        several = [b for b in range(1, 2 * len(own), 2) if b not in one]
        if several:
            items.append(F.struct(F.lit(s).alias("s"), F.when(F.col(f"b{s}").isin(several), F.col(f"b{s}")).alias("b"), F.col(f"x{s}").alias("v")))
    at = df.select(*cols)
    counts = zip(counted, at.agg(*[F.count_if(F.col(f"b{s}") == b) for s, b in counted]).first())
    kept = spark.createDataFrame([(*x, points.get(x), n) for x, n in counts if n], "s int, b int, v double, c long")
    if items:  # no lambda functions here: Spark interprets all that is below one
        long = at.select(F.inline(F.array(*items))).where("b is not null")
        kept = kept.union(cut_lineage(long.groupBy("s", "b", "v").agg(F.count(F.lit(1)).alias("c")), columnar=True))
    return kept


def _totals(kept: DataFrame) -> dict[tuple[int, int], tuple[int, int]]:
    """Rows and values of each bucket (as many as series and brackets)."""
    return {(r["s"], r["b"]): (r["n"], r["d"]) for r in kept.groupBy("s", "b").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("d")).collect()}


def _wanted(totals: dict, probs_of: list[list[float]]) -> tuple[dict, bool]:
    """``{(s, p): (n, frac, place of the lower neighbour, of the upper)}`` with a place being
    (s, b, rank in the bucket); and whether one lies outside all brackets."""
    out, missed = {}, False
    for s, probs in enumerate(probs_of):
        own = sorted((b, t[0]) for (x, b), t in totals.items() if x == s)
        n = sum(t for _, t in own)

        def place(k: int) -> tuple[int, int, int]:
            for b, t in own:
                if k < t:
                    return s, b, k
                k -= t
            raise AssertionError("a rank beyond the series")

        for p in probs if n else ():
            at = (n - 1) * p
            lo, hi = place(math.floor(at)), place(math.ceil(at))
            missed |= lo[1] % 2 == 0 or hi[1] % 2 == 0
            out[s, p] = n, at - math.floor(at), lo, hi
    return out, missed


def _values(kept: DataFrame, totals: dict, places: set, at_most: int) -> dict[tuple, float]:
    """The value at each place, from the values kept."""
    spark = kept.sparkSession
    want = {x: x for x in places}  # place asked for -> place in the narrowed table
    rows = kept.where("b % 2 = 1")
    while sum(totals[s, b][1] for s, b in {x[:2] for x in want.values()}) > at_most:
        used = sorted({x[:2] for x in want.values()})
        few = F.broadcast(spark.createDataFrame(used, "s int, b int"))
        rows = rows.join(few, ["s", "b"], "left_semi")
        edges = rows.groupBy("s", "b").agg(F.percentile_approx("v", [i / SPLITS for i in range(1, SPLITS)], ACCURACY).alias("e"))
        edges = spark.createDataFrame(edges.collect(), "s int, b int, e array<double>")  # a row per series and bracket
        part = F.size(F.filter("e", lambda e: e < F.col("v")))
        rows = cut_lineage(rows.join(F.broadcast(edges), ["s", "b"]).select("s", (F.col("b") * SPLITS + part).alias("b"), "v", "c"), columnar=True)
        totals = _totals(rows)
        for asked, (s, b, k) in want.items():
            for i in range(b * SPLITS, (b + 1) * SPLITS):
                n = totals.get((s, i), (0, 0))[0]
                if k < n:
                    break
                k -= n
            want[asked] = s, i, k
        if all(totals[x[:2]][1] == 1 for x in want.values()):
            break
    used = sorted({x[:2] for x in want.values()})
    sorted_: dict[tuple, list] = {}
    if used:
        for r in rows.join(F.broadcast(spark.createDataFrame(used, "s int, b int")), ["s", "b"], "left_semi").collect():  # at_most rows
            sorted_.setdefault((r["s"], r["b"]), []).append((r["v"] != r["v"], r["v"], r["c"]))  # NaN comes last
    out = {}
    for asked, (s, b, k) in want.items():
        for _, v, c in sorted(sorted_[s, b]):
            if k < c:
                break
            k -= c
        out[asked] = v
    return out


def bottom_cuts(df: DataFrame, stratum: Column, order: Column, digest: Column, sizes: Callable[[dict], dict], *,
                at_most: int | None = None) -> dict:
    """Cut-offs of the rows with the smallest (hex digest, order) of each of a few strata:
    ``{stratum: (digest, order) of the last one}``.  ``sizes`` tells from the number of
    rows of each stratum how many to take; strata of which none is taken have no entry.

    A histogram of the digests' first digits gives the border bucket of each stratum; only its
    rows are looked at again: by the next digits while they are many, then in order.
    """
    rows = df.select(stratum.alias("g"), digest.alias("h"), order.alias("k"))
    border: dict = {}  # stratum -> (digits, how many of the rows that begin so are taken, such rows)
    some, digits = rows, 0
    while True:
        digits += DIGITS
        counts: dict = {}
        for r in some.groupBy("g", F.substring("h", 1, digits).alias("p")).agg(F.count(F.lit(1)).alias("n")).collect():  # 65,536 a stratum
            counts.setdefault(r["g"], []).append((r["p"], r["n"]))
        if digits == DIGITS:
            rows_of = {g: sum(c for _, c in own) for g, own in counts.items()}
            taken = sizes(rows_of)
        for g, own in counts.items():
            left = border[g][1] if g in border else min(taken.get(g, 0), rows_of[g])
            for p, c in sorted(own) if left > 0 else ():
                if left <= c:
                    border[g] = p, left, c
                    break
                left -= c
        wide = {g: b for g, b in border.items() if b[2] > (at_most or AT_MOST) and len(b[0]) == digits < 32}
        if not wide:
            break
        some = rows.where(_begins(wide))
    out = {}
    for g, b in border.items():
        last = rows.where(_begins({g: b})).orderBy("h", "k").offset(b[1] - 1).limit(1).first()
        out[g] = last["h"], last["k"]
    return out


def _begins(border: dict) -> Column:
    hit = F.lit(False)
    for g, (p, _, _) in border.items():
        hit = hit | (F.col("g").eqNullSafe(F.lit(g)) & F.col("h").startswith(p))
    return hit


def within_cuts(cuts: dict, stratum: Column, order: Column, digest: Column) -> Column:
    """Whether a row is among those that ``bottom_cuts`` takes."""
    hit = F.lit(False)
    for g, (h, k) in cuts.items():
        hit = hit | (stratum.eqNullSafe(F.lit(g)) & ((digest < h) | ((digest == h) & (order <= F.lit(k)))))
    return F.coalesce(hit, F.lit(False))
