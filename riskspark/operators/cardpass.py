"""One ordered pass over every card (entity) of a transaction table.

All per-card operators (previous value, running number, history window,
whole-card statistics) are produced here.  Rows meet in one exchange, on the card
and the number of their chunk: a stretch of the card's rows in order.  Rows are counted
per card first (a map-side aggregate of the key alone); only a card with more rows
than a chunk may hold has more than one, and its chunks are cut at order values
from a sample by hash, so that a card that holds a large share of all rows is
divided like the others, rows of one time included.

What a chunk needs from those before it is small and comes along as one row of
offsets a chunk and the last ``L`` rows before it as context rows, which keeps lags,
running numbers, history frames and running statistics exact wherever the cuts
lie.  Rows without a card have no values; many of them are spread by hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.config import DEFAULT_SCALE, ScaleConfig
from riskspark.operators.ranks import ascending
from riskspark.session import cut_lineage

CHUNK = "_chunk"
#: Rows of one card that stay together (``ScaleConfig.chunk_rows`` overrides it), sampled rows
#: of a chunk, and tasks that rows without a card are spread over.
CHUNK_ROWS, SAMPLES, SALTS = 1 << 20, 8, 4096
#: Edges compared one after another; a card with more has them in blocks.
BLOCK = 256


def hot_cards(df: DataFrame, key: str, order: tuple[str, ...], scale: ScaleConfig) -> tuple[DataFrame | None, bool]:
    """``(key, coarse, fine)`` with the chunk edges of cards of several chunks (None: there are
    none), and whether rows without a card are many.  At most four chunks a
    shuffle partition in all, so the table is small whatever the input."""
    n = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    own = F.when(F.col(key).isNotNull(), F.col("n"))
    seen = n.agg(F.max(own).alias("most"), F.sum(own).alias("rows"), F.max(F.when(F.col(key).isNull(), F.col("n"))).alias("none")).first()
    limit = scale.chunk_rows or CHUNK_ROWS
    spread = (seen["none"] or 0) > limit
    if (seen["most"] or 0) <= limit:
        return None, spread
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = scale.chunk_rows or max(limit, seen["rows"] // (4 * partitions))
    step = max(1, size // SAMPLES)
    hot = cut_lineage(n.filter(own > size).select(key), columnar=True)
    at = F.struct(*order)
    sample = (df.select(key, *order).join(F.broadcast(hot), key).filter(F.pmod(F.xxhash64(*order), F.lit(step)) == 0)
              .groupBy(key).agg(F.sort_array(F.collect_list(at)).alias("s")))
    every = size // step
    edges = F.filter("s", lambda e, i: (i + 1) % every == 0)  # an edge begins a chunk
    blocks = F.sequence(F.lit(0), F.greatest(F.ceil(F.size("e") / BLOCK) - 1, F.lit(0)).cast("int"))
    laid = sample.withColumn("e", edges).select(
        key, F.transform(blocks, lambda i: F.slice("e", i * BLOCK + 1, F.lit(BLOCK))).alias("fine"),
        F.filter("e", lambda e, i: (i + 1) % BLOCK == 0).alias("coarse"))
    return cut_lineage(laid, columnar=True), spread


def chunk_of(order: tuple[str, ...]) -> Column:
    """How many of the card's edges a row has reached; 0 on a card without edges."""
    at = F.struct(*order)
    block = F.size(F.filter("coarse", lambda e: e <= at))
    rest = F.coalesce(F.size(F.filter(F.get("fine", block), lambda e: e <= at)), F.lit(0))
    return F.when(F.col("fine").isNull(), F.lit(0)).otherwise(block * BLOCK + F.greatest(rest, F.lit(0)))


def card_pass(df: DataFrame, *, key: str = "uid",
              order: tuple[str, ...] = ("TransactionDT", "TransactionID"),
              lags: dict[str, str] | None = None,
              row_number: str | None = None,
              history: list[str] | None = None,
              history_len: int = 10,
              history_col: str = "_hist",
              card_aggs: dict[str, Column] | None = None,
              running: list[str] | None = None,
              scale: ScaleConfig = DEFAULT_SCALE) -> DataFrame:
    """Return ``df`` plus, per row:

    * ``lags``: ``{out: src}`` -> value of ``src`` on the previous row of the card;
    * ``row_number``: 1, 2, 3 ... in card order;
    * ``history_col``: ``array<array<double>>`` of ``history`` columns of the
      up to ``history_len`` previous rows, oldest first;
    * ``card_aggs``: ``{out: aggregate}`` evaluated over the whole card;
    * for each ``running`` column ``c``, statistics of the *earlier* rows of
      the card only: ``_rn_c`` (non-null count), ``_rm_c`` (mean), ``_rsd_c``
      (sample std), ``_rmax_c``, ``_rmin_c``.

    ``order`` should be unique within a card; a null order value comes first.
    Rows with a null key get nulls (a null key is not a card).
    """
    lags, card_aggs, running = lags or {}, card_aggs or {}, running or []
    depth = max(history_len if history else 1, 1)
    base = df.columns
    hot, spread = hot_cards(df, key, order, scale)
    salt = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(*order), F.lit(SALTS))).cast("int")
    if hot is None:
        by = [key, CHUNK] if spread else [key]
        d = df.withColumn(CHUNK, F.coalesce(salt, F.lit(0)) if spread else F.lit(0))
        both = d.withColumns({"_ctx": F.lit(0), **{c: F.lit(None).cast(t) for c, t in _carried_types(running).items()}})
        return _windows(both, by, key, order, base, lags, row_number, history, depth, history_col, card_aggs, running)
    d = df.join(F.broadcast(hot), key, "left").withColumn(CHUNK, F.coalesce(salt, chunk_of(order)))
    rows = d.filter(F.col("fine").isNotNull())
    d = d.drop("coarse", "fine")

    # a row per chunk of a hot card, with the offsets of what comes before
    piece_aggs = [F.count(F.lit(1)).alias("_n")]
    for c in running:
        x = F.col(c).cast("double")
        piece_aggs += [F.count(x).alias(f"_n_{c}"), F.avg(x).alias(f"_m_{c}"),
                       (F.var_pop(x) * F.count(x)).alias(f"_q_{c}"), F.max(x).alias(f"_x_{c}"), F.min(x).alias(f"_i_{c}")]
    of_card = Window.partitionBy(key)
    before = of_card.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = {"_start": F.coalesce(F.sum("_n").over(before), F.lit(0)).cast("long"),
               "_rank": F.row_number().over(of_card.orderBy(CHUNK))}
    for c in running:
        # moments about the first piece's mean, which lies among the values: no cancellation
        about = F.min_by(f"_m_{c}", F.when(F.col(f"_n_{c}") > 0, F.col(CHUNK))).over(of_card)
        off = F.col(f"_m_{c}") - about
        n, s = F.col(f"_n_{c}"), F.sum(F.col(f"_n_{c}") * off).over(before)
        q = F.sum(F.col(f"_q_{c}") + n * off * off).over(before)
        n0 = F.coalesce(F.sum(n).over(before), F.lit(0))
        offsets |= {f"_n0_{c}": n0, f"_m0_{c}": about + F.try_divide(s, n0), f"_q0_{c}": q - F.try_divide(s * s, n0),
                    f"_x0_{c}": F.max(f"_x_{c}").over(before), f"_i0_{c}": F.min(f"_i_{c}").over(before)}
    pieces = cut_lineage(rows.groupBy(key, CHUNK).agg(*piece_aggs).withColumns(offsets), columnar=True)

    # context rows: the last rows before a chunk lie in as many chunks before it at most
    need = list(dict.fromkeys([key, *order, *lags.values(), *(history or [])]))
    last = Window.partitionBy(key, CHUNK).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    tails = (rows.select(*need, CHUNK).withColumn("_back", F.row_number().over(last)).filter(F.col("_back") <= depth)
             .join(F.broadcast(pieces.select(key, CHUNK, "_n", "_start", "_rank")), [key, CHUNK])
             .select(*need, (F.col("_start") + F.col("_n") - F.col("_back")).alias("_at"),
                     F.explode(F.sequence(F.col("_rank") + 1, F.col("_rank") + depth)).alias("_rank")))
    context = (tails.join(F.broadcast(pieces.select(key, "_rank", CHUNK, "_start")), [key, "_rank"])
               .filter(F.col("_at") >= F.col("_start") - depth).select(*need, CHUNK, F.lit(1).alias("_ctx")))

    carried = pieces.select(key, CHUNK, *_carried_types(running))
    if card_aggs:  # over all chunks of a hot card
        whole = rows.groupBy(key).agg(*[a.alias(f"_w_{name}") for name, a in card_aggs.items()])
        carried = carried.join(F.broadcast(cut_lineage(whole, columnar=True)), key)
    both = (d.withColumn("_ctx", F.lit(0)).unionByName(cut_lineage(context, columnar=True), allowMissingColumns=True)
            .join(F.broadcast(carried), [key, CHUNK], "left"))
    return _windows(both, [key, CHUNK], key, order, base, lags, row_number, history, depth, history_col, card_aggs, running)


def _carried_types(running: list[str]) -> dict[str, str]:
    """Offsets that a chunk takes over from those before it."""
    kinds = {"_n0": "long", "_m0": "double", "_q0": "double", "_x0": "double", "_i0": "double"}
    return {"_start": "long"} | {f"{p}_{c}": t for c in running for p, t in kinds.items()}


def _windows(both: DataFrame, by: list[str], key: str, order, base: list[str], lags, row_number, history, depth, history_col, card_aggs, running) -> DataFrame:
    """The outputs over each card's chunk, from rows, context rows and offsets."""
    w = Window.partitionBy(*by).orderBy(*ascending(list(order)))
    earlier = w.rowsBetween(Window.unboundedPreceding, -1)
    own = F.col("_ctx") == 0
    out = {name: F.lag(src, 1).over(w) for name, src in lags.items()}
    if row_number:
        seen = F.sum(1 - F.col("_ctx")).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        out[row_number] = (F.coalesce("_start", F.lit(0)) + seen).cast("long")
    if history:
        item = F.array(*[F.col(c).cast("double") for c in history])
        out[history_col] = F.collect_list(item).over(w.rowsBetween(-depth, -1))
    for name, a in card_aggs.items():  # a card of one chunk has no context rows
        own_aggs = a.over(Window.partitionBy(*by))
        out[name] = F.when(F.col("_start").isNull(), own_aggs).otherwise(F.col(f"_w_{name}")) if f"_w_{name}" in both.columns else own_aggs
    for c in running:
        out |= _running(F.when(own, F.col(c).cast("double")), c, earlier)
    known = F.col(key).isNotNull()
    kept = [F.when(known, e).alias(name) for name, e in out.items()]
    return both.select(*base, "_ctx", *kept).filter(F.col("_ctx") == 0).drop("_ctx")


def _running(x: Column, c: str, earlier) -> dict[str, Column]:
    """Statistics of the earlier rows: those of this piece merged with the offsets."""
    n1, m1, q1 = F.count(x).over(earlier), F.avg(x).over(earlier), F.var_pop(x).over(earlier)
    n0, m0, q0 = F.coalesce(F.col(f"_n0_{c}"), F.lit(0)), F.col(f"_m0_{c}"), F.col(f"_q0_{c}")
    n, gap = n0 + n1, m1 - m0
    mean = F.when(n0 == 0, m1).when(n1 == 0, m0).otherwise(m0 + gap * n1 / n)
    q = F.when(n0 == 0, q1 * n1).when(n1 == 0, q0).otherwise(q0 + q1 * n1 + gap * gap * n0 * n1 / n)
    sd = F.when(n0 == 0, F.stddev_samp(x).over(earlier)).otherwise(F.sqrt(F.greatest(F.try_divide(q, n - 1), F.lit(0.0))))
    hi, lo = F.greatest(F.max(x).over(earlier), F.col(f"_x0_{c}")), F.least(F.min(x).over(earlier), F.col(f"_i0_{c}"))
    # one value, or equal ones, have no spread at all
    sd = F.when(n < 2, F.lit(None)).when(hi == lo, F.lit(0.0)).otherwise(sd)
    return {f"_rn_{c}": n, f"_rm_{c}": mean, f"_rsd_{c}": sd, f"_rmax_{c}": hi, f"_rmin_{c}": lo}
