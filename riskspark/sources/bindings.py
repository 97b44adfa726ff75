"""Canonical views over the driver tables (see FIXTURES.md part 2).

There is no card-transaction table in the test data, so each view maps a
driver table onto the schema an operator expects, with simple expressions
that have an exact DuckDB twin (``*_SQL`` strings) for the oracle check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.functions.scalar import epoch_seconds
from riskspark.sources.io import read_table


def txn_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions <- events.  ``k`` is the number inside ``props``."""
    ev = read_table(spark, sf_dir, "events")
    ts_type = ev.schema["ts"].dataType
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    e = ev.withColumn("k", k)
    kc = F.col("k")
    return e.select(
        F.col("event_id").alias("TransactionID"),
        F.col("user_id").cast("string").alias("uid"),
        epoch_seconds("ts", ts_type).alias("TransactionDT"),
        F.col("value").alias("TransactionAmt"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("isFraud"),
        F.when(kc % 10 == 0, F.lit(None)).otherwise(
            F.concat(F.lit("dev-"), (kc % 7).cast("string"))).alias("DeviceInfo"),
        F.when(kc % 3 == 0, "mobile").when(kc % 3 == 1, "desktop").alias("DeviceType"),
        F.when(kc % 25 == 0, "Anonymous VPN").when(kc % 4 == 0, F.lit(None))
        .otherwise("chrome 70.0").alias("id_31"),
        F.col("value").alias("id_01"),
        F.when(kc % 4 == 0, F.lit(None)).otherwise(kc.cast("double")).alias("id_02"),
        F.col("event_type").alias("card4"),
        F.when(kc % 2 == 0, "debit").otherwise("credit").alias("card6"),
    )


TXN_SQL = """(select event_id as TransactionID, cast(user_id as varchar) as uid,
  epoch_us(ts) // 1000000 as TransactionDT, value as TransactionAmt,
  case when event_type = 'error' then 1 else 0 end as isFraud,
  case when k % 10 = 0 then null else concat('dev-', cast(k % 7 as varchar)) end as DeviceInfo,
  case when k % 3 = 0 then 'mobile' when k % 3 = 1 then 'desktop' end as DeviceType,
  case when k % 25 = 0 then 'Anonymous VPN' when k % 4 = 0 then null else 'chrome 70.0' end as id_31,
  value as id_01, case when k % 4 = 0 then null else cast(k as double) end as id_02,
  event_type as card4, case when k % 2 = 0 then 'debit' else 'credit' end as card6
from (select *, cast(regexp_extract(props, '([0-9]+)', 1) as integer) as k from events) e)"""


def score_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(model, label, score) <- labels join documents.

    model ``length``: least(1, n_chars / 20000); model ``digits``:
    (n_chars % 1000) / 1000 -- a weak score, so models differ.
    """
    lab = read_table(spark, sf_dir, "labels").select("doc_id", "toxic")
    doc = read_table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    j = lab.join(doc, "doc_id")
    base = j.select("doc_id", F.col("toxic").cast("int").alias("label"), "n_chars")
    length = base.select("doc_id", F.lit("length").alias("model"), "label",
                         F.least(F.lit(1.0), F.col("n_chars") / F.lit(20000.0)).alias("score"))
    digits = base.select("doc_id", F.lit("digits").alias("model"), "label",
                         ((F.col("n_chars") % 1000) / F.lit(1000.0)).alias("score"))
    return length.unionByName(digits)


SCORE_PAIRS_SQL = """(select l.doc_id, 'length' as model, cast(l.toxic as integer) as label,
    least(1.0::double, d.n_chars / 20000.0::double) as score
  from labels l join documents d on l.doc_id = d.doc_id
  union all
  select l.doc_id, 'digits' as model, cast(l.toxic as integer) as label,
    (d.n_chars % 1000) / 1000.0::double as score
  from labels l join documents d on l.doc_id = d.doc_id)"""

DRIFT_FEATURES = ["l_extendedprice", "l_quantity", "l_discount", "l_tax"]


def drift_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sides <- lineitem, ``is_ref`` before shipdate 2000-01-01, with a
    score; rows without a shipdate are on no side."""
    li = read_table(spark, sf_dir, "lineitem")
    cut = F.lit("2000-01-01").cast(li.schema["l_shipdate"].dataType)
    score = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return li.filter(F.col("l_shipdate").isNotNull()).select(
        (F.col("l_shipdate") < cut).alias("is_ref"), *DRIFT_FEATURES, score.alias("score"))


DRIFT_REF_SQL = "(select l_extendedprice, l_quantity, l_discount, l_tax from lineitem where l_shipdate < timestamp '2000-01-01')"
DRIFT_CUR_SQL = "(select l_extendedprice, l_quantity, l_discount, l_tax from lineitem where l_shipdate >= timestamp '2000-01-01')"


def identity_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identity side <- customers with a positive balance (0..1 per key)."""
    cu = read_table(spark, sf_dir, "customer")
    return cu.filter(F.col("c_acctbal") > 0).select(
        F.col("c_custkey").alias("cust_id"), "c_mktsegment", "c_acctbal")


def orders_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    od = read_table(spark, sf_dir, "orders")
    return od.select(F.col("o_orderkey").alias("TransactionID"),
                     F.col("o_custkey").alias("cust_id"), "o_totalprice", "o_orderstatus")

