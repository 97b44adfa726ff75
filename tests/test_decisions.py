"""Tiered actions on 0-100 risks."""

import pytest
from pyspark.sql import functions as F

from riskspark import config
from riskspark.functions.scalar import decide, entity_key, lenient_double, np_round

ACTIONS = ["allow", "step_up_auth", "block"]


@pytest.mark.parametrize("backend", [*config.DECISION_THRESHOLDS, "another"])
def test_each_limit_belongs_to_the_higher_action(spark, backend):
    t = config.DECISION_THRESHOLDS.get(backend, config.DECISION_THRESHOLDS["rf"])
    limits = sorted({0.0, 100.0, *(x * 100 + d for x in t.values() for d in (-0.01, 0.0, 0.01))})
    df = spark.createDataFrame([(x,) for x in limits], "r double")
    got = {r.r: r.a for r in df.select("r", decide("r", backend).alias("a")).collect()}
    assert got == {x: ACTIONS[(x >= t["verify"] * 100) + (x >= t["block"] * 100)] for x in limits}


def test_given_limits_and_missing_risks(spark):
    df = spark.createDataFrame([(19.9,), (20.0,), (60.0,), (None,)], "r double")
    got = [r.a for r in df.select(decide("r", verify=0.2, block=0.6).alias("a")).collect()]
    assert got == ["allow", "step_up_auth", "block", "allow"]


def test_rounding_is_half_to_even(spark):
    r = spark.range(1).select(*[np_round(F.lit(x), d).alias(f"c{i}") for i, (x, d) in enumerate([(0.5, 0), (1.5, 0), (-2.5, 0), (0.00045, 4)])]).first()
    assert list(r) == [0.0, 2.0, -2.0, 0.0004]


TEXTS = {"7": 7.0, " -7.25 ": -7.25, "+.5": 0.5, "3.": 3.0, "2e3": 2000.0, "1E-2": 0.01, "1d": None, "12f": None, "0x1p3": None, "inf": None, "NaN": None, "": None, "1,5": None, "e5": None, None: None}


def test_text_numbers(spark):
    df = spark.createDataFrame([(k,) for k in TEXTS], "t string")
    assert {r.t: r.n for r in df.select("t", lenient_double("t").alias("n")).collect()} == TEXTS
    r = spark.createDataFrame([(1.5, 3, float("inf"))], "d double, i int, x double").select(*[lenient_double(c).alias(c) for c in "dix"]).first()
    assert tuple(r) == (1.5, 3.0, None)


def test_keys_of_missing_parts(spark):
    df = spark.createDataFrame([(1, 2.0), (None, 315.0), (4, None), (None, None)], "c long, a double")
    assert [r.k for r in df.select(entity_key("c", "a").alias("k")).collect()] == ["1_2.0", "nan_315.0", "4_nan", "nan_nan"]
