import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablelearn.errors import ValidationError
from tablelearn.operators import profile, validate

HOUSE_RULES = [("columns", ["Id", "GrLivArea", "SalePrice"]), ("non_empty",), ("positive", "SalePrice"),
               ("not_null", "SalePrice"), ("non_negative", "BedroomAbvGr"), ("non_negative", "FullBath")]


def test_valid_house_passes(house):
    validate.require(house, HOUSE_RULES)
    res = validate.check(house, HOUSE_RULES).collect()
    assert all(r["violations"] == 0 for r in res)


@pytest.mark.parametrize("mutate,rule", [
    (lambda d: d.limit(0), "non_empty"),
    (lambda d: d.drop("GrLivArea"), "columns"),
    (lambda d: d.drop("SalePrice"), "columns"),
    (lambda d: d.withColumn("SalePrice", F.when(F.col("Id") == 1, -100).otherwise(F.col("SalePrice"))), "positive"),
    (lambda d: d.withColumn("BedroomAbvGr", F.when(F.col("Id") == 2, -1).otherwise(F.col("BedroomAbvGr"))),
     "non_negative"),
])
def test_each_rule_fires(house, mutate, rule):
    with pytest.raises(ValidationError) as e:
        validate.require(mutate(house), HOUSE_RULES)
    assert e.value.violations[0][0] == rule


def test_nan_target_caught_by_not_null(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, 5.0)], "Id long, SalePrice double")
    with pytest.raises(ValidationError) as e:
        validate.require(df, [("positive", "SalePrice"), ("not_null", "SalePrice")])
    assert e.value.violations[0][0] == "not_null"


def test_unique_counts_extra_rows_and_null_keys(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k long")
    r = validate.check(df, [("unique", ["k"])]).first()
    assert r["violations"] == 2


def test_median_and_quartiles_small_column(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (10.0,), (None,)], "v double")
    q = profile.exact_quantiles(df, ["v"], [0.25, 0.5, 0.75])["v"]
    assert q[0.5] == 3.0 and q[0.25] == 1.75 and q[0.75] == 5.5


@pytest.mark.parametrize("max_bracket", [10**9, 40, 2])
def test_exact_quantiles_match_numpy_with_ties(spark, max_bracket):
    rng = np.random.default_rng(7)
    vals = np.concatenate([rng.normal(size=3000), np.full(1500, 0.25), rng.integers(0, 4, 800).astype(float)])
    df = spark.createDataFrame([(float(v),) for v in vals], "a double").repartition(5)
    ps = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    got = profile.exact_quantiles(df, ["a"], ps, accuracy=100, max_bracket=max_bracket)["a"]
    for p in ps:
        assert math.isclose(got[p], float(np.quantile(vals, p)), rel_tol=0, abs_tol=1e-12)


def test_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([(float(v),) for v in range(0, 21)], "v double")
    h = {r["bin"]: r["n"] for r in profile.histogram(df, "v", 20).collect()}
    assert len(h) == 20 and h[19] == 2 and sum(h.values()) == 21


def test_value_counts_shares(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "s string")
    r = {x["value"]: (x["n"], x["share"]) for x in profile.value_counts(df, "s").collect()}
    assert r == {"a": (2, 2 / 3), "b": (1, 1 / 3)}


def test_group_profile_sizes_sum_to_n(spark):
    rows = [(i % 3, float(i), "M" if i % 2 else "F") for i in range(30)]
    df = spark.createDataFrame(rows, "cluster int, x double, g string")
    p = profile.group_profile(df, "cluster", ["x"], "g").collect()
    assert sum(r["size"] for r in p) == 30
    assert all(set(r["segment_pct"]) == {"M", "F"} for r in p)


CUSTOMER_RULES = [("columns", ["CustomerID", "Gender", "Age", "Annual Income (k$)", "Spending Score (1-100)"]),
                  ("unique", ["CustomerID"]), ("non_empty",),
                  ("not_null", "Age"), ("not_null", "Annual Income (k$)"), ("not_null", "Spending Score (1-100)"),
                  ("non_negative", "Age"), ("between", "Age", 18, 70), ("one_of", "Gender", ["Male", "Female"])]


@pytest.fixture()
def customers(spark):
    rows = [(i, "Male" if i % 2 else "Female", 18 + (i * 7) % 52, 15 + (i * 3) % 125, 1 + (i * 11) % 99)
            for i in range(1, 41)]
    return spark.createDataFrame(rows, "CustomerID long, Gender string, Age int, `Annual Income (k$)` int, "
                                       "`Spending Score (1-100)` int")


def test_customer_rules_pass_and_fire(spark, customers):
    validate.require(customers, CUSTOMER_RULES)
    cases = [
        (customers.drop("Age"), "columns"),
        (customers.unionByName(customers.limit(1)), "unique"),
        (customers.withColumn("Age", F.when(F.col("CustomerID") == 3, None).otherwise(F.col("Age"))), "not_null"),
        (customers.limit(0), "non_empty"),
    ]
    for df, rule in cases:
        with pytest.raises(ValidationError) as e:
            validate.require(df, CUSTOMER_RULES)
        assert e.value.violations[0][0] == rule, rule
