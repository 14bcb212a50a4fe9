import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cohortline.functions.text import stable_hash
from cohortline.operators import profile as P
from cohortline.operators import ranked as R
from cohortline.operators.columns import binary_columns, continuous_columns, distinct_classes, long_form
from cohortline.operators.replicate import lookup_join, replicate


@pytest.fixture(scope="module")
def table():
    rng = np.random.default_rng(5)
    n = 600
    pdf = pd.DataFrame({"a": rng.normal(50, 10, n), "b": rng.exponential(3, n), "flag": rng.integers(0, 2, n).astype(float)})
    pdf["c"] = pdf["a"] * 3 + rng.normal(0, 1, n)
    pdf["d"] = -pdf["c"]
    pdf.loc[rng.integers(0, n, 80), "b"] = np.nan
    pdf.loc[rng.integers(0, n, 40), "c"] = np.nan
    pdf["one"], pdf["none"] = 7.0, np.nan
    return pdf


@pytest.fixture(scope="module")
def frame(spark, table):
    wide = spark.createDataFrame(table)
    return wide.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) for c in wide.columns]).repartition(3)


def test_column_classes(frame):
    kinds = distinct_classes(frame, frame.columns)
    assert kinds["one"] == "constant" and kinds["none"] == "empty" and kinds["flag"] == "binary" and kinds["a"] == "many"
    assert P.constant_columns(frame) == ["one"]
    assert binary_columns(frame) == ["flag"] and continuous_columns(frame) == ["a", "b", "c", "d"]


def test_nulls_and_skew_match_pandas(frame, table):
    nulls = {r["column_name"]: r["null_count"] for r in P.null_profile(frame).collect()}
    assert nulls == {k: v for k, v in table.isnull().sum().items() if v > 0}
    skew = {r["column_name"]: r["skewness"] for r in P.skew_profile(frame, ["a", "b", "c"]).collect()}
    for name, value in skew.items():
        assert value == pytest.approx(table[name].skew(), rel=1e-9)


def test_correlation_matches_pandas(frame, table):
    cols = ["a", "b", "flag", "c", "d", "one"]
    want = table[cols].corr()
    rows = P.corr_pairs(frame, cols).collect()
    assert len(rows) == 15
    for r in rows:
        expected = want.loc[r["left_col"], r["right_col"]]
        if np.isnan(expected):
            assert r["r"] is None or np.isnan(r["r"])
        else:
            assert r["r"] == pytest.approx(expected, abs=1e-9)
    pruned = [r["column_name"] for r in P.corr_prune(P.corr_pairs(frame, cols)).collect()]
    assert pruned == ["c", "d"]


def test_duplicate_rows_with_one_row_filling_a_third(spark):
    pdf = pd.DataFrame({"x": [1] * 40 + list(range(100, 160)) + [101, 101, 102], "y": ["hot"] * 40 + ["u"] * 60 + ["u", "u", "v"]})
    df = spark.createDataFrame(pdf)
    listed = P.duplicate_rows(df).toPandas()
    want = pdf[pdf.duplicated(keep=False)]
    assert len(listed) == len(want) == 43
    assert listed["is_repeat"].sum() == pdf.duplicated().sum()
    assert sorted(listed["x"]) == sorted(want["x"])


def test_duplicate_columns(spark):
    pdf = pd.DataFrame({"a": [1.0, 2.0, None, 0.0] * 3, "z": list("abcd") * 3})
    df = spark.createDataFrame(pdf).withColumn("a", F.when(~F.isnan("a"), F.col("a")))
    wide = df.select("a", F.col("a").alias("b"), "z", F.col("a").cast("int").alias("whole"), (-F.col("a") * -1).alias("minus"),
                     F.coalesce("a", F.lit(5.0)).alias("filled"), F.col("z").alias("z2"))
    assert {(r["column_name"], r["same_as"]) for r in P.duplicate_columns(wide).collect()} == {("b", "a"), ("whole", "a"), ("minus", "a"), ("z2", "z")}


def test_value_counts_skip_nulls(spark):
    df = spark.createDataFrame([("x",), ("x",), (None,), ("y",)], "v string")
    rows = P.value_counts(df, "v").collect()
    assert [(r["value"], r["n"]) for r in rows] == [("x", 2), ("y", 1)]
    assert [r["share"] for r in rows] == pytest.approx([2 / 3, 1 / 3]) and [r["pct"] for r in rows] == pytest.approx([200 / 3, 100 / 3])


@pytest.fixture(scope="module")
def skewed(spark):
    """One value and one group hold a third of the rows and more."""
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"g": ["big"] * 3000 + ["small"] * 50 + ["one"], "v": np.concatenate([
        np.full(1200, 7.5), rng.exponential(10, 1800), rng.integers(0, 4, 50).astype(float), [3.0]])})
    return pdf, spark.createDataFrame(pdf).repartition(5)


@pytest.fixture(params=["one range", "many ranges"])
def ranges(request, spark):
    """Ranges as the session cuts them, and so many that groups and values span several."""
    if request.param == "many ranges":
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "23")
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "17")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_exact_quantiles(skewed, ranges):
    pdf, df = skewed
    probs = [0.0, 0.1, 0.25, 0.333, 0.5, 0.95, 0.99, 1.0]
    got = {r["g"]: r for r in R.exact_quantiles(df, "g", "v", probs).collect()}
    for g, part in pdf.groupby("g"):
        assert got[g]["n"] == len(part)
        assert got[g]["quantiles"] == pytest.approx(list(np.quantile(part["v"], probs)), rel=1e-12)
    assert R.exact_quantiles(df.filter("v < 0"), "g", "v", probs).collect() == []
    nulls = df.withColumn("v", F.when(F.col("g") != "one", F.col("v")))
    assert {r["g"] for r in R.exact_quantiles(nulls, "g", "v", probs).collect()} == {"big", "small"}


@pytest.mark.parametrize("ascending", [True, False])
def test_running_sums(skewed, ranges, ascending):
    pdf, df = skewed
    ones = df.withColumn("n", F.lit(1)).withColumn("w", F.col("v") * 2)
    rows = R.running_sums(ones, ["g"], "v", ["n", "w"], ascending).toPandas()
    for g, part in rows.groupby("g"):
        want = pdf[pdf["g"] == g].groupby("v")["v"].agg(["count", "sum"]).sort_index(ascending=ascending)
        part = part.sort_values("v", ascending=ascending)
        assert list(part["n_cum"]) == list(want["count"].cumsum())
        assert list(part["w_cum"]) == pytest.approx(list(2 * want["sum"].cumsum()))
    two = R.running_sums(ones.withColumn("h", F.when(F.col("v") > 5, "high")), ["g", "h"], "v", ["n"], ascending)
    last = {(r["g"], r["h"]): r["m"] for r in two.groupBy("g", "h").agg(F.max("n_cum").alias("m")).collect()}
    want = pdf.assign(h=np.where(pdf["v"] > 5, "high", "low")).groupby(["g", "h"]).size()
    assert last == {(g, None if h == "low" else h): int(n) for (g, h), n in want.items()}
    whole = R.running_sums(ones, [], "v", ["n"], ascending).agg(F.max("n_cum")).first()[0]
    assert whole == len(pdf)


def test_dense_index_is_contiguous_and_stable(spark):
    df = spark.range(5000).withColumn("g", F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 7).cast("string"))).withColumn("h", stable_hash("id"))
    one = R.dense_index(df, ["g"], "h", "id").toPandas().set_index("id")["row_index"].sort_index()
    two = R.dense_index(df.repartition(13), ["g"], "h", "id", bits=3).toPandas()
    assert (two.set_index("id")["row_index"].sort_index() == one).all()
    for _, part in two.groupby("g"):
        assert sorted(part["row_index"]) == list(range(len(part))) and (part["group_size"] == len(part)).all()


def test_bottom_k_sample(spark):
    wide = spark.range(4000).withColumns({"x": F.col("id") * 1.5, "y": F.lit(2.0), "h": stable_hash("id")})
    df = long_form(wide, ["x", "y"], keep=["id", "h"])
    few = R.bottom_k_sample(df, ["column_name"], "h", ["id"], 100).toPandas()
    assert few.groupby("column_name").size().to_dict() == {"x": 100, "y": 100}
    again = R.bottom_k_sample(df.repartition(7), ["column_name"], "h", ["id"], 100, bits=4).toPandas()
    assert sorted(map(tuple, few.values)) == sorted(map(tuple, again.values))
    assert R.bottom_k_sample(df, ["column_name"], "h", ["id"], 10_000).count() == 8000


def test_rank_filters_limit_before_the_shuffle(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 3)
    plan = R.first_per_key(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.count("WindowGroupLimit") >= 2
    assert [r["id"] for r in R.first_per_key(df, ["k"], ["id"]).orderBy("k").collect()] == [0, 1, 2]
    assert [r["id"] for r in R.last_n(df, 3, ["id"]).collect()] == [997, 998, 999]
    assert "TakeOrderedAndProject" in R.last_n(df, 3, ["id"])._jdf.queryExecution().executedPlan().toString()


def test_replicate_spreads_large_counts(spark):
    df = spark.createDataFrame([("a", 25_003), ("b", 1), ("c", 0)], "k string, n bigint")
    out = replicate(df, "n", "i", chunk=1000)
    got = out.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("i").alias("d"), F.min("i").alias("lo"), F.max("i").alias("hi")).collect()
    assert {tuple(r) for r in got} == {("a", 25_003, 25_003, 0, 25_002), ("b", 1, 1, 0, 0)}


def test_lookup_join_keeps_every_row(spark):
    rows = spark.range(3000).withColumn("k", F.when(F.col("id") < 1000, F.lit(-1)).otherwise(F.col("id") % 500))
    lookup = rows.select("k").distinct().withColumn("v", F.col("k") * 10)
    joined = lookup_join(rows, lookup, ["k"], spark.createDataFrame([(-1,)], "k bigint"))
    assert joined.count() == 3000 and joined.filter("v <> k * 10").count() == 0


def test_values_not_listed_are_counted_too(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", None), ("b", 9)], "k string, v int")
    assert sorted(tuple(r) for r in P.crosstab(df, "k", "v", [1, 2]).collect()) == [("a", 1, 1, 1), ("b", 0, 0, 1)]
    with pytest.raises(ValueError):
        P.crosstab(df, "k", "k", ["other"])


def test_head_is_ordered(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("x"))
    assert [r["x"] for r in R.head(df, 5, ["x"]).collect()] == [0, 1, 2, 3, 4] and R.head(df, 0, ["x"]).collect() == []
