"""Forests grown from binned rows against the library's own."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cohortline.operators import forest as FO
from cohortline.operators import training as T

NAMES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(900, 4))
    x[:, 3] = np.round(x[:, 3])
    label = (x[:, 0] + x[:, 1] ** 2 + rng.normal(0, 0.6, 900) > 0.8).astype(int) + (x[:, 2] > 1.1)
    pdf = pd.DataFrame(x, columns=NAMES).assign(label=label, id=range(900))
    return T.cut_lineage(T.assemble(spark.createDataFrame(pdf).repartition(3), NAMES, "label", ["id"]))


def probabilities(model, df):
    return np.array([r["p"] for r in model.transform(df).select("id", vector_to_array("probability").alias("p")).orderBy("id").collect()])


@pytest.mark.parametrize("local", [1 << 18, 120])
def test_one_tree_is_the_librarys(spark, rows, local, monkeypatch):
    """Without draws and with every feature tried the tree is the library's, grown in one task or split by all first."""
    monkeypatch.setattr(FO, "LOCAL_ROWS", local)
    estimator = T.forest(numTrees=1, featureSubsetStrategy="all", bootstrap=False, maxDepth=9)
    library, grown = estimator.fit(rows), estimator.grow(rows)
    assert np.array_equal(probabilities(library, rows), probabilities(grown, rows))
    assert np.allclose(library.featureImportances.toArray(), grown.importances, atol=1e-12)
    assert len(grown.trees[0].feature) == library.totalNumNodes or local == 120


def test_a_forest_learns_as_the_librarys(spark, rows, monkeypatch):
    train, test = rows.filter("id % 4 > 0"), rows.filter("id % 4 = 0")
    estimator = T.forest(numTrees=25, maxDepth=8)
    library = T._accuracy(estimator.fit(train).transform(test))
    assert T._accuracy(estimator.grow(train).transform(test)) > library - 0.04
    monkeypatch.setattr(FO, "LOCAL_ROWS", 100)
    grown = estimator.grow(train)
    assert T._accuracy(grown.transform(test)) > library - 0.04 and len({len(t.feature) for t in grown.trees}) > 5
    again = estimator.grow(train)
    assert np.array_equal(probabilities(grown, test), probabilities(again, test))


def test_equal_bins_are_counted(spark):
    """Rows beyond the combinations of bins add no work: they are counted, and a tree draws for the count."""
    rng = np.random.default_rng(8)
    x = rng.integers(0, 4, (3000, 2)).astype(float)
    pdf = pd.DataFrame({"x": x[:, 0], "y": x[:, 1], "label": (x[:, 0] > x[:, 1]).astype(int), "id": range(3000)})
    df = T.assemble(spark.createDataFrame(pdf).repartition(5), ["x", "y"], "label", ["id"])
    splits = [np.array([0.5, 1.5, 2.5])] * 2
    growth = FO.Growth(6, 5, 5, 2, 42, 2, (4, 4))
    shaped = df.select(vector_to_array("features").alias("x"), "label")
    pieces, stored = FO.stored_pieces(shaped, splits, growth, 3000)
    assert stored == 16  # one label for each combination
    counts = sum((np.frombuffer(bytes(r["copies"]), np.int64).tolist() for r in pieces.collect()), [])
    assert sum(counts) == 3000
    drawn = [sum(t.counts[t.feature < 0].sum() for t in FO.grow_trees(pieces, growth, n)[:6]) / 6 for n in (16,)]
    assert abs(drawn[0] - 3000) < 150
    # the same tree from counted and from single rows
    whole = FO.Growth(1, 5, 5, 2, 42, 2, (4, 4), bootstrap=False)
    counted = FO.grow_trees(pieces, whole, 16)[0]
    single = FO.grow_rows(FO.to_bins(x, splits), pdf["label"].to_numpy(), np.ones(3000), 5, whole, np.random.default_rng(0))
    assert np.array_equal(counted.feature, single.feature) and np.array_equal(counted.split, single.split)


def test_small_nodes_by_sorting_find_the_same_splits():
    rng = np.random.default_rng(6)
    sizes = rng.integers(5, 40, 60)
    growth = FO.Growth(1, 5, 3, 3, 1, 4, (8,) * 6)
    bins, labels, weights = rng.integers(0, 8, (sizes.sum(), 6)).astype(np.uint8), rng.integers(0, 4, sizes.sum()), rng.integers(1, 4, sizes.sum())
    tried = FO.tried_features(rng, 60, growth)
    by_sorting = FO.best_of_sorted(bins, labels, weights, sizes, tried, growth)
    by_bins = FO.best_of_histogram(FO.histogram(bins, labels, weights, np.repeat(np.arange(60), sizes), tried, growth), 3)
    found = np.isfinite(by_bins[0])
    assert np.allclose(by_sorting[0][found], by_bins[0][found]) and np.array_equal(found, np.isfinite(by_sorting[0]))


def test_odd_rows(spark):
    """Rows that the library does not learn from are refused as well; features without a split give single leaves."""
    df = spark.createDataFrame([([1.0, 2.0], 0.0), ([3.0, 2.0], 1.0)] * 20, "v array<double>, label double")
    data, estimator = T.from_arrays(df, "v", "label"), T.forest(numTrees=3)
    assert T._accuracy(estimator.grow(data).transform(data)) == 1.0
    alike = T.from_arrays(df.withColumn("v", F.array(F.lit(1.0))), "v", "label")
    assert all(len(t.feature) == 1 for t in estimator.grow(alike).trees)
    for odd in (data.withColumn("label", F.lit(None).cast("double")), T.from_arrays(df.withColumn("v", F.array(F.lit(float("nan")))), "v", "label")):
        for fit in (estimator.fit, estimator.grow):
            with pytest.raises(Exception):
                fit(odd)


def test_scoring_pipeline_is_grown_and_saved(spark, tmp_path):
    """The scoring model is grown from bins, not by the library, and comes back from its stored form."""
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame(rng.normal(size=(300, 2)), columns=["x", "y"])
    pdf["label"] = (pdf["x"] > pdf["y"]).astype(float)
    df = spark.createDataFrame(pdf)
    model = T.fit_pipeline(df, ["x", "y"], T.forest(numTrees=12, maxDepth=8))
    assert isinstance(model.stages[-1], FO.GrownForest) and T._accuracy(model.transform(df)) > 0.9
    T.save_model(model, str(tmp_path / "model"))
    loaded = T.load_model(str(tmp_path / "model"))
    both = [m.transform(df).select("x", "prediction", vector_to_array("probability").alias("p")).orderBy("x").collect() for m in (model, loaded)]
    assert both[0] == both[1]


def unfit(*args):
    raise AssertionError("fitted by the library")


def test_elimination_grows_from_bins(spark, monkeypatch):
    """Every size and fold, and the path over all rows, without a fit of the library."""
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame(rng.normal(size=(200, 3)), columns=["x", "y", "noise"])
    pdf["label"], pdf["id"] = (pdf["x"] + pdf["y"] > 0).astype(int), range(200)
    monkeypatch.setattr(T.RandomForestClassifier, "_fit", unfit)
    path = T.eliminate_features(spark.createDataFrame(pdf), ["noise", "x", "y"], "label", "id", T.forest(numTrees=9, maxDepth=6), n_folds=2)
    assert [sorted(r["features"]) for r in path.orderBy("n_features").collect()][1:] == [["x", "y"], ["noise", "x", "y"]]
    assert path.agg(F.max("mean_accuracy")).first()[0] > 0.8


def test_learning_curve_grows_from_bins(spark, rows, monkeypatch):
    monkeypatch.setattr(T.RandomForestClassifier, "_fit", unfit)
    curve = T.learning_curve(rows, T.forest(numTrees=15, maxDepth=10), "id", fractions=(0.2, 1.0), n_folds=3).collect()
    assert len(curve) == 6 and min(r["test_accuracy"] for r in curve if r["fraction"] == 1.0) > 0.7
    assert sum(r["n_train"] for r in curve if r["fraction"] == 1.0) == 2 * 900


def test_folds_grow_from_bins_and_split_large_roots_first(spark, rows, monkeypatch):
    """No task holds a whole tree's rows beyond the bound: the levels above are split by all partitions."""
    monkeypatch.setattr(T.RandomForestClassifier, "_fit", unfit)
    monkeypatch.setattr(FO, "LOCAL_ROWS", 200)
    held, top_levels = [], FO._top_levels
    monkeypatch.setattr(FO, "_top_levels", lambda *a: held.append(top_levels(*a)) or held[-1])
    folds = T.cross_validate(rows, T.forest(numTrees=12, maxDepth=9), "id", n_folds=2).collect()
    assert len(folds) == 2 and min(r["accuracy"] for r in folds) > 0.7
    assert all(len(top.feature) > 1 for tops, _, _ in held for top in tops.values())
