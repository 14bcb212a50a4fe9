"""Kernel maps against exact kernels, and machines against SQL over what they store."""

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cohortline.operators import evaluate as E
from cohortline.operators import kernels as K
from cohortline.operators import training as T


def rows_of(n, d, seed=3):
    return np.random.default_rng(seed).normal(0, 1, (n, d))


def as_frame(spark, points):
    return spark.createDataFrame([(i, [None if x is None else float(x) for x in p] if p is not None else None) for i, p in enumerate(points)],
                                 "id int, v array<double>")


@pytest.mark.parametrize("degree", [1, 2, 3])
def test_sketch_against_the_exact_gram_matrix(degree):
    x = rows_of(150, 24)
    exact = (0.1 * x @ x.T) ** degree
    sketch = K.TensorSketch(24, 2_048, degree, 0.1).apply(x)
    length = (0.1 * (x * x).sum(axis=1)) ** degree
    relative = (sketch @ sketch.T - exact) / np.sqrt(np.outer(length, length))
    assert np.sqrt((relative ** 2).mean()) <= np.sqrt((3 ** degree - 1) / (2 * 2_048))
    # by the definition: every product of one place of each factor, at the sum of the places
    map_ = K.TensorSketch(3, 8, degree, 0.5, seed=7)
    want = np.zeros(8)
    want[0] = 1.0
    for factor in range(degree):
        place, sign = map_.draws(factor)
        step = np.zeros(8)
        for i in range(3):
            for at in range(8):
                step[(at + place[i]) % 8] += want[at] * sign[i] * np.sqrt(0.5) * x[0, i]
        want = step
    np.testing.assert_allclose(map_.apply(x[:1, :3])[0], want, atol=1e-12)


def test_sketches_of_many_seeds_average_to_the_kernel():
    x = rows_of(2, 10, seed=5)
    found = [np.prod(K.TensorSketch(10, 64, 3, 0.2, seed).apply(x), axis=0).sum() for seed in range(600)]
    assert abs(np.mean(found) - (0.2 * x[0] @ x[1]) ** 3) < 4 * np.std(found) / np.sqrt(len(found))


def test_landmarks_and_fourier_against_the_exact_gram_matrix():
    x = rows_of(300, 6)
    exact = K.rbf(x, x, 0.05)
    np.testing.assert_allclose(exact[0, 1], np.exp(-0.05 * ((x[0] - x[1]) ** 2).sum()))
    some = K.Landmarks(x[:120], 0.05).apply(x)
    np.testing.assert_allclose(some[:120] @ some[:120].T, exact[:120, :120], atol=1e-6)
    error = {"landmarks": np.sqrt(((some @ some.T - exact) ** 2).mean())}
    waves = K.Fourier(6, 512, 0.05).apply(x)
    error["fourier"] = np.sqrt(((waves @ waves.T - exact) ** 2).mean())
    assert error["landmarks"] < 0.002 and error["fourier"] < 1.5 / np.sqrt(512)
    # repeated landmarks add no direction
    twice = K.Landmarks(np.vstack([x[:120], x[:120]]), 0.05).apply(x)
    np.testing.assert_allclose(twice @ twice.T, some @ some.T, atol=1e-5)


def test_maps_of_odd_rows(spark):
    sketch = K.TensorSketch(2, 16)
    df = as_frame(spark, [[1, 2], None, [None, 1], [0, 0], [1, 2], [float("inf"), 1]]).repartition(3)
    found = {r["id"]: r["s"] for r in df.withColumn("s", K.lifted(F.col("v"), sketch)).collect()}
    assert found[1] is None and found[0] == found[4] and found[3] == [0.0] * 16 and found[2] is found[5] is None
    np.testing.assert_allclose(found[0], sketch.apply(np.array([[1.0, 2.0]]))[0])
    assert df.where("false").withColumn("s", K.lifted(F.col("v"), sketch)).collect() == []
    with pytest.raises(Exception, match="vectors of 3 entries, the map takes 2"):
        as_frame(spark, [[1, 2, 3]]).withColumn("s", K.lifted(F.col("v"), sketch)).collect()


def test_landmarks_are_different_rows_under_any_partitioning(spark):
    points = rows_of(400, 3).round(6).tolist()
    rows = [*points, *[[7.0, 7.0, 7.0]] * 300, None, [None, 1.0, 2.0], [float("nan"), 0.0, 0.0], [float("inf"), 0.0, 0.0]]
    df = as_frame(spark, rows)
    one = K.choose_landmarks(df.coalesce(1), "v", 50)
    assert len({tuple(p) for p in one.tolist()}) == 50 and np.isfinite(one).all()
    np.testing.assert_array_equal(one, K.choose_landmarks(df.repartition(7), "v", 50))
    assert len(K.choose_landmarks(df, "v", 1_000)) == 401
    copies = as_frame(spark, [[7.0, 7.0, 7.0]] * 900 + points[:20])
    assert len(K.choose_landmarks(copies, "v", 21)) == 21
    for frame, n, message in [(df.where("v is null"), 5, "no usable vector"), (df, 0, "landmarks"), (df, K.MAX_LANDMARKS + 1, "landmarks")]:
        with pytest.raises(ValueError, match=message):
            K.choose_landmarks(frame, "v", n)


def rings(spark, n=300):
    rng = np.random.default_rng(0)
    angle, ring = rng.uniform(0, 2 * np.pi, n), rng.integers(0, 3, n)
    radius = 1 + 1.5 * ring + rng.normal(0, 0.1, n)
    pdf = pd.DataFrame({"id": range(n), "vec": [[float(r * np.cos(a)), float(r * np.sin(a))] for r, a in zip(radius, angle)], "label": ring})
    return T.from_arrays(spark.createDataFrame(pdf), "vec", "label", ["id", "vec"])


def test_sketched_machine_learns_what_the_expansion_does(spark):
    df = rings(spark).filter("label < 2").persist()
    kept = df.columns
    for fit in (lambda: T.fit_poly_svc(df, [0, 1], degree=2, max_iter=15),
                lambda: T.fit_sketched_poly_svc(df, 2, [0, 1], degree=2, n_components=64, max_iter=15)):
        scored = fit()(df)
        assert scored.columns == [*kept, "margins"]
        auc = {r["class"]: r["auc"] for r in E.roc_auc(E.one_vs_rest_scores(scored, "margins", [0, 1])).collect()}
        assert min(auc.values()) > 0.95


def test_landmark_machine_predicts_as_sql_over_its_stored_tables(spark, tmp_path):
    df = rings(spark).persist()
    machine = T.fit_landmark_svc(df, gamma=0.5, n_landmarks=40, max_iter=30)
    scored = {r["id"]: r["prediction"] for r in machine.transform(df).select("id", "prediction").collect()}
    assert T.evaluate(machine.transform(df))["accuracy"] > 0.95
    machine.save(spark, f"{tmp_path}/svc")
    loaded = T.LandmarkMachine.load(spark, f"{tmp_path}/svc")
    assert {r["id"]: r["prediction"] for r in loaded.transform(df).select("id", "prediction").collect()} == scored

    # the whitening folded into the weights: one weight per class and landmark
    weights = pd.DataFrame([(cls, i, w) for cls, m in enumerate(loaded.model.models)
                            for i, w in enumerate(loaded.landmarks.whiten @ m.coefficients.toArray())], columns=["class", "place", "w"])
    bias = pd.DataFrame([(cls, m.intercept) for cls, m in enumerate(loaded.model.models)], columns=["class", "bias"])
    rows = pd.DataFrame([(r["id"], *r["vec"]) for r in df.collect()], columns=["id", "x", "y"])
    sql = duckdb.connect()
    for name, table in {"weights": weights, "bias": bias, "points": rows}.items():
        sql.register(name, table)
    found = sql.execute(f"""
        WITH margins AS (
            SELECT id, class, sum(w * exp(-gamma * (pow(x - point[1], 2) + pow(y - point[2], 2)))) + any_value(bias) AS margin
            FROM points, '{tmp_path}/svc/landmarks/*.parquet' l JOIN weights USING (place) JOIN bias USING (class) GROUP BY id, class)
        SELECT id, arg_max(class, margin) FROM margins GROUP BY id""").fetchall()
    assert {i: float(cls) for i, cls in found} == scored


def test_mapped_rows_leave_in_chunks(spark, monkeypatch):
    """The rows of a large batch are never all held mapped: each chunk is an output of its own, nulls in place."""
    lift = K.lifted(F.col("v"), K.TensorSketch(2, 16), chunk=10)
    df = as_frame(spark, [None if i % 7 == 0 else [1.0, i] for i in range(95)]).coalesce(1)
    got = {r["id"]: r["s"] for r in df.select("id", lift.alias("s")).collect()}
    want = K.TensorSketch(2, 16).apply(np.array([[1.0, i] for i in range(95)]))
    assert all((got[i] is None) == (i % 7 == 0) and (got[i] is None or np.allclose(got[i], want[i])) for i in range(95))
    taken = []
    monkeypatch.setattr(K.F, "arrow_udf", lambda kind: lambda f: lambda col: taken.append(f))
    K.lifted(F.col("v"), K.TensorSketch(2, 16), chunk=10)
    batch = pa.array([[1.0, float(i)] for i in range(95)])
    assert [len(out) for out in taken[0](iter([batch]))] == [10] * 9 + [5]
