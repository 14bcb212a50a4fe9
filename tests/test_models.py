import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cohortline.operators import balance as B
from cohortline.operators import evaluate as E
from cohortline.operators import knn as N
from cohortline.operators import prep
from cohortline.operators import scoring as S
from cohortline.operators import training as T
from cohortline.plans import patients as P
from cohortline.plans import train as TP


def vectors(spark, points, labels, parts=3):
    pdf = pd.DataFrame({"id": np.arange(len(points)), "vec": [list(map(float, p)) for p in points], "label": labels})
    return spark.createDataFrame(pdf).repartition(parts)


def brute(points, k, scope=None):
    out = {}
    for i, p in enumerate(points):
        d = np.sqrt(((points - p) ** 2).sum(1))
        near = sorted((d[j], j) for j in range(len(points)) if j != i and (scope is None or scope[i] == scope[j]))
        out[i] = [j for _, j in near[:k]]
    return out


def test_worker_functions_need_no_installed_package():
    import subprocess
    import sys

    from pyspark import cloudpickle
    code = ("import sys, numpy as np; from pyspark import cloudpickle; f = cloudpickle.loads(sys.stdin.buffer.read()); "
            "x = np.array([[0.0], [1.0], [5.0]]); i = np.arange(3); print(f(x, i, x, i, 1)[1].tolist())")
    done = subprocess.run([sys.executable, "-c", code], input=cloudpickle.dumps(N._block_neighbours), capture_output=True, cwd="/", check=True)
    assert done.stdout.strip() == b"[1, 0, 1]"


@pytest.fixture(scope="module")
def cloud():
    """Ties on a grid, and one vector copied over a third of the rows."""
    rng = np.random.default_rng(8)
    points = np.concatenate([rng.integers(0, 6, (120, 3)).astype(float), np.tile([2.0, 2.0, 2.0], (90, 1)), rng.normal(3, 2, (60, 3))])
    order = rng.permutation(len(points))
    labels = rng.integers(0, 3, len(points))
    return points[order], labels


@pytest.mark.parametrize("pivots,block,scoped", [(1, 8192, False), (9, 16, False), (5, 32, True)])
def test_neighbours_match_brute_force(spark, cloud, pivots, block, scoped):
    points, labels = cloud
    rows = N.as_rows(vectors(spark, points, labels), "id", "vec", "label", "label" if scoped else None)
    got = {r["id"]: [e["id"] for e in r["neighbours"]] for r in N.row_neighbours(rows, 4, n_pivots=pivots, block_rows=block).collect()}
    assert got == brute(points, 4, labels if scoped else None)


def test_fewer_rows_than_neighbours(spark):
    rows = N.as_rows(vectors(spark, np.array([[0.0], [1.0], [5.0]]), [0, 0, 1]), "id", "vec", "label", "label")
    got = {r["id"]: [e["id"] for e in r["neighbours"]] for r in N.row_neighbours(rows, 5).collect()}
    assert got == {0: [1], 1: [0], 2: []}


def test_probes_limit_the_search(spark, cloud):
    points, labels = cloud
    rows = N.as_rows(vectors(spark, points, labels), "id", "vec", "label")
    got = {r["id"]: [e["id"] for e in r["neighbours"]] for r in N.row_neighbours(rows, 4, probes=3, n_pivots=9).collect()}
    want = brute(points, 4)
    hits = np.mean([len(set(got[i]) & set(want[i])) / 4 for i in want])
    assert set(got) == set(want) and hits > 0.7


def test_oversampling_levels_the_classes(spark):
    rng = np.random.default_rng(2)
    points = np.concatenate([rng.normal(0, 1, (60, 2)), rng.normal(5, 1, (17, 2)), rng.normal(-5, 1, (6, 2))])
    labels = np.array([0] * 60 + [1] * 17 + [2] * 6)
    made = B.smote(vectors(spark, points, labels), "id", "vec", "label").toPandas()
    assert made.groupby("label").size().to_dict() == {1: 43, 2: 54}
    near = brute(points, 5, labels)
    for r in made.itertuples():
        assert r.nn_id in near[r.base_id] and 0 <= r.u < 1
        assert np.allclose(r.vec, points[r.base_id] + r.u * (points[r.nn_id] - points[r.base_id]))
    per_base = made[made["label"] == 1].groupby("base_id").size()
    assert per_base.max() - per_base.min() <= 1
    again = B.smote(vectors(spark, points, labels, 7), "id", "vec", "label").toPandas()
    key = ["base_id", "draw"]
    assert made.sort_values(key)["nn_id"].tolist() == again.sort_values(key)["nn_id"].tolist()
    with pytest.raises(ValueError):
        B.smote(vectors(spark, points[:65], labels[:65]), "id", "vec", "label")


def test_editing_keeps_rows_in_agreement(spark, cloud):
    points, labels = cloud
    labels = (points[:, 0] > 2).astype(int)
    kept = {r["id"] for r in B.edited_neighbours(vectors(spark, points, labels), "id", "vec", "label").collect()}
    near = brute(points, 3)
    assert kept == {i for i, nn in near.items() if all(labels[j] == labels[i] for j in nn)}


def test_split_is_disjoint_complete_and_keeps_copies_together(spark):
    df = spark.range(3000).select((F.col("id") % 1000).alias("a"), F.lit("x").alias("b"))
    train, test = prep.hash_split(df)
    again, _ = prep.hash_split(df.repartition(11))
    assert train.count() + test.count() == 3000 and again.count() == train.count()
    assert train.select("a").distinct().join(test.select("a").distinct(), "a").count() == 0
    assert abs(test.count() / 3000 - 0.2) < 0.05


def test_folds_are_balanced(spark):
    df = spark.range(503).withColumn("label", F.when(F.col("id") % 3 == 0, 1).otherwise(0))
    counts = prep.stratified_folds(df, "label", "id").groupBy("label", "fold").count().toPandas()
    assert len(counts) == 10 and counts.groupby("label")["count"].agg(lambda c: c.max() - c.min()).max() <= 1


def test_standardiser_uses_population_deviation(spark):
    df = spark.createDataFrame(pd.DataFrame({"x": [1.0, 2, 3, 4], "c": [5.0] * 4, "flag": [0, 1, 0, 1], "t": [1, 2, 3, 4]}))
    train, test, stats = prep.scale_split(df, df, ["t"])
    assert train.columns == ["x", "c", "flag", "t"]
    assert [r["x"] for r in train.orderBy("t").collect()] == pytest.approx(list((np.array([1, 2, 3, 4]) - 2.5) / np.std([1, 2, 3, 4])))
    assert [r["column_name"] for r in stats.collect()] == ["x"]
    assert prep.apply_standardiser(df, prep.fit_standardiser(df, ["c"])).first()["c"] == 0.0


def test_label_codes(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "l string")
    assert prep.fit_label_codes(df, "l") == {"a": 0, "b": 1}


def test_metrics_by_hand(spark):
    pairs = [(0, 0)] * 5 + [(0, 1)] * 2 + [(1, 1)] * 3 + [(2, 1)] * 2 + [(2, 3)]
    df = spark.createDataFrame([(float(a), float(b)) for a, b in pairs], "label double, prediction double")
    row = E.classification_metrics(df).first()
    f0, f1 = 2 * 1.0 * (5 / 7) / (1 + 5 / 7), 2 * (3 / 7) * 1 / (3 / 7 + 1)
    assert row["accuracy"] == pytest.approx(8 / 13)
    assert row["balanced_accuracy"] == pytest.approx((5 / 7 + 1 + 0) / 3)
    assert row["f1_weighted"] == pytest.approx((7 * f0 + 3 * f1) / 13)
    report = {r["class"]: (r["precision"], r["support"]) for r in E.class_report(df).collect()}
    assert report[3.0] == (0.0, 0) and report[1.0] == (pytest.approx(3 / 7), 3)


def test_auc_with_ties_and_single_class(spark):
    rng = np.random.default_rng(1)
    score, pos = rng.integers(0, 8, 300) / 8.0, rng.integers(0, 2, 300)
    want = np.mean([(a > b) + 0.5 * (a == b) for a in score[pos == 1] for b in score[pos == 0]])
    df = spark.createDataFrame(pd.DataFrame({"class": 0, "is_positive": pos == 1, "score": score}))
    assert E.roc_auc(df).first()["auc"] == pytest.approx(want)
    assert E.roc_auc(df.filter("is_positive")).first()["auc"] is None


def test_champion_tie_goes_to_the_first_name(spark):
    runs = T.run_record(spark, "SVC", {"composite_score": 0.9}).unionByName(T.run_record(spark, "RandomForestClassifier", {"composite_score": 0.9}))
    assert E.champion(runs, [T.FOREST_NAME, T.KERNEL_NAME]).first()["model"] == T.FOREST_NAME
    better = runs.unionByName(T.run_record(spark, "SVC", {"composite_score": 0.95}))
    assert E.champion(better, [T.FOREST_NAME, T.KERNEL_NAME]).first()["composite_score"] == 0.95
    assert E.metric_long(runs).count() == 2


def blobs(n=360, seed=0):
    rng = np.random.default_rng(seed)
    label = rng.integers(0, 3, n)
    centre = np.array([[0, 0], [4, 0], [0, 4]])[label]
    xy = centre + rng.normal(0, 0.7, (n, 2))
    return pd.DataFrame({"x": xy[:, 0], "y": xy[:, 1], "noise": rng.normal(0, 1, n), "flag": rng.integers(0, 2, n), "label": label})


def test_kernel_and_poly_machines_learn_rings(spark):
    rng = np.random.default_rng(0)
    angle, ring = rng.uniform(0, 2 * np.pi, 300), rng.integers(0, 2, 300)
    radius = 1 + 2 * ring + rng.normal(0, 0.1, 300)
    pdf = pd.DataFrame({"vec": [[float(r * np.cos(a)), float(r * np.sin(a))] for r, a in zip(radius, angle)], "label": ring})
    df = T.from_arrays(spark.createDataFrame(pdf), "vec", "label").persist()
    kernel = T.fit_kernel_svc(df, 2, gamma=0.5, n_components=64, max_iter=20)
    assert T.evaluate(kernel.transform(df))["accuracy"] > 0.95
    scored = T.fit_poly_svc(df, [0, 1], degree=2, max_iter=15)(df)
    auc = {r["class"]: r["auc"] for r in E.roc_auc(E.one_vs_rest_scores(scored, "margins", [0, 1])).collect()}
    assert min(auc.values()) > 0.95


def test_selection_curve_and_folds(spark):
    df = spark.createDataFrame(blobs(240)).withColumn("id", F.monotonically_increasing_id())
    small = T.forest(numTrees=4, maxDepth=4)
    path = T.eliminate_features(df, ["noise", "x", "y"], "label", "id", small, n_folds=3)
    assert [len(r["features"]) for r in path.orderBy("n_features").collect()] == [1, 2, 3]
    assert set(T.chosen_features(path)) >= {"x", "y"}
    data = T.assemble(df, ["x", "y"], "label", ["id"])
    curve = T.learning_curve(data, small, "id", fractions=(0.3, 1.0), n_folds=3).toPandas()
    assert len(curve) == 6 and curve[curve["fraction"] == 1.0]["n_train"].sum() == 2 * 240
    assert T.fold_summary(T.cross_validate(data, small, "id", n_folds=3)).first()["mean"] > 0.85


def test_training_plan_end_to_end(spark, tmp_path):
    table = spark.createDataFrame(blobs())
    out = str(tmp_path / "run")
    cfg = TP.TrainConfig(["x", "y", "noise"], "label", forest={"numTrees": 8, "maxDepth": 5}, kernel_components=64, kernel_iterations=15)
    result = TP.train(table, cfg, out)
    assert set(result.metrics) == {T.FOREST_NAME, T.KERNEL_NAME} and result.metrics[result.champion]["composite_score"] > 0.85
    assert "roc_auc" in result.metrics[T.FOREST_NAME] and "roc_auc" not in result.metrics[T.KERNEL_NAME]
    runs = spark.read.parquet(f"{out}/runs")
    assert runs.count() == 3 and runs.filter(F.col("parent_id") == result.run_id).count() == 2
    model, scaler, features = TP.load_scorer(spark, out)
    assert features == ["x", "y", "noise"]
    codes = {"a": 0, "b": 1, "c": 2}
    scored = S.score(table.withColumn("id", F.monotonically_increasing_id()), model, scaler, features, codes)
    ok = scored.join(table.withColumn("id", F.monotonically_increasing_id()).select("id", F.col("label").alias("y")), "id")
    right = ok.filter(F.expr("diagnosis = element_at(array('a','b','c'), cast(y as int) + 1)")).count()
    assert right > 0.85 * 360 and scored.filter("status <> 'success'").count() == 0
    with pytest.raises(ValueError):
        prep.select_features(table, ["x", "gone"])


# Values of one accepted request.
PAYLOAD = {
    "ESR": 23.7, "RBC_Count": 4.33, "PLT_Count": 276336, "Hemoglobin": 12.7, "MCH": 26.6, "Sickness_Duration_Months": 43, "Reticulocyte_Count": 1.63,
    "Monocytes": 3.3, "WBC_Count": 8828, "MPV": 8.4, "MBL_Level": 0.95, "MCV": 84.7, "RDW": 14.6, "C3": 67.4, "Hematocrit": 39.9, "Lymphocytes": 25.8,
    "MCHC": 31.2, "Neutrophils": 34.6, "Basophils": 0.81, "Eosinophils": 2.3, "Age": 22, "C4": 4.35, "Esbach": 239.6,
}


@pytest.fixture(scope="module")
def patient_model(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({f: rng.normal(PAYLOAD[f], 1 + abs(PAYLOAD[f]) * 0.1, 120) for f in P.MODEL_FEATURES})
    pdf["C4"] = np.log1p(pdf["C4"].abs())
    pdf["diagnosis"] = (pdf["Age"] > 22).astype(int) + 2
    train = spark.createDataFrame(pdf)
    stats = prep.fit_standardiser(train, P.MODEL_FEATURES)
    scaled = prep.apply_standardiser(train, stats, others_after=False).withColumn("label", F.col("diagnosis").cast("double"))
    return T.fit_pipeline(scaled, P.MODEL_FEATURES, T.forest(numTrees=5, maxDepth=4)), stats


def test_payload_is_scored_and_missing_age_rejected(spark, patient_model, tmp_path):
    model, stats = patient_model
    assert len(P.MODEL_FEATURES) == 23 and len(P.OPTIONAL_INPUTS) == 15 and set(PAYLOAD) == set(P.MODEL_FEATURES)
    rows = [{"request": "full", **PAYLOAD}, {"request": "ones", **dict.fromkeys(PAYLOAD, 1.0)}, {"request": "no_age", **PAYLOAD, "Age": None},
            {"request": "text", **PAYLOAD, "ESR": "high"}]
    df = spark.createDataFrame(pd.DataFrame(rows).astype(object).map(lambda v: None if v is None or v != v else str(v)))
    accepted, rejected = S.validate_inputs(df, P.MODEL_FEATURES, P.OPTIONAL_INPUTS)
    assert {r["request"]: r["reasons"] for r in rejected.collect()} == {"no_age": ["Age: missing"], "text": ["ESR: not a number"]}
    assert accepted.first()["crp"] == 0.0
    everything = [*P.MODEL_FEATURES, *P.OPTIONAL_INPUTS]
    scored = S.score(accepted, model, stats, P.MODEL_FEATURES, P.DIAGNOSIS_CODES, ["C4"], inputs=everything)
    assert len(scored.schema["inputs"].dataType.names) == 38
    got = {r["request"]: r for r in scored.collect()}
    assert set(got) == {"full", "ones"} and all(r["status"] == "success" and r["diagnosis"] in ("normal", "rheumatoid_arthritis") for r in got.values())
    assert all(0 < r["confidence"] <= 100 for r in got.values()) and got["full"]["inputs"]["C4"] == 4.35
    assert S.score_features(scored, ["Age"]).count() == 2
    unknown = S.score(accepted, model, stats, P.MODEL_FEATURES, {"elsewhere": 9}, ["C4"]).first()
    assert unknown["status"] == "error" and unknown["diagnosis"] is None and "no label" in unknown["error"]
    hollow = S.score(accepted.withColumn("ESR", F.lit(None).cast("double")), model, stats, P.MODEL_FEATURES, P.DIAGNOSIS_CODES, ["C4"]).first()
    assert hollow["status"] == "error" and hollow["confidence"] is None
    path = str(tmp_path / "model")
    T.save_model(model, path)
    assert S.score(accepted, T.load_model(path), stats, P.MODEL_FEATURES, P.DIAGNOSIS_CODES, ["C4"], inputs=everything).collect() == scored.collect()


def test_raw_compat_skips_the_log(spark, patient_model):
    model, stats = patient_model
    accepted = spark.createDataFrame([tuple(float(PAYLOAD[f]) for f in P.MODEL_FEATURES)], P.MODEL_FEATURES)
    a = S.score(accepted, model, stats, P.MODEL_FEATURES, P.DIAGNOSIS_CODES, ["C4"], raw_compat=True).first()
    assert a["status"] == "success" and a["inputs"]["C4"] == 4.35


def test_range_rules(spark):
    df = spark.createDataFrame([(5.0, 130.0), (-1.0, 50.0), (None, 20.0)], "RBC_Count double, Age double")
    bounds = {c: P.INPUT_BOUNDS[c] for c in ("RBC_Count", "Age")}
    assert {(r["column_name"], r["n"]) for r in S.range_violations(df, bounds).collect()} == {("RBC_Count", 1), ("Age", 1)}


def test_probability_columns_feed_the_auc(spark):
    df = T.assemble(spark.createDataFrame(blobs(150)), ["x", "y"], "label")
    scored = T.forest(numTrees=4, maxDepth=4).fit(df).transform(df).withColumn("p", vector_to_array("probability"))
    assert E.macro_roc_auc(scored, "p", [0, 1, 2]).first()["roc_auc"] > 0.95


def test_synthetic_plan_of_large_counts(spark):
    """Index times need passes 64 bits; the plan's arithmetic does not."""
    row = spark.sql("SELECT 3100000000L AS row_index, 3100000007L AS need, 6200000000L AS group_size")
    got = row.selectExpr(f"{B.SPREAD.format('row_index + 1')} - {B.SPREAD.format('row_index')} AS draws").first()["draws"]
    assert got == 3100000001 * 3100000007 // 6200000000 - 3100000000 * 3100000007 // 6200000000


def test_registered_queries_use_full_settings(spark, sf_dir, monkeypatch):
    import inspect

    from cohortline.plans import model_queries as Q

    class Reached(Exception):
        pass

    def stop(*args):
        raise Reached(args)

    fit_poly_svc = T.fit_poly_svc
    monkeypatch.setattr(Q.T, "fit_poly_svc", lambda *a, **k: stop(inspect.signature(fit_poly_svc).bind(*a, **k)))
    monkeypatch.setattr(Q.T, "eliminate_features", lambda df, features, label, key, estimator, **k: stop(estimator))
    monkeypatch.setattr(Q.T, "fit_pipeline", lambda train, features, estimator: stop(estimator))
    found = {}
    for query in (Q.poly_roc, Q.feature_elimination, Q.batch_score):
        with pytest.raises(Reached) as reached:
            query(spark, sf_dir)
        found[query.__name__] = reached.value.args[0][0]
    bound = found["poly_roc"]
    bound.apply_defaults()
    assert (bound.arguments["degree"], bound.arguments["max_iter"]) == (3, 50)
    forests = {name: (found[name].getNumTrees(), found[name].getMaxDepth()) for name in ("feature_elimination", "batch_score")}
    assert forests == {"feature_elimination": (100, 10), "batch_score": (70, 18)}


def test_large_forests_take_turns(spark, monkeypatch):
    """The driver holds every forest that grows: small ones grow side by side, large ones one at a time."""
    df = spark.range(60).select(F.col("id"), F.col("id").cast("double").alias("x"), (F.col("id") % 2).cast("int").alias("label"))
    data, small = T.assemble(df, ["x"], "label", ["id"]), T.forest(numTrees=2, maxDepth=2)
    used, run = [], T._side_by_side
    monkeypatch.setattr(T, "_side_by_side", lambda tasks, parallelism: used.append(parallelism) or run(tasks, parallelism))
    before = T.cross_validate(data, small, "id", n_folds=2).collect()
    monkeypatch.setattr(T, "MAX_GROWN_NODES", 10)
    assert T.cross_validate(data, small, "id", n_folds=2).collect() == before and used == [4, 1]


def test_fractions_of_a_curve_take_turns_by_their_own_rows(spark, monkeypatch):
    df = spark.range(60).select(F.col("id"), F.col("id").cast("double").alias("x"), (F.col("id") % 2).cast("int").alias("label"))
    data, small = T.assemble(df, ["x"], "label", ["id"]), T.forest(numTrees=2, maxDepth=4)
    used, run = [], T._side_by_side
    monkeypatch.setattr(T, "_side_by_side", lambda tasks, parallelism: used.append(parallelism) or run(tasks, parallelism))
    monkeypatch.setattr(T, "MAX_GROWN_NODES", 30)
    curve = T.learning_curve(data, small, "id", fractions=(0.3, 1.0), n_folds=2).collect()
    assert [(r["fraction"], r["fold"]) for r in curve] == [(0.3, 0), (0.3, 1), (1.0, 0), (1.0, 1)]
    assert used[0] > 1 and used[1:] == [1]


def test_small_files_are_fitted_and_scored_on_all_cores(spark, sf_dir, monkeypatch):
    """A file of one row group is one partition; fits and scores work on as many as there are cores."""
    from cohortline.plans import model_queries as Q

    df, cores = spark.createDataFrame(blobs(120)).coalesce(1), spark.sparkContext.defaultParallelism
    parts = []

    class Seen(T.RandomForestClassifier):
        def _fit(self, dataset):
            parts.append(dataset.rdd.getNumPartitions())
            return super()._fit(dataset)

    model = T.fit_pipeline(df.withColumn("label", F.col("label").cast("double")), ["x", "y"], Seen(numTrees=4, maxDepth=4, seed=1))
    assert T._accuracy(model.transform(df)) > 0.9

    machines = T._class_machines
    monkeypatch.setattr(T, "_class_machines", lambda base, *a: parts.append(base.rdd.getNumPartitions()) or machines(base, *a))
    T.fit_poly_svc(T.assemble(df, ["x", "y"], "label"), [0, 1, 2], degree=2, max_iter=3)

    class Reached(Exception):
        pass

    def score(accepted, *args, **kwargs):
        parts.append(accepted.rdd.getNumPartitions())
        raise Reached

    monkeypatch.setattr(Q.T, "fit_pipeline", lambda *a: None)
    monkeypatch.setattr(Q.S, "score", score)
    with pytest.raises(Reached):
        Q.batch_score(spark, sf_dir)
    assert cores > 1 and parts == [cores] * 3


def test_eliminating_forests_read_sorted_rows_on_all_cores(spark, monkeypatch):
    """Many rows are dealt out evenly and sorted; the forests that grow side by side keep a bounded number of draws and node ids."""
    df, cores = spark.createDataFrame(blobs(120)).withColumn("id", F.monotonically_increasing_id()).coalesce(1), spark.sparkContext.defaultParallelism
    seen = []

    class Seen(T.RandomForestClassifier):
        def _fit(self, dataset):
            parts = dataset.rdd.glom().map(lambda rows: [tuple(r["features"].toArray().tolist()) for r in rows]).collect()
            seen.append((len(parts), all(rows == sorted(rows) for rows in parts)))
            return super()._fit(dataset)

    estimator = Seen(numTrees=2, maxDepth=2, seed=1)
    small = T.eliminate_features(df, ["x", "y"], "label", "id", estimator, n_folds=2)
    assert seen == [(1, False)] * 6
    monkeypatch.setattr(T, "SORTED_ROWS", 100)
    large = T.eliminate_features(df, ["x", "y"], "label", "id", estimator, n_folds=2)
    # the later fits of a fold may read the second column alone, which only runs of equal first values sort
    assert {n for n, _ in seen[6:]} == {cores} and sum(ordered for _, ordered in seen[6:]) >= 3
    assert [r["n_features"] for r in large.collect()] == [r["n_features"] for r in small.collect()] == [1, 2]
    assert T._fits_at_once(T.forest(numTrees=100, maxDepth=10), 600_000, 4) == 4
    assert T._fits_at_once(T.forest(numTrees=100, maxDepth=10), 3_600_000, 4) == 2


def test_large_forests_grow_in_parts(spark, monkeypatch):
    """A forest with too many nodes to grow beside others is grown in parts, all its trees, each part on few partitions; the
    parts vote together as one forest does."""
    data = T.assemble(spark.createDataFrame(blobs(360)).withColumn("id", F.monotonically_increasing_id()), ["x", "y", "noise"], "label", ["id"])
    data, cores = T.cut_lineage(T.spread(data, 360)), spark.sparkContext.defaultParallelism
    fitted = []

    class Seen(T.RandomForestClassifier):
        def _fit(self, dataset):
            fitted.append((self.getNumTrees(), self.getSeed(), dataset.rdd.getNumPartitions()))
            return super()._fit(dataset)

    estimator = Seen(numTrees=11, maxDepth=9, minInstancesPerNode=5, seed=3)
    T._grow(estimator, data, 360, 4)
    assert fitted == [(11, 3, max(1, cores // 4))]
    monkeypatch.setattr(T, "MAX_GROWN_NODES", 900)
    at_once = T._fits_at_once(estimator, 360, 4)
    grown = T._grow(estimator, data, 360, at_once)
    assert at_once == 1 and sum(n for n, _, _ in fitted[1:]) == 11 and len(fitted) > 3
    assert len({seed for _, seed, _ in fitted[1:]}) == len(fitted) - 1 and {p for _, _, p in fitted[1:]} == {max(1, cores // 2)}
    scored = grown.transform(data)
    assert scored.columns == [*data.columns, "prediction"] and T._accuracy(scored) > 0.9
    # votes of the trees, one by one
    want = {}
    for model in grown.models:
        for row in model.transform(data).select("id", vector_to_array("rawPrediction").alias("votes")).collect():
            want[row["id"]] = np.add(want.get(row["id"], 0), row["votes"])
    assert {r["id"]: r["prediction"] for r in scored.collect()} == {i: float(np.argmax(v)) for i, v in want.items()}
    curve = T.learning_curve(data, estimator, "id", fractions=(1.0,), n_folds=2).collect()
    assert len(curve) == 2 and min(r["test_accuracy"] for r in curve) > 0.85
    # a shallow forest has few nodes: rows decide, and it keeps all partitions
    T._grow(Seen(numTrees=2, maxDepth=2, seed=1), data, 360, 1)
    assert fitted[-1] == (2, 1, cores)
