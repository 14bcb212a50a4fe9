"""Hash-table neighbours against the exact search, and forests as node tables against the library's own."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cohortline.operators import balance as B
from cohortline.operators import knn as N
from cohortline.operators import lsh
from cohortline.operators import nodes as ND
from cohortline.operators import scoring as S
from cohortline.operators import training as T


def frame(spark, points, labels=None, ids=None, parts=5):
    ids = np.arange(len(points)) if ids is None else ids
    return spark.createDataFrame(pd.DataFrame({
        "id": ids, "vec": [p.tolist() for p in points], "label": labels if labels is not None else [0] * len(points)})).repartition(parts)


@pytest.fixture(scope="module")
def heaps():
    """Three thousand points in sixty heaps of twelve dimensions."""
    rng = np.random.default_rng(21)
    centres = rng.normal(0, 4, (60, 12))
    of = rng.integers(0, 60, 3000)
    return centres[of] + rng.normal(0, 1, (3000, 12)), of


def near_pairs(df):
    return {(r["pid"], r["nid"]) for r in df.collect()}


def recall(found, exact):
    return len(found & exact) / len(exact)


def test_flips_come_in_order_of_distance():
    flips = lsh.likely_flips(5, 32)
    assert len(flips) == 32 and len({tuple(f) for f in flips}) == 32 and flips[0].sum() == 0 and flips[1].tolist() == [1, 0, 0, 0, 0]
    assert lsh.likely_flips(0, 8).shape == (1, 0) and len(lsh.likely_flips(3, 100)) == 8


@pytest.mark.parametrize("tables, bucket_rows", [(4, 64), (2, 250)])
def test_recall_of_the_hash_tables(spark, heaps, tables, bucket_rows):
    points = N.distinct_points(N.as_rows(frame(spark, heaps[0]), "id", "vec"), 4)
    settings = lsh.Projections(tables=tables, bucket_rows=bucket_rows, block_rows=300)
    index = settings.fit(points, 4)
    assert index.planes.shape[2] > 0 and index.recall >= 0.97
    found = settings.search_with(index, points.table.select("pid", "scope", "vec"), 4)
    rows = found.groupBy("pid").count().toPandas()
    assert len(rows) == 3000 and (rows["count"] == 4).all()  # once each, and no query falls short
    assert recall(near_pairs(found), near_pairs(N.nearest_points(points, 4))) >= 0.95


def test_queries_against_all_rows(spark, heaps):
    points = N.distinct_points(N.as_rows(frame(spark, heaps[0]), "id", "vec"), 3)
    asked = points.table.filter("pid % 20 = 0")
    found = near_pairs(lsh.Projections(bucket_rows=128).search(points, 3, asked))
    exact = {pair for pair in near_pairs(N.nearest_points(points, 3)) if pair[0] % 20 == 0}
    assert {p for p, _ in found} == {p for p, _ in exact} and recall(found, exact) >= 0.95


def test_small_classes_are_searched_whole(spark, heaps):
    points, _ = heaps
    labels = np.where(np.arange(len(points)) < 30, 1, 0)
    scoped = N.distinct_points(N.as_rows(frame(spark, points, labels), "id", "vec", scope="label"), 5)
    settings = lsh.Projections(bucket_rows=100)
    index = settings.fit(scoped, 5)
    assert index.bits_of["1"] == 0 and index.bits_of["0"] > 0
    found = near_pairs(settings.search_with(index, scoped.table.select("pid", "scope", "vec"), 5))
    exact = near_pairs(N.nearest_points(scoped, 5))
    assert {p for p in found if p[0] < 30} == {p for p in exact if p[0] < 30} and recall(found, exact) >= 0.95


def test_vectors_without_structure_are_searched_whole(spark):
    points = np.random.default_rng(2).normal(size=(600, 40))
    distinct = N.distinct_points(N.as_rows(frame(spark, points), "id", "vec"), 3)
    settings = lsh.Projections(bucket_rows=64)
    assert settings.fit(distinct, 3).planes.shape[2] == 0
    assert near_pairs(settings.search(distinct, 3)) == near_pairs(N.nearest_points(distinct, 3))


def test_queries_that_meet_too_few_are_searched_again(spark, heaps):
    points = N.distinct_points(N.as_rows(frame(spark, heaps[0][:500]), "id", "vec"), 5)
    fitted = lsh.Projections(bucket_rows=16).fit(points, 5)
    thin = lsh.Index(np.array([np.linalg.qr(np.random.default_rng(0).normal(size=(12, 12)))[0][:, :8]]), fitted.centre, 1, {"all": 8}, 0.0)
    found = lsh.Projections().search_with(thin, points.table.select("pid", "scope", "vec"), 5).groupBy("pid").count().toPandas()
    assert len(found) == 500 and (found["count"] == 5).all()


def test_no_block_grows_with_a_class(spark, heaps):
    """One class, one hot cell: blocks stay near their size on both sides."""
    table = N.distinct_points(N.as_rows(frame(spark, heaps[0]), "id", "vec"), 3).table.select("pid", "scope", "vec").withColumn(
        "cell", F.when(F.col("pid") % 10 < 8, 0).otherwise(F.col("pid")))
    for side in N.blocks(table, table, 500):
        sizes = side.groupBy("scope", "cell", "q_part", "d_part").count().toPandas()
        hot = sizes[sizes["cell"] == 0]
        assert len(hot) == 5 * 5 and hot["count"].max() < 650 and hot["count"].min() > 330
    whole = table.withColumn("cell", F.lit(0)).limit(40)
    queries, _ = N.blocks(whole, whole, min_parts=N.MIN_PARTS)
    assert queries.select("q_part", "d_part").distinct().count() == 4


def test_copies_of_rows_do_not_grow_with_the_table(spark, heaps):
    """Small blocks asked for, large cells: a row is sent to a bounded number of blocks, not to one per so many rows."""
    table = N.distinct_points(N.as_rows(frame(spark, heaps[0]), "id", "vec"), 3).table.select("pid", "scope", "vec").withColumn("cell", F.pmod("pid", F.lit(3)))
    for side in N.blocks(table, table, 4):
        assert side.count() <= 3000 * (N.MAX_BLOCKS + 3)


@pytest.mark.parametrize("dims, pivots", [(40, 60), (2, 60)])
def test_many_cells_match_brute_force(spark, dims, pivots, monkeypatch):
    """Without structure the cells are searched by regions, with few dimensions one by one; for all points or for some."""
    vectors = np.random.default_rng(5).normal(size=(1500, dims))
    points = N.distinct_points(N.as_rows(frame(spark, vectors), "id", "vec"), 3)
    sent, search = [], N.block_search
    monkeypatch.setattr(N, "block_search", lambda routed, data, *a: sent.append(data.select("cell").distinct().count()) or search(routed, data, *a))
    found = near_pairs(N.nearest_points(points, 3, n_pivots=pivots))
    gaps = ((vectors[:, None, :] - vectors[None, :, :]) ** 2).sum(2)
    np.fill_diagonal(gaps, np.inf)
    assert found == {(i, int(j)) for i in range(1500) for j in np.argsort(gaps[i], kind="stable")[:3]}
    assert (sent[1] <= N.REGIONS) == (dims == 40)
    assert near_pairs(N.nearest_points(points, 3, n_pivots=pivots, queries=points.table.filter("pid % 20 = 0"))) == {p for p in found if p[0] % 20 == 0}


def test_block_search_with_groups_equals_plain_order():
    """More data rows than groups of columns, with copies of ids, null ids and rows that are not finite."""
    rng = np.random.default_rng(4)
    data, queries = rng.normal(size=(2003, 5)), rng.normal(size=(300, 5))
    data[:300], data_ids = queries, np.arange(2003.0)
    data_ids[400], data_ids[500], query_ids = 7.0, np.nan, np.arange(300.0)
    data[600], query_ids[3] = np.inf, np.nan
    q, d, dist = N._block_neighbours(queries, query_ids, data[:600], data_ids[:600], 2)
    for i in (0, 3, 7, 299):
        gaps = np.sqrt(((data[:600] - queries[i]) ** 2).sum(1))
        gaps[data_ids[:600] == query_ids[i]] = np.inf
        near = np.sort(gaps)[:2]
        assert np.allclose(dist[2 * i:2 * i + 2], near) and len(q) == 600


def test_text_ids_ties_and_copies(spark):
    """Equal vectors and equal distances: the smaller id first, in both searches."""
    points = np.array([[float(i % 12), float(i % 5)] for i in range(300)])
    rows = N.as_rows(frame(spark, points, ids=[f"r{i:03d}" for i in range(300)]), "id", "vec")
    exact = {r["id"]: [e["id"] for e in r["neighbours"]] for r in N.row_neighbours(rows, 3).collect()}
    again = {r["id"]: [e["id"] for e in r["neighbours"]] for r in N.row_neighbours(rows, 3, search=lsh.Projections(bucket_rows=8).search).collect()}
    assert len(exact) == 300 and all(len(v) == 3 for v in again.values())
    assert exact["r000"] == ["r060", "r120", "r180"] == again["r000"]


def test_balancing_over_the_hash_tables(spark, heaps):
    points, _ = heaps
    points, labels = points[:2000], (points[:2000, 0] > 3).astype(int)
    df = frame(spark, points, labels)
    search = lsh.Projections(bucket_rows=200).search
    made = B.smote(df, "id", "vec", "label", search=search).toPandas()
    assert made.groupby("label").size().to_dict() == {1: int((labels == 0).sum() - (labels == 1).sum())}
    assert all(labels[n] == 1 for n in made["nn_id"])
    kept = {r["id"] for r in B.edited_neighbours(df, "id", "vec", "label", search=search).collect()}
    exact = {r["id"] for r in B.edited_neighbours(df, "id", "vec", "label").collect()}
    assert 0 < len(exact) < 2000 and len(kept ^ exact) <= 0.03 * len(exact)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "id long, vec array<double>, label int")
    assert N.row_neighbours(N.as_rows(empty, "id", "vec"), 3).collect() == []
    assert N.row_neighbours(N.as_rows(empty, "id", "vec"), 3, search=lsh.Projections().search).collect() == []


# -- forests as node tables ------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def grown(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(900, 5))
    label = (x[:, 0] + 0.5 * x[:, 1] > 0).astype(int) + (x[:, 2] > 1).astype(int)
    pdf = pd.DataFrame(x, columns=[f"f{i}" for i in range(5)])
    pdf["label"], pdf["id"] = label, np.arange(900)
    df = spark.createDataFrame(pdf).repartition(5).persist()
    names = [f"f{i}" for i in range(5)]
    model = T.forest(numTrees=15, maxDepth=9, minInstancesPerNode=1).fit(T.assemble(df, names, "label"))
    return df, names, model


def by_library(df, names, model):
    scored = model.transform(T.assemble(df, names, "label", ["id"])).select("id", "prediction", vector_to_array("probability").alias("p"))
    return {r["id"]: (r["prediction"], r["p"]) for r in scored.collect()}


@pytest.mark.parametrize("max_nodes", [ND.MAX_NODES, 300])
def test_walking_the_nodes_equals_the_library(spark, grown, max_nodes):
    df, names, model = grown
    nodes = ND.model_nodes(model, spark)
    assert nodes.count() == model.totalNumNodes
    forest = ND.NodeForest(nodes, names, 3, max_nodes=max_nodes)
    want = by_library(df, names, model)
    got = forest.transform(df.withColumn("tree", F.lit("mine"))).collect()  # clashing names of the caller's columns
    assert len(got) == 900 and set(got[0].asDict()) == {*names, "label", "id", "tree", "probability", "prediction"}
    for r in got:
        assert r["probability"] == pytest.approx(want[r["id"]][1], abs=1e-12)
        assert r["prediction"] == want[r["id"]][0] or len({round(p, 9) for p in r["probability"]}) < 3


def test_scores_carry_confidence_and_reasons(spark, grown):
    df, names, model = grown
    forest = ND.NodeForest(ND.model_nodes(model, spark), names, 3)
    raw = df.select("id", *[F.col(n).cast("string").alias(n) for n in names]).withColumn("f0", F.when(F.col("id") % 10 == 1, None).when(
        F.col("id") % 10 == 2, "n/a").otherwise(F.col("f0")))
    scored = {r["id"]: r for r in S.score_raw(raw, forest, None, names, {"a": 0, "b": 1}).collect()}
    want = by_library(df, names, model)
    assert len(scored) == 900
    for i, r in scored.items():
        if i % 10 == 1:
            assert (r["status"], r["error"], r["diagnosis"], r["confidence"], r["inputs"]) == ("error", "f0: missing", None, None, None)
        elif i % 10 == 2:
            assert (r["status"], r["error"]) == ("error", "f0: not a number")
        elif want[i][0] == 2:
            assert (r["status"], r["error"], r["confidence"]) == ("error", "no label for code 2", None)
        else:
            assert r["status"] == "success" and r["diagnosis"] == "ab"[int(want[i][0])]
            assert r["confidence"] == pytest.approx(100 * max(want[i][1]), abs=0.0051)


def test_random_trees_count_their_training_rows(spark, grown):
    df, names, _ = grown
    bounds = df.select(F.inline(F.array(*[F.struct(F.lit(i).alias("feature"), F.col(n).alias("v")) for i, n in enumerate(names)]))).groupBy("feature").agg(
        F.min("v").alias("low"), F.max("v").alias("high"))
    forest = ND.NodeForest(ND.random_nodes(bounds, 5, 7, 4), names, 3).with_counts(df, "label")
    nodes = forest.nodes.toPandas()
    assert len(nodes) == 7 * 31 and (nodes["below"] < 0).sum() == 7 * 16
    totals = nodes[nodes["below"] < 0].groupby("tree")["counts"].apply(lambda c: sum(map(sum, c)))
    assert (totals == 900).all()
    got = forest.transform(df).toPandas()
    tree = {t: part.set_index("node") for t, part in nodes.groupby("tree")}
    for r in got.head(60).itertuples():
        votes = np.zeros(3)
        for part in tree.values():
            at = 0
            while part.loc[at, "below"] >= 0:
                at = part.loc[at, "below"] if getattr(r, names[part.loc[at, "feature"]]) <= part.loc[at, "threshold"] else part.loc[at, "above"]
            counts = np.array(part.loc[at, "counts"])
            votes += counts / counts.sum() if counts.sum() else 0
        assert np.allclose(votes / 7, r.probability) and r.prediction == int(np.argmax(np.round(votes, 12)))


def test_a_tree_beyond_the_bound_is_refused(spark, grown):
    _, names, model = grown
    with pytest.raises(ValueError, match="nodes, more than"):
        ND.NodeForest(ND.model_nodes(model, spark), names, 3, max_nodes=10).transform(grown[0])


def test_scoring_by_nodes_shuffles_nothing(spark, heaps):
    """Rows are scored where they are, null and NaN features going above, in one group of trees or several."""
    df = frame(spark, heaps[0][:200, :2]).select("id", F.get("vec", F.lit(0)).alias("a"), F.when(F.col("id") % 5 > 0, F.get("vec", F.lit(1))).alias("b"))
    nodes = spark.createDataFrame([(t, 0, t, 0.0, 1, 2, None) for t in (0, 1)] + [(t, n, -1, None, -1, -1, [2.0 - n, n - 1.0]) for t in (0, 1) for n in (1, 2)], ND.NODE_SCHEMA)
    for most in (6, 3):
        scored = ND.NodeForest(nodes, ["a", "b"], 2, max_nodes=most).transform(df)
        assert "Exchange hashpartitioning" not in scored._jdf.queryExecution().executedPlan().toString()
        for r in scored.select("id", "a", "b", "probability", "prediction").filter("id < 60").collect():
            above = ((r["a"] > 0) + (r["b"] is None or r["b"] > 0)) / 2
            assert r["probability"] == [1 - above, above] and r["prediction"] == float(above > 0.5)


def test_few_dimensions_get_codes_longer_than_them(spark):
    """With few dimensions the buckets shrink as the table grows: a code may have more signs than the vectors have numbers."""
    vectors = np.random.default_rng(9).normal(size=(6000, 3))
    points = N.distinct_points(N.as_rows(frame(spark, vectors), "id", "vec"), 4)
    asked = points.table.filter("pid % 20 = 0")
    settings = lsh.Projections(bucket_rows=32)
    index = settings.fit(points, 4)
    assert index.planes.shape[2] > 3 and index.recall >= 0.97
    found = settings.search_with(index, points.table.select("pid", "scope", "vec"), 4, asked)
    assert recall(near_pairs(found), near_pairs(N.nearest_points(points, 4, queries=asked))) >= 0.93
