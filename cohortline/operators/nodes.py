"""A forest as a table of nodes, walked level by level in generated code.

``nodes``: (tree, node, feature, threshold, below, above, counts), one row per node, numbered from 0
in each tree, the root first. An inner node sends values up to its threshold to ``below`` and others
to ``above``; a leaf has -1 there and its class counts. Such a table can be read, joined, stored and
compared by any engine, and scoring does not need the training library.

Scoring pairs each row with each tree: the trees are one row each, of arrays, and their number of
nodes is checked before they are broadcast; larger forests are broadcast some trees at a time. A
level is one projection over array look-ups. Where only the votes of a row are asked for, its batch walks
all trees in place, so that no row is shuffled to bring its votes together.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.functions.text import stable_hash
from cohortline.session import pin_small, shared_path, store

NODE_SCHEMA = "tree int, node int, feature int, threshold double, below int, above int, counts array<double>"
#: Nodes of one broadcast, some 100 bytes each.
MAX_NODES = 1_000_000
HASH_RANGE = float(2 ** 32)


def model_nodes(model: RandomForestClassificationModel, spark: SparkSession) -> DataFrame:
    """The nodes of a trained forest, from its stored form; splits on ordered features only."""
    path = shared_path(spark, "forest")
    model.write().save(path)
    data = spark.read.parquet(f"{path}/data")
    n = F.col("nodeData")
    inner = n["leftChild"] >= 0
    if not data.filter(inner & (n["split"]["numCategories"] >= 0)).isEmpty():
        raise ValueError("splits on categories have no threshold")
    return data.select(
        F.col("treeID").cast("int").alias("tree"), n["id"].alias("node"), F.when(inner, n["split"]["featureIndex"]).otherwise(-1).alias("feature"),
        F.when(inner, F.get(n["split"]["leftCategoriesOrThreshold"], F.lit(0))).alias("threshold"), n["leftChild"].alias("below"),
        n["rightChild"].alias("above"), n["impurityStats"].alias("counts"))


def random_nodes(bounds: DataFrame, n_features: int, n_trees: int, depth: int, seed: int = 42) -> DataFrame:
    """Totally randomised trees: every inner node of a complete tree of ``depth`` levels splits a hashed
    feature at a hashed place between its ``bounds`` (feature, low, high). Counts are null until
    ``with_counts`` fills them."""
    spark = bounds.sparkSession
    n_inner = 2 ** depth - 1
    numbered = spark.range(n_trees * (2 * n_inner + 1)).select(
        F.floor(F.col("id") / (2 * n_inner + 1)).cast("int").alias("tree"), F.pmod("id", F.lit(2 * n_inner + 1)).cast("int").alias("node"))
    inner = numbered.filter(F.col("node") < n_inner).withColumn(
        "feature", F.pmod(stable_hash("tree", "node", seed=seed), F.lit(n_features)).cast("int"))
    place = stable_hash("tree", "node", seed=seed + 1) / HASH_RANGE
    split = inner.join(pin_small(bounds), "feature").select(
        "tree", "node", "feature", (F.col("low") + (F.col("high") - F.col("low")) * place).alias("threshold"),
        (2 * F.col("node") + 1).alias("below"), (2 * F.col("node") + 2).alias("above"), F.lit(None).cast("array<double>").alias("counts"))
    leaves = numbered.filter(F.col("node") >= n_inner).select(
        "tree", "node", F.lit(-1).alias("feature"), F.lit(None).cast("double").alias("threshold"), F.lit(-1).alias("below"), F.lit(-1).alias("above"),
        F.lit(None).cast("array<double>").alias("counts"))
    return split.unionByName(leaves)


@dataclass(frozen=True)
class NodeForest:
    """``nodes`` over the ``features`` of a row, ``n_classes`` classes coded from 0."""

    nodes: DataFrame
    features: Sequence[str]
    n_classes: int
    max_nodes: int = MAX_NODES

    def _packed(self) -> tuple[list[DataFrame], int, int]:
        """The trees as one row each, in groups that fit a broadcast, the number of levels and of trees."""
        sizes = sorted((r["tree"], r["n"]) for r in self.nodes.groupBy("tree").agg(F.count(F.lit(1)).alias("n")).collect())  # one row per tree
        groups: list[list[int]] = [[]]
        held = 0
        for tree, n in sizes:
            if n > self.max_nodes:
                raise ValueError(f"tree {tree} has {n} nodes, more than {self.max_nodes}")
            if held + n > self.max_nodes:
                groups.append([])
                held = 0
            groups[-1].append(tree)
            held += n
        share = F.aggregate("counts", F.lit(0.0), lambda a, x: a + x)
        votes = F.when(share > 0, F.transform("counts", lambda x: x / share)).otherwise(F.array(*[F.lit(0.0)] * self.n_classes))
        rows = self.nodes.select(
            "tree", F.struct("node", "feature", "threshold", "below", "above", F.coalesce(votes, F.array(*[F.lit(0.0)] * self.n_classes)).alias("votes")).alias("e"))
        trees = rows.groupBy("tree").agg(F.array_sort(F.collect_list("e")).alias("e")).select(
            "tree", *[F.col("e")[c].alias(c) for c in ("feature", "threshold", "below", "above", "votes")])
        trees = store(trees, "trees")
        return [trees.filter(F.col("tree").isin(group)) for group in groups], self._levels(trees), len(sizes)

    @staticmethod
    def _levels(trees: DataFrame) -> int:
        """Longest way from a root to a leaf, level by level in each tree's arrays."""
        @F.pandas_udf("int")
        def levels(below: pd.Series, above: pd.Series) -> pd.Series:
            out = []
            for low, high in zip(below, above):
                reached, n = np.array([0]), -1
                while len(reached):
                    n += 1
                    children = np.concatenate([low[reached], high[reached]])
                    reached = children[children >= 0]
                out.append(n)
            return pd.Series(out, dtype="int32")

        return trees.select(levels("below", "above").alias("n")).agg(F.max("n")).first()[0] or 0

    def leaves(self, df: DataFrame) -> list[DataFrame]:
        """Rows of ``df`` with each tree: tree, node (the leaf reached) and its votes."""
        groups, levels, _ = self._packed()
        return [self._walk(df, trees, levels) for trees in groups]

    def _walk(self, df: DataFrame, trees: DataFrame, levels: int) -> DataFrame:
        values = df.withColumn("_x", F.array(*[F.col(f"`{f}`").cast("double") for f in self.features]))
        names = trees.select("tree").collect()  # one number per tree
        paired = values.withColumn("tree", F.explode(F.array(*[F.lit(r["tree"]) for r in names])))
        walked = paired.join(F.broadcast(trees), "tree").withColumn("node", F.lit(0))
        at = F.col("node")
        for _ in range(levels):
            goes_below = F.get("_x", F.get("feature", at)) <= F.get("threshold", at)
            walked = walked.withColumn("node", F.when(F.get("below", at) < 0, at).when(goes_below, F.get("below", at)).otherwise(F.get("above", at)))
        return walked.select(*[F.col(f"`{c}`") for c in df.columns], "tree", "node", F.get("votes", at).alias("votes"))

    def with_counts(self, train: DataFrame, label: str) -> "NodeForest":
        """The same splits with the class counts of the training rows in their leaves."""
        reached = reduce(DataFrame.unionByName, [part.groupBy("tree", "node", F.col(label).cast("int").alias("label")).agg(
            F.count(F.lit(1)).alias("n")) for part in self.leaves(train.select(*[F.col(f"`{f}`") for f in self.features], label))])
        counted = reached.groupBy("tree", "node").agg(F.array(*[
            F.coalesce(F.sum(F.when(F.col("label") == c, F.col("n"))), F.lit(0)).cast("double") for c in range(self.n_classes)]).alias("found"))
        # stored before the join, whose null test would otherwise unfold the levels into one huge expression
        counted = store(counted, "leaf-counts")
        none = F.when(F.col("below") < 0, F.array(*[F.lit(0.0)] * self.n_classes))
        filled = self.nodes.join(counted, ["tree", "node"], "left").withColumn("counts", F.coalesce("found", none)).drop("found")
        return NodeForest(store(filled, "nodes"), self.features, self.n_classes, self.max_nodes)

    def _shares(self, trees: DataFrame, levels: int, x: Column) -> Column:
        """Summed votes of some trees for an array of features, as an array. The trees are as many as a broadcast takes."""
        n_features, n_classes = len(self.features), self.n_classes
        packed = trees.select("feature", F.transform("threshold", lambda t: F.coalesce(t, F.lit(float("nan")))).alias("threshold"), "below", "above",
                              F.flatten("votes").alias("votes"), "tree").orderBy("tree").toArrow().to_batches()
        arrays = [[batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in range(5)] for batch in packed for i in range(batch.num_rows)]
        held = trees.sparkSession.sparkContext.broadcast([(*tree[:4], tree[4].reshape(len(tree[0]), n_classes)) for tree in arrays])

        @F.arrow_udf("array<double>")
        def sum_votes(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for batch in batches:
                # a null feature compares as not up to the threshold, as NaN does
                values = batch.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(batch), n_features)
                total, rows = np.zeros((len(batch), n_classes)), np.arange(len(batch))
                for feature, threshold, below, above, votes in held.value:
                    at = np.zeros(len(batch), dtype=np.int32)
                    for _ in range(levels):
                        down = np.where(values[rows, feature[at]] <= threshold[at], below[at], above[at])
                        at = np.where(below[at] < 0, at, down)
                    total += votes[at]
                places = np.arange(len(batch) + 1, dtype=np.int32) * n_classes
                yield pa.ListArray.from_arrays(pa.array(places), pa.array(total.ravel()))

        return sum_votes(x)

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``probability`` (an array: the mean of the trees' class shares) and ``prediction`` (the class with
        the highest one, the lowest code on ties), like a fitted model. Rows stay where they are: nothing is shuffled."""
        groups, levels, n_trees = self._packed()
        x = F.array(*[F.col(f"`{f}`").cast("double") for f in self.features])
        summed = reduce(lambda a, b: F.zip_with(a, b, lambda p, q: p + q), [self._shares(trees, levels, x) for trees in groups])
        scored = df.withColumn("probability", F.transform(summed, lambda v: v / n_trees))
        return scored.withColumn("prediction", (F.array_position("probability", F.array_max("probability")) - 1).cast("double"))
