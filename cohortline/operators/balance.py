"""Class balancing of a training set: interpolated oversampling, then removal of
rows whose neighbours disagree."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.functions.text import stable_hash
from cohortline.operators.knn import as_rows, row_neighbours
from cohortline.operators.ranked import dense_index
from cohortline.operators.replicate import replicate
from cohortline.session import pin_small

HASH_RANGE = float(2 ** 32)
#: A class's surplus spread up to a row, in exact decimals: index x need passes 64 bits in large classes.
SPREAD = "cast({} as decimal(19, 0)) * cast(need as decimal(19, 0)) div cast(group_size as decimal(19, 0))"


def synthetic_plan(df: DataFrame, id_col: str, label: str, seed: int = 42) -> DataFrame:
    """(id, label, draws): how many synthetic rows start from each row, so that
    every class reaches exactly the size of the largest. The classes' surpluses
    spread evenly over their rows in hash order."""
    hashed = df.select(F.col(id_col).alias("id"), F.col(label).alias("label"), stable_hash(id_col, seed=seed).alias("h"))
    largest = df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).scalar()
    indexed = dense_index(hashed, ["label"], "h", "id").withColumn("need", largest - F.col("group_size"))
    draws = F.expr(f"{SPREAD.format('row_index + 1')} - {SPREAD.format('row_index')}")
    return indexed.select("id", "label", draws.cast("bigint").alias("draws")).filter("draws > 0")


def smote(df: DataFrame, id_col: str, vec_col: str, label: str, k: int = 5, seed: int = 42,
          probes: int | None = None, search: Callable | None = None) -> DataFrame:
    """Synthetic rows (base_id, draw, nn_id, u, label, vec): base + u (neighbour -
    base), with one of the base row's k nearest rows of its class."""
    small = df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).agg(F.min("n").alias("lo"), F.max("n").alias("hi")).first()
    if small["lo"] is not None and small["lo"] <= k and small["lo"] < small["hi"]:
        raise ValueError(f"smallest class has {small['lo']} rows; {k} neighbours need at least {k + 1}")
    plan = synthetic_plan(df, id_col, label, seed)
    # the majority class needs no neighbours
    raised = df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") < small["hi"]).select(label)
    minority = df.join(pin_small(raised), label)
    rows = as_rows(minority, id_col, vec_col, scope=label)
    around = row_neighbours(rows, k, probes, search=search).select("id", "vec", "neighbours")
    drawn = replicate(plan.join(around, "id"), "draws", "draw")
    picked = drawn.withColumn(
        "nn", F.get("neighbours", F.pmod(stable_hash("id", "draw", seed=seed + 1), F.size("neighbours")).cast("int")))
    placed = picked.select(
        F.col("id").alias("base_id"), "draw", "label", "vec", F.col("nn.id").alias("nn_id"), F.col("nn.dist").alias("dist"),
        (stable_hash("id", "draw", seed=seed + 2) / HASH_RANGE).alias("u"))
    # copies of the base need no lookup: the new row is the base itself
    same = placed.filter("dist = 0").select("base_id", "draw", "nn_id", "u", "label", "vec")
    vectors = rows.select(F.col("id").alias("nn_id"), F.col("vec").alias("nn_vec"))
    moved = placed.filter("dist > 0").join(vectors, "nn_id").select(
        "base_id", "draw", "nn_id", "u", "label",
        F.zip_with("vec", "nn_vec", lambda a, b: a + (b - a) * F.col("u")).alias("vec"))
    return moved.unionByName(same)


def edited_neighbours(df: DataFrame, id_col: str, vec_col: str, label: str, k: int = 3, probes: int | None = None,
                      search: Callable | None = None) -> DataFrame:
    """(id, label, vec) of the rows whose k nearest rows all share their label."""
    around = row_neighbours(as_rows(df, id_col, vec_col, payload=label), k, probes, search=search)
    agree = F.forall("neighbours", lambda e: e["payload"] == F.col("payload"))
    return around.filter(agree).select("id", F.col("payload").alias("label"), "vec")


def balance(df: DataFrame, id_col: str, vec_col: str, label: str, seed: int = 42, probes: int | None = None,
            search: Callable | None = None) -> DataFrame:
    """(id, label, vec): originals plus synthetic rows, edited. Ids are texts. ``search``, for
    instance ``lsh.Projections().search``, replaces the exact neighbour search."""
    made = smote(df, id_col, vec_col, label, seed=seed, probes=probes, search=search)
    old = df.select(F.concat(F.lit("o"), F.col(id_col).cast("string")).alias("id"), F.col(label).alias("label"),
                    F.col(vec_col).cast("array<double>").alias("vec"))
    new = made.select(F.concat_ws("-", F.lit("s"), F.col("base_id").cast("string"), F.col("draw").cast("string")).alias("id"),
                      "label", "vec")
    return edited_neighbours(old.unionByName(new), "id", "vec", "label", probes=probes, search=search)
