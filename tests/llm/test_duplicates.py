"""Near and exact duplicates against brute force."""

import random

import brute
import numpy as np
from pyspark.sql import functions as F

import __spark_entry__ as entry
from cohortline.llm import exactdup, neardup


def test_near_duplicates_of_documents(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = entry.queries()["op2_near_duplicates"](spark, sf_dir).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} == brute.near_duplicates(docs)


def test_chains_hot_groups_and_shared_passages(documents):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for n in range(150):  # near copies of one text
        words = list(base)
        words[rng.randrange(120)] = f"n{n}"
        rows.append((1000 + n, " ".join(words)))
    chain = [f"c{i}" for i in range(200)]
    for n in range(25):  # each links only to its neighbours
        rows.append((3000 + n, " ".join(chain[8 * n:8 * n + 8] and [f"c{i}" for i in range(8 * n, 8 * n + 100)])))
    passage = " ".join(f"p{i}" for i in range(60))
    rows += [(5000 + n, passage + " " + " ".join(f"u{n}x{i}" for i in range(rng.randrange(10, 60)))) for n in range(120)]
    rows += [(7000 + n, "just the same words every time around") for n in range(300)]
    rng.shuffle(rows)
    got = neardup.near_duplicates(documents(rows)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} == brute.near_duplicates(rows)


def test_near_duplicates_of_odd_rows(documents, odd_rows):
    got = neardup.near_duplicates(documents(odd_rows)).collect()
    assert len(got) == len(odd_rows)
    by_id = {r["doc_id"]: r for r in got}
    assert (by_id[1]["n_shingles"], by_id[1]["component_id"], by_id[1]["kept"]) == (0, 1, True)
    assert by_id[4]["component_id"] == by_id[5]["component_id"] == 4
    assert by_id[6]["component_id"] == by_id[7]["component_id"] == 6
    assert by_id[9]["component_id"] == by_id[10]["component_id"] == 9 and not by_id[10]["kept"]
    assert by_id[None]["component_id"] is None and by_id[None]["kept"]
    assert by_id[14]["component_id"] == 13
    assert neardup.near_duplicates(documents([])).collect() == []
    # an id with two texts ties both their groups together
    tied = neardup.near_duplicates(documents([(1, "a b c d e"), (2, "a b c d e"), (3, "q r s t u"), (2, "q r s t u")])).collect()
    assert {r["component_id"] for r in tied} == {1}


def test_sketches_estimate_high_similarities():
    rng = np.random.default_rng(2)
    for share in (0.75, 0.85, 0.95):
        both, n = rng.integers(0, 1 << 63, 2_000, dtype=np.uint64), 2_000
        own = int(n * (1 - share) / (1 + share))
        left = np.concatenate([both[own:], rng.integers(0, 1 << 63, own, dtype=np.uint64)])
        bits = [np.frombuffer(neardup.odd_sketch(neardup.minhash(x)), np.uint64) for x in (both, left)]
        different = int(np.bitwise_count(bits[0] ^ bits[1]).sum())
        assert abs(neardup.estimate(different) - share) < 0.13 and different <= neardup.most_different_bits()


def test_blocks_compare_every_pair_of_components(spark, documents):
    text = " ".join(f"w{i}" for i in range(60))
    docs = documents([(n, text) for n in range(40)])
    signed = neardup.signatures(docs.select("doc_id", "text"))
    nodes = signed.select(F.col("doc_id").alias("node"), "n_shingles", "sketch", "bands")
    key = nodes.first()["bands"][0]
    rows = nodes.select(F.lit(key).alias("key"), "node", (F.col("node") % 3).alias("component"), F.lit(40).cast("long").alias("size"))
    want = {(a, b) for a in range(40) for b in range(a + 1, 40) if a % 3 != b % 3}
    for block in (512, 7):
        assert {tuple(r) for r in neardup._links_across(rows, nodes, docs.select("doc_id", "text"), 75, block).collect()} == want
        near = {tuple(r) for r in neardup._proposals(rows, nodes, 75, 3, block).collect()}
        assert near <= want and {n for pair in near for n in pair} == set(range(40))
    # a pair counts in the bucket of its first common band only
    other = rows.withColumn("key", F.lit(nodes.first()["bands"][1]))
    assert neardup._links_across(other, nodes, docs.select("doc_id", "text"), 75).collect() == []


def test_components_of_long_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(200, 200 + i) for i in range(1, 50)] + [(500, 400), (400, 300), (7, 7)]
    found = {r["node"]: r["component"] for r in neardup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {found.get(i, i) for i in range(61)} == {0} and {found.get(200 + i, 200 + i) for i in range(50)} == {200}
    assert found[500] == found[400] == 300 and not {0, 200, 300} & set(found)


def _rows(df):
    return {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in df.collect()}


def test_exact_duplicates_of_documents(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert _rows(entry.queries()["op4_exact_duplicates"](spark, sf_dir)) == brute.exact_duplicates(docs)


def test_collisions_are_chained_and_buckets_split(documents):
    rng = random.Random(4)
    rows = [(n, " ".join(rng.choice("abc") for _ in range(rng.randrange(6)))) for n in range(400)]
    want = brute.exact_duplicates(rows)
    for key, keys in (("xxhash64(body)", 2), ("pmod(crc32(body), 3)", 1), ("0", 64)):
        assert _rows(exactdup.exact_duplicates(documents(rows), key=key, range_bits=2, bucket_keys=keys)) == want
    held = exactdup.KeyRange(0, 2)
    for key in (0, 1 << 61, 1 << 62, 1 << 63, 3 << 62, 7 << 61):
        held.insert(key, b"%d" % key, "", (key, 1), 1)
    assert held.depth == 2 and [b.depth for b in held.directory] == [2, 2, 2, 2]
    assert sorted(key for _, _, key, _, _ in held.entries()) == [0, 1 << 61, 1 << 62, 1 << 63, 3 << 62, 7 << 61]
    assert all(len(b.keys) <= 2 for b in held.directory)


def test_exact_duplicates_of_odd_rows(documents, odd_rows):
    got = exactdup.exact_duplicates(documents(odd_rows)).collect()
    assert len(got) == len(odd_rows)
    by_id = {r["doc_id"]: r for r in got}
    assert {by_id[i]["keep_id"] for i in (1, 2, 3)} == {3} and by_id[3]["group_size"] == 3  # the blank text is the longest
    assert by_id[9]["keep_id"] == 9 and by_id[9]["group_size"] == 2 and by_id[9]["kept"] and by_id[10]["kept"]
    assert by_id[None]["kept"] and by_id[None]["keep_id"] is None
    assert exactdup.exact_duplicates(documents([])).collect() == []
