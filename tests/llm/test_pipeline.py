"""The pipeline against the same stages in plain Python."""

import brute
from test_tokens import assert_packed, ids_by_tokenizer

import __spark_entry__ as entry
import corpus_pipeline as pipeline


def test_pipeline_equals_its_stages(spark, sf_dir, bpe):
    read = spark.read.parquet
    docs = {r["doc_id"]: r["text"] for r in read(f"{sf_dir}/documents.parquet").collect()}
    toxic = {r["doc_id"] for r in entry.queries()["op5_toxicity"](spark, sf_dir).collect() if r["toxic"]}
    left = [(i, t) for i, t in docs.items() if i not in toxic]
    exact = brute.exact_duplicates(left)
    left = [(i, t) for i, t in left if exact[i][2]]
    near = brute.near_duplicates(left)
    left = [(i, t) for i, t in left if near[i][2]]
    items = [(r["item_id"], r["text"]) for r in read(f"{sf_dir}/benchmark.parquet").collect()]
    leaked = {i for i, _ in brute.overlaps(left, items)}
    left = [(i, t) for i, t in left if i not in leaked]
    rows = entry.queries()["pipeline"](spark, sf_dir).collect()
    assert {r["doc_id"] for r in rows} == {i for i, _ in left}
    assert_packed(rows, {i: found + [0] for (i, _), found in zip(left, ids_by_tokenizer(bpe, [t for _, t in left]))})


def test_stages_keep_columns_and_odd_rows(spark, sf_dir, documents, odd_rows):
    docs = documents(odd_rows)
    for name, stage in pipeline.STAGES[:-1]:
        kept = stage(spark, docs, sf_dir)
        assert kept.columns == docs.columns and kept.schema == docs.schema, name
        assert stage(spark, docs.where("false"), sf_dir).collect() == [], name
    ids = sorted(str(r["doc_id"]) for r in pipeline.drop_exact_copies(spark, docs, sf_dir).collect())
    # of the blank texts the longest, of the two rows with id 9 one
    assert ids == sorted(["3", "4", "5", "6", "7", "8", "9", "10", "None", "11", "12", "13", "14"])
    assert [name for name, _ in pipeline.STAGES] == ["toxicity", "exact dedup", "near dedup", "decontamination", "packing"]


def test_rows_are_decided_by_their_texts(spark, sf_dir, documents):
    """Rows without an id go as others do, and one bad text of an id does not take its other rows along."""
    toxic = {r["doc_id"] for r in entry.queries()["op5_toxicity"](spark, sf_dir).collect() if r["toxic"]}
    real = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    bad, passage = real[min(toxic)], spark.read.parquet(f"{sf_dir}/benchmark.parquet").first()["text"]
    clean = "plain words about rivers and boats that nobody minds at all in here"
    rows = [(None, bad), (70_001, bad), (70_001, clean), (None, clean + " again"), (None, None)]
    docs = documents(rows)
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source").limit(0)
    full = docs.unionByName(table, allowMissingColumns=True).unionByName(
        spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), allowMissingColumns=True)
    kept = {(r["doc_id"], r["text"]) for r in pipeline.drop_toxic(spark, full, sf_dir).where("doc_id is null or doc_id > 70000").collect()}
    assert kept == {(70_001, clean), (None, clean + " again"), (None, None)}
    leaks = documents([(None, f"before {passage} after"), (1, f"before {passage} after"), (1, clean), (None, clean)])
    assert {(r["doc_id"], r["text"]) for r in pipeline.drop_leaks(spark, leaks, sf_dir).collect()} == {(1, clean), (None, clean)}
    long = " ".join(f"w{i}" for i in range(60))
    near = documents([(9, long), (4, long + " x"), (None, long + " y"), (4, clean), (None, clean + " with another ending of several more words")])
    assert {(r["doc_id"], r["text"]) for r in pipeline.drop_near_copies(spark, near, sf_dir).collect()} == {
        (4, long + " x"), (4, clean), (None, clean + " with another ending of several more words")}


def test_columns_may_have_the_names_used_inside(spark, sf_dir):
    """Columns of the documents that are called what the stages call theirs, and one with a dot."""
    names = ["key", "_key", "sha256", "length", "KEPT", "component_id", "n_chars", "text_sha256", "toxic", "first", "no_id", "a.b"]
    long = " ".join(f"w{i}" for i in range(60))
    passage = spark.read.parquet(f"{sf_dir}/benchmark.parquet").first()["text"]
    texts = [long, long, long + " x", None, "plain words of no other text", f"before {passage} after"]
    docs = spark.createDataFrame([(i, t, *([str(i)] * len(names))) for i, t in enumerate(texts)], ["doc_id", "text", *names])
    # near dedup lets rows that share a text stay together
    left = {"toxicity": {0, 1, 2, 3, 4, 5}, "exact dedup": {0, 2, 3, 4, 5}, "near dedup": {0, 1, 3, 4, 5}, "decontamination": {0, 1, 2, 3, 4}}
    for name, stage in pipeline.STAGES[:-1]:
        kept = stage(spark, docs, sf_dir)
        assert kept.schema == docs.schema, name
        rows = kept.collect()
        assert {r["doc_id"] for r in rows} == left[name], name
        assert all(set(r[2:]) == {str(r["doc_id"])} for r in rows), name
    assert {r["doc_id"] for r in pipeline.pack(spark, docs, sf_dir).collect()} == set(range(6))
