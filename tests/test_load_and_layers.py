import math
import re

import pytest
from patient_rows import frame, row
from pyspark.sql import functions as F

from cohortline.functions.names import plan_names, snake_case
from cohortline.operators import checks as C
from cohortline.operators import columns as K
from cohortline.plans import layers as L
from cohortline.plans import patients as P
from cohortline.sources import records, reports


def test_snake_case_reproduces_every_documented_pair():
    import os
    text = open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "FIXTURES.md"), encoding="utf-8").read()
    pairs = re.findall(r"^\| \d+ \| ([^|]+?) \| `(\w+)` \| (?:BIGINT|DOUBLE|VARCHAR) \| ", text, re.M)
    pairs = [(h, n) for h, n in pairs if not h.startswith("- ")]
    assert len(pairs) == 77
    assert [n for h, n in pairs if snake_case(h) != n] == []


def test_name_collisions_keep_the_plain_identifier():
    plan = plan_names(["Anti-Sm", "Anti_Sm", "Age"])
    assert plan.kept == (("Anti_Sm", "anti_sm"), ("Age", "age"))
    assert plan.lost == (("Anti-Sm", "anti_sm"),)
    with pytest.raises(ValueError):
        plan_names(["Anti-Sm", "Anti_Sm"], keep="error")
    with pytest.raises(ValueError):
        plan_names(["a b", "a-b"])


def test_csv_load_types_nulls_and_collisions(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('Patient_ID,Anti-Sm,Anti_Sm,MCV,Diagnosis,Gap\n1,9,0,75.5,"Graves\' disease",3\n2,9,1,NA,"a, ""b""",\n', encoding="utf-8")
    result = records.load_csv(spark, str(path), load_id="l1")
    assert result.status == "loaded" and result.lost_columns == (("Anti-Sm", "anti_sm"),)
    types = dict(result.data.dtypes)
    assert types == {"patient_id": "bigint", "anti_sm": "bigint", "mcv": "double", "diagnosis": "string", "gap": "double",
                     "_load_id": "string", "_row_id": "string"}
    rows = result.data.orderBy("patient_id").collect()
    assert [r["anti_sm"] for r in rows] == [0, 1] and rows[1]["mcv"] is None and rows[1]["diagnosis"] == 'a, "b"'
    assert rows[0]["_load_id"] == "l1" and rows[0]["_row_id"] != rows[1]["_row_id"]


def test_csv_with_schema_and_line_breaks(spark, tmp_path):
    path = tmp_path / "typed.csv"
    path.write_text('a,b,c\n1,NA,"two\nlines"\n,2.5,x\n', encoding="utf-8")
    rows = records.read_csv(spark, str(path), "a bigint, b double, c string", multi_line=True).collect()
    assert [tuple(r) for r in rows] == [(1, None, "two\nlines"), (None, 2.5, "x")]


def test_missing_and_empty_files_keep_the_old_table(spark, tmp_path):
    good = tmp_path / "good.csv"
    good.write_text("a\n1\n2\n")
    assert records.replace_table(records.load_csv(spark, str(good)), "raw_area.numbers")
    empty = tmp_path / "empty.csv"
    empty.write_text("a\n")
    assert records.load_csv(spark, str(tmp_path / "none.csv")).status == "missing"
    assert records.load_csv(spark, str(empty)).status == "empty"
    assert not records.replace_table(records.load_csv(spark, str(empty)), "raw_area.numbers")
    assert records.read_table(spark, "raw_area.numbers").count() == 2


def test_csv_sink_and_encoder_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    records.write_csv(df, str(tmp_path / "out"))
    assert spark.read.csv(str(tmp_path / "out"), header=True).collect() == [("1", "x")]
    reports.save_encoder(P.DIAGNOSIS_CODES, spark, str(tmp_path / "codes"))
    assert reports.load_encoder(spark, str(tmp_path / "codes")) == P.DIAGNOSIS_CODES
    (tmp_path / "object.json").write_text('{"0": "female", "1": "male"}')
    assert reports.load_encoder(spark, str(tmp_path / "object.json")) == P.GENDER_CODES
    with pytest.raises(reports.ReferenceMissing):
        reports.load_reference(spark, str(tmp_path / "nothing"))


LABELS = [
    ("Normal", "normal"), ("normal", P.OTHER_DIAGNOSIS), ("NORMAL", P.OTHER_DIAGNOSIS), (" Normal ", "normal"),
    ("SJÖGREN SYNDROME", "sjogren_syndrome"), ("Graves' Disease", "graves_disease"), ("rheumatoid arthritis", "rheumatoid_arthritis"),
    ("  autoimmune orchitis", "autoimmune_orchitis"), ("systemic LUPUS erythematosus (sle)", "systemic_lupus_erythematosus"),
    (None, P.OTHER_DIAGNOSIS), ("Lupus", P.OTHER_DIAGNOSIS),
]


def test_patient_layers(spark):
    rows = [row(i, diagnosis=raw, gender=g) for i, ((raw, _), g) in enumerate(zip(LABELS, ["  Female ", "MALE"] * 6))]
    rows[3].update(c4=0.0, low_grade_fever=None)
    rows[4].update(c4=math.e - 1)
    raw = frame(spark, rows)
    layers = L.layer_chain(raw, P.PATIENTS)
    assert [len(layers[n].columns) for n in ("staged", "cleaned", "features", "model")] == [77, 60, 61, 60]
    staged = layers["staged"].orderBy("patient_id").collect()
    assert [r["diagnosis"] for r in staged] == [label for _, label in LABELS]
    assert {r["gender"] for r in staged} == {"female", "male"} and layers["staged"].columns[-1] == "diagnosis"
    features = layers["features"].orderBy("patient_id").collect()
    assert features[3]["clinical_symptoms_count"] is None and features[3]["c4"] == 0.0
    assert features[4]["c4"] == pytest.approx(1.0)
    assert features[0]["clinical_symptoms_count"] == sum(rows[0][f] for f in P.SYMPTOM_FLAGS)
    model = layers["model"]
    assert model.schema == P.model_schema() or C.schema_differences(model, P.model_schema()) == []
    got = model.collect()
    assert {r["diagnosis"] for r in got} == {0, 1, 2, 3, 4, 5, None} and {r["gender"] for r in got} == {0, 1}
    unmapped = C.unmapped_labels(L.staged_with_raw_label(raw, P.PATIENTS), "diagnosis_raw", "diagnosis", P.OTHER_DIAGNOSIS)
    assert {(r["raw_label"], r["row_count"]) for r in unmapped.collect()} == {("normal", 1), ("NORMAL", 1), (None, 1), ("Lupus", 1)}


def good_rows(n=1200):
    # half of the rows are copies, 600 ids
    return [row(i % 600, diagnosis=["Normal", "Graves' disease"][i % 2]) for i in range(n)]


def test_checks_pass_and_block(spark):
    raw = frame(spark, good_rows())
    results = L.check_layers(raw, L.layer_chain(raw, P.PATIENTS), P.PATIENTS)
    assert results.count() == 21 + 4
    assert [r for r in results.collect() if not r["passed"]] == []
    assert C.enforce(results) == []
    assert L.materialise(raw, P.PATIENTS, mart_database="good_marts") == []
    assert spark.table("good_marts.model").count() == 1200 and spark.table("staged").count() == 1200

    bad = good_rows()
    bad[0].update(diagnosis="unknown", esr=None, gender="x")
    broken = frame(spark, bad)
    with pytest.raises(C.CheckFailed) as failure:
        L.materialise(broken, P.PATIENTS, mart_database="bad_marts")
    text = str(failure.value)
    for part in ("staged.diagnosis unmapped_labels", "model.ESR not_null", "model.diagnosis not_null", "staged.gender accepted_values"):
        assert part in text
    assert not spark.catalog.databaseExists("bad_marts") or not spark.catalog.tableExists("bad_marts.model")


def test_duplicate_band_only_warns(spark):
    raw = frame(spark, [row(i, diagnosis="Normal") for i in range(600)])
    warnings = C.enforce(L.check_layers(raw, L.layer_chain(raw, P.PATIENTS), P.PATIENTS))
    assert warnings == ["staged.* duplicate_rate"]


def test_one_pass_checks_equal_per_layer_checks(spark):
    raw = frame(spark, [row(i, diagnosis=d) for i, d in enumerate(["Normal", "odd", None])])
    chain = L.layer_chain(raw, P.PATIENTS)
    once = {tuple(r) for r in L._column_checks(raw, P.PATIENTS).collect()}
    apart = {tuple(r) for name, specs in P.PATIENTS.layer_checks.items() for r in C.run_column_checks(chain[name], name, specs).collect()}
    assert once == apart


def test_schema_contract_finds_every_kind_of_change(spark):
    base = spark.createDataFrame([(1, 2.0, "x")], "a bigint, b double, c string")
    want = base.schema
    assert C.schema_differences(base, want) == []
    assert [d.problem for d in C.schema_differences(base.drop("b"), want)] == ["missing"]
    assert [d.problem for d in C.schema_differences(base.withColumnRenamed("a", "z"), want)] == ["missing", "extra"]
    assert [d.problem for d in C.schema_differences(base.withColumn("a", F.col("a").cast("int")), want)] == ["type"]
    assert {d.problem for d in C.schema_differences(base.select("b", "a", "c"), want)} == {"order"}
    with pytest.raises(C.CheckFailed):
        C.enforce_schema(base.drop("c"), want)


def test_columns_fail_loudly(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    for call in (lambda: K.project(df, ["a", "q"]), lambda: K.star_exclude(df, ["q"]), lambda: K.replace_at_end(df, {"q": F.lit(1)})):
        with pytest.raises(ValueError):
            call()
    assert K.replace_at_end(df, {"a": F.col("a") + 1}).columns == ["b", "a"]
    assert K.rename_first(df, [("b", "B2")]).columns == ["B2", "a"]


def test_row_loss_and_empty_duplicate_rate(spark):
    df = spark.range(10)
    counts = C.layer_counts({"raw": df, "a": df, "b": df.filter("id < 9")})
    assert [tuple(r) for r in C.row_loss(counts, "raw").collect()] == [("b", 9)]
    empty = C.duplicate_rate(df.filter("id < 0"), ["id"])
    assert empty.first()["duplicate_rate"] is None and C.outside_band(empty, "duplicate_rate", 0.4, 0.6).count() == 0


def test_csv_columns_are_found_by_name(spark, tmp_path):
    path = tmp_path / "reordered.csv"
    path.write_text("b,a\nx,1\n,2\n", encoding="utf-8")
    assert [tuple(r) for r in records.read_csv(spark, str(path), "a bigint, b string").collect()] == [(1, "x"), (2, None)]
    for schema in ("a bigint", "a bigint, b string, c int"):
        with pytest.raises(ValueError):
            records.read_csv(spark, str(path), schema)
