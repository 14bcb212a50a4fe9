"""The patient-table instance of the layer chain and of the monitored features.
Everything in this module is a fixed value of the data contract."""

from __future__ import annotations

from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from cohortline.functions.text import LabelRule
from cohortline.operators.checks import ColumnCheck
from cohortline.plans.layers import LayerConfig

# Laboratory measures, as in the normalised source.
LAB_COLUMNS = (
    "age", "sickness_duration_months", "rbc_count", "hemoglobin", "hematocrit", "mcv", "mch", "mchc", "rdw",
    "reticulocyte_count", "wbc_count", "neutrophils", "lymphocytes", "monocytes", "eosinophils", "basophils",
    "plt_count", "mpv", "esbach", "mbl_level", "esr", "c3", "c4",
)

# Names the model knows the same measures by, in the same order.
MODEL_FEATURES = (
    "Age", "Sickness_Duration_Months", "RBC_Count", "Hemoglobin", "Hematocrit", "MCV", "MCH", "MCHC", "RDW",
    "Reticulocyte_Count", "WBC_Count", "Neutrophils", "Lymphocytes", "Monocytes", "Eosinophils", "Basophils",
    "PLT_Count", "MPV", "Esbach", "MBL_Level", "ESR", "C3", "C4",
)

# The ten symptom flags.
SYMPTOM_FLAGS = (
    "low_grade_fever", "fatigue_or_chronic_tiredness", "dizziness", "weight_loss", "rashes_and_skin_lesions",
    "stiffness_in_the_joints", "brittle_hair_or_hair_loss", "dry_eyes_and_or_mouth", "general_unwell_feeling",
    "joint_pain",
)

# Staged columns in source order, without load metadata.
SOURCE_COLUMNS = (
    "patient_id", "age", "gender", "diagnosis", "sickness_duration_months", "rbc_count", "hemoglobin", "hematocrit",
    "mcv", "mch", "mchc", "rdw", "reticulocyte_count", "wbc_count", "neutrophils", "lymphocytes", "monocytes",
    "eosinophils", "basophils", "plt_count", "mpv", "ana", "esbach", "mbl_level", "esr", "c3", "c4", "crp",
    "anti_ds_dna", "anti_sm", "rheumatoid_factor", "acpa", "anti_tpo", "anti_tg", "anti_sma", "low_grade_fever",
    "fatigue_or_chronic_tiredness", "dizziness", "weight_loss", "rashes_and_skin_lesions",
    "stiffness_in_the_joints", "brittle_hair_or_hair_loss", "dry_eyes_and_or_mouth", "general_unwell_feeling",
    "joint_pain", "anti_enterocyte_antibodies", "anti_lkm1", "anti_rnp", "asca", "anti_ro_ssa", "anti_c_bir1",
    "anti_bp230", "anti_t_tg", "dgp", "anti_bp180", "asma", "anti_if", "ig_g_ig_e_receptor", "anti_srp",
    "anti_desmoglein_3", "anti_la_ssb", "anti_jo1", "anca", "anti_centromere", "anti_desmoglein_1", "ema",
    "anti_type_vii_collagen", "c1_inhibitor", "anti_tif1", "anti_epidermal_basement_membrane_ig_a", "anti_omp_c",
    "p_anca", "anti_tissue_transglutaminase", "anti_scl_70", "anti_mi2", "anti_parietal_cell",
    "progesterone_antibodies",
)

# Columns that hold one value in every record.
CONSTANT_COLUMNS = ("anti_t_tg", "progesterone_antibodies")

# Columns frozen out for |correlation| above 0.85.
CORRELATED_COLUMNS = (
    "anti_sm", "anti_ro_ssa", "anti_c_bir1", "anti_bp180", "asma", "anti_la_ssb", "anti_jo1", "anca",
    "anti_desmoglein_1", "ema", "anti_tif1", "anti_omp_c", "anti_scl_70", "anti_mi2", "anti_parietal_cell",
)

# Diagnosis vocabulary and the bucket of everything else.
DIAGNOSIS_RULES = (
    LabelRule("Normal", "normal", case_sensitive=True),
    LabelRule("Systemic lupus erythematosus (SLE)", "systemic_lupus_erythematosus"),
    LabelRule("Sjögren syndrome", "sjogren_syndrome"),
    LabelRule("Graves' disease", "graves_disease"),
    LabelRule("Rheumatoid arthritis", "rheumatoid_arthritis"),
    LabelRule("Autoimmune orchitis", "autoimmune_orchitis"),
)
OTHER_DIAGNOSIS = "other_autoimmune_disease"

# Encoder codes (alphabetical).
GENDER_CODES = {"female": 0, "male": 1}
DIAGNOSIS_CODES = {
    "autoimmune_orchitis": 0, "graves_disease": 1, "normal": 2, "rheumatoid_arthritis": 3, "sjogren_syndrome": 4,
    "systemic_lupus_erythematosus": 5,
}

# Columns of the duplicate fingerprint.
FINGERPRINT_COLUMNS = ("age", "gender", "diagnosis", "sickness_duration_months", "rbc_count", "hemoglobin", "hematocrit",
                       "wbc_count", "plt_count", "esr", "crp")

# Source columns that are whole numbers and text; the rest are doubles.
TEXT_COLUMNS = ("gender", "diagnosis")
WHOLE_COLUMNS = (
    "patient_id", "age", "sickness_duration_months", "ana", "anti_ds_dna", "anti_sm", "low_grade_fever",
    "fatigue_or_chronic_tiredness", "dizziness", "weight_loss", "rashes_and_skin_lesions",
    "stiffness_in_the_joints", "brittle_hair_or_hair_loss", "dry_eyes_and_or_mouth", "general_unwell_feeling",
    "joint_pain", "anti_enterocyte_antibodies", "anti_lkm1", "anti_rnp", "asca", "anti_ro_ssa", "anti_c_bir1",
    "anti_bp230", "anti_t_tg", "dgp", "anti_bp180", "asma", "anti_if", "ig_g_ig_e_receptor", "anti_srp",
    "anti_desmoglein_3", "anti_la_ssb", "anti_jo1", "anca", "anti_centromere", "anti_desmoglein_1", "ema",
    "anti_type_vii_collagen", "c1_inhibitor", "anti_tif1", "anti_epidermal_basement_membrane_ig_a", "anti_omp_c",
    "p_anca", "anti_tissue_transglutaminase", "anti_scl_70", "anti_mi2", "anti_parietal_cell",
    "progesterone_antibodies",
)

# Scoring inputs with a default, beside the 23 required measures.
OPTIONAL_INPUTS = (
    "crp", "clinical_symptoms_count", "ana", "rheumatoid_factor", "acpa", "anti_tpo", "anti_tg", "anti_sma",
    "low_grade_fever", "dizziness", "rashes_and_skin_lesions", "stiffness_in_the_joints",
    "brittle_hair_or_hair_loss", "general_unwell_feeling", "gender",
)

# Bounds the entry form accepts, in model-feature order.
INPUT_BOUNDS = {
    "Age": (0, 120), "Sickness_Duration_Months": (0, 120), "RBC_Count": (0, 10), "Hemoglobin": (0, 2000),
    "Hematocrit": (0, 60), "MCV": (0, 15000), "MCH": (0, 5000), "MCHC": (0, 5000),
    "RDW": (0, 5000), "Reticulocyte_Count": (0, 5000), "WBC_Count": (0, 1000000), "Neutrophils": (0, 10000),
    "Lymphocytes": (0, 10000), "Monocytes": (0, 5000), "Eosinophils": (0, 5000), "Basophils": (0, 5000),
    "PLT_Count": (0, 10000000), "MPV": (0, 5000), "Esbach": (0, 50000), "MBL_Level": (0, 5000),
    "ESR": (0, 15000), "C3": (0, 50000), "C4": (0, 5000),
}


def source_type(column: str):
    if column in TEXT_COLUMNS:
        return StringType()
    return LongType() if column in WHOLE_COLUMNS else DoubleType()


def source_schema() -> StructType:
    return StructType([StructField(c, source_type(c)) for c in SOURCE_COLUMNS])


def model_schema() -> StructType:
    """Contract of the model table: measures, remaining columns in source order,
    the symptom count, encoded gender and diagnosis."""
    gone = {"patient_id", "gender", "diagnosis", *LAB_COLUMNS, *CONSTANT_COLUMNS, *CORRELATED_COLUMNS}
    fields = [StructField(m, source_type(s)) for s, m in zip(LAB_COLUMNS, MODEL_FEATURES)]
    fields += [StructField(c, source_type(c)) for c in SOURCE_COLUMNS if c not in gone]
    fields += [StructField("clinical_symptoms_count", LongType()), StructField("gender", IntegerType()),
               StructField("diagnosis", IntegerType())]
    return StructType(fields)


def _not_null(*columns: str) -> tuple[ColumnCheck, ...]:
    return tuple(ColumnCheck("not_null", c) for c in columns)


PATIENTS = LayerConfig(
    source_columns=SOURCE_COLUMNS,
    folded_text=("gender",),
    label_column="diagnosis",
    label_rules=DIAGNOSIS_RULES,
    label_default=OTHER_DIAGNOSIS,
    constant_columns=CONSTANT_COLUMNS,
    log_columns=("c4",),
    correlated_columns=CORRELATED_COLUMNS,
    flag_columns=SYMPTOM_FLAGS,
    flag_sum_column="clinical_symptoms_count",
    id_columns=("patient_id",),
    encoders={"gender": GENDER_CODES, "diagnosis": DIAGNOSIS_CODES},
    renames=tuple(zip(LAB_COLUMNS, MODEL_FEATURES)),
    contract=model_schema(),
    layer_checks={
        "staged": _not_null("patient_id", "gender", "diagnosis") + (
            ColumnCheck("accepted_values", "gender", tuple(GENDER_CODES)),
            ColumnCheck("accepted_values", "diagnosis", tuple(r.target for r in DIAGNOSIS_RULES) + (OTHER_DIAGNOSIS,)),
        ),
        "cleaned": _not_null("patient_id", "c4"),
        "features": _not_null("patient_id", "clinical_symptoms_count"),
        "model": _not_null("Age", "Sickness_Duration_Months", "RBC_Count", "Hemoglobin", "Hematocrit", "WBC_Count", "ESR",
                           "clinical_symptoms_count", "gender", "diagnosis") + (
            ColumnCheck("accepted_values", "gender", tuple(GENDER_CODES.values())),
            ColumnCheck("accepted_values", "diagnosis", tuple(DIAGNOSIS_CODES.values())),
        ),
    },
    fingerprint_columns=FINGERPRINT_COLUMNS,
    duplicate_band=(0.40, 0.60),
    id_band=("patient_id", 500, 800),
)
