"""Schemas and the two small dimension tables (relation labels, entity types)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. They must equal the reference's for results to agree.
# Relation labels, in label-id order (id 0 is "no_relation").
LABELS = [
    "no_relation", "org:top_members/employees", "org:members",
    "org:product", "per:title", "org:alternate_names",
    "per:employee_of", "org:place_of_headquarters", "per:product",
    "org:number_of_employees/members", "per:children",
    "per:place_of_residence", "per:alternate_names",
    "per:other_family", "per:colleagues", "per:origin", "per:siblings",
    "per:spouse", "org:founded", "org:political/religious_affiliation",
    "org:member_of", "per:parents", "org:dissolved",
    "per:schools_attended", "per:date_of_death", "per:date_of_birth",
    "per:place_of_birth", "per:place_of_death", "org:founded_by",
    "per:religion",
]
# Entity type code -> marker name, and marker name -> type id (1..6).
ENTITY_TYPES = {
    "PER": "사람",
    "ORG": "조직",
    "DAT": "날짜",
    "LOC": "장소",
    "POH": "단어",
    "NOH": "숫자",
}
TYPE_IDS = {"사람": 1, "조직": 2, "날짜": 3, "장소": 4, "단어": 5, "숫자": 6}
# Punctuation inserted by the AEDA augmentation.
PUNCTUATIONS = [".", ",", "!", "?", ";", ":"]
# ---------------------------------------------------------------------------

RAW_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("sentence", T.StringType()),
    T.StructField("subject_entity", T.StringType()),
    T.StructField("object_entity", T.StringType()),
    T.StructField("label", T.StringType()),
    T.StructField("source", T.StringType()),
])

ENTITY_STRUCT = T.StructType([
    T.StructField("word", T.StringType()),
    T.StructField("start_idx", T.IntegerType()),
    T.StructField("end_idx", T.IntegerType()),
    T.StructField("type", T.StringType()),
])

MARKED_COLUMNS = [
    "id", "sentence", "subject_entity", "object_entity", "subject_type",
    "object_type", "label", "subject_idx", "object_idx",
]


def label_dim(spark: SparkSession) -> DataFrame:
    """S04: the 30-row label dimension ``(label_id INT, label STRING)``."""
    return spark.createDataFrame(
        list(enumerate(LABELS)),
        T.StructType([T.StructField("label_id", T.IntegerType(), False),
                      T.StructField("label", T.StringType(), False)]),
    )


def type_name_map():
    """Map expression code -> marker name (used by ``try_element_at``)."""
    return F.create_map(*[F.lit(x) for kv in ENTITY_TYPES.items() for x in kv])


def type_id_map():
    return F.create_map(*[F.lit(x) for kv in TYPE_IDS.items() for x in kv])
