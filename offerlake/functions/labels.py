"""Label normalisation: remote work, contract inference."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Remote-work labels (keys compared lower-cased).
REMOTE = {
    "full": "Total",
    "fulltime": "Total",
    "total": "Total",
    "partial": "Partiel",
    "punctual": "Ponctuel",
    "none": "Non",
    "no": "Non",
    "unknown": "Non précisé",
    "": "Non précisé",
}
NOT_SPECIFIED = "Non précisé"


def normalize_remote(v: Column, json_type: Column | None = None) -> Column:
    """Map a remote label; unknown values pass through, null stays null.

    ``json_type`` is the raw JSON type of the value ('BOOLEAN', 'STRING' or a
    numeric type) when known: a JSON ``false`` or a numeric zero is falsy
    (-> null) and ``true`` reads 'True'.
    """
    m = F.create_map(*[x for k, lab in REMOTE.items() for x in (F.lit(k), F.lit(lab))])
    hit = m[F.lower(v)]
    out = F.when(v.isNull(), F.lit(None).cast("string")).otherwise(
        F.coalesce(hit, F.nullif(v, F.lit(""))))
    if json_type is not None:
        is_bool = json_type == "BOOLEAN"
        out = (F.when(is_bool & (F.lower(v) == "true"), F.lit("True"))
               .when(is_bool, F.lit(None).cast("string"))
               .when((json_type != "STRING") & (v.try_cast("double") == 0), F.lit(None).cast("string"))
               .otherwise(out))
    return out


def infer_contract(job_types: Column) -> Column:
    """'Stage' when any job type mentions 'stage', else 'Non précisé'."""
    joined = F.lower(F.array_join(F.coalesce(job_types, F.array().cast("array<string>")), "|"))
    return F.when(joined.contains("stage"), F.lit("Stage")).otherwise(F.lit(NOT_SPECIFIED))


# Experience buckets, first matching pattern wins.
EXP_RULES = (
    ("Junior (< 3 ans)", "less|moins|_6m|6_month|0_|debut|intern"),
    ("Junior (< 3 ans)", "1_to_2|2_to_3|1_2|2_3|one_to|two_to|under_3"),
    ("Confirmé (3-5 ans)", "3_to_5|3_4|3_5|three_to|four"),
    ("Senior (5+ ans)", "5_|7_|10|more|senior|plus|expert"),
)


def experience_bucket(v: Column) -> Column:
    low = F.lower(v)
    out = F.when(v.isNull(), F.lit(NOT_SPECIFIED))
    for label, pat in EXP_RULES:
        out = out.when(low.rlike(pat), F.lit(label))
    return out.otherwise(F.lit("Autre"))
