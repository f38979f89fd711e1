"""Gold: staging view, validity filter, dimensions, fact and marts.

The fact is written once and read back, so the thirteen marts and the
checks all start from the stored table instead of recomputing the chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlake.functions import labels, salary
from offerlake.operators import aggregates as agg
from offerlake.operators import keys, quality
from offerlake.operators.star import attach_keys
from offerlake.schemas import EXP_BUCKETS, SOURCES
from offerlake.session import passing_scratch

# Fixed values.
MART_NAMES = (
    "mart_completude", "mart_kpis", "mart_par_contrat", "mart_par_departement", "mart_par_experience",
    "mart_par_metier", "mart_par_remote", "mart_salaire_par_contrat", "mart_salaire_par_metier",
    "mart_tension", "mart_timeseries", "mart_top_competences", "mart_top_villes",
)


def staging(silver: DataFrame) -> DataFrame:
    """Silver + exp_bucket + sal_mid_eur, without run_date / ingested_at."""
    cols = [c for c in silver.columns if c not in ("run_date", "ingested_at")]
    out = silver.select(*cols)
    out = out.withColumn("exp_bucket", labels.experience_bucket(F.col("experience")))
    out = out.withColumn("sal_mid_eur", salary.midpoint(F.col("sal_min_eur"), F.col("sal_max_eur"),
                                                        F.col("has_salary")))
    order = cols[:cols.index("experience") + 1] + ["exp_bucket"] + \
        cols[cols.index("experience") + 1:cols.index("sal_max_eur") + 1] + ["sal_mid_eur"] + \
        cols[cols.index("sal_max_eur") + 1:]
    return out.select(*order)


def valid(stg: DataFrame) -> DataFrame:
    """Feed B without twins, feed A with status 200."""
    return stg.where(((F.col("source") == "Indeed") & ~F.col("is_twin"))
                     | ((F.col("source") == "WTTJ") & (F.col("status") == 200)))


def dimensions(v: DataFrame) -> dict[str, DataFrame]:
    """The eight dimensions, keys numbered in natural-key order."""
    day = F.when(F.col("date_is_precise") & F.col("posted_date").isNotNull(), F.col("posted_date").cast("date"))
    sk = keys.surrogate_key
    dims = {
        "dim_contrat": sk(v, "contract", "contrat_key"),
        "dim_remote": sk(v, "remote", "remote_key"),
        "dim_metier": sk(v, "profession", "metier_key"),
        "dim_entreprise": sk(v, "company", "entreprise_key"),
        "dim_experience": sk(v, "exp_bucket", "exp_key"),
        "dim_education": sk(v, "education", "edu_key"),
    }
    places = (v.where(F.col("city").isNotNull()).groupBy("city")
               .agg(F.any_value("departement", True).alias("departement"), F.bool_or("is_idf").alias("is_idf")))
    dims["dim_lieu"] = (sk(places, "city", "lieu_key").join(places, "city")
                        .select("lieu_key", "city", "departement", "is_idf"))
    days = v.select(day.alias("jour")).where(F.col("jour").isNotNull())
    dims["dim_date"] = sk(days, "jour", "date_key").select(
        "date_key", "jour", F.date_format("jour", "yyyy-MM").alias("mois"), F.year("jour").cast("bigint").alias("annee"))
    return dims


def fact(v: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    return attach_keys(v, [
        (dims["dim_contrat"], "contract", "contrat_key"),
        (dims["dim_remote"], "remote", "remote_key"),
        (dims["dim_metier"], "profession", "metier_key"),
        (dims["dim_lieu"], "city", "lieu_key"),
        (dims["dim_entreprise"], "company", "entreprise_key"),
        (dims["dim_experience"], "exp_bucket", "exp_key"),
        (dims["dim_education"], "education", "edu_key"),
    ], row_id="offer_id")


# Label and condition of each completeness row.
COMPLETENESS = (
    ("Salaire", "has_salary"),
    ("Expérience", "experience IS NOT NULL"),
    ("Diplôme", "education IS NOT NULL"),
    ("Ville", "city IS NOT NULL"),
    ("Métier (profession.fr)", "profession IS NOT NULL"),
    ("Télétravail", "remote IS NOT NULL"),
    ("Date précise", "date_is_precise"),
)


def kpis(fct: DataFrame, stg: DataFrame, *, approx_distinct: bool = False) -> DataFrame:
    """The KPI card: one pass over the fact, one count over staging.

    Distinct companies and cities are exact by default; ``approx_distinct``
    uses HyperLogLog++ (about 1 % error) to avoid the distinct expansion.
    """
    distinct = F.approx_count_distinct if approx_distinct else F.count_distinct
    n = F.count(F.lit(1))
    sal = F.count_if("has_salary")
    card = fct.agg(
        n.alias("n_offres"),
        F.count_if(F.col("source") == "WTTJ").alias("n_wttj"),
        F.count_if(F.col("source") == "Indeed").alias("n_indeed"),
        sal.alias("n_salaire"),
        agg.pct(sal, n).alias("pct_salaire"),
        distinct("company").alias("n_entreprises"),
        distinct("city").alias("n_villes"),
        F.count_if("is_idf").alias("n_idf"),
    )
    # Salaries lie in a fixed band: one (value, frequency) row each before they meet.
    freq = fct.where("has_salary").groupBy("sal_mid_eur").agg(n.alias("f"))
    box = freq.agg(*[F.round(F.percentile("sal_mid_eur", p, F.col("f")), 0).alias(name)
                     for name, p in (("salaire_median", 0.5), ("salaire_q1", 0.25), ("salaire_q3", 0.75))])
    twins = stg.agg(F.count_if((F.col("source") == "Indeed") & F.col("is_twin")).alias("n_twins_dedup"))
    return agg.side_by_side(card, box, twins).select(
        "n_offres", "n_wttj", "n_indeed", "n_twins_dedup", "n_salaire", "pct_salaire", "n_entreprises",
        "n_villes", "n_idf", "salaire_median", "salaire_q1", "salaire_q3")


def marts(fct: DataFrame, stg: DataFrame) -> dict[str, DataFrame]:
    with_sal = fct.where(F.col("has_salary"))
    month = F.when(F.col("date_is_precise"), F.date_format(F.col("posted_date").cast("date"), "yyyy-MM"))
    # Every count mart from one scan of the fact.
    counts = agg.grouped_counts(fct.withColumn("mois", month), {
        "contrat": ["contract"], "departement": ["departement"], "experience": ["exp_bucket"], "metier": ["profession"],
        "remote": ["remote"], "tension": ["profession", "departement"], "mois": ["mois"]})
    return {
        "mart_completude": agg.completeness(fct, [(n, F.expr(c)) for n, c in COMPLETENESS]),
        "mart_kpis": kpis(fct, stg),
        "mart_par_contrat": agg.ranked(counts["contrat"], contract="contrat"),
        "mart_par_departement": agg.ranked(counts["departement"]),
        "mart_par_experience": agg.ranked(counts["experience"]),
        "mart_par_metier": agg.ranked(counts["metier"].where("profession is not null"), profession="metier"),
        "mart_par_remote": agg.ranked(counts["remote"].where("remote is not null")),
        "mart_salaire_par_contrat": agg.distribution(with_sal, "contract", "sal_mid_eur", min_n=5,
                                                     out_key="contrat", bounded_domain=True),
        "mart_salaire_par_metier": agg.distribution(with_sal.where(F.col("profession").isNotNull()),
                                                    "profession", "sal_mid_eur", min_n=8, extremes=False,
                                                    out_key="metier", bounded_domain=True),
        "mart_tension": (counts["tension"].where("profession is not null")
                         .where(~F.col("departement").isin("Non précisé", "Hors référentiel")).withColumnRenamed("profession", "metier")),
        "mart_timeseries": counts["mois"].where("mois is not null").orderBy("mois"),
        "mart_top_competences": agg.top_k(
            fct.select(F.explode("skills").alias("competence")).where(F.col("competence").isNotNull()),
            "competence", 30),
        "mart_top_villes": agg.top_k(fct.where(F.col("city").isNotNull()), "city", 20,
                                     extra=[F.any_value("departement", True).alias("departement")])
                              .withColumnRenamed("city", "ville").select("ville", "departement", "n"),
    }


# The full-corpus reference counts (checked only on full data).
REFERENCE_COUNTS = {
    "wttj_total": 2171, "wttj_status_200": 2164, "cdi": 1417, "stage": 336, "alternance": 326,
    "paris": 1216, "indeed_total": 5752, "salper_rempli": 789, "url_doublons": 0,
}


def reference_counts(stg: DataFrame, expected: dict[str, int] | None = None) -> DataFrame:
    """Mismatching (verif, obtenu, attendu) rows of the frozen counts."""
    e = expected or REFERENCE_COUNTS
    a = F.col("source") == "WTTJ"
    checks = [
        ("wttj_total", a), ("wttj_status_200", a & (F.col("status") == 200)),
        ("cdi", a & (F.col("contract") == "CDI")), ("stage", a & (F.col("contract") == "Stage")),
        ("alternance", a & (F.col("contract") == "Alternance")), ("paris", a & (F.col("city") == "Paris")),
        ("indeed_total", F.col("source") == "Indeed"),
        ("salper_rempli", a & F.col("sal_source_period").isNotNull() & (F.col("sal_source_period") != "")),
    ]
    counts = agg.frozen_counts(stg, [(n, c, e[n]) for n, c in checks])
    dup = (stg.where(F.col("url").isNotNull())
              .agg((F.count(F.lit(1)) - F.count_distinct("url")).alias("obtenu"))
              .select(F.lit("url_doublons").alias("verif"), "obtenu",
                      F.lit(e["url_doublons"]).cast("bigint").alias("attendu"))
              .where(F.col("obtenu") != F.col("attendu")))
    return counts.unionByName(dup)


def checks(stg: DataFrame, v: DataFrame, fct: DataFrame, dims: dict[str, DataFrame],
           marts_: dict[str, DataFrame], expected: dict[str, int] | None = None) -> list[quality.Check]:
    """The schema tests of the models and the frozen-count test."""
    Q = quality
    out = [
        Q.Check("stg_offres.offer_id.not_null", lambda: Q.not_null(stg, "offer_id")),
        Q.Check("stg_offres.offer_id.unique", lambda: Q.unique(stg, "offer_id")),
        Q.Check("stg_offres.source.not_null", lambda: Q.not_null(stg, "source")),
        Q.Check("stg_offres.source.accepted_values", lambda: Q.accepted_values(stg, "source", SOURCES)),
        Q.Check("stg_offres.contract.not_null", lambda: Q.not_null(stg, "contract")),
        Q.Check("stg_offres.departement.not_null", lambda: Q.not_null(stg, "departement")),
        Q.Check("stg_offres.exp_bucket.not_null", lambda: Q.not_null(stg, "exp_bucket")),
        Q.Check("stg_offres.exp_bucket.accepted_values",
                lambda: Q.accepted_values(stg, "exp_bucket", EXP_BUCKETS)),
        Q.Check("int_offres_valides.offer_id.not_null", lambda: Q.not_null(v, "offer_id")),
        Q.Check("int_offres_valides.offer_id.unique", lambda: Q.unique(v, "offer_id")),
        Q.Check("fct_offres.offer_id.not_null", lambda: Q.not_null(fct, "offer_id")),
        Q.Check("fct_offres.offer_id.unique", lambda: Q.unique(fct, "offer_id")),
    ]
    for fk, dim in (("contrat_key", "dim_contrat"), ("remote_key", "dim_remote"), ("metier_key", "dim_metier"),
                    ("lieu_key", "dim_lieu"), ("entreprise_key", "dim_entreprise")):
        out.append(Q.Check(f"fct_offres.{fk}.relationships",
                           lambda fk=fk, dim=dim: Q.relationships(fct, fk, dims[dim], fk)))
    for dim, cols in (("dim_contrat", ("contrat_key", "contract")), ("dim_lieu", ("lieu_key", "city")),
                      ("dim_metier", ("metier_key", "profession"))):
        for c in cols:
            out.append(Q.Check(f"{dim}.{c}.not_null", lambda dim=dim, c=c: Q.not_null(dims[dim], c)))
            out.append(Q.Check(f"{dim}.{c}.unique", lambda dim=dim, c=c: Q.unique(dims[dim], c)))
    m = marts_["mart_salaire_par_contrat"]
    out.append(Q.Check("mart_salaire_par_contrat.contrat.not_null", lambda: Q.not_null(m, "contrat")))
    out.append(Q.Check("mart_salaire_par_contrat.contrat.unique", lambda: Q.unique(m, "contrat")))
    out.append(Q.Check("assert_reference_counts", lambda: reference_counts(stg, expected), tags=("fullonly",)))
    return out


# The data contract of the published fact.
FACT_CONTRACT = [
    {"field": "offer_id", "type": "string", "nullable": False, "unique": True},
    {"field": "source", "type": "string", "nullable": False, "enum": list(SOURCES)},
    {"field": "url", "type": "string", "nullable": True},
    {"field": "title", "type": "string", "nullable": True},
    {"field": "company", "type": "string", "nullable": True},
    {"field": "city", "type": "string", "nullable": True},
    {"field": "departement", "type": "string", "nullable": False},
    {"field": "is_idf", "type": "boolean", "nullable": False},
    {"field": "profession", "type": "string", "nullable": True},
    {"field": "contract", "type": "string", "nullable": False,
     "enum": ["CDI", "CDD", "Stage", "Alternance", "Freelance", "VIE", "Non précisé"]},
    {"field": "exp_bucket", "type": "string", "nullable": False, "enum": list(EXP_BUCKETS)},
    {"field": "education", "type": "string", "nullable": True},
    {"field": "remote", "type": "string", "nullable": True,
     "enum": ["Total", "Partiel", "Ponctuel", "Non", "Non précisé"]},
    {"field": "sal_min_eur", "type": "integer", "nullable": True, "max_of": "sal_max_eur"},
    {"field": "sal_max_eur", "type": "integer", "nullable": True},
    {"field": "sal_mid_eur", "type": "double", "nullable": True},
    {"field": "has_salary", "type": "boolean", "nullable": False},
    {"field": "posted_date", "type": "string", "nullable": True},
    {"field": "date_is_precise", "type": "boolean", "nullable": False},
    {"field": "skills", "type": "list<string>", "nullable": False},
]


def build(spark: SparkSession, silver: DataFrame, warehouse: str) -> dict[str, DataFrame]:
    """Build every gold table into ``warehouse`` and return them (read back)."""
    stg = staging(silver)
    v = valid(stg)
    with passing_scratch(spark):
        dims = dimensions(v)
        for name, d in dims.items():
            d.write.mode("overwrite").parquet(f"{warehouse}/{name}")
        dims = {n: spark.read.parquet(f"{warehouse}/{n}") for n in dims}
        fact(v, dims).write.mode("overwrite").parquet(f"{warehouse}/fct_offres")
        fct = spark.read.parquet(f"{warehouse}/fct_offres")
        built = marts(fct, stg)
        for name, m in built.items():
            m.write.mode("overwrite").parquet(f"{warehouse}/{name}")
    tables = {n: spark.read.parquet(f"{warehouse}/{n}") for n in built}
    tables.update(dims)
    tables["fct_offres"] = fct
    tables["stg_offres"] = stg
    tables["int_offres_valides"] = v
    return tables
