"""Silver: conform both feeds into one typed offer table, plus salary rejects.

Each feed is one projection over its landed rows; the two are concatenated
by name.  The twin flag is a left join against the distinct twin URLs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from offerlake.functions import dates, geo, labels, salary, skills, text
from offerlake.operators.aggregates import side_by_side
from offerlake.operators.quality import contract_rules, contract_violations
from offerlake.operators.star import spread_null_key
from offerlake.schemas import FEED_A_RECORD, FEED_B_RECORD, OPTIONAL_TEXT_COLUMNS, SILVER, SILVER_COLUMNS
from offerlake.session import materialize
from offerlake.sources.feeds import require, twin_urls


def _remote(o: str = "o") -> Column:
    """Normalised remote label from the VARIANT-typed field: its text plus its
    raw JSON type ('BOOLEAN' or 'STRING'), from the same parse."""
    v = F.col(f"{o}.remote")
    return labels.normalize_remote(v.cast("string"), F.expr(f"schema_of_variant({o}.remote)"))


def _finish(df: DataFrame, run_date: str) -> DataFrame:
    """Blank optional text -> null, bound repair, constants, column order and types."""
    for c in OPTIONAL_TEXT_COLUMNS:
        df = df.withColumn(c, text.blank_to_null(F.col(c)))
    rep = salary.repair_bounds(F.col("sal_min_eur"), F.col("sal_max_eur"))
    df = (df.withColumn("__rep", rep)
            .withColumn("sal_min_eur", F.col("__rep.lo"))
            .withColumn("sal_max_eur", F.col("__rep.hi"))
            .withColumn("has_salary", F.col("__rep.has_salary"))
            .withColumn("run_date", F.lit(run_date))
            .withColumn("ingested_at", F.lit(f"{run_date}T00:00:00Z")))
    return df.select(*[F.col(f.name) if f.name == "skills" else F.col(f.name).cast(f.dataType).alias(f.name)
                       for f in SILVER.fields])


# Record fields that are text (or null) in each feed.
TEXT_A = ("url", "applyUrl", "name", "city", "contract", "exp", "edu", "salPer", "salCur", "date")
TEXT_B = ("jk", "url", "title", "company", "city", "loc", "date", "salary", "snippet", "kw")


def typed_records(rows: DataFrame, texts: tuple[str, ...], whole: tuple[str, ...] = ()) -> DataFrame:
    """``rows``, whose job stops at a record that is not an object or whose fields have
    another type: ``texts`` are strings or null, ``whole`` integers (or their text) or null."""

    def typed(v: Column) -> Column:
        ok = F.col("raw").rlike(r"^\s*\{")
        for f in texts:
            kind = F.schema_of_variant(F.try_variant_get(v, f"$.{f}", "variant"))
            ok = ok & F.coalesce(kind.isin("STRING", "VOID"), F.lit(True))
        for f in whole:
            ok = ok & F.coalesce(F.try_variant_get(v, f"$.{f}", "string").rlike(r"^\s*[+-]?\d+(\.0*)?\s*$"), F.lit(True))
        return ok

    ok = salary.let(F.try_parse_json("raw"), typed)      # a record is parsed once for all its fields
    return require(rows, "raw", ok, "record of another type")


def conform_a(rows: DataFrame, run_date: str) -> DataFrame:
    """Feed A (structured) -> silver columns."""
    rows = typed_records(rows, TEXT_A, ("status",))
    r = rows.select("pos", "raw", F.from_json("raw", FEED_A_RECORD).alias("o"))
    o = lambda c: F.col(f"o.{c}")
    ann = salary.annualize(salary.to_number(o("salMin")), salary.to_number(o("salMax")),
                           o("salPer"), o("salCur"))
    posted = dates.absolute_date(o("date"))
    # Columns of their own: bindings are not shared between the expressions that read them.
    df = r.withColumn("__ann", ann).withColumn("__folded", skills.fold(o("name"))).select(
        F.concat(F.lit("WTTJ_"), F.col("pos").cast("string")).alias("offer_id"),
        F.lit("WTTJ").alias("source"),
        o("url").alias("url"),
        o("applyUrl").alias("apply_url"),
        o("name").alias("title"),
        text.url_segment(o("url")).alias("company"),
        o("city").alias("city"),
        F.col("o.profession.fr").alias("profession"),
        F.lit(None).cast("string").alias("kw"),
        text.falsy_default(o("contract"), labels.NOT_SPECIFIED).alias("contract"),
        o("exp").alias("experience"),
        o("edu").alias("education"),
        _remote().alias("remote"),
        F.col("__ann.lo").alias("sal_min_eur"),
        F.col("__ann.hi").alias("sal_max_eur"),
        o("salPer").alias("sal_source_period"),
        posted["date"].alias("posted_date"),
        posted["precise"].alias("date_is_precise"),
        o("status").try_cast("double").cast("int").alias("status"),
        F.lit(False).alias("is_twin"),
        skills.found("__folded").alias("skills"),
    )
    df = geo.with_departement(df, "city")
    return _finish(df, run_date)


def conform_b(rows: DataFrame, twins: DataFrame, run_date: str) -> tuple[DataFrame, DataFrame]:
    """Feed B (free text) -> (silver columns, salary rejects).

    Both come from one pass over the records, whose conformed columns (no longer the raw
    text) are written once."""
    rows = typed_records(rows, TEXT_B)
    r = rows.select("pos", "raw", F.from_json("raw", FEED_B_RECORD).alias("o"))
    o = lambda c: F.col(f"o.{c}")
    offer_id = F.concat(F.lit("IND_"), text.falsy_default(o("jk"), F.col("pos").cast("string")))
    r = r.withColumn("offer_id", offer_id).withColumn("sal", salary.salary_from_text(o("salary")))
    posted = dates.relative_date(o("date"), run_date)
    kw_text = F.concat_ws(" ", F.coalesce(o("title"), F.lit("")), F.coalesce(o("snippet"), F.lit("")),
                          F.coalesce(o("kw"), F.lit("")))
    tw = twins.select(F.col("url").alias("__twin_url")).distinct().withColumn("__twin", F.lit(True))
    df = r.withColumn("__folded", skills.fold(kw_text)).select(
        "offer_id",
        F.lit("Indeed").alias("source"),
        o("url").alias("url"),
        o("url").alias("apply_url"),
        o("title").alias("title"),
        o("company").alias("company"),
        text.falsy_default(o("city"), o("loc")).alias("city"),
        F.lit(None).cast("string").alias("profession"),
        o("kw").alias("kw"),
        labels.infer_contract(o("jobTypes")).alias("contract"),
        F.lit(None).cast("string").alias("experience"),
        F.lit(None).cast("string").alias("education"),
        _remote().alias("remote"),
        F.col("sal.lo").alias("sal_min_eur"),
        F.col("sal.hi").alias("sal_max_eur"),
        F.col("sal.parsed.period").alias("sal_source_period"),
        posted["date"].alias("posted_date"),
        posted["precise"].alias("date_is_precise"),
        F.lit(200).alias("status"),
        skills.found("__folded").alias("skills"),
        o("salary").alias("salary_raw"),
        F.col("sal.reason").alias("reason"),
    )
    df = materialize(df, "silver-feed-b")
    rejects = df.where(F.col("reason").isNotNull()).select("offer_id", "salary_raw", "reason", F.lit(run_date).alias("run_date"))
    df = df.drop("salary_raw", "reason")
    # Offers without a URL cannot be twins; their join key is spread per row
    # so they do not all land in one partition of a shuffled join.
    url_key = spread_null_key(F.when(F.col("url") != "", F.col("url")), F.col("offer_id"))
    df = df.join(tw, url_key == F.col("__twin_url"), "left")
    df = df.withColumn("is_twin", F.col("url").isNotNull() & (F.col("url") != "")
                       & F.coalesce(F.col("__twin"), F.lit(False)))
    df = geo.with_departement(df, "city")
    return _finish(df, run_date), rejects


def build(rows_a: DataFrame, rows_b: DataFrame, twin_rows: DataFrame,
          run_date: str) -> tuple[DataFrame, DataFrame]:
    a = conform_a(rows_a, run_date)
    b, rejects = conform_b(rows_b, twin_urls(twin_rows), run_date)
    return a.unionByName(b).select(*SILVER_COLUMNS), rejects


def _counts() -> list:
    return [F.count(F.lit(1)).alias("n_total"), F.count_if(F.col("source") == "WTTJ").alias("n_wttj"),
            F.count_if(F.col("source") == "Indeed").alias("n_indeed"), F.count_if("is_twin").alias("n_twins_indeed"),
            F.count_if("has_salary").alias("n_salary")]


def stats(silver: DataFrame, rejects: DataFrame, run_date: str) -> DataFrame:
    """One-row run statistics.  Both inputs are reduced to one row each and
    put side by side.  The percentage is rounded half-even,
    as the statistics file of the reference is written by Python."""
    n = F.count(F.lit(1))
    sal = F.count_if("has_salary")
    s = silver.agg(
        F.lit(run_date).alias("run_date"), *_counts(),
        F.coalesce(F.bround(F.try_divide(F.lit(100.0) * sal, n.cast("double")), 1), F.lit(0.0))
         .alias("pct_salary"),
    )
    r = rejects.agg(F.count(F.lit(1)).alias("n_rejects_salaire"))
    return side_by_side(s, r)


# The silver row contract (required fields, source enum).
SILVER_CONTRACT = [
    {"field": "offer_id", "type": "string", "nullable": False},
    {"field": "source", "type": "string", "nullable": False, "enum": ["WTTJ", "Indeed"]},
    {"field": "departement", "type": "string", "nullable": False},
    {"field": "is_idf", "type": "boolean", "nullable": False},
    {"field": "contract", "type": "string", "nullable": False},
    {"field": "sal_min_eur", "type": "integer", "nullable": True, "max_of": "sal_max_eur"},
    {"field": "sal_max_eur", "type": "integer", "nullable": True},
    {"field": "has_salary", "type": "boolean", "nullable": False},
    {"field": "date_is_precise", "type": "boolean", "nullable": False},
    {"field": "status", "type": "integer", "nullable": True},
    {"field": "is_twin", "type": "boolean", "nullable": False},
    {"field": "skills", "type": "list<string>", "nullable": False},
    {"field": "run_date", "type": "string", "nullable": False},
    {"field": "ingested_at", "type": "string", "nullable": False},
]


class InvalidRowsError(ValueError):
    pass


class Audited:
    """Offers and rejects whose statistics and rule violations are counted while they are
    written: observed metrics, which a retried task does not count twice."""

    def __init__(self, offers: DataFrame, rejects: DataFrame):
        self._schema, rules, _ = contract_rules(offers, SILVER_CONTRACT)
        self._rules = {f"bad{i}": (rule, field) for i, (rule, field, _) in enumerate(rules)}
        self._offers, self._rejects = Observation(), Observation()
        bad = [F.count_if(F.coalesce(test, F.lit(False))).alias(f"bad{i}") for i, (_, _, test) in enumerate(rules)]
        self.offers = offers.observe(self._offers, *_counts(), *bad)
        self.rejects = rejects.observe(self._rejects, F.count(F.lit(1)).alias("n_rejects_salaire"))

    def stats(self, run_date: str) -> dict:
        """The run's statistics, once both tables are written; raises if a row breaks a rule."""
        seen = self._offers.get
        found = self._schema + [(*self._rules[k], n) for k, n in seen.items() if k in self._rules and n]
        if found:
            raise InvalidRowsError("; ".join(f"{rule}:{field}={n}" for rule, field, n in found))
        counts = {k: seen.get(k, 0) for k in ("n_total", "n_wttj", "n_indeed", "n_twins_indeed", "n_salary")}
        share = round(100.0 * counts["n_salary"] / counts["n_total"], 1) if counts["n_total"] else 0.0
        return {"run_date": run_date, **counts, "pct_salary": share, "n_rejects_salaire": self._rejects.get.get("n_rejects_salaire", 0)}


def validate(silver: DataFrame, *, strict: bool = True) -> DataFrame:
    """Row validation of silver (one scan).  Returns the violations; with
    ``strict`` any violation aborts the run, as row validation does in the
    reference."""
    v = contract_violations(silver, SILVER_CONTRACT)
    if strict:
        bad = v.collect()          # at most a few rows: one per rule and field
        if bad:
            raise InvalidRowsError("; ".join(f"{r.rule}:{r.field}={r.violations}" for r in bad))
    return v
