"""The query catalogue: every operator applied to the shared test tables.

The test tables are not job offers, so each operator runs as the generic
function it is, on a table with the right shape.  Where an operator expects
offer-like text (salaries, dates, labels), the text is built from the rows'
own columns, identically in the Spark plan and in the SQL oracle, and the
operator then parses it.  Every query reads whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlake.functions import dates, geo, labels, salary, skills, text
from offerlake.operators import aggregates as agg
from offerlake.operators import keys, quality, search, similarity
from offerlake.operators.quantiles import exact_quantiles
from offerlake.operators.star import attach_keys
from offerlake.plans import sqltext as S
from offerlake.session import table_path

RUN_DATE = "2026-06-10"


def tbl(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf, name))


# ---------------------------------------------------------------- aggregates

def box_plot_by_segment(spark, sf):
    o = tbl(spark, sf, "orders").select("o_custkey", "o_totalprice")
    c = tbl(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    j = o.join(c, o.o_custkey == c.c_custkey, "left")
    return agg.distribution(j, "c_mktsegment", "o_totalprice", min_n=5, out_key="segment")


def box_plot_min_n(spark, sf):
    li = tbl(spark, sf, "lineitem")
    return agg.distribution(li, "l_returnflag", "l_extendedprice", min_n=8, extremes=False,
                            out_key="grp")


def kpi_card(spark, sf):
    o = tbl(spark, sf, "orders")
    c = tbl(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    j = o.join(c, o.o_custkey == c.c_custkey, "left")
    valid = F.col("o_orderstatus") != "P"
    urgent = valid & (F.col("o_orderpriority") == "1-URGENT")
    n_valid = F.count_if(valid)
    card = j.agg(
        n_valid.alias("n_offres"),
        F.count_if(F.col("o_orderstatus") == "F").alias("n_f"),
        F.count_if(F.col("o_orderstatus") == "O").alias("n_o"),
        F.count_if(F.col("o_orderstatus") == "P").alias("n_excluded"),
        F.count_if(urgent).alias("n_urgent"),
        agg.pct(F.count_if(urgent), n_valid).alias("pct_urgent"),
        F.count_distinct(F.when(valid, F.col("o_custkey"))).alias("n_clients"),
        F.count_distinct(F.when(valid, F.col("c_mktsegment"))).alias("n_segments"),
        F.count_if(valid & (F.col("c_mktsegment") == "BUILDING")).alias("n_building"),
    )
    # Global quantiles without funnelling every distinct price into one task.
    q = exact_quantiles(o.where(urgent), [], "o_totalprice",
                        {"prix_median": 0.5, "prix_q1": 0.25, "prix_q3": 0.75})
    q = q.select(*[F.round(c, 0).alias(c) for c in ("prix_median", "prix_q1", "prix_q3")])
    return agg.side_by_side(card, q)


def _docs_labels(spark, sf):
    d = tbl(spark, sf, "documents").select("doc_id", "text", "lang", "n_chars")
    lab = tbl(spark, sf, "labels")
    return d.join(lab, "doc_id", "left")


COMPLETENESS_FIELDS = (
    ("Texte", "text IS NOT NULL"),
    ("Langue", "lang IS NOT NULL"),
    ("Qualité", "quality IS NOT NULL"),
    ("Toxicité", "toxic IS NOT NULL"),
    ("Qualité positive", "quality = 1"),
    ("Toxique", "toxic = 1"),
    ("Texte long", "n_chars >= 1000"),
)


def completeness_scorecard(spark, sf):
    return agg.completeness(_docs_labels(spark, sf), [(n, F.expr(c)) for n, c in COMPLETENESS_FIELDS])


def count_by_key(spark, sf):
    return agg.count_by(tbl(spark, sf, "customer"), "c_mktsegment")


def count_by_key_nonnull(spark, sf):
    return agg.count_by(_docs_labels(spark, sf), "quality", non_null=["quality"])


def tension_matrix(spark, sf):
    o = tbl(spark, sf, "orders").select("o_custkey", "o_orderpriority")
    c = tbl(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    j = o.join(c, o.o_custkey == c.c_custkey, "left")
    return agg.count_by(j, ["c_mktsegment", "o_orderpriority"], non_null=["c_mktsegment"],
                        exclude={"o_orderpriority": ["4-NOT SPECIFIED", "5-LOW"]},
                        rename={"c_mktsegment": "segment", "o_orderpriority": "priority"}, order=False)


def month_series(spark, sf):
    o = tbl(spark, sf, "orders").where(F.col("o_orderdate").isNotNull())
    return (o.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("mois"))
             .agg(F.count(F.lit(1)).alias("n")).orderBy("mois"))


def top_terms(spark, sf):
    d = tbl(spark, sf, "documents")
    terms = d.select(F.explode(text.title_tokens(F.col("text"))).alias("term"))
    return agg.top_k(terms, "term", 30)


def top_skills(spark, sf):
    d = tbl(spark, sf, "documents")
    s = d.select(F.explode(skills.extract_skills(F.col("text"))).alias("competence"))
    return agg.top_k(s.where(F.col("competence").isNotNull()), "competence", 30)


def top_k_cities_like(spark, sf):
    c = tbl(spark, sf, "customer").select("c_nationkey")
    n = tbl(spark, sf, "nation")
    j = c.join(n, c.c_nationkey == n.n_nationkey, "left").where(F.col("n_name").isNotNull())
    out = agg.top_k(j, "n_name", 20, extra=[F.any_value("n_regionkey", True).alias("region")])
    return out.withColumnRenamed("n_name", "ville")


def any_value_bool_or(spark, sf):
    c = tbl(spark, sf, "customer").select("c_nationkey", "c_acctbal")
    n = tbl(spark, sf, "nation").select("n_nationkey", "n_name")
    j = c.join(n, c.c_nationkey == n.n_nationkey, "left").where(F.col("c_nationkey").isNotNull())
    g = j.groupBy("c_nationkey").agg(F.any_value("n_name", True).alias("n_name"),
                                     F.bool_or(F.col("c_acctbal") < 0).alias("has_negative"))
    k = keys.surrogate_key(g, "c_nationkey", "lieu_key")
    return k.join(g, "c_nationkey").select("lieu_key", "c_nationkey", "n_name", "has_negative")


def distinct_dim_key(spark, sf):
    return keys.surrogate_key(tbl(spark, sf, "part"), "p_brand", "brand_key")


def date_dim(spark, sf):
    o = tbl(spark, sf, "orders").select(F.to_date("o_orderdate").alias("jour"))
    k = keys.surrogate_key(o, "jour", "date_key")
    return k.select("date_key", "jour", F.date_format("jour", "yyyy-MM").alias("mois"),
                    F.year("jour").cast("bigint").alias("annee"))


def star_fact(spark, sf):
    li = tbl(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                          "l_extendedprice")
    part = tbl(spark, sf, "part").select("p_partkey", "p_brand", "p_type")
    supp = (tbl(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
            .join(tbl(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("s_nation")),
                  F.col("s_nationkey") == F.col("n_nationkey"), "left"))
    fact = (li.join(part, li.l_partkey == part.p_partkey, "left")
              .join(supp, li.l_suppkey == supp.s_suppkey, "left"))
    dims = [
        (keys.surrogate_key(part, "p_brand", "brand_key"), "p_brand", "brand_key"),
        (keys.surrogate_key(part, "p_type", "type_key"), "p_type", "type_key"),
        (keys.surrogate_key(supp, "s_nation", "nation_key"), "s_nation", "nation_key"),
    ]
    fact = fact.withColumn("__row", F.struct("l_orderkey", "l_linenumber"))
    return attach_keys(fact, dims, row_id="__row").select("l_orderkey", "l_linenumber", "l_extendedprice",
                                          "brand_key", "type_key", "nation_key")


# ------------------------------------------------------------------- quality

def fk_violations(spark, sf):
    o = tbl(spark, sf, "orders").select("o_orderkey", "o_custkey")
    c = tbl(spark, sf, "customer").where(F.col("c_mktsegment") != "BUILDING")
    return quality.relationships(o, "o_custkey", c, "c_custkey")


EVENT_TYPES_ACCEPTED = ["view", "click", "purchase", "signup"]
RETURN_FLAGS = ["A", "N", "R"]


def not_null_unique_accepted(spark, sf):
    ev = tbl(spark, sf, "events")
    li = tbl(spark, sf, "lineitem")
    ev_rules = quality.column_rules(ev, [
        ("not_null", "events.event_id", F.col("event_id").isNull()),
        ("not_null", "events.user_id", F.col("user_id").isNull()),
        ("accepted_values", "events.event_type",
         F.col("event_type").isNotNull() & ~F.col("event_type").isin(EVENT_TYPES_ACCEPTED)),
    ])
    li_rules = quality.column_rules(li, [
        ("accepted_values", "lineitem.l_returnflag",
         F.col("l_returnflag").isNotNull() & ~F.col("l_returnflag").isin(RETURN_FLAGS)),
    ])
    uniq = [
        quality.unique(ev, "event_id").agg(F.count(F.lit(1)).alias("violations"))
        .select(F.lit("unique").alias("rule"), F.lit("events.event_id").alias("field"), "violations"),
        quality.unique(li, ["l_orderkey", "l_linenumber"]).agg(F.count(F.lit(1)).alias("violations"))
        .select(F.lit("unique").alias("rule"), F.lit("lineitem.l_orderkey,l_linenumber").alias("field"),
                "violations"),
    ]
    out = ev_rules.unionByName(li_rules)
    for u in uniq:
        out = out.unionByName(u)
    return out


# Frozen expectations: the counts of the sf0.1 tables.
ORDER_EXPECTED = {"orders_total": 150000, "orders_f": 49710, "orders_o": 50101,
                  "orders_urgent": 30076, "orders_high": 29910, "orders_expensive": 59934,
                  "orderkey_duplicates": 0}
LINE_EXPECTED = {"lineitem_total": 600000, "lineitem_returned": 200025}


def reference_count_checks(spark, sf):
    o = tbl(spark, sf, "orders")
    li = tbl(spark, sf, "lineitem")
    oc = [
        ("orders_total", F.lit(True)),
        ("orders_f", F.col("o_orderstatus") == "F"),
        ("orders_o", F.col("o_orderstatus") == "O"),
        ("orders_urgent", F.col("o_orderpriority") == "1-URGENT"),
        ("orders_high", F.col("o_orderpriority") == "2-HIGH"),
        ("orders_expensive", F.col("o_totalprice") > 300000),
    ]
    a = agg.frozen_counts(o, [(n, c, ORDER_EXPECTED[n]) for n, c in oc])
    dup = (o.where(F.col("o_orderkey").isNotNull())
            .agg((F.count(F.lit(1)) - F.count_distinct("o_orderkey")).alias("obtenu"))
            .select(F.lit("orderkey_duplicates").alias("verif"), "obtenu",
                    F.lit(ORDER_EXPECTED["orderkey_duplicates"]).cast("bigint").alias("attendu"))
            .where(F.col("obtenu") != F.col("attendu")))
    lc = [("lineitem_total", F.lit(True)), ("lineitem_returned", F.col("l_returnflag") == "R")]
    b = agg.frozen_counts(li, [(n, c, LINE_EXPECTED[n]) for n, c in lc])
    return a.unionByName(dup).unionByName(b)


CUSTOMER_CONTRACT = [
    {"field": "c_custkey", "type": "bigint", "nullable": False, "unique": True},
    {"field": "c_name", "type": "string", "nullable": False},
    {"field": "c_nationkey", "type": "integer", "nullable": False},
    {"field": "c_acctbal", "type": "integer", "nullable": True},
    {"field": "c_mktsegment", "type": "string", "nullable": False,
     "enum": ["AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY"]},
    {"field": "c_phone", "type": "string", "nullable": True},
]


def contract_check(spark, sf):
    return quality.contract_violations(tbl(spark, sf, "customer"), CUSTOMER_CONTRACT)


# ------------------------------------------------------ projections/scalars

def _bounds(spark, sf):
    li = tbl(spark, sf, "lineitem")
    lo = F.when(F.col("l_returnflag") != "R", F.floor("l_quantity").cast("int") * 1000)
    hi = F.when(~((F.col("l_linestatus") == "O") & (F.col("l_returnflag") == "N")),
                F.floor("l_extendedprice").cast("int"))
    r = salary.repair_bounds(lo, hi)
    return li.select("l_orderkey", "l_linenumber", r.alias("r"))


def range_repair(spark, sf):
    return _bounds(spark, sf).select("l_orderkey", "l_linenumber", F.col("r.lo").alias("sal_min"),
                                     F.col("r.hi").alias("sal_max"), F.col("r.has_salary").alias("has_salary"))


def midpoint(spark, sf):
    b = _bounds(spark, sf)
    return b.select("l_orderkey", "l_linenumber",
                    salary.midpoint(F.col("r.lo"), F.col("r.hi"), F.col("r.has_salary")).alias("sal_mid"))


def _exp_text() -> Column:
    m = (F.col("p_size") % 12).cast("string")
    return (F.when(F.col("p_size") % 12 == 11, F.lit(None).cast("string"))
             .when(F.col("p_type") == "LARGE", F.concat(F.lit("more_than_"), m, F.lit("_years")))
             .when(F.col("p_type") == "SMALL", F.concat(F.lit("less_than_"), m, F.lit("_years")))
             .when(F.col("p_type") == "PROMO", F.concat(F.lit("Expert "), F.col("p_brand")))
             .otherwise(F.concat(m, F.lit("_to_"), (F.col("p_size") % 12 + 2).cast("string"), F.lit("_years"))))


def bucket_case(spark, sf):
    p = tbl(spark, sf, "part").select("p_partkey", _exp_text().alias("experience"))
    return p.select("p_partkey", "experience", labels.experience_bucket(F.col("experience")).alias("exp_bucket"))


def validity_filter(spark, sf):
    o = tbl(spark, sf, "orders")
    src = F.when(F.col("o_orderstatus") == "O", "Indeed").otherwise("WTTJ")
    twin = F.col("o_orderpriority") == "1-URGENT"
    status = (F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None).cast("int"))
               .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(404)).otherwise(F.lit(200)))
    s = o.select("o_orderkey", src.alias("source"), status.alias("status"), twin.alias("is_twin"))
    return s.where(((F.col("source") == "Indeed") & ~F.col("is_twin"))
                   | ((F.col("source") == "WTTJ") & (F.col("status") == 200)))


def _blanks() -> Column:
    k = F.col("doc_id") % 6
    return (F.when(k == 0, F.lit(""))
             .when(k == 1, F.lit(" \t\n "))
             .when(k == 2, F.lit(None).cast("string"))
             .when(k == 3, F.lit("\u00a0\u3000"))
             .when(k == 4, F.concat(F.lit(" "), F.col("lang"), F.lit(" ")))
             .otherwise(F.col("text")))


def blank_to_null(spark, sf):
    d = tbl(spark, sf, "documents")
    return d.select("doc_id", text.blank_to_null(_blanks()).alias("v"))


def falsy_default(spark, sf):
    d = tbl(spark, sf, "documents")
    return d.select("doc_id", text.falsy_default(_blanks(), "Non précisé").alias("v"))


def accent_fold(spark, sf):
    d = tbl(spark, sf, "documents")
    return d.select("doc_id", text.fold_accents(F.col("text")).alias("folded"))


def slug(spark, sf):
    d = tbl(spark, sf, "documents")
    return d.select("doc_id", text.slug(F.col("text")).alias("slug"))


# Fixed test values: a display city per nation key (accents, blanks, places
# outside the reference, the region itself).
NATION_CITIES = [
    "Paris", "Saint-Denis", "Évry-Courcouronnes", "Le Bourget", "Lyon", "Île-de-France",
    "Boulogne-Billancourt", "Paris 15e", "", "Nanterre", "Créteil", "Versailles", "Marseille",
    "Vélizy-Villacoublay", "L'Haÿ-les-Roses", "Cergy", "Meaux", "Massy", "Saint-Ouen-sur-Seine",
    "Ivry-sur-Seine", "MONTREUIL", "Toulouse", " ", "Rungis", None,
]


def geo_lookup(spark, sf):
    c = tbl(spark, sf, "customer").select("c_custkey", "c_nationkey")
    cities = spark.createDataFrame(list(enumerate(NATION_CITIES)), "nk int, city string")
    j = c.join(F.broadcast(cities), c.c_nationkey == cities.nk, "left")
    return geo.with_departement(j, "city").select("c_custkey", "city", "departement", "is_idf")


def _fr_amount(x: Column, sep: Column) -> Column:
    th = F.floor(x / 1000).cast("bigint")
    rest = F.lpad((x % 1000).cast("string"), 3, "0")
    return F.when(x >= 1000, F.concat(th.cast("string"), sep, rest)).otherwise(x.cast("string"))


def _salary_text() -> Column:
    a = F.floor(F.col("o_totalprice") / 10).cast("bigint")
    b = F.floor(F.col("o_totalprice") / 4).cast("bigint")
    sep = (F.when(F.col("o_orderstatus") == "F", F.lit("\u202f"))
            .when(F.col("o_orderstatus") == "O", F.lit("\u00a0")).otherwise(F.lit(" ")))
    pr = F.col("o_orderpriority")
    cents = F.lpad((F.col("o_orderkey") % 100).cast("string"), 2, "0")
    return (F.when(pr == "1-URGENT", F.concat(F.lit("De "), _fr_amount(a, sep), F.lit(" € à "),
                                              _fr_amount(b, sep), F.lit(" € par an")))
             .when(pr == "2-HIGH", F.concat(F.lit("À partir de "), (a / 10).cast("bigint").cast("string"),
                                            F.lit(" € par mois")))
             .when(pr == "3-MEDIUM", F.concat((a / 100).cast("bigint").cast("string"), F.lit(","), cents,
                                              F.lit(" € /jour")))
             .when(pr == "4-NOT SPECIFIED", F.concat(F.lit("Salaire : "), a.cast("string"), F.lit(" €")))
             .otherwise(F.concat(F.lit("Jusqu'à "), (a % 90).cast("string"), F.lit(" € par heure"))))


def salary_parse(spark, sf):
    o = tbl(spark, sf, "orders").select("o_orderkey", _salary_text().alias("sal_text"))
    o = o.withColumn("p", salary.parse_salary_fr(F.col("sal_text")))
    return o.select("o_orderkey", "sal_text", F.col("p.min").alias("sal_min"), F.col("p.max").alias("sal_max"),
                    F.col("p.period").alias("sal_period"))


def _structured_salary(spark, sf):
    o = tbl(spark, sf, "orders")
    pr = F.col("o_orderpriority")
    div = (F.when(pr == "1-URGENT", 10).when(pr == "2-HIGH", 100).when(pr == "3-MEDIUM", 1000)
            .otherwise(10000))
    base = F.floor(F.col("o_totalprice") / div).cast("bigint")
    top = F.floor(base * 5 / 4).cast("bigint")
    st = F.col("o_orderstatus")
    sal_min = (F.when(st == "F", base.cast("string"))
                .when(st == "O", _fr_amount(base, F.lit(" ")))
                .otherwise(F.concat(base.cast("string"), F.lit(",5"))))
    sal_max = F.when(pr != "3-MEDIUM", top.cast("string"))
    per = (F.when(pr == "1-URGENT", "yearly").when(pr == "2-HIGH", "monthly")
            .when(pr == "3-MEDIUM", "daily").when(pr == "4-NOT SPECIFIED", "hourly"))
    cur = F.when(F.col("o_custkey") % 3 == 0, "USD").otherwise("EUR")
    return o.select("o_orderkey", sal_min.alias("salMin"), sal_max.alias("salMax"),
                    per.alias("salPer"), cur.alias("salCur"))


def salary_annualise(spark, sf):
    s = _structured_salary(spark, sf)
    a = salary.annualize(salary.to_number(F.col("salMin")), salary.to_number(F.col("salMax")),
                         F.col("salPer"), F.col("salCur"))
    return s.select("o_orderkey", a["lo"].alias("sal_min_eur"), a["hi"].alias("sal_max_eur"))


def salary_rejects(spark, sf):
    o = (tbl(spark, sf, "orders").select("o_orderkey", _salary_text().alias("salary_raw"))
         .withColumn("s", salary.salary_from_text(F.col("salary_raw"))))
    reason = F.col("s.reason")
    return (o.select(F.concat(F.lit("IND_"), F.col("o_orderkey").cast("string")).alias("offer_id"),
                     "salary_raw", reason.alias("reason"), F.lit(RUN_DATE).alias("run_date"))
             .where(F.col("reason").isNotNull()))


def absolute_date(spark, sf):
    e = tbl(spark, sf, "events")
    et = F.col("event_type")
    raw = (F.when(et == "click", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
            .when(et == "view", F.date_format("ts", "yyyy-MM-dd"))
            .when(et == "error", F.lit("hier"))
            .when(et == "signup", F.lit(None).cast("string"))
            .otherwise(F.lit("")))
    d = dates.absolute_date(raw)
    return e.select("event_id", d["date"].alias("posted_date"), d["precise"].alias("date_is_precise"))


def _relative_text() -> Column:
    pr = F.col("o_orderpriority")
    return (F.when(pr == "1-URGENT", F.concat(F.lit("il y a "), (F.col("o_orderkey") % 45).cast("string"),
                                              F.lit(" jours")))
             .when(pr == "2-HIGH", F.lit("Il y a 30+ jours"))
             .when(pr == "3-MEDIUM", F.lit("Publié à l'instant"))
             .when(pr == "4-NOT SPECIFIED", F.concat(F.lit("il y a "), (F.col("o_orderkey") % 23).cast("string"),
                                                     F.lit(" heures")))
             .otherwise(F.lit("Offre publiée il y a plus de 30 jours")))


def relative_date(spark, sf):
    o = tbl(spark, sf, "orders")
    d = dates.relative_date(_relative_text(), RUN_DATE)
    return o.select("o_orderkey", d["date"].alias("posted_date"), d["precise"].alias("date_is_precise"))


def _remote_raw() -> Column:
    et = F.col("event_type")
    return (F.when(et == "view", F.lit("FULL")).when(et == "click", F.lit("partial"))
             .when(et == "error", F.lit("")).when(et == "signup", F.lit(None).cast("string"))
             .otherwise(et))


def label_map(spark, sf):
    e = tbl(spark, sf, "events")
    return e.select("event_id", labels.normalize_remote(_remote_raw()).alias("remote"))


def contract_infer(spark, sf):
    e = tbl(spark, sf, "events")
    jt = F.array(F.col("event_type"),
                 F.when(F.col("value") > 50, F.lit("Stage de fin d'études")).otherwise(F.lit("CDD")))
    return e.select("event_id", labels.infer_contract(jt).alias("contract"))


def url_segment(spark, sf):
    p = tbl(spark, sf, "pages")
    return p.select("page_id", text.url_segment(F.col("url"), "/en/").alias("segment"))


def json_field(spark, sf):
    e = tbl(spark, sf, "events")
    return e.select("event_id", F.from_json("props", "struct<k int>")["k"].alias("k"))


def _with_phone(spark, sf):
    d = tbl(spark, sf, "documents")
    phone = F.concat(F.lit(" Tel 0"), (F.col("doc_id") % 9 + 1).cast("string"), F.lit(" "),
                     F.lpad((F.col("doc_id") % 100).cast("string"), 2, "0"), F.lit(".34.56.78"))
    return d.select("doc_id", F.concat(F.col("text"), phone).alias("text"))


def pii_redact(spark, sf):
    d = _with_phone(spark, sf)
    return d.select("doc_id", text.redact_contacts(F.col("text")).alias("redacted"))


def title_tokens(spark, sf):
    b = tbl(spark, sf, "benchmark")
    t = text.title_tokens(F.col("text"))
    return b.select("item_id", F.array_join(t, " ").alias("tokens"), F.size(t).cast("bigint").alias("n_tokens"))


def jaccard_pairs(spark, sf):
    c = tbl(spark, sf, "conversations").select("conv_id", "turn", text.title_tokens(F.col("text")).alias("toks"))
    nxt = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("toks").alias("next_toks"))
    j = c.join(nxt, ["conv_id", "turn"])
    return j.select("conv_id", "turn", text.jaccard(F.col("toks"), F.col("next_toks")).alias("j"))


def fuzzy_twins(spark, sf):
    d = tbl(spark, sf, "documents").select(F.col("doc_id"), "text", "source", "lang")
    return similarity.find_twins(d, d, id_col="doc_id", title="text", company="source", city="lang",
                                 exclude_self=True).withColumnRenamed("id", "doc_id")


TWIN_HOSTS = r"(?i)example\.(net|org)"


def twin_flag(spark, sf):
    p = tbl(spark, sf, "pages").select("page_id", "url")
    twins = (p.where(F.col("url").rlike(TWIN_HOSTS))
              .select(F.regexp_replace("url", r"[?#].*$", "").alias("twin_url")).distinct()
              .withColumn("__hit", F.lit(True)))
    j = p.join(twins, p.url == twins.twin_url, "left")
    flag = F.col("url").isNotNull() & (F.col("url") != "") & F.coalesce(F.col("__hit"), F.lit(False))
    return j.select("page_id", "url", flag.alias("is_twin"))


def union_feeds(spark, sf):
    c = tbl(spark, sf, "customer").select(
        F.concat(F.lit("C_"), F.col("c_custkey").cast("string")).alias("entity_id"),
        F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"),
        F.col("c_acctbal").alias("balance"), F.lit("customer").alias("kind"),
        F.col("c_mktsegment").alias("segment"))
    s = tbl(spark, sf, "supplier").select(
        F.concat(F.lit("S_"), F.col("s_suppkey").cast("string")).alias("entity_id"),
        F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"),
        F.col("s_acctbal").alias("balance"), F.lit("supplier").alias("kind"))
    return c.unionByName(s, allowMissingColumns=True)


def search_offers(spark, sf):
    o = tbl(spark, sf, "orders").select(
        F.col("o_orderkey").alias("offer_id"), F.col("o_orderstatus").alias("departement"),
        F.col("o_orderpriority").alias("contract"), (F.col("o_totalprice") > 100000).alias("has_salary"),
        "o_totalprice")
    return search.search_offers(o, departement="F", contract="1-URGENT", has_salary=True, limit=50,
                                columns=["offer_id", "departement", "contract", "has_salary", "o_totalprice"])


def run_stats(spark, sf):
    o = tbl(spark, sf, "orders")
    n = F.count(F.lit(1))
    sal = F.count_if(F.col("o_totalprice") > 200000)
    return o.agg(
        F.lit(RUN_DATE).alias("run_date"), n.alias("n_total"),
        F.count_if(F.col("o_orderstatus") == "F").alias("n_wttj"),
        F.count_if(F.col("o_orderstatus") == "O").alias("n_indeed"),
        F.count_if((F.col("o_orderstatus") == "O") & (F.col("o_orderpriority") == "1-URGENT")).alias("n_twins_indeed"),
        sal.alias("n_salary"),
        F.coalesce(agg.pct(sal, n), F.lit(0.0)).alias("pct_salary"),
        F.count_if(F.col("o_orderpriority") == "5-LOW").alias("n_rejects_salaire"),
    )


def parquet_scan(spark, sf):
    from pyspark.sql import types as T
    schema = T.StructType([
        T.StructField("l_orderkey", T.LongType()), T.StructField("l_partkey", T.LongType()),
        T.StructField("l_quantity", T.DoubleType()), T.StructField("l_shipdate", T.TimestampNTZType()),
    ])
    li = spark.read.schema(schema).parquet(table_path(sf, "lineitem"))
    return spark.sql(
        "SELECT l_orderkey, l_partkey, l_quantity FROM {li} "
        "WHERE l_shipdate >= CAST(:since AS TIMESTAMP_NTZ) AND l_quantity > :q",
        args={"since": "1997-01-01 00:00:00", "q": 45}, li=li)


SAMPLE_N = 250


def sample_first_n(spark, sf):
    d = _with_phone(spark, sf)
    first = d.orderBy("doc_id").limit(SAMPLE_N)
    return first.select("doc_id", text.redact_contacts(F.col("text")).alias("text"))


def offer_star_build(spark, sf):
    """The whole job on feeds derived from the tables: land, conform, build
    the star and marts, run the checks; returns the fact table."""
    import uuid

    from offerlake.plans import derived_feeds, job
    from offerlake.session import scratch_path
    from offerlake.sources import sinks
    base = scratch_path(spark, f"derived-{uuid.uuid4().hex[:12]}")
    sources = derived_feeds.write_feeds(spark, sf, f"{base}/raw")
    stats = job.run_job(spark, f"{base}/lake", RUN_DATE, sources, exclude_tags=("fullonly",))
    if not stats["gold_ok"]:
        raise RuntimeError(f"quality gate failed: {stats['failed_checks']}")
    return sinks.gold_table(spark, f"{base}/lake/gold", "fct_offres")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "box_plot_by_segment": box_plot_by_segment,
    "box_plot_min_n": box_plot_min_n,
    "kpi_card": kpi_card,
    "completeness_scorecard": completeness_scorecard,
    "count_by_key": count_by_key,
    "count_by_key_nonnull": count_by_key_nonnull,
    "tension_matrix": tension_matrix,
    "month_series": month_series,
    "top_terms": top_terms,
    "top_skills": top_skills,
    "top_k_cities_like": top_k_cities_like,
    "any_value_bool_or": any_value_bool_or,
    "distinct_dim_key": distinct_dim_key,
    "date_dim": date_dim,
    "star_fact": star_fact,
    "fk_violations": fk_violations,
    "not_null_unique_accepted": not_null_unique_accepted,
    "reference_count_checks": reference_count_checks,
    "contract_check": contract_check,
    "midpoint": midpoint,
    "range_repair": range_repair,
    "bucket_case": bucket_case,
    "validity_filter": validity_filter,
    "blank_to_null": blank_to_null,
    "falsy_default": falsy_default,
    "accent_fold": accent_fold,
    "slug": slug,
    "geo_lookup": geo_lookup,
    "salary_parse": salary_parse,
    "salary_annualise": salary_annualise,
    "salary_rejects": salary_rejects,
    "absolute_date": absolute_date,
    "relative_date": relative_date,
    "label_map": label_map,
    "contract_infer": contract_infer,
    "url_segment": url_segment,
    "json_field": json_field,
    "pii_redact": pii_redact,
    "title_tokens": title_tokens,
    "jaccard_pairs": jaccard_pairs,
    "fuzzy_twins": fuzzy_twins,
    "twin_flag": twin_flag,
    "union_feeds": union_feeds,
    "search_offers": search_offers,
    "run_stats": run_stats,
    "parquet_scan": parquet_scan,
    "sample_first_n": sample_first_n,
    "offer_star_build": offer_star_build,
}
