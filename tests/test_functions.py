"""Golden vectors for the column expressions."""

import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from conftest import run_expr
from offerlake.functions import dates, geo, labels, salary, skills, text


def test_fold_tables_match_python(spark):
    samples = ["Évry-Courcouronnes", "ÇA VA où ñandú Übermaß", "ǅemal ﬁ", "Ångström ŀ ø"]
    got = run_expr(spark, samples, text.fold_accents)
    exp = ["".join(c for c in unicodedata.normalize("NFD", s.lower()) if unicodedata.category(c) != "Mn")
           for s in samples]
    assert got == exp


def test_strip_accents_every_code_point(spark):
    """Every code point of Unicode, in blocks, against the standard library."""
    blocks = ["".join(chr(c) for c in range(i, i + 0x400) if not 0xD800 <= c <= 0xDFFF) for i in range(0, 0x110000, 0x400)]
    blocks = [b for b in blocks if b]
    exp = ["".join(x for c in b for x in unicodedata.normalize("NFD", c) if unicodedata.category(x) != "Mn") for b in blocks]
    assert run_expr(spark, blocks, text.strip_accents) == exp


@pytest.mark.parametrize("v,exp", [
    ("45000", 45000.0), ("45 000,5", 45000.5), ("45000d", None), ("45000f", None), ("45000\u00a0", 45000.0), ("1_000", 1000.0),
    ("1__0", None), ("1e3", 1000.0), (".5", 0.5), ("5.", 5.0), ("+7", 7.0), ("", None), ("abc", None), ("0x10", None), (None, None),
])
def test_to_number(spark, v, exp):
    assert run_expr(spark, [v], salary.to_number) == [exp]


def test_remote_json_types(spark):
    df = spark.sql("""SELECT i, parse_json(j) AS v FROM VALUES (0, '0'), (1, '1'), (2, 'false'), (3, 'true'), (4, '"full"'), (5, '0.0'), (6, '""') t(i, j)""")
    out = df.select("i", labels.normalize_remote(F.col("v").cast("string"), F.expr("schema_of_variant(v)")).alias("o")).orderBy("i").collect()
    assert [r.o for r in out][:4] == [None, "1", None, "True"] and out[5].o is None


# Golden vectors: inputs and outputs are fixed values.
@pytest.mark.parametrize("v,exp", [
    ("Évry-Courcouronnes", "evry-courcouronnes"), ("  Saint  Denis!! ", "saint-denis"),
    (None, ""), ("", ""), ("---", ""),
])
def test_slug(spark, v, exp):
    assert run_expr(spark, [v], text.slug) == [exp]


def test_departement(spark):
    cities = ["Paris", "Saint-Denis", "Le Bourget", "Nanterre", "Île-de-France", "Lyon", None, "", "Paris 15e"]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cities)], "i int, city string")
    out = geo.with_departement(df, "city").orderBy("i").collect()
    assert [r.departement for r in out] == ["75", "93", "93", "92", "IDF", "Hors référentiel",
                                            "Non précisé", "Non précisé", "Hors référentiel"]
    assert [r.is_idf for r in out] == [True, True, True, True, True, False, False, False, False]


def test_reference_has_unique_slugs():
    rows = geo.reference_rows()
    assert len(rows) == len({c for c, _ in rows}) == 165


@pytest.mark.parametrize("v,exp", [
    ("Data Engineer Python / SQL / Airflow / dbt sur AWS", ["Python", "SQL", "Airflow", "dbt", "AWS"]),
    ("Développeur JavaScript React", []),
    ("Ingénieur Java Spring", ["Java"]),
    ("Consultant PowerBI et Power Query", ["Power BI", "Power Query"]),
    ("Maîtrise des STATISTIQUES appliquées", ["Statistiques"]),
    ("", []), (None, []),
    ("scikitlearn and sklearnx", ["scikit-learn"]),
    ("ßsql", []),
])
def test_skills(spark, v, exp):
    assert run_expr(spark, [v], skills.extract_skills) == [exp]


def test_title_tokens_and_jaccard(spark):
    assert run_expr(spark, ["Data Engineer H/F"], text.title_tokens) == [["data", "engineer"]]
    assert run_expr(spark, [None], text.title_tokens) == [[]]
    df = spark.createDataFrame([(["a", "b"], ["a", "b"]), (["a"], ["b"]), ([], ["a"])], "a array<string>, b array<string>")
    assert [r[0] for r in df.select(text.jaccard(F.col("a"), F.col("b"))).collect()] == [1.0, 0.0, 0.0]


def _parse(spark, v):
    r = run_expr(spark, [v], salary.parse_salary_fr)[0]
    return None if r is None else (r["min"], r["max"], r["period"])


def test_salary_text(spark):
    assert _parse(spark, "De 45 000 € à 50 000 € par an") == (45000.0, 50000.0, "yearly")
    assert _parse(spark, "De 45 000 € à 50 000 € par an") == (45000.0, 50000.0, "yearly")
    assert _parse(spark, "70 000 € par an") == (70000.0, 70000.0, "yearly")
    assert _parse(spark, "À partir de 60 000 € par an")[0] == 60000.0
    lo, hi, per = _parse(spark, "De 492,22 € à 1 823,03 € par mois")
    assert per == "monthly" and round(hi) == 1823
    assert _parse(spark, "50 000 €") is None
    assert _parse(spark, "") is None and _parse(spark, None) is None
    assert _parse(spark, "15 € de l'heure") is None          # amounts under 100 dropped
    assert _parse(spark, "2 500 3 000 par mois") == (25003000.0, 25003000.0, "monthly")


def _ann(spark, lo, hi, per, cur):
    df = spark.createDataFrame([(lo, hi, per, cur)], "a string, b string, p string, c string")
    r = df.select(salary.annualize(salary.to_number(F.col("a")), salary.to_number(F.col("b")),
                                   F.col("p"), F.col("c")).alias("x")).first().x
    return (r.lo, r.hi)


def test_annualize(spark):
    assert _ann(spark, "4000", "4000", "monthly", "EUR") == (48000, 48000)
    assert _ann(spark, "500", "500", "daily", "EUR") == (109000, 109000)
    assert _ann(spark, "610000", "610000", "yearly", "EUR") == (None, None)
    assert _ann(spark, "200", "200", "yearly", "EUR") == (None, None)
    assert _ann(spark, "100000", None, "yearly", "USD") == (92000, 92000)
    assert _ann(spark, "40000", "50000", None, "EUR") == (None, None)
    assert _ann(spark, "45 000", "5000000", "yearly", "EUR") == (45000, 45000)
    assert _ann(spark, "8000.5", "8001.5", "yearly", "EUR") == (8000, 8002)   # half-even
    assert _ann(spark, "45 000", "50000", "yearly", "EUR") == (50000, 50000)


def test_dates(spark):
    r = run_expr(spark, ["2026-05-21T10:00:00Z", "hier", None], dates.absolute_date)
    assert [(x["date"], x["precise"]) for x in r] == [("2026-05-21", True), (None, False), (None, False)]
    vals = ["il y a 3 jours", "il y a 30+ jours", "Publié à l'instant", "il y a 5 heures", "", None, "x"]
    r = run_expr(spark, vals, lambda c: dates.relative_date(c, "2026-06-10"))
    assert [x["date"] for x in r] == ["2026-06-07", "2026-05-11", "2026-06-10", "2026-06-10", None, None, None]
    assert not any(x["precise"] for x in r)


def test_labels(spark):
    r = run_expr(spark, ["FULL", "partial", "", None, "weird", "Unknown"], labels.normalize_remote)
    assert r == ["Total", "Partiel", "Non précisé", None, "weird", "Non précisé"]
    df = spark.createDataFrame([(["CDI", "Stage de fin"],), (None,), (["cdd"],)], "a array<string>")
    assert [x[0] for x in df.select(labels.infer_contract(F.col("a"))).collect()] == ["Stage", "Non précisé", "Non précisé"]
    r = run_expr(spark, [None, "less_than_1_year", "more_than_10_years", "3_to_4_years", "4_to_5_years", "1_to_3"],
                 labels.experience_bucket)
    assert r == ["Non précisé", "Junior (< 3 ans)", "Junior (< 3 ans)", "Autre", "Senior (5+ ans)", "Autre"]


def test_blank_and_default(spark):
    r = run_expr(spark, ["  ", " \t", " x ", "", None], text.blank_to_null)
    assert r == [None, None, " x ", None, None]
    r = run_expr(spark, ["", None, " ", "CDI"], lambda c: text.falsy_default(c, "Non précisé"))
    assert r == ["Non précisé", "Non précisé", " ", "CDI"]


def test_redact_and_url(spark):
    r = run_expr(spark, ["écrire à jean.dupont@exemple.fr ou au 06 12 34 56 78", "id 1234567890123"],
                 text.redact_contacts)
    assert r == ["écrire à [email] ou au [tel]", "id 1234567890123"]
    r = run_expr(spark, ["https://x.com/fr/companies/acme/jobs/1", "https://x.com/", None],
                 text.url_segment)
    assert r == ["acme", None, None]


def test_salary_special_spaces(spark):
    # narrow no-break space and thin space inside amounts are plain spaces in free text
    assert _parse(spark, "De 45\u202f000 € à 50\u202f000 € par an") == (45000.0, 50000.0, "yearly")
    assert _parse(spark, "32\u2009000 € /an") == (32000.0, 32000.0, "yearly")


def reads(column, name):
    """How often an expression computes ``name``."""
    return column._jc.toString().count(name)


def test_values_in_bindings_are_computed_once(spark):
    """Bodies of bindings are interpreted without shared subexpressions: an amount that is read in
    several places would be parsed as often."""
    probe = F.reverse(F.col("v"))
    assert reads(salary.to_number(probe), "reverse") == 1
    number = salary.to_number(probe)
    assert reads(salary.annualize(number, F.lit(None).cast("double"), F.lit("yearly"), F.lit("EUR")), "reverse") == 1


def test_a_record_is_parsed_once_for_all_field_types(spark):
    from offerlake.plans import silver

    rows = spark.createDataFrame([(0, None, '{"url": "u"}')], "pos bigint, key string, raw string")
    plan = silver.typed_records(rows, silver.TEXT_A, ("status",))._jdf.queryExecution().analyzed().toString()
    assert plan.count("parse_json(") == 1


def test_words_of_skills_against_their_patterns(spark):
    """Skills looked up among a text's words are those whose pattern Python finds in it."""
    rng = random.Random(5)
    bits = [w for p in [p for _, p in skills.SKILLS] for w in [*skills.needles(p), *skills.words(p)]]
    bits += ["google", "cloud", "powerbi", "power bi", "power  bi", "javascript", "statistique", "scikit-learn", "xsklearn", "langage naturels", "é", "k8s_", "#GCP", "#Power BI"]
    ends = [" ", "", "-", "_", ",", "/", "\n", "é", "1", "\u0301", "#"]
    texts = ["".join(rng.choice(bits) + rng.choice(ends) for _ in range(rng.randint(0, 6))) for _ in range(1500)] + ["\U0001d5bascala", "scala\U0001d5ba"]
    got = [r.f for r in spark.createDataFrame(list(enumerate(texts)), "i int, v string").select("i", skills.found("v").alias("f")).orderBy("i").collect()]
    want = [[label for label, p in skills.SKILLS if re.search(p, t)] for t in texts]
    assert got == want and sum(map(len, got)) > 1000
    # No search of the whole text per whole word of the dictionary.
    plan = spark.createDataFrame([("a",)], "v string").select(skills.found("v").alias("f"))._jdf.queryExecution().analyzed().toString()
    assert plan.lower().count("contains(") <= 12


def test_silver_parses_amounts_and_feed_b_once(spark):
    from offerlake.plans import silver
    from offerlake.schemas import BRONZE_ROWS

    a = spark.createDataFrame([(0, None, '{"url": "u", "salMin": "3000", "salMax": "3500", "salPer": "monthly"}')], BRONZE_ROWS)
    out = silver.conform_a(a, "2026-06-10")
    assert [(r.sal_min_eur, r.sal_max_eur) for r in out.collect()] == [(36000, 42000)]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("bround(") == 2        # one for each bound
    b = spark.createDataFrame([(i, str(i), f'{{"jk": "{i}", "salary": "{s}"}}') for i, s in enumerate(["30000 € par an", "selon profil", "3 € par an", ""])], BRONZE_ROWS)
    offers, rejects = silver.conform_b(b, spark.createDataFrame([], "url string"), "2026-06-10")
    assert offers.count() == 4 and {(r.offer_id, r.salary_raw) for r in rejects.collect()} == {("IND_1", "selon profil"), ("IND_2", "3 € par an")}
    assert all("from_json" not in d._jdf.queryExecution().optimizedPlan().toString() for d in (offers, rejects))
