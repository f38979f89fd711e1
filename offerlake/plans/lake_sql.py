"""DuckDB SQL for the product queries: the job's tables from the shared tables.

The column rules come from ``sqltext``, which spells the same fixed values (word lists,
patterns, bounds) as the library; the joins, filters, keys and aggregates are written here
on their own.
"""

from __future__ import annotations

from offerlake.functions import labels, salary
from offerlake.plans import catalog as C
from offerlake.plans import derived_feeds as D
from offerlake.plans import sqltext as S
from offerlake.plans.oracle import _annual, _parsed_salary_cte
from offerlake.sources.sampling import RECORDS

q = S.q
_cities = ", ".join(f"({i}, {'NULL' if c is None else q(c)})" for i, c in enumerate(C.NATION_CITIES))
_titles = "[" + ", ".join(q(t) for t in D.TITLE_SKILLS) + "]"
_per = "CASE o_orderpriority WHEN '1-URGENT' THEN 'yearly' WHEN '2-HIGH' THEN 'monthly' WHEN '3-MEDIUM' THEN 'daily' END"
_div = "CASE o_orderpriority WHEN '1-URGENT' THEN 5 WHEN '2-HIGH' THEN 60 ELSE 1000 END"
_a_lo, _a_hi = _annual("CAST(amount AS DOUBLE)", "CAST(amount * 5 // 4 AS DOUBLE)", "per", "'EUR'")
_b_lo, _b_hi = _annual("pmin", "pmax", "pper", "'EUR'")

SILVER = rf"""
cities(nk, city) AS (VALUES {_cities}),
ref AS (SELECT * FROM {S.geo_values()}),
a0 AS (
  SELECT o.*, lower(regexp_replace(coalesce(c_name, ''), '[^A-Za-z0-9]+', '-', 'g')) AS company, c_mktsegment, ci.city AS city,
         {_per} AS per, CAST(floor(o_totalprice / ({_div})) AS BIGINT) AS amount,
         row_number() OVER (ORDER BY CAST(o_orderkey // {D.RECORDS_PER_DOC} AS VARCHAR) || '/', o_orderkey) - 1 AS pos
  FROM orders o LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN cities ci ON c_nationkey = ci.nk),
a1 AS (
  SELECT 'WTTJ_' || pos AS offer_id, 'WTTJ' AS source, pos,
         'https://jobs.example/fr/companies/' || company || '/jobs/' || o_orderkey AS url, CAST(NULL AS VARCHAR) AS apply_url,
         'Data ' || lower(c_mktsegment) || ' ' || o_orderpriority || {_titles}[1 + o_orderkey % {len(D.TITLE_SKILLS)}] AS title,
         nullif(company, '') AS company, city, c_mktsegment AS profession, CAST(NULL AS VARCHAR) AS kw,
         CASE o_orderstatus WHEN 'F' THEN 'CDI' WHEN 'O' THEN 'Stage' ELSE {q(labels.NOT_SPECIFIED)} END AS contract,
         CASE WHEN o_orderkey % 7 <> 0 THEN (o_orderkey % 11) || '_to_' || (o_orderkey % 11 + 2) || '_years' END AS experience,
         CASE WHEN o_orderkey % 3 = 0 THEN 'bac_5' END AS education,
         {S.remote("CASE o_orderkey % 4 WHEN 0 THEN 'partial' WHEN 1 THEN 'full' END")} AS remote,
         {_a_lo} AS lo, {_a_hi} AS hi, per AS sal_source_period,
         strftime(o_orderdate, '%Y-%m-%d') AS posted_date, o_orderdate IS NOT NULL AS date_is_precise,
         CASE WHEN o_orderpriority = '5-LOW' THEN 404 ELSE 200 END AS status, false AS is_twin
  FROM a0),
s0 AS (
  SELECT doc_id AS o_orderkey, 'De ' || n_chars * 10 || ' € à ' || n_chars * 20 || ' € par an' AS raw FROM documents),
{_parsed_salary_cte('raw').strip()},
b1 AS (
  SELECT 'IND_d' || d.doc_id AS offer_id, 'Indeed' AS source, CAST(NULL AS BIGINT) AS pos,
         'https://fr.indeed.com/doc/' || d.doc_id AS url, 'https://fr.indeed.com/doc/' || d.doc_id AS apply_url,
         'Data ' || lang || ' ' || source AS title, d.source AS company, ci.city AS city, CAST(NULL AS VARCHAR) AS profession, CAST(NULL AS VARCHAR) AS kw,
         CASE WHEN lang = 'fr' THEN 'Stage' ELSE {q(labels.NOT_SPECIFIED)} END AS contract,
         CAST(NULL AS VARCHAR) AS experience, CAST(NULL AS VARCHAR) AS education, CAST(NULL AS VARCHAR) AS remote,
         {_b_lo} AS lo, {_b_hi} AS hi, pper AS sal_source_period, raw, pmin,
         strftime(DATE {q(C.RUN_DATE)} - CAST(d.doc_id % 31 AS INTEGER), '%Y-%m-%d') AS posted_date, false AS date_is_precise, 200 AS status,
         EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.toxic = 1) AS is_twin, coalesce(d.text, '') AS snippet
  FROM documents d JOIN s2 ON s2.o_orderkey = d.doc_id LEFT JOIN cities ci ON d.doc_id % {len(C.NATION_CITIES)} = ci.nk),
both_feeds AS (
  SELECT * EXCLUDE (pos), title AS skill_text FROM a1
  UNION ALL BY NAME
  SELECT * EXCLUDE (pos, raw, pmin, snippet), coalesce(title, '') || ' ' || snippet || ' ' AS skill_text FROM b1),
silver AS (
  SELECT offer_id, source, {S.blank_to_null('url')} AS url, {S.blank_to_null('apply_url')} AS apply_url, {S.blank_to_null('title')} AS title,
         {S.blank_to_null('company')} AS company, {S.blank_to_null('b.city')} AS city,
         CASE WHEN geo_dept IS NOT NULL THEN geo_dept WHEN {S.slug('b.city')} <> '' THEN 'Hors référentiel' ELSE 'Non précisé' END AS departement,
         geo_dept IS NOT NULL AS is_idf, profession, kw, contract, experience, education, remote,
         CASE WHEN lo > hi THEN hi ELSE lo END AS sal_min_eur, CASE WHEN lo > hi THEN lo ELSE hi END AS sal_max_eur,
         sal_source_period, lo IS NOT NULL AS has_salary, posted_date, date_is_precise, status, is_twin,
         array_to_string({S.skills_list('skill_text')}, '|') AS skills, {q(C.RUN_DATE)} AS run_date, {q(C.RUN_DATE + 'T00:00:00Z')} AS ingested_at
  FROM both_feeds b LEFT JOIN ref ON {S.slug('b.city')} = geo_slug),
rejects AS (
  SELECT offer_id, raw AS salary_raw, CASE WHEN pmin IS NULL THEN {q(salary.REASON_UNPARSED)} ELSE {q(salary.REASON_IMPLAUSIBLE)} END AS reason,
         {q(C.RUN_DATE)} AS run_date
  FROM b1 WHERE lo IS NULL),
stg AS (
  SELECT * EXCLUDE (run_date, ingested_at), {S.exp_bucket('experience')} AS exp_bucket,
         CASE WHEN has_salary THEN round((coalesce(sal_min_eur, sal_max_eur) + coalesce(sal_max_eur, sal_min_eur)) / 2.0, 0) END AS sal_mid_eur
  FROM silver),
valid AS (SELECT * FROM stg WHERE (source = 'Indeed' AND NOT is_twin) OR (source = 'WTTJ' AND status = 200))"""


def _dim(column: str, key: str) -> str:
    return f"SELECT row_number() OVER (ORDER BY {column}) AS {key}, {column} FROM (SELECT DISTINCT {column} FROM valid WHERE {column} IS NOT NULL)"


_DIMS = {
    "dim_contrat": _dim("contract", "contrat_key"), "dim_remote": _dim("remote", "remote_key"), "dim_metier": _dim("profession", "metier_key"),
    "dim_entreprise": _dim("company", "entreprise_key"), "dim_experience": _dim("exp_bucket", "exp_key"), "dim_education": _dim("education", "edu_key"),
    "dim_lieu": """SELECT row_number() OVER (ORDER BY city) AS lieu_key, city, departement, is_idf
                   FROM (SELECT city, any_value(departement) AS departement, bool_or(is_idf) AS is_idf FROM valid WHERE city IS NOT NULL GROUP BY city)""",
    "dim_date": """SELECT row_number() OVER (ORDER BY jour) AS date_key, jour, strftime(jour, '%Y-%m') AS mois, year(jour) AS annee
                   FROM (SELECT DISTINCT CAST(posted_date AS DATE) AS jour FROM valid WHERE date_is_precise AND posted_date IS NOT NULL)""",
}


def _rank(column: str) -> str:
    return f"CASE WHEN {column} IS NOT NULL THEN dense_rank() OVER (ORDER BY {column} NULLS LAST) END"


_FACT = f"""SELECT *, {_rank('contract')} AS contrat_key, {_rank('remote')} AS remote_key, {_rank('profession')} AS metier_key, {_rank('city')} AS lieu_key,
  {_rank('company')} AS entreprise_key, {_rank('exp_bucket')} AS exp_key, {_rank('education')} AS edu_key FROM valid"""

_filled = {"Salaire": "has_salary", "Expérience": "experience IS NOT NULL", "Diplôme": "education IS NOT NULL", "Ville": "city IS NOT NULL",
           "Métier (profession.fr)": "profession IS NOT NULL", "Télétravail": "remote IS NOT NULL", "Date précise": "date_is_precise"}


def _box(group: str, least: int, extremes: str, out: str, where: str = "true") -> str:
    return (f"SELECT {group} AS {out}, count(*) AS n, round(quantile_cont(sal_mid_eur, 0.5), 0) AS median, round(quantile_cont(sal_mid_eur, 0.25), 0) AS q1, "
            f"round(quantile_cont(sal_mid_eur, 0.75), 0) AS q3{extremes} FROM valid WHERE has_salary AND {where} GROUP BY {group} HAVING count(*) >= {least}")


_MARTS = {
    "mart_completude": " UNION ALL ".join(
        f"SELECT {q(n)} AS champ, count(*) FILTER (WHERE {c}) AS rempli, count(*) AS total, round(100.0 * count(*) FILTER (WHERE {c}) / count(*), 1) AS pct FROM valid"
        for n, c in _filled.items()),
    "mart_kpis": """SELECT count(*) AS n_offres, count(*) FILTER (WHERE source = 'WTTJ') AS n_wttj, count(*) FILTER (WHERE source = 'Indeed') AS n_indeed,
        (SELECT count(*) FROM stg WHERE source = 'Indeed' AND is_twin) AS n_twins_dedup, count(*) FILTER (WHERE has_salary) AS n_salaire,
        round(100.0 * count(*) FILTER (WHERE has_salary) / count(*), 1) AS pct_salaire, count(DISTINCT company) AS n_entreprises,
        count(DISTINCT city) AS n_villes, count(*) FILTER (WHERE is_idf) AS n_idf, round(quantile_cont(sal_mid_eur, 0.5), 0) AS salaire_median,
        round(quantile_cont(sal_mid_eur, 0.25), 0) AS salaire_q1, round(quantile_cont(sal_mid_eur, 0.75), 0) AS salaire_q3 FROM valid""",
    "mart_par_contrat": "SELECT contract AS contrat, count(*) AS n FROM valid GROUP BY ALL",
    "mart_par_departement": "SELECT departement, count(*) AS n FROM valid GROUP BY ALL",
    "mart_par_experience": "SELECT exp_bucket, count(*) AS n FROM valid GROUP BY ALL",
    "mart_par_metier": "SELECT profession AS metier, count(*) AS n FROM valid WHERE profession IS NOT NULL GROUP BY ALL",
    "mart_par_remote": "SELECT remote, count(*) AS n FROM valid WHERE remote IS NOT NULL GROUP BY ALL",
    "mart_salaire_par_contrat": _box("contract", 5, ", round(min(sal_mid_eur), 0) AS mini, round(max(sal_mid_eur), 0) AS maxi", "contrat"),
    "mart_salaire_par_metier": _box("profession", 8, "", "metier", "profession IS NOT NULL"),
    "mart_tension": """SELECT profession AS metier, departement, count(*) AS n FROM valid
        WHERE profession IS NOT NULL AND departement NOT IN ('Non précisé', 'Hors référentiel') GROUP BY ALL""",
    "mart_timeseries": "SELECT strftime(CAST(posted_date AS DATE), '%Y-%m') AS mois, count(*) AS n FROM valid WHERE date_is_precise AND posted_date IS NOT NULL GROUP BY ALL",
    "mart_top_competences": """SELECT competence, count(*) AS n FROM (SELECT unnest(string_split(skills, '|')) AS competence FROM valid) WHERE competence <> ''
        GROUP BY ALL ORDER BY n DESC, competence LIMIT 30""",
    "mart_top_villes": "SELECT city AS ville, any_value(departement) AS departement, count(*) AS n FROM valid WHERE city IS NOT NULL GROUP BY city ORDER BY n DESC, city LIMIT 20",
}


def oracle_sql() -> dict[str, str]:
    body = {
        "landed_records": f"""SELECT 'wttj' AS feed, pos, CAST(NULL AS VARCHAR) AS key, url FROM a1 UNION ALL
            SELECT 'indeed', row_number() OVER (ORDER BY CAST(doc_id // 2000 AS VARCHAR) || '/', doc_id) - 1, 'd' || doc_id, 'https://fr.indeed.com/doc/' || doc_id FROM documents UNION ALL
            SELECT 'cross_site', row_number() OVER (PARTITION BY doc_id // {D.RECORDS_PER_DOC} ORDER BY doc_id) - 1, 'https://fr.indeed.com/doc/' || doc_id, NULL
            FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL""",
        "feed_samples": f"""SELECT * FROM (SELECT 'wttj' AS feed, pos, CAST(NULL AS VARCHAR) AS key, url FROM a1) WHERE pos < {RECORDS['wttj']} UNION ALL
            SELECT * FROM (SELECT 'indeed', row_number() OVER (ORDER BY CAST(doc_id // 2000 AS VARCHAR) || '/', doc_id) - 1 AS pos, 'd' || doc_id, 'https://fr.indeed.com/doc/' || doc_id FROM documents)
            WHERE pos < {RECORDS['indeed']}""",
        "twin_urls": "SELECT DISTINCT 'https://fr.indeed.com/doc/' || doc_id AS url FROM labels WHERE toxic = 1",
        "silver_offers": "SELECT * FROM silver",
        "silver_rejects": "SELECT * FROM rejects",
        "run_stats": f"""SELECT {q(C.RUN_DATE)} AS run_date, count(*) AS n_total, count(*) FILTER (WHERE source = 'WTTJ') AS n_wttj, count(*) FILTER (WHERE source = 'Indeed') AS n_indeed,
            count(*) FILTER (WHERE is_twin) AS n_twins_indeed, count(*) FILTER (WHERE has_salary) AS n_salary,
            coalesce(round_even(100.0 * count(*) FILTER (WHERE has_salary) / nullif(count(*), 0), 1), 0.0) AS pct_salary,
            (SELECT count(*) FROM rejects) AS n_rejects_salaire FROM silver""",
        "staging": "SELECT * FROM stg",
        "valid_offers": "SELECT * FROM valid",
        "fact": _FACT,
        **_DIMS, **_MARTS,
    }
    out = {f"product_{name}": f"WITH {SILVER}\n{sql}" for name, sql in body.items()}
    out["offer_star_build"] = f"WITH {SILVER}\nSELECT * REPLACE (list_filter(string_split(skills, '|'), lambda x: x <> '') AS skills) FROM ({_FACT})"
    return out
