"""Independent SQL (DuckDB dialect) for each catalogue query.

Written against the same parquet tables, registered as views.  These are
the reference answers the Spark plans are compared with.
"""

from __future__ import annotations

from offerlake.plans import catalog as C
from offerlake.plans import sqltext as S

q = S.q


def _salary_text() -> str:
    a = "CAST(floor(o_totalprice / 10) AS BIGINT)"
    b = "CAST(floor(o_totalprice / 4) AS BIGINT)"
    sep = "(CASE o_orderstatus WHEN 'F' THEN chr(8239) WHEN 'O' THEN chr(160) ELSE ' ' END)"

    def fr(x):
        return (f"(CASE WHEN {x} >= 1000 THEN CAST({x} // 1000 AS VARCHAR) || {sep} || "
                f"lpad(CAST({x} % 1000 AS VARCHAR), 3, '0') ELSE CAST({x} AS VARCHAR) END)")
    cents = "lpad(CAST(o_orderkey % 100 AS VARCHAR), 2, '0')"
    return (f"(CASE o_orderpriority "
            f"WHEN '1-URGENT' THEN 'De ' || {fr(a)} || ' € à ' || {fr(b)} || ' € par an' "
            f"WHEN '2-HIGH' THEN 'À partir de ' || CAST({a} // 10 AS VARCHAR) || ' € par mois' "
            f"WHEN '3-MEDIUM' THEN CAST({a} // 100 AS VARCHAR) || ',' || {cents} || ' € /jour' "
            f"WHEN '4-NOT SPECIFIED' THEN 'Salaire : ' || CAST({a} AS VARCHAR) || ' €' "
            f"ELSE 'Jusqu''à ' || CAST({a} % 90 AS VARCHAR) || ' € par heure' END)")


def _parsed_salary_cte(raw_alias: str) -> str:
    t = S.special_spaces(raw_alias)
    return f"""
    s1 AS (SELECT o_orderkey, {raw_alias}, {S.period(t)} AS period, {S.amounts(t)} AS nums FROM s0),
    s2 AS (SELECT o_orderkey, {raw_alias},
                  CASE WHEN {raw_alias} IS NOT NULL AND {raw_alias} <> '' AND period IS NOT NULL AND len(nums) > 0
                       THEN list_min(nums) END AS pmin,
                  CASE WHEN {raw_alias} IS NOT NULL AND {raw_alias} <> '' AND period IS NOT NULL AND len(nums) > 0
                       THEN list_max(nums) END AS pmax,
                  CASE WHEN {raw_alias} IS NOT NULL AND {raw_alias} <> '' AND period IS NOT NULL AND len(nums) > 0
                       THEN period END AS pper
           FROM s1)"""


def _annual(vmin: str, vmax: str, per: str, cur: str) -> tuple[str, str]:
    f = S.factor(per, cur)
    a, b = S.annual_bound(vmin, f), S.annual_bound(vmax, f)
    m = S.mult(per)
    return (f"(CASE WHEN {m} IS NOT NULL THEN coalesce({a}, {b}) END)",
            f"(CASE WHEN {m} IS NOT NULL THEN coalesce({b}, {a}) END)")


def _blanks() -> str:
    return ("(CASE doc_id % 6 WHEN 0 THEN '' WHEN 1 THEN ' ' || chr(9) || chr(10) || ' ' WHEN 2 THEN NULL "
            "WHEN 3 THEN chr(160) || chr(12288) WHEN 4 THEN ' ' || lang || ' ' ELSE text END)")


def _bounds() -> str:
    lo = "CASE WHEN l_returnflag <> 'R' THEN CAST(floor(l_quantity) AS INTEGER) * 1000 END"
    hi = ("CASE WHEN NOT (l_linestatus = 'O' AND l_returnflag = 'N') "
          "THEN CAST(floor(l_extendedprice) AS INTEGER) END")
    return f"""WITH b0 AS (SELECT l_orderkey, l_linenumber, {lo} AS lo, {hi} AS hi FROM lineitem),
    b AS (SELECT l_orderkey, l_linenumber,
                 CASE WHEN lo IS NOT NULL AND hi IS NOT NULL AND lo > hi THEN hi ELSE lo END AS sal_min,
                 CASE WHEN lo IS NOT NULL AND hi IS NOT NULL AND lo > hi THEN lo ELSE hi END AS sal_max
          FROM b0)"""


def _exp_text() -> str:
    m = "CAST(p_size % 12 AS VARCHAR)"
    return (f"(CASE WHEN p_size % 12 = 11 THEN NULL "
            f"WHEN p_type = 'LARGE' THEN 'more_than_' || {m} || '_years' "
            f"WHEN p_type = 'SMALL' THEN 'less_than_' || {m} || '_years' "
            f"WHEN p_type = 'PROMO' THEN 'Expert ' || p_brand "
            f"ELSE {m} || '_to_' || CAST(p_size % 12 + 2 AS VARCHAR) || '_years' END)")


def _with_phone() -> str:
    return ("text || ' Tel 0' || CAST(doc_id % 9 + 1 AS VARCHAR) || ' ' || "
            "lpad(CAST(doc_id % 100 AS VARCHAR), 2, '0') || '.34.56.78'")


def _twin_sql() -> str:
    tk = S.tokens("text")
    j = S.jaccard("a.toks", "b.toks")
    # Brute force over all ordered pairs, split by the rule that can fire:
    # same company slug or same city slug with Jaccard >= 0.6, or any pair
    # with Jaccard >= 0.85.  Each branch adds the size bound its threshold
    # implies (t|a| <= |b| and t|b| <= |a|).
    band6 = "3 * a.n <= 5 * b.n AND 3 * b.n <= 5 * a.n"
    band85 = "17 * a.n <= 20 * b.n AND 17 * b.n <= 20 * a.n"
    return f"""WITH t AS (SELECT doc_id, source, lang, {tk} AS toks, {S.slug('source')} AS cs,
                        {S.slug('lang')} AS ls FROM documents),
    t2 AS (SELECT *, len(toks) AS n FROM t WHERE len(toks) > 0)
    SELECT a.doc_id FROM t2 a JOIN t2 b ON a.doc_id <> b.doc_id AND a.cs = b.cs AND {band6}
      WHERE a.source IS NOT NULL AND a.source <> '' AND {j} >= 0.6
    UNION
    SELECT a.doc_id FROM t2 a JOIN t2 b ON a.doc_id <> b.doc_id AND a.ls = b.ls AND {band6}
      WHERE a.lang IS NOT NULL AND a.lang <> '' AND {j} >= 0.6
    UNION
    SELECT a.doc_id FROM t2 a JOIN t2 b ON a.doc_id <> b.doc_id AND {band85}
      WHERE {j} >= 0.85"""


def oracle_sql() -> dict[str, str]:
    completeness = " UNION ALL ".join(
        f"SELECT {q(n)} AS champ, count(*) FILTER (WHERE {c}) AS rempli, count(*) AS total, "
        f"round(100.0 * count(*) FILTER (WHERE {c}) / count(*), 1) AS pct "
        f"FROM documents LEFT JOIN labels USING (doc_id)"
        for n, c in C.COMPLETENESS_FIELDS)
    geo_cities = ", ".join(f"({i}, {'NULL' if c is None else q(c)})" for i, c in enumerate(C.NATION_CITIES))
    slug_city = S.slug("city")
    sal_text = _salary_text()
    base = ("CAST(floor(o_totalprice / (CASE o_orderpriority WHEN '1-URGENT' THEN 10 WHEN '2-HIGH' THEN 100 "
            "WHEN '3-MEDIUM' THEN 1000 ELSE 10000 END)) AS BIGINT)")
    smin = (f"(CASE o_orderstatus WHEN 'F' THEN CAST({base} AS VARCHAR) "
            f"WHEN 'O' THEN (CASE WHEN {base} >= 1000 THEN CAST({base} // 1000 AS VARCHAR) || ' ' || "
            f"lpad(CAST({base} % 1000 AS VARCHAR), 3, '0') ELSE CAST({base} AS VARCHAR) END) "
            f"ELSE CAST({base} AS VARCHAR) || ',5' END)")
    smax = f"(CASE WHEN o_orderpriority <> '3-MEDIUM' THEN CAST(({base} * 5) // 4 AS VARCHAR) END)"
    sper = ("(CASE o_orderpriority WHEN '1-URGENT' THEN 'yearly' WHEN '2-HIGH' THEN 'monthly' "
            "WHEN '3-MEDIUM' THEN 'daily' WHEN '4-NOT SPECIFIED' THEN 'hourly' END)")
    scur = "(CASE WHEN o_custkey % 3 = 0 THEN 'USD' ELSE 'EUR' END)"
    ann_lo, ann_hi = _annual(S.to_number("salMin"), S.to_number("salMax"), "salPer", "salCur")
    rej_lo, _ = _annual("pmin", "pmax", "pper", "'EUR'")
    rel = ("(CASE o_orderpriority WHEN '1-URGENT' THEN 'il y a ' || CAST(o_orderkey % 45 AS VARCHAR) || ' jours' "
           "WHEN '2-HIGH' THEN 'Il y a 30+ jours' WHEN '3-MEDIUM' THEN 'Publié à l''instant' "
           "WHEN '4-NOT SPECIFIED' THEN 'il y a ' || CAST(o_orderkey % 23 AS VARCHAR) || ' heures' "
           "ELSE 'Offre publiée il y a plus de 30 jours' END)")
    days = f"regexp_extract(r, '(?i)il y a ([{S.D}]+)\\+?[{S.WS}]*jour', 1)"
    hours = f"regexp_matches(r, '(?i)il y a ([{S.D}]+)\\+?[{S.WS}]*heure')"
    recent = "regexp_matches(r, '(?i)instant|aujourd''hui|moins de|24 heures')"
    oe, le = C.ORDER_EXPECTED, C.LINE_EXPECTED
    enum = ", ".join(q(v) for v in C.CUSTOMER_CONTRACT[4]["enum"])

    return {
        "box_plot_by_segment": """
            SELECT c_mktsegment AS segment, count(*) AS n,
                   round(median(o_totalprice)) AS median,
                   round(quantile_cont(o_totalprice, 0.25)) AS q1,
                   round(quantile_cont(o_totalprice, 0.75)) AS q3,
                   round(min(o_totalprice)) AS mini, round(max(o_totalprice)) AS maxi
            FROM orders LEFT JOIN customer ON o_custkey = c_custkey
            WHERE o_totalprice IS NOT NULL
            GROUP BY 1 HAVING count(*) >= 5 ORDER BY median DESC""",
        "box_plot_min_n": """
            SELECT l_returnflag AS grp, count(*) AS n,
                   round(median(l_extendedprice)) AS median,
                   round(quantile_cont(l_extendedprice, 0.25)) AS q1,
                   round(quantile_cont(l_extendedprice, 0.75)) AS q3
            FROM lineitem WHERE l_extendedprice IS NOT NULL
            GROUP BY 1 HAVING count(*) >= 8 ORDER BY median DESC""",
        "kpi_card": """
            WITH f AS (SELECT * FROM orders LEFT JOIN customer ON o_custkey = c_custkey
                       WHERE o_orderstatus <> 'P')
            SELECT (SELECT count(*) FROM f) AS n_offres,
                   (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') AS n_f,
                   (SELECT count(*) FROM orders WHERE o_orderstatus = 'O') AS n_o,
                   (SELECT count(*) FROM orders WHERE o_orderstatus = 'P') AS n_excluded,
                   (SELECT count(*) FROM f WHERE o_orderpriority = '1-URGENT') AS n_urgent,
                   (SELECT round(100.0 * count(*) FILTER (WHERE o_orderpriority = '1-URGENT') / count(*), 1) FROM f)
                       AS pct_urgent,
                   (SELECT count(DISTINCT o_custkey) FROM f WHERE o_custkey IS NOT NULL) AS n_clients,
                   (SELECT count(DISTINCT c_mktsegment) FROM f WHERE c_mktsegment IS NOT NULL) AS n_segments,
                   (SELECT count(*) FROM f WHERE c_mktsegment = 'BUILDING') AS n_building,
                   (SELECT round(median(o_totalprice)) FROM f WHERE o_orderpriority = '1-URGENT') AS prix_median,
                   (SELECT round(quantile_cont(o_totalprice, 0.25)) FROM f WHERE o_orderpriority = '1-URGENT')
                       AS prix_q1,
                   (SELECT round(quantile_cont(o_totalprice, 0.75)) FROM f WHERE o_orderpriority = '1-URGENT')
                       AS prix_q3""",
        "completeness_scorecard": completeness + " ORDER BY pct DESC",
        "count_by_key": "SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1 ORDER BY n DESC",
        "count_by_key_nonnull": """
            SELECT quality, count(*) AS n FROM documents LEFT JOIN labels USING (doc_id)
            WHERE quality IS NOT NULL GROUP BY 1 ORDER BY n DESC""",
        "tension_matrix": """
            SELECT c_mktsegment AS segment, o_orderpriority AS priority, count(*) AS n
            FROM orders LEFT JOIN customer ON o_custkey = c_custkey
            WHERE c_mktsegment IS NOT NULL AND o_orderpriority NOT IN ('4-NOT SPECIFIED', '5-LOW')
            GROUP BY 1, 2""",
        "month_series": """
            SELECT strftime(o_orderdate, '%Y-%m') AS mois, count(*) AS n FROM orders
            WHERE o_orderdate IS NOT NULL GROUP BY 1 ORDER BY 1""",
        "top_terms": f"""
            SELECT term, count(*) AS n FROM (SELECT unnest({S.tokens('text')}) AS term FROM documents)
            GROUP BY term ORDER BY n DESC, term LIMIT 30""",
        "top_skills": f"""
            SELECT competence, count(*) AS n
            FROM (SELECT unnest({S.skills_list('text')}) AS competence FROM documents)
            WHERE competence IS NOT NULL GROUP BY 1 ORDER BY n DESC, competence LIMIT 30""",
        "top_k_cities_like": """
            SELECT n_name AS ville, any_value(n_regionkey) AS region, count(*) AS n
            FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
            WHERE n_name IS NOT NULL GROUP BY n_name ORDER BY n DESC, ville LIMIT 20""",
        "any_value_bool_or": """
            SELECT row_number() OVER (ORDER BY c_nationkey) AS lieu_key, c_nationkey,
                   any_value(n_name) AS n_name, bool_or(c_acctbal < 0) AS has_negative
            FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
            WHERE c_nationkey IS NOT NULL GROUP BY c_nationkey""",
        "distinct_dim_key": """
            SELECT row_number() OVER (ORDER BY p_brand) AS brand_key, p_brand
            FROM (SELECT DISTINCT p_brand FROM part WHERE p_brand IS NOT NULL)""",
        "date_dim": """
            SELECT row_number() OVER (ORDER BY d) AS date_key, d AS jour, strftime(d, '%Y-%m') AS mois,
                   year(d) AS annee
            FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderdate IS NOT NULL)""",
        "star_fact": """
            WITH s AS (SELECT s_suppkey, n_name AS s_nation FROM supplier
                       LEFT JOIN nation ON s_nationkey = n_nationkey),
            li AS (SELECT l_orderkey, l_linenumber, l_extendedprice, p_brand, p_type, s_nation
                   FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
                   LEFT JOIN s ON l_suppkey = s_suppkey),
            db AS (SELECT row_number() OVER (ORDER BY p_brand) AS brand_key, p_brand
                   FROM (SELECT DISTINCT p_brand FROM part WHERE p_brand IS NOT NULL)),
            dt AS (SELECT row_number() OVER (ORDER BY p_type) AS type_key, p_type
                   FROM (SELECT DISTINCT p_type FROM part WHERE p_type IS NOT NULL)),
            dn AS (SELECT row_number() OVER (ORDER BY s_nation) AS nation_key, s_nation
                   FROM (SELECT DISTINCT s_nation FROM s WHERE s_nation IS NOT NULL))
            SELECT l_orderkey, l_linenumber, l_extendedprice, brand_key, type_key, nation_key
            FROM li LEFT JOIN db USING (p_brand) LEFT JOIN dt USING (p_type) LEFT JOIN dn USING (s_nation)""",
        "fk_violations": """
            SELECT o_orderkey, o_custkey FROM orders o
            WHERE o_custkey IS NOT NULL AND NOT EXISTS (
                SELECT 1 FROM customer c WHERE c.c_mktsegment <> 'BUILDING' AND c.c_custkey = o.o_custkey)""",
        "not_null_unique_accepted": """
            SELECT 'not_null' AS rule, 'events.event_id' AS field,
                   count(*) FILTER (WHERE event_id IS NULL) AS violations FROM events
            UNION ALL SELECT 'not_null', 'events.user_id', count(*) FILTER (WHERE user_id IS NULL) FROM events
            UNION ALL SELECT 'accepted_values', 'events.event_type', count(*) FILTER (
                WHERE event_type IS NOT NULL AND event_type NOT IN ('view', 'click', 'purchase', 'signup')) FROM events
            UNION ALL SELECT 'accepted_values', 'lineitem.l_returnflag', count(*) FILTER (
                WHERE l_returnflag IS NOT NULL AND l_returnflag NOT IN ('A', 'N', 'R')) FROM lineitem
            UNION ALL SELECT 'unique', 'events.event_id', count(*) FROM (
                SELECT event_id FROM events WHERE event_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1)
            UNION ALL SELECT 'unique', 'lineitem.l_orderkey,l_linenumber', count(*) FROM (
                SELECT l_orderkey, l_linenumber FROM lineitem
                WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1)""",
        "reference_count_checks": f"""
            WITH checks AS (
                SELECT 'orders_total' AS verif, (SELECT count(*) FROM orders) AS obtenu,
                       CAST({oe['orders_total']} AS BIGINT) AS attendu
                UNION ALL SELECT 'orders_f', (SELECT count(*) FROM orders WHERE o_orderstatus = 'F'), {oe['orders_f']}
                UNION ALL SELECT 'orders_o', (SELECT count(*) FROM orders WHERE o_orderstatus = 'O'), {oe['orders_o']}
                UNION ALL SELECT 'orders_urgent', (SELECT count(*) FROM orders WHERE o_orderpriority = '1-URGENT'),
                                 {oe['orders_urgent']}
                UNION ALL SELECT 'orders_high', (SELECT count(*) FROM orders WHERE o_orderpriority = '2-HIGH'),
                                 {oe['orders_high']}
                UNION ALL SELECT 'orders_expensive', (SELECT count(*) FROM orders WHERE o_totalprice > 300000),
                                 {oe['orders_expensive']}
                UNION ALL SELECT 'orderkey_duplicates',
                                 (SELECT count(*) - count(DISTINCT o_orderkey) FROM orders WHERE o_orderkey IS NOT NULL),
                                 {oe['orderkey_duplicates']}
                UNION ALL SELECT 'lineitem_total', (SELECT count(*) FROM lineitem), {le['lineitem_total']}
                UNION ALL SELECT 'lineitem_returned', (SELECT count(*) FROM lineitem WHERE l_returnflag = 'R'),
                                 {le['lineitem_returned']})
            SELECT * FROM checks WHERE obtenu <> attendu""",
        "contract_check": f"""
            WITH v AS (
                SELECT 'type' AS rule, 'c_acctbal' AS field, CAST(1 AS BIGINT) AS violations
                UNION ALL SELECT 'missing', 'c_phone', 1
                UNION ALL SELECT 'not_null', 'c_custkey', count(*) FILTER (WHERE c_custkey IS NULL) FROM customer
                UNION ALL SELECT 'not_null', 'c_name', count(*) FILTER (WHERE c_name IS NULL) FROM customer
                UNION ALL SELECT 'not_null', 'c_nationkey', count(*) FILTER (WHERE c_nationkey IS NULL) FROM customer
                UNION ALL SELECT 'not_null', 'c_mktsegment', count(*) FILTER (WHERE c_mktsegment IS NULL) FROM customer
                UNION ALL SELECT 'enum', 'c_mktsegment',
                          count(*) FILTER (WHERE c_mktsegment IS NOT NULL AND c_mktsegment NOT IN ({enum})) FROM customer
                UNION ALL SELECT 'unique', 'c_custkey', CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM (
                    SELECT c_custkey, count(*) AS n FROM customer WHERE c_custkey IS NOT NULL
                    GROUP BY 1 HAVING count(*) > 1))
            SELECT * FROM v WHERE violations > 0""",
        "range_repair": _bounds() + """
            SELECT l_orderkey, l_linenumber, sal_min, sal_max, sal_min IS NOT NULL AS has_salary FROM b""",
        "midpoint": _bounds() + """
            SELECT l_orderkey, l_linenumber,
                   CASE WHEN sal_min IS NOT NULL
                        THEN round((CAST(coalesce(sal_min, sal_max) AS DOUBLE)
                                    + CAST(coalesce(sal_max, sal_min) AS DOUBLE)) / 2.0) END AS sal_mid
            FROM b""",
        "bucket_case": f"""
            SELECT p_partkey, experience, {S.exp_bucket('experience')} AS exp_bucket
            FROM (SELECT p_partkey, {_exp_text()} AS experience FROM part)""",
        "validity_filter": """
            SELECT * FROM (
                SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 'Indeed' ELSE 'WTTJ' END AS source,
                       CASE o_orderpriority WHEN '5-LOW' THEN NULL WHEN '4-NOT SPECIFIED' THEN 404 ELSE 200 END
                           AS status,
                       o_orderpriority = '1-URGENT' AS is_twin
                FROM orders)
            WHERE (source = 'Indeed' AND NOT is_twin) OR (source = 'WTTJ' AND status = 200)""",
        "blank_to_null": f"SELECT doc_id, {S.blank_to_null('v')} AS v FROM (SELECT doc_id, {_blanks()} AS v FROM documents)",
        "falsy_default": (f"SELECT doc_id, {S.falsy_default('v', 'Non précisé')} AS v "
                          f"FROM (SELECT doc_id, {_blanks()} AS v FROM documents)"),
        "accent_fold": f"SELECT doc_id, {S.fold('text')} AS folded FROM documents",
        "slug": f"SELECT doc_id, {S.slug('text')} AS slug FROM documents",
        "geo_lookup": f"""
            WITH c AS (SELECT c_custkey, city FROM customer
                       LEFT JOIN (VALUES {geo_cities}) AS nc(nk, city) ON c_nationkey = nk),
            s AS (SELECT c_custkey, city, {slug_city} AS sl FROM c)
            SELECT c_custkey, city,
                   CASE WHEN geo_dept IS NOT NULL THEN geo_dept WHEN sl <> '' THEN 'Hors référentiel'
                        ELSE 'Non précisé' END AS departement,
                   geo_dept IS NOT NULL AS is_idf
            FROM s LEFT JOIN {S.geo_values()} ON sl = geo_slug""",
        "salary_parse": f"""
            WITH s0 AS (SELECT o_orderkey, {sal_text} AS sal_text FROM orders), {_parsed_salary_cte('sal_text')}
            SELECT o_orderkey, sal_text, pmin AS sal_min, pmax AS sal_max, pper AS sal_period FROM s2""",
        "salary_annualise": f"""
            WITH s AS (SELECT o_orderkey, {smin} AS salMin, {smax} AS salMax, {sper} AS salPer, {scur} AS salCur
                       FROM orders)
            SELECT o_orderkey, {ann_lo} AS sal_min_eur, {ann_hi} AS sal_max_eur FROM s""",
        "salary_rejects": f"""
            WITH s0 AS (SELECT o_orderkey, {sal_text} AS salary_raw FROM orders), {_parsed_salary_cte('salary_raw')},
            s3 AS (SELECT o_orderkey, salary_raw, pmin, {rej_lo} AS lo FROM s2)
            SELECT 'IND_' || CAST(o_orderkey AS VARCHAR) AS offer_id, salary_raw,
                   CASE WHEN pmin IS NULL THEN 'non parsé' ELSE 'hors plage plausible après annualisation' END
                       AS reason,
                   {q(C.RUN_DATE)} AS run_date
            FROM s3 WHERE salary_raw IS NOT NULL AND salary_raw <> '' AND lo IS NULL""",
        "absolute_date": f"""
            WITH r AS (SELECT event_id,
                              CASE event_type WHEN 'click' THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
                                   WHEN 'view' THEN strftime(ts, '%Y-%m-%d') WHEN 'error' THEN 'hier'
                                   WHEN 'signup' THEN NULL ELSE '' END AS r FROM events)
            SELECT event_id,
                   CASE WHEN regexp_matches(r, '^[{S.D}]{{4}}-[{S.D}]{{2}}-[{S.D}]{{2}}') THEN substr(r, 1, 10) END
                       AS posted_date,
                   coalesce(regexp_matches(r, '^[{S.D}]{{4}}-[{S.D}]{{2}}-[{S.D}]{{2}}'), false) AS date_is_precise
            FROM r""",
        "relative_date": f"""
            WITH x AS (SELECT o_orderkey, {rel} AS r FROM orders)
            SELECT o_orderkey,
                   CASE WHEN r IS NULL OR r = '' THEN NULL
                        WHEN {recent} THEN {q(C.RUN_DATE)}
                        WHEN {days} <> '' THEN CAST(DATE {q(C.RUN_DATE)} - CAST({days} AS INTEGER) AS VARCHAR)
                        WHEN {hours} THEN {q(C.RUN_DATE)} END AS posted_date,
                   false AS date_is_precise
            FROM x""",
        "label_map": f"""
            SELECT event_id, {S.remote('r')} AS remote FROM (
                SELECT event_id, CASE event_type WHEN 'view' THEN 'FULL' WHEN 'click' THEN 'partial'
                                 WHEN 'error' THEN '' WHEN 'signup' THEN NULL ELSE event_type END AS r FROM events)""",
        "contract_infer": """
            SELECT event_id,
                   CASE WHEN contains(lower(array_to_string(
                        [event_type, CASE WHEN value > 50 THEN 'Stage de fin d''études' ELSE 'CDD' END], '|')), 'stage')
                        THEN 'Stage' ELSE 'Non précisé' END AS contract
            FROM events""",
        "url_segment": """
            SELECT page_id, CASE WHEN url IS NULL OR url = '' THEN NULL
                                 ELSE nullif(regexp_extract(url, '/en/([^/]+)', 1), '') END AS segment
            FROM pages""",
        "json_field": "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events",
        "pii_redact": f"SELECT doc_id, {S.redact('t')} AS redacted FROM (SELECT doc_id, {_with_phone()} AS t FROM documents)",
        "title_tokens": f"""
            SELECT item_id, array_to_string(toks, ' ') AS tokens, len(toks) AS n_tokens
            FROM (SELECT item_id, {S.tokens('text')} AS toks FROM benchmark)""",
        "jaccard_pairs": f"""
            WITH c AS (SELECT conv_id, turn, {S.tokens('text')} AS toks FROM conversations)
            SELECT a.conv_id, a.turn, {S.jaccard('a.toks', 'b.toks')} AS j
            FROM c a JOIN c b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1""",
        "fuzzy_twins": _twin_sql(),
        "twin_flag": f"""
            WITH t AS (SELECT DISTINCT regexp_replace(url, '[?#].*$', '') AS twin_url FROM pages
                       WHERE regexp_matches(url, {q(C.TWIN_HOSTS)}))
            SELECT page_id, url, (url IS NOT NULL AND url <> '' AND twin_url IS NOT NULL) AS is_twin
            FROM pages LEFT JOIN t ON url = twin_url""",
        "union_feeds": """
            SELECT 'C_' || CAST(c_custkey AS VARCHAR) AS entity_id, c_name AS name, c_nationkey AS nation,
                   c_acctbal AS balance, 'customer' AS kind, c_mktsegment AS segment FROM customer
            UNION ALL
            SELECT 'S_' || CAST(s_suppkey AS VARCHAR), s_name, s_nationkey, s_acctbal, 'supplier', NULL FROM supplier""",
        "search_offers": """
            SELECT o_orderkey AS offer_id, o_orderstatus AS departement, o_orderpriority AS contract,
                   o_totalprice > 100000 AS has_salary, o_totalprice
            FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' AND o_totalprice > 100000
            ORDER BY o_orderkey LIMIT 50""",
        "run_stats": f"""
            SELECT {q(C.RUN_DATE)} AS run_date, count(*) AS n_total,
                   count(*) FILTER (WHERE o_orderstatus = 'F') AS n_wttj,
                   count(*) FILTER (WHERE o_orderstatus = 'O') AS n_indeed,
                   count(*) FILTER (WHERE o_orderstatus = 'O' AND o_orderpriority = '1-URGENT') AS n_twins_indeed,
                   count(*) FILTER (WHERE o_totalprice > 200000) AS n_salary,
                   coalesce(round(100.0 * count(*) FILTER (WHERE o_totalprice > 200000) / nullif(count(*), 0), 1), 0.0)
                       AS pct_salary,
                   count(*) FILTER (WHERE o_orderpriority = '5-LOW') AS n_rejects_salaire
            FROM orders""",
        "parquet_scan": """
            SELECT l_orderkey, l_partkey, l_quantity FROM lineitem
            WHERE l_shipdate >= TIMESTAMP '1997-01-01 00:00:00' AND l_quantity > 45""",
        "sample_first_n": f"""
            SELECT doc_id, {S.redact('t')} AS text
            FROM (SELECT doc_id, {_with_phone()} AS t FROM documents ORDER BY doc_id LIMIT {C.SAMPLE_N})""",
    }
