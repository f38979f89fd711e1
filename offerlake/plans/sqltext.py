"""SQL spellings (DuckDB dialect) of the library's column functions.

Used only to write the independent oracle queries that check the Spark
plans; they are generated from the same fixed values as the Spark code.
"""

from __future__ import annotations

from offerlake.functions import geo, labels, salary, skills, text

W = r"\p{L}\p{N}_"
WS = r"\t\n\x0B\f\r\x1C-\x1F\x{85}\p{Z}"
D = r"\p{Nd}"


def q(s: str) -> str:
    """A SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def fold(x: str) -> str:
    return f"strip_accents(lower({x}))"


def slug(x: str) -> str:
    return (f"coalesce(trim(regexp_replace({fold(x)}, '[^\\p{{L}}\\p{{N}}]+', '-', 'g'), '-'), '')")


def tokens(x: str) -> str:
    stop = ", ".join(q(w) for w in text.STOP_WORDS)
    return (f"coalesce(list_sort(list_distinct(list_filter(regexp_extract_all({fold(x)}, '[a-z0-9]+'), "
            f"lambda t: length(t) > 1 AND NOT list_contains([{stop}], t)))), [])")


def jaccard(a: str, b: str) -> str:
    inter = f"len(list_intersect({a}, {b}))"
    return (f"(CASE WHEN len({a}) = 0 OR len({b}) = 0 THEN 0.0 "
            f"ELSE {inter}::DOUBLE / (len({a}) + len({b}) - {inter})::DOUBLE END)")


def blank_to_null(x: str) -> str:
    return f"(CASE WHEN regexp_matches({x}, '^[{WS}]*$') THEN NULL ELSE {x} END)"


def falsy_default(x: str, d: str) -> str:
    return f"(CASE WHEN {x} IS NULL OR {x} = '' THEN {q(d)} ELSE {x} END)"


def redact(x: str) -> str:
    email = f"regexp_replace({x}, '[{W}.+-]+@[{W}-]+\\.[{W}.-]+', '[email]', 'g')"
    phone = f"(^|[^{W}])(?:\\+33|0)[{WS}]*{D}(?:[{WS}.\\-]?{D}{{2}}){{4}}([^{D}]|$)"
    once = f"regexp_replace({email}, '{phone}', '\\1[tel]\\2', 'g')"
    # No look-around in RE2: the boundary characters are consumed, so a
    # second pass catches numbers separated by a single character.
    return f"regexp_replace({once}, '{phone}', '\\1[tel]\\2', 'g')"


def skills_list(x: str) -> str:
    norm = fold(f"coalesce({x}, '')")
    items = ", ".join(f"CASE WHEN regexp_matches({norm}, {q(skills.sql_pattern(p))}) THEN {q(lab)} END"
                      for lab, p in skills.SKILLS)
    return f"list_filter([{items}], lambda s: s IS NOT NULL)"


def period(t: str) -> str:
    parts = []
    for label, pat in salary.PERIOD_PATTERNS:
        pat = pat.replace(r"(?![\p{L}\p{N}_])", f"([^{W}]|$)")
        parts.append(f"WHEN regexp_matches(lower({t}), {q(pat)}) THEN {q(label)}")
    return "(CASE " + " ".join(parts) + " END)"


def special_spaces(x: str) -> str:
    out = x
    for ch in salary.SPECIAL_SPACES:
        out = f"replace({out}, chr({ord(ch)}), ' ')"
    return out


def amounts(t: str) -> str:
    raw = f"regexp_extract_all({t}, '[{D}][{D} .]*(?:,[{D}]+)?')"
    conv = f"list_transform({raw}, lambda x: TRY_CAST(replace(replace(replace(x, ' ', ''), '.', ''), ',', '.') AS DOUBLE))"
    return f"list_filter({conv}, lambda v: v IS NOT NULL AND v >= {salary.MIN_AMOUNT})"


def to_number(x: str) -> str:
    return f"TRY_CAST(replace(replace({x}, ' ', ''), ',', '.') AS DOUBLE)"


def mult(p: str) -> str:
    whens = " ".join(f"WHEN {q(k)} THEN {float(m)}::DOUBLE" for k, m in salary.ANNUAL_MULT.items())
    return f"(CASE {p} {whens} END)"


def annual_bound(v: str, factor: str) -> str:
    a = f"(CASE WHEN {v} > 0 THEN round_even({v} * {factor}, 0) END)"
    return (f"(CASE WHEN {a} BETWEEN {salary.SALARY_MIN_PLAUSIBLE} AND {salary.SALARY_MAX_PLAUSIBLE} "
            f"THEN CAST({a} AS INTEGER) END)")


def factor(p: str, cur: str) -> str:
    return f"((CASE WHEN {cur} = 'USD' THEN {salary.USD_EUR}::DOUBLE ELSE 1.0::DOUBLE END) * {mult(p)})"


def remote(x: str) -> str:
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in labels.REMOTE.items())
    return (f"(CASE WHEN {x} IS NULL THEN NULL WHEN lower({x}) IN ({', '.join(q(k) for k in labels.REMOTE)}) "
            f"THEN (CASE lower({x}) {whens} END) WHEN {x} = '' THEN NULL ELSE {x} END)")


def exp_bucket(x: str) -> str:
    whens = " ".join(f"WHEN regexp_matches(lower({x}), {q(p)}) THEN {q(lab)}" for lab, p in labels.EXP_RULES)
    return f"(CASE WHEN {x} IS NULL THEN 'Non précisé' {whens} ELSE 'Autre' END)"


def geo_values() -> str:
    rows = ", ".join(f"({q(s)}, {q(d)})" for s, d in geo.reference_rows())
    return f"(VALUES {rows}) AS ref(geo_slug, geo_dept)"
