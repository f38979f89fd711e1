"""Salary parsing (French free text), numeric coercion and annualisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from offerlake.functions.text import DIGIT, SPACE

# The annualisation assumptions, exchange rate and plausible band.
ANNUAL_MULT = {"yearly": 1, "monthly": 12, "daily": 218, "hourly": 1820}
USD_EUR = 0.92
SALARY_MIN_PLAUSIBLE = 8_000
SALARY_MAX_PLAUSIBLE = 300_000
MIN_AMOUNT = 100  # smaller numbers in free text are hours, short codes...

# Period patterns, tested in this order on lower-cased text.
PERIOD_PATTERNS = (
    ("yearly", r"par an|/an|annuel"),
    ("monthly", r"par mois|mensuel|/mois"),
    ("daily", r"par jour|/jour|tjm"),
    ("hourly", r"de l'heure|par heure|/h(?![\p{L}\p{N}_])"),
)

# The three special spaces replaced by a plain space.
SPECIAL_SPACES = "\u00a0\u202f\u2009"  # no-break, narrow no-break, thin

# One amount: digits, then digits/spaces/dots, then an optional decimal comma.
AMOUNT_RE = rf"[{DIGIT}][{DIGIT} .]*(?:,[{DIGIT}]+)?"

REASON_UNPARSED = "non parsé"
REASON_IMPLAUSIBLE = "hors plage plausible après annualisation"


def detect_period(text: Column) -> Column:
    t = F.lower(text)
    out = F.lit(None).cast("string")
    for label, pat in reversed(PERIOD_PATTERNS):
        out = F.when(t.rlike(pat), F.lit(label)).otherwise(out)
    return out


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` (a lambda binding)."""
    return F.transform(F.array(value), body)[0]


def parse_salary_fr(text: Column) -> Column:
    """Free text -> struct<min double, max double, period string> or null.

    Needs a period; every amount is read, spaces and dots dropped, the comma
    is the decimal point, amounts under 100 are ignored.  Intermediate values
    are bound once so the regexes run once per row.
    """
    def from_text(t: Column) -> Column:
        raw = F.regexp_extract_all(t, F.lit(AMOUNT_RE), 0)
        nums = F.transform(raw, lambda x: F.translate(F.regexp_replace(x, r"[ .]", ""), ",", ".")
                           .try_cast("double"))
        kept = F.filter(nums, lambda v: v.isNotNull() & (v >= MIN_AMOUNT))
        return let(F.struct(detect_period(t).alias("period"), kept.alias("kept")), lambda r: F.when(
            r["period"].isNotNull() & (F.size(r["kept"]) > 0),
            F.struct(F.array_min(r["kept"]).alias("min"), F.array_max(r["kept"]).alias("max"),
                     r["period"].alias("period"))))

    cleaned = F.translate(text, SPECIAL_SPACES, " " * len(SPECIAL_SPACES))
    return F.when(text.isNotNull() & (text != ""), let(cleaned, from_text))


# What counts as a number once separators are normalised: digits with single
# underscores between them, an optional fraction and exponent; no type suffix.
_DIGITS = r"[0-9]+(?:_[0-9]+)*"
NUMBER_RE = rf"^[+-]?(?:(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?|(?i:inf|infinity|nan))$"


def to_number(v: Column) -> Column:
    """Structured amount (number kept as text, or text like "45 000") -> double.

    ASCII spaces are removed, a comma becomes the decimal point and other
    white space at either end falls away; anything that still is not a number
    gives null.
    """
    s = F.translate(F.regexp_replace(v, " ", ""), ",", ".")
    s = F.regexp_replace(s, rf"^[{SPACE}]+|[{SPACE}]+$", "")
    return let(s, lambda t: F.when(t.rlike(NUMBER_RE), F.regexp_replace(t, "_", "").try_cast("double")))


def _annual(v: Column, factor: Column) -> Column:
    return F.when(v.isNotNull() & (v > 0), F.bround(v * factor, 0))


def _plausible(a: Column) -> Column:
    return F.when((a >= SALARY_MIN_PLAUSIBLE) & (a <= SALARY_MAX_PLAUSIBLE), a.cast("int"))


def annualize(min_v: Column, max_v: Column, period: Column, currency: Column) -> Column:
    """(amounts, period, currency) -> struct<lo int, hi int>, yearly EUR.

    Multiplier by period, USD converted, half-even rounding, bounds outside
    the plausible band dropped, and a single surviving bound copied to the
    other side.  Unknown period -> both null.
    """
    mult = F.create_map(*[x for k, m in ANNUAL_MULT.items() for x in (F.lit(k), F.lit(float(m)))])[period]
    rate = F.when(currency == "USD", F.lit(USD_EUR)).otherwise(F.lit(1.0))
    factor = rate * mult

    def pick(r: Column) -> Column:
        a, b = r["a"], r["b"]
        ok = r["f"].isNotNull()
        return F.struct(F.when(ok, F.coalesce(a, b)).alias("lo"), F.when(ok, F.coalesce(b, a)).alias("hi"))

    def step(f):
        return lambda r: F.struct(f(r["a"], r["f"]).alias("a"), f(r["b"], r["f"]).alias("b"), r["f"].alias("f"))

    # Bodies of a binding are interpreted without shared subexpressions: every value that is
    # read more than once is bound.
    given = F.struct(min_v.alias("a"), max_v.alias("b"), factor.alias("f"))
    return let(let(let(given, step(_annual)), step(lambda a, _: _plausible(a))), pick)


def repair_bounds(lo: Column, hi: Column) -> Column:
    """Swap inverted bounds; struct<lo, hi, has_salary>."""
    swap = lo.isNotNull() & hi.isNotNull() & (lo > hi)
    nlo = F.when(swap, hi).otherwise(lo)
    nhi = F.when(swap, lo).otherwise(hi)
    return F.struct(nlo.alias("lo"), nhi.alias("hi"), nlo.isNotNull().alias("has_salary"))


def midpoint(lo: Column, hi: Column, has_salary: Column) -> Column:
    """round((coalesce(lo, hi) + coalesce(hi, lo)) / 2.0) as double, when has_salary."""
    s = F.coalesce(lo, hi).cast("double") + F.coalesce(hi, lo).cast("double")
    return F.when(has_salary, F.round(s / F.lit(2.0), 0))


def reject_reason(raw: Column, parsed: Column, annual_lo: Column) -> Column:
    """Reason a non-empty salary text did not yield an annual amount, or null."""
    bad = raw.isNotNull() & (raw != "") & annual_lo.isNull()
    return F.when(bad, F.when(parsed.isNull(), F.lit(REASON_UNPARSED)).otherwise(F.lit(REASON_IMPLAUSIBLE)))


def salary_from_text(text: Column, currency: Column | str = "EUR") -> Column:
    """Free text -> struct<parsed, lo, hi, reason>: parse, annualise and the
    reject reason in one binding (the text is parsed once per row)."""
    cur = currency if isinstance(currency, Column) else F.lit(currency)

    def finish(p: Column) -> Column:
        a = annualize(p["min"], p["max"], p["period"], cur)
        return let(a, lambda r: F.struct(p.alias("parsed"), r["lo"].alias("lo"), r["hi"].alias("hi"),
                                         reject_reason(text, p, r["lo"]).alias("reason")))

    return let(parse_salary_fr(text), finish)
