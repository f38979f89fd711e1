"""Posting dates: absolute ISO prefixes and relative French phrases."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from offerlake.functions.text import DIGIT, SPACE

ISO_PREFIX_RE = rf"^[{DIGIT}]{{4}}-[{DIGIT}]{{2}}-[{DIGIT}]{{2}}"
# The relative-date phrases (case-insensitive).
RECENT_RE = r"(?i)instant|aujourd'hui|moins de|24 heures"
DAYS_RE = rf"(?i)il y a ([{DIGIT}]+)\+?[{SPACE}]*jour"
HOURS_RE = rf"(?i)il y a ([{DIGIT}]+)\+?[{SPACE}]*heure"


def absolute_date(v: Column) -> Column:
    """ISO-looking text -> struct<date: first 10 chars, precise: true>, else (null, false)."""
    ok = F.coalesce(v.rlike(ISO_PREFIX_RE), F.lit(False))
    return F.struct(F.when(ok, F.substring(v, 1, 10)).alias("date"), ok.alias("precise"))


def relative_date(v: Column, run_date: str | Column) -> Column:
    """Relative phrase -> struct<date string, precise false>.

    Recent words -> run date; "il y a N jours" -> run date - N; hours -> run
    date; anything else (and null or empty) -> null.  Never precise.
    """
    base = run_date if isinstance(run_date, Column) else F.lit(run_date)
    days = F.regexp_extract(v, DAYS_RE, 1)
    d = (F.when(v.isNull() | (v == ""), F.lit(None).cast("string"))
         .when(v.rlike(RECENT_RE), base)
         .when(days != "", F.date_sub(F.to_date(base), days.try_cast("int")).cast("string"))
         .when(v.rlike(HOURS_RE), base))
    return F.struct(d.alias("date"), F.lit(False).alias("precise"))


def month_of(date_text: Column) -> Column:
    """'yyyy-MM' of a date (or ISO date text)."""
    return F.date_format(F.to_date(date_text), "yyyy-MM")
