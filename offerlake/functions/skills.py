"""Skill extraction with a fixed dictionary of patterns."""

from __future__ import annotations

import functools
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from offerlake.functions.salary import let
from offerlake.functions.text import WORD, fold_accents

# Fixed values: (label, pattern) pairs, matched against the accent-folded,
# lower-cased text and reported in this order.  ``\b`` is a word boundary in
# Python's Unicode sense.
SKILLS = (
    ("Python", r"\bpython\b"),
    ("SQL", r"\bsql\b"),
    ("Java", r"\bjava\b(?!script)"),
    ("Scala", r"\bscala\b"),
    ("Spark", r"\bspark\b"),
    ("Hadoop", r"\bhadoop\b"),
    ("Kafka", r"\bkafka\b"),
    ("Airflow", r"\bairflow\b"),
    ("dbt", r"\bdbt\b"),
    ("Snowflake", r"\bsnowflake\b"),
    ("BigQuery", r"\bbigquery\b"),
    ("Databricks", r"\bdatabricks\b"),
    ("AWS", r"\baws\b"),
    ("Azure", r"\bazure\b"),
    ("GCP", r"\b(gcp|google cloud)\b"),
    ("Docker", r"\bdocker\b"),
    ("Kubernetes", r"\b(kubernetes|k8s)\b"),
    ("Power BI", r"\bpower ?bi\b"),
    ("Tableau", r"\btableau\b"),
    ("Looker", r"\blooker\b"),
    ("Qlik", r"\bqlik\b"),
    ("Excel", r"\bexcel\b"),
    ("ETL", r"\betl\b"),
    ("Machine Learning", r"\bmachine learning\b"),
    ("Deep Learning", r"\bdeep learning\b"),
    ("NLP", r"\bnlp\b|langage naturel"),
    ("LLM", r"\bllm\b"),
    ("RAG", r"\brag\b"),
    ("Computer Vision", r"\bcomputer vision\b|vision par ordinateur"),
    ("PyTorch", r"\bpytorch\b"),
    ("TensorFlow", r"\btensorflow\b"),
    ("scikit-learn", r"\bscikit|sklearn\b"),
    ("Pandas", r"\bpandas\b"),
    ("Power Query", r"\bpower query\b"),
    ("VBA", r"\bvba\b"),
    ("Git", r"\bgit\b"),
    ("Linux", r"\blinux\b"),
    ("Statistiques", r"\bstatisti"),
)

def _spell_boundaries(p: str, lead: str, trail: str) -> str:
    """Replace each ``\\b``: at the start of an alternative it precedes a word
    character (``lead``), anywhere else it follows one (``trail``)."""
    out, i = [], 0
    while i < len(p):
        if p.startswith(r"\b", i):
            out.append(lead if i == 0 or p[i - 1] == "|" else trail)
            i += 2
        else:
            out.append(p[i])
            i += 1
    return "".join(out)


def java_pattern(p: str) -> str:
    """The pattern with ``\\b`` spelled as Python's Unicode word boundary.

    Every boundary in the dictionary sits next to a word character, so it
    reduces to one look-behind (before a word) or one look-ahead (after one).
    """
    return _spell_boundaries(p, rf"(?<![{WORD}])", rf"(?![{WORD}])")


def sql_pattern(p: str) -> str:
    """The same test for engines without look-around (RE2): a leading ``\\b``
    consumes a non-word character or the start, a trailing one a non-word
    character or the end.  ``(?!script)`` is implied by the boundary."""
    return _spell_boundaries(p.replace("(?!script)", ""), rf"(^|[^{WORD}])", rf"([^{WORD}]|$)")


def needles(p: str) -> list[str]:
    """Literal substrings one of which any match of ``p`` must contain.

    Rule: drop boundaries and look-arounds, split into alternatives, keep the
    longest literal run of each (``power ?bi`` -> ``power``).
    """
    core = re.sub(r"\(\?<?[!=][^)]*\)", "", p).replace(r"\b", "")
    if core.startswith("(") and core.endswith(")") and core.count("(") == 1:
        core = core[1:-1]
    alts = re.split(r"\|", core.replace("(", "").replace(")", ""))
    return [max(re.split(r".\?", a), key=len) for a in alts]


def fold(text: Column) -> Column:
    return fold_accents(F.coalesce(text, F.lit("")))


def _alternatives(p: str) -> list[str]:
    """The pattern's alternatives, its boundaries dealt out to those of a group."""
    if m := re.fullmatch(r"\\b\((.*)\)\\b", p):
        return [rf"\b{a}\b" for a in m[1].split("|")]
    return p.replace("(?!script)", "").split("|")                 # implied by the boundary before it


def words(p: str) -> list[str]:
    """The alternatives that are one word between boundaries: such a one matches where the
    word is one of the text's words."""
    return [m[1] for a in _alternatives(p) if (m := re.fullmatch(r"\\b([a-z0-9]+)\\b", a))]


def found(norm: str | Column) -> Column:
    """Labels whose pattern occurs in folded text, dictionary order; [] if there is none.

    The text is split into words once, and whole words are looked up among them.  The regex of
    any other alternative only runs on rows that contain its literal needle (a plain substring
    search).  ``norm`` is read many times: it should be a stored or projected column.
    """
    c = F.col(norm) if isinstance(norm, str) else norm
    keys, others = {}, []                                          # in dictionary order
    for label, p in SKILLS:
        keys |= {w: label for w in words(p)}
        rest = [n for n, a in zip(needles(p), _alternatives(p), strict=True) if not words(a)]
        if rest:
            mark = f"#{label}"                                     # no word: words hold no such character
            keys[mark] = label
            has = functools.reduce(lambda x, y: x | y, [c.contains(n) for n in rest])
            others.append(F.when(has & c.rlike(java_pattern(p)), F.lit(mark)))
    known = F.array(*[F.lit(k) for k in keys])
    hits = F.array_intersect(known, F.concat(F.split(c, f"[^{WORD}]+"), F.array(*others)))      # keeps the order of ``known``
    label_of = F.create_map(*[F.lit(x) for k, v in keys.items() for x in (k, v)])
    return F.coalesce(F.array_distinct(F.transform(hits, lambda k: label_of[k])), F.array().cast("array<string>"))


def extract_skills(text: Column) -> Column:
    """``found`` in the folded text, which is bound once; [] for null/empty."""
    return let(fold(text), found)
