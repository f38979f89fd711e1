"""Text normalisation: accent folding, slugs, title tokens, blanks, redaction.

All functions take and return ``Column`` objects built from Spark's built-in
functions; no Python runs on the data.
"""

from __future__ import annotations

import functools
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Character classes written out so Java's regex engine matches Python's
# ``str`` semantics exactly (Python's \w, \s and \d are Unicode-wide).
WORD = r"\p{L}\p{N}_"             # Python \w == isalnum() or '_'
SPACE = r"\t\n\x0B\f\r\x1C-\x1F\x85\p{Z}"   # Python str.isspace()
DIGIT = r"\p{Nd}"                  # Python \d
BLANK_RE = rf"^[{SPACE}]*$"

# Title stop-words and the minimum token length (length > 1).
STOP_WORDS = ("de", "la", "le", "les", "des", "et", "en", "du", "un", "une", "h", "f", "x")

# Contact-data patterns and their replacements, e-mail first.
EMAIL_RE = rf"[{WORD}.+-]+@[{WORD}-]+\.[{WORD}.-]+"
PHONE_RE = rf"(?<![{WORD}])(?:\+33|0)[{SPACE}]*[{DIGIT}](?:[{SPACE}.\-]?[{DIGIT}]{{2}}){{4}}(?![{DIGIT}])"


@functools.lru_cache(maxsize=1)
def fold_tables() -> tuple[str, str, dict[str, str]]:
    """Tables for "NFD, then drop non-spacing marks", made by rule from ``unicodedata``
    over all of Unicode: ``translate`` arguments for the code points that become one
    character or vanish, and those that become several.  Hangul syllables are left out;
    they are decomposed by arithmetic."""
    src, dst, dele, several = [], [], [], {}
    for cp in range(0x110000):
        ch = chr(cp)
        if 0xD800 <= cp <= 0xDFFF or 0xAC00 <= cp <= 0xD7A3:
            continue
        out = "".join(c for c in unicodedata.normalize("NFD", ch)
                      if unicodedata.category(c) != "Mn")
        if out == ch:
            continue
        if out == "":
            dele.append(ch)
        elif len(out) == 1:
            src.append(ch)
            dst.append(out)
        else:
            several[ch] = out
    # translate(): characters of `src` beyond the length of `dst` are deleted.
    return "".join(src + dele), "".join(dst), several


def _jamo(c: Column) -> Column:
    """One Hangul syllable as its two or three letters."""
    n = F.ascii(c) - 0xAC00
    unit = lambda x: F.lpad(F.hex(x), 4, "0")
    tail = n % 28
    parts = F.concat(unit(F.lit(0x1100) + F.floor(n / 588)),
                     unit(F.lit(0x1161) + F.floor((n % 588) / 28)),
                     F.when(tail > 0, unit(F.lit(0x11A7) + tail)).otherwise(F.lit("")))
    return F.decode(F.unhex(parts), "UTF-16BE")


def strip_accents(c: Column) -> Column:
    """Canonical decomposition without non-spacing marks, for any Unicode text."""
    src, dst, several = fold_tables()
    rare = c
    for ch, out in several.items():
        rare = F.replace(rare, F.lit(ch), F.lit(out))
    rare = F.array_join(F.transform(F.split(rare, ""), lambda x: F.when(x.between("\uac00", "\ud7a3"), _jamo(x)).otherwise(x)), "")
    # Characters that become several are rare: only their rows take the long way, and only
    # rows with a character as high as the lowest of them are searched for one.
    high = c.rlike(f"[{min(several)}-\U0010ffff]")
    some = F.when(high, c.rlike("[\uac00-\ud7a3" + "".join(several) + "]")).otherwise(False)
    return F.translate(F.when(some, rare).otherwise(c), src, dst)


def fold_accents(c: Column) -> Column:
    """Lower-case and strip combining accents (``é`` -> ``e``)."""
    low = F.lower(c)
    return F.when(F.octet_length(c) == F.length(c), low).otherwise(strip_accents(low))      # ASCII has no accents


def slug(c: Column) -> Column:
    """Folded text, runs of non-alphanumerics -> '-', dashes trimmed; null -> ''."""
    s = F.regexp_replace(fold_accents(c), r"[^\p{L}\p{N}]+", "-")
    s = F.regexp_replace(s, r"^-+|-+$", "")
    return F.coalesce(s, F.lit(""))


def title_tokens(c: Column) -> Column:
    """Distinct ``[a-z0-9]+`` tokens of the folded text, stop-words and
    one-letter tokens removed, sorted; null or empty text -> empty array."""
    # Runs of [a-z0-9] are the pieces between runs of anything else; the
    # empty pieces at either end fall to the length filter.
    toks = F.split(fold_accents(c), "[^a-z0-9]+")
    kept = F.filter(toks, lambda t: (F.length(t) > 1) & ~t.isin(list(STOP_WORDS)))
    return F.coalesce(F.sort_array(F.array_distinct(kept)), F.array().cast("array<string>"))


def jaccard(a: Column, b: Column) -> Column:
    """|a ∩ b| / |a ∪ b| on distinct arrays; 0.0 when either side is empty."""
    inter = F.size(F.array_intersect(a, b))
    union = F.size(F.array_union(a, b))
    return (F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0))
            .otherwise(inter.cast("double") / union.cast("double")))


def blank_to_null(c: Column) -> Column:
    """A value made only of whitespace becomes null; others are not trimmed."""
    return F.when(~c.rlike(BLANK_RE), c)


def falsy_default(c: Column, default: str | Column) -> Column:
    """``c or default``: null and the empty string both take the default."""
    d = default if isinstance(default, Column) else F.lit(default)
    return F.when(c.isNull() | (c == ""), d).otherwise(c)


def redact_contacts(c: Column) -> Column:
    """E-mail addresses -> ``[email]``, then French phone numbers -> ``[tel]``."""
    return F.regexp_replace(F.regexp_replace(c, EMAIL_RE, "[email]"), PHONE_RE, "[tel]")


def url_segment(url: Column, marker: str = "/companies/") -> Column:
    """The path segment following ``marker`` in a URL, or null."""
    seg = F.regexp_extract(url, rf"{_quote(marker)}([^/]+)", 1)
    return F.when(url.isNull() | (url == ""), F.lit(None).cast("string")).otherwise(F.nullif(seg, F.lit("")))


def _quote(s: str) -> str:
    return "".join("\\" + ch if not ch.isalnum() else ch for ch in s)


def redact_json(raw: Column) -> Column:
    """``redact_contacts`` on every string value of a JSON text, however nested; keys, numbers
    and all other text stay as they are.

    Control characters cannot stand in a JSON text's strings, so two of them stand for the escapes of a
    backslash and of a quote while strings are told from the rest.  A string is decoded,
    redacted and, only where that changes it, encoded anew.
    """
    marked = F.replace(F.replace(raw, F.lit("\\\\"), F.lit("\x02")), F.lit('\\"'), F.lit("\x01"))
    tokens = F.regexp_extract_all(marked, F.lit(r'"[^"]*+"(?:[ \t\r\n]*+:)?|[^"]++'), F.lit(0))

    def token(t: Column) -> Column:
        plain = F.replace(F.replace(t, F.lit("\x01"), F.lit('\\"')), F.lit("\x02"), F.lit("\\\\"))
        value = F.from_json(F.concat(F.lit("["), plain, F.lit("]")), "array<string>")[0]
        clean = redact_contacts(value)
        again = F.to_json(F.array(clean))
        return (F.when(~t.startswith('"') | t.endswith(":") | (clean == value), plain)
                 .otherwise(F.substring(again, F.lit(2), F.length(again) - 2)))

    return F.array_join(F.transform(tokens, token), "")
