"""Personal data replaced by keyed surrogates of the same type, gender, script and format.

Entities: e-mail addresses, telephone numbers, IPv4 addresses, long numbers (cards),
social-security-like numbers, and person names (after a title, or a known given name
followed by a capitalised word).  An entity's canonical form is written as one number in
a mixed radix: every character ranges over its own class (digit, vowel or consonant of its
script), fixed characters stay.  A keyed permutation of that range, conjugate to a cyclic
shift, gives the surrogate, so equal entities get equal surrogates in every document
(coreference), different entities of one format different ones (distinctness), and no
entity stays itself where its range holds two values.  Given names are exchanged inside
the list of their gender and script; card numbers keep a valid check digit if they had
one; IPv4 octets stay in range; national numbers keep the country code; case and
punctuation follow the mention.  Other names never become a listed given name, and gain
or lose no family name's ending, so the ranges of all names are disjoint.

``collisions`` checks the outcome over a whole corpus: entities whose surrogate another
entity has too.  There are none by construction; ``replace`` raises should that ever be
broken, unless told not to look.

Defined results.  A null text stays null, an empty one empty.  Rows that repeat a doc_id
are replaced one by one.  Overlapping detections: the one that begins first, then the
longer, then the type's order in ``TYPES``.  Extra columns are ignored.  Texts are read
whole.
"""

from __future__ import annotations

import functools
import hashlib
import hmac
import math
import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerlake.llm.secret_scan import luhn
from offerlake.llm.spark import arrow_batches

TYPES = ("email", "ip", "phone", "ssn", "number", "name")

# Given names by script and gender, and titles by gender ("" for either).
GIVEN = {
    ("latin", "f"): "anna clara elena emma eva helen ines julia karin laura lucia maria marie martha mary nina nora olga paula rosa sarah sofia susan vera".split(),
    ("latin", "m"): "adam albert andrew anton carlos daniel david felix frank george hans henry hugo jack james jean john jose karl louis lukas martin paul peter".split(),
    ("cyrillic", "f"): "анна вера дарья елена ирина мария нина ольга софия татьяна".split(),
    ("cyrillic", "m"): "алексей андрей борис виктор дмитрий иван николай олег павел сергей".split(),
}
TITLES = {"Mr": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Dr": "", "Prof": "", "Herr": "m", "Frau": "f", "Mme": "f", "Madame": "f", "Monsieur": "m",
          "Señor": "m", "Señora": "f", "г-н": "m", "г-жа": "f"}
ENDINGS = ("ова", "ева", "ина", "ская", "ов", "ев", "ин", "ский", "ova", "ov")
CLASSES = ("0123456789", "aeiouy", "bcdfghjklmnpqrstvwxz", "аеиоуыэюя", "бвгджзклмнпрстфхцчшщ")

_KIND = {c: k for k in CLASSES for c in k}
_GENDER = {n: key for key, names in GIVEN.items() for n in names}
_NAME = r"[^\W\d_][^\W\d_'’-]+"
PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"),
    "ip": re.compile(r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\w]|\.\d)", re.ASCII),
    "phone": re.compile(r"(?<![\w+])(?:\+\d{1,3}[ .-]?(?:\(\d{2,4}\)|\d{2,4})(?:[ .-]?\d{2,4}){2,3}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?!\d)", re.ASCII),
    "ssn": re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])", re.ASCII),
    "number": re.compile(r"(?<!\w)\d(?:[ -]?\d){12,18}(?!\w)", re.ASCII),
}
_AFTER = re.compile(rf"({_NAME})(?:[ ]({_NAME}))?")


def _machine() -> ahocorasick.Automaton:
    """Finds titles and given names (capitalised) in one pass."""
    found = ahocorasick.Automaton()
    for t in TITLES:
        found.add_word(t, ("title", t))
    for n in _GENDER:
        found.add_word(n.capitalize(), ("given", n.capitalize()))
    found.make_automaton()
    return found


def _names(text: str, machine) -> list[tuple[int, int, str]]:
    """Name parts, with the gender the title or the given name tells."""
    out = []
    for last, (what, word) in machine.iter(text):
        lo, hi = last - len(word) + 1, last + 1
        if (lo and (text[lo - 1].isalnum() or text[lo - 1] in "@._-")) or (hi < len(text) and (text[hi].isalnum() or text[hi] in "@_-'’")):
            continue
        if what == "title":
            at = hi + 1 if text[hi:hi + 1] == "." else hi
            m = _AFTER.match(text, at + 1) if text[at:at + 1] == " " else None
            if m and m.group(1)[0].isupper():
                out.append((m.start(1), m.end(1), TITLES[word]))
                if m.group(2) and m.group(2)[0].isupper():
                    out.append((m.start(2), m.end(2), TITLES[word]))
        elif text[hi:hi + 1] == " " and (m := _AFTER.match(text, hi + 1)) and m.group(1)[0].isupper():
            out += [(lo, hi, _GENDER[word.lower()][1]), (m.start(1), m.end(1), _GENDER[word.lower()][1])]
    return out


def find(text: str, machine) -> list[tuple[int, int, str, str]]:
    """(start, end, type, gender) of the entities of a text, not overlapping."""
    found = []
    if "@" in text:
        found += [(*m.span(), "email", "") for m in PATTERNS["email"].finditer(text)]
    if re.search("[0-9]", text):
        for kind in TYPES[1:5]:
            found += [(*m.span(), kind, "") for m in PATTERNS[kind].finditer(text)]
    found += [(a, b, "name", g) for a, b, g in _names(text, machine)]
    found.sort(key=lambda x: (x[0], -x[1], TYPES.index(x[2]), x[3]))
    out, done = [], 0
    for f in found:
        if f[0] >= done:
            out.append(f)
            done = f[1]
    return out


class Keyed:
    """Keyed permutations of ranges of any size."""

    def __init__(self, key: bytes):
        self.key = key

    def _number(self, *parts, below: int) -> int:
        raw = hmac.new(self.key, "|".join(map(str, parts)).encode(), hashlib.sha256).digest()
        while len(raw) * 8 < below.bit_length() + 64:
            raw += hashlib.sha256(raw).digest()
        return int.from_bytes(raw, "big") % below

    def _rounds(self, x: int, size: int, tweak: str, forth: bool) -> int:
        """An alternating Feistel network on [0, size), walking on until back in the range."""
        a = math.isqrt(size - 1) + 1
        b = -(-size // a)
        while True:
            left, right = divmod(x, b)
            for i in (range(6) if forth else range(5, -1, -1)):
                sign = 1 if forth else -1
                if i % 2:
                    right = (right + sign * self._number(tweak, size, i, left, below=b)) % b
                else:
                    left = (left + sign * self._number(tweak, size, i, right, below=a)) % a
            x = left * b + right
            if x < size:
                return x

    def permuted(self, x: int, size: int, tweak: str) -> int:
        """A permutation without fixed points (for two values or more)."""
        if size < 2:
            return x
        shift = 1 + self._number(tweak, size, "shift", below=size - 1)
        while math.gcd(shift, size) > 1:         # one cycle: walking on meets every other value first
            shift += 1
        return self._rounds((self._rounds(x, size, tweak, True) + shift) % size, size, tweak, False)

    def rewritten(self, text: str, tweak: str, spared: int = 0) -> str:
        """Every classed character of a lower-case text, but the first ``spared`` ones, moves
        inside its class; the rest stays."""
        free = [i for i, c in enumerate(text) if c in _KIND][spared:]
        size, x = 1, 0
        for i in free:
            kind = _KIND[text[i]]
            size, x = size * len(kind), x * len(kind) + kind.index(text[i])
        shape = "".join(c if i not in set(free) else str(CLASSES.index(_KIND[c])) for i, c in enumerate(text)) if len(text) < 200 else str(len(text))
        x, out = self.permuted(x, size, f"{tweak}|{shape}"), list(text)
        for i in reversed(free):
            kind = _KIND[text[i]]
            x, d = divmod(x, len(kind))
            out[i] = kind[d]
        return "".join(out)


def canonical(kind: str, text: str) -> str:
    if kind in ("email", "name"):
        return text.lower()
    if kind == "ip":                             # leading zeros name the same address
        return ".".join(str(int(x)) for x in text.split("."))
    digits = re.sub(r"[^0-9]", "", text)
    return digits[-10:] if kind == "phone" and len(digits) > 10 else digits


def _digits(keyed: Keyed, kind: str, digits: str) -> str:
    if kind != "number":
        return keyed.rewritten(digits, kind)
    valid = luhn(digits.encode())
    if valid:                                    # all digits but the check digit move
        body = keyed.rewritten(digits[:-1], "card", spared=1)
        return next(body + c for c in CLASSES[0] if luhn((body + c).encode()))
    out = digits
    while True:                                  # walk on to the next number without a check digit
        out = keyed.rewritten(out, "digits")
        if not luhn(out.encode()):
            return out


def _ending(name: str) -> str:
    return next((e for e in ENDINGS if name.endswith(e) and len(name) > len(e) + 1), "")


def surrogate(keyed: Keyed, kind: str, canon: str, gender: str) -> str:
    """The surrogate of a canonical entity, in canonical form."""
    if kind == "ip":
        o = [int(x) for x in canon.split(".")]
        low = 1 <= o[0] <= 223                   # ordinary addresses stay ordinary
        size, first = (223 if low else 33), (o[0] - 1 if low else (0 if o[0] == 0 else o[0] - 223))
        x = keyed.permuted(((first * 256 + o[1]) * 256 + o[2]) * 256 + o[3], size * 256**3, f"ip{low}")
        x, d = divmod(x, 256)
        x, c = divmod(x, 256)
        first, b = divmod(x, 256)
        return f"{first + 1 if low else (0 if first == 0 else first + 223)}.{b}.{c}.{d}"
    if kind == "email":
        local, _, domain = canon.partition("@")
        host, dot, top = domain.rpartition(".")
        return f"{keyed.rewritten(local, 'local')}@{keyed.rewritten(host, 'host')}{dot}{top}"
    if kind == "name":
        if canon in _GENDER:
            names = GIVEN[_GENDER[canon]]
            return names[keyed.permuted(names.index(canon), len(names), "given" + "".join(_GENDER[canon]))]
        # A Slavic family name keeps its gendered ending.  Names of each ending, or of none,
        # have surrogates among themselves: others, and given names, are walked past.
        out, end = canon, _ending(canon)
        while True:
            out = keyed.rewritten(out[:len(out) - len(end)], "family") + end
            if out not in _GENDER and _ending(out) == end:
                return out
    return _digits(keyed, kind, canon)


def dressed(kind: str, mention: str, new: str) -> str:
    """A canonical surrogate in the format of the mention."""
    if kind == "ip":
        return new
    if kind in ("email", "name"):
        if len(new) == len(mention):
            return "".join(n.upper() if m.isupper() else n for m, n in zip(mention, new))
        return new.upper() if mention.isupper() else new[:1].upper() + new[1:] if mention[:1].isupper() else new
    total = sum(c in CLASSES[0] for c in mention)
    rest, out = list(new), []
    for c in mention:
        if c in CLASSES[0]:
            out.append(rest.pop(0) if total <= len(rest) else c)
            total -= 1
        else:
            out.append(c)
    return "".join(out)


def _run(key: bytes, pairs: bool):
    def run(batches):
        keyed, machine = Keyed(key), _machine()
        of = functools.lru_cache(1 << 16)(lambda kind, canon, gender: surrogate(keyed, kind, canon, gender))
        for batch in batches:
            texts, spans, counts, seen = [], [], [], set()
            for text in batch.column("text").to_pylist():
                found = find(text, machine) if text else []
                out, at = [], 0
                for a, b, kind, gender in found:
                    canon = canonical(kind, text[a:b])
                    new = of(kind, canon, gender)
                    if pairs:
                        seen.add((kind, canon, new))
                    out += [text[at:a], dressed(kind, text[a:b], new)]
                    at = b
                if not pairs:
                    texts.append("".join([*out, text[at:]]) if found else text)
                    counts.append(len(found))
                    spans.append(",".join(f"{k}:{a}:{b}" for a, b, k, _ in found))
            if pairs:
                rows = sorted(seen)
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], pa.string()) for c in range(3)], names=["type", "entity", "surrogate"])
            else:
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string()), pa.array(counts, pa.int64()),
                                                  pa.array(spans, pa.string())], names=["doc_id", "text", "n_entities", "spans"])
    return run


def collisions(docs: DataFrame, key: bytes, *, text_col: str = "text") -> DataFrame:
    """type, surrogate, entities of every surrogate that several entities got."""
    arrow_batches(docs.sparkSession)
    pairs = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(_run(key, True), "type string, entity string, surrogate string")
    return (pairs.distinct().groupBy("type", "surrogate").agg(F.count("*").alias("entities")).where("entities > 1"))


def replace(docs: DataFrame, key: bytes, *, id_col: str = "doc_id", text_col: str = "text", check: bool = True) -> DataFrame:
    """doc_id, text (with surrogates), n_entities and spans (type:start:end in code points of
    the original text, comma-joined) of every row."""
    if check and (found := collisions(docs, key, text_col=text_col).limit(3).collect()):
        raise ValueError(f"surrogates collide: {found}")
    arrow_batches(docs.sparkSession)
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(_run(key, False), f"doc_id {kind}, text string, n_entities bigint, spans string")
