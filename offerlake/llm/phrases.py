"""Phrase collocations mined over Rabin-Karp fingerprints.

A text is lower-cased (A-Z), cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and pieces into words
``[^\\x20\\x09]+``.  Everything is counted within a language.  Prefix polynomials over the
words' hashes, S(i) = sum of h(j) B^-j modulo 2^64, give every run of words its fingerprint
by one subtraction and one product, whatever its length.

* Fingerprint rounds, for 1, 2, ... ``longest`` words: every task adds up the fingerprints
  of its n-grams, the shuffle adds up the tasks' sums, and those of ``least`` occurrences
  or more stay.  An n-gram is only looked at if the two shorter ones in it stayed (a phrase
  is never more frequent than its parts), so that most n-grams are never shuffled.  What
  stayed reaches the next round as a bitmap of fingerprints of at most ``MAP_BITS`` bits
  (its size follows the counted fingerprints); a bit that two share lets through an n-gram
  too many, never one too few.
* Text round: the n-grams that passed are told apart by their words themselves, each with
  a pointer to an occurrence (the key of its text, a 64-bit hash), and each phrase is cut
  out of a batch's texts only once.  The shuffle adds up counts by phrase and keeps the
  least pointer.
  Phrases of one fingerprint part here, so that collisions change no count, and the
  threshold holds for exact counts.
* Scores, in integers: cuts of a candidate meet their parts' counts in equi-joins.

Scale.  Counts are added up in the task before every shuffle, so frequent words cost one row
per task.  Nothing is collected but the bitmaps, whose size is bounded.  The best phrases
of a language are picked share by share, then among ``SHARES`` times ``top`` rows at most.

Defined results.  A null text is empty.  A null language is ``und``.  Rows that repeat a
doc_id, or a text, all count.  Equal scores go by count, then by the bytes of the phrase.
Extra columns are ignored.  An empty table, or one without frequent phrases, gives an
empty result.  A task's memory follows its longest single text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from offerlake.llm import words as W
from offerlake.llm.spark import arrow_batches, materialize, small

LEAST, LONGEST, TOP = 30, 4, 2000
MAP_BITS = 27                 # a bitmap of fingerprints has 2**27 bits (16 MB) at most
BLOCK_BITS = 20               # built in blocks of 2**20 bits
BITS_PER_ENTRY = 32
SHARES = 64                   # a language's phrases are ranked in so many shares first
UNKNOWN = "und"

_STOP = np.zeros(256, bool)
_STOP[list(b".,;:!?\n\x0b\x0c\r")] = True
_WORD = ~_STOP
_WORD[[0x20, 9]] = False
_BASE = 0x9E3779B97F4A7C15 | 1                     # odd: has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 ... base**(n - 1) modulo 2**64."""
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Runs:
    """Words of some texts and the fingerprints of runs of them."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, salt: np.ndarray):
        self.data, self.salt = data, salt
        self.starts, self.ends, first = W.spans(data, bounds, _WORD)
        n = len(self.starts)
        self.text = np.repeat(np.arange(len(bounds) - 1), np.diff(first))     # of every word
        stops = np.concatenate([[0], np.cumsum(_STOP[data])])
        # Does the next word belong to the same piece?
        self.joined = np.zeros(n, bool)
        if n > 1:
            self.joined[:-1] = (stops[self.starts[1:]] == stops[self.ends[:-1]]) & (self.text[1:] == self.text[:-1])
        h = W.hashes(data, self.starts, self.ends, W.LOWER)
        self.prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * _powers(_INVERSE, n), dtype=np.uint64)])
        self.shift = _powers(_BASE, n)

    def fingerprints(self, at: np.ndarray, size: int) -> np.ndarray:
        """Of the runs of ``size`` words that begin at the words ``at``, by language."""
        poly = (self.prefix[at + size] - self.prefix[at]) * self.shift[at]
        return W.mix(poly ^ self.salt[self.text[at]] ^ np.uint64(size))

    def passing(self, maps: list[tuple[int, np.ndarray]], size: int, whole: bool = False):
        """(size, first words, fingerprints) of the n-grams whose shorter parts all passed:
        for every size up to ``size`` that a bitmap tells of, and the last one unfiltered
        unless ``whole``."""
        at = np.arange(len(self.starts))
        for n in range(1, size + 1):
            if n > 1:
                # Both shorter ones have passed, and the last two words are of one piece.
                at = at[:-1][(at[1:] == at[:-1] + 1) & self.joined[at[:-1] + n - 2]]
            marks = self.fingerprints(at, n)
            if n < size or whole:
                seen = _known(maps[n - 1], marks)
                at, marks = at[seen], marks[seen]
            yield n, at, marks


def _known(bitmap: tuple[int, np.ndarray], marks: np.ndarray) -> np.ndarray:
    bits, data = bitmap
    pos = (marks >> np.uint64(64 - bits)).astype(np.int64)
    return (data[pos >> 3] >> (pos & 7).astype(np.uint8)) & 1 == 1


def _runs(batch):
    """Runs of a batch, some texts at a time, with the first text's number."""
    data, bounds = W.texts(batch.column("text"))
    langs = batch.column("lang").dictionary_encode()
    names = langs.dictionary.to_pylist()
    codes = langs.indices.to_numpy(zero_copy_only=False)
    salt = W.hash_words([x.encode() for x in names])[codes] if names else np.zeros(0, np.uint64)
    for i, j in W.pieces(bounds):
        yield Runs(data[bounds[i]:bounds[j]], bounds[i:j + 1] - bounds[i], salt[i:j]), i, codes[i:j], names


def _count(maps, size: int):
    def run(batches):
        for batch in batches:
            for runs, _, codes, names in _runs(batch):
                for n, at, marks in runs.passing([m.value for m in maps], size):
                    pass                                          # the last size is meant
                marks, counts = np.unique(marks, return_counts=True)
                langs, marks, counts = [None] * len(marks), marks.view(np.int64).tolist(), counts.tolist()
                if size == 1:                                     # and all words of a language
                    for k, total in enumerate(np.bincount(codes[runs.text], minlength=len(names)).tolist()):
                        langs.append(names[k]), marks.append(0), counts.append(total)
                yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(marks, pa.int64()), pa.array(counts, pa.int64())],
                                                 names=["lang", "mark", "n"])
    return run


def _cut(maps, longest: int):
    def run(batches):
        for batch in batches:
            keys = batch.column("key").to_numpy(zero_copy_only=False)
            for runs, first, codes, names in _runs(batch):
                if not len(runs.starts):
                    continue
                # Exact numbers of words, then of n-grams from those of (n - 1)-grams.
                size = runs.ends - runs.starts
                offsets = np.concatenate([[0], np.cumsum(size)])
                inner = np.arange(offsets[-1]) - np.repeat(offsets[:-1], size)
                low = W.LOWER[runs.data[np.repeat(runs.starts, size) + inner]]
                spelt = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(low)])
                coded = spelt.dictionary_encode()
                word = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                spelling = coded.dictionary
                number = word * len(names) + codes[runs.text[np.arange(len(word))]]
                grams = np.full(len(word), -1, np.int64)
                for n, at, _ in runs.passing([m.value for m in maps], longest, whole=True):
                    if not len(at):
                        break
                    key = number[at] if n == 1 else grams[at] * (len(spelling) + 1) + word[at + n - 1]
                    _, where, back, counts = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
                    grams[at] = back
                    lead = at[where]                              # the first occurrences
                    text = runs.text[lead]
                    parts = [spelling.take(pa.array(word[lead + k])) for k in range(n)]
                    phrase = parts[0] if n == 1 else pa.compute.binary_join_element_wise(*parts, pa.scalar(b" ", pa.large_binary()))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([names[c] for c in codes[text].tolist()], pa.string()), pa.array(np.full(len(lead), n, np.int32)),
                         phrase.cast(pa.binary()).cast(pa.string()), pa.array(counts.astype(np.int64)),
                         pa.array(keys[first + text])], names=["lang", "size", "phrase", "n", "key"])
    return run


def _bitmap(kept: DataFrame):
    """The fingerprints of ``kept`` (column mark) as a bitmap: (bits, bytes), broadcast."""
    n = kept.count()
    bits = min(MAP_BITS, max(16, (BITS_PER_ENTRY * max(1, n) - 1).bit_length()))
    block = min(bits, BLOCK_BITS)
    pos = kept.select(F.shiftrightunsigned("mark", 64 - bits).alias("pos")).distinct()
    pos = pos.select(F.shiftright("pos", block).alias("block"), F.col("pos").bitwiseAND(F.lit((1 << block) - 1)).cast("int").alias("bit"))

    def fill(table: pa.Table) -> pa.Table:
        flags = np.zeros(1 << block, np.uint8)
        flags[table.column("bit").to_numpy()] = 1
        return pa.table({"block": table.column("block").slice(0, 1), "bytes": pa.array([np.packbits(flags, bitorder="little").tobytes()], pa.binary())})

    data = np.zeros(1 << (bits - 3), np.uint8)
    width = 1 << (block - 3)
    for row in pos.groupBy("block").applyInArrow(fill, "block bigint, bytes binary").collect():   # 2**(bits - 3) bytes at most
        data[row.block * width:(row.block + 1) * width] = np.frombuffer(row.bytes, np.uint8)
    return kept.sparkSession.sparkContext.broadcast((bits, data))


def counts(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """Exact counts: (lang, size, phrase, n, key) of every phrase of 1 to ``longest`` words
    with at least ``least`` occurrences, with the key of a text that holds it, and (lang, n)
    with all words of a language."""
    arrow_batches(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    maps: list = []
    totals = None
    for size in range(1, longest + 1):
        added = (texts.mapInArrow(_count(list(maps), size), "lang string, mark bigint, n bigint")
                      .groupBy("lang", "mark").agg(F.sum("n").alias("n")).where(F.col("lang").isNotNull() | (F.col("n") >= least)))
        added = materialize(added, f"phrases-{size}")
        if size == 1:
            totals = added.where("lang is not null").select("lang", "n")
        maps.append(_bitmap(added.where("lang is null").select("mark")))
    keyed = texts.withColumn("key", F.xxhash64("text"))
    found = keyed.mapInArrow(_cut(maps, longest), "lang string, size int, phrase string, n bigint, key bigint")
    found = (found.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n"), F.min("key").alias("key"))
                  .where(F.col("n") >= least))
    return materialize(found, "phrases-exact"), totals


def collocations(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, longest: int = LONGEST,
                 top: int = TOP, cover_percent: int = 80) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score, cut (words of the first part) and at_key
    (xxhash64 of a text that holds the phrase) of the ``top`` best phrases of every language.

    A phrase of two or more words is cut in two where floor(2000000 a / (l + r)) is lowest
    (ties: shortest first part).  It is dropped if a longer frequent phrase holds it and has
    at least ``cover_percent`` % of its occurrences."""
    f, totals = counts(docs, text_col=text_col, lang_col=lang_col, least=least, longest=longest)
    part = lambda name: small(f.select(F.col("lang").alias(f"{name}_lang"), F.col("phrase").alias(name), F.col("n").alias(f"{name}_n")), f)
    words = F.split("phrase", " ")
    cand = f.where("size >= 2").select("lang", "size", "phrase", F.col("n").alias("a"), "key", words.alias("w"))

    cuts = cand.select("lang", "phrase", "a", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("cut"), "w", "size")
    cuts = cuts.select("lang", "phrase", "a", "cut", F.array_join(F.slice("w", 1, F.col("cut")), " ").alias("p1"),
                       F.array_join(F.slice("w", F.col("cut") + 1, F.col("size") - F.col("cut")), " ").alias("p2"))
    cuts = (cuts.join(part("first"), (F.col("lang") == F.col("first_lang")) & (F.col("p1") == F.col("first")))
                .join(part("rest"), (F.col("lang") == F.col("rest_lang")) & (F.col("p2") == F.col("rest"))))
    score = F.expr("(2000000BD * cast(a as decimal(20,0))) div (cast(first_n as decimal(20,0)) + cast(rest_n as decimal(20,0)))")
    low = (cuts.select("lang", "phrase", F.struct(score.alias("score"), "cut", F.col("first_n").alias("l"), F.col("rest_n").alias("r")).alias("low"))
               .groupBy("lang", "phrase").agg(F.min("low").alias("low")))

    inside = cand.where("size >= 3").select("lang", "a", "size", "w", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("k"))
    inside = inside.select("lang", "a", "w", "k", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("k") + 1)).alias("from"))
    cover = (inside.select(F.col("lang").alias("c_lang"), F.array_join(F.slice("w", F.col("from"), F.col("k")), " ").alias("c_phrase"), "a")
                   .groupBy("c_lang", "c_phrase").agg(F.max("a").alias("most")))
    kept = (cand.join(cover, (F.col("lang") == F.col("c_lang")) & (F.col("phrase") == F.col("c_phrase")), "left")
                .where(F.col("most").isNull() | (100 * F.col("most") < cover_percent * F.col("a")))
                .select("lang", "phrase", "a", "key"))
    scored = kept.join(low, ["lang", "phrase"]).select("lang", "phrase", "a", "low.l", "low.r", "low.score", "low.cut", "key")
    # The best of every share of a language first: what meets in one task is bounded.
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    scored = scored.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(SHARES)))
    some = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))).where(F.col("rank") <= top)
    best = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    total = F.broadcast(totals.select(F.col("lang").alias("t_lang"), F.col("n")))             # one row per language
    return (best.join(total, F.col("lang") == F.col("t_lang"))
                .select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score",
                        F.col("cut").cast("bigint").alias("cut"), F.col("key").alias("at_key")))
