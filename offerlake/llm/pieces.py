"""SentencePiece encoding and decoding by a relational lattice.

A text is normalised as the public piece model does: a space becomes U+2581, one more is
put in front.  It falls into units (``UNIT``: a whole run of U+2581 with the word behind
it) that no piece of the vocabulary crosses, so
the best path of a text is the best paths of its units.  Every distinct unit's substrings
of bounded length are exploded and equi-joined with the piece table; its edges are grouped
by unit (a long one by 128 bits of its hash); a Spark higher-order aggregate folds the Viterbi recurrence over the positions
and a second one walks back.  A character without a piece becomes its byte pieces.

Piece scores are log-probabilities of a Zipf law over the vocabulary's ranks, -ln(id): the
public vocabulary was made by merges and stores ranks, not probabilities.  The ids are
valid ids of that vocabulary and any decoder of it restores the text; the segmentation is
the best path, not the order of merges.  Ties go to the path whose last piece begins
later, then to the smaller id.

Scale.  Units that are frequent in a bounded sample of the documents (``HEAD``) are encoded
once, by the same lattice, and looked up by every task.  Units are cut into parts wherever no
piece holds the two characters at the cut, which no path crosses either; the parts of all other
units are looked up where they are frequent, and else travel as (row number, place, part) rows, meet the
lattice's result in a join on the part, and go back to their row, which itself travels as
compressed numbers.  Texts are split once.  The result does not depend on what the sample holds.

Defined results.  A null text has null ids and counts of 0; an empty text has no ids.
U+2581 in a text decodes to a space, as in the model.  Rows that agree in doc_id and text
are encoded alike.  Extra columns are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import sentencepiece
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlake.llm.spark import arrow_batches, materialize

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
# A piece holds U+2581 only as a run of it or as its first character, and no line end.
UNIT = f"{SPACE}+[^{SPACE}\\n]*|[^{SPACE}\\n]+|\\n"
SAMPLE_DOCS = 20_000          # documents of the sample that names the frequent units
HEAD = 150_000                # units looked up by every task, at most
UNITS = 40_000                # rows of units that one task solves
RUN = 256                     # elements of an inner fold
KEY = 32                      # characters of a hashed unit's key; a unit of fewer bytes is its own key
SLICE = 64                    # characters of a unit in one row, at most (and a piece more)


def vocabulary(model: str = MODEL) -> tuple[list[tuple[str, int, float]], list[bytes], int, int]:
    """Pieces (piece, id, score), the bytes that each id stands for, the id of byte 0 and
    the longest piece in characters."""
    m = sentencepiece.SentencePieceProcessor(model_file=model)
    pieces, raw, first = [], [], None
    for i in range(m.get_piece_size()):
        piece = m.id_to_piece(i)
        if m.is_byte(i):
            first = i if first is None else first
            raw.append(bytes([i - first]))
        elif m.is_control(i) or m.is_unknown(i) or m.is_unused(i):
            raw.append(b"")
        else:
            raw.append(piece.replace(SPACE, " ").encode())
            pieces.append((piece, i, -math.log(i)))
    return pieces, raw, first, max(len(p) for p, *_ in pieces)


def neighbours(pieces: list[tuple[str, int, float]]) -> set[str]:
    """The pairs of characters that follow one another in some piece."""
    return {p[i:i + 2] for p, *_ in pieces for i in range(len(p) - 1)}


def parts(unit: str, pairs: set[str]) -> list[str]:
    """The unit cut where no piece can span: the best path is the best paths of the parts.
    Every unit is solved by its parts, so that scores are summed in one way only."""
    cuts = [0, *(i for i in range(1, len(unit)) if unit[i - 1:i + 1] not in pairs), len(unit)]
    return [unit[lo:hi] for lo, hi in zip(cuts, cuts[1:])]


def normalised(text: Column) -> Column:
    return F.concat(F.lit(SPACE), F.translate(text, " ", SPACE))


def keyed(units: DataFrame) -> DataFrame:
    """Adds ``key``, which stands for a unit in shuffles: the unit itself, or 128 bits of its hash
    as 32 digits where it has that many bytes.  Most units are shorter than a hash, and unlike it
    they compress."""
    digits = F.concat(*[F.lpad(F.hex(h), KEY // 2, "0") for h in (F.xxhash64("unit"), F.xxhash64(F.lit(1), "unit"))])
    return units.withColumn("key", F.when(F.octet_length("unit") < KEY, F.col("unit")).otherwise(digits))


def lattice(units: DataFrame, pieces: DataFrame, first_byte: int, longest: int, rows: int = 0) -> DataFrame:
    """(unit, key) rows -> key, ids (the best path's pieces), one row per unit.

    Units are dealt by their key once, in parts of about UNITS of the stated ``rows``, so that
    the edges of a part are grouped in memory; their edges stay where they are.  A unit is cut into
    overlapping slices first, so that an edge's row carries a slice and not the whole unit."""
    long = F.when(F.octet_length("unit") >= KEY, F.col("unit")).alias("long")     # a short one is its key
    at = units.select("key", long).repartition(1 + rows // UNITS, "key").distinct()
    at = at.select("key", F.coalesce("long", "key").alias("unit"))
    at = at.select("key", "unit", F.length("unit").alias("n"))
    at = at.select("key", "unit", "n", F.explode(F.expr(f"sequence(0, n - 1, {SLICE})")).alias("base"))
    at = at.select("key", "n", "base", F.expr(f"substring(unit, base + 1, {SLICE + longest - 1})").alias("part"))
    at = at.select("key", "n", "base", "part", F.explode(F.expr(f"sequence(1, least({SLICE}, n - base))")).alias("lo"))
    at = at.select("key", "n", "base", "part", "lo", F.explode(F.expr(f"sequence(1, least({longest}, n - base - lo + 1))")).alias("size"))
    at = at.select("key", "n", (F.col("base") + F.col("lo") - 1).alias("lo"), "size", F.expr("substring(part, lo, size)").alias("piece"))
    worst = -math.log(1e9)                       # a character without a piece
    edges = at.join(F.broadcast(pieces), "piece", "left").where("id is not null or size = 1")
    # A character without a piece stands as -1 - its code point.
    edges = edges.select("key", "n", F.struct((F.col("lo") + F.col("size")).alias("hi"), "lo", F.coalesce("score", F.lit(worst)).alias("score"),
                                                   F.coalesce("id", -1 - F.ascii("piece")).alias("id")).alias("edge"))
    words = edges.groupBy("key").agg(F.max("n").alias("n"), F.sort_array(F.collect_list("edge")).alias("edges"))
    # Best score, beginning and piece of the last step at every position; position 0 first.
    # The piece is kept negated, so that of equal paths the smaller id is the greatest.
    # Edges are sorted by their end, and every position has one, so the fold takes them one
    # by one: ``top`` is the best step to the end ``hi``, ``near`` holds those before it from
    # position ``from`` on.  aggregate() copies its state at every element, so RUN edges make
    # an inner fold with a small state, and the outer one moves steps that no piece reaches
    # back to into ``far``.
    steps = "array<struct<score:double,lo:int,minus:int>>"
    step = "named_struct('score', if(e.lo = s.hi, s.top.score, s.near[e.lo - s.from].score) + e.score, 'lo', e.lo, 'minus', -e.id)"
    inner = f"""aggregate(slice(edges, r * {RUN} + 1, {RUN}), named_struct('from', o.from, 'near', o.near, 'hi', o.hi, 'top', o.top),
        (s, e) -> if(e.hi = s.hi, named_struct('from', s.from, 'near', s.near, 'hi', s.hi, 'top', greatest(s.top, {step})),
                     named_struct('from', s.from, 'near', concat(s.near, array(s.top)), 'hi', e.hi, 'top', {step})))"""
    old = f"greatest(0, size(i.near) - {longest})"
    best = f"""aggregate(sequence(0, (size(edges) - 1) div {RUN}), named_struct('far', cast(array() as array<{steps}>), 'from', 0,
                'near', cast(array() as {steps}), 'hi', 0, 'top', named_struct('score', 0d, 'lo', 0, 'minus', 0)),
        (o, r) -> element_at(transform(array({inner}), i -> named_struct('far', concat(o.far, array(slice(i.near, 1, {old}))), 'from', i.from + {old},
                'near', slice(i.near, {old} + 1, {longest}), 'hi', i.hi, 'top', i.top)), 1),
        o -> concat(flatten(o.far), o.near, array(o.top)))"""
    words = words.select("key", "n", F.expr(best).alias("best"))
    # Back from the end: pieces in front of ``ids``, in runs as well.
    def byte_pieces(code: str) -> str:                # byte pieces of the code point's UTF-8
        low = [f"{first_byte + 128} + ({code} div {64 ** k}) % 64" for k in range(3)]
        return (f"case when {code} < 128 then array({first_byte} + {code}) when {code} < 2048 then array({first_byte + 192} + {code} div 64, {low[0]}) "
                f"when {code} < 65536 then array({first_byte + 224} + {code} div 4096, {low[1]}, {low[0]}) "
                f"else array({first_byte + 240} + {code} div 262144, {low[2]}, {low[1]}, {low[0]}) end")
    piece = f"cast(if(best[p].minus > 0, {byte_pieces('(best[p].minus - 1)')}, array(-best[p].minus)) as array<int>)"
    inner = f"""aggregate(sequence(n - r * {RUN}, greatest(1, n - r * {RUN} - {RUN - 1}), -1), named_struct('at', o.at, 'ids', cast(array() as array<int>)),
        (s, p) -> if(p <> s.at, s, named_struct('at', best[p].lo, 'ids', concat({piece}, s.ids))))"""
    path = f"""aggregate(sequence(0, (n - 1) div {RUN}), named_struct('at', n, 'runs', cast(array() as array<array<int>>)),
        (o, r) -> element_at(transform(array({inner}), i -> named_struct('at', i.at, 'runs', concat(array(i.ids), o.runs))), 1), o -> flatten(o.runs))"""
    return words.select("key", F.expr(path).alias("ids"))


def _part_counts(pairs: set[str]):
    def run(batches):
        for batch in batches:
            unit, n = [], []
            for u, k in zip(batch.column("unit").to_pylist(), batch.column("n").to_pylist()):
                cut = parts(u, pairs)
                if len(cut) > 1:
                    unit += cut
                    n += [k] * len(cut)
            yield pa.RecordBatch.from_arrays([pa.array(unit, pa.string()), pa.array(n, pa.int64())], names=["unit", "n"])
    return run


def _cut(pairs: set[str]):
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([x for u in batch.column("unit").to_pylist() for x in parts(u, pairs)], pa.string())], names=["unit"])
    return run


def _frequent(texts: DataFrame, sample_docs: int, head: int, pairs: set[str]) -> DataFrame:
    """At most ``head`` units and parts, the most frequent ones of a sample of the documents."""
    n = texts.count()
    share = min(1.0, sample_docs / max(1, n))
    sample = texts.where(F.pmod("key", F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    counts = materialize(sample.select(F.explode(F.expr(f"regexp_extract_all(norm, '{UNIT}', 0)")).alias("unit"))
                               .groupBy("unit").agg(F.count("*").alias("n")), "pieces-sample")
    counts = materialize(counts.union(counts.mapInArrow(_part_counts(pairs), "unit string, n bigint"))
                               .groupBy("unit").agg(F.sum("n").alias("n")), "pieces-counts")
    # Units of equal count enter together: one row per count decides, not a global sort.
    per, total, least = counts.groupBy("n").agg(F.count("*").alias("units")).orderBy(F.desc("n")), 0, None
    for row in per.limit(head).toLocalIterator():
        total += row.units
        if total > head:
            break
        least = row.n
    return counts.where(F.col("n") >= (least if least is not None else 1 << 62)).select("unit")


def _codes(units: list[str], known: pa.Table, pairs: set[str]) -> tuple[dict, np.ndarray, np.ndarray]:
    """Units as numbers, and the ids of each, those of its parts: offsets into one flat array."""
    solved = known.column("ids").combine_chunks()
    at = np.concatenate([[0], np.cumsum(pa.compute.list_value_length(solved).to_numpy(zero_copy_only=False))]).astype(np.int64)
    ids = solved.flatten().to_numpy(zero_copy_only=False).astype(np.int32)
    place = {u: i for i, u in enumerate(known.column("unit").to_pylist())}
    which = [[place[x] for x in parts(u, pairs)] for u in units]
    flat = np.array([k for w in which for k in w], np.int64)
    size = np.concatenate([[0], np.cumsum(at[flat + 1] - at[flat])]).astype(np.int64)
    ends = np.concatenate([[0], np.cumsum([len(w) for w in which])]).astype(np.int64)
    return {u: i for i, u in enumerate(units)}, size[ends], _gather(ids, at, flat)


def _gather(values: np.ndarray, at: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Concatenation of the runs values[at[w]:at[w + 1]] for each w of ``which``."""
    size = at[which + 1] - at[which]
    total = np.concatenate([[0], np.cumsum(size)])
    return values[np.repeat(at[which] - total[:-1], size) + np.arange(total[-1])]


def _two(at: np.ndarray, ids: np.ndarray, tail: list[np.ndarray], which: np.ndarray) -> np.ndarray:
    """Ids of a text's units: number w >= 0 is a head unit, -1 - k the k-th tail unit."""
    size = np.array([len(t) for t in tail], np.int64)
    flat = np.concatenate([*tail, np.zeros(0, np.int32)]).astype(np.int64)
    begin = np.concatenate([[0], np.cumsum(size)])
    head = which >= 0
    k = np.where(head, 0, -1 - which)
    length = np.where(head, at[np.maximum(which, 0) + 1] - at[np.maximum(which, 0)], 0) if len(at) > 1 else np.zeros(len(which), np.int64)
    if len(tail):
        length = np.where(head, length, size[k])
    total = np.concatenate([[0], np.cumsum(length)])
    inner = np.arange(total[-1]) - np.repeat(total[:-1], length)
    from_head = np.repeat(head, length)
    out = np.empty(total[-1], np.int32)
    out[from_head] = ids[(np.repeat(at[np.maximum(which, 0)], length) + inner)[from_head]]
    if len(tail):
        out[~from_head] = flat[(np.repeat(begin[k], length) + inner)[~from_head]]
    return out


def _split(codes, pairs: set[str]):
    pattern = re.compile(UNIT)

    def run(norm: str) -> tuple[np.ndarray, list[str], int]:
        """Numbers of a text's units, or of their parts, and how many units it has; what is
        not in the head is -1, -2, ... by first use."""
        number = codes.value[0]
        tail: dict[str, int] = {}
        rare: dict[str, list[int]] = {}
        out, units = [], pattern.findall(norm)
        for u in units:
            k = number.get(u)
            if k is not None:
                out.append(k)
                continue
            if u not in rare:
                rare[u] = [number[x] if x in number else tail.setdefault(x, -1 - len(tail)) for x in parts(u, pairs)]
            out += rare[u]
        return np.array(out, np.int32), list(tail), len(units)
    return run


def _packed(codes, pairs: set[str]):
    """Rows with the numbers of their units and the text of those that are not in the head."""
    split = _split(codes, pairs)

    def run(batches):
        for batch in batches:
            packed, sums, tails, units = [], [], [], []
            for norm in batch.column("norm").to_pylist():
                if norm is None:
                    packed.append(None), sums.append(0), tails.append([]), units.append(0)
                else:
                    numbers, tail, n = split(norm)
                    units.append(n), packed.append(zlib.compress(numbers.tobytes(), 1)), tails.append(tail)
                    sums.append(zlib.crc32(norm.replace(SPACE, " ").encode()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(packed, pa.binary()), pa.array(sums, pa.int64()),
                                              pa.array(units, pa.int64()), pa.array(tails, pa.list_(pa.string()))],
                                             names=["doc_id", "packed", "crc", "n_units", "units"])
    return run


def _assemble(codes, raw: list[bytes]):
    def run(batches):
        byte_at = np.concatenate([[0], np.cumsum([len(b) for b in raw])]).astype(np.int64)
        byte = np.frombuffer(b"".join(raw), np.uint8)
        _, head_at, head_ids = codes.value
        for batch in batches:
            ids, same = [], []
            crc = batch.column("crc").to_pylist()
            for i in range(batch.num_rows):
                packed = batch.column("packed")[i].as_py()
                if packed is None:
                    ids.append(None), same.append(True)
                    continue
                which = np.frombuffer(zlib.decompress(packed), np.int32).astype(np.int64)
                tail = {t["place"]: t["ids"] for t in batch.column("tail")[i].as_py() or []}
                tail = [np.array(tail[k], np.int32) for k in range(len(tail))]
                # Tail unit -1 - k is stored behind the head's units.
                one = _two(head_at, head_ids, tail, which)
                ids.append(one)
                same.append(zlib.crc32(_gather(byte, byte_at, one.astype(np.int64)).tobytes()) == crc[i] if len(one) else True)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_units"), pa.array([0 if x is None else len(x) for x in ids], pa.int64()),
                 pa.array(ids, pa.list_(pa.int32())), pa.array(same)], names=["doc_id", "n_units", "n_pieces", "ids", "round_trip"])
    return run


def encode(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL,
           sample_docs: int = SAMPLE_DOCS, head: int = HEAD) -> DataFrame:
    """doc_id, n_units, n_pieces, ids and round_trip (the ids decode to the text) of every row."""
    spark = docs.sparkSession
    arrow_batches(spark)
    rows, raw, first_byte, longest = vocabulary(model)
    pieces = spark.createDataFrame(rows, "piece string, id int, score double")      # the vocabulary: bounded
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    texts = texts.select("doc_id", F.when(F.col("text") != "", normalised(F.col("text"))).when(F.col("text") == "", "").alias("norm"),
                         F.xxhash64("doc_id", "text").alias("key"))
    pairs = neighbours(rows)
    frequent = materialize(_frequent(texts, sample_docs, head, pairs), "pieces-frequent")
    cut = keyed(materialize(frequent.mapInArrow(_cut(pairs), "unit string").distinct(), "pieces-cut"))
    known = cut.join(lattice(cut, pieces, first_byte, longest, cut.count()), "key").select("unit", "ids")
    units = frequent.toArrow().column("unit").to_pylist()                           # at most ``head`` rows
    codes = spark.sparkContext.broadcast(_codes(units, known.toArrow(), pairs))     # and their parts
    kind = texts.schema["doc_id"].dataType.simpleString()
    # Every text is split once.  Rows are told apart by their own number, so equal rows do
    # not meet in one group.
    rows = (texts.select("doc_id", "norm").mapInArrow(_packed(codes, pairs), f"doc_id {kind}, packed binary, crc bigint, n_units bigint, units array<string>")
                 .withColumn("row", F.monotonically_increasing_id()))
    rows = materialize(rows, "pieces-rows")
    tail = keyed(rows.select("row", F.posexplode("units").alias("place", "unit")))
    n_tail = rows.agg(F.sum(F.size("units"))).first()[0] or 0
    solved = materialize(lattice(tail, pieces, first_byte, longest, n_tail), "pieces-solved")
    back = (tail.select("row", "place", "key").join(solved, "key").groupBy("row").agg(F.collect_list(F.struct("place", "ids")).alias("tail"))
                .select(F.col("row").alias("t_row"), "tail"))
    both = rows.select("row", "doc_id", "packed", "crc", "n_units").join(back, F.col("row") == F.col("t_row"), "left").select("doc_id", "packed", "crc", "n_units", "tail")
    return both.mapInArrow(_assemble(codes, raw), f"doc_id {kind}, n_units bigint, n_pieces bigint, ids array<int>, round_trip boolean")


def decode(encoded: DataFrame, *, id_col: str = "doc_id", ids_col: str = "ids", model: str = MODEL) -> DataFrame:
    """doc_id, text: the text that each row's ids stand for (null ids: null)."""
    raw = vocabulary(model)[1]

    def run(batches):
        at = np.concatenate([[0], np.cumsum([len(b) for b in raw])]).astype(np.int64)
        byte = np.frombuffer(b"".join(raw), np.uint8)
        for batch in batches:
            out = []
            for ids in batch.column("ids").to_pylist():
                text = None if ids is None else _gather(byte, at, np.array(ids, np.int64)).tobytes().decode("utf-8", "replace")
                out.append(text[1:] if text and text[0] == " " else text)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.string())], names=["doc_id", "text"])

    rows = encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text string")
