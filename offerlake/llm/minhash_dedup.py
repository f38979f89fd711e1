"""Near-duplicate documents: MinHash banding with sequential Bayesian verification.

1. Every text becomes its set of word shingles (64-bit fingerprints); documents with
   the same set form one class, found by a 128-bit fingerprint of the set.
2. One MinHash signature per class; bands of it are hash buckets.
3. Members of a bucket are compared with hubs, and members with too many shingles that
   no other candidate has are set aside (see ``components``), so a bucket never emits all
   its pairs.  A candidate pair compares its signatures batch by batch: with
   m of n positions equal, and a uniform prior, P(similarity >= t) is the binomial
   P(Bin(n + 1, t) <= m); the pair is dropped once that is below ``miss``.
4. Survivors are verified on their full shingle sets, made again from the whole texts.
   Where a region of buckets still holds several components after the hubs, the nodes
   outside its largest one meet the others in blocks, which go through the same steps
   and return at most one link for each node and component.
5. Verified links are joined to components by distributed union-find.

Defined results.  A null or empty text, or one without words, has no shingles and is
linked with nothing.  A text with fewer words than a shingle has its whole sequence as
one shingle.  Rows that repeat a doc_id are separate rows; each gets the result of its
own text.  A null doc_id never names a component: the component's id is its smallest
doc_id that is not null, and a row is kept if its doc_id equals that id (null equals
null).  Ties cannot arise otherwise.  Extra columns are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerlake.llm import words as W
from offerlake.llm.components import link_members
from offerlake.llm.spark import arrow_batches, ids, materialize, small

BANDS, ROWS = 30, 5           # P(pair at 0.8 shares no band) = (1 - 0.8**5)**30 = 7e-6
BATCH = 30                    # signature positions compared at a time
LEFT, RIGHT = 512, 1024       # nodes of a block of one region that meet in one group
MISS = 1e-5                   # chance at which a pair is given up
_rng = np.random.default_rng(77)
_XOR = _rng.integers(1, 2**63, BANDS * ROWS, dtype=np.uint64)
_MUL = _rng.integers(1, 2**62, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(data, bounds, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle fingerprints of every text, and where each text's begin."""
    starts, ends, first = W.spans(data, bounds, W.NOT_SPACE)
    word = W.hashes(data, starts, ends, W.LOWER)
    full = np.zeros(max(0, len(word) - size + 1), np.uint64)
    for i in range(size):
        full = full * _STEP + word[i:len(word) - size + 1 + i] if len(full) else full
    full = W.mix(full + np.uint64(size))
    sets, at = [], [0]
    for lo, hi in zip(first[:-1], first[1:]):
        n = hi - lo
        if n >= size:
            one = np.unique(full[lo:hi - size + 1])
        elif n:
            acc = np.zeros(1, np.uint64)
            for w in word[lo:hi]:
                acc = acc * _STEP + w
            one = W.mix(acc + np.uint64(n))
        else:
            one = np.zeros(0, np.uint64)
        sets.append(one)
        at.append(at[-1] + len(one))
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), np.array(at, np.int64)


def minima(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """(texts, positions) minimum of each permutation; texts without shingles get zeros."""
    out = np.zeros((len(at) - 1, len(_XOR)), np.uint64)
    some = np.flatnonzero(np.diff(at))
    if len(some):
        for p in range(len(_XOR)):
            out[some, p] = np.minimum.reduceat((values ^ _XOR[p]) * _MUL[p], at[:-1][some])
    return out


def _describe(size: int):
    def run(batches):
        for batch in batches:
            data, bounds = W.texts(batch.column("text"))
            for i, j in W.pieces(bounds):
                values, at = shingle_sets(data[bounds[i]:bounds[j]], bounds[i:j + 1] - bounds[i], size)
                low = minima(values, at)
                band = np.zeros((j - i, BANDS), np.uint64)
                for b in range(BANDS):
                    key = np.full(j - i, b + 1, np.uint64)
                    for r in range(ROWS):
                        key = W.mix(key * _STEP + low[:, b * ROWS + r])
                    band[:, b] = key
                sig = (low >> np.uint64(48)).astype(np.uint16)
                one, two = np.cumsum(np.append(np.uint64(0), W.mix(values))), np.cumsum(np.append(np.uint64(0), W.mix(values + _STEP)))
                ends = np.stack([one[at[1:]] - one[at[:-1]], two[at[1:]] - two[at[:-1]] + np.diff(at).astype(np.uint64)], 1)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(i, j - i), batch.column("h").slice(i, j - i),
                    pa.array(np.diff(at)), pa.array([x.tobytes() for x in ends], pa.binary()),
                    pa.array([x.tobytes() for x in sig], pa.binary()), pa.array([x.tobytes() for x in band], pa.binary()),
                ], names=["doc_id", "h", "n_shingles", "node", "sig", "bands"])
    return run


def _buckets(batches):
    for batch in batches:
        keys = np.frombuffer(b"".join(batch.column("bands").to_pylist()), np.int64)
        node = batch.column("node").take(pa.array(np.repeat(np.arange(batch.num_rows), BANDS)))
        yield pa.RecordBatch.from_arrays([pa.array(keys), node], names=["bucket", "node"])


def _shingle_rows(size: int):
    def run(batches):
        for batch in batches:
            data, bounds = W.texts(batch.column("text"))
            for i, j in W.pieces(bounds):
                values, at = shingle_sets(data[bounds[i]:bounds[j]], bounds[i:j + 1] - bounds[i], size)
                number = batch.column("number").slice(i, j - i).take(pa.array(np.repeat(np.arange(j - i), np.diff(at))))
                yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), number], names=["shingle", "number"])
    return run


def least_matches(n: int, threshold: float, miss: float) -> int:
    """Fewest equal positions of n at which P(similarity >= threshold) is still >= miss."""
    total = 0.0
    for m in range(n + 1):
        total += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        if total >= miss:
            return m
    return n


def _prune(threshold: float, miss: float):
    n = BANDS * ROWS
    need = [(e, least_matches(e, threshold, miss)) for e in range(BATCH, n + 1, BATCH)]

    def run(batches):
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, n) for c in ("sig_a", "sig_b"))
            alive, equal, done = np.arange(batch.num_rows), np.zeros(batch.num_rows, np.int64), 0
            for e, least in need:
                equal[alive] += (a[alive, done:e] == b[alive, done:e]).sum(1)
                alive, done = alive[equal[alive] >= least], e
            yield batch.select(["a", "b"]).take(pa.array(alive))
    return run


def shingles(text: str | None, size: int) -> set:
    """The set of word shingles of a text, as the words themselves."""
    low = (text or "").encode().translate(bytes(W.LOWER)).split()
    if not low:
        return set()
    return set(zip(*(low[i:] for i in range(size)))) if len(low) >= size else {tuple(low)}


def _confirm(size: int, percent: int):
    def run(batches):
        kept: dict = {}                          # sets of the last few texts: hubs repeat
        def of(node, text):
            if node not in kept:
                if len(kept) >= 32:
                    kept.pop(next(iter(kept)))
                kept[node] = shingles(text, size)
            return kept[node]
        for batch in batches:
            a, b, ta, tb = (batch.column(c) for c in ("a", "b", "text_a", "text_b"))
            ok = []
            for i in range(batch.num_rows):
                x, y = of(a[i].as_py(), ta[i].as_py()), of(b[i].as_py(), tb[i].as_py())
                if min(len(x), len(y)) * 100 < percent * max(len(x), len(y)):
                    continue
                both = len(x & y)
                if 100 * both >= percent * (len(x) + len(y) - both):
                    ok.append(i)
            yield batch.select(["a", "b"]).take(pa.array(ok, pa.int64()))
    return run


def shared_sizes(lv, lat, rv, rat) -> np.ndarray:
    """Sizes of the common parts of all left and right sets, by blocks of shared shingles."""
    out = np.zeros((len(lat) - 1, len(rat) - 1), np.float32)
    shared = np.intersect1d(lv, rv)
    lrow, rrow = np.repeat(np.arange(len(lat) - 1), np.diff(lat)), np.repeat(np.arange(len(rat) - 1), np.diff(rat))
    lcol, rcol = np.searchsorted(shared, lv), np.searchsorted(shared, rv)
    lok, rok = np.isin(lv, shared), np.isin(rv, shared)
    for lo in range(0, len(shared), 4096):
        x, y = np.zeros((len(lat) - 1, 4096), np.float32), np.zeros((len(rat) - 1, 4096), np.float32)
        li, ri = lok & (lcol >= lo) & (lcol < lo + 4096), rok & (rcol >= lo) & (rcol < lo + 4096)
        x[lrow[li], lcol[li] - lo] = 1
        y[rrow[ri], rcol[ri] - lo] = 1
        out += x @ y.T
    return out


def _compare(size: int, percent: int, miss: float):
    """Links between some nodes and some others of one region: one for each node and label."""
    n = BANDS * ROWS
    need = [(e, least_matches(e, percent / 100, miss)) for e in range(BATCH, n + 1, BATCH)]

    def side(table):
        data, bounds = W.texts(table.column("text"))
        values, at = shingle_sets(data, bounds, size)
        sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint16).reshape(-1, n)
        return values, at, np.diff(at), sig

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        a, b = [], []
        if left.num_rows and right.num_rows:
            lv, lat, ln, lsig = side(left)
            rv, rat, rn, rsig = side(right)
            code = {x: i for i, x in enumerate(dict.fromkeys(left.column("label").to_pylist() + right.column("label").to_pylist()))}
            llab, rlab = (np.array([code[x] for x in t.column("label").to_pylist()]) for t in (left, right))
            total = ln[:, None] + rn[None, :]
            alive = (llab[:, None] != rlab[None, :]) & ((100 + percent) * np.minimum(ln[:, None], rn[None, :]) >= percent * total)
            equal, done = np.zeros(alive.shape, np.int16), 0
            for e, least in need:
                for k in range(done, e):
                    equal += lsig[:, k][:, None] == rsig[:, k][None, :]
                alive &= equal >= least
                done = e
                if not alive.any():
                    break
            if alive.any():
                common = shared_sizes(lv, lat, rv, rat)
                link = alive & (100 * common >= percent * (total - common))
                for i in np.flatnonzero(link.any(1)):
                    _, first = np.unique(rlab[link[i]], return_index=True)
                    for j in np.flatnonzero(link[i])[first]:
                        a.append(left.column("node")[i].as_py()), b.append(right.column("node")[j].as_py())
        return pa.table([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])
    return run


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                    percent: int = 80, miss: float = MISS) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents are linked where 100 * |A & B| >= percent * |A | B| on their word shingles.
    """
    spark = docs.sparkSession
    arrow_batches(spark)
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    docs = docs.withColumn("h", F.xxhash64("text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.mapInArrow(_describe(shingle), f"doc_id {id_type}, h bigint, n_shingles bigint, node binary, sig binary, bands binary")
    rows = materialize(rows, "minhash-rows")
    reps = (rows.where("n_shingles > 0").groupBy("node")
                .agg(F.first("sig").alias("sig"), F.first("bands").alias("bands"), F.first("n_shingles").alias("size"),
                     F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "h")).alias("rep")))
    reps = materialize(reps, "minhash-classes")
    buckets = reps.select("node", "bands").mapInArrow(_buckets, "bucket bigint, node binary")
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    members = materialize(buckets.join(small(materialize(shared, "minhash-shared")), "bucket"), "minhash-members")

    # From here on only the classes that share a bucket with another one matter.
    nodes = materialize(members.select("node").distinct(), "minhash-nodes")
    reps = materialize(reps.join(small(nodes), "node", "left_semi").select("node", "sig", "size", "rep"), "minhash-open-classes")
    asked = reps.select("node", F.col("rep.doc_id").alias("rep_id"), F.col("rep.h").alias("rep_h"))
    found = ids(docs, "h", "inner", asked, "rep_h", asked.count(), 64).where("doc_id <=> rep_id")
    texts = materialize(found.select("node", "text").dropDuplicates(["node"])
                             .withColumn("number", F.monotonically_increasing_id()), "minhash-texts")

    def verify(pairs: DataFrame) -> DataFrame:
        sig = reps.select("node", "sig")
        with_sig = (pairs.join(small(sig.toDF("a", "sig_a"), reps), "a").join(small(sig.toDF("b", "sig_b"), reps), "b"))
        open_pairs = materialize(with_sig.mapInArrow(_prune(percent / 100, miss), "a binary, b binary"), "minhash-open")
        side = [small(texts.select(F.col("node").alias(c), F.col("text").alias(f"text_{c}")), texts) for c in "ab"]
        with_text = open_pairs.join(side[0], "a").join(side[1], "b")
        return with_text.mapInArrow(_confirm(shingle, percent), "a binary, b binary")

    def sweep(regions: DataFrame) -> DataFrame:
        nodes = materialize(regions, "minhash-region-nodes")
        # Nodes outside their region's largest component meet all others, block by block.
        size = nodes.groupBy("region", "label").agg(F.count("*").alias("n"))
        main = size.groupBy("region").agg(F.max(F.struct("n", "label")).alias("main"), F.sum("n").alias("n"))
        main = materialize(main.where("n > 2").select("region", "main.label", "n"), "minhash-regions")   # two were compared
        nodes = materialize(nodes.join(small(main.select("region", F.col("label").alias("main"), "n"), main), "region"), "minhash-open-nodes")
        rows = materialize(texts.select("node", "text").join(small(nodes), "node").join(small(reps.select("node", "sig"), reps), "node"), "minhash-sweep")
        deal = F.xxhash64("node")
        cols = ["region", "l", "r", "node", "label", "text", "sig"]
        lblocks, rblocks = F.expr(f"cast(ceil(n / {LEFT}) as int)"), F.expr(f"cast(ceil(n / {RIGHT}) as int)")
        left = (rows.where("label <> main").withColumn("l", F.pmod(deal, lblocks).cast("int"))
                    .withColumn("r", F.explode(F.sequence(F.lit(0), rblocks - 1))))
        right = (rows.withColumn("r", F.pmod(deal, rblocks).cast("int"))
                     .withColumn("l", F.explode(F.sequence(F.lit(0), lblocks - 1))))
        key = ["region", "l", "r"]
        return (left.select(cols).groupBy(*key).cogroup(right.select(cols).groupBy(*key))
                    .applyInArrow(_compare(shingle, percent, miss), "a binary, b binary"))

    # How many shingles of a candidate no other candidate has.
    alone = (texts.select("text", "number").mapInArrow(_shingle_rows(shingle), "shingle bigint, number bigint")
                    .groupBy("shingle").agg(F.count("*").alias("n"), F.min("number").alias("number")).where("n = 1")
                    .groupBy("number").agg(F.count("*").alias("alone")))
    alone = materialize(alone, "minhash-alone")
    sizes = (texts.select("node", "number").join(small(alone), "number", "left").join(small(reps.select("node", "size"), reps), "node")
                  .select("node", "size", (F.col("size") - F.coalesce("alone", F.lit(0))).alias("reach")))
    sizes = materialize(sizes, "minhash-sizes")
    label = materialize(link_members(members.join(small(sizes), "node"), verify, percent, "minhash", sweep), "minhash-labels")
    rows = (rows.select("doc_id", "n_shingles", "node").join(small(label), "node", "left")
                .withColumn("part", F.when(F.col("n_shingles") > 0, F.coalesce("label", "node"))))
    least = rows.where("part is not null").groupBy("part").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")).where("n > 1")
    least = materialize(least.select("part", "least", F.lit(True).alias("grouped")), "minhash-least")
    out = rows.join(small(least), "part", "left")
    out = out.withColumn("component_id", F.when(F.col("grouped"), F.col("least")).otherwise(F.col("doc_id")))
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
