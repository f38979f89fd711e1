"""Toxic spans by a linear-chain conditional random field over words.

States are toxic (T) and other (O).  A word's features are the word and its leading
3 to 8 bytes (A-Z lower-cased); a T-T bonus couples neighbours.  Training uses a bounded
sample of labelled rows (``sample`` rows of each class, texts of at most ``sample_chars``
code points): features that are much more frequent in toxic texts are selected; words of
toxic texts that carry a strong one are the T tokens; the field's weights are fitted by
gradient ascent on the conditional likelihood.  Exact marginals come from
forward-backward.  Words without a selected feature all act alike, so a run of n of them
is the n-th power of one 2 x 2 step; this is exact and skips most of the text.

A document's score is a logistic function, fitted on the same sample, of the expected
number of toxic words, their rate and the largest marginal.

Defined results.  A null or empty text, or one without letters, is scored like a text
with no toxic word.  Without labelled toxic and clean rows every score is 0.  Of repeated
labels the largest counts; a label that is null is no label.  Rows that repeat a doc_id
are scored one by one.  A null doc_id is not held out and never trained on.  labels,
lang, source and doc_id are no inputs of a score.  Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerlake.llm import words as W
from offerlake.llm.spark import arrow_batches

SAMPLE = 2000                 # labelled rows of each class to learn from
SAMPLE_CHARS = 8000           # longer texts are not learned from (all are scored)
FEATURES = 4096               # most features of the field
PREFIXES = range(3, 9)        # bytes
SEGMENT = 32                  # words of one training sequence
STEPS = 80                    # of gradient ascent
_WHOLE = np.uint64(0x5851F42D4C957F2D)
_POWERS = 512                 # by then a run of plain words has forgotten where it began


@dataclass
class Field:
    """A fitted model; all arrays are bounded by FEATURES."""

    keys: np.ndarray          # sorted feature hashes
    weights: np.ndarray
    heads: np.ndarray         # 65,536 flags: two first bytes that some feature has
    bias: float
    bonus: float
    doc: np.ndarray           # weights of the document's score, intercept last


def _features(data, starts, ends) -> np.ndarray:
    """(words, 1 + prefixes) feature hashes; 0 where the word is too short."""
    cols = [W.hashes(data, starts, ends, W.LOWER) ^ _WHOLE]
    for k in PREFIXES:
        h = W.hashes(data, starts, np.minimum(ends, starts + k), W.LOWER)
        cols.append(np.where(ends - starts > k, h, np.uint64(0)))
    return np.stack(cols, 1) if len(starts) else np.zeros((0, 1 + len(PREFIXES)), np.uint64)


def _head(data, starts, ends) -> np.ndarray:
    second = np.where(ends - starts > 1, W.LOWER[data[np.minimum(starts + 1, max(len(data) - 1, 0))]], 0)
    return W.LOWER[data[starts]].astype(np.int64) * 256 + second


def _sparse(keys: np.ndarray, feats: np.ndarray) -> np.ndarray:
    """Index of every feature in keys, len(keys) where it is none."""
    if not len(keys):
        return np.zeros(feats.shape, np.int64)
    at = np.searchsorted(keys, feats)
    return np.where(keys[np.minimum(at, len(keys) - 1)] == feats, at, len(keys))


def _forward_backward(emit: np.ndarray, size: np.ndarray, bonus: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """P(T) of each word, P(T, T) of each neighbouring pair and log Z, of padded sequences."""
    n, steps = emit.shape
    live = np.arange(steps)[None, :] < size[:, None]
    e = np.where(live, np.exp(np.clip(emit, -30, 30)), 0.0)
    a = math.exp(bonus)
    alpha, scale = np.zeros((n, steps, 2)), np.ones((n, steps))
    one = live.astype(float)
    alpha[:, 0, 0], alpha[:, 0, 1] = 1.0, e[:, 0]
    for t in range(steps):
        if t:
            o, x = alpha[:, t - 1, 0], alpha[:, t - 1, 1]
            alpha[:, t, 0] = np.where(one[:, t] > 0, o + x, o)
            alpha[:, t, 1] = np.where(one[:, t] > 0, (o + a * x) * e[:, t], x)
        scale[:, t] = alpha[:, t].sum(1)
        alpha[:, t] /= scale[:, t, None]
    beta = np.ones((n, steps, 2))
    for t in range(steps - 2, -1, -1):
        up = one[:, t + 1] > 0
        bo, bt = beta[:, t + 1, 0], beta[:, t + 1, 1] * e[:, t + 1]
        beta[:, t, 0] = np.where(up, bo + bt, 1.0)
        beta[:, t, 1] = np.where(up, bo + a * bt, 1.0)
        beta[:, t] /= beta[:, t].max(1, keepdims=True)
    both = alpha * beta
    p = both[:, :, 1] / both.sum(2)
    pair = np.zeros((n, steps))
    bo, bt = beta[:, 1:, 0], beta[:, 1:, 1] * e[:, 1:]
    tt = alpha[:, :-1, 1] * a * bt
    total = alpha[:, :-1, 0] * (bo + bt) + alpha[:, :-1, 1] * bo + tt
    pair[:, 1:] = np.where(live[:, 1:], tt / np.maximum(total, 1e-300), 0)
    return np.where(live, p, 0), pair, np.log(scale).sum(1)


def fit(rows: list[tuple[str | None, int]], share: float | None = None) -> Field | None:
    """Fit the field on (text, toxic) rows; ``share`` is the true share of toxic texts."""
    n = Counter(y for _, y in rows)
    if not n[0] or not n[1]:
        return None
    docs, seen = [], [Counter(), Counter()]
    for text, y in rows:
        data, bounds = W.texts(pa.array([text], pa.string()))
        starts, ends, _ = W.spans(data, bounds, W.LETTERS)
        feats = _features(data, starts, ends)
        docs.append((feats, _head(data, starts, ends), y))
        if y:
            seen[1].update(np.unique(feats).tolist())
    strong = {f for f, c in seen[1].items() if f and c >= 4}
    for feats, _, y in docs:
        if not y:
            seen[0].update(strong.intersection(np.unique(feats).tolist()))
    odds = {f: math.log((seen[1][f] + .5) / (n[1] + 1)) - math.log((seen[0][f] + .5) / (n[0] + 1)) for f in strong}
    best = sorted((f for f in odds if odds[f] > 1.5), key=lambda f: (-odds[f] * math.log1p(seen[1][f]), f))[:FEATURES]
    keys = np.array(sorted(best), np.uint64)
    sure = np.array([odds[f] >= 3 for f in sorted(best)] + [False])
    heads = np.zeros(65536, bool)
    del seen, strong, odds                       # the driver keeps little of what it has counted

    # Training sequences: every segment with a feature, and one of 20 of the plain ones.
    index, label, size, weight = [], [], [], []
    sparse = []
    for d, (feats, head, y) in enumerate(docs):
        docs[d] = None
        at = _sparse(keys, feats).astype(np.int32)
        active = (at < len(keys)).any(1)
        heads[head[active]] = True
        sparse.append((at, active, y))
        for i in range(0, len(at), SEGMENT):
            part = slice(i, min(i + SEGMENT, len(at)))
            if active[part].any() or (d + i // SEGMENT) % 20 == 0:
                k = part.stop - part.start
                pad = np.full((SEGMENT, at.shape[1]), len(keys), np.int32)
                pad[:k] = at[part]
                y_t = np.zeros(SEGMENT)
                y_t[:k] = y * sure[at[part]].any(1)
                index.append(pad), label.append(y_t), size.append(k)
                weight.append(1.0 if active[part].any() else 20.0)
    index, label, size, weight = np.array(index), np.array(label), np.array(size), np.array(weight)
    total = weight.sum()
    theta = np.zeros(len(keys) + 3)              # feature weights, the absent feature, bias, bonus
    theta[-2] = -4.0
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    live = np.arange(SEGMENT)[None, :] < size[:, None]
    y_pair = np.zeros_like(label)
    y_pair[:, 1:] = label[:, 1:] * label[:, :-1]
    for step in range(1, STEPS + 1):
        p, pair, _ = _forward_backward(theta[:-2][index].sum(2) + theta[-2], size, theta[-1])
        miss = (label - p) * live * weight[:, None]
        g = np.zeros_like(theta)
        g[:-2] = np.bincount(index.ravel(), np.repeat(miss.ravel(), index.shape[2]), len(keys) + 1)
        g[-2], g[-1] = miss.sum(), ((y_pair - pair) * weight[:, None]).sum()
        g = g / total - 1e-4 * theta
        g[len(keys)] = 0                         # the absent feature keeps weight 0
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        theta += 0.25 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    field = Field(keys, theta[:-2], heads, float(theta[-2]), float(theta[-1]), np.zeros(4))

    x = np.array([summary(marginals(field, at[active], np.flatnonzero(active), len(at)), len(at)) for at, active, _ in sparse])
    x1, y = np.hstack([x, np.ones((len(x), 1))]), np.array([y for *_, y in sparse], float)
    coef = np.zeros(4)
    for _ in range(30):                          # Newton steps of a ridge logistic regression
        q = 1 / (1 + np.exp(-np.clip(x1 @ coef, -30, 30)))
        ridge = np.array([0.5, 0.5, 0.5, 1e-6])
        h = (x1 * (q * (1 - q))[:, None]).T @ x1 + np.diag(ridge)
        coef = coef + np.linalg.solve(h, x1.T @ (y - q) - ridge * coef)
    if share:                                    # the sample holds other shares than the corpus
        coef[-1] += math.log(share / (1 - share)) - math.log(n[1] / n[0])
    field.doc = coef
    return field


def marginals(field: Field, index: np.ndarray, place: np.ndarray, n: int) -> np.ndarray:
    """P(T) of the words at ``place`` (those with features ``index``) in a text of n words."""
    if not len(place):
        return np.zeros(0)
    a, b = math.exp(field.bonus), math.exp(field.bias)
    emit = np.exp(np.clip(field.weights[index].sum(1) + field.bias, -30, 30)).tolist()
    ahead, behind = _steps(a, b)
    k, gaps = len(place), np.diff(place).tolist()

    def move(table, gap, r):
        w, x, y, z = table[min(gap, _POWERS)]
        return (w * r + x) / (y * r + z)

    forward, r = [], 0.0                         # odds of T from the left
    for i in range(k):
        if i == 0:
            r = emit[0] if place[0] == 0 else None
            if r is None:                        # plain words in front: the first has odds b
                r = move(ahead, int(place[0]) - 1, b)
                r = emit[0] * (1 + a * r) / (1 + r)
        else:
            r = move(ahead, gaps[i - 1] - 1, r)
            r = emit[i] * (1 + a * r) / (1 + r)
        forward.append(r)
    out = [0.0] * k
    s = move(behind, n - 1 - int(place[-1]), 1.0)   # odds of T from the right
    for i in range(k - 1, -1, -1):
        odds = forward[i] * s
        out[i] = odds / (1 + odds)
        s = (1 + a * emit[i] * s) / (1 + emit[i] * s)
        if i:
            s = move(behind, gaps[i - 1] - 1, s)
    return np.array(out)


_tables: dict = {}


def _steps(a: float, b: float) -> tuple[list, list]:
    """Powers of one step over a plain word, on odds, from the left and from the right."""
    if (a, b) not in _tables:
        both = []
        for step in (np.array([[a * b, b], [1, 1]]), np.array([[a * b, 1], [b, 1]])):
            now, rows = np.eye(2), []
            for _ in range(_POWERS + 1):
                rows.append(tuple(now.ravel().tolist()))
                now = step @ now
                now = now / now.max()
            both.append(rows)
        _tables[a, b] = tuple(both)
    return _tables[a, b]


def summary(p: np.ndarray, n: int) -> list[float]:
    total = float(p.sum())
    return [math.log1p(total), 10 * total / max(n, 20), float(p.max()) if len(p) else 0.0]


def _score(field: Field | None, span_at: float):
    def run(batches):
        for batch in batches:
            data, bounds = W.texts(batch.column("text"))
            scores, expected, tokens, found = [], [], [], []
            for i, j in W.pieces(bounds):
                part, at = data[bounds[i]:bounds[j]], bounds[i:j + 1] - bounds[i]
                starts, ends, first = W.spans(part, at, W.LETTERS)
                tokens.extend(np.diff(first).tolist())
                if field is None:
                    scores.extend([0.0] * (j - i)), expected.extend([0.0] * (j - i)), found.extend([""] * (j - i))
                    continue
                maybe = np.flatnonzero(field.heads[_head(part, starts, ends)]) if len(starts) else np.zeros(0, np.int64)
                index = _sparse(field.keys, _features(part, starts[maybe], ends[maybe]))
                some = (index < len(field.keys)).any(1)
                maybe, index = maybe[some], index[some]
                cut = np.searchsorted(maybe, first)
                for d in range(j - i):
                    lo, hi, n = cut[d], cut[d + 1], int(first[d + 1] - first[d])
                    p = marginals(field, index[lo:hi], maybe[lo:hi] - first[d], n)
                    x = summary(p, n)
                    z = float(np.dot(field.doc[:3], x) + field.doc[3])
                    scores.append(1 / (1 + math.exp(-max(-60.0, min(60.0, z)))))
                    expected.append(float(p.sum()))
                    hits = maybe[lo:hi][p >= span_at]
                    if len(hits):
                        points = W.code_points(part[at[d]:at[d + 1]])
                        found.append(",".join(f"{points[starts[h] - at[d]]}:{points[ends[h] - at[d]]}" for h in hits))
                    else:
                        found.append("")
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64()), pa.array(expected, pa.float64()),
                 pa.array(tokens, pa.int64()), pa.array(found, pa.string())],
                names=["doc_id", "score", "expected_toxic", "n_words", "spans"])
    return run


def held_out(col):
    """crc32 of the id as text, mod 5, is 0; a null id is not held out."""
    return F.coalesce(F.crc32(col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          sample: int = SAMPLE, sample_chars: int = SAMPLE_CHARS) -> Field | None:
    """Fit the field on at most ``sample`` rows of each class that are not held out."""
    rows = (labels.where(F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
                  .groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).alias("y")).where("y in (0, 1)"))
    counts = {r.y: r.n for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    order = [F.xxhash64("id"), F.col("id")]
    picked = [rows.where(F.col("y") == y).orderBy(*order).limit(sample) for y in (0, 1)]
    chosen = picked[0].union(picked[1])                      # bounded: 2 * sample rows
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    got = (texts.where(F.length("text") <= sample_chars).join(F.broadcast(chosen), "id")
                .orderBy(F.xxhash64("id"), "id", F.xxhash64("text")).limit(2 * sample)
                .select("text", F.col("y").cast("int").alias("y")).collect())
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    return fit([(r.text, r.y) for r in got], share if 0 < share < 1 else None)


def score(docs: DataFrame, field: Field | None, *, id_col: str = "doc_id", text_col: str = "text",
          span_at: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted, expected_toxic, n_words and spans (start:end in
    code points, comma-joined) of every row of ``docs``."""
    arrow_batches(docs.sparkSession)
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    out = docs.mapInArrow(_score(field, span_at), f"doc_id {kind}, score double, expected_toxic double, n_words bigint, spans string")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"), "expected_toxic", "n_words", "spans")
