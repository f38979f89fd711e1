"""Quality rules and line labelling by a linear-chain conditional random field.

Base rules count, over the whole text, words, symbols, repeated lines and words in
8-word windows that occur twice or more.  Then every line is described by a few numbers
(``FEATURES``) and the Viterbi path of a two-state field marks each line as content or
boilerplate.  A document is kept if its base rules hold and at least ``MIN_CONTENT`` of
its words lie in content lines.

The field is fitted on a bounded sample (``sample`` labelled rows of each class that are
not held out, texts of at most ``sample_chars`` code points): lines of rows of good quality
are content, lines of rows of poor quality boilerplate.  With a bias and one bonus for
neighbouring content lines, the transitions of a two-state chain are complete up to the
first and last line.

Defined results.  A null text has no words; such rows and empty texts fail the base rules.
Without rows of both classes, every line is content.  Rows that repeat a doc_id are judged
one by one.  Of repeated labels the largest counts.  Extra columns are ignored.  A tie of
two Viterbi paths goes to content.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerlake.llm import words as W
from offerlake.llm.spark import arrow_batches
from offerlake.llm.toxicity import _forward_backward, held_out

SYMBOLS = b"#*$%&|<>"         # fixed values
WINDOW = 8
MIN_WORDS, MAX_REPEAT = 20, 30        # least words; largest percentage of repeated words
MIN_CONTENT = 0.5
SAMPLE, SAMPLE_CHARS = 2000, 8000
GOOD_WEIGHT = 5               # a good document dropped costs as much as so many poor ones kept
SEGMENT = 64                  # lines of one training sequence
STEPS = 150
FEATURES = ("words", "symbols", "upper", "digits", "repeats", "bars", "full_stop", "seen_before", "very_short", "long_words")


def _table(chars) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(chars)] = True
    return t


_SYMBOL, _UPPER, _DIGIT, _NEWLINE = _table(SYMBOLS), _table(range(65, 91)), _table(range(48, 58)), 10


@dataclass
class Lines:
    """What is known of the lines and words of some texts."""

    first: np.ndarray         # index of each text's first line, and the number of lines
    n_words: np.ndarray       # of each line
    x: np.ndarray             # features of each line
    doc: np.ndarray           # per text: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words


def _repeated(windows: np.ndarray) -> int:
    """Words covered by windows that occur twice or more."""
    _, inverse, counts = np.unique(windows, return_inverse=True, return_counts=True)
    twice = np.flatnonzero(counts[inverse] > 1)
    if not len(twice):
        return 0
    return int(np.minimum(np.diff(np.append(twice, twice[-1] + WINDOW)), WINDOW).sum())


def describe(data: np.ndarray, bounds: np.ndarray) -> Lines:
    breaks = np.flatnonzero(data == _NEWLINE)
    line_start = np.sort(np.concatenate([bounds[:-1], breaks + 1]), kind="stable")
    # A break at the end of a text begins its last, empty line, just before the next text's first.
    n_lines = np.searchsorted(breaks, bounds[1:]) - np.searchsorted(breaks, bounds[:-1]) + 1
    first = np.concatenate([[0], np.cumsum(n_lines)])
    of_text = np.repeat(np.arange(len(n_lines)), n_lines)
    line_end = np.append(line_start[1:], len(data))
    line_end = np.where(np.arange(len(line_start)) + 1 == first[of_text + 1], bounds[of_text + 1], line_end - 1)

    starts, ends, at = W.spans(data, bounds, W.NOT_SPACE)
    word = W.hashes(data, starts, ends)
    lo = np.searchsorted(starts, line_start)
    hi = np.searchsorted(starts, line_end)
    n = hi - lo

    def count(flags):
        total = np.concatenate([[0], np.cumsum(flags)])
        return total[line_end] - total[line_start], total

    symbols, symbols_to = count(_SYMBOL[data])
    upper, _ = count(_UPPER[data])
    digits, _ = count(_DIGIT[data])
    points, points_to = count((data & 0xC0) != 0x80)
    same = np.concatenate([[False], word[1:] == word[:-1]]) if len(word) else np.zeros(0, bool)
    same_to = np.concatenate([[0], np.cumsum(same)])
    bar = np.concatenate([[0], np.cumsum((ends - starts == 1) & (data[starts] == 124))]) if len(word) else np.zeros(1, np.int64)
    last = np.where(n > 0, data[ends[np.maximum(hi - 1, 0)] - 1] if len(ends) else 0, 0)
    stop = np.isin(last, np.frombuffer(b".!?:;\"')", np.uint8))

    doc = np.zeros((len(n_lines), 5), np.int64)
    doc[:, 0] = np.diff(at)
    word_points = points_to[ends] - points_to[starts] if len(starts) else np.zeros(0, np.int64)
    doc[:, 1] = np.diff(np.concatenate([[0], np.cumsum(word_points)])[at])
    doc[:, 2] = symbols_to[bounds[1:]] - symbols_to[bounds[:-1]]
    dup = np.zeros(len(line_start), bool)
    raw = data.tobytes()
    for d in range(len(n_lines)):
        seen = set()
        for k in range(first[d], first[d + 1]):
            if n[k]:
                line = raw[line_start[k]:line_end[k]]
                dup[k] = line in seen
                seen.add(line)
    doc[:, 3] = np.diff(np.concatenate([[0], np.cumsum(dup)])[first])
    window = np.zeros(max(0, len(word) - WINDOW + 1), np.uint64)
    for i in range(WINDOW if len(window) else 0):
        window = W.mix(window) + word[i:len(word) - WINDOW + 1 + i]
    for d in np.flatnonzero(doc[:, 0] > WINDOW):
        doc[d, 4] = _repeated(window[at[d]:at[d + 1] - WINDOW + 1])

    chars, some = np.maximum(points, 1), np.maximum(n, 1)
    x = np.stack([np.log1p(n) / 4, 10 * symbols / chars, upper / chars * 3, digits / chars * 3, (same_to[hi] - same_to[np.minimum(lo + 1, hi)]) / some,
                  (bar[hi] - bar[lo]) / some * 3, stop, dup, n < 4, np.clip(points / some / 10, 0, 3)], 1).astype(float)
    return Lines(first, n, x, doc)


@dataclass
class Field:
    weights: np.ndarray
    bias: float
    bonus: float


def fit(rows: list[tuple[str | None, int]]) -> Field | None:
    """Fit on (text, quality) rows: every line of a text has the text's label."""
    if {y for _, y in rows} != {0, 1}:
        return None
    xs, ys, sizes = [], [], []
    for text, y in rows:
        data, bounds = W.texts(pa.array([text], pa.string()))
        lines = describe(data, bounds)
        x = lines.x[lines.n_words > 0]
        for i in range(0, len(x), SEGMENT):
            part = x[i:i + SEGMENT]
            pad = np.zeros((SEGMENT, x.shape[1]))
            pad[:len(part)] = part
            xs.append(pad), ys.append(y), sizes.append(len(part))
    x, y, size = np.array(xs), np.array(ys, float), np.array(sizes)
    live = np.arange(SEGMENT)[None, :] < size[:, None]
    # Each text counts by its lines' mean, each class by its weight.
    weight = (1 / size) / (1 + GOOD_WEIGHT) * np.where(y == 1, GOOD_WEIGHT / max(1, (y == 1).sum()), 1 / max(1, (y == 0).sum()))
    label = live * y[:, None]
    pairs = np.zeros_like(label)
    pairs[:, 1:] = label[:, 1:] * label[:, :-1]
    theta = np.zeros(x.shape[2] + 2)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        p, both, _ = _forward_backward(x @ theta[:-2] + theta[-2], size, theta[-1])
        miss = (label - p) * weight[:, None]
        g = np.concatenate([np.einsum("ij,ijk->k", miss, x), [miss.sum(), ((pairs - both) * weight[:, None]).sum()]]) - 1e-4 * theta
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        theta += 0.15 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Field(theta[:-2], float(theta[-2]), float(theta[-1]))


def viterbi(emit: list[float], bonus: float) -> list[bool]:
    """Best path: is each line content?  ``emit`` is content's score over boilerplate's."""
    if not emit:
        return []
    other, content, back = 0.0, emit[0], []
    for e in emit[1:]:
        from_other, from_content = other, content + bonus
        back.append((content >= other, from_content >= from_other))
        other, content = max(other, content), e + max(from_other, from_content)
    state = content >= other
    path = [state]
    for to_other, to_content in reversed(back):
        state = to_content if state else to_other
        path.append(state)
    return path[::-1]


def _run(field: Field | None, min_content: float):
    def run(batches):
        for batch in batches:
            data, bounds = W.texts(batch.column("text"))
            for i, j in W.pieces(bounds):
                lines = describe(data[bounds[i]:bounds[j]], bounds[i:j + 1] - bounds[i])
                emit = (lines.x @ field.weights + field.bias) if field else np.ones(len(lines.x))
                bonus = field.bonus if field else 0.0
                filled = lines.n_words > 0
                shares, n_content, n_filled = [], [], []
                for d in range(j - i):
                    part = slice(lines.first[d], lines.first[d + 1])
                    keep = filled[part]
                    path = np.array(viterbi(emit[part][keep].tolist(), bonus), bool)
                    n = lines.n_words[part][keep]
                    shares.append(float(n[path].sum() / n.sum()) if len(n) else 0.0)
                    n_content.append(int(path.sum())), n_filled.append(len(n))
                doc = lines.doc
                failed = (doc[:, 0] < MIN_WORDS) | (100 * doc[:, 4] > MAX_REPEAT * doc[:, 0])
                kept = ~failed & (np.array(shares) >= min_content)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i), *[pa.array(doc[:, c]) for c in range(5)], pa.array(failed), pa.array(kept),
                     pa.array(shares, pa.float64()), pa.array(n_filled, pa.int64()), pa.array(n_content, pa.int64())],
                    names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                           "content_share", "n_lines", "n_content_lines"])
    return run


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          sample: int = SAMPLE, sample_chars: int = SAMPLE_CHARS) -> Field | None:
    """Fit the field on at most ``sample`` rows of each class that are not held out."""
    rows = (labels.where(F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
                  .groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).alias("y")).where("y in (0, 1)"))
    picked = [rows.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(sample) for y in (0, 1)]
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    got = (texts.where(F.length("text") <= sample_chars).join(F.broadcast(picked[0].union(picked[1])), "id")
                .orderBy(F.xxhash64("id"), "id", F.xxhash64("text")).limit(2 * sample)
                .select("text", F.col("y").cast("int").alias("y")).collect())
    return fit([(r.text, r.y) for r in got])


def judge(docs: DataFrame, field: Field | None, *, id_col: str = "doc_id", text_col: str = "text",
          min_content: float = MIN_CONTENT) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    content_share, n_lines and n_content_lines (lines with a word) of every row."""
    arrow_batches(docs.sparkSession)
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(_run(field, min_content),
                           f"doc_id {kind}, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
                           "base_failed boolean, kept boolean, content_share double, n_lines bigint, n_content_lines bigint")
