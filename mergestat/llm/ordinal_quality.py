"""Quality classifier: ordinal cumulative-link regression on graded ratings.

One weight vector over hashed text features is shared by all grades; ordered
thresholds t_0 < t_1 < ... cut the score s = w.x into grades by
P(grade <= k) = sigmoid(t_k - s).  From that come the expected grade and the
tail probability P(grade >= k) by which documents are selected.

Features of a whole text, hashed to ``DIMS`` slots: its distinct lower-case
words and runs of punctuation; word beginnings of 4 and 6 characters, each once
and once more when ``OFTEN`` distinct words begin so; and the shares of distinct
words and distinct lines in tenths.  The loss is the mean negative log likelihood
plus an L1 term, minimised by proximal AdaGrad; the L1 term is ``l1_docs``
documents' worth of gradient, so features that no such number of documents
speaks for keep weight zero and long texts gather no noise.

Scale: fitted in one task on at most ``max_rows`` labelled rows (the lowest in
hash order of their id); scoring is one pass over the documents without a
shuffle, whose broadcast model holds at most ``DIMS`` weights.

Defined cases: labels with a null id or grade are not used; a document labelled
twice counts twice; a null text counts as empty and is scored by the thresholds
alone; without any usable label every probability is null and every document is
kept; repeated rows are scored alike; all input columns are kept.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh

DIMS = 1 << 20
MAX_ROWS = 5000
GRADES = 3
#: Words whose features a scoring task remembers.
CACHE_WORDS = 120_000

#: Distinct words that must share a beginning for its second feature.
OFTEN = 3

#: Every so many steps the fit looks at all features again.
REFRESH = 10

_TOKEN = re.compile(r"[^\W_]+|[^\w\s]+|_+")


def _slot(name: str) -> int:
    return zlib.crc32(name.encode()) % DIMS


def _word_slots(word: str) -> tuple[list[int], list[tuple[int, int]]]:
    """Slots of a word's tokens, and (once, often) slots of its beginnings."""
    tokens = _TOKEN.findall(word)
    stem = next((t for t in tokens if t[0].isalnum()), "")
    starts = {stem[:n] for n in (4, 6) if len(stem) >= n}
    return ([_slot(t) for t in tokens],
            [(_slot("^" + x), _slot("^^" + x)) for x in sorted(starts)])


def _shape_slots(text: str, words: list[str], distinct: int) -> list[int]:
    lines = text.split("\n")
    return [_slot(f"words {10 * distinct // max(1, len(words))}"),
            _slot(f"lines {10 * len(set(lines)) // len(lines)}")]


def features(text: str | None) -> np.ndarray:
    """Sorted distinct feature slots of a whole text."""
    text = (text or "").lower()
    words = text.split()
    distinct = set(words)
    found: set[int] = set(_shape_slots(text, words, len(distinct)))
    starts: Counter = Counter()
    for w in distinct:
        slots, begins = _word_slots(w)
        found.update(slots)
        starts.update(begins)
    for (once, often), n in starts.items():
        found.add(once)
        if n >= OFTEN:
            found.add(often)
    return np.array(sorted(found), np.int32)


def _sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


def fit(rows: list[np.ndarray], grade: np.ndarray, grades: int = GRADES, l1_docs: float = 3.0,
        steps: int = 200, rate: float = 0.2) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(slots, weights, thresholds) of the cumulative-link model."""
    n = len(rows)
    flat, row = np.concatenate([*rows, np.empty(0, np.int32)]), np.repeat(np.arange(n), [len(r) for r in rows])
    slots, col, seen = np.unique(flat, return_inverse=True, return_counts=True)
    # the gradient of a feature in so few documents never exceeds the L1 term
    live = seen > l1_docs
    row, col = row[live[col]], (np.cumsum(live) - 1)[col[live[col]]]
    slots = slots[live]
    # thresholds start at the smoothed cumulative shares
    share = (np.cumsum(np.bincount(grade, minlength=grades))[:-1] + 0.5) / (n + 1)
    share = np.maximum.accumulate(share + 1e-6 * np.arange(1, grades))
    t = np.log(share / (1 - share))
    base, gap = t[0], np.log(np.maximum(np.diff(t), 1e-3))
    w = np.zeros(len(slots))
    past_w, past_t = np.zeros(len(slots)), np.zeros(grades - 1)
    part = slice(None)
    for step in range(steps):
        if step % REFRESH == 0:
            part = slice(None)
        r, c = row[part], col[part]
        t = base + np.concatenate([[0], np.cumsum(np.exp(gap))])
        s = np.bincount(r, w[c], n)
        below = _sigmoid(np.concatenate([t, [np.inf]])[grade] - s)
        lower = _sigmoid(np.concatenate([[-np.inf], t])[grade] - s)
        p = np.maximum(below - lower, 1e-12)
        g_s = (1 - below - lower) / n
        g_w = np.bincount(c, g_s[r], len(slots))
        up, down = below * (1 - below) / p / n, lower * (1 - lower) / p / n
        g_cut = np.array([down[grade == k + 1].sum() - up[grade == k].sum() for k in range(grades - 1)])
        tail = np.cumsum(g_cut[::-1])[::-1]
        g_t = np.concatenate([[tail[0]], tail[1:] * np.exp(gap)])
        past_w += g_w * g_w
        past_t += g_t * g_t
        step_w = rate / (np.sqrt(past_w) + 1e-9)
        w -= step_w * g_w
        w = np.sign(w) * np.maximum(np.abs(w) - step_w * l1_docs / n, 0)
        if step % REFRESH == 0:
            # until the next full step only features that can leave zero move
            part = np.flatnonzero(((w != 0) | (np.abs(g_w) > 0.9 * l1_docs / n))[col])
        step_t = 0.5 * rate / (np.sqrt(past_t) + 1e-9) * g_t
        base, gap = base - step_t[0], np.clip(gap - step_t[1:], -12, 4)
    t = base + np.concatenate([[0], np.cumsum(np.exp(gap))])
    on = w != 0
    return slots[on], w[on], t


def train(docs: DataFrame, ratings: DataFrame, ident: str = "doc_id", text: str = "text",
          grade: str = "grade", grades: int = GRADES, max_rows: int = MAX_ROWS,
          l1_docs: float = 3.0) -> dict | None:
    """Fit on at most ``max_rows`` rated documents; None where no rating meets a document.

    Those are the lowest in hash order of id and text; documents equal in id, text and
    grade count once.
    """
    rated = (ratings.select(F.col(f"`{ident}`").alias("rated"), F.col(f"`{grade}`").cast("int").alias("grade"))
             .where(F.col("rated").isNotNull() & F.col("grade").between(0, grades - 1)).distinct()
             .orderBy(F.xxhash64("rated"), "rated", "grade").limit(max_rows))
    known = docs.select(F.col(f"`{ident}`").alias("ident"), F.col(f"`{text}`").alias("text")).join(
        F.broadcast(rated), F.col("ident") == F.col("rated")).select(
        "ident", "grade", "text", F.xxhash64("text").alias("h"))
    # ids and hashes are ranked first, so that an id with many documents moves no texts
    picked = (known.select("ident", "grade", "h").distinct()
              .orderBy(F.xxhash64("ident"), "ident", "h", "grade").limit(max_rows)).toDF("i", "g", "of")
    rows = known.join(F.broadcast(picked), (F.col("ident") == F.col("i")) & (F.col("grade") == F.col("g")) & (F.col("h") == F.col("of"))) \
        .groupBy("ident", "grade", "h").agg(F.min("text").alias("text")).select("ident", "grade", "text")

    def extract(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0).cast(pa.int64()), b.column(1),
                 pa.array([features(t) for t in b.column(2).to_pylist()], pa.list_(pa.int32()))],
                ["ident", "grade", "slots"])

    def learn(batches):
        ident, grade, rows = [], [], []
        for b in batches:
            ident += b.column(0).to_pylist()
            grade += b.column(1).to_pylist()
            rows += [np.array(x, np.int32) for x in b.column(2).to_pylist()]
        if rows:
            order = sorted(range(len(rows)), key=lambda k: (ident[k], grade[k]))
            slots, w, t = fit([rows[k] for k in order], np.array([grade[k] for k in order]),
                              grades, l1_docs)
            yield pa.RecordBatch.from_arrays(
                [pa.array([*slots.tolist(), *range(-len(t), 0)], pa.int64()),
                 pa.array([*w.tolist(), *t.tolist()], pa.float64())], ["slot", "value"])

    model = rows.mapInArrow(extract, "ident long, grade int, slots array<int>") \
        .repartition(1).mapInArrow(learn, "slot long, value double").collect()
    if not model:
        return None
    return {"thresholds": [r.value for r in sorted(model) if r.slot < 0],
            "weights": {r.slot: r.value for r in model if r.slot >= 0}}


class _Scorer:
    """w.x of whole texts; remembers which of a word's features carry weight."""

    def __init__(self, weights: dict[int, float]):
        self.weights, self.tokens, self.starts = weights, {}, {}

    def _learn(self, words) -> None:
        for w in words:
            slots, begins = _word_slots(w)
            self.tokens[w] = tuple(s for s in slots if s in self.weights)
            self.starts[w] = tuple(x for x in begins if x[0] in self.weights or x[1] in self.weights)

    def score(self, text: str | None) -> float:
        text = (text or "").lower()
        words = text.split()
        distinct = set(words)
        new = distinct.difference(self.tokens)
        if new:
            if len(self.tokens) > CACHE_WORDS:
                self.tokens.clear()
                self.starts.clear()
                new = distinct
            self._learn(new)
        hit = set(_shape_slots(text, words, len(distinct)))
        hit.update(*filter(None, map(self.tokens.__getitem__, distinct)))
        starts: Counter = Counter(chain.from_iterable(filter(None, map(self.starts.__getitem__, distinct))))
        for (once, often), n in starts.items():
            hit.add(once)
            if n >= OFTEN:
                hit.add(often)
        return sum(self.weights.get(s, 0.0) for s in sorted(hit))


def score(docs: DataFrame, model: dict | None, text: str = "text",
          select_grade: int = GRADES - 1, least: float = 0.5) -> DataFrame:
    """``docs`` with ``expected_grade``, ``p_ge_1`` .. and ``kept``.

    ``kept`` is P(grade >= select_grade) >= least.  A column of ``docs`` of one
    of these names is replaced.
    """
    cuts = np.array(model["thresholds"]) if model else np.empty(0)
    names = [f"p_ge_{k + 1}" for k in range(len(cuts) or GRADES - 1)]
    added = ["expected_grade", *names, "kept"]
    own = [c for c in docs.columns if c not in added]
    if not model:
        return docs.select(*[F.col(f"`{c}`") for c in own],
                           *[F.lit(None).cast("double").alias(c) for c in added[:-1]], F.lit(True).alias("kept"))
    copy = fresh(docs, "read")[0]
    src = docs.select(*[F.col(f"`{c}`") for c in own], F.col(f"`{text}`").alias(copy))
    weights = model["weights"]

    def run(batches):
        scorer = _Scorer(weights)
        for b in batches:
            s = np.array([scorer.score(t) for t in b.column(len(own)).to_pylist()])
            tail = 1 - _sigmoid(cuts[None, :] - s[:, None])
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(tail.sum(1)), *[pa.array(c) for c in tail.T],
                 pa.array(tail[:, select_grade - 1] >= least)], [*own, *added])

    schema = src.drop(copy).schema
    for c in added[:-1]:
        schema = schema.add(c, "double")
    return src.mapInArrow(run, schema.add("kept", "boolean"))


def keep_good(docs: DataFrame, model: dict | None, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``score`` keeps, with their own columns only."""
    names = fresh(docs, *docs.columns)
    own = docs.toDF(*names)
    kept = score(own, model, names[docs.columns.index(text)]).where("kept")
    return kept.select(*[F.col(f"`{n}`").alias(c) for n, c in zip(names, docs.columns)])


def graded(labels: DataFrame) -> DataFrame:
    """Grades of the ``labels`` table: 0 toxic, 1 of low quality, 2 good."""
    known = F.col("quality").isNotNull() & F.col("toxic").isNotNull()
    return labels.where(known).select(
        "doc_id", F.when(F.col("toxic") != 0, 0).when(F.col("quality") == 0, 1).otherwise(2).alias("grade"))
