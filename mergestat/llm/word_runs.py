"""Periodic runs of words, by maximal pairs on the LCP-interval tree.

A run is a stretch of consecutive words with smallest period q (words q apart are
identical), at least ``max(least, copies * q)`` words long, that no neighbouring
word extends.  Two places i < j are a maximal pair if the words before them
differ and the words behind their longest common prefix differ.  A run of period
q that starts at s is exactly the maximal pair (s, s + q) whose common prefix has
length - q words; so maximal pairs at a distance d and of a common prefix L with
``L + d >= max(least, copies * d)`` are runs, and need no extension.  A run also
shows at multiples of its period, with the same stretch: the smallest distance
of a stretch is its period.

Pairs are enumerated bottom-up over the intervals of the LCP array.  Every node
keeps the places below it in text order and, per word to their left, a list of
those places.  When a child joins its parent, each place of the smaller side
looks only at places of the other side within ``L / (copies - 1)`` words, the
distances that can be runs, and jumps over places of its own left-word class by
binary search in that class's list; so the steps are few beside the pairs found.
Intervals with a common prefix too short for any run are never built, and
suffixes are sorted only where their first words recur in the document: ranks by
1, 2, 4, ... words (prefix doubling, many documents at once in numpy) leave a
place out as soon as it is alone.

Scale: one pass over the rows without a shuffle.  A task holds one chunk of
whole documents, ``CHUNK_WORDS`` words or one longer document, with about 4
bytes a word and doubling step.

Defined cases: a null text counts as empty; texts without words have no runs and
an empty collapsed text; repeated rows are treated alike; an empty table gives
no rows; all input columns are kept and those named ``n_words``, ``runs`` or
``collapsed`` are replaced.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

LEAST, COPIES = 24, 3
CHUNK_WORDS = 400_000
RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])


def _ranks(words: np.ndarray, shortest: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Ranks of all places by their first 1, 2, 4, ... words, and the recurring places.

    A rank is the place of the group's first member in sorted order, so ranks of
    groups that are not split stay as they are.  Ends when no two places with
    equal ``shortest`` first words are left together.
    """
    n = len(words)
    sizes = np.bincount(words)
    rank = (np.cumsum(sizes) - sizes)[words].astype(np.int32)
    levels, k = [rank], 1
    active = np.flatnonzero(sizes[words] > 1)
    recurring = None
    while True:
        if recurring is None and 2 * k > shortest:
            recurring = active                 # same first k words, k > shortest / 2
        if not len(active):
            break
        behind = active + k
        nxt = np.where(behind < n, rank[np.minimum(behind, n - 1)] + np.int64(1), 0)
        here = rank[active].astype(np.int64)
        order = np.argsort(here * (n + 1) + nxt)
        here, nxt, active = here[order], nxt[order], active[order]
        new_old = np.concatenate([[True], here[1:] != here[:-1]])
        new = new_old | np.concatenate([[True], nxt[1:] != nxt[:-1]])
        at = np.arange(len(active))
        first_old = np.maximum.accumulate(np.where(new_old, at, 0))
        first = np.maximum.accumulate(np.where(new, at, 0))
        rank = rank.copy()
        rank[active] = here + (first - first_old)
        group = np.cumsum(new) - 1
        active = np.sort(active[np.bincount(group)[group] > 1])
        levels.append(rank)
        k *= 2
    return (recurring if recurring is not None else active), levels


def _common(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the longest common prefix of places ``a`` and ``b``, pair by pair."""
    n = len(levels[0])
    length = np.zeros(len(a), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        x, y = a + length, b + length
        inside = (x < n) & (y < n)
        same = inside & (levels[level][np.minimum(x, n - 1)] == levels[level][np.minimum(y, n - 1)])
        length += same * (1 << level)
    return length


class _Node:
    """Places below an interval: in text order, and by the word to their left."""

    __slots__ = ("places", "by_left")

    def __init__(self, place: int, left: int):
        self.places = [place]
        self.by_left = {left: [place]}


def _near(node: _Node, place: int, left: int, low: int, high: int):
    """Members of ``node`` from ``low`` to ``high`` with another word to their left."""
    places = node.places
    own = node.by_left.get(left)
    at, stop = bisect_left(places, low), bisect_left(places, high + 1)
    while at < stop:
        found = places[at]
        if own is not None:
            k = bisect_left(own, found)
            if k < len(own) and own[k] == found:
                # a block of own class lies side by side in both lists: find its end
                a, b = 1, min(stop - at, len(own) - k)
                while a < b:
                    mid = (a + b + 1) // 2
                    if places[at + mid - 1] == own[k + mid - 1]:
                        a = mid
                    else:
                        b = mid - 1
                at += a
                continue
        yield found
        at += 1


def _joined(big: _Node, small: _Node, length: int, least: int, copies: int, out: list) -> _Node:
    """Both sides under one interval of common prefix ``length``; maximal pairs go to ``out``."""
    if len(big.places) < len(small.places):
        big, small = small, big
    most, closest = length // (copies - 1), max(1, least - length)
    for left, group in small.by_left.items():
        for p in group:
            for q in _near(big, p, left, p - most, p - closest):
                out.append((q, p - q + length, p - q))
            for q in _near(big, p, left, p + closest, p + most):
                out.append((p, q - p + length, q - p))
    for left, group in small.by_left.items():
        mine = big.by_left.setdefault(left, [])
        for p in group:
            for kept in (mine, big.places):
                if kept and kept[-1] > p:
                    insort(kept, p)
                else:
                    kept.append(p)
    return big


def maximal_pairs(words: np.ndarray, least: int = LEAST, copies: int = COPIES) -> list[tuple[int, int, int]]:
    """(start, length, distance) of all maximal pairs that meet the length constraints.

    ``words`` are word numbers, of several documents one behind the other if no
    two documents share a number.
    """
    # L + d >= least and L >= (copies - 1) d leave nothing below this common prefix
    shortest = -(-least * (copies - 1) // copies)
    recurring, levels = _ranks(words, shortest)
    if len(recurring) < 2:
        return []
    suffixes = recurring[np.argsort(levels[-1][recurring], kind="stable")]
    lcp = _common(levels, suffixes[:-1], suffixes[1:])
    left = np.concatenate([[-1], words[:-1]])[suffixes].tolist()
    suffixes, lcp = suffixes.tolist(), lcp.tolist()
    out: list[tuple[int, int, int]] = []
    stack: list[tuple[int, _Node]] = []         # open intervals: common prefix, what lies below

    def close(down_to: int, node: _Node | None) -> _Node | None:
        """Close intervals deeper than ``down_to``; what lies below the last of them."""
        while stack and stack[-1][0] > down_to:
            depth, below = stack.pop()
            node = below if node is None else _joined(below, node, depth, least, copies, out)
        return node

    for k, place in enumerate(suffixes):
        leaf = _Node(place, left[k])
        depth = lcp[k] if k < len(lcp) else 0
        if depth < shortest:
            close(0, leaf)
            continue
        node = close(depth, leaf)
        if stack and stack[-1][0] == depth:
            stack[-1] = (depth, _joined(stack[-1][1], node, depth, least, copies, out))
        else:
            stack.append((depth, node))
    return out


def runs(words: np.ndarray, least: int = LEAST, copies: int = COPIES) -> list[tuple[int, int, int]]:
    """(start, length, smallest period) of every run, by start, then period."""
    best: dict[tuple[int, int], int] = {}
    for start, length, distance in maximal_pairs(words, least, copies):
        if distance < best.get((start, length), distance + 1):
            best[start, length] = distance
    return sorted((s, n, q) for (s, n), q in best.items())


def _collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> list[bytes]:
    """Words that no run holds behind its first period."""
    keep = np.ones(len(words), bool)
    for start, length, period in found:
        keep[start + period:start + length] = False
    return [words[k] for k in np.flatnonzero(keep).tolist()]


def _chunk(texts: list[str], least: int, copies: int) -> list[tuple[int, list, str]]:
    """Number of words, runs and collapsed text of each text."""
    number = count().__next__
    split, ids = [], []
    for t in texts:
        words = t.encode("utf-8").split()       # at 0x20 and 0x09 to 0x0D, as bytes
        split.append(words)
        ids.extend(map(defaultdict(number).__getitem__, words))
    starts = np.cumsum([0, *map(len, split)])
    found: list[list] = [[] for _ in texts]
    if ids:
        all_runs = runs(np.array(ids, np.int64), least, copies)
        owner = np.searchsorted(starts, [r[0] for r in all_runs], side="right") - 1
        for d, (s, n, q) in zip(owner.tolist(), all_runs):
            found[d].append((s - int(starts[d]), n, q))
    return [(len(w), f, b" ".join(_collapsed(w, f) if f else w).decode("utf-8")) for w, f in zip(split, found)]


def _analysed(texts: list[str], least: int, copies: int):
    """``_chunk`` over whole texts, some ``CHUNK_WORDS`` words at a time."""
    part, chars = [], 0
    for t in texts:
        if part and chars + len(t) > 6 * CHUNK_WORDS:
            yield from _chunk(part, least, copies)
            part, chars = [], 0
        part.append(t)
        chars += len(t)
    if part:
        yield from _chunk(part, least, copies)


def collapse(docs: DataFrame, text: str = "text", least: int = LEAST, copies: int = COPIES) -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` (array of start, length, period) and ``collapsed`` text."""
    if copies < 2 or least < 1:
        raise ValueError("a run has two copies and one word at least")
    added = {"n_words": T.LongType(), "runs": T.ArrayType(RUN), "collapsed": T.StringType()}
    fields = docs.schema.fields
    keep = [k for k, f in enumerate(fields) if f.name.lower() not in added]
    place = [f.name.lower() for f in fields].index(text.lower())
    schema = T.StructType([fields[k] for k in keep] + [T.StructField(c, t) for c, t in added.items()])
    kind = pa.list_(pa.struct([(c, pa.int64()) for c in RUN.names]))

    def work(batches):
        for b in batches:
            if not b.num_rows:
                continue
            n, found, rest = zip(*_analysed([x.as_py() or "" for x in b.column(place)], least, copies))
            rows = [[dict(zip(RUN.names, r)) for r in f] for f in found]
            yield pa.RecordBatch.from_arrays(
                [b.column(k) for k in keep] + [pa.array(n, pa.int64()), pa.array(rows, kind), pa.array(rest, pa.string())],
                schema.names)

    return docs.mapInArrow(work, schema)
