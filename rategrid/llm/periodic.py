"""Runs: stretches of words that repeat with a period, found as maximal pairs.

Two equal stretches of L words that begin at i and i + d are a maximal pair if the words
before them differ and the words behind them differ. Then the L + d words from i have
period d and no neighbour extends them, so a maximal pair whose L and d satisfy the
length constraints *is* a run; nothing has to be extended. Pairs come from the tree of
LCP intervals, worked through bottom up:

* Suffixes of a text are sorted by prefix doubling. A run needs L of at least 16 words
  (at 24 words and three periods), so only suffixes that share 16 words are kept; in
  prose nearly none are.
* Each interval of the tree holds its positions in order, each with its left-word class
  (the word before it). Where children meet, positions of different children have exactly
  the interval's L words in common, and those of different classes form maximal pairs.
* The smaller child is looked up in the larger. The positions that begin within L / 2 of
  each other are in steps of the smallest period, so only the neighbours of a position in
  the other child can be a run of it, and a pair at a multiple of the period has a smaller
  pair with the same ends. Time is n log n, whatever repeats.

A text is worked on inside the task that reads it: nothing is shuffled or gathered.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Words of the shortest run, and the periods it has at least.
WORDS, TIMES = 24, 3
#: Bytes of text worked on at a time; a longer text is worked on alone, as a whole.
CHUNK = 1 << 20

Run = tuple[int, int, int]


class Suffixes:
    """Ranks of the suffixes of several texts by their first 1, 2, 4, ... words."""

    def __init__(self, ids: np.ndarray, doc: np.ndarray, ends: np.ndarray, depth: int) -> None:
        """``ids``, ``doc`` per word, ``ends`` per text; suffixes alike in 2 ** depth words are sorted out."""
        self.n = len(ids)
        self.levels: list[np.ndarray] = []
        #: Positions that share 2 ** depth words with another of their text.
        self.shared = np.empty(0, np.int64)
        rank = np.zeros(self.n + 1, np.int64)
        rank[-1] = -1
        active, second = np.arange(self.n), ids.astype(np.int64)
        first, step, width = doc.astype(np.int64), 1, int(second.max(initial=0)) + 1
        while len(active):
            key = first * width + second
            order = np.argsort(key)
            key, active = key[order], active[order]
            new = np.append(True, key[1:] != key[:-1])
            group = np.flatnonzero(new)
            size = np.diff(np.append(group, len(key)))
            if self.levels:
                old = rank[active]
                outer = np.append(True, old[1:] != old[:-1])
                base = np.maximum.accumulate(np.where(outer, np.arange(len(old)), 0))
                value = old + np.repeat(group, size) - base
                step *= 2
            else:
                value = np.repeat(group, size)
            rank = rank.copy()
            rank[active] = value
            self.levels.append(rank if self.n >= 1 << 31 else rank.astype(np.int32))
            active = active[np.repeat(size > 1, size)]
            if len(self.levels) == depth + 1:
                self.shared = active
            after = active + step
            first, width = rank[active], self.n + 1
            second = np.where(after < ends[doc[active]], rank[np.minimum(after, self.n)], -1) + 1
        self.rank = rank

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words the suffixes at ``i`` and ``j``, of one text, have in common."""
        length = np.zeros(len(i), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            rank = self.levels[k]
            length += (rank[i + length] == rank[j + length]).astype(np.int64) << k
        return length


def meeting(node: list[int], child: list[int], depth: int, left: np.ndarray) -> tuple[list[int], list[Run]]:
    """The positions of two children, merged, and the (i, j, depth) of different classes that may be runs."""
    if len(node) < len(child):
        node, child = child, node
    found = []
    for x in child:
        at = bisect_left(node, x)
        if at and 2 * (x - node[at - 1]) <= depth and left[node[at - 1]] != left[x]:
            found.append((node[at - 1], x, depth))
        if at < len(node) and 2 * (node[at] - x) <= depth and left[node[at]] != left[x]:
            found.append((x, node[at], depth))
    if 8 * len(child) > len(node):
        return sorted(node + child), found
    for x in child:
        insort(node, x)
    return node, found


def tree_pairs(positions: list[int], common: list[int], left: np.ndarray, least: int) -> list[Run]:
    """Pairs from the LCP intervals of at least ``least`` words over suffixes in sorted order.

    ``common[k]`` belongs to the suffixes k and k + 1.
    """
    found: list[Run] = []
    stack: list[tuple[int, list[int]]] = []

    def close(done: list[int], down_to: int) -> list[int]:
        while stack and stack[-1][0] > down_to:
            depth, node = stack.pop()
            done, pairs = meeting(node, done, depth, left)
            found.extend(pairs)
        return done

    done = [positions[0]]
    for depth, position in zip(common, positions[1:], strict=True):
        if depth < least:
            close(done, -1)
        else:
            done = close(done, depth)
            if stack and stack[-1][0] == depth:
                merged, pairs = meeting(stack.pop()[1], done, depth, left)
                found.extend(pairs)
                done = merged
            stack.append((depth, done))
        done = [position]
    close(done, -1)
    return found


def runs_of(texts: list[list[bytes]], least: int = WORDS, times: int = TIMES) -> list[list[Run]]:
    """(start, length, period) of the runs of each text, by start, then period."""
    if times < 3:
        raise ValueError("runs of fewer than three periods have other pairs beside the nearest")
    out: list[list[Run]] = [[] for _ in texts]
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    flat = list(chain.from_iterable(texts))
    shortest = -(-least * (times - 1) // times)
    if len(flat) < shortest:
        return out
    named = {w: i for i, w in enumerate(dict.fromkeys(flat))}
    ids = np.fromiter(map(named.__getitem__, flat), np.int64, len(flat))
    doc = np.repeat(np.arange(len(texts)), sizes)
    suffixes = Suffixes(ids, doc, ends, max(shortest, 1).bit_length() - 1)
    at = suffixes.shared
    if not len(at):
        return out
    left = np.append(-1, ids[:-1])
    left[(ends - sizes)[sizes > 0]] = -1
    at = at[np.argsort(suffixes.rank[at])]
    bucket = suffixes.levels[max(shortest, 1).bit_length() - 1][at]
    edge = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(at))
    # A bucket of one class holds no maximal pair.
    kinds = left[at]
    several = np.minimum.reduceat(kinds, edge[:-1]) != np.maximum.reduceat(kinds, edge[:-1])
    common = np.append(suffixes.common(at[:-1], at[1:]), 0)
    common[edge[1:] - 1] = 0
    most = np.maximum.reduceat(common, edge[:-1])
    by_place = at[np.lexsort((at, np.repeat(np.arange(len(edge) - 1), np.diff(edge))))]
    gap = np.append(np.diff(by_place), np.iinfo(np.int64).max)
    gap[edge[1:] - 1] = np.iinfo(np.int64).max
    near = np.minimum.reduceat(gap, edge[:-1]) * 2 <= most
    pairs: list[Run] = []
    for b in np.flatnonzero(several & near & (most >= shortest)):
        some = slice(edge[b], edge[b + 1])
        pairs += tree_pairs(at[some].tolist(), common[some][:-1].tolist(), left, shortest)
    least_period: dict[tuple[int, int], int] = {}
    for i, j, length in pairs:
        period = j - i
        if length >= (times - 1) * period and length + period >= least:
            ends_at = (i, j + length)
            least_period[ends_at] = min(period, least_period.get(ends_at, period))
    for (i, end), period in sorted(least_period.items(), key=lambda x: (x[0][0], x[1])):
        d = int(doc[i])
        out[d].append((i - int(ends[d] - sizes[d]), end - i, period))
    return out


def collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    """The words without those that repeat a run's first period, joined by blanks."""
    if not runs:
        return b" ".join(words)
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period:start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(keep)])


def find_runs(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = WORDS, times: int = TIMES
) -> DataFrame:
    r"""One row (key, n_words, runs, collapsed) per row of ``docs``; no other column is read.

    Words are runs of bytes other than white space (``[^\x20\x09-\x0D]+``), numbered from 0.
    ``runs`` holds (start, length, period) of each stretch of at least ``least`` words and
    ``times`` periods, with its smallest period, that no neighbouring word extends, by start,
    then period; ``collapsed`` is the text's words, joined by blanks, without those that some
    run holds after its first period.

    NULL, empty and blank texts have no words, no runs and an empty collapsed text. Repeated
    rows give repeated rows, keys may be NULL, and an empty table gives an empty one. Texts
    are worked on whole, with some 400 bytes of memory a word.
    """
    run = T.StructType([T.StructField(n, T.LongType(), False) for n in ("start", "length", "period")])
    held = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    schema = T.StructType([
        held.schema["key"], T.StructField("n_words", T.LongType()),
        T.StructField("runs", T.ArrayType(run, False)), T.StructField("collapsed", T.StringType()),
    ])

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).fill_null("")
            size = np.cumsum(texts.cast(pa.binary()).fill_null(b"").to_pandas().str.len().to_numpy(np.int64)) if len(texts) else []
            first = 0
            while first < len(texts):
                before = size[first - 1] if first else 0
                last = max(first + 1, int(np.searchsorted(size, before + CHUNK, "right")))
                words = [t.split() for t in texts.slice(first, last - first).cast(pa.binary()).to_pylist()]
                runs = runs_of(words, least, times)
                flat = np.array(list(chain.from_iterable(runs)), np.int64).reshape(-1, 3)
                offsets = np.cumsum([0, *map(len, runs)])
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, last - first),
                    pa.array([len(w) for w in words], pa.int64()),
                    pa.ListArray.from_arrays(
                        pa.array(offsets, pa.int32()),
                        pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], names=run.names),
                    ),
                    pa.array([collapsed(w, r) for w, r in zip(words, runs, strict=True)], pa.binary()).cast(pa.string()),
                ], names=schema.names)
                first = last

    return held.mapInArrow(found, schema).withColumnRenamed("key", key)
