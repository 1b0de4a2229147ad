"""Maximal periodic runs of words by a suffix automaton with link-cut access.

Words are appended one by one to a suffix automaton.  Its suffix links form a
tree whose path from the newest prefix to the root holds all suffixes; every
state on it now ends last at the newest word.  A link-cut tree keeps the paths
by colour, the end position seen last: appending a word accesses its prefix's
state, and walks the segments of one colour that the access recolours.  A
segment with previous end ``e`` whose longest state has ``L`` words says that
the suffix of ``L`` words at the new end ``i`` stood at ``e`` before; where the
distance ``q = i - e`` is at most ``L`` the two touch, a square of period ``q``.
As ``e`` is the last earlier end, ``q`` is the smallest period, and the first
square of every run is met at its end.  A square is extended both ways to its
run; later squares of the same run are inside it and skipped.

An access costs O(log n) segments amortised.  Only stretches where runs are
possible get there: a run of at least ``least`` words repeats every group of
``ceil(least / 2)`` words inside it at a distance of at most half its length, so
numpy first keeps the stretches that such repeated groups cover; what is cut
away can hold no run and touch none.

Scale: documents never move; one pass over the texts in Arrow batches, no
exchange.  Memory is a batch of texts and the automaton of one stretch.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import HASHES, slices

LEAST = 12  # words of the shortest run that counts


def _cover(starts: np.ndarray, size: int, n: int) -> np.ndarray:
    """Which of ``n`` places are within ``size`` places of a start."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + size, n), -1)
    return np.cumsum(edge[:-1]) > 0


def stretches(hashes: np.ndarray, doc: np.ndarray, least: int = LEAST) -> list[tuple[int, int]]:
    """(first, after last) place of every stretch that may hold runs; none crosses documents.

    ``hashes`` are the words of several documents one after the other, ``doc`` says whose."""
    size, n = -(-least // 2), len(hashes)
    if n < least:
        return []
    with np.errstate(over="ignore"):
        group = np.zeros(n - size + 1, np.uint64)
        for j in range(size):
            group = (group + hashes[j:n - size + 1 + j]) * np.uint64(0x9E3779B97F4A7C15)
            group ^= group >> np.uint64(29)
        group ^= (doc[:n - size + 1].astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    inside = np.flatnonzero(doc[:n - size + 1] == doc[size - 1:])
    order = inside[np.argsort(group[inside], kind="stable")]
    same = group[order[1:]] == group[order[:-1]]
    a, b = order[:-1][same], order[1:][same]  # neighbouring places of equal groups
    while len(a):
        covered = _cover(np.concatenate([a, b]), size, n)
        first = covered & np.concatenate([[True], ~covered[:-1] | (doc[1:] != doc[:-1])])
        starts = np.flatnonzero(first)
        after = np.flatnonzero(covered & np.concatenate([~covered[1:] | first[1:], [True]])) + 1
        of = np.cumsum(first) - 1
        length = after - starts
        keep = (of[a] == of[b]) & (2 * (b - a) <= length[of[a]]) & (length[of[a]] >= least)
        if keep.all():
            return list(zip(starts.tolist(), after.tolist()))
        a, b = a[keep], b[keep]
    return []


def runs_of(s: list, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of the sequence, by start, then period.

    A run is a stretch with smallest period ``q`` and at least ``max(least, 2q)``
    items that neither neighbour extends."""
    n = len(s)
    # states from 1 (the empty prefix); 0 stands for none
    nexts: list[dict] = [{}, {}]
    link, length = [0, 0], [0, 0]
    up, left, right, ended = [0, 0], [0, 0], [0, 0], [0, -1]  # link-cut tree; a path's colour stands at its splay root

    def splay(x: int) -> None:
        while True:
            p = up[x]
            if not p or (left[p] != x and right[p] != x):
                return
            g = up[p]
            top = not g or (left[g] != p and right[g] != p)
            if top:
                ended[x] = ended[p]
                turns = (x,)
            else:
                above = up[g]
                if not above or (left[above] != g and right[above] != g):
                    ended[x] = ended[g]
                turns = (p, x) if (left[g] == p) == (left[p] == x) else (x, x)
            for y in turns:
                p = up[y]
                g = up[p]
                if left[p] == y:
                    c = left[p] = right[y]
                    right[y] = p
                else:
                    c = right[p] = left[y]
                    left[y] = p
                if c:
                    up[c] = p
                up[p], up[y] = y, g
                if g:
                    if left[g] == p:
                        left[g] = y
                    elif right[g] == p:
                        right[g] = y

    found: list[tuple[int, int, int]] = []
    until: dict[int, int] = {}  # per period: where its last run ends
    last = 1
    for i, word in enumerate(s):
        # the automaton's new state for the prefix that ends here
        cur = len(length)
        nexts.append({})
        length.append(length[last] + 1)
        p = last
        while p and word not in nexts[p]:
            nexts[p][word] = cur
            p = link[p]
        above = 1
        if p:
            above = q = nexts[p][word]
            if length[p] + 1 != length[q]:
                above = len(length)  # after cur: the copy that takes q's shorter suffixes
                nexts.append(nexts[q].copy())
                length.append(length[p] + 1)
        link.append(above)
        up.append(above)
        left.append(0)
        right.append(0)
        ended.append(-1)
        if above > cur:  # the copy stands right above q on q's path, and ended where q did
            link.append(link[q])
            link[q] = above
            splay(q)
            up.append(q)
            left.append(left[q])
            right.append(0)
            ended.append(-1)
            if left[q]:
                up[left[q]] = above
            left[q] = above
            while p and nexts[p].get(word) == q:
                nexts[p][word] = above
                p = link[p]
        last = cur

        # access: every segment of the path shows where it ended before
        below, x = 0, cur
        while x:
            splay(x)
            q = i - ended[x]
            if x != cur and 0 < q <= length[x] and i >= until.get(q, 0):
                a, z = i - q - length[x] + 1, i + 1
                while a and s[a - 1] == s[a - 1 + q]:
                    a -= 1
                while z < n and s[z] == s[z - q]:
                    z += 1
                until[q] = z
                if z - a >= least:
                    found.append((a, z - a, q))
            if right[x]:
                ended[right[x]] = ended[x]
            right[x] = below
            below, x = x, up[x]
        ended[below] = i
    return sorted(found, key=lambda r: (r[0], r[2]))


def batch_runs(texts: list[list[bytes]], least: int = LEAST) -> list[list[tuple[int, int, int]]]:
    """The runs of every document of a batch, given as word lists."""
    flat = [w for words in texts for w in words]
    ends = np.cumsum([len(words) for words in texts])
    doc = np.repeat(np.arange(len(texts)), [len(words) for words in texts])
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for lo, hi in stretches(np.fromiter(map(HASHES.__getitem__, flat), np.uint64, len(flat)), doc, least):
        number: dict[bytes, int] = {}
        at = int(doc[lo])
        shift = lo - (int(ends[at - 1]) if at else 0)
        ids = [number.setdefault(w, len(number)) for w in flat[lo:hi]]
        out[at].extend((start + shift, size, q) for start, size, q in runs_of(ids, least))
    return out


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    for start, size, q in runs:
        edge[start + q] += 1
        edge[start + size] -= 1
    keep = np.cumsum(edge[:-1]) == 0
    return [w for w, k in zip(words, keep.tolist()) if k]


def plant_period(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Words with a periodic tail in a tenth of the documents, by the CRC of the decimal id; a null id has none."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST,
              rewrite: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """One row per input row: the id, ``runs`` and ``collapsed``.

    Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0.  ``runs`` is an array of
    (start, length, period) of all runs of at least ``max(least, 2 * period)``
    words, by start, then period; ``collapsed`` the words that no run holds
    after its first period, joined by one blank.  ``rewrite`` may change a
    document's words first (its id and words to words).  A null, empty or blank
    text has no words, no runs and an empty ``collapsed``; repeated rows and
    null ids are rows like any other; other columns are not read.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches):
        for b in batches:
            for part in slices(b, "t"):
                texts = [(t or "").encode().split() for t in part.column("t").to_pylist()]
                if rewrite is not None:
                    texts = [rewrite(i, words) for i, words in zip(part.column("id").to_pylist(), texts)]
                runs = batch_runs(texts, least)
                rows = [[{"start": s, "length": n, "period": q} for s, n, q in r] for r in runs]
                kept = [b" ".join(collapse(words, r)).decode() for words, r in zip(texts, runs)]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(rows, run_type), pa.array(kept, pa.string())],
                                                 names=["id", "runs", "collapsed"])

    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
            .mapInArrow(run, f"id {id_type}, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")
            .withColumnRenamed("id", id_col))
