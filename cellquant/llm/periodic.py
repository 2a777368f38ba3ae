"""Periodic runs of words: a suffix automaton whose suffix links are a link-cut tree coloured by last occurrence."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: bytes of text that are unpacked at a time
SLICE = 4 << 20
Change = Callable[[int | None, list[bytes]], list[bytes]]
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def repeated_stretches(words: list[bytes], least: int) -> list[tuple[int, int]]:
    """Stretches outside which no run can lie: a run of two periods and ``least`` words or more is covered by windows of half
    of ``least`` that stand twice in it. Windows are compared by hash, so a stretch may be needless, but none is lost."""
    gram = (least + 1) // 2
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    todo = [(0, len(words))]
    for _ in range(3):  # inside a stretch fewer windows stand twice; a further round only saves work
        found = []
        for a, z in todo:
            if z - a < least:
                continue
            g = np.zeros(z - a - gram + 1, np.uint64)
            for k in range(gram):
                g = g * np.uint64(0x9E3779B97F4A7C15) + h[a + k : z - gram + 1 + k]
            order = np.argsort(g, kind="stable")
            same = np.flatnonzero(g[order[1:]] == g[order[:-1]])
            if len(same):
                twice = np.zeros(z - a + 1, np.int32)
                twice[np.union1d(order[same], order[same + 1])] = 1
                covered = np.cumsum(twice - np.concatenate((np.zeros(gram, np.int32), twice[:-gram]))) > 0
                edges = np.flatnonzero(np.diff(np.concatenate(([False], covered[:-1], [False])))) + a
                found += zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)
        if found == todo:
            break
        todo = found
    return [(a, z) for a, z in todo if z - a >= least]


def squares(words: list[int]) -> dict[tuple[int, int], int]:
    """{(start, smallest period): stop} of all maximal stretches of at least two periods.

    Each appended word makes a state whose path of suffix links holds all suffixes; the path falls into segments of one
    last occurrence each. A segment of longest string m, last seen d words ago, ends a stretch of period d and m + d words
    if d <= m; the path then takes the new place as its last occurrence. The last such stretch of a start and a period is
    the whole run. ``colour`` holds at the root of a segment's splay tree only.
    """
    length, link, goes = [0], [-1], [{}]
    par, left, right, colour = [-1], [-1], [-1], [-1]
    runs: dict[tuple[int, int], int] = {}

    def rotate(x: int, y: int) -> None:
        z = par[y]
        if left[y] == x:
            b = left[y] = right[x]
            right[x] = y
        else:
            b = right[y] = left[x]
            left[x] = y
        if b >= 0:
            par[b] = y
        par[y], par[x] = x, z
        if z >= 0:
            if left[z] == y:
                left[z] = x
            elif right[z] == y:
                right[z] = x
        colour[x] = colour[y]

    def splay(x: int) -> None:
        while (y := par[x]) >= 0 and (left[y] == x or right[y] == x):
            z = par[y]
            if z >= 0 and (left[z] == y or right[z] == y):
                if (left[z] == y) == (left[y] == x):
                    rotate(y, z)
                else:
                    rotate(x, y)
                    y = z
            rotate(x, y)

    def state(size: int, to: dict[int, int], up: int) -> int:
        for a, v in ((length, size), (goes, to), (link, up), (par, up), (left, -1), (right, -1), (colour, -1)):
            a.append(v)
        return len(length) - 1

    last = 0
    for i, c in enumerate(words):
        cur = state(i + 1, {}, -1)
        p, last = last, cur
        while p >= 0 and c not in goes[p]:
            goes[p][c] = cur
            p = link[p]
        up = 0
        if p >= 0:
            up = q = goes[p][c]
            if length[q] != length[p] + 1:  # the shorter suffixes of q part from it, with q's last occurrence
                up = state(length[p] + 1, goes[q].copy(), link[q])
                splay(q)
                above = left[up] = left[q]
                if above >= 0:
                    par[above] = up
                left[q], par[up], link[q] = up, q, up
                while p >= 0 and goes[p].get(c) == q:
                    goes[p][c] = up
                    p = link[p]
        link[cur] = par[cur] = up
        below, x = cur, up
        while x >= 0:
            splay(x)
            seen, m = colour[x], length[x]
            if m and i - seen <= m:
                runs[seen + 1 - m, i - seen] = i + 1
            if (deeper := right[x]) >= 0:
                colour[deeper] = seen
            right[x] = below
            below, x = x, par[x]
        colour[below] = i
    return runs


def runs_of(words: list[bytes], least: int = 12) -> list[tuple[int, int, int]]:
    """(start, length, period) of every maximal run of ``least`` words and two periods or more, by start, then period."""
    out = []
    for a, z in repeated_stretches(words, least):
        known: dict[bytes, int] = {}
        found = squares([known.setdefault(w, len(known)) for w in words[a:z]])
        out += [(a + s, stop - s, q) for (s, q), stop in found.items() if stop - s >= least]
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run contains after its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    for s, n, q in runs:
        edge[s + q] += 1
        edge[s + n] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(edge)[:-1] == 0).tolist()])


def periodic_runs(documents: DataFrame, *, least: int = 12, change: Change | None = None) -> DataFrame:
    """doc_id, n_words, runs (array of start, length, period, by start, then period) and collapsed of every row.

    Words stand between blanks (space, tab to carriage return) of the whole text and are numbered from 0. A run is a stretch
    of at least ``least`` (2 or more) words and two of its smallest periods that no neighbouring word extends; ``collapsed``
    keeps of each run its first period. ``change`` may replace the words of a document first. Null, empty and blank texts
    have no words and no runs. Rows are judged each by itself, so repeated rows and doc_ids stay, and null doc_ids stay
    null; an empty table gives an empty result. Other columns are ignored. Memory grows with the longest repetitive
    stretch of one document, at most about half a kilobyte a word.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).cast(pa.large_string())
            upto = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
            lo = 0
            while lo < b.num_rows:
                hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + SLICE, side="right")))
                ids, n_words, runs, kept = b.column(0).slice(lo, hi - lo), [], [], []
                for i, text in zip(ids.to_pylist(), texts.slice(lo, hi - lo).cast(pa.large_binary()).to_pylist(), strict=True):
                    words = (text or b"").split()
                    if change is not None:
                        words = change(i, words)
                    found = runs_of(words, least)
                    n_words.append(len(words))
                    runs.append([{"start": s, "length": n, "period": q} for s, n, q in found])
                    kept.append(collapsed(words, found))
                yield pa.RecordBatch.from_arrays([ids, pa.array(n_words, pa.int64()), pa.array(runs, _RUNS), pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "runs", "collapsed"])
                lo = hi

    rows = documents.select("doc_id", "text")
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def runs_digest(found: DataFrame) -> DataFrame:
    """The number of runs, the longest one (ties: smallest start, then period) and hashes of all runs and of what is kept."""
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r.length).alias("less"), r.start.alias("start"), r.period.alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(r.start, F.lit(","), r.length, F.lit(","), r.period, F.lit("\n")))
    return (
        found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.array_join(lines, "").alias("lines"), "collapsed")
        .select(
            "doc_id",
            "n_runs",
            F.col("best.start").alias("start"),
            (-F.col("best.less")).alias("length"),
            F.col("best.period").alias("period"),
            F.expr("-1000 * best.less DIV best.period").alias("exponent_milli"),
            F.sha2(F.col("lines").cast("binary"), 256).alias("runs_sha256"),
            F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
        )
    )
