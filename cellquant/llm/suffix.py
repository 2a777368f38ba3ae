"""Removal of long repeated byte strings with run-length Burrows-Wheeler indexes.

The corpus is cut so that equal 100-byte strings always meet. Every window of ``length`` bytes names one of its own
``K``-grams (the one of least hash: its anchor), so equal windows name equal anchors. Anchors that occur once cannot lie
in a repeat and are dropped before any text moves. For the others, consecutive windows of one anchor form a range, and
ranges with the same anchor are indexed together: a run-compressed Burrows-Wheeler transform with text positions sampled
at run ends, and the earliest place of each block of rows that share ``length`` bytes. Each range is then streamed
backwards through the index; its matching statistics say which windows also start earlier.

Identical ranges are merged in each task before anything is shuffled. Anchors with more than ``HOT`` occurrences (a passage
that a third of all documents holds) are not gathered: their windows go by their own 128-bit hash, again merged in each
task, so that no key receives more rows than there are tasks times flushes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellquant.llm.common import shuffle_partitions

K, HOT, LEAST = 32, 8000, -(1 << 63)
#: bytes of text for which the shuffles get another partition, if the session gives fewer
PART_BYTES = 64_000_000
Batches = Iterator[pa.RecordBatch]
_TABLE = np.random.default_rng(20).integers(0, 1 << 64, 256, np.uint64)
_B = np.uint64(0x9E3779B97F4A7C15)
_LOW = np.uint64((1 << 24) - 1)
_PIECE = 1 << 18  # bytes whose hashes stay in a core's cache


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the 32 bytes from each place, by doubling."""
    h, width, base = _TABLE[data], 1, _B
    while width < K:
        h = h[:-width] * base + h[width:]
        width, base = width * 2, np.uint64(int(base) * int(base) & _M)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    m, w = x, 1
    while w * 2 <= width:
        m, w = np.minimum(m[:-w], m[w:]), w * 2
    rest = width - w
    return np.minimum(m[: len(m) - rest], m[rest:]) if rest else m


def anchors(data: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """For texts laid end to end (``ends``: where each ends): per range of windows with one anchor, the anchor's hash, the
    text's number, the first window's place in ``data``, the number of windows and the anchor's distance from the first
    window's start. ``data`` is under 2 ** 24 bytes."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return np.zeros(0, np.uint64), none, none, none, none
    h = _gram_hashes(data)
    at = _sliding_min((h & ~_LOW) | np.arange(len(h), dtype=np.uint64), length - K + 1) & _LOW  # of each window: its anchor
    begin = np.concatenate(([0], ends[:-1]))
    own = np.flatnonzero(ends - begin >= length)  # texts that hold a window
    if not len(own):
        return np.zeros(0, np.uint64), none, none, none, none
    stop = ends[own] - length + 1  # behind each text's last window
    new = np.zeros(len(at) + 1, bool)  # where a range begins, or windows over two texts do
    new[1:-1] = at[1:] != at[:-1]
    new[begin[own]] = new[stop] = True
    edges = np.flatnonzero(new)
    of = np.searchsorted(begin[own], edges, side="right") - 1
    inside = (of >= 0) & (edges < stop[of])
    first, windows = edges[inside], np.diff(np.append(edges, len(at)))[inside]
    a = at[first].astype(np.int64)
    return h[a], own[of[inside]], first, windows, a - first


def _pieces(batches: Batches, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(data, ends, ids, ths, offsets) of texts laid end to end, ``_PIECE`` bytes at a time; a longer text comes in overlapping parts."""
    held, ids, ths, offs, size = [], [], [], [], 0

    def laid() -> tuple[np.ndarray, ...]:
        return np.concatenate(held), np.cumsum([len(x) for x in held]), np.array(ids), np.array(ths), np.array(offs)

    for b in batches:
        for i, th, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
            raw = np.frombuffer((t.as_py() or "").encode(), np.uint8)
            for lo in range(0, max(1, len(raw) - length + 1), _PIECE):
                held.append(raw[lo : lo + _PIECE + length - 1])
                ids.append(i)
                ths.append(th)
                offs.append(lo)
                size += len(held[-1])
                if size >= _PIECE:
                    yield laid()
                    held, ids, ths, offs, size = [], [], [], [], 0
    if held:
        yield laid()


def _pack(start, windows, off):
    """A range in one number: its first window's start, how many windows, and where the anchor lies from the start."""
    return start << 20 | windows << 10 | off


def _unpack(place: int) -> tuple[int, int, int]:
    return place >> 20, place >> 10 & 1023, place & 1023


def _repeated_anchors(texts: DataFrame, length: int, segments: int, flush: int = 1_000_000) -> DataFrame:
    """(id, th, h, place, hot) of ranges whose anchor occurs more than once. place: see ``_pack``.

    In each task an anchor seen before is known to repeat: it only adds to a count, so a hot anchor sends one row a flush.
    """
    kind = "segment int, h binary, id binary, th binary, place binary, n binary"
    names = ["segment", "h", "id", "th", "place", "n"]
    shift = np.uint64(40)

    def send(batches: Batches) -> Batches:
        held: list[tuple[np.ndarray, ...]] = []
        size = 0

        def out() -> pa.RecordBatch:
            h, ids, th, place = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            order = np.argsort(h)
            first = np.flatnonzero(np.concatenate(([True], h[order][1:] != h[order][:-1])))
            count = np.diff(np.append(first, len(h)))
            n = np.zeros(len(h), np.uint32)  # 0: another row of this flush stands for the anchor's count
            n[order[first]] = count
            seg = ((h >> shift) % np.uint64(segments)).astype(np.int32)
            by = np.argsort(seg, kind="stable")
            cuts = np.searchsorted(seg[by], np.arange(segments + 1))
            full = [s for s in range(segments) if cuts[s] < cuts[s + 1]]
            blobs = [[x[by[cuts[s] : cuts[s + 1]]] for s in full] for x in (h, ids, th, place, n)]
            blobs[1] = [np.diff(x, prepend=0) for x in blobs[1]]  # small numbers compress
            return pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), *(pa.array([x.tobytes() for x in b], pa.binary()) for b in blobs)], names)

        for data, ends, ids, ths, offs in _pieces(batches, length):
            h, doc, start, windows, off = anchors(data, ends, length)
            begin = np.concatenate(([0], ends[:-1]))
            if not len(h):  # nothing here is as long as a window
                continue
            held.append((h, ids[doc].astype(np.int64), ths[doc].astype(np.int64), _pack(start - begin[doc] + offs[doc], windows, off)))
            size += len(h)
            if size >= flush:
                yield out()
                size = 0
        if held:
            yield out()

    def gather(batches: Batches) -> Batches:
        held: list[list[bytes]] = []
        now = -1

        def out() -> pa.RecordBatch:
            h, th, place, n = (np.concatenate([np.frombuffer(r[i], t) for r in held]) for i, t in ((1, np.uint64), (3, np.int64), (4, np.int64), (5, np.uint32)))
            ids = np.concatenate([np.cumsum(np.frombuffer(r[2], np.int64)) for r in held])
            held.clear()
            order = np.argsort(h)
            hs = h[order]
            first = np.flatnonzero(np.concatenate(([True], hs[1:] != hs[:-1])))
            total = np.add.reduceat(n[order].astype(np.int64), first)
            times = np.empty(len(h), np.int64)
            times[order] = np.repeat(total, np.diff(np.append(first, len(h))))
            keep = times > 1
            return pa.RecordBatch.from_arrays([pa.array(ids[keep]), pa.array(th[keep]), pa.array(h[keep].view(np.int64)), pa.array(place[keep]), pa.array(times[keep] > HOT)], ["id", "th", "h", "place", "hot"])

        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if row[0] != now and held:
                    yield out()
                now = row[0]
                held.append(row)
        if held:
            yield out()

    sent = texts.mapInArrow(send, kind).repartition(max(1, segments // 4), "segment").sortWithinPartitions("segment")
    return sent.mapInArrow(gather, "id long, th long, h long, place long, hot boolean")


class RunLengthIndex:
    """Run-compressed BWT over strings, for matches up to ``length`` bytes.

    Kept: symbol and start of each run, rank of each run among those of its symbol, the text position at both ends of each
    run, and the starts of the blocks of rows that share ``length`` bytes. ``order`` gives the text position of each row
    while the index is built; only its run-end samples stay.
    """

    def __init__(self, strings: list[bytes], length: int):
        self.length = length
        sizes = np.array([len(s) for s in strings])
        self.begin = np.concatenate(([0], np.cumsum(sizes[:-1] + 1))).astype(np.int64)
        n = int(sizes.sum() + len(strings))
        raw = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8)
        text = raw.astype(np.uint16) + 1  # 0 separates; bytes are 1 to 256
        text[self.begin + sizes] = 0
        self.text = text
        # Prefix doubling within each string: nothing after its separator counts, and strings that end alike keep their
        # order, which is a consistent order of all suffixes.
        left = np.repeat(self.begin + sizes, sizes + 1) - np.arange(n)  # symbols before the separator
        key, width = text.astype(np.int64), 7
        for i in range(1, width):
            key <<= 9
            key[: n - i] |= np.where(left[: n - i] >= i, text[i:], 0)
        while True:
            last = width > sizes.max()
            order = np.argsort(key, kind="stable" if last else None)
            ks = key[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(np.concatenate(([0], ks[1:] != ks[:-1])))
            if width <= length:
                part, held = width, rank
            if last:
                break
            key = rank * (n + 1)
            key[: n - width] += np.where(left[: n - width] >= width, rank[width:] + 1, 0)
            width *= 2
        ext = np.zeros(n, np.int64)
        if n > length - part:
            ext[: n - (length - part)] = np.where(left[: n - (length - part)] >= length - part, held[length - part :], 0)
        head = held[order]
        tail = ext[order]
        self.block = np.flatnonzero(np.concatenate(([True], (head[1:] != head[:-1]) | (tail[1:] != tail[:-1]))))
        self.order = order
        bwt = text[order - 1]
        starts = np.flatnonzero(np.concatenate(([True], bwt[1:] != bwt[:-1])))
        self.starts, self.symbol = starts, bwt[starts]
        lengths = np.diff(np.append(starts, n))
        by = np.argsort(self.symbol, kind="stable")
        before = np.cumsum(lengths[by]) - lengths[by]
        self.lf = np.empty(len(starts), np.int64)  # where a run's first row leads
        self.lf[by] = before
        self.by_symbol, self.symbol_cuts = by, np.searchsorted(self.symbol[by], np.arange(258))
        self.keys = self.symbol[by].astype(np.int64) * len(starts) + by
        self.last = starts + lengths - 1
        self.head_at, self.tail_at = order[starts] - 1, order[starts + lengths - 1] - 1  # text place of the run's symbol
        self.rows = n

    def blocks_of(self, row: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.block, row, side="right") - 1

    def matching_statistics(self, patterns: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each place of each pattern (matrix, right-aligned): the row reached, and the length of the longest match
        from there, up to the index's length; then the columns' offset of each pattern. All patterns step together.

        On a symbol that does not stand before the row, the match moves to the nearest run of that symbol above or below,
        whichever shares more with what is matched so far, by comparing with the text at the run's sampled end.
        """
        sizes = np.array([len(p) for p in patterns])
        wide = int(sizes.max(initial=0))
        grid = np.zeros((len(patterns), wide), np.uint16)
        for i, p in enumerate(patterns):
            grid[i, wide - len(p) :] = np.frombuffer(p, np.uint8).astype(np.uint16) + 1
        rows, lens = np.zeros((len(patterns), wide), np.int64), np.zeros((len(patterns), wide), np.int32)
        row, matched = np.zeros(len(patterns), np.int64), np.zeros(len(patterns), np.int64)
        for col in range(wide - 1, -1, -1):
            on = np.flatnonzero(sizes >= wide - col)
            c = grid[on, col]
            r, m = row[on], matched[on]
            run = np.searchsorted(self.starts, r, side="right") - 1
            fits = self.symbol[run] == c
            if not fits.all():
                odd = np.flatnonzero(~fits)
                r[odd], m[odd], run[odd] = self._jump(run[odd], c[odd], m[odd], grid[on[odd]], col)
            known = m >= 0
            r = np.where(known, self.lf[run] + r - self.starts[run], 0)
            m = np.where(known, np.minimum(m + 1, self.length), 0)
            row[on], matched[on] = r, m
            rows[on, col], lens[on, col] = r, m
        return rows, lens, wide - sizes

    def _jump(self, run: np.ndarray, c: np.ndarray, matched: np.ndarray, grid: np.ndarray, col: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, length, run) after moving to the nearest run of ``c``; length -1 if there is none."""
        k = np.searchsorted(self.keys, c.astype(np.int64) * len(self.starts) + run)
        best, to_row, to_run = np.full(len(run), -1, np.int64), np.zeros(len(run), np.int64), np.zeros(len(run), np.int64)
        for j, at_end, row in ((k - 1, self.tail_at, self.last), (k, self.head_at, self.starts)):
            ok = np.flatnonzero((j >= self.symbol_cuts[c]) & (j < self.symbol_cuts[c + 1]))
            own = self.by_symbol[j[ok]]
            got = self._common(at_end[own] + 1, grid[ok, col + 1 :], matched[ok])
            better = got > best[ok]
            to, own = ok[better], own[better]
            best[to], to_run[to], to_row[to] = got[better], own, row[own]
        return to_row, best, to_run

    def _common(self, at: np.ndarray, want: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many symbols ``want`` and the text from ``at`` share at the start, ``most`` at most."""
        width = int(most.max(initial=0))
        if not width:
            return np.zeros(len(at), np.int64)
        off = np.arange(width)
        same = (self.text[np.minimum(at[:, None] + off, self.rows - 1)] == want[:, :width]) & (off < most[:, None])
        return np.where(same.all(1), width, same.argmin(1))


def earlier_windows(strings: list[bytes], ids: np.ndarray, starts: np.ndarray, length: int) -> list[np.ndarray]:
    """For ranges (bytes, document, first window's place): which of each range's windows also start earlier, in a
    document of smaller id or earlier in the same one, among the ranges given."""
    index = RunLengthIndex(strings, length)
    rank = np.unique(ids, return_inverse=True)[1].astype(np.int64)
    of = np.searchsorted(index.begin, np.arange(index.rows), side="right") - 1
    place = (rank[of] << 40) + starts[of] + np.arange(index.rows) - index.begin[of]
    earliest = np.minimum.reduceat(place[index.order], index.block)
    del index.order  # what is left are the runs, their samples and the blocks
    rows, lens, off = index.matching_statistics(strings)
    windows = np.array([len(s) - length + 1 for s in strings])
    own = np.repeat(np.arange(len(strings)), windows)
    j = np.arange(len(own)) - np.repeat(np.cumsum(windows) - windows, windows)
    r, m = rows[own, off[own] + j], lens[own, off[own] + j]
    covered = (m >= length) & (earliest[index.blocks_of(r)] < (rank[own] << 40) + starts[own] + j)
    return np.split(covered, np.cumsum(windows)[:-1])


_RANGE = "kind int, key long, r long, id long, th long, start int, n int, off int, body binary"
_MARK = "id long, th long, start int, stop int"


def _marked(h: int, off: int, body: bytes) -> bytes:
    """A range's bytes with the anchor's hash in place of the anchor, which every window of the range holds. Byte 255 is
    in no UTF-8 text, so equal windows have their anchors at the same place. Windows are ``_MARKED`` shorter."""
    return b"%b\xff%b%b" % (body[:off], h.to_bytes(8, "little", signed=True), body[off:])


_MARKED = K - 9


def _ranges(joined: DataFrame, length: int, flush: int = 20_000_000) -> DataFrame:
    """Rows of ``_RANGE`` from (id, th, text, list of (h, place, hot)). kind 0: a mark (start, n bytes); 1: a range's first
    copy of this flush, with its bytes but the anchor's; 2: a window of a hot anchor. th tells rows apart that share an id."""

    def run(batches: Batches) -> Batches:
        first: dict[tuple, tuple] = {}
        done: list[tuple] = []
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            windows: dict[tuple, tuple] = {}
            for (h, hot, r, *_), (i, th, s, n, off, body) in first.items():
                if not hot:
                    done.append((1, h, _signed(r & _M), i, th, s, n, off, body[:off] + body[off + K :]))
                    continue
                for j in range(n):
                    w = xxhash.xxh3_128_intdigest(body[j : j + length])
                    put(windows, (_signed(w & _M), _signed(w >> 64)), (i, th, s + j, 1, 0, b""))
            done.extend((2, k[0], k[1], *v) for k, v in windows.items())
            first.clear()
            for lo in range(0, len(done), 50_000):
                cols = list(zip(*done[lo : lo + 50_000], strict=True))
                kinds = [pa.int32(), *[pa.int64()] * 4, *[pa.int32()] * 3, pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["kind", "key", "r", "id", "th", "start", "n", "off", "body"])
            done.clear()

        def put(seen: dict, key: tuple, new: tuple) -> None:
            old = seen.get(key)
            if old is None:
                seen[key] = new
            elif (old[0], old[2]) == (new[0], new[2]):  # two rows with one id: neither is earlier, and both stay
                if old[1] != new[1]:
                    put(seen, (*key, new[1]), new)
            else:
                old, new = sorted((old, new), key=lambda x: (x[0], x[2]))
                seen[key] = old
                done.append((0, new[0], 0, new[0], new[1], new[2], new[3] + length - 1, 0, b""))

        for b in batches:
            for i, th, text, found in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3).to_pylist(), strict=True):
                raw = (text.as_py() or "").encode()
                for f in found:
                    s, n, off = _unpack(f["place"])
                    body = raw[s : s + n + length - 1]
                    if th and (len(body) < n + length - 1 or _signed(int(_gram_hashes(np.frombuffer(body, np.uint8, K, off))[0])) != f["h"]):
                        continue  # a place of another row with this id and hash
                    put(first, (f["h"], f["hot"], xxhash.xxh3_128_intdigest(body)), (i, th, s, n, off, body))
                    size += len(body)
                if size > flush:
                    yield from out()
                    size = 0
        yield from out()

    return joined.mapInArrow(run, _RANGE)


_M = (1 << 64) - 1


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _marks(ranges: DataFrame, length: int, partitions: int, batch: int = 1_000_000) -> DataFrame:
    """Byte intervals to remove, from ranges that arrive together by anchor (kind 1) or window (kind 2)."""

    def run(batches: Batches) -> Batches:
        group: list[tuple] = []
        size, out, last = 0, [], None

        def indexed() -> None:
            rest: list[tuple] = []
            for r in group:  # sorted: of equal ranges the earliest comes first
                p = rest[-1] if rest else None
                if p and p[1:3] == r[1:3] and p[8] == r[8] and (p[3], p[5]) != (r[3], r[5]):
                    out.append((r[3], r[4], r[5], r[5] + r[6] + length - 1))
                else:
                    rest.append(r)
            keys = [r[1] for r in rest]
            several = {k for k, k2 in zip(keys, keys[1:], strict=False) if k == k2}
            rest = [r for r in rest if r[1] in several]
            if rest:
                covered = earlier_windows([_marked(r[1], r[7], r[8]) for r in rest], np.array([r[3] for r in rest]), np.array([r[5] for r in rest], np.int64), length - _MARKED)
                for r, c in zip(rest, covered, strict=True):
                    edge = np.flatnonzero(np.diff(np.concatenate(([False], c, [False])).astype(np.int8)))
                    out.extend((r[3], r[4], r[5] + a, r[5] + z + length - 1) for a, z in edge.reshape(-1, 2).tolist())
            group.clear()

        def sent() -> pa.RecordBatch:
            cols = list(zip(*out, strict=True)) if out else [[]] * 4
            got = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, [pa.int64(), pa.int64(), pa.int32(), pa.int32()], strict=True)], ["id", "th", "start", "stop"])
            out.clear()
            return got

        for b in batches:
            for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if r[0] == 0:
                    out.append((r[3], r[4], r[5], r[5] + r[6]))
                elif r[0] == 1:
                    if size > batch and r[1] != group[-1][1]:
                        indexed()
                        size = 0
                    group.append(r)
                    size += len(r[8])
                else:
                    if last and last[1:3] == r[1:3]:
                        if (last[3], last[5]) != (r[3], r[5]):
                            out.append((r[3], r[4], r[5], r[5] + length))
                    else:
                        last = r
            if len(out) > 100_000:
                yield sent()
        if group:
            indexed()
        yield sent()

    sent = ranges.repartition(partitions, "kind", "key").sortWithinPartitions("kind", "key", "r", "id", "start")
    return sent.mapInArrow(run, _MARK)


def remove_repeats(documents: DataFrame, *, length: int = 100) -> DataFrame:
    """id, kept (binary), n_bytes, n_removed and spans (array of start, stop: maximal removed runs) of every row.

    Each byte covered by a ``length``-byte string that also starts earlier (smaller doc_id, or same document and earlier
    start) is removed, judged on the input. Texts count as UTF-8; null, empty and shorter ones have nothing removed, and an
    empty table gives an empty result. A doc_id must be a long or cast to one; a null one stays null and counts as the
    least long. Rows that share a doc_id are compared with each other by start alone, so that equal copies under one
    doc_id both stay. Other columns are ignored. ``length`` is over 32 and under 1000.
    """
    rows = documents.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST)).alias("id"), "text")
    shared = not rows.groupBy("id").count().where("count > 1").isEmpty()  # such rows are told apart by their texts
    rows = rows.withColumn("th", F.xxhash64(F.coalesce("text", F.lit(""))) if shared else F.lit(0).cast("long"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(shuffle_partitions(documents.sparkSession), -(-size // PART_BYTES))
    repeated = _repeated_anchors(rows.select("id", "th", "text"), length, segments=4 * parts)
    key, gathered = (["id", "th"], F.collect_set) if shared else (["id"], F.collect_list)  # equal rows of one id send the same
    lists = repeated.groupBy(*key).agg(gathered(F.struct("h", "place", "hot")).alias("found"))
    # doc_id goes along unused: with the same columns in both joins, the texts are shuffled once
    marks = _marks(_ranges(rows.join(lists, key).select("id", "th", "text", "found", "doc_id"), length), length, parts)
    by_doc = marks.groupBy(*key).agg(gathered(F.struct("start", "stop")).alias("marks"))

    def cut(batches: Batches) -> Batches:
        for b in batches:
            out = []
            for i, text, found in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist(), strict=True):
                raw = (text.as_py() or "").encode()
                spans: list[list[int]] = []
                if found:
                    for a, z in sorted((m["start"], m["stop"]) for m in found):
                        if spans and a <= spans[-1][1]:
                            spans[-1][1] = max(spans[-1][1], z)
                        else:
                            spans.append([a, z])
                edges = [0, *(x for s in spans for x in s), len(raw)]
                kept = b"".join(raw[a:z] for a, z in zip(edges[::2], edges[1::2], strict=True))
                out.append((i, kept, len(raw), len(raw) - len(kept), [{"start": a, "stop": z} for a, z in spans]))
            kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])))
            cols = list(zip(*out, strict=True)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["doc_id", "kept", "n_bytes", "n_removed", "spans"])

    return rows.join(by_doc, key, "left").select(F.col("doc_id").cast("long"), "text", "marks").mapInArrow(cut, "doc_id long, kept binary, n_bytes long, n_removed long, spans array<struct<start:int,stop:int>>")


def repeats_digest(cleaned: DataFrame) -> DataFrame:
    return cleaned.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
