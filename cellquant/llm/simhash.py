"""SimHash near-duplicates: fingerprints, vantage-point trees over overlapping shards, connected components.

Fingerprints are dealt to shards by masked Hamming distance: a shard is the ball of radius zero around one value of some
bits. A pair at distance 3 or less leaves whole at least two of five bit groups, so of the ten shards to which each
fingerprint goes (one for each two groups) the pair shares at least one: no pair is lost at a shard's boundary. Inside a
shard a vantage-point tree is built over bounded blocks and the triangle bound prunes its branches. Shards above
``hot_shard`` rows are dealt again by five of eight groups (56 shards a fingerprint), which leaves 24 free bits, so their
size has a fixed bound too.

``similar_documents`` takes a similarity of shingle sets instead (0.8 of five-word shingles in the pipeline). Such pairs
differ in 15 % of a fingerprint's bits, too many for shards that miss none, so it deals 512-bit fingerprints to as many
shards of random bits as a stated recall needs. Fingerprints only propose pairs there: a link is one whose shingle sets
are that similar, counted exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellquant.llm.common import ascii_words, materialize, settle

MAX_BITS, SEED = 3, 42


def _masks(groups: int, whole: int) -> list[int]:
    edges = [round(i * 64 / groups) for i in range(groups + 1)]
    parts = [((1 << b) - (1 << a)) for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(x) for x in combinations(parts, whole)]


FIRST_MASKS, SECOND_MASKS = _masks(5, 2), _masks(8, 5)


def fingerprint(text: str | None, shingle_words: int = 3) -> int:
    """Signed 64-bit SimHash: a bit is 1 if set in over half of the shingles' XXH64."""
    hashes = shingle_hashes(text, shingle_words)
    return int(majority_bits(hashes).view("<i8")[0]) if len(hashes) else 0


def shingle_hashes(text: str | None, shingle_words: int) -> np.ndarray:
    """XXH64 of every shingle, repeats included; a text of fewer words is one shingle, a wordless one has none."""
    words = ascii_words(text)
    if not words:
        return np.zeros(0, np.uint64)
    line, n = b" ".join(words), len(words)
    if n <= shingle_words:
        hashes = [xxhash.xxh64_intdigest(line, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        digest = xxhash.xxh64_intdigest
        hashes = [digest(line[a:b], SEED) for a, b in zip(starts[: n - shingle_words + 1].tolist(), ends[shingle_words - 1 :].tolist(), strict=True)]
    return np.array(hashes, np.uint64)


def majority_bits(h: np.ndarray) -> np.ndarray:
    """The 64 bits set in over half of the hashes, as 8 bytes."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 65_536):  # bounded however long the text
        ones += np.unpackbits(h[at : at + 65_536].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return np.packbits(ones * 2 > len(h), bitorder="little")


def fingerprints(documents: DataFrame, shingle_words: int = 3) -> DataFrame:
    """(doc_id, fp): 64-bit fingerprints of whole texts; null and wordless texts have 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(t.as_py(), shingle_words) for t in b.column(1)), np.int64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps)], ["doc_id", "fp"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fp long")


class VantageTree:
    """Vantage-point tree over a block of fingerprints; range queries are answered for many queries at once."""

    LEAF = 64

    def __init__(self, fps: np.ndarray):
        self.fps = fps
        self.root = self._build(np.arange(len(fps)))

    def _build(self, at: np.ndarray) -> tuple:
        if len(at) <= self.LEAF:
            return ("leaf", at)
        v = self.fps[at[0]]
        d = np.bitwise_count(self.fps[at] ^ v)
        middle = int(np.median(d))
        inner, outer = at[d <= middle], at[d > middle]
        if not len(inner) or not len(outer):
            middle = int(d.min())
            inner, outer = at[d <= middle], at[d > middle]
        if not len(outer):
            return ("leaf", at)
        return ("node", v, middle, int(d.max()), self._build(inner), self._build(outer))

    def within(self, queries: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query places, tree places) of all pairs at ``radius`` or less, in chunks."""
        todo = [(self.root, np.arange(len(queries)))]
        while todo:
            node, at = todo.pop()
            if not len(at):
                continue
            if node[0] == "leaf":
                for lo in range(0, len(at), 4096):
                    part = at[lo : lo + 4096]
                    q, t = np.nonzero(np.bitwise_count(queries[part][:, None] ^ self.fps[node[1]][None, :]) <= radius)
                    yield part[q], node[1][t]
                continue
            _, v, middle, most, inner, outer = node
            d = np.bitwise_count(queries[at] ^ v).astype(np.int16)
            todo.append((inner, at[d - radius <= middle]))
            todo.append((outer, at[(d + radius > middle) & (d - radius <= most)]))


def shard_links(fps: np.ndarray, radius: int = MAX_BITS, block: int = 32_768) -> np.ndarray:
    """Links that join all fingerprints of one shard that belong together, as rows (smaller, larger) of values.

    Each block's tree is asked for its own pairs and those with later blocks, so memory is bounded by the block; a link
    between two that are joined already is not reported again, so there are fewer links than fingerprints.
    """
    parent = np.arange(len(fps))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    out = []
    for lo in range(0, len(fps), block):
        tree = VantageTree(fps[lo : lo + block])
        for q0 in range(lo, len(fps), block):
            for q, t in tree.within(fps[q0 : q0 + block], radius):
                q, t = q + q0, t + lo
                new = q > t
                q, t = q[new], t[new]
                apart = parent[q] != parent[t]
                for a, b in zip(q[apart].tolist(), t[apart].tolist(), strict=True):
                    ra, rb = root(a), root(b)
                    if ra != rb:
                        parent[max(ra, rb)] = min(ra, rb)
                        out.append((fps[a], fps[b]))
    return np.array(out, np.uint64).reshape(-1, 2)


def _in_shards(fps: DataFrame, masks: list[int]) -> DataFrame:
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keys = F.array(*[F.struct(F.lit(i).alias("mask"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("value")) for i, m in enumerate(signed)])
    return fps.select("fp", F.explode(keys).alias("k")).select("fp", "k.mask", "k.value")


def _links_by_shard(rows: DataFrame) -> DataFrame:
    """Links (a, b) in every shard. Shards arrive sorted; several small ones share a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []  # batches of the shards that have not ended
        size = 0

        def links(rows: np.ndarray) -> pa.RecordBatch:
            cuts = np.flatnonzero((rows[1:, :2] != rows[:-1, :2]).any(axis=1)) + 1
            edges = np.concatenate(([0], cuts, [len(rows)]))
            big = np.flatnonzero(np.diff(edges) > 1)
            found = [shard_links(np.ascontiguousarray(rows[edges[i] : edges[i + 1], 2]).view(np.uint64)) for i in big]
            both = np.concatenate([np.empty((0, 2), np.uint64), *found]).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])

        for b in batches:
            rows = np.column_stack([b.column(i).to_numpy() for i in range(3)])
            if size > 100_000 and len(rows):
                cut = np.flatnonzero((rows[1:, :2] != rows[:-1, :2]).any(axis=1))
                last = cut[-1] + 1 if len(cut) else 0 if (rows[0, :2] != held[-1][-1, :2]).any() else None
                if last is not None:
                    yield links(np.concatenate([*held, rows[:last]]))
                    held, rows, size = [], rows[last:], 0
            if len(rows):
                held.append(rows)
                size += len(rows)
        if held:
            yield links(np.concatenate(held))

    dealt = rows.select(F.col("mask").cast("long").alias("mask"), "value", "fp").repartition("mask", "value").sortWithinPartitions("mask", "value", "fp")
    return dealt.mapInArrow(run, "a long, b long")


def fingerprint_links(distinct: DataFrame, hot_shard: int = 20_000) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp) that join exactly what belongs together."""
    first = _in_shards(distinct, FIRST_MASKS)
    hot = materialize(first.groupBy("mask", "value").count().where(F.col("count") > hot_shard).select("mask", "value"), "hot-shards")
    cool = first.join(hot, ["mask", "value"], "left_anti")
    again = _in_shards(first.join(hot, ["mask", "value"], "left_semi").select("fp").distinct(), SECOND_MASKS)
    return _links_by_shard(cool.withColumn("mask", F.col("mask").cast("long")).unionByName(again.withColumn("mask", F.col("mask").cast("long") + 1000))).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for every node of ``links`` (a, b).

    Alternates large-star and small-star, writing the links of each round to the shared folder, until nothing changes;
    rounds grow with the logarithm of the largest component, and no component is ever gathered in one place.
    """
    edges = materialize(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        edges = materialize(small.where("u <> v").distinct(), "links")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == before:
            break
        before = tuple(now)
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def near_duplicates(documents: DataFrame, *, shingle_words: int = 3) -> DataFrame:
    """(doc_id, fp, component_id) for every row: component_id is the smallest doc_id reachable over fingerprints that
    differ in 3 bits or fewer, itself included.

    Null, empty and wordless texts share fingerprint 0 and are linked like any other. Rows that repeat a doc_id each get
    a row. A null doc_id never is a component's id unless no other is in it. An empty table gives an empty result.
    """
    fps = materialize(fingerprints(documents, shingle_words), "fingerprints")
    distinct = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("first_doc")), "distinct-fingerprints")
    roots = settle(lambda: connected_components(fingerprint_links(distinct.select("fp"))), "roots")
    labelled = distinct.join(roots, distinct.fp == roots.node, "left").select("fp", "first_doc", F.coalesce("root", "fp").alias("root"))
    ids = labelled.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    by_fp = labelled.join(ids, "root").select("fp", "component_id")
    return fps.join(by_fp, "fp").select("doc_id", "fp", "component_id")


WIDE = 8  # words of 64 bits in a wide fingerprint
BLOCK = 256  # rows that are compared with as many at once: 4 MB of differing bits, 15 MB of shard numbers if all are close
_SPREAD = np.random.default_rng(SEED).integers(1 << 62, 1 << 63, WIDE, dtype=np.uint64) | np.uint64(1)


def shingle_set(text: str | None, shingle_words: int) -> np.ndarray:
    return np.unique(shingle_hashes(text, shingle_words))


def wide_fingerprint(text: str | None, shingle_words: int) -> bytes:
    """512-bit SimHash of the set of shingles (eight hashes are drawn from each shingle's XXH64; all zero for wordless
    texts), then 128 bits that tell sets of one SimHash apart."""
    h = shingle_set(text, shingle_words)
    if not len(h):
        return bytes(8 * WIDE + 16)
    out = b""
    for factor in _SPREAD:
        x = (h ^ (h >> np.uint64(31))) * factor
        out += majority_bits((x ^ (x >> np.uint64(29))) * np.uint64(0xFF51AFD7ED558CCD)).tobytes()
    return out + xxhash.xxh3_128_digest(h.tobytes())


def bits_apart(similarity: float) -> float:
    """Share of bits in which SimHashes of two equally long texts of that Jaccard similarity differ on average."""
    return math.acos(min(1.0, 2 * similarity / (1 + similarity))) / math.pi


def close_links(fps: np.ndarray, radius: int, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """(links, parent): links as rows of two places that join all of ``fps`` (n x words) that belong together.

    Each vantage point is linked to all in its ball at once, so a tight group costs one comparison a row and never all its
    pairs; by the triangle inequality only what is within twice the radius can meet members of the ball.
    """
    parent, out = np.arange(len(fps)), []

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def link(a: int, b: int) -> None:
        x, y = root(a), root(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
            out.append((a, b))

    def cross(a: np.ndarray, b: np.ndarray) -> None:
        for lo in range(0, len(a), block):
            for at in range(0, len(b), block):
                p, q = a[lo : lo + block], b[at : at + block]
                for i, j in zip(*np.nonzero(np.bitwise_count(fps[p][:, None] ^ fps[q][None]).sum(axis=2, dtype=np.int16) <= radius), strict=True):
                    if parent[p[i]] != parent[q[j]]:
                        link(int(p[i]), int(q[j]))

    todo = [np.arange(len(fps))]
    while todo:
        at = todo.pop()
        if len(at) <= 256:
            d = np.bitwise_count(fps[at][:, None] ^ fps[at][None]).sum(axis=2, dtype=np.int16)
            for i, j in zip(*np.nonzero(np.triu(d <= radius, 1)), strict=True):
                link(int(at[i]), int(at[j]))
            continue
        d = np.bitwise_count(fps[at] ^ fps[at[0]]).sum(axis=1, dtype=np.int16)
        ball, rest, far = at[d <= radius], at[d > radius], d[d > radius]
        for i in ball[1:].tolist():
            link(int(at[0]), i)
        cross(ball[1:], rest[far <= 2 * radius])
        if len(rest) <= 256 or len(ball) > len(rest) // 64:
            todo.append(rest)
            continue
        middle = np.median(far)
        todo += [rest[far <= middle], rest[far > middle]]
        cross(rest[(far <= middle) & (far > middle - radius)], rest[(far > middle) & (far <= middle + radius)])
    for i in range(len(parent)):
        root(i)
    return np.array(out, np.int64).reshape(-1, 2), np.array([root(i) for i in range(len(parent))], np.int64)


def shard_plan(rows: int, similarity: float, recall: float = 0.97, shard_rows: int = 128) -> list[np.ndarray]:
    """Bits that name the shards of each dealing: so many that shards of unrelated texts hold ``shard_rows`` on average, in
    so many dealings that a pair of just that similarity shares one with the probability ``recall``."""
    k = max(4, math.ceil(math.log2(max(1, rows) / shard_rows)))
    dealings = math.ceil(math.log(1 - recall) / math.log(1 - (1 - bits_apart(similarity)) ** k))
    rng = np.random.default_rng(SEED)
    return [np.sort(rng.permutation(64 * WIDE)[:k]) for _ in range(dealings)]


def shard_keys(fps: list[bytes], plan: list[np.ndarray]) -> np.ndarray:
    """rows x dealings: the number of each fingerprint's shard in each dealing."""
    raw = np.frombuffer(b"".join(fps), np.uint8).reshape(len(fps), -1)[:, : 8 * WIDE]
    bits = np.unpackbits(raw, axis=1, bitorder="little")
    return np.column_stack([bits[:, places].astype(np.int64) @ (np.int64(1) << np.arange(len(places))) for places in plan])


def _as_words(fps: list[bytes]) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(b"".join(fps), np.uint8).reshape(len(fps), -1)[:, : 8 * WIDE]).view(np.uint64)


def cross_pairs(keys: list[bytes], label: np.ndarray, plan: list[np.ndarray], radius: int, block: int = BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of places whose fingerprints are within ``radius``, whose labels differ, and that no dealing of ``plan`` (the
    earlier ones) brings together, in chunks."""
    fps, shards = _as_words(keys), None
    order = np.argsort(label, kind="stable")
    for lo in range(0, len(fps), block):
        p = order[lo : lo + block]
        for at in range(lo, len(fps), block):
            q = order[at : at + block]
            if label[p[0]] == label[q[-1]]:
                continue  # sorted, so all are of one label
            near = (np.bitwise_count(fps[p][:, None] ^ fps[q][None]).sum(axis=2, dtype=np.int16) <= radius) & (label[p][:, None] != label[q][None])
            i, j = np.nonzero(np.triu(near, 1) if at == lo else near)
            i, j = p[i], q[j]
            if len(i) and plan:
                if shards is None:
                    shards = shard_keys(keys, plan)
                first = ~(shards[i] == shards[j]).any(axis=1)
                i, j = i[first], j[first]
            if len(i):
                yield i, j


def _dealt(nodes: DataFrame, plan: list[np.ndarray]) -> DataFrame:
    """(unit, dealing, fp, label) of nodes (fp, label): a row for each dealing. A unit is what one task compares."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            keys = shard_keys(b.column(0).to_pylist(), plan)
            for t in range(len(plan)):
                yield pa.RecordBatch.from_arrays([pa.array((np.int64(t) << 44) + keys[:, t]), pa.array(np.full(b.num_rows, t, np.int32)), *b.columns], ["unit", "dealing", "fp", "label"])

    return nodes.mapInArrow(deal, "unit long, dealing int, fp binary, label long")


def _by_unit(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.select("unit", "dealing", *columns).repartition("unit").sortWithinPartitions("unit")


def _units(batches: Iterator[pa.RecordBatch], most: int | None = None) -> Iterator[tuple[int, int, list[list], bool]]:
    """(unit, dealing, its other columns as lists, whether it has more than ``most`` rows) from batches sorted by unit. A unit
    beyond ``most`` comes in several parts, each of which says so; its first part is known to be one only from the next
    row on, so it is held back until then."""
    held: list[list] | None = None
    last, dealing, hot = None, 0, False
    for b in batches:
        unit = b.column(0).to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(unit)) + 1).tolist(), len(unit)] if len(unit) else []
        columns = [c.to_pylist() for c in b.columns[2:]]
        for lo, hi in zip(edges, edges[1:], strict=False):
            if unit[lo] != last:
                if held and held[0]:
                    yield last, dealing, held, hot
                last, dealing, hot, held = int(unit[lo]), b.column(1)[lo].as_py(), False, [[] for _ in columns]
            for whole, part in zip(held, columns, strict=True):
                whole += part[lo:hi]
            if hot or most and len(held[0]) > most:
                hot = True
                yield last, dealing, held, True
                held = [[] for _ in columns]
    if held and held[0]:
        yield last, dealing, held, hot


def _in_windows(hot: DataFrame, window: int) -> DataFrame:
    """Rows (unit, dealing, fp, label) of units beyond ``window``: each is dealt to windows, and each two windows of a unit are a
    unit of their own, so that every member meets every other and no task holds more than two windows."""
    sizes = hot.groupBy("unit").agg(F.ceil(F.count(F.lit(1)) / window).alias("windows"), (F.min("label") < F.max("label")).alias("differ"))
    mine = hot.join(F.broadcast(sizes), "unit").withColumn("w", F.pmod(F.xxhash64("fp", "unit"), F.col("windows")))  # a row for each large unit
    met = mine.withColumn("o", F.explode(F.sequence(F.lit(0).cast("long"), F.col("windows") - 1))).where("o <> w")
    return met.select(F.xxhash64("unit", F.least("w", "o"), F.greatest("w", "o")).alias("unit"), "dealing", "fp", "label", "differ")


def _wide_links(distinct: DataFrame, plan: list[np.ndarray], radius: int, window: int = 50_000) -> DataFrame:
    """Distinct links (a, b) of wide fingerprints (column fp) within the shards of all dealings: enough of them to join what
    belongs together. Shards beyond ``window`` rows: see ``_in_windows``."""

    def linker(most: int | None):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names = ["a", "b", "unit", "dealing"]
            for unit, dealing, (keys, _), hot in _units(batches, most):
                if hot:
                    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.nulls(len(keys), pa.binary()), pa.array([unit] * len(keys), pa.int64()), pa.array([dealing] * len(keys), pa.int32())], names)
                elif len(keys) > 1:
                    links = [sorted((keys[a], keys[b])) for a, b in close_links(_as_words(keys), radius)[0].tolist()]
                    yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in links], pa.binary()), pa.array([x[1] for x in links], pa.binary()), pa.nulls(len(links), pa.int64()), pa.nulls(len(links), pa.int32())], names)

        return run

    kind = "a binary, b binary, unit long, dealing int"
    nodes = distinct.select("fp", F.lit(0).cast("long").alias("label"))
    first = materialize(_by_unit(_dealt(nodes, plan), ["fp", "label"]).mapInArrow(linker(window), kind), "shard-links")
    hot = first.where(F.col("b").isNull()).select("unit", "dealing", F.col("a").alias("fp"), F.lit(0).cast("long").alias("label"))
    again = _by_unit(_in_windows(hot, window), ["fp", "label"]).mapInArrow(linker(None), kind)
    return first.where(F.col("b").isNotNull()).unionByName(again).select("a", "b").distinct()


def _cross_members(labelled: DataFrame, plan: list[np.ndarray], radius: int, window: int = 8192) -> DataFrame:
    """(unit, dealing, fp, label) of nodes (fp, label) that are within ``radius`` of one with another label in that unit. Pairs
    are not written: in a group of texts that are almost similar enough, there are as many as its size squared."""

    def run(batches: Iterator[pa.RecordBatch], most: int | None) -> Iterator[pa.RecordBatch]:
        for unit, dealing, (fps, labels), hot in _units(batches, most):
            if len(set(labels)) < 2 and not hot:
                continue
            near = np.zeros(len(fps), bool)
            if not hot:
                for i, j in cross_pairs(fps, np.array(labels), plan[:dealing], radius):
                    near[i] = near[j] = True
            at = range(len(fps)) if hot else np.flatnonzero(near).tolist()
            cols = [pa.array([unit] * len(at), pa.int64()), pa.array([dealing] * len(at), pa.int32()), pa.array([fps[i] for i in at], pa.binary()), pa.array([labels[i] for i in at], pa.int64()), pa.array([hot] * len(at), pa.bool_())]
            yield pa.RecordBatch.from_arrays(cols, ["unit", "dealing", "fp", "label", "hot"])

    kind, columns = "unit long, dealing int, fp binary, label long, hot boolean", ["fp", "label"]
    first = materialize(_by_unit(_dealt(labelled.select("fp", "label"), plan), columns).mapInArrow(lambda b: run(b, window), kind), "shard-members")
    again = _by_unit(_in_windows(first.where("hot").drop("hot"), window).where("differ"), columns).mapInArrow(lambda b: run(b, None), kind)
    return first.where("NOT hot").unionByName(again).drop("hot")


def exact_links(sets: list[np.ndarray], label: list[int], pairs: Iterator[tuple[np.ndarray, np.ndarray]], similarity: float) -> list[tuple[int, int]]:
    """Of pairs of places those whose sets are that similar, without such as join what the ones before have joined."""
    parent: dict[int, int] = {x: x for x in label}

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for i, j in pairs:
        order = np.argsort(i, kind="stable")
        i, j = i[order], j[order]
        for part in np.split(np.arange(len(i)), np.flatnonzero(np.diff(i)) + 1):
            if not len(part):
                continue
            one, own = int(i[part[0]]), sets[int(i[part[0]])]
            others = [int(x) for x in j[part] if root(label[int(x)]) != root(label[one])]
            if not others or not len(own):
                continue
            sizes = np.array([len(sets[x]) for x in others])
            every = np.concatenate([sets[x] for x in others])
            same = own[np.minimum(np.searchsorted(own, every), len(own) - 1)] == every
            both = np.add.reduceat(np.append(same, False), np.cumsum(sizes) - sizes, dtype=np.int64) * (sizes > 0)
            for x in np.flatnonzero(both >= similarity * (sizes + len(own) - both)).tolist():
                a, b = root(label[one]), root(label[others[x]])
                if a != b:
                    parent[max(a, b)] = min(a, b)
                    out.append((one, others[x]))
    return out


def _cross_links(members: DataFrame, texts: DataFrame, plan: list[np.ndarray], radius: int, shingle_words: int, similarity: float) -> DataFrame:
    """Links (a, b) between the labels of each unit's members, counted on their shingle sets, which come to the unit once a
    member; enough of them to join what belongs together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, dealing, (fps, labels, shingles), _ in _units(batches):
            sets = [np.frombuffer(x, np.uint64) for x in shingles]
            links = exact_links(sets, labels, cross_pairs(fps, np.array(labels), plan[:dealing], radius), similarity)
            yield pa.RecordBatch.from_arrays([pa.array([fps[a] for a, _ in links], pa.binary()), pa.array([fps[b] for _, b in links], pa.binary())], ["a", "b"])

    sets = _shingle_sets(members.select("fp").distinct(), texts, shingle_words)
    return _by_unit(members.join(sets, "fp"), ["fp", "label", "shingles"]).mapInArrow(run, "a binary, b binary").distinct()


def _shingle_sets(asked: DataFrame, texts: DataFrame, shingle_words: int) -> DataFrame:
    """(fp, shingles) of the fingerprints asked for: the sorted hashes, as bytes; ``texts`` (fp, text) holds all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([shingle_set(t.as_py(), shingle_words).tobytes() for t in b.column(1)], pa.binary())], ["fp", "shingles"])

    return texts.join(asked, "fp", "left_semi").dropDuplicates(["fp"]).select("fp", "text").mapInArrow(run, "fp binary, shingles binary")


def _verified(pairs: DataFrame, texts: DataFrame, shingle_words: int, similarity: float) -> DataFrame:
    """Those of the pairs (a, b) whose shingle sets have that Jaccard similarity; ``texts`` (fp, text) holds all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            good = []
            for x, y in zip(b.column(2), b.column(3), strict=True):
                x, y = (np.frombuffer(v.as_py(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(both >= similarity * (len(x) + len(y) - both))
            keep = b.filter(pa.array(good, pa.bool_()))
            yield pa.RecordBatch.from_arrays([keep.column(0), keep.column(1)], ["a", "b"])

    asked = pairs.select(F.col("a").alias("fp")).unionByName(pairs.select(F.col("b").alias("fp"))).distinct()
    sets = materialize(_shingle_sets(asked, texts, shingle_words), "shingle-sets")
    left, right = (sets.select(F.col("fp").alias(k), F.col("shingles").alias(f"of_{k}")) for k in ("a", "b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "of_a", "of_b").mapInArrow(run, "a binary, b binary")


def similar_documents(documents: DataFrame, *, shingle_words: int = 5, similarity: float = 0.8) -> DataFrame:
    """(doc_id, component_id) for every row: component_id is the smallest doc_id reachable over texts whose sets of shingles
    have that Jaccard similarity. Pairs are proposed by 512-bit SimHashes (the bits in which such texts differ on average,
    and three deviations more) and counted exactly.

    Close pairs are counted first, just enough to join tight groups; then all that are proposed between different groups,
    where they meet. So no link is left out that could join two, and no group's pairs are written out.

    Texts with the same words always belong together; null, empty and wordless ones too. Rows that repeat a doc_id each
    get a row. An empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([wide_fingerprint(t.as_py(), shingle_words) for t in b.column(1)], pa.binary()), b.column(1)], ["doc_id", "fp", "text"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    fps = materialize(documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fp binary, text string"), "wide-fingerprints")
    distinct = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("first_doc")), "distinct-fingerprints")
    p, n = bits_apart(similarity), 64 * WIDE
    plan, deviation = shard_plan(distinct.count(), similarity), math.sqrt(n * p * (1 - p))
    texts = fps.select("fp", "text")

    def joined() -> DataFrame:
        close = settle(lambda: _wide_links(distinct.select("fp"), plan, round(n * p)), "close-pairs")
        sure = settle(lambda: _verified(close, texts, shingle_words, similarity), "close-links")
        groups = settle(lambda: connected_components(sure), "close-groups")
        label = distinct.join(groups, distinct.fp == groups.node, "left").select("fp", F.xxhash64(F.coalesce("root", "fp")).alias("label"))
        wide = round(n * p + 3 * deviation)
        members = settle(lambda: _cross_members(materialize(label, "labels"), plan, wide), "wide-members")
        more = settle(lambda: _cross_links(members, texts, plan, wide, shingle_words, similarity), "wide-links")
        return connected_components(sure.unionByName(more))

    roots = settle(joined, "roots")
    labelled = distinct.join(roots, distinct.fp == roots.node, "left").select("fp", "first_doc", F.coalesce("root", "fp").alias("root"))
    ids = labelled.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    return fps.select("doc_id", "fp").join(labelled.join(ids, "root").select("fp", "component_id"), "fp").select("doc_id", "component_id")


def hex16(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
