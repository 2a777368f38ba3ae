"""Language-model scoring with a log-frequency Bloom filter.

Training tokens become word and word-pair counts. Counts up to ``EXACT`` are their own levels, larger ones have ``STEPS``
levels to each doubling. An n-gram is put into the filter once for each level up to its own; a reader probes level after
level until one is absent, which gives the count back to 0.6 %. The filter's size follows the number of training tokens
without a limit: it consists of segments of a bounded size, and no task or broadcast holds more than one. The n-grams of
all texts, distinct within parts of the rows, are dealt to the segments with their training counts; a segment's task sets
its bits, probes them for each part, and the levels go back to the part's rows. What n-grams found by chance add to a
history is known from the share of bits set, and is part of the history's normaliser.

The exact unigram base score is computed beside it: counts of the ``head_words`` most frequent words (a bounded number)
are broadcast, all other words of a text are joined with their counts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellquant.llm.common import ascii_words, materialize, shuffle_partitions

END = b" "  # no word holds a blank
_START = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xFF51AFD7ED558CCD)
_FIRST = np.zeros(1, int)
HASHES, BITS_A_TOKEN = 3, 64
EXACT, STEPS = 92, 64  # from 92 on, a step of 2^(1/64) holds a whole number at least
_LEVEL = np.uint64(0x2545F4914F6CDD1D)
#: training tokens for which the filter gets another segment, and n-grams (repeats included) after which a part ends
SEGMENT_TOKENS, PART_KEYS = 400_000, 2_000_000
Batches = Iterator[pa.RecordBatch]


class _Ids(dict):
    """Word to 64-bit hash, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


class _Counts(dict):
    """Counts of known words, 0 for others."""

    def __missing__(self, word: bytes) -> int:
        return 0


def _pairs(h: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Hash of each word with the one before it; texts laid end to end begin at ``starts``, each after the start mark."""
    before = np.concatenate((h[:1], h[:-1]))
    before[starts] = _START
    x = (before * np.uint64(0x9FB21C651E98DF25)) ^ (h + np.uint64(0x165667B19E3779F9))
    x = (x ^ (x >> np.uint64(33))) * _MIX
    return x ^ (x >> np.uint64(29))


def levels(counts: np.ndarray) -> np.ndarray:
    counts = counts.astype(float)
    return np.where(counts < EXACT, counts, EXACT + np.floor(STEPS * np.log2(np.maximum(counts / EXACT, 1)))).astype(np.uint16)


def _counted(texts: DataFrame, flush_words: int = 400_000) -> DataFrame:
    """(word, n) of all tokens, summed in each task before they leave it."""

    def run(batches: Batches) -> Batches:
        seen: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            got = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])
            seen.clear()
            return got

        for b in batches:
            for t in b.column(0):
                seen.update(ascii_words(t.as_py()))
                seen[END] += 1
                if len(seen) > flush_words:
                    yield out()
        if seen:
            yield out()

    return texts.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _merged(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, int)
    return keys[first], np.add.reduceat(n, first) if len(first) else n


def _planes(x: np.ndarray) -> bytes:
    """Byte by byte of all numbers, so that the high zeros compress."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes()


def _numbers(data: bytes, kind: type) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _ngram_blobs(rows: DataFrame, segments: int) -> DataFrame:
    """(segment, part, keys, counts) of (row, held_out, text): distinct hashed words and pairs of each part in order, with
    their training counts (0 if only held-out texts have them), packed by segment of the filter. A part is a run of
    consecutive rows in one task, named by its first row."""
    shift, part_keys = np.uint64(64 - segments.bit_length() + 1), PART_KEYS

    def run(batches: Batches) -> Batches:
        ids, held, trains, size, first, last = _Ids(), [], [], 0, None, None

        def out() -> pa.RecordBatch:
            keys, n = _merged(np.concatenate(held), np.repeat(np.array(trains, np.uint32), [len(x) for x in held]))
            cuts = np.searchsorted(keys >> shift, np.arange(segments + 1, dtype=np.uint64)) if segments > 1 else np.array([0, len(keys)])
            full = np.flatnonzero(np.diff(cuts))
            steps, n = np.diff(keys, prepend=np.uint64(0)), n.astype(np.uint32)
            steps[cuts[full]] = keys[cuts[full]]
            held.clear()
            trains.clear()
            blobs = [[_planes(x[cuts[s] : cuts[s + 1]]) for s in full.tolist()] for x in (steps, n)]
            return pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array([first] * len(full), pa.int64()), *(pa.array(x, pa.binary()) for x in blobs)], ["segment", "part", "keys", "counts"])

        for b in batches:
            for row, held_out, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                if held and (size > part_keys or row != last + 1):
                    yield out()
                    size = 0
                if not held:
                    first = row
                last = row
                words = ascii_words(t.as_py())
                h = np.fromiter(map(ids.__getitem__, [*words, END]), np.uint64, len(words) + 1)
                held += [h, _pairs(h, _FIRST)]
                trains += [not held_out] * 2
                size += 2 * len(h)
        if held:
            yield out()

    return rows.select("row", "held_out", "text").mapInArrow(run, "segment int, part long, keys binary, counts binary")


def _places(keys: np.ndarray, level: np.ndarray | int, segments: int, bits: int) -> Iterator[np.ndarray]:
    """Bits of the ``HASHES`` probes of each key at its level: the key's high bits give the segment, so one task builds a
    segment whole."""
    low = np.uint64(bits // segments - 1)
    base = (keys >> np.uint64(64 - segments.bit_length() + 1)) * np.uint64(bits // segments) if segments > 1 else np.uint64(0)
    x = (keys ^ np.atleast_1d(np.asarray(level, np.uint64)) * _LEVEL) * _MIX
    x ^= x >> np.uint64(32)
    step = (x * np.uint64(0xC4CEB9FE1A85EC53)) >> np.uint64(17) | np.uint64(1)
    for i in range(HASHES):
        yield base + ((x + np.uint64(i) * step) >> np.uint64(3) & low)


class LogFrequencyFilter:
    """The filter, or with ``alone`` one segment of it, to which then only that segment's keys may be added and put."""

    def __init__(self, bits: int, segments: int, alone: bool = False):
        self.bits, self.segments = bits, segments
        self.data = np.zeros(bits // segments if alone else bits, bool)
        self.inside = np.uint64(len(self.data) - 1 if alone else (1 << 64) - 1)

    def add(self, keys: np.ndarray, top: np.ndarray, block: int = 1 << 16) -> None:
        """Set the bits of all levels up to each key's own."""
        for at in range(0, len(keys), block):  # a block's levels are laid end to end
            n = top[at : at + block].astype(int)
            level = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + 1
            for p in _places(np.repeat(keys[at : at + block], n), level, self.segments, self.bits):
                self.data[p & self.inside] = True

    def level(self, keys: np.ndarray) -> np.ndarray:
        """The last level before the first that is absent, 0 if level 1 is; levels are probed some at a time."""
        found = np.zeros(len(keys), np.uint16)
        at, low = np.arange(len(keys)), 0
        while len(at):
            width = min(max(1, low // 2), 64)
            k, marks = np.repeat(keys[at], width), np.tile(np.arange(low + 1, low + width + 1), len(at))
            hit = np.ones(len(k), bool)
            for p in _places(k, marks, self.segments, self.bits):
                hit &= self.data[p & self.inside]
            hit = hit.reshape(len(at), width)
            on = hit.all(axis=1)
            found[at[~on]] = low + hit[~on].argmin(axis=1)
            at, low = at[on], low + width
        return found

    def chance(self) -> float:
        """How likely a level that was never set is found all the same."""
        return float(self.data.mean()) ** HASHES


def filter_size(tokens: int) -> tuple[int, int]:
    """(bits, segments) for so many training tokens, without a limit."""
    wanted = max(1 << 16, tokens * BITS_A_TOKEN)
    segments = 1 << max(0, tokens // SEGMENT_TOKENS).bit_length()
    each = max(64, 1 << (wanted // segments).bit_length() - 1)
    return each * segments * (2 if each * segments * 3 // 2 <= wanted else 1), segments


def probe_filter(rows: DataFrame, tokens: int) -> DataFrame:
    """(part, segment, data, chance): the levels of each part's n-grams in order of their keys, and under part -1 how likely
    the segment finds what was never put in. A task sets the bits of one segment whole and then probes them."""
    bits, segments = filter_size(tokens)

    def run(batches: Batches) -> Batches:
        held: list[tuple[int, int, bytes, bytes]] = []

        def out() -> pa.RecordBatch:
            asked = [_numbers(k, np.uint64).cumsum(dtype=np.uint64) for _, _, k, _ in held]
            keys, n = _merged(np.concatenate(asked), np.concatenate([_numbers(c, np.uint32).astype(np.uint64) for _, _, _, c in held]))
            here = LogFrequencyFilter(bits, segments, alone=True)
            here.add(keys, levels(n))
            found = here.level(keys)
            rows = [(-1, b"", here.chance()), *((part, _planes(found[np.searchsorted(keys, k)]), None) for (_, part, _, _), k in zip(held, asked, strict=True))]
            part, data, chance = zip(*rows, strict=True)
            cols = [pa.array(part, pa.int64()), pa.array([held[0][0]] * len(rows), pa.int32()), pa.array(data, pa.binary()), pa.array(chance, pa.float64())]
            return pa.RecordBatch.from_arrays(cols, ["part", "segment", "data", "chance"])

        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if held and held[0][0] != row[0]:
                    yield out()
                    held.clear()
                held.append(row)
        if held:
            yield out()

    n = min(segments, max(shuffle_partitions(rows.sparkSession), 1))
    blobs = _ngram_blobs(rows, segments).repartition(n, "segment").sortWithinPartitions("segment")
    return blobs.mapInArrow(run, "part long, segment int, data binary, chance double")


def _level_values() -> np.ndarray:
    """The middle of each level's counts."""
    edges = np.ceil(EXACT * 2.0 ** (np.arange(STEPS * 56 + 1) / STEPS))  # up to the largest long
    return np.concatenate((np.arange(EXACT, dtype=float), (edges[:-1] + edges[1:] - 1) / 2))


VALUE = _level_values()


def log10_probabilities(word: np.ndarray, pair: np.ndarray, starts: np.ndarray, tokens: int, distinct: int, texts: int, chance: float = 0.0, mix: float = 0.6) -> np.ndarray:
    """log10 P(word | word before), a model of order two, for texts laid end to end, from the levels that the filter gave.

    The pair's share of its history is mixed with the word's smoothed share of all tokens; a history that was never seen
    leaves all to the latter. A text's first word has the start as history, seen once in each of the ``texts`` training rows.
    With ``chance``, a pair is found one level higher than it is; over all ``distinct`` words that adds ``chance * distinct``
    to what any history has, so its normaliser has as much more. Counts are right within 0.55 %, so that the probabilities
    after any history sum to one within 0.4 * 0.0055 + 0.6 * 0.011 = 0.009."""
    word, pair = VALUE[word], VALUE[pair]
    before = np.concatenate((word[:1], word[:-1]))
    before[starts] = texts
    seen, more = np.where(before > 0, mix, 0), chance * distinct
    share = np.minimum(np.minimum(pair, word), before) / np.where(before > 0, before + more, 1)
    return np.log10(seen * share + (1 - seen) * (word + 0.1) / (tokens + more + 0.1 * (distinct + 1)))


def _with_levels(rows: DataFrame, probed: DataFrame) -> DataFrame:
    """(part, row, doc_id, held_out, text, segment, data): each part's levels (row -1), then its rows, in one task."""
    answers = probed.where("part >= 0").drop("chance")
    ends = F.lead("part").over(Window.partitionBy(F.shiftright("part", 33)).orderBy("part"))  # row ids of one task share their high bits
    parts = answers.select("part").distinct().select("part", ends.alias("until"))
    inside = (F.shiftright("row", 33) == F.shiftright("part", 33)) & (F.col("row") >= F.col("part")) & (F.col("row") < F.coalesce("until", F.lit((1 << 63) - 1)))
    texts = rows.join(F.broadcast(parts), inside).drop("until")
    both = texts.unionByName(answers.withColumn("row", F.lit(-1).cast("long")), allowMissingColumns=True)
    return both.select("part", "row", "doc_id", "held_out", "text", "segment", "data").repartition("part").sortWithinPartitions("part", "row", "segment")


def score_documents(documents: DataFrame, *, folds: int = 10, head_words: int = 500_000) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    Training rows are those whose crc32(doc_id as text) is no multiple of ``folds``; a row with a null doc_id trains. A
    null or empty text has only the end token. With no training rows, counts are 0 and scores follow from the formula.
    Repeated rows each train and each get a row; other columns are ignored.
    """
    spark = documents.sparkSession
    rows = documents.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == 0, F.lit(False)).alias("held_out"), "text")
    rows = materialize(rows, "scored-rows")  # the row ids must not change any more
    training = rows.where(~F.col("held_out")).select("text")
    counts = materialize(_counted(training), "word-counts")
    tokens, distinct = (x or 0 for x in counts.agg(F.sum("n"), F.count(F.lit(1))).first())
    texts = (counts.where(F.col("word") == F.lit(END)).agg(F.sum("n")).first()[0] or 0)  # each training row has one end
    held = rows.where("held_out").agg(F.sum(F.octet_length("text"))).first()[0] or 0
    size = max(tokens, held // 6)  # segments for held-out n-grams too, where few rows train
    probed = materialize(probe_filter(rows, size), "filter")
    chance = (probed.where("part = -1").agg(F.sum("chance")).first()[0] or 0.0) / filter_size(size)[1]
    head = counts.orderBy(F.desc("n"), "word").limit(head_words)
    table = head.toArrow()
    floor = int(table["n"][-1].as_py()) if table.num_rows == head_words else 0
    words = dict(zip(map(bytes, table["word"].to_pylist()), table["n"].to_pylist(), strict=True))
    shared = spark.sparkContext.broadcast(words)
    del words, table

    def run(batches: Batches) -> Batches:
        ids, head = _Ids(), _Counts(shared.value)
        now, found, done, hashes = None, [], [], []

        def read(b: pa.RecordBatch) -> None:
            """Base scores and hashes of some rows, kept until their part ends."""
            texts = [[*ascii_words(t.as_py()), END] for t in b.column("text")]
            sizes = np.array([len(t) for t in texts])
            starts = np.cumsum(sizes) - sizes
            tok = [w for t in texts for w in t]
            hashes.append((np.fromiter(map(ids.__getitem__, tok), np.uint64, len(tok)), sizes))
            c = np.fromiter(map(head.__getitem__, tok), np.int64, len(tok))
            logs = np.log10(c + 0.1)
            logs[c == 0] = 0
            rare = [Counter(tok[i] for i in (s + np.flatnonzero(c[s : s + n] == 0)).tolist()) for s, n in zip(starts.tolist(), sizes.tolist(), strict=True)]
            cols = [
                *(b.column(x) for x in ("row", "doc_id", "held_out")),
                pa.array(sizes),
                pa.array(np.add.reduceat((c > 0).astype(np.int64), starts)),
                pa.array(np.add.reduceat(logs, starts)),
                pa.array([list(r) for r in rare], pa.list_(pa.binary())),
                pa.array([list(r.values()) for r in rare], pa.list_(pa.int64())),
            ]
            done.append(pa.RecordBatch.from_arrays(cols, ["row", "doc_id", "held_out", "n_tokens", "known", "part", "rare", "times"]))

        def out() -> Batches:
            """The part's rows with their scores: its n-grams in order are those that were asked for."""
            h, sizes = (np.concatenate(x) for x in zip(*hashes, strict=True))
            starts = np.cumsum(sizes) - sizes
            keys, back = np.unique(np.concatenate((h, _pairs(h, starts))), return_inverse=True)
            level = np.concatenate([_numbers(d, np.uint16) for d in found])
            assert len(level) == len(keys), "levels of other rows"
            level = level[back]
            scores = np.add.reduceat(log10_probabilities(level[: len(h)], level[len(h) :], starts, tokens, distinct, texts, chance), starts)
            at = 0
            for b in done:
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(scores[at : at + b.num_rows])], [*b.schema.names, "score"])
                at += b.num_rows
            done.clear()
            hashes.clear()
            found.clear()

        for batch in batches:
            part, row = batch.column("part").to_numpy(), batch.column("row").to_numpy()
            edges = [0, *(np.flatnonzero((part[1:] != part[:-1]) | ((row[1:] < 0) != (row[:-1] < 0))) + 1).tolist(), len(part)] if len(part) else []
            for lo, hi in zip(edges, edges[1:], strict=False):
                if part[lo] != now:
                    if now is not None:
                        yield from out()
                    now = part[lo]
                if row[lo] < 0:
                    found += batch.column("data").slice(lo, hi - lo).to_pylist()
                else:
                    for at in range(lo, hi, 500):  # enough texts for long arrays, few enough for memory
                        read(batch.slice(at, min(500, hi - at)))
        if now is not None:
            yield from out()

    kind = documents.schema["doc_id"].dataType.simpleString()
    scored = materialize(
        _with_levels(rows, probed).mapInArrow(run, f"row long, doc_id {kind}, held_out boolean, n_tokens long, known long, part double, rare array<binary>, times array<long>, score double"), "scored"
    )
    tail = counts.where(F.col("n") <= floor)  # the head holds every word above; words of it are never asked for
    rare = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("r")).select("row", F.col("r.rare").alias("word"), F.col("r.times").alias("times"))
    found = rare.join(tail, "word", "left").groupBy("row").agg(
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("more"), F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 0.1)).alias("rest")
    )
    per_token = F.lit(float(np.log10(tokens + 0.1 * (distinct + 1))))
    return scored.drop("rare", "times").join(found, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("part") + F.coalesce("rest", F.lit(0.0)) - F.col("n_tokens") * per_token).alias("base_score"),
        "score",
    )
