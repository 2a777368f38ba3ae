"""Quality control of reads in one pass each: profiles by cycle, duplication, sequences that are too frequent."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

QUANTILES = {"q10": 0.1, "q25": 0.25, "q50": 0.5, "q75": 0.75, "q90": 0.9}
#: duplication levels: from how many copies on
LEVELS = (1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 50, 100, 500, 1000, 5000, 10000)


def _cycles(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """(place in its text, byte) of every byte."""
    raw = pc.fill_null(texts, "").cast(pa.large_binary())
    ends = np.cumsum(pc.binary_length(raw).to_numpy())
    sizes = np.diff(ends, prepend=0)
    data = np.frombuffer(b"".join(raw.to_pylist()), np.uint8)
    return np.arange(len(data)) - np.repeat(ends - sizes, sizes), data


def histograms(reads: DataFrame, seq: str, qual: str) -> DataFrame:
    """(cycle, kind, code, n): how often each byte of the bases (kind b) and qualities (kind q) stands at each place, from 1. A task
    sends a row for what a batch holds of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for kind, column in (("b", 0), ("q", 1)):
                at, data = _cycles(b.column(column))
                if len(data):
                    key = at * 256 + data
                    if key.max() < 8 * len(key):
                        n = np.bincount(key)
                        found = np.flatnonzero(n)
                        n = n[found]
                    else:  # a few long reads
                        found, n = np.unique(key, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(found // 256 + 1), pa.array([kind] * len(found)), pa.array((found % 256).astype(np.int32)), pa.array(n.astype(np.int64))], ["cycle", "kind", "code", "n"])

    each = reads.select(seq, qual).mapInArrow(run, "cycle long, kind string, code int, n long")
    return each.groupBy("cycle", "kind", "code").agg(F.sum("n").alias("n"))


def cycle_profile(reads: DataFrame, seq: str, qual: str) -> DataFrame:
    """(cycle, n, a, c, g, t, other, mean, q10 to q90) of each place of the reads: bases, and mean and quantiles of the qualities
    (the least that at least the share in question does not exceed). Null and empty reads count nowhere."""
    found = histograms(reads, seq, qual)
    bases = found.where("kind = 'b'").groupBy("cycle").agg(F.sum("n").alias("n"), *(F.sum(F.when(F.upper(F.char("code")) == x, F.col("n")).otherwise(0)).alias(x.lower()) for x in "ACGT"))
    upto = Window.partitionBy("cycle").orderBy("code")
    quals = found.where("kind = 'q'").withColumns({"upto": F.sum("n").over(upto), "all": F.sum("n").over(Window.partitionBy("cycle")), "phred": F.greatest(F.col("code") - 33, F.lit(0))})
    values = quals.groupBy("cycle").agg((F.sum(F.col("phred") * F.col("n")) / F.sum("n")).alias("mean"), *(F.min(F.when(F.col("upto") >= F.col("all") * p, F.col("phred"))).alias(k) for k, p in QUANTILES.items()))
    rest = F.col("n") - F.col("a") - F.col("c") - F.col("g") - F.col("t")
    return bases.join(values, "cycle", "left").select("cycle", "n", "a", "c", "g", "t", rest.alias("other"), "mean", *QUANTILES)


def duplication_levels(reads: DataFrame, seq: str, prefix: int = 50) -> DataFrame:
    """(level, sequences, reads): how many distinct sequences (their first ``prefix`` bases) have how many copies; level: the least
    number of copies of those counted together. Null and empty reads count nowhere."""
    counts = reads.select(F.substring(seq, 1, prefix).alias("s")).where("s <> ''").groupBy("s").agg(F.count(F.lit(1)).alias("copies"))
    level = F.array_max(F.filter(F.array(*map(F.lit, LEVELS)), lambda x: x <= F.col("copies")))
    return counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("sequences"), F.sum("copies").alias("reads"))


def _shrunk(counts: Counter, counters: int) -> Counter:
    """The largest ``counters`` counts, less the next one."""
    if len(counts) <= counters:
        return counts
    cut = sorted(counts.values(), reverse=True)[counters]
    return Counter({k: n - cut for k, n in counts.items() if n > cut})


def frequent(rows: DataFrame, column: str, counters: int) -> DataFrame:
    """(value, least): candidates for values with over 1 / (``counters`` + 1) of the rows, of which none is missing. Each task
    keeps so many counters (summaries that merge), and least, their sum, is at most rows / (``counters`` + 1) short of the count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for b in batches:
            found = pc.value_counts(b.column(0).drop_null())
            held.update(dict(zip(found.field("values").to_pylist(), found.field("counts").to_pylist(), strict=True)))
            held = _shrunk(held, counters)
        yield pa.RecordBatch.from_arrays([pa.array(list(held.keys()), pa.string()), pa.array(list(held.values()), pa.int64())], ["value", "least"])

    return rows.select(F.col(column).alias("value")).mapInArrow(run, "value string, least long").groupBy("value").agg(F.sum("least").alias("least"))


def overrepresented(reads: DataFrame, seq: str, share: float = 0.001, prefix: int = 50) -> DataFrame:
    """(sequence, n, percent) of sequences (first ``prefix`` bases) with at least ``share`` of the reads. Summaries of twice as many
    counters as there can be such sequences find the candidates, which are then counted exactly."""
    rows = reads.select(F.substring(seq, 1, prefix).alias("s")).where("s <> ''")
    counters = int(2 / share)
    total = rows.count()
    likely = frequent(rows, "s", counters).where(F.col("least") + total / (counters + 1) >= total * share).select(F.col("value").alias("s"))
    exact = rows.join(F.broadcast(likely), "s").groupBy("s").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= total * share)  # at most counters candidates
    return exact.select(F.col("s").alias("sequence"), "n", (100 * F.col("n") / total).alias("percent"))
