"""Scalar functions over sequences, qualities and alignments: Columns in, Columns out, all inside the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

PHRED = 33


def reverse_complement(seq: Column) -> Column:
    """Reverse complement; anything but A, C, G, T becomes N."""
    return F.reverse(F.translate(F.regexp_replace(seq, "[^ACGT]", "N"), "ACGT", "TGCA"))


def query_name(read_id: Column) -> Column:
    """First token of a read id, without a trailing ``/x``."""
    return F.regexp_replace(F.regexp_extract(read_id, r"^([^ \t]*)", 1), r"/.$", "")


def qualities(qual: Column) -> Column:
    """Phred scores of a quality string, never below 0."""
    return F.transform(F.filter(F.split(qual, ""), lambda c: c != ""), lambda c: F.greatest(F.ascii(c) - PHRED, F.lit(0)))


def low_bases(qual: Column, phred: int) -> Column:
    """How many bases have a quality under ``phred``."""
    low = rf"[\x00-\x{{{PHRED - 1 + phred:x}}}]" if phred > 0 else r"(?!)"
    return F.length(qual) - F.length(F.regexp_replace(qual, low, ""))


def mismatches(a: Column, b: Column) -> Column:
    """Differing places of two strings; a missing place counts."""
    return F.aggregate(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: (~x.eqNullSafe(y)).cast("int")), F.lit(0), lambda s, x: s + x)


def has_tag(seq: Column, tag: str, most: int) -> Column:
    """Whether ``seq`` starts with ``tag`` up to ``most`` mismatches."""
    wrong = reduce(lambda n, x: n + x, [(F.substring(seq, i + 1, 1) != base).cast("int") for i, base in enumerate(tag)], F.lit(0))
    return (F.length(seq) >= len(tag)) & (wrong <= most)


def quality_window(qual: Column, quality: int, width: int = 4) -> Column:
    """(start, end), 0-based half-open, after trimming low ends and then cutting at the start of the first window of
    ``width`` bases whose mean is under ``quality``. Nothing left: (0, 0)."""
    q = qualities(qual)
    good = F.filter(F.transform(q, lambda x, i: F.when(x >= quality, i)), lambda i: i.isNotNull())
    start, end = F.coalesce(F.array_min(good), F.lit(0)), F.coalesce(F.array_max(good) + 1, F.lit(0))
    places = F.when(end - start >= width, F.sequence(start, end - width)).otherwise(F.array().cast("array<int>"))
    bad = F.filter(places, lambda i: F.aggregate(F.slice(q, i + 1, F.lit(width)), F.lit(0), lambda a, x: a + x) < width * quality)
    return F.struct(start.alias("start"), F.coalesce(F.array_min(bad), end).alias("end"))


def clip_adapter(seq: Column, adapter: str, least: int = 5, rate: float = 0.1) -> Column:
    """Length that is left of ``seq``: up to the leftmost place where it and the adapter overlap by ``least`` bases or
    more with mismatches of at most ``rate`` of the overlap."""
    n, m = F.length(seq), len(adapter)
    places = F.when(n >= least, F.sequence(F.lit(0), n - least)).otherwise(F.array().cast("array<int>"))

    def fits(i: Column) -> Column:
        overlap = F.least(F.lit(m), n - i)
        wrong = mismatches(F.substr(seq, i + 1, overlap), F.substr(F.lit(adapter), F.lit(1), overlap))
        return wrong * F.lit(round(1 / rate)) <= overlap

    return F.coalesce(F.array_min(F.filter(places, fits)), n)


def aligned_blocks(pos: Column, cigar: Column) -> Column:
    """array<struct<start, end>>, 1-based inclusive, of the reference that M, = and X cover; D and N move on."""
    op = r"(\d+)([MIDNSHP=X])"
    steps = F.arrays_zip(F.regexp_extract_all(cigar, F.lit(op), F.lit(1)).alias("n"), F.regexp_extract_all(cigar, F.lit(op), F.lit(2)).alias("op"))
    empty = F.array().cast("array<struct<start:bigint,end:bigint>>")
    first = F.struct(pos.cast("long").alias("at"), empty.alias("blocks"))

    def step(state: Column, s: Column) -> Column:
        n = s["n"].cast("long")
        covers = s["op"].isin("M", "=", "X")
        block = F.array(F.struct(state["at"].alias("start"), (state["at"] + n - 1).alias("end")))
        return F.struct(
            F.when(covers | s["op"].isin("D", "N"), state["at"] + n).otherwise(state["at"]).alias("at"),
            F.when(covers, F.concat(state["blocks"], block)).otherwise(state["blocks"]).alias("blocks"),
        )

    return F.aggregate(steps, first, step, lambda s: s["blocks"])


def aligned_bases(pos: Column, cigar: Column) -> Column:
    """How many bases of the reference the blocks of ``aligned_blocks`` cover."""
    return F.aggregate(aligned_blocks(pos, cigar), F.lit(0).cast("long"), lambda n, b: n + b["end"] - b["start"] + 1)
