"""Intervals on contigs, 1-based and closed: merging, gaps, single-gene regions, introns and overlap joins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cellquant.storage import stored


#: bases of a range in which a contig is scanned; what passes over its edges is carried by one row a range
RANGE = 1 << 20


def merge(intervals: DataFrame, *keys: str) -> DataFrame:
    """Overlapping or adjacent intervals of a key joined: gaps and islands. A key, as a gene, is one group; for whole contigs
    there is ``merge_contigs``."""
    order = Window.partitionBy(*keys).orderBy("start_pos", "end_pos")
    before = F.max("end_pos").over(order.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum(F.when(F.col("start_pos") <= before + 1, 0).otherwise(1)).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return intervals.withColumn("island", island).groupBy(*keys, "island").agg(F.min("start_pos").alias("start_pos"), F.max("end_pos").alias("end_pos")).drop("island")


def _carried(rows: DataFrame, by: str, sums: dict[str, tuple[Column, Callable]], *, ahead: bool = False) -> DataFrame:
    """``rows`` (with ``by`` and block) and, of the blocks before theirs (``ahead``: behind it), the ``sums`` over them. The pass
    over blocks has one row a block."""
    whole = Window.partitionBy(by).orderBy(F.desc("block") if ahead else "block").rowsBetween(Window.unboundedPreceding, -1)
    inside = rows.groupBy(by, "block").agg(*(c.alias(n) for n, (c, _) in sums.items()))
    over = inside.select(by, "block", *(f(n).over(whole).alias(n) for n, (_, f) in sums.items()))
    return rows.join(over, [by, "block"])


def merge_contigs(intervals: DataFrame, width: int | None = None) -> DataFrame:
    """(chrom, start_pos, end_pos): overlapping or adjacent intervals of a contig joined, scanned in ranges of ``width`` bases
    (``RANGE``) side by side. A range takes over the farthest end of those before it and, where no island begins in it up to
    a place, the island that began last."""
    width = width or RANGE
    rows = intervals.select("chrom", "start_pos", "end_pos", F.floor(F.col("start_pos") / width).alias("block"))
    local = Window.partitionBy("chrom", "block").orderBy("start_pos", "end_pos")
    met = _carried(rows, "chrom", {"far": (F.max("end_pos"), F.max)})
    before = F.greatest(F.max("end_pos").over(local.rowsBetween(Window.unboundedPreceding, -1)), F.col("far"))
    begun = met.withColumn("begun", F.when(F.col("start_pos") > F.coalesce(before + 1, F.lit(-1)), F.col("start_pos")))
    last = _carried(begun.drop("far"), "chrom", {"open": (F.max("begun"), F.max)})
    # of equal intervals, the one that begins the island comes first: the join may have changed their order
    first = Window.partitionBy("chrom", "block").orderBy("start_pos", "end_pos", F.asc_nulls_last("begun"))
    island = F.coalesce(F.max("begun").over(first.rowsBetween(Window.unboundedPreceding, 0)), F.col("open"))
    return last.withColumn("island", island).groupBy("chrom", "island").agg(F.min("start_pos").alias("start_pos"), F.max("end_pos").alias("end_pos")).drop("island")


def _next(place: str) -> Column:
    """The next ``place`` of the contig, of rows that carry ahead, the least place of the ranges behind theirs."""
    return F.coalesce(F.lead(place).over(Window.partitionBy("chrom", "block").orderBy(place)), F.col("ahead"))


def gaps(merged: DataFrame, width: int | None = None) -> DataFrame:
    """(chrom, start_pos, end_pos) of what lies between consecutive merged intervals of a contig, scanned in ranges."""
    width = width or RANGE
    rows = _carried(merged.select("chrom", "start_pos", "end_pos", F.floor(F.col("start_pos") / width).alias("block")), "chrom", {"ahead": (F.min("start_pos"), F.min)}, ahead=True)
    return rows.select("chrom", (F.col("end_pos") + 1).alias("start_pos"), (_next("start_pos") - 1).alias("end_pos")).where(F.col("end_pos") >= F.col("start_pos"))


def single_gene_regions(spans: DataFrame, width: int | None = None) -> DataFrame:
    """(chrom, gene_id, start_pos, end_pos) covered by the span of exactly one gene: a sweep over starts and ends, in ranges of
    ``width`` bases (``RANGE``) side by side, which take over the depth of those before them."""
    width = width or RANGE
    sign = spans.withColumn("g", F.xxhash64("gene_id").cast("decimal(38,0)"))
    events = sign.select("chrom", F.col("start_pos").alias("p"), F.lit(1).alias("d"), "g").unionByName(sign.select("chrom", (F.col("end_pos") + 1).alias("p"), F.lit(-1).alias("d"), (-F.col("g")).alias("g")))
    at = events.groupBy("chrom", "p").agg(F.sum("d").alias("d"), F.sum("g").cast("decimal(38,0)").alias("g")).withColumn("block", F.floor(F.col("p") / width))
    rows = _carried(at, "chrom", {"d0": (F.sum("d"), F.sum), "g0": (F.sum("g").cast("decimal(38,0)"), F.sum)})
    rows = _carried(rows, "chrom", {"ahead": (F.min("p"), F.min)}, ahead=True)
    upto = Window.partitionBy("chrom", "block").orderBy("p").rowsBetween(Window.unboundedPreceding, 0)
    depth = F.sum("d").over(upto) + F.coalesce("d0", F.lit(0))
    open_ = (F.sum("g").over(upto) + F.coalesce("g0", F.lit(0))).cast("decimal(38,0)")
    swept = rows.select("chrom", F.col("p").alias("start_pos"), (_next("p") - 1).alias("end_pos"), depth.alias("depth"), open_.alias("g"))
    only = swept.where("depth = 1").join(sign.select("chrom", "g", "gene_id").distinct(), ["chrom", "g"])
    return merge(only.select("chrom", "gene_id", "start_pos", "end_pos"), "chrom", "gene_id")


def introns(exons: DataFrame, least: int = 10, most: int = 100_000) -> DataFrame:
    """Gaps of a contig's exon union (both strands) inside the region of one gene, wider than ``least`` and narrower than
    ``most``."""
    between = gaps(merge_contigs(exons))
    spans = exons.groupBy("chrom", "gene_id").agg(F.min("start_pos").alias("start_pos"), F.max("end_pos").alias("end_pos"))
    regions = stored(single_gene_regions(spans), "single-gene-regions")  # its size is asked for before it is joined
    held = overlap_join(between.withColumn("gap", F.monotonically_increasing_id()), regions)
    inside = (F.col("a_start") >= F.col("b_start")) & (F.col("a_end") <= F.col("b_end"))
    width = F.col("a_end") - F.col("a_start") + 1
    return held.where(inside & (width > least) & (width < most)).select("chrom", "gene_id", F.col("a_start").alias("start_pos"), F.col("a_end").alias("end_pos"))


#: intervals of an annotation that are broadcast, and rows of a key beyond which they are dealt to several tasks; a gene's many
#: reads then never meet in one task
BROADCAST_ROWS, HOT_ROWS = 1_000_000, 1_000_000


def annotated(rows: DataFrame, annotation: DataFrame, keys: list[str]) -> DataFrame:
    """Join with an annotation on ``keys``: up to ``BROADCAST_ROWS`` of it are broadcast; beyond, rows and annotation meet by key,
    and only a key of more than ``HOT_ROWS`` rows is dealt to a task for each so many, each with that key's annotation."""
    if annotation.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(annotation), keys)
    parts = F.ceil(F.count(F.lit(1)) / HOT_ROWS).cast("int")
    hot = stored(rows.groupBy(*keys).agg(parts.alias("salts")).where("salts > 1"), "hot-keys")  # a row for each HOT_ROWS rows at most
    if hot.isEmpty():
        return rows.join(annotation, keys)
    salts, hot = F.coalesce("salts", F.lit(1)), F.broadcast(hot)
    salted = annotation.join(hot, keys, "left").withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("salts")
    dealt = rows.join(hot, keys, "left").withColumn("salt", F.pmod(F.xxhash64(*rows.columns), salts).cast("int")).drop("salts")
    return dealt.join(salted, [*keys, "salt"]).drop("salt")


def overlap_join(a: DataFrame, b: DataFrame, bin_width: int = 4096) -> DataFrame:
    """Pairs of intervals of one contig that share a base, with ``olen``; a's and b's ends become a_start, a_end, b_start
    and b_end; b is the annotation. Both sides are dealt to fixed bins and joined by (chrom, bin); a pair counts in the
    first bin it shares, so none comes twice, and no contig is ever joined whole."""

    def dealt(df: DataFrame, side: str) -> DataFrame:
        df = df.withColumnsRenamed({"start_pos": f"{side}_start", "end_pos": f"{side}_end"})
        lo, hi = (F.floor(F.col(f"{side}_{e}") / bin_width) for e in ("start", "end"))
        return df.withColumns({f"{side}_first": lo, "bin": F.explode(F.sequence(lo, hi))})

    pairs = annotated(dealt(a, "a"), dealt(b, "b"), ["chrom", "bin"])
    shared = (F.col("bin") == F.greatest("a_first", "b_first")) & (F.col("a_start") <= F.col("b_end")) & (F.col("b_start") <= F.col("a_end"))
    olen = F.least("a_end", "b_end") - F.greatest("a_start", "b_start") + 1
    return pairs.where(shared).withColumn("olen", olen).drop("bin", "a_first", "b_first")
