"""The decision on each read: trimming, barcode, quality gates, tag and UMI, in one fixed order; and the counters over it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cellquant.functions.seq import has_tag, low_bases, query_name, reverse_complement
from cellquant.functions.trimming import trim_span
from cellquant.operators.barcode import demultiplex


@dataclass(frozen=True)
class ReadLayout:
    """Where things lie, 0-based half-open, and the limits. ``*_low``: a slice with more bases than that under ``*_phred`` is
    dropped."""

    tag: str = "ATTGCGCAATG"
    tag_mismatches: int = 2
    umi: tuple[int, int] = (11, 19)
    cdna_start: int = 22
    i7: tuple[int, int] = (0, 10)
    i5: tuple[int, int] = (0, 10)
    adapters: Sequence[str] = ()
    quality: int = 20
    min_length: int = 20
    bc_low: int = 3
    bc_phred: int = 20
    umi_low: int = 3
    umi_phred: int = 20
    budget: int = 1
    i7_reversed: bool = False
    i5_reversed: bool = False


def _cut(text: Column, span: tuple[int, int]) -> Column:
    return F.substring(text, span[0] + 1, span[1] - span[0])


def _window(seq: Column, span: tuple[int, int], reverse: bool) -> Column:
    """The index window, turned to the panel's orientation; null if the read is too short for it."""
    w = F.when(F.length(seq) >= span[1], _cut(seq, span))
    return reverse_complement(w) if reverse else w


def filter_reads(reads: DataFrame, panel: DataFrame, layout: ReadLayout = ReadLayout()) -> DataFrame:
    """Reads (read_id, r1, r2, i1, i2 as _seq and _qual) with ``outcome``: passed or the first reason to drop, in this order:
    second mate too short, index absent or ambiguous, pair not listed, low barcode, and for tagged reads first mate too
    short and low UMI. Beside it: qname, cell (codes as the panel lists them), corrected, has_tag, umi (empty for internal
    reads), past_barcode (it got past the barcode's gates), and what goes on: r1_cdna, r1_cdna_qual, r2_cdna, r2_cdna_qual."""
    p = layout
    trimmed = reads.withColumn("trim", trim_span(F.col("r2_seq"), F.col("r2_qual"), p.adapters, p.quality))
    windows = trimmed.withColumns({"i1_seq": _window(F.col("i1_seq"), p.i7, p.i7_reversed), "i2_seq": _window(F.col("i2_seq"), p.i5, p.i5_reversed)})
    rows = demultiplex(windows, panel, p.budget)
    barcode = F.col("outcome")
    tagged = has_tag(F.col("r1_seq"), p.tag, p.tag_mismatches)
    outcome = (
        F.when(F.col("trim.end") - F.col("trim.start") < p.min_length, "dropped_short_r2")
        .when(F.col("i1_seq").isNull() | F.col("i2_seq").isNull(), "dropped_no_barcode_absent")
        .when(barcode == "dropped_ambiguous", "dropped_no_barcode_ambiguous")
        .when(barcode == "dropped_absent", "dropped_no_barcode_absent")
        .when(barcode == "dropped_uncorrectable", "dropped_no_barcode_uncorrectable")
        .when(low_bases(F.concat(_cut(F.col("i1_qual"), p.i7), _cut(F.col("i2_qual"), p.i5)), p.bc_phred) > p.bc_low, "dropped_bc_quality")
        .when(F.col("has_tag") & (F.length("r1_seq") < max(p.umi[1], p.cdna_start)), "dropped_short_r2")
        .when(F.col("has_tag") & (low_bases(_cut(F.col("r1_qual"), p.umi), p.umi_phred) > p.umi_low), "dropped_umi_quality")
        .otherwise("passed")
    )
    short_r2 = F.col("trim.end") - F.col("trim.start") < p.min_length
    past = ~short_r2 & F.col("assigned") & (F.col("outcome") != "dropped_bc_quality")
    start = F.when(F.col("has_tag"), p.cdna_start).otherwise(0) + 1
    trim = F.col("trim")
    return (
        rows.withColumns({"corrected": barcode == "corrected", "assigned": barcode.isin("exact", "corrected"), "has_tag": tagged, "cell": F.concat("i7_code", "i5_code"), "qname": query_name(F.col("read_id"))})
        .withColumn("outcome", outcome)
        .withColumn("past_barcode", past)
        .withColumns(
            {
                "umi": F.when(F.col("has_tag"), _cut(F.col("r1_seq"), p.umi)).otherwise(""),
                "r1_cdna": F.substr("r1_seq", start),
                "r1_cdna_qual": F.substr("r1_qual", start),
                "r2_cdna": F.substr("r2_seq", trim.start + 1, trim.end - trim.start),
                "r2_cdna_qual": F.substr("r2_qual", trim.start + 1, trim.end - trim.start),
            }
        )
        .drop("trim", "assigned")
    )


#: counters in the order of the statistics file; orientation and share follow them
METRICS = (
    "total", "passed", "tagged", "internal", "dropped_short_r2", "dropped_no_barcode_absent", "dropped_no_barcode_uncorrectable",
    "dropped_no_barcode_ambiguous", "dropped_bc_quality", "dropped_umi_quality", "bc_exact", "bc_corrected",
)


def filter_counts(filtered: DataFrame) -> DataFrame:
    """One row with a column for each of ``METRICS``. Reads with a barcode count as exact or corrected if they got past its
    quality gate, whatever became of them then."""
    o = F.col("outcome")
    past = F.col("past_barcode")
    counts = {
        "total": F.count(F.lit(1)),
        "passed": F.count_if(o == "passed"),
        "tagged": F.count_if((o == "passed") & F.col("has_tag")),
        "internal": F.count_if((o == "passed") & ~F.col("has_tag")),
        **{m: F.count_if(o == m) for m in METRICS if m.startswith("dropped")},
        "bc_exact": F.count_if(past & ~F.col("corrected")),
        "bc_corrected": F.count_if(past & F.col("corrected")),
    }
    return filtered.agg(*(counts[m].alias(m) for m in METRICS))


def filter_statistics(counts: DataFrame, i7_orient: str = "Forward", i5_orient: str = "Forward") -> DataFrame:
    """(place, metric, value) as text: the counters, both orientations, and the share that passed with four digits."""
    share = F.format_string("%.4f", F.when(F.col("total") > 0, 100.0 * F.col("passed") / F.col("total")).otherwise(0.0))
    values = [*((m, F.col(m).cast("string")) for m in METRICS), ("i7_orient", F.lit(i7_orient)), ("i5_orient", F.lit(i5_orient)), ("passed_pct", share)]
    return counts.select(F.inline(F.array(*(F.struct(F.lit(i).alias("place"), F.lit(m).alias("metric"), v.alias("value")) for i, (m, v) in enumerate(values)))))


def drop_ranking(counts: DataFrame) -> DataFrame:
    """(place, reason, n) of the reasons that dropped reads, most first, ties by name."""
    each = counts.select(F.inline(F.array(*(F.struct(F.lit(m).alias("reason"), F.col(m).alias("n")) for m in METRICS if m.startswith("dropped_"))))).where("n > 0")
    order = Window.orderBy(F.desc("n"), "reason")  # a row for each reason
    return each.withColumn("place", F.row_number().over(order))


def read_table(counts: DataFrame) -> DataFrame:
    """(category, level, n, pct_total, pct_parent): all reads, those that passed and were dropped, and what they consist of."""
    dropped = F.col("total") - F.col("passed")
    rows = [("total", 0, F.col("total"), None), ("passed", 1, F.col("passed"), F.col("total")), ("tagged", 2, F.col("tagged"), F.col("passed")), ("internal", 2, F.col("internal"), F.col("passed")), ("dropped", 1, dropped, F.col("total"))]
    rows += [(m, 2, F.col(m), dropped) for m in METRICS if m.startswith("dropped_")]

    def percent(n: Column, of: Column | None) -> Column:
        return F.lit(None).cast("double") if of is None else F.when(of > 0, 100.0 * n / of)

    each = F.array(*(F.struct(F.lit(c).alias("category"), F.lit(k).alias("level"), n.alias("n"), percent(n, F.col("total")).alias("pct_total"), percent(n, of).alias("pct_parent")) for c, k, n, of in rows))
    return counts.select(F.inline(each)).where((F.col("level") < 2) | (F.col("n") > 0) | ~F.startswith("category", F.lit("dropped_")))


def per_cell_totals(filtered: DataFrame) -> DataFrame:
    """(cell, tagged, internal, total) of the reads that passed."""
    return filtered.where("outcome = 'passed'").groupBy("cell").agg(F.count_if("has_tag").alias("tagged"), F.count_if(~F.col("has_tag")).alias("internal"), F.count(F.lit(1)).alias("total"))
