"""Demultiplexing of reads as they arrive: stream-static joins and running counts."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cellquant.operators.barcode import demultiplex, outcome_counts


def stream_outcomes(reads: DataFrame, panel: DataFrame, budget: int = 1) -> DataFrame:
    """Running counts of outcomes; ``reads`` may be a streaming DataFrame, the panel is static."""
    return outcome_counts(demultiplex(reads, panel, budget))
