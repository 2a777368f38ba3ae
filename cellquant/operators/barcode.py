"""Error-tolerant demultiplexing by two index reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _substituted(windows: DataFrame, most: int, upto: Column) -> DataFrame:
    """Windows with up to ``most`` substitutions in their first ``upto`` places."""
    out = windows
    for _ in range(most):
        more = out.select("code", F.explode(F.sequence(F.lit(1), upto)).alias("p"), "window").select("code", "window", "p", F.explode(F.array(*map(F.lit, "ACGT"))).alias("b"))
        changed = more.select("code", F.concat(F.expr("substr(window, 1, p - 1)"), "b", F.expr("substr(window, p + 1)")).alias("window"))
        out = out.unionByName(changed).distinct()
    return out


def index_sphere(codes: DataFrame, budget: int) -> DataFrame:
    """(window, code, is_exact): every window that is read as a code, null where two codes claim it (rejected).

    ``budget`` substitutions without an indel, or one deletion (any base fills the end, which is not substituted) or one
    insertion (the right end falls off) with one substitution fewer. A listed code always stands for itself.
    """
    length = F.length("code")
    exact = codes.select("code", F.col("code").alias("window"))
    base = F.explode(F.array(*map(F.lit, "ACGT"))).alias("b")
    dropped = codes.select("code", F.explode(F.sequence(F.lit(1), length)).alias("p")).select("code", "p", base)
    dropped = dropped.select("code", F.expr("concat(substr(code, 1, p - 1), substr(code, p + 1), b)").alias("window"))
    added = codes.select("code", F.explode(F.sequence(F.lit(0), length)).alias("p")).select("code", "p", base)
    added = added.select("code", F.expr("substr(concat(substr(code, 1, p), b, substr(code, p + 1)), 1, length(code))").alias("window"))
    fewer = max(0, budget - 1)
    near = _substituted(exact, budget, length).unionByName(_substituted(dropped, fewer, length - 1)).unionByName(_substituted(added, fewer, length))
    claimed = near.groupBy("window").agg(F.count_distinct("code").alias("n"), F.min("code").alias("code"), F.max((F.col("window") == F.col("code")).cast("int")).alias("e"), F.max(F.when(F.col("window") == F.col("code"), F.col("code"))).alias("own"))
    return claimed.select("window", F.coalesce("own", F.when(F.col("n") == 1, F.col("code"))).alias("code"), (F.col("e") == 1).alias("is_exact"))


def decode(reads: DataFrame, column: str, sphere: DataFrame, prefix: str) -> DataFrame:
    """Add ``<prefix>_code`` and ``<prefix>_state``: exact, corrected, ambiguous or absent. The sphere of a panel is small;
    Spark broadcasts it by its size."""
    s = sphere.select(F.col("window").alias(column), F.col("code").alias(f"{prefix}_code"), F.col("is_exact"))
    state = F.when(F.col("is_exact"), "exact").when(F.col(f"{prefix}_code").isNotNull(), "corrected").when(F.col("is_exact").isNotNull(), "ambiguous").otherwise("absent")
    return reads.join(s, column, "left").withColumn(f"{prefix}_state", state).drop("is_exact")


def demultiplex(reads: DataFrame, panel: DataFrame, budget: int = 1) -> DataFrame:
    """Reads (i1_seq, i2_seq) with both codes and outcome: an ambiguous index outranks an absent one, then pairs that the
    panel does not list; the rest are exact or corrected."""
    out = reads
    for column, code, prefix in (("i1_seq", "i7_index", "i7"), ("i2_seq", "i5_index", "i5")):
        out = decode(out, column, index_sphere(panel.select(F.col(code).alias("code")).distinct(), budget), prefix)
    pairs = panel.select(F.col("i7_index").alias("i7_code"), F.col("i5_index").alias("i5_code"), F.lit(True).alias("listed")).distinct()
    states = F.array("i7_state", "i5_state")
    outcome = (
        F.when(F.array_contains(states, "ambiguous"), "dropped_ambiguous")
        .when(F.array_contains(states, "absent"), "dropped_absent")
        .when(F.col("listed").isNull(), "dropped_uncorrectable")
        .when(F.array_contains(states, "corrected"), "corrected")
        .otherwise("exact")
    )
    return out.join(pairs, ["i7_code", "i5_code"], "left").withColumn("outcome", outcome).drop("listed")


def outcome_counts(demultiplexed: DataFrame) -> DataFrame:
    return demultiplexed.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))
