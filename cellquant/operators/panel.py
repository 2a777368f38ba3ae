"""Guards on an index panel: distances between its codes, what they allow, and which way its reads run. A panel has at most a
few thousand codes, so pairs of them are few."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellquant.functions.seq import reverse_complement

MIN_VOTES, DOMINANCE, SAMPLE = 200, 0.90, 50_000


def open_end_distance(a: Column, b: Column) -> Column:
    """Edit distance of two codes whose right ends cost nothing: the least over all left parts of either one."""
    cut_a = F.transform(F.sequence(F.lit(0), F.length(a)), lambda i: F.levenshtein(F.substr(a, F.lit(1), i), b))
    cut_b = F.transform(F.sequence(F.lit(0), F.length(b)), lambda i: F.levenshtein(a, F.substr(b, F.lit(1), i)))
    return F.least(F.array_min(cut_a), F.array_min(cut_b))


def code_distances(codes: DataFrame) -> DataFrame:
    """(a, b, d) of every two codes (column code), the lesser first."""
    left, right = codes.select(F.col("code").alias("a")), codes.select(F.col("code").alias("b"))
    return left.join(right, F.col("a") < F.col("b")).select("a", "b", open_end_distance(F.col("a"), F.col("b")).alias("d"))


def panel_report(codes: DataFrame, budget: int) -> DataFrame:
    """One row: codes, min_distance and safe_radius (null for a single code), and collisions (pairs within twice the budget)."""
    found = code_distances(codes).agg(F.min("d").alias("min_distance"), F.count_if(F.col("d") <= 2 * budget).alias("collisions"))
    return codes.agg(F.count(F.lit(1)).alias("codes")).join(found).select("codes", "min_distance", F.floor((F.col("min_distance") - 1) / 2).cast("int").alias("safe_radius"), "collisions")


def check_codes(codes: list[str]) -> None:
    """Refuse an empty list, unequal lengths, other letters than ACGT and repeated codes."""
    if not codes:
        raise ValueError("empty index list")
    for c in codes:
        if len(c) != len(codes[0]):
            raise ValueError(f"non-uniform index length: {c} has {len(c)} bases, expected {len(codes[0])}")
        if not c or set(c) - set("ACGT"):
            raise ValueError(f"non-ACGT index: {c}")
    if len(set(codes)) < len(codes):
        raise ValueError("duplicate index")


def radius_warning(name: str, report: DataFrame, budget: int) -> str | None:
    """What to tell the user if the budget is wider than the panel's distances allow; None if it is not."""
    r = report.first()
    if r["safe_radius"] is None or budget <= r["safe_radius"]:
        return None
    return f"{name} panel: least distance {r['min_distance']}, so a budget of {budget} exceeds the safe radius {r['safe_radius']}; windows near two of the {r['collisions']} close pairs are rejected"


@dataclass(frozen=True)
class Votes:
    forward: int
    reverse: int
    both: int
    neither: int


def orientation_votes(reads: DataFrame, column: str, codes: DataFrame) -> DataFrame:
    """One row: windows that are codes as they are, only when reversed, both ways, or neither."""
    rows = reads.select(F.col(column).alias("w"), reverse_complement(F.col(column)).alias("rc"))
    f = codes.select(F.col("code").alias("w"), F.lit(True).alias("fwd")).distinct()
    r = codes.select(F.col("code").alias("rc"), F.lit(True).alias("rev")).distinct()
    both = rows.join(f, "w", "left").join(r, "rc", "left")
    fwd, rev = F.col("fwd").isNotNull(), F.col("rev").isNotNull()
    return both.agg(F.count_if(fwd & ~rev).alias("forward"), F.count_if(rev & ~fwd).alias("reverse"), F.count_if(fwd & rev).alias("both"), F.count_if(~fwd & ~rev).alias("neither"))


def first_windows(reads: DataFrame, column: str, order: str, most: int = SAMPLE) -> DataFrame:
    """The first ``most`` windows in the order of the reads."""
    return reads.where(F.col(column).isNotNull()).orderBy(order).limit(most)


def resolve_orientation(votes: Votes, name: str) -> bool:
    """Whether windows are to be reversed. Votes both ways count for neither. Too few others, or neither way dominant, is an
    error."""
    told = votes.forward + votes.reverse
    if told < MIN_VOTES:
        raise ValueError(f"low-confidence orientation for {name}: {told} discriminating reads; wrong index table or read files?")
    if max(votes.forward, votes.reverse) / told < DOMINANCE:
        raise ValueError(f"mixed orientation for {name}: {votes.forward} forward, {votes.reverse} reverse")
    return votes.reverse > votes.forward


def detect_orientation(reads: DataFrame, column: str, codes: DataFrame, order: str, name: str) -> bool:
    """As ``resolve_orientation``, from the first windows of the reads."""
    return resolve_orientation(Votes(**orientation_votes(first_windows(reads, column, order), column, codes).first().asDict()), name)
