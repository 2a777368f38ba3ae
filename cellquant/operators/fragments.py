"""From alignments to assigned fragments."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cellquant.functions.seq import aligned_blocks
from cellquant.operators.intervals import overlap_join


def blocks(alignments: DataFrame) -> DataFrame:
    """(rid, chrom, start_pos, end_pos) of the aligned blocks."""
    return alignments.select("rid", "chrom", F.explode(aligned_blocks(F.col("pos"), F.col("cigar"))).alias("b")).select("rid", "chrom", F.col("b.start").alias("start_pos"), F.col("b.end").alias("end_pos"))


def gene_overlaps(block_rows: DataFrame, exons: DataFrame) -> DataFrame:
    """(rid, gene_id, strand, olen): bases of a fragment's blocks on a gene's intervals; additional, if exons tell it of genes
    that were added to the annotation."""
    keys = [c for c in ("rid", "gene_id", "strand", "additional") if c in (*exons.columns, "rid")]
    return overlap_join(block_rows, exons).groupBy(*keys).agg(F.sum("olen").alias("olen"))


def mapped_length(block_rows: DataFrame) -> DataFrame:
    return block_rows.groupBy("rid").agg(F.sum(F.col("end_pos") - F.col("start_pos") + 1).alias("mapped"))


def resolve(fragments: DataFrame, overlaps: DataFrame, *, stranded: bool = True, multi_overlap: bool = False, fraction: float = 0.0) -> DataFrame:
    """(rid, genes, ambiguous, user) of fragments (rid, tagged, frag_strand, is_multi, mapped) that reach a gene; user: all of
    the genes are additional.

    Only tagged fragments are held to their strand, and only if ``stranded``. A multimapper takes all its compatible genes.
    Others take the gene of largest overlap, if it is ``fraction`` of the mapped bases; ties are ambiguous unless
    ``multi_overlap``.
    """
    rows = fragments.join(overlaps, "rid")
    if stranded:
        rows = rows.where(~F.col("tagged") | (F.col("strand") == F.col("frag_strand")))
    enough = F.col("is_multi") | (F.when(F.col("mapped") > 0, F.col("olen") / F.col("mapped")).otherwise(1.0) >= fraction)  # the product would round otherwise
    rows = rows.where(enough & (F.col("olen") >= 1))
    best = F.max("olen").over(Window.partitionBy("rid"))
    won = rows.withColumn("best", best).where(F.col("is_multi") | (F.col("olen") == F.col("best")))
    user = F.min("additional") if "additional" in overlaps.columns else F.lit(False)
    sets = won.groupBy("rid", "is_multi").agg(F.array_sort(F.collect_set("gene_id")).alias("genes"), user.alias("user"))
    tie = ~F.col("is_multi") & (F.size("genes") > 1) & F.lit(not multi_overlap)
    return sets.select("rid", F.when(~tie, F.col("genes")).alias("genes"), tie.alias("ambiguous"), "user")


def assign(fragments: DataFrame, exon: DataFrame, intron: DataFrame) -> DataFrame:
    """Fragments with ge and gi (gene arrays or null), user and category, from what ``resolve`` gave for exons and introns."""
    e = exon.select("rid", F.col("genes").alias("ge"), F.col("ambiguous").alias("ge_tie"), "user")
    i = intron.select("rid", F.col("genes").alias("gi"), F.col("ambiguous").alias("gi_tie"))
    return fragments.join(e, "rid", "left").join(i, "rid", "left").withColumn("category", _category()).withColumn("user", F.coalesce("user", F.lit(False))).drop("ge_tie", "gi_tie")


def assign_once(fragments: DataFrame, block_rows: DataFrame, exons: DataFrame, introns: DataFrame | None = None, *, stranded: bool = True, multi_overlap: bool = False, fraction: float = 0.0) -> DataFrame:
    """What ``assign`` gives of ``resolve`` for exons and introns, in one pass: blocks meet both kinds of intervals in one join,
    and all else goes by rid, over which pairs and fragments are dealt once. Exons and introns are stored tables."""
    kinds = [("e", exons)] + ([("i", introns)] if introns is not None else [])
    features = reduce(DataFrame.unionByName, [x.select("gene_id", "chrom", "strand", "start_pos", "end_pos", (F.col("additional") if "additional" in x.columns else F.lit(False)).alias("additional"), F.lit(k).alias("kind")) for k, x in kinds])
    pairs = overlap_join(block_rows, features).select("rid", "kind", "gene_id", "strand", "additional", "olen").repartition("rid")
    over = pairs.groupBy("rid", "kind", "gene_id", "strand", "additional").agg(F.sum("olen").alias("olen"))
    rows = fragments.join(over, "rid", "left")
    share = F.when(F.col("mapped") > 0, F.col("olen") / F.col("mapped")).otherwise(1.0)
    ok = (F.col("olen") >= 1) & (F.col("is_multi") | (share >= fraction))
    if stranded:
        ok &= ~F.col("tagged") | (F.col("strand") == F.col("frag_strand"))
    rows = rows.withColumn("ok", ok)
    best = F.max(F.when(F.col("ok"), F.col("olen"))).over(Window.partitionBy("rid", "kind"))
    rows = rows.withColumn("best", best).withColumn("won", F.col("ok") & (F.col("is_multi") | (F.col("olen") == F.col("best"))))
    of = {k: F.col("won") & (F.col("kind") == k) for k in "ei"}
    sets = rows.groupBy("rid").agg(F.first(F.struct(*fragments.columns)).alias("f"), *(F.array_sort(F.collect_set(F.when(c, F.col("gene_id")))).alias(k) for k, c in of.items()), F.min(F.when(of["e"], F.col("additional"))).alias("user"))
    tie = {k: ~F.col("f.is_multi") & (F.size(k) > 1) & F.lit(not multi_overlap) for k in "ei"}
    genes = {k: F.when((F.size(k) > 0) & ~tie[k], F.col(k)) for k in "ei"}
    out = sets.select("f.*", genes["e"].alias("ge"), genes["i"].alias("gi"), tie["e"].alias("ge_tie"), tie["i"].alias("gi_tie"), F.coalesce("user", F.lit(False)).alias("user"))
    return out.withColumn("category", _category()).drop("ge_tie", "gi_tie")


def _category() -> Column:
    taken = F.col("ge").isNotNull()
    return F.when(taken & F.col("user"), "User").when(taken, "Exon").when(F.col("ge_tie"), "Ambiguity").when(F.col("gi").isNotNull(), "Intron").when(F.col("gi_tie"), "Ambiguity").otherwise("Intergenic")


def layers(assigned: DataFrame) -> DataFrame:
    """A row for each layer that counts the fragment: exon, intron (only without exon genes), inex (exon, else intron)."""
    each = F.array(*(F.struct(F.lit(n).alias("layer"), c.alias("genes")) for n, c in (("exon", F.col("ge")), ("intron", F.when(F.col("ge").isNull(), F.col("gi"))), ("inex", F.coalesce("ge", "gi")))))
    return assigned.select("*", F.inline(each)).where("genes is not null")


def category_counts(assigned: DataFrame) -> DataFrame:
    """One row per cell: how many fragments of each category."""
    names = ("Exon", "Intron", "Ambiguity", "Intergenic", "User")
    return assigned.groupBy("bc").agg(*(F.count_if(F.col("category") == n).alias(n.lower()) for n in names), F.count(F.lit(1)).alias("mapped"))
