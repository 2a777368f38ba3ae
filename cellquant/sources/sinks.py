"""Outputs: alignment and read text, count tables, matrices, statistics, the report page. What a folder held before is
replaced."""

from __future__ import annotations

import html

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellquant.operators.order import numbered
from cellquant.sources.bam import header, write_bam


def plain_number(value: Column) -> Column:
    """A double as text without exponent: ``3``, ``0.5``, ``0.00001``."""
    text = value.cast("string")
    wide = F.regexp_replace(F.regexp_replace(value.cast("decimal(38,18)").cast("string"), r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")
    return F.when(F.contains(text, F.lit("E")), wide).otherwise(F.regexp_replace(text, r"\.0$", ""))


def write_tsv(rows: DataFrame, path: str, *order: str | Column, compression: str = "none") -> None:
    """Tab-separated text with a header in each part; parts in order hold the rows in order. Doubles have no exponent."""
    cols = [plain_number(F.col(f"`{f.name}`")).alias(f.name) if f.dataType.simpleString() == "double" else F.col(f"`{f.name}`") for f in rows.schema]
    ordered = rows.orderBy(*order) if order else rows
    ordered.select(*cols).write.mode("overwrite").csv(path, sep="\t", header=True, compression=compression)


def write_counts(counts: DataFrame, path: str) -> None:
    """(quant, feature, level, gene, cell, value) as compressed text, blocks one after the other, each by gene and cell."""
    names = ["quant", "feature", "level", "gene", "cell"]
    write_tsv(counts.select(*names, "value"), path, *names, compression="gzip")


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", header=True, schema="quant string, feature string, level string, gene string, cell string, value double")


def write_matrices(counts: DataFrame, path: str) -> None:
    """A folder for each quant, feature and level, so that a reader of one matrix opens only its files."""
    names = ["quant", "feature", "level"]
    counts.repartition(*names, F.pmod(F.xxhash64("gene"), F.lit(16))).sortWithinPartitions(*names, "gene", "cell").write.mode("overwrite").partitionBy(*names).parquet(path)


def read_matrix(spark: SparkSession, path: str, quant: str, feature: str, level: str = "all") -> DataFrame:
    """(gene, cell, value) of one matrix."""
    return spark.read.parquet(path).where((F.col("quant") == quant) & (F.col("feature") == feature) & (F.col("level") == level)).select("gene", "cell", "value")


def dense(matrix: DataFrame, cells: list[str]) -> DataFrame:
    """A row for each gene with a column for each of the cells given, 0 where there is no value."""
    return matrix.groupBy("gene").pivot("cell", cells).agg(F.sum("value")).fillna(0.0)


def write_matrix_market(counts: DataFrame, path: str) -> None:
    """Counts (gene, bc, value) as a sparse matrix: folders genes and cells (names in order) and matrix, whose parts, laid
    end to end, are one list or coordinate file each. Names and triplets are range-sorted."""
    spark = counts.sparkSession
    tables = {}
    for folder, column in (("genes", "gene"), ("cells", "bc")):
        names = numbered(counts.select(column).distinct(), [column], "at").select(column, (F.col("at") + 1).alias(f"{column}_at"))
        names.orderBy(f"{column}_at").select(column).write.mode("overwrite").text(f"{path}/{folder}")
        tables[column] = names
    rows, genes, cells = counts.count(), tables["gene"].count(), tables["bc"].count()
    head = spark.createDataFrame([(0, 0, f"%%MatrixMarket matrix coordinate real general\n{genes} {cells} {rows}")], "gene_at long, bc_at long, value string")
    body = counts.join(tables["gene"], "gene").join(tables["bc"], "bc").select("gene_at", "bc_at", F.concat_ws(" ", "gene_at", "bc_at", plain_number(F.col("value").cast("double"))).alias("value"))
    head.unionByName(body).orderBy("bc_at", "gene_at").select("value").write.mode("overwrite").text(f"{path}/matrix")


BLOCK_CELLS = 64
_MATRIX = ["quant", "feature", "level"]


def write_blocks(counts: DataFrame, path: str, cells: int = BLOCK_CELLS) -> None:
    """Counts (quant, feature, level, gene, cell, value) as column-compressed blocks: folders genes (gene, gene_at) and cells (cell,
    cell_at), both in order, and blocks, by matrix, of ``cells`` consecutive cells each: the cells it has values of, pointers
    to where each one's begin, and numbers of genes and values. No block is larger than its cells by all genes."""
    names = {}
    for column in ("gene", "cell"):
        names[column] = numbered(counts.select(column).distinct(), [column], f"{column}_at")
        names[column].write.mode("overwrite").parquet(f"{path}/{column}s")
    rows = counts.join(names["gene"], "gene").join(names["cell"], "cell").withColumn("block", F.floor(F.col("cell_at") / cells))
    counts.sparkSession.createDataFrame([(cells,)], "block_cells long").write.mode("overwrite").parquet(f"{path}/shape")

    def packed(group: pa.Table) -> pa.Table:
        group = group.sort_by([("cell_at", "ascending"), ("gene_at", "ascending")])
        at = group["cell_at"].to_numpy()
        begin = np.flatnonzero(np.diff(at, prepend=-1))
        row = {k: group[k][0].as_py() for k in (*_MATRIX, "block")}
        row |= {"cells": group["cell"].take(pa.array(begin)).to_pylist(), "pointers": [*begin.tolist(), len(at)], "genes": group["gene_at"].to_pylist(), "values": group["value"].to_pylist()}
        return pa.Table.from_pylist([row], kinds)

    kinds = pa.schema([*((k, pa.string()) for k in _MATRIX), ("block", pa.int64()), ("cells", pa.list_(pa.string())), ("pointers", pa.list_(pa.int32())), ("genes", pa.list_(pa.int64())), ("values", pa.list_(pa.float64()))])
    made = rows.select(*_MATRIX, "block", "cell", "cell_at", "gene_at", "value").groupBy(*_MATRIX, "block").applyInArrow(packed, "quant string, feature string, level string, block long, cells array<string>, pointers array<int>, genes array<long>, values array<double>")
    made.write.mode("overwrite").partitionBy(*_MATRIX).parquet(f"{path}/blocks")


def read_blocks(spark: SparkSession, path: str, quant: str, feature: str, level: str = "all", cells: tuple[str, str] | None = None) -> DataFrame:
    """(gene, cell, value) of one matrix, of the cells from the first to the second name if given: only blocks that hold some of
    them are opened, and nothing is pivoted."""
    blocks = spark.read.parquet(f"{path}/blocks").where((F.col("quant") == quant) & (F.col("feature") == feature) & (F.col("level") == level))
    wanted = F.lit(True)
    if cells is not None:
        ends = spark.read.parquet(f"{path}/cells").where(F.col("cell").between(*cells)).agg(F.min("cell_at"), F.max("cell_at")).first()
        size = spark.read.parquet(f"{path}/shape").first()["block_cells"]
        blocks = blocks.where(F.col("block").between(ends[0] // size, ends[1] // size)) if ends[0] is not None else blocks.limit(0)
        wanted = F.col("cell").between(*cells)
    each = F.transform("cells", lambda c, i: F.struct(c.alias("cell"), F.arrays_zip(*(F.slice(x, F.get("pointers", i) + 1, F.get("pointers", i + 1) - F.get("pointers", i)).alias(x) for x in ("genes", "values"))).alias("held")))
    held = blocks.select(F.inline(each)).where(wanted).select("cell", F.inline("held"))
    genes = spark.read.parquet(f"{path}/genes")
    return held.join(genes, F.col("genes") == F.col("gene_at")).select("gene", "cell", F.col("values").alias("value"))


def write_filtered(filtered: DataFrame, path: str, shards: int) -> None:
    """The reads that passed, dealt evenly to ``shards`` files."""
    names = ["qname", "cell", "umi", "r1_cdna", "r1_cdna_qual", "r2_cdna", "r2_cdna_qual"]
    filtered.where("outcome = 'passed'").select(*names).repartition(shards).write.mode("overwrite").parquet(path)


def write_unaligned(passed: DataFrame, path: str) -> None:
    """Pairs as SAM text: two unmapped lines a read, flags 77 and 141, with BC and UB."""
    header = passed.sparkSession.createDataFrame([(0, "@HD\tVN:1.6\tSO:unsorted")], "n int, value string")

    def line(flag: int, seq: str) -> Column:
        return F.concat_ws("\t", "qname", F.lit(flag), F.lit("*\t0\t0\t*\t*\t0\t0"), seq, f"{seq}_qual", F.concat(F.lit("BC:Z:"), "cell"), F.concat(F.lit("UB:Z:"), "umi"))

    both = passed.select(F.concat_ws("\n", line(77, "r1_cdna"), line(141, "r2_cdna")).alias("value"))
    header.coalesce(1).select("value").unionByName(both).write.mode("overwrite").text(path)


def write_unaligned_bam(passed: DataFrame, path: str) -> None:
    """The same pairs as BAM files."""

    def mate(flag: int, side: str) -> Column:
        tags = F.create_map(F.lit("BC"), F.concat(F.lit("Z:"), "cell"), F.lit("UB"), F.concat(F.lit("Z:"), "umi"))
        return F.struct("qname", F.lit(flag).alias("flag"), F.lit("*").alias("rname"), F.lit(0).cast("long").alias("pos"), F.col(f"{side}_cdna").alias("seq"), F.col(f"{side}_cdna_qual").alias("qual"), tags.alias("tags"))

    write_bam(passed.select(F.inline(F.array(mate(77, "r1"), mate(141, "r2")))), path, header([]))


def write_fastq(sample: DataFrame, path: str, seq: str, qual: str) -> None:
    sample.select(F.concat(F.lit("@"), "qname", F.lit("\n"), seq, F.lit("\n+\n"), qual).alias("value")).write.mode("overwrite").text(path, compression="gzip")


def write_gtf(annotation: DataFrame, path: str) -> None:
    """Exon lines in order; additional genes have the source User."""
    attributes = F.concat(F.lit('gene_id "'), "gene_id", F.lit('"; gene_name "'), F.coalesce("gene_name", "gene_id"), F.lit('";'))
    source = F.when(F.col("additional"), "User").otherwise("annotation")
    line = F.concat_ws("\t", "chrom", source, F.lit("exon"), "start_pos", "end_pos", F.lit("."), "strand", F.lit("."), attributes)
    annotation.orderBy("line").select(line.alias("value")).write.mode("overwrite").text(path)


def report_page(title: str, tables: dict[str, DataFrame], rows: int = 1000) -> str:
    """One page with a table for each aggregate. Of a table of more than ``rows`` rows the first ones are shown, and a line says
    how many are left out."""
    parts = [f"<!doctype html><meta charset='utf-8'><title>{html.escape(title)}</title><h1>{html.escape(title)}</h1>"]
    for name, df in tables.items():
        found = df.limit(rows + 1).collect()
        head = "".join(f"<th>{html.escape(c)}" for c in df.columns)
        body = "".join("<tr>" + "".join(f"<td>{html.escape('' if v is None else f'{v:.4g}' if isinstance(v, float) else str(v))}" for v in r) for r in found[:rows])
        more = f"<p>{df.count() - rows} more rows are not shown." if len(found) > rows else ""
        parts.append(f"<h2>{html.escape(name)}</h2><table><tr>{head}{body}</table>{more}")
    return "\n".join(parts)
