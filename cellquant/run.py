"""The staged run: filtering, mapping (by an aligner of the user's), counting, summarising. Each stage writes tables below
out_dir and reads what the one before left, so that a run can start at any of them."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import replace
from hashlib import sha256

from pyarrow.fs import FileType
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellquant.config import STAGES, Config, check_index_lengths
from cellquant.functions import seq
from cellquant.operators import counts, filtering, fragments, intervals, mates, panel, qc, readqc, sampling
from cellquant.sources import bam, readers, sinks
from cellquant.storage import scratch

#: takes (spark, folder of filtered reads, config), returns records: qname, flag, chrom, pos, cigar, nh, bc, ub
Aligner = Callable[[SparkSession, str, Config], DataFrame]
SAMPLE = 1_000_000


def _put(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def filtering_stage(spark: SparkSession, config: Config, *, shards: int = 8) -> list[str]:
    """Writes filtered/ (decisions on all reads, reads, unaligned), qc/ (statistics, sample); returns warnings on the panel."""
    out, pairs = config.out_dir, readers.read_index_panel(spark, config.index_table)
    codes = {k: pairs.select(F.col(f"{k}_index").alias("code")).distinct() for k in ("i7", "i5")}
    first = pairs.first()
    check_index_lengths(config, len(first["i7_index"]), len(first["i5_index"]))
    adapters = [r[0] for r in readers.read_adapter_lines(spark, config.adapter_fasta).collect()] if config.adapter_fasta else []
    reads = _put(readers.read_lanes(spark, config.lanes), f"{out}/filtered/reads-in")
    turned, warnings = {}, []
    for k, column, span in (("i7", "i1_seq", config.layout.i7), ("i5", "i2_seq", config.layout.i5)):
        panel.check_codes([r["code"] for r in codes[k].collect()])
        windows = reads.select((F.shiftleft(F.col("lane").cast("long"), 40) + F.col("n")).alias("n"), F.when(F.length(column) >= span[1], F.substring(column, span[0] + 1, span[1] - span[0])).alias(column))
        turned[k] = panel.detect_orientation(windows, column, codes[k], "n", k)
        warnings += filter(None, [panel.radius_warning(k, panel.panel_report(codes[k], config.layout.budget), config.layout.budget)])
    layout = replace(config.layout, adapters=tuple(adapters), i7_reversed=turned["i7"], i5_reversed=turned["i5"])
    done = _put(filtering.filter_reads(reads, pairs, layout), f"{out}/filtered/decisions")
    sinks.write_filtered(done, f"{out}/filtered/passed", shards)
    passed = spark.read.parquet(f"{out}/filtered/passed")
    sinks.write_unaligned(passed, f"{out}/filtered/unaligned")
    _anew(f"{out}/filtered/unaligned_bam")
    sinks.write_unaligned_bam(passed, f"{out}/filtered/unaligned_bam")
    names = {k: "RevComp" if v else "Forward" for k, v in turned.items()}
    found = _put(filtering.filter_counts(done), f"{out}/qc/filter_counts")
    sinks.write_tsv(filtering.filter_statistics(found, names["i7"], names["i5"]).orderBy("place").drop("place").coalesce(1), f"{out}/qc/filter_stats")
    found.withColumns({"i7_orient": F.lit(names["i7"]), "i5_orient": F.lit(names["i5"])}).coalesce(1).write.mode("overwrite").json(f"{out}/qc/filter_stats_json")
    totals = _put(filtering.per_cell_totals(done), f"{out}/filtered/per_barcode")
    sinks.write_tsv(totals, f"{out}/filtered/per_barcode_tsv", "cell")
    sample = sampling.sample_rows(passed, SAMPLE, "qname")
    sample = _put(sample, f"{out}/qc/sample")
    for mate in ("r1", "r2"):
        _put(readqc.cycle_profile(sample, f"{mate}_cdna", f"{mate}_cdna_qual"), f"{out}/qc/cycles_{mate}")
        _put(readqc.duplication_levels(sample, f"{mate}_cdna"), f"{out}/qc/duplication_{mate}")
        _put(readqc.overrepresented(sample, f"{mate}_cdna"), f"{out}/qc/overrepresented_{mate}")
        sinks.write_fastq(sample, f"{out}/qc/sample_{mate}", f"{mate}_cdna", f"{mate}_cdna_qual")
    return warnings


def _anew(path: str) -> None:
    """Delete the folder of an earlier run."""
    source, at = bam.open_path(path)
    if source.get_file_info(at).type == FileType.Directory:
        source.delete_dir(at)


def _alignments(spark: SparkSession, paths: list[str]) -> tuple[DataFrame, list[tuple[str, int]] | None]:
    """Records of all inputs, which are BAM files (or folders of them) or SAM text, and the contigs of BAM headers."""
    columns = [F.col("rname").alias("chrom"), "pos", "cigar", F.coalesce("NH", F.lit(1)).alias("nh"), F.coalesce("BC", F.lit("")).alias("bc"), F.coalesce("UB", F.lit("")).alias("ub")]
    if not all(p.endswith(".bam") or bam.list_files([p]) != [p] for p in paths):
        if any(p.endswith(".bam") for p in paths):
            raise ValueError("alignments are either all BAM or all SAM text")
        return readers.read_sam(spark, paths).select("qname", "flag", *columns), None
    rows = bam.scan_bam(spark, paths)
    tag = {k: F.substring(rows.tags[k], 3, 1 << 30) for k in ("BC", "UB", "NH")}
    rows = rows.withColumns({"BC": tag["BC"], "UB": tag["UB"], "NH": tag["NH"].cast("int")})
    return rows.select("qname", "flag", *columns, "mapq", "rnext", "pnext", "tlen", "seq", "qual", "tags"), list(bam.read_header(bam.list_files(paths)[0])[0].contigs)


def mapping_stage(spark: SparkSession, config: Config, aligner: Aligner | None) -> None:
    """Writes mapped/: what the aligner returns, or the alignments (SAM text or BAM, one or several) that the configuration names;
    and the contigs in the order of the header, or of their names where there is none."""
    contigs = None
    if aligner is not None:
        records = aligner(spark, f"{config.out_dir}/filtered/passed", config)
    elif config.alignments:
        records, contigs = _alignments(spark, list(config.alignments))
    else:
        raise ValueError("mapping needs an aligner, or alignments in the configuration")
    records = _put(records, f"{config.out_dir}/mapped/records")
    if contigs is None:
        ends = records.where("chrom <> '*'").groupBy("chrom").agg(F.max(F.array_max(F.transform(seq.aligned_blocks(F.col("pos"), F.col("cigar")), lambda b: b.end))).alias("length"))
        contigs = [(r["chrom"], r["length"] or 1) for r in ends.orderBy("chrom").collect()]  # a row a contig
    _put(spark.createDataFrame([(i, *c) for i, c in enumerate(contigs)], "n int, contig string, length long"), f"{config.out_dir}/mapped/contigs")


def annotation_of(spark: SparkSession, config: Config) -> DataFrame:
    exons = readers.read_annotation(spark, config.gtf)
    return readers.with_contigs(exons, readers.read_fasta_lengths(spark, config.extra_contigs)) if config.extra_contigs else exons


def counting_stage(spark: SparkSession, config: Config) -> None:
    """Writes counts/: fragments, tagged records by place, all counts in long form, reads per cell, kinds of reads; qc/: coverage
    and insert sizes."""
    out = config.out_dir
    records, lines = spark.read.parquet(f"{out}/mapped/records"), annotation_of(spark, config)
    genes = _put(readers.genes(lines), f"{out}/counts/genes")
    exons = lines.select("gene_id", "start_pos", "end_pos").join(genes.select("gene_id", "chrom", "strand", "additional"), "gene_id")
    merged = _put(intervals.merge(exons, "gene_id", "chrom", "strand", "additional"), f"{out}/counts/exons")
    blocks = mates.record_blocks(records)
    gaps = None
    if config.introns:
        inside = intervals.introns(exons.select("chrom", "gene_id", "start_pos", "end_pos")).join(genes.select("gene_id", "strand"), "gene_id")
        gaps = _put(inside, f"{out}/counts/introns")
    found = fragments.assign_once(mates.fold(records), blocks, merged, gaps, stranded=config.strand == 1, multi_overlap=config.multi_overlap, fraction=config.fraction)
    found = found.withColumnRenamed("ub", "umi").withColumn("is_uniq", ~F.col("is_multi"))
    found = _put(found, f"{out}/counts/fragments")
    contigs = [(r["contig"], r["length"]) for r in spark.read.parquet(f"{out}/mapped/contigs").orderBy("n").collect()]
    tagged = _put(mates.tagged_records(records, found), f"{out}/counts/tagged_records")
    _anew(f"{out}/counts/tagged_bam")
    bam.write_bam(mates.bam_rows(mates.by_coordinate(tagged, [c for c, _ in contigs])), f"{out}/counts/tagged_bam", bam.header(contigs, order="coordinate"), index=True)
    totals = spark.read.parquet(f"{out}/filtered/per_barcode").withColumnRenamed("cell", "bc")
    lengths = merged.groupBy(F.col("gene_id").alias("gene")).agg(F.sum(F.col("end_pos") - F.col("start_pos") + 1).alias("length"))
    long = counts.counts_long(found, totals.select("bc", "total"), lengths, least_reads=config.least_reads, mode=config.mode.lower(), levels=config.levels)
    long = _put(long if config.introns else long.where("feature = 'exon'"), f"{out}/counts/long")
    sinks.write_counts(long, f"{out}/counts/counts_tsv")
    per_cell = _put(qc.reads_per_cell(fragments.category_counts(found), totals.select("bc", "total"), config.least_reads), f"{out}/counts/reads_per_cell")
    sinks.write_tsv(per_cell.select(F.col("cell").alias("RG"), F.col("n").alias("N"), F.initcap("type").alias("type")), f"{out}/counts/reads_per_cell_tsv", "RG", "type")
    sinks.write_tsv(totals.select(F.col("bc").alias("XC"), F.col("internal").alias("nNontagged"), F.col("tagged").alias("nUMItag")), f"{out}/counts/read_kinds_tsv", "XC")
    sinks.write_tsv(genes.orderBy("line").select("gene_id", "gene_name").coalesce(1), f"{out}/counts/gene_names_tsv")
    own = found.select("rid", "tagged", F.explode("ge").alias("gene_id"))
    kind = F.when(F.col("tagged"), "UMI-tagged").otherwise("Internal").alias("read_type")
    by_gene = qc.gene_body(blocks, merged.drop("additional"), assigned=own, keys=("tagged",)).join(genes.select("gene_id", "additional"), "gene_id")
    gene_class = F.when(F.col("additional"), "Spike-in").otherwise("Transcriptome").alias("category")
    profile = qc.mean_profile(by_gene, "additional", "tagged")
    body = _put(profile.select(gene_class, kind, (F.col("percentile") + 1).alias("percentile"), "coverage"), f"{out}/qc/gene_body")
    category = F.when(F.col("user"), "Spike-in").otherwise("Transcriptome").alias("category")
    sinks.write_tsv(body, f"{out}/qc/gene_body_tsv", "category", "read_type", "percentile")
    sizes = _put(qc.mate_insert_sizes(found, qc.transcript_spans(blocks, merged.drop("additional", "strand"))), f"{out}/qc/insert_sizes")
    sinks.write_tsv(sizes.select(category, kind, F.col("size").alias("insert_size"), F.col("n").alias("count")), f"{out}/qc/insert_sizes_tsv", "category", "read_type", "insert_size")


def summarising_stage(spark: SparkSession, config: Config) -> str:
    """Writes matrices/ and returns the report page."""
    out = config.out_dir
    long = spark.read.parquet(f"{out}/counts/long")
    sinks.write_matrices(long, f"{out}/matrices")
    sinks.write_blocks(long, f"{out}/matrix_blocks")
    found, per_cell = spark.read.parquet(f"{out}/qc/filter_counts"), spark.read.parquet(f"{out}/counts/reads_per_cell")
    measured = long.where("level = 'all' AND quant IN ('umicount', 'readcount')").groupBy("quant", "feature", "cell").agg(F.count_if(F.col("value") >= 1).alias("genes"), F.sum("value").alias("total"))
    setup = [(k, str(v)) for k, v in (("start_stage", config.start_stage), ("multi_mappers", config.mode), ("downsampling", config.levels), ("introns", config.introns), ("strand", config.strand))]
    if config.mode != "Unique" and (multi := readers.multimapper_metric(spark, f"{out}/star/{config.project}.Log.final.out")):
        setup.append(("multimapper_reads", multi))
    medians = measured.groupBy("quant", "feature").agg(F.bround(F.median("genes"), 0).alias("median_genes"), F.bround(F.median("total"), 0).alias("median_total"))
    return sinks.report_page(
        config.project,
        {
            "Run": spark.createDataFrame(setup, "setting string, value string"),
            "Reads": filtering.read_table(found),
            "Dropped reads": filtering.drop_ranking(found),
            "Genes and counts of a cell": medians,
            "Genes of a cell: boxes": qc.box_statistics(measured.where("quant = 'readcount'"), "genes", "feature").orderBy("feature"),
            "UMIs of a cell: boxes": qc.box_statistics(measured.where("quant = 'umicount'"), "total", "feature").orderBy("feature"),
            "Kinds of reads": qc.type_shares(per_cell),
            **{f"{name} of {mate}": spark.read.parquet(f"{out}/qc/{folder}_{mate}").orderBy(*order) for mate in ("r1", "r2") for name, folder, order in (("Bases and qualities", "cycles", ("cycle",)), ("Duplication", "duplication", ("level",)), ("Frequent sequences", "overrepresented", (F.desc("n"), "sequence")))},
            "Kinds of reads by cell": per_cell.where("cell <> 'bad'").orderBy("cell", "type"),
            "Gene body": spark.read.parquet(f"{out}/qc/gene_body").orderBy("category", "read_type", "percentile"),
            "Insert sizes": qc.insert_size_shares(spark.read.parquet(f"{out}/qc/insert_sizes"), keys=("user", "tagged")).orderBy("user", "tagged", "size"),
        },
    )


#: settings that a stage's tables depend on, and the tables whose rows its manifest counts
_SETTINGS = {
    "Filtering": ("files", "more_lanes", "layout", "index_table", "adapter_fasta"),
    "Mapping": ("alignments", "most_places"),
    "Counting": ("gtf", "extra_contigs", "least_reads", "introns", "strand", "levels", "multi_overlap", "fraction", "mode"),
}
_TABLES = {"Filtering": ("filtered/decisions", "filtered/passed", "filtered/per_barcode"), "Mapping": ("mapped/records", "mapped/contigs"), "Counting": ("counts/fragments", "counts/long", "counts/reads_per_cell")}


def _settings(config: Config, stage: str) -> str:
    """What a stage and those before it were asked to do, as one hash."""
    upto = [s for s in STAGES[:3] if STAGES.index(s) <= STAGES.index(stage)]
    return sha256(json.dumps([[name, repr(getattr(config, name))] for s in upto for name in _SETTINGS[s]]).encode()).hexdigest()


def _manifest(config: Config, stage: str) -> dict | None:
    """What a stage that was completed left, or None."""
    source, at = bam.open_path(f"{config.out_dir}/manifests/{stage}.json")
    if source.get_file_info(at).type != FileType.File:
        return None
    with source.open_input_stream(at) as f:
        return json.loads(f.read())


def check_resume(spark: SparkSession, config: Config) -> None:
    """The stages before ``config.start_stage`` must have been completed, with the same settings, and their tables hold the rows
    that they had then."""
    for stage in STAGES[: STAGES.index(config.start_stage)]:
        found = _manifest(config, stage)
        if found is None:
            raise ValueError(f"cannot start at {config.start_stage}: {stage} was not completed in {config.out_dir}")
        if found["settings"] != _settings(config, stage):
            raise ValueError(f"cannot start at {config.start_stage}: {stage} was run with other settings")
        for table, rows in found["rows"].items():
            now = spark.read.parquet(f"{config.out_dir}/{table}").count()
            if now != rows:
                raise ValueError(f"cannot start at {config.start_stage}: {table} holds {now} rows, {stage} left {rows}")


def resume_stage(config: Config) -> str:
    """The first stage that is not completed with these settings."""
    done = {s: (m := _manifest(config, s)) is not None and m["settings"] == _settings(config, s) for s in _SETTINGS}
    return next((s for s in _SETTINGS if not done[s]), "Summarising")


def _staged(spark: SparkSession, config: Config, stage: str, work: Callable[[], object]) -> None:
    """Run a stage. Its manifest and those of later stages go first and its own is written last, so that a stage that was
    stopped is never taken for a complete one."""
    source, folder = bam.open_path(f"{config.out_dir}/manifests")
    source.create_dir(folder, recursive=True)
    for later in STAGES[STAGES.index(stage) :]:
        if source.get_file_info(f"{folder}/{later}.json").type == FileType.File:
            source.delete_file(f"{folder}/{later}.json")
    with scratch(spark):
        work()
    rows = {t: spark.read.parquet(f"{config.out_dir}/{t}").count() for t in _TABLES[stage]}
    with source.open_output_stream(f"{folder}/{stage}.json.part") as f:
        f.write(json.dumps({"stage": stage, "settings": _settings(config, stage), "rows": rows}).encode())
    source.move(f"{folder}/{stage}.json.part", f"{folder}/{stage}.json")


def run(spark: SparkSession, config: Config, aligner: Aligner | None = None, *, resume: bool = False) -> str:
    """All stages from ``config.start_stage`` on (``resume``: from the first one that is not complete); returns the report page."""
    if resume:
        config = replace(config, start_stage=resume_stage(config))
    check_resume(spark, config)
    stages = {"Filtering": lambda: filtering_stage(spark, config), "Mapping": lambda: mapping_stage(spark, config, aligner), "Counting": lambda: counting_stage(spark, config)}
    for stage, work in stages.items():
        if config.runs(stage):
            _staged(spark, config, stage, work)
    return summarising_stage(spark, config)
