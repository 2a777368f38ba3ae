"""Mates, counts of all kinds, outputs, configuration and the staged run."""

from __future__ import annotations

import gzip
import shutil
import struct
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from cellquant import config, run, storage
from cellquant.operators import counts, intervals, mates, qc
from cellquant.sources import bam, readers, sinks

RECORD = "qname string, flag int, chrom string, pos long, cigar string, nh int, bc string, ub string"


def test_mates_come_together(spark):
    rows = [
        ("a", 65, "c1", 10, "5M", 1, "B", "U"), ("a", 145, "c2", 5, "5M", 1, "B2", "U2"),  # across contigs
        ("b", 145, "c1", 5, "4M", 1, "B", ""),  # second mate alone, reversed
        ("d", 81, "c1", 5, "4M", 1, "B", "U"), ("d", 2113, "c9", 5, "4M", 1, "B", "U"),  # a supplementary record
        ("e", 65, "c1", 5, "4M", 1, "B", "U"), ("e", 65, "c1", 900, "4M", 3, "B", "V"), ("e", 321, "c1", 700, "4M", 3, "B", "W"),  # one name, both kinds
        ("f", 129, "c1", 5, "4M", None, None, None),
    ]
    df = spark.createDataFrame(rows, RECORD)
    got = {r["rid"]: (r["is_multi"], r["bc"], r["ub"], r["r1_rev"], r["r2_rev"], r["frag_strand"], r["n_records"]) for r in mates.fold(df).collect()}
    assert got == {
        "a": (False, "B", "U", False, True, "+", 2), "b": (False, "B", "", None, True, "+", 1), "d": (False, "B", "U", True, None, "-", 1),
        "e": (False, "B", "U", False, None, "+", 1), "e*": (True, "B", "W", False, None, "+", 2), "f": (False, "", "", None, False, "-", 1),
    }
    assert mates.record_blocks(df).where("chrom = 'c9'").count() == 0 and mates.record_blocks(df).count() == 8
    tagged = mates.tagged_records(df, spark.createDataFrame([("a", ["G1", "G2"], None), ("d", None, ["G3"])], "rid string, ge array<string>, gi array<string>"))
    assert sorted((r["qname"], r["flag"], r["GE"], r["GI"]) for r in tagged.where("qname IN ('a', 'd')").collect()) == [("a", 65, "G1,G2", ""), ("a", 145, "G1,G2", ""), ("d", 81, "", "G3"), ("d", 2113, "", "")]
    assert mates.fold(df.limit(0)).count() == 0


def test_levels_and_tokens():
    assert counts.parse_levels("0, 10 ,5-20,,x, 5 - 7") == [("10", 10, 10), ("5-20", 5, 20), ("x", 0, 0), ("5 - 7", 0, 0)]


def test_counts_of_one_cell(spark):
    rows = [("r1", "c", "AAAA", ["A"], None, True), ("r2", "c", "AAAC", ["A"], None, True), ("r3", "c", "", ["A"], None, True), ("r4", "c", "", ["A", "B"], None, True), ("r5", "c", "", None, ["B"], True), ("r6", "low", "", ["A"], None, True), ("r7", "c", "", None, None, True)]
    df = spark.createDataFrame([(i, b, u, u != "", q, e, g) for i, b, u, e, g, q in rows], "rid string, bc string, umi string, tagged boolean, is_uniq boolean, ge array<string>, gi array<string>")
    totals, lengths = spark.createDataFrame([("c", 10), ("low", 1)], "bc string, total long"), spark.createDataFrame([("A", 500), ("B", 1000)], "gene string, length long")
    got = {tuple(r)[:5]: r["value"] for r in counts.counts_long(df, totals, lengths, least_reads=5, mode="rescue", levels="100,6").collect()}
    every = {k[:2] + k[3:]: v for k, v in got.items() if k[2] == "all"}
    assert every == {
        ("umicount", "exon", "A", "c"): 1, ("umicount", "inex", "A", "c"): 1, ("readcount", "exon", "A", "c"): 3, ("readcount", "inex", "A", "c"): 3, ("readcount", "inex", "B", "c"): 1, ("readcount", "intron", "B", "c"): 1,
        ("readcount_internal", "exon", "A", "c"): 1, ("readcount_internal", "inex", "A", "c"): 1, ("readcount_internal", "inex", "B", "c"): 1, ("readcount_internal", "intron", "B", "c"): 1, ("rpkm", "exon", "A", "c"): 2e6,
        ("readcount_internal_mult_rescue", "exon", "A", "c"): 0.75, ("readcount_internal_mult_rescue", "exon", "B", "c"): 0.25, ("readcount_internal_mult_rescue", "inex", "A", "c"): 0.5, ("readcount_internal_mult_rescue", "inex", "B", "c"): 0.5,
    }
    assert {k[2] for k in got} == {"all", "downsampled_6"} and {k: v for k, v in got.items() if k[2] != "all"} == {(*k[:2], "downsampled_6", *k[3:]): v for k, v in got.items() if k[2] == "all" and k[0] != "rpkm"}
    whole = {tuple(r)[:5]: r["value"] for r in counts.unique_and_mult(spark.createDataFrame([(*k, v) for k, v in got.items()], "quant string, feature string, level string, gene string, cell string, value double"), "rescue").collect()}
    assert whole["readcount_internal_UniqueAndMult-rescue", "exon", "all", "A", "c"] == 1.75 and whole["umicount_UniqueAndMult-rescue", "exon", "all", "A", "c"] == 1
    assert counts.counts_long(df.limit(0), totals, lengths).count() == 0


def test_annotation_joins_without_a_broadcast(spark, monkeypatch):
    """A large annotation is dealt with salts; pairs and coverage are the same."""
    a = spark.createDataFrame([(f"r{i}", "c", i * 7 % 900, i * 7 % 900 + 40) for i in range(200)], "rid string, chrom string, start_pos long, end_pos long")
    b = spark.createDataFrame([(f"g{i}", "c", "+" if i % 2 else "-", i * 90, i * 90 + 70) for i in range(10)], "gene_id string, chrom string, strand string, start_pos long, end_pos long")
    want = sorted((r["rid"], r["gene_id"], r["olen"]) for r in intervals.overlap_join(a, b, bin_width=64).collect())
    body = sorted(map(tuple, qc.gene_body(a, b).collect()))
    by_hand = [(x["rid"], y["gene_id"], n) for x in a.collect() for y in b.collect() if (n := min(x["end_pos"], y["end_pos"]) - max(x["start_pos"], y["start_pos"]) + 1) > 0]
    assert want == sorted(by_hand) and sum(r[2] for r in body) == sum(r[2] for r in want)
    monkeypatch.setattr(intervals, "BROADCAST_ROWS", 3)
    assert want == sorted((r["rid"], r["gene_id"], r["olen"]) for r in intervals.overlap_join(a, b, bin_width=64).collect()) and body == sorted(map(tuple, qc.gene_body(a, b).collect()))


def test_outputs(spark, tmp_path):
    values = [3.0, 0.5, 1e-7, 12345678.25, 1e9, 1 / 3]
    texts = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v double").select(sinks.plain_number(F.col("v"))).collect()]
    assert texts[:5] == ["3", "0.5", "0.0000001", "12345678.25", "1000000000"] and float(texts[5]) == values[5]
    rows = [("umicount", "exon", "all", g, c, v) for g, c, v in (("g2", "c1", 2.0), ("g1", "c2", 0.25), ("g1", "c1", 1.0))] + [("rpkm", "exon", "all", "g1", "c1", 7.5)]
    df = spark.createDataFrame(rows, "quant string, feature string, level string, gene string, cell string, value double")
    sinks.write_counts(df, str(tmp_path / "counts"))
    lines = [x for p in sorted((tmp_path / "counts").glob("part-*")) for x in gzip.decompress(p.read_bytes()).decode().splitlines() if not x.startswith("quant")]
    assert lines == ["rpkm\texon\tall\tg1\tc1\t7.5", "umicount\texon\tall\tg1\tc1\t1", "umicount\texon\tall\tg1\tc2\t0.25", "umicount\texon\tall\tg2\tc1\t2"]
    assert sorted(map(tuple, sinks.read_counts(spark, str(tmp_path / "counts")).collect())) == sorted(rows)
    sinks.write_matrices(df, str(tmp_path / "m"))
    matrix = sinks.read_matrix(spark, str(tmp_path / "m"), "umicount", "exon")
    assert sorted(map(tuple, sinks.dense(matrix, ["c1", "c2"]).collect())) == [("g1", 1.0, 0.25), ("g2", 2.0, 0.0)]
    assert "<td>g2" in sinks.report_page("x & y", {"t": matrix}) and "x &amp; y" in sinks.report_page("x & y", {})


def bam_file(records, contigs):
    body = b"BAM\1" + struct.pack("<i", 0) + struct.pack("<i", len(contigs))
    for c, n in contigs:
        body += struct.pack("<i", len(c) + 1) + c.encode() + b"\0" + struct.pack("<i", n)
    for name, flag, ref, pos, cigar, seq, qual, tags in records:
        packed = bytes(("=ACMGRSVTWYHKDBN".index(seq[i]) << 4) + ("=ACMGRSVTWYHKDBN".index(seq[i + 1]) if i + 1 < len(seq) else 0) for i in range(0, len(seq), 2))
        rec = struct.pack("<iiBBHHHiiii", ref, pos - 1, len(name) + 1, 9, 0, len(cigar), flag, len(seq), -1, -1, 0) + name.encode() + b"\0"
        rec += b"".join(struct.pack("<I", n << 4 | "MIDNSHP=X".index(op)) for n, op in cigar) + packed + bytes(ord(q) - 33 for q in qual) + tags
        body += struct.pack("<i", len(rec)) + rec
    return gzip.compress(body[:50]) + gzip.compress(body[50:])


def test_bam(spark, tmp_path):
    tags = b"NHC\2" + b"XXBS\2\0\0\0\1\0\2\0" + b"BCZACGT\0" + b"YYAx" + b"UBZTT\0" + b"ZZf\0\0\0\0"
    data = bam_file([("q1", 16, 1, 5, [(3, "M"), (10, "N"), (2, "S")], "ACGTN", "IIII#", tags), ("q2", 4, -1, 0, [], "", "", b"")], [("c1", 9), ("c2", 99)])
    (tmp_path / "a.bam").write_bytes(data)
    got = [tuple(r) for r in readers.read_bam(spark, [str(tmp_path / "a.bam")]).collect()]
    assert got == [("q1", 16, "c2", 5, 9, "3M10N2S", "ACGTN", "IIII#", "ACGT", "TT", 2), ("q2", 4, "*", 0, 9, "*", "*", "*", None, "", None)]
    (tmp_path / "b.bam").write_bytes(gzip.compress(gzip.decompress(data)[:-3]))
    with pytest.raises(Exception, match="inside a record"):
        readers.read_bam(spark, [str(tmp_path / "b.bam")]).count()


def settings(folder, **changes):
    out = {
        "project": "p", "out_dir": f"{folder}/out", "star_tmp": f"{folder}/tmp", "num_threads": 4, "mem_limit": 8,
        "sequence_files": {
            "file1": {"name": f"{folder}/r1.fq", "base_definition": ["cDNA(23-60)", "UMI(12-19)"], "find_pattern": "ATTGCGCAATG;2"},
            "file2": {"name": f"{folder}/r2.fq", "base_definition": ["cDNA(1-60)"]},
            "file3": {"name": f"{folder}/i1.fq", "base_definition": ["BC(1-10)"]},
            "file4": {"name": f"{folder}/i2.fq", "base_definition": ["BC(1-10)"]},
        },
        "reference": {"GTF_file": f"{folder}/a.gtf", "additional_files": f"{folder}/extra.fa"},
        "read_filtering": {"adapter_fasta": f"{folder}/adapters.fa", "quality": 20, "min_length": 20},
        "filter_cutoffs": {"BC_filter": {"num_bases": 3, "phred": 20}, "UMI_filter": {"num_bases": 3, "phred": 20}},
        "barcodes": {"index_table": f"{folder}/panel.csv", "BarcodeBinning": 1, "nReadsperCell": 2},
        "counting_opts": {"introns": True, "strand": 1, "downsampling": "2-3", "multi_overlap": False, "fraction_overlap": 0, "multi_mappers": "EM"},
        "alignments": f"{folder}/mapped.sam",
    }
    return out | changes


def test_configuration(tmp_path, monkeypatch):
    monkeypatch.setenv("HOME", "/home/x")
    assert [config.expand_path(p) for p in ("~/a", "$HOME/b", "${HOME}", "~y/c", "d~", "$HOMES")] == ["/home/x/a", "/home/x/b", "/home/x", "~y/c", "d~", "/home/xS"]
    c = config.from_mapping(settings("~"), exists=False)
    assert c.files[0] == "/home/x/r1.fq" and c.layout.umi == (11, 19) and c.layout.cdna_start == 22 and c.layout.tag_mismatches == 2 and c.runs("Filtering") and c.mode == "EM"
    later = config.from_mapping(settings("~", start_stage="Counting"), exists=False)
    assert [later.runs(s) for s in config.STAGES] == [False, False, True, True]
    bad = [
        {"start_stage": "Later"}, {"num_threads": 0}, {"compress_threads": 3, "filter_threads": 2}, {"star_tmp": "~/out/tmp"},
        {"counting_opts": settings("~")["counting_opts"] | {"multi_mappers": "Best"}},
        {"sequence_files": settings("~")["sequence_files"] | {"file3": {"name": "x", "base_definition": ["XX(1-2)"]}}},
        {"sequence_files": settings("~")["sequence_files"] | {"file3": {"name": "x", "base_definition": []}}},
        {"sequence_files": settings("~")["sequence_files"] | {"file1": {"name": "x", "base_definition": ["cDNA(23-60)", "UMI(12-19)"]}}},
    ]
    for changes in bad:
        with pytest.raises(ValueError):
            config.from_mapping(settings("~", **changes), exists=False)
    with pytest.raises(ValueError, match="there is no"):
        config.from_mapping(settings(str(tmp_path)))
    with pytest.raises(ValueError, match="i7_index"):
        config.check_index_lengths(c, 8, 10)


def test_staged_run(spark, tmp_path):
    """From FASTQ files and alignments to matrices and the page, and again from a later stage on."""
    panel = [("ACGTACGTAC", "TTGGTACGCG"), ("TGCATGCATG", "TTGGTACGCG")]
    files, sam = {k: "" for k in ("r1", "r2", "i1", "i2")}, "@HD\tVN:1.6\n"
    for n in range(400):
        i7, i5 = panel[n % 2]
        umi = "ACGTTGCA" if n % 4 < 2 else "GGATCCAA"
        r1 = f"ATTGCGCAATG{umi}GGG" + "ACGATCGA" * 4 if n % 3 else "ACGATCGA" * 6
        reads = {"r1": r1, "r2": "TTGACCAG" * 6, "i1": i7, "i2": i5}
        for k, s in reads.items():
            files[k] += f"@read{n}/1\n{s}\n+\n{'#' * 30 if k == 'r2' and n % 50 == 0 else ''}{'I' * (len(s) - (30 if k == 'r2' and n % 50 == 0 else 0))}\n"
        gene = ("chr1", 120, 400) if n % 5 else ("spike", 10, 60)
        for flag, pos in ((65, gene[1]), (145, gene[2])):
            sam += f"read{n}\t{flag}\t{gene[0]}\t{pos}\t255\t30M\t*\t0\t0\t*\t*\tNH:i:1\tBC:Z:{i7}{i5}" + (f"\tUB:Z:{umi}" if n % 3 else "") + "\n"
    for k, text in files.items():
        (tmp_path / f"{k}.fq").write_text(text)
    (tmp_path / "mapped.sam").write_text(sam)
    (tmp_path / "a.gtf").write_text("".join(f'chr1\ts\texon\t{a}\t{b}\t.\t+\t.\tgene_id "G1"; gene_name "First";\n' for a, b in ((101, 200), (351, 500))))
    (tmp_path / "extra.fa").write_text(">spike\n" + "ACGT" * 50 + "\n")
    (tmp_path / "adapters.fa").write_text(">a\nCTGTCTCTTATACACATCT\n")
    (tmp_path / "panel.csv").write_text("i7_index;i5_index\n" + "".join(f"{a};{b}\n" for a, b in panel))
    c = config.from_mapping(settings(str(tmp_path)))
    page = run.run(spark, c)
    assert "<h2>Dropped reads</h2>" in page and "dropped_short_r2" in page
    stats = dict(x.split("\t") for p in (tmp_path / "out/qc/filter_stats").glob("part-*") for x in p.read_text().splitlines())
    assert (stats["total"], stats["passed"], stats["dropped_short_r2"], stats["i7_orient"], stats["passed_pct"]) == ("400", "392", "8", "Forward", "98.0000")
    long = {tuple(r)[:5]: r["value"] for r in spark.read.parquet(c.out_dir + "/counts/long").collect()}
    cell = "".join(panel[0])
    assert not any(k[0] == "umicount" and k[2] == "all" for k in long), "each UMI is on two genes"
    assert long["readcount", "exon", "all", "G1", cell] == 160 and long["readcount", "exon", "all", "spike", cell] == 40
    kinds = {(r["cell"], r["type"]): r["n"] for r in spark.read.parquet(c.out_dir + "/counts/reads_per_cell").collect()}
    assert kinds[cell, "user"] == 40 and kinds[cell, "exon"] == 160
    sizes = {(r["user"], r["size"]) for r in spark.read.parquet(c.out_dir + "/qc/insert_sizes").collect()}
    assert sizes == {(False, 160), (True, 80)}
    sam_lines = [x for p in (tmp_path / "out/filtered/unaligned").glob("part-*") for x in p.read_text().splitlines()]
    assert len(sam_lines) == 1 + 2 * 392 and {x.split("\t")[1] for x in sam_lines[1:] if not x.startswith("@")} == {"77", "141"}
    assert run.run(spark, config.from_mapping(settings(str(tmp_path), start_stage="Summarising"))).count("<h2>") == page.count("<h2>")

    pairs = bam.scan_bam(spark, [c.out_dir + "/filtered/unaligned_bam"])
    assert pairs.count() == 2 * 392 and {tuple(r) for r in pairs.select("flag", "rname", F.length("seq") == F.length("qual")).distinct().collect()} == {(77, "*", True), (141, "*", True)}
    tagged = bam.scan_bam(spark, [c.out_dir + "/counts/tagged_bam"])
    assert tagged.count() == 800 and tagged.where("tags['GE'] = 'Z:G1' AND tags['NH'] = 'i:1'").count() == 640
    assert bam.scan_bam(spark, [c.out_dir + "/counts/tagged_bam"], region="chr1:380-410").count() == 320

    # a stage that was stopped, other settings, a table that lost rows
    assert run.resume_stage(c) == "Summarising"
    with pytest.raises(ValueError, match="Counting was run with other settings"):
        run.run(spark, replace(c, start_stage="Summarising", fraction=0.5))
    (tmp_path / "out/manifests/Counting.json").unlink()
    with pytest.raises(ValueError, match="Counting was not completed"):
        run.run(spark, replace(c, start_stage="Summarising"))
    assert run.resume_stage(c) == "Counting" and run.resume_stage(replace(c, alignments=("x.sam",))) == "Mapping"
    assert run.run(spark, c, resume=True).count("<h2>") == page.count("<h2>") and run.resume_stage(c) == "Summarising"
    spark.read.parquet(c.out_dir + "/mapped/records").limit(5).write.parquet(c.out_dir + "/mapped/few")
    shutil.rmtree(tmp_path / "out/mapped/records")
    (tmp_path / "out/mapped/few").rename(tmp_path / "out/mapped/records")
    with pytest.raises(ValueError, match="mapped/records holds 5 rows, Mapping left 800"):
        run.run(spark, replace(c, start_stage="Counting"))

    # several inputs, as BAM, give the same counts
    shutil.copytree(c.out_dir + "/counts/tagged_bam", tmp_path / "in")
    parts = sorted(str(p) for p in (tmp_path / "in").glob("*.bam"))
    again = replace(c, start_stage="Mapping", alignments=tuple(parts) if len(parts) > 1 else (str(tmp_path / "in"),))
    run.run(spark, again)
    assert {tuple(r)[:5]: r["value"] for r in spark.read.parquet(c.out_dir + "/counts/long").collect()} == long
    assert bam.scan_bam(spark, [c.out_dir + "/counts/tagged_bam"]).count() == 800


def test_tables_need_a_shared_folder():
    class Cluster:
        class sparkContext:  # noqa: N801
            master, applicationId = "yarn", "a"

        class conf:  # noqa: N801
            get = staticmethod(lambda key, other: other)

    with pytest.raises(RuntimeError, match="checkpoint"):
        storage.shared_dir(Cluster)
