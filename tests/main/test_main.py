"""The main engine: every query against its SQL equivalent, and values worked out by hand."""

from __future__ import annotations

import gzip

import duckdb
import pytest
from pyspark.sql import functions as F

from cellquant.functions import seq
from cellquant.operators import matrices, umi
from cellquant.plans import queries
from cellquant.sources import readers, sinks
from cellquant.streaming.filtering import stream_outcomes

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.queries()))
def test_query_equals_sql(spark, name, tmp_path):
    out = str(tmp_path / "out")
    queries.queries()[name](spark, SF).write.parquet(out)
    if name not in queries.oracle_sql():
        assert spark.read.parquet(out).count() > 0
        return
    db = duckdb.connect()
    for t in ("lineitem", "nation", "part"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    db.execute(f"CREATE TABLE want AS {queries.oracle_sql()[name]}")
    assert db.execute("SELECT count(*) FROM want").fetchone()[0] > 0, "an empty result proves nothing"
    cols = ", ".join(f'"{c}"' for c in sorted(spark.read.parquet(out).columns))
    for a, b in (("want", f"'{out}/*.parquet'"), (f"'{out}/*.parquet'", "want")):
        assert db.execute(f"SELECT {cols} FROM {a} EXCEPT ALL SELECT {cols} FROM {b} LIMIT 3").fetchall() == []


SETS = [("c", ["A"], 3.0), ("c", ["B"], 1.0), ("c", ["A", "B"], 2.0), ("c", ["B", "C"], 1.0), ("c", ["C", "D"], 1.0)]


@pytest.mark.parametrize(
    ("share", "want"),
    [
        (matrices.share_uniform, [1.0, 1.5, 1.0, 0.5]),
        (matrices.share_prop_unique, [1.5, 1.5, 0.5, 0.5]),
        (matrices.share_rescue, [1.230769, 1.483516, 0.952381, 0.333333]),
        (matrices.share_em, [1.293113, 1.343193, 1.348707, 0.014988]),
    ],
)
def test_multimapper_shares(spark, share, want):
    df = spark.createDataFrame(SETS, "bc string, genes array<string>, c double")
    got = {r["gene"]: r["value"] for r in share(df).collect()}
    assert [round(got[g], 6) for g in "ABCD"] == want


def test_molecules_prefer_unique_evidence(spark):
    rows = [("c", "exon", "AAAA", True, ["A"]), ("c", "exon", "AAAA", False, ["B", "C"]), ("c", "exon", "CCCC", True, ["A"]), ("c", "exon", "CCCC", True, ["B"]), ("c", "exon", "GGGG", False, ["B", "C"]), ("c", "exon", "GGGG", False, ["C"])]
    df = spark.createDataFrame(rows, "bc string, layer string, umi string, is_uniq boolean, genes array<string>")
    got = {r["seed"]: r["genes"] for r in umi.molecules(umi.accumulate(df)).collect()}
    assert got == {"AAAA": ["A"], "GGGG": ["C"]}


def test_functions(spark):
    r = spark.range(1).select(
        seq.reverse_complement(F.lit("ACGTX")).alias("rc"),
        seq.aligned_blocks(F.lit(10), F.lit("5S4M2D3=1I2X10N1M3H")).alias("b"),
        seq.low_bases(F.lit("#I5"), 20).alias("low"),
        seq.query_name(F.lit("a:b/1 c")).alias("q"),
    ).first()
    assert r["rc"] == "NACGT" and r["low"] == 1 and r["q"] == "a:b"
    assert [tuple(b) for b in r["b"]] == [(10, 13), (16, 18), (19, 20), (31, 31)]


def test_readers(spark, tmp_path):
    (tmp_path / "a.gtf").write_text('#x\nchr1\ts\texon\t1\t9\t.\t+\t.\tgene_id "G1"; gene_name "N";\nchr1\ts\tgene\t1\t9\t.\t+\t.\tgene_id "G1";\n')
    assert [tuple(r) for r in readers.read_gtf_exons(spark, str(tmp_path / "a.gtf")).collect()] == [("chr1", 1, 9, "+", "G1", "N")]
    (tmp_path / "a.sam").write_text("@HD\nq\t16\tchr1\t5\t255\t4M\t*\t0\t0\tACGT\tIIII\tNH:i:2\tBC:Z:AC\n")
    assert [tuple(r) for r in readers.read_sam(spark, str(tmp_path / "a.sam")).collect()] == [("q", 16, "chr1", 5, "4M", "AC", "", 2)]
    (tmp_path / "p.csv").write_text("Cell,I5_index,i7_index\n1,acgt,TTTT\n2,ACGT,TTTT\n")
    assert [tuple(r) for r in readers.read_index_panel(spark, str(tmp_path / "p.csv")).collect()] == [("TTTT", "ACGT")]


def test_fastq_lanes(spark, tmp_path):
    def lane(k, n, short=0):
        paths = []
        for f in ("r1", "r2", "i1", "i2"):
            p = tmp_path / f"{k}{f}.fq.gz"
            text = "".join(f"@{k}:{i}/1\n{f[0].upper()}{'ACGT' * (i % 3 + 1)}\n+\n{'I' * (4 * (i % 3 + 1) + 1)}\n" for i in range(n - (short if f == "i2" else 0)))
            p.write_bytes(gzip.compress(text.encode()) if f != "i1" else text.encode())
            paths.append(str(p))
        return tuple(paths)

    rows = readers.read_fastq4(spark, [lane("a", 25), (*(f"file://{x}" for x in lane("b", 3)),)], rows=10).orderBy("lane", "n").collect()
    assert [(r["lane"], r["n"]) for r in rows] == [(0, i) for i in range(25)] + [(1, i) for i in range(3)]
    assert rows[1].asDict() | {"lane": 0} == {"lane": 0, "n": 1, "read_id": "a:1/1", "r1_seq": "RACGTACGT", "r1_qual": "I" * 9, "r2_seq": "RACGTACGT", "r2_qual": "I" * 9, "i1_seq": "IACGTACGT", "i1_qual": "I" * 9, "i2_seq": "IACGTACGT", "i2_qual": "I" * 9}
    with pytest.raises(Exception, match="different numbers"):
        readers.read_fastq4(spark, [lane("c", 5, short=1)]).count()
    for text, fails in (("@a\nAC\n+\nII\n\n", False), ("@a\nAC\n+\nII\n\n@b\nAC\n+\nII\n", True), ("@a\nAC\n+\nI\n", True), ("", False)):
        (tmp_path / "blank.fq").write_text(text)
        found = readers.read_fastq4(spark, [(str(tmp_path / "blank.fq"),) * 4])
        if fails:
            with pytest.raises(Exception, match="blank line|not a FASTQ"):
                found.count()
        else:
            assert found.count() == bool(text)


def test_fasta_and_matrix(spark, tmp_path):
    (tmp_path / "g.fa").write_text(">chr1 first\nACGT\nAC\n>chr2\nACG\n")
    assert sorted(tuple(r) for r in readers.read_fasta_lengths(spark, str(tmp_path / "g.fa")).collect()) == [("chr1", 6), ("chr2", 3)]
    assert {r["adapter"] for r in readers.read_adapters(spark, str(tmp_path / "g.fa")).collect()} == {"ACGT", "AC", "ACG"}
    exons = spark.createDataFrame([("G1", None), ("G2", "N"), ("G2", None)], "gene_id string, gene_name string")
    assert {tuple(r) for r in readers.gene_names(exons).collect()} == {("G1", "G1"), ("G2", "N")}
    lines = spark.createDataFrame([("G2", None, 5), ("G2", "Z", 3), ("G2", "A", 4), ("G1", None, 1), ("G1", "late", 2)], "gene_id string, gene_name string, line long")
    assert {tuple(r) for r in readers.gene_names(lines).collect()} == {("G1", "G1"), ("G2", "Z")}
    (tmp_path / "odd.fa").write_bytes(b">chr1 a > b\r\nAC\r\nGT\r\n>empty\r\n>chr2\r\nA\r\n")
    assert sorted(tuple(r) for r in readers.read_fasta_lengths(spark, str(tmp_path / "odd.fa")).collect()) == [("chr1", 4), ("chr2", 1), ("empty", 0)]
    sinks.write_matrix_market(spark.createDataFrame([("g2", "c1", 5), ("g1", "c2", 7), ("g1", "c1", 1)], "gene string, bc string, value long"), str(tmp_path / "mm"))
    lines = "".join(p.read_text() for p in sorted((tmp_path / "mm" / "matrix").glob("part-*"))).splitlines()
    assert lines == ["%%MatrixMarket matrix coordinate real general", "2 2 3", "1 1 1", "2 1 5", "1 2 7"]


def test_stream(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.createDataFrame([("ACGTACGTAC", "TTTTTGGGGG"), ("ACGTACGTAA", "TTTTTGGGGG"), ("NNNNNNNNNN", "TTTTTGGGGG")], "i1_seq string, i2_seq string").write.parquet(src)
    panel = spark.createDataFrame([("ACGTACGTAC", "TTTTTGGGGG")], "i7_index string, i5_index string")
    reads = spark.readStream.schema("i1_seq string, i2_seq string").parquet(src)
    q = stream_outcomes(reads, panel).writeStream.outputMode("complete").format("memory").queryName("outcomes").option("checkpointLocation", str(tmp_path / "ck")).start()
    q.processAllAvailable()
    q.stop()
    assert {tuple(r) for r in spark.table("outcomes").collect()} == {("exact", 1), ("corrected", 1), ("dropped_absent", 1)}
