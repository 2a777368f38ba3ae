"""Plans in which no contig, cell or file is one task give the same results as the plain ones."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from cellquant.operators import fragments, intervals, matrices, order, sampling, umi
from cellquant.plans import queries
from cellquant.sources import sinks
from tests.main import test_main


def _plain_merge(rows):
    out = []
    for c, s, e in sorted(rows):
        if out and out[-1][0] == c and s <= out[-1][2] + 1:
            out[-1] = c, out[-1][1], max(e, out[-1][2])
        else:
            out.append((c, s, e))
    return out


@pytest.mark.parametrize("width", [1, 7, 4096])
def test_contigs_are_scanned_in_ranges(spark, width):
    r = random.Random(width)
    spans = [(r.choice("ab"), f"g{i}", s := r.randrange(1, 400), s + r.choice([0, 3, 9, 90])) for i in range(60)]
    df = spark.createDataFrame(spans, "chrom string, gene_id string, start_pos long, end_pos long")
    want = _plain_merge([(c, s, e) for c, _, s, e in spans])
    merged = intervals.merge_contigs(df, width)
    assert sorted(map(tuple, merged.collect())) == want
    assert sorted(map(tuple, intervals.gaps(merged, width).collect())) == [(a[0], a[2] + 1, b[1] - 1) for a, b in zip(want, want[1:], strict=False) if a[0] == b[0]]
    single = {(c, p) for c in "ab" for p in range(600) if len({g for k, g, s, e in spans if k == c and s <= p <= e}) == 1}
    found = intervals.single_gene_regions(df, width).collect()
    assert {(x["chrom"], p) for x in found for p in range(x["start_pos"], x["end_pos"] + 1)} == single
    of = {(g, p) for _, g, s, e in spans for p in range(s, e + 1)}
    assert all((x["gene_id"], p) in of for x in found for p in (x["start_pos"], x["end_pos"]))
    assert intervals.merge_contigs(df.limit(0), width).count() == intervals.single_gene_regions(df.limit(0), width).count() == 0


def test_equal_intervals_are_one_island_in_any_order(spark, monkeypatch):
    """A join may give equal rows in any order; here those that begin no island come first."""
    plain = intervals._carried

    def turned(rows, by, sums, **how):
        out = plain(rows, by, sums, **how)
        return out.coalesce(1).sortWithinPartitions(F.asc_nulls_first("begun")) if "begun" in out.columns else out

    monkeypatch.setattr(intervals, "_carried", turned)
    spans = [("a", 1, 5), ("a", 9, 12), ("a", 9, 12), ("a", 9, 12), ("a", 20, 21), ("a", 20, 21)]
    merged = intervals.merge_contigs(spark.createDataFrame(spans, "chrom string, start_pos long, end_pos long"))
    assert sorted(map(tuple, merged.collect())) == [("a", 1, 5), ("a", 9, 12), ("a", 20, 21)]
    assert sorted(map(tuple, intervals.gaps(merged).collect())) == [("a", 6, 8), ("a", 13, 19)]


def test_em_by_rounds_is_em(spark):
    worked = [("A", 3), ("B", 1), ("AB", 2), ("BC", 1), ("CD", 1)]
    rows = [("w", list(g), float(n)) for g, n in worked]
    r = random.Random(4)
    rows += [(f"c{i % 7}", sorted(r.sample("ABCDEFGH", r.choice([1, 1, 2, 3]))), float(r.choice([1, 2, 9]))) for i in range(150)]
    sets = spark.createDataFrame(rows, "bc string, genes array<string>, c double").groupBy("bc", "genes").agg(F.sum("c").alias("c"))
    key = lambda df: {(x["bc"], x["gene"]): round(x["value"], 9) for x in df.collect()}
    plain, joined = key(matrices.share_em(sets)), key(matrices.em_by_rounds(sets))
    assert plain == joined == key(matrices.share_em(sets, cell_rows=20))
    assert {g: round(v, 6) for (c, g), v in joined.items() if c == "w"} == {"A": 1.293113, "B": 1.343193, "C": 1.348707, "D": 0.014988}
    assert key(matrices.em_by_rounds(sets.limit(0))) == {} and key(matrices.em_by_rounds(sets.where("size(genes) = 1"))) == {}


def test_shares_of_mapped_bases_at_the_boundary(spark):
    """55 of 100 bases are 0.55 of them, though the product rounds up; no mapped bases keep what overlaps."""
    frags = spark.createDataFrame([("a", False, "+", False, 100), ("b", False, "+", False, 100), ("c", False, "+", False, 0)], "rid string, tagged boolean, frag_strand string, is_multi boolean, mapped long")
    over = spark.createDataFrame([("a", "G", "+", 55), ("b", "G", "+", 54), ("c", "G", "+", 1)], "rid string, gene_id string, strand string, olen long")
    assert sorted(r["rid"] for r in fragments.resolve(frags, over, fraction=0.55).collect()) == ["a", "c"]


@pytest.mark.parametrize("size", [4, 12])
def test_networks_by_rounds_are_networks(spark, size):
    r = random.Random(size)
    rows = []
    for cell in range(3):
        found = {"".join(r.choice("ACGT") for _ in range(size)) for _ in range(12)}
        for u in list(found):  # neighbours of neighbours
            for _ in range(6):
                i = r.randrange(size)
                u = u[:i] + r.choice("ACGTN") + u[i + 1 :]
                found.add(u)
        rows += [(f"c{cell}", u, r.choice([1, 1, 1, 2, 3, 9, 40])) for u in sorted(found)]
    rows.append(("c9", "", 5))
    df = spark.createDataFrame(rows, "bc string, umi string, n long")
    want = {}
    for cell in {b for b, _, _ in rows}:
        own = [(u, n) for b, u, n in rows if b == cell]
        want |= {(cell, u): s for (u, _), s in zip(own, umi.seeds([u for u, _ in own], [n for _, n in own]), strict=True)}
    for got in (umi.networks_by_rounds(df, "bc"), umi.networks(df, "bc"), umi.networks(df, "bc", group_umis=10)):
        assert {(x["bc"], x["umi"]): x["seed"] for x in got.collect()} == want and set(got.columns) == {"bc", "umi", "n", "seed"}
    assert umi.networks_by_rounds(df.limit(0), "bc").count() == 0


def test_levels_in_one_pass(spark):
    rows = [(f"c{i % 5}", f"r{i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "bc string, rid string")
    targets = [(f"c{c}", level, n) for c in range(5) for level, n in (("none", 0), ("one", 1), ("some", 37 * c + 5), ("most", 599), ("all", 600), ("more", 10**6))]
    got = sampling.take_levels(df, ["bc"], spark.createDataFrame(targets, "bc string, level string, target long"), "rid").collect()
    held = {}
    for x in got:
        held.setdefault((x["bc"], x["level"]), set()).add(x["rid"])
    assert {(c, k): len(v) for (c, k), v in held.items()} == {(c, k): min(n, 600) for c, k, n in targets if n}
    for c, level, n in targets:
        one = sampling.take_by_hash(df.where(f"bc = '{c}'").withColumn("t", F.lit(n)), ["bc"], "t", "rid").collect()
        assert held.get((c, level), set()) == {x["rid"] for x in one}


def test_one_join_assigns_as_two_do(spark):
    r = random.Random(5)
    blocks = [(f"r{i % 80}", "c", s := r.randrange(1, 900), s + r.randrange(40)) for i in range(120)]
    frags = [(f"r{i}", r.random() < 0.5, r.choice("+-"), r.random() < 0.3, r.choice([0, 40, 80])) for i in range(90)]
    exons = [(f"g{i}", "c", r.choice("+-"), s := r.randrange(1, 900), s + r.randrange(90), i % 5 == 0) for i in range(40)]
    block_rows = spark.createDataFrame(blocks, "rid string, chrom string, start_pos long, end_pos long")
    frag_rows = spark.createDataFrame(frags, "rid string, tagged boolean, frag_strand string, is_multi boolean, mapped long")
    features = spark.createDataFrame(exons, "gene_id string, chrom string, strand string, start_pos long, end_pos long, additional boolean")
    e, i = features.where("start_pos % 3 > 0"), features.where("start_pos % 3 = 0").drop("additional")
    for rules in ({"fraction": 0.25}, {"stranded": False, "multi_overlap": True}, {"fraction": 0.0}):
        exon, intron = (fragments.resolve(frag_rows, fragments.gene_overlaps(block_rows, x), **rules) for x in (e, i))
        want = sorted(map(str, fragments.assign(frag_rows, exon, intron).select("rid", "ge", "gi", "user", "category").collect()))
        got = fragments.assign_once(frag_rows, block_rows, e, i, **rules)
        assert sorted(map(str, got.select("rid", "ge", "gi", "user", "category").collect())) == want and len(want) == 90
        assert set(r["category"] for r in fragments.assign_once(frag_rows, block_rows, e, **rules).collect()) <= {"Exon", "User", "Ambiguity", "Intergenic"}


def test_numbers_of_a_global_order(spark):
    r = random.Random(1)
    rows = [(r.choice([None, *"abc"]), r.randrange(50)) for _ in range(500)]
    got = order.numbered(spark.createDataFrame(rows, "k string, v int").repartition(6), ["k", "v"], "n").orderBy("n").collect()
    assert [x["n"] for x in got] == list(range(500)) and [(x["k"], x["v"]) for x in got] == sorted(rows, key=lambda x: (x[0] is not None, x[0] or "", x[1]))
    assert order.numbered(spark.createDataFrame([], "k string"), ["k"], "n").count() == 0


def test_blocks_of_a_sparse_matrix(spark, tmp_path):
    r = random.Random(2)
    rows = [(q, "exon", "all", f"g{g}", f"c{c:02}", r.random()) for q in ("umicount", "rpkm") for c in range(40) for g in r.sample(range(30), r.choice([0, 1, 9]))]
    df = spark.createDataFrame(rows, "quant string, feature string, level string, gene string, cell string, value double")
    sinks.write_blocks(df, str(tmp_path / "b"), cells=7)
    for q in ("umicount", "rpkm"):
        for cells in (None, ("c05", "c06"), ("c13", "c30"), ("c99", "d")):
            want = sorted((x[3], x[4], x[5]) for x in rows if x[0] == q and (cells is None or cells[0] <= x[4] <= cells[1]))
            assert sorted(map(tuple, sinks.read_blocks(spark, str(tmp_path / "b"), q, "exon", cells=cells).collect())) == want
    assert spark.read.parquet(str(tmp_path / "b/blocks")).count() <= 2 * 6
    sinks.write_matrix_market(df.where("quant = 'rpkm'").withColumnRenamed("cell", "bc"), str(tmp_path / "m"))
    text = [x for p in sorted((tmp_path / "m/matrix").glob("part-*")) for x in p.read_text().splitlines()]
    assert text[0].startswith("%%MatrixMarket") and int(text[1].split()[2]) == len(text) - 2 == sum(x[0] == "rpkm" for x in rows)


@pytest.mark.parametrize("name", ["mate_taxonomy", "tagged_records", "mate_reads_per_cell", "mate_insert_sizes", "mate_gene_body", "counts_long", "unique_and_mult"])
def test_slices_of_records_equal_sql(spark, name, tmp_path, monkeypatch):
    """Three slices, an annotation that is not broadcast, and keys that are dealt to several tasks."""
    monkeypatch.setattr(queries, "SLICE", 2500)
    monkeypatch.setattr(intervals, "BROADCAST_ROWS", 100)
    monkeypatch.setattr(intervals, "HOT_ROWS", 50)
    test_main.test_query_equals_sql(spark, name, tmp_path)


def test_only_hot_keys_are_dealt_to_several_tasks(spark, monkeypatch):
    rows = spark.createDataFrame([("a", i) for i in range(50)] + [("b", 1), ("c", 2)], "k string, x int")
    annotation = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), ("d", 4)], "k string, y int")
    want = sorted((k, x, y) for k, x in map(tuple, rows.collect()) for kk, y in map(tuple, annotation.collect()) if k == kk)
    monkeypatch.setattr(intervals, "BROADCAST_ROWS", 2)
    for hot, dealt in ((1000, False), (10, True)):
        monkeypatch.setattr(intervals, "HOT_ROWS", hot)
        got = intervals.annotated(rows, annotation, ["k"])
        assert sorted(map(tuple, got.select("k", "x", "y").collect())) == want
        assert ("salt" in got._jdf.queryExecution().analyzed().toString()) is dealt
