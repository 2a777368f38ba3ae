"""Trimming, the decision on each read, panel guards and orientation."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from cellquant.functions import seq, trimming
from cellquant.operators import barcode, filtering, panel, sampling
from cellquant.plans import queries
from cellquant.sources import readers


def plain_trim(read, qual, adapters, quality):
    end = len(read)
    for a in adapters:
        for i in range(end):
            n = min(len(a), end - i)
            if n < 5:
                break
            if sum(x != y for x, y in zip(read[i : i + n], a, strict=False)) <= 0.1 * n:
                end = i
                break
    q = [max(0, ord(c) - 33) for c in qual]
    start = 0
    while start < end and q[start] < quality:
        start += 1
    while end > start and q[end - 1] < quality:
        end -= 1
    if start == end:  # no base is good
        return 0, 0
    for i in range(start, end - 3):
        if sum(q[i : i + 4]) < 4 * quality:
            end = i
            break
    return start, end


def test_trimming(spark):
    rng = random.Random(3)
    adapters = ["CTGTCTCTTATACACATCT", "ACGTA", "GATC"]
    rows = [("", ""), ("ACGT", "IIII"), ("ACGTA", "IIIII"), ("T" * 30, "#" * 30), ("T" * 30, "I" * 30), (None, None)]
    for _ in range(400):
        read = "".join(rng.choice("ACGT") for _ in range(rng.randrange(0, 60)))
        if rng.random() < 0.5:
            a = list(adapters[0])
            a[rng.randrange(len(a))] = "N"
            read += "".join(a)[: rng.randrange(3, 20)]
        rows.append((read, "".join(rng.choice("#+5?IIIIII") for _ in read)))
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, s string, q string")
    got = {r["i"]: tuple(r["w"]) for r in df.select("i", trimming.trim_span(F.col("s"), F.col("q"), adapters, 20).alias("w")).collect()}
    for i, (s, q) in enumerate(rows):
        assert got[i] == plain_trim(s or "", q or "", adapters, 20), (s, q)
    one = {r["i"]: (r["n"], r["w"]) for r in df.where("s IS NOT NULL").select("i", seq.clip_adapter(F.col("s"), adapters[0]).alias("n"), trimming.trim_span(F.col("s"), F.regexp_replace("s", ".", "I"), adapters[:1], 20).end.alias("w")).collect()}
    assert all(n == w for n, w in one.values()), "array functions and batches agree"


PANEL = [("AAAAAAAAAA", "CCCCCCCCCC"), ("AAAAAAAAAA", "GGGGGGGGGG"), ("TTTTTTTTTT", "CCCCCCCCCC")]


def test_reasons_in_their_order(spark):
    """Each read has one more fault than the next, so its reason is the first of its faults."""
    good = {"read_id": "a:1/1 x", "r1_seq": "ATTGCGCAATG" + "ACGTACGT" + "GGG" + "TTTT", "r2_seq": "ACGTTGCA" * 5, "i1_seq": "AAAAAAAAAA", "i2_seq": "CCCCCCCCCC"}
    good |= {f"{k}_qual": "I" * len(good[f"{k}_seq"]) for k in ("r1", "r2", "i1", "i2")}
    low_umi = good | {"r1_qual": "I" * 11 + "#" * 4 + "I" * 11}
    short_r1 = low_umi | {"r1_seq": good["r1_seq"][:20], "r1_qual": low_umi["r1_qual"][:20]}
    low_bc = short_r1 | {"i1_qual": "#" * 2 + "I" * 8, "i2_qual": "I" * 8 + "##"}
    unlisted = low_bc | {"i1_seq": "TTTTTTTTTT", "i2_seq": "GGGGGGGGGG"}
    absent = low_bc | {"i1_seq": "CGCGCGCGCG"}
    too_short = absent | {"i1_seq": "AAAA", "i1_qual": "IIII"}
    short_r2 = too_short | {"r2_qual": "I" * 19 + "#" * 21}
    fixed, internal = good | {"i1_seq": "AAAAACAAAA"}, good | {"r1_seq": "C" * 26, "r1_qual": "#" * 26}
    rows = [good, low_umi, short_r1, low_bc, unlisted, absent, too_short, short_r2, fixed, internal]
    want = ["passed", "dropped_umi_quality", "dropped_short_r2", "dropped_bc_quality", "dropped_no_barcode_uncorrectable", "dropped_no_barcode_absent", "dropped_no_barcode_absent", "dropped_short_r2", "passed", "passed"]
    names = sorted(good)
    df = spark.createDataFrame([(i, *(r[k] for k in names)) for i, r in enumerate(rows)], "n int, " + ", ".join(f"{k} string" for k in names))
    pairs = spark.createDataFrame(PANEL, "i7_index string, i5_index string")
    done = filtering.filter_reads(df, pairs)
    got = done.orderBy("n").collect()
    assert [r["outcome"] for r in got] == want
    assert (got[0]["cell"], got[0]["umi"], got[0]["r1_cdna"], got[0]["qname"], got[8]["corrected"]) == ("AAAAAAAAAACCCCCCCCCC", "ACGTACGT", "TTTT", "a:1", True)
    assert (got[9]["umi"], got[9]["r1_cdna"], got[9]["has_tag"]) == ("", "C" * 26, False)
    found = filtering.filter_counts(done)
    assert tuple(found.first()) == (10, 3, 2, 1, 2, 2, 1, 0, 1, 1, 4, 1)
    stats = {r["metric"]: r["value"] for r in filtering.filter_statistics(found, "Forward", "RevComp").collect()}
    assert len(stats) == 15 and stats["passed_pct"] == "30.0000" and stats["i5_orient"] == "RevComp"
    assert [(r["reason"], r["n"]) for r in filtering.drop_ranking(found).orderBy("place").collect()][:2] == [("dropped_no_barcode_absent", 2), ("dropped_short_r2", 2)]
    parts = {r["category"]: (r["pct_total"], r["pct_parent"]) for r in filtering.read_table(found).collect()}
    assert parts["dropped"] == (70.0, 70.0) and parts["total"] == (100.0, None) and "dropped_no_barcode_ambiguous" not in parts
    back = spark.createDataFrame([(seq_rc(a), b) for a, b in PANEL], "i7_index string, i5_index string")
    turned = filtering.filter_reads(df, back, filtering.ReadLayout(i7_reversed=True))
    assert [r["outcome"] for r in turned.orderBy("n").collect()] == want
    assert filtering.filter_counts(filtering.filter_reads(df.limit(0), pairs)).first()["total"] == 0


def seq_rc(s):
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


# Codes of a 96-cell panel whose spheres are known.
I7 = "ATAGGCGCTC TACAACCTCA AGTTATCGGA AGGAGCTTCC CATGCTGTTA TACGGTGTCA TCTTGCTGTG CGGATCATTA TACGACACTT TGTTGGTGCA TACCACAGAA TAGGCGATTG".split()
I5 = "TTGGTACGCG AACTGACCAA ATGTCTCCGG TTGGAACCAA GTCCTTGGTG CGATTACGTA ACCGATTAGA TTGTTAACGG".split()


@pytest.mark.parametrize(("codes", "close", "windows", "rejected"), [(I7, 18, (712, 1015, 19689), (0, 0, 317)), (I5, 5, (440, 636, 12186), (0, 0, 157))])
def test_spheres_of_a_panel(spark, codes, close, windows, rejected):
    df = spark.createDataFrame([(c,) for c in codes], "code string")
    for budget in range(3):
        sphere = barcode.index_sphere(df, budget)
        assert (sphere.count(), sphere.where("code IS NULL").count()) == (windows[budget], rejected[budget])
    report = panel.panel_report(df, 2)
    assert tuple(report.first()) == (len(codes), 3, 1, close)
    assert panel.radius_warning("i7", report, 1) is None and "safe radius 1" in panel.radius_warning("i7", report, 2)


def decoded(spark, codes, windows, budget=2):
    sphere = barcode.index_sphere(spark.createDataFrame([(c,) for c in codes], "code string"), budget)
    df = spark.createDataFrame(list(enumerate(windows)), "n int, w string")
    return [(r["x_code"], r["x_state"]) for r in barcode.decode(df, "w", sphere, "x").orderBy("n").collect()]


def test_sphere_rules(spark):
    a, b = "AAAAAAAAAA", "AAAAAAAACC"
    assert decoded(spark, [a, b], [a, b, "AAAAAAAAAC"]) == [(a, "exact"), (b, "exact"), (None, "ambiguous")]
    c, d = "ACGTACGTAC", "TGCATGCATG"
    assert [x for x, _ in decoded(spark, [c, d], [c, "ACGTACGTAG", "TGCATGCATA"])] == [c, c, d]
    one = ["ACGTACGTAC", "ACATACGTCC", "CGTACGTACA", "CTTACGTACA", "CTTTCGTACA", "CAATACGTAC", "CAGTACGTAC", "GTACGTACAA", "ACGTNCGTAC"]
    assert [x is not None for x, _ in decoded(spark, [c], one)] == [True, True, True, True, False, False, True, False, False]


def test_distances_with_open_ends(spark):
    pairs = [("CGTACGTACA", "ACGTACGTAC", 1), ("ACGTACGTAC", "CGTACGTACA", 1), ("ACGTACGTAC", "ACGTACGTAC", 0), ("ACGTACGTAC", "ACTTACGTAC", 1), ("AAAA", "CCCC", 4)]
    df = spark.createDataFrame(pairs, "a string, b string, d int")
    assert all(r["d"] == r["got"] for r in df.withColumn("got", panel.open_end_distance(F.col("a"), F.col("b"))).collect())
    single = panel.panel_report(spark.createDataFrame([("ACGT",)], "code string"), 2).first()
    assert tuple(single) == (1, None, None, 0)
    for bad in ([], ["ACGT", "ACG"], ["ACGN"], ["ACGT", "ACGT"], [""]):
        with pytest.raises(ValueError, match="index"):
            panel.check_codes(bad)


def test_orientation(spark):
    code = "ACGTAAGGCC"
    rc = seq_rc(code)

    def votes(windows, codes):
        df = spark.createDataFrame(list(enumerate(windows)), "n long, w string")
        return panel.Votes(**panel.orientation_votes(df, "w", spark.createDataFrame([(c,) for c in codes], "code string")).first().asDict())

    assert votes([rc] * 800 + ["A" * 10], [code]) == panel.Votes(0, 800, 0, 1) and votes([code], [code, rc]) == panel.Votes(0, 0, 1, 0)
    assert votes(["ACGTAAGGCG"], [code]) == panel.Votes(0, 0, 0, 1), "only listed codes vote"
    assert panel.resolve_orientation(panel.Votes(0, 800, 200, 0), "i7") is True and panel.resolve_orientation(panel.Votes(950, 50, 0, 9), "i7") is False
    for v, what in ((panel.Votes(0, 0, 0, 50), "low-confidence"), (panel.Votes(500, 500, 0, 0), "mixed"), (panel.Votes(100, 100, 0, 0), "mixed"), (panel.Votes(120, 100, 0, 0), "mixed"), (panel.Votes(100, 99, 5, 0), "low-confidence")):
        with pytest.raises(ValueError, match=what):
            panel.resolve_orientation(v, "i7")
    late = spark.createDataFrame([(n, rc if n < 300 else code) for n in range(2000)], "n long, w string")
    assert panel.resolve_orientation(panel.Votes(**panel.orientation_votes(panel.first_windows(late, "w", "n", 300), "w", spark.createDataFrame([(code,)], "code string")).first().asDict()), "i7")


def test_index_tables():
    row = ("ACGTACGTAC", "TTGGTACGCG")
    for sep in ",\t;":
        for end in ("\n", "\r\n", "\r"):
            text = sep.join(("\ufeffI7_index", "a", "i5_INDEX")) + end + sep.join((row[0].lower(), "1", f" {row[1]} ")) + end + sep * 2 + end + end
            assert readers.parse_index_panel(text) == [row]
    assert readers.parse_index_panel("i5_index,i7_index\nTT,AC\nTT,AC\nTT,GG\n") == [("AC", "TT"), ("GG", "TT")]
    for bad in ("", "i7_index i5_index\nA C\n", "a,i5_index\nA,C\n", "i7_index,i5_index\nACN,AC\n", "i7_index,i5_index\nAC,AC\nACG,AC\n", "i7_index,i5_index\nAC\n", "i7_index,i5_index\n", "i7_index,i5_index\nAC,\n"):
        with pytest.raises(ValueError, match="index"):
            readers.parse_index_panel(bad)


def test_samples_of_a_stated_size(spark):
    df = spark.range(5000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('k', id % 7) END AS k").withColumn("want", F.when(F.col("k") == "hot", 700).when(F.col("k") == "k1", 10_000).otherwise(5))
    got = sampling.take_by_hash(df, ["k"], "want", "id")
    assert got.columns == ["id", "k", "want"]
    have = {r["k"]: r["count"] for r in df.groupBy("k").count().collect()}
    assert {r["k"]: r["count"] for r in got.groupBy("k").count().collect()} == {k: 700 if k == "hot" else n if k == "k1" else 5 for k, n in have.items()}
    hot = [r["id"] for r in df.where("k = 'hot'").orderBy(sampling.hash_order(F.col("id"), "s42")).limit(700).collect()]
    assert {r["id"] for r in got.where("k = 'hot'").collect()} == set(hot)
    assert sampling.sample_rows(df, 123, "id").count() == 123 and sampling.sample_rows(df, 9999, "id").count() == 5000 and sampling.sample_rows(df.limit(0), 3, "id").count() == 0
    draws = [r[0] for r in spark.range(300).select(sampling.binomial(200, F.lit(0.3), F.col("id").cast("string"))).collect()]
    assert abs(sum(draws) / 300 - 60) < 2 and 4 < (sum((d - 60) ** 2 for d in draws) / 300) ** 0.5 < 9


def test_quality_windows_are_cut_in_batches(spark):
    """The spans of the column form, on odd strings too, and the query does not go through windows by array functions."""
    r = random.Random(5)
    texts = [None, "", "I", "#", "####", "IIII", "III#", "#IIII#", "II", "!!I!!!!I", *("".join(r.choice("#+05:?ABDEFGHI ~") for _ in range(r.randrange(90))) for _ in range(400))]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, q string").repartition(3)
    for width in (1, 4, 7):
        w, want = trimming.window_span(F.col("q"), 25, width), seq.quality_window(F.col("q"), 25, width)
        rows = df.select("i", w.alias("w"), want.alias("want")).collect()
        assert len(rows) == len(texts) and all(tuple(x["w"]) == tuple(x["want"]) for x in rows)
    plan = queries.sliding_window_trim(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "lambdafunction" not in plan


@pytest.mark.parametrize(("size", "share"), [(50, 2), (50, 40), (3000, 2), (1, 5000), (0, 2)])
def test_a_sample_of_what_passes_looks_at_no_more_than_it_needs(spark, size, share):
    df = spark.range(5000).selectExpr("concat('q', id) AS q", "id").union(spark.sql("SELECT 'q7', 7L"))
    seen = []

    def passing(rows):
        seen.append(rows.count())
        return rows.where(F.col("id") % share == 1)

    got = sampling.sample_passing(df, size, "q", passing)
    want = sampling.sample_rows(df.where(F.col("id") % share == 1), size, "q")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert sum(seen) <= 5001 and (share > 2 or size > 50 or sum(seen) < 600)
    assert sampling.sample_passing(df.limit(0), 3, "q", lambda x: x).count() == 0
