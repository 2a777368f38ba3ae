"""Quality control of reads against plain counts."""

from __future__ import annotations

import random
from collections import Counter

from cellquant.operators import qc, readqc
from cellquant.sources import readers


def test_cycles(spark):
    r = random.Random(1)
    rows = []
    for k in range(400):
        n = r.choice([0, 1, 5, 5, 30]) if k else 9000
        rows.append(("".join(r.choice("ACGTNa") for _ in range(n)), "".join(chr(33 + r.randrange(42)) for _ in range(n))))
    got = {x["cycle"]: x for x in readqc.cycle_profile(spark.createDataFrame([*rows, (None, None)], "s string, q string").repartition(3), "s", "q").collect()}
    assert set(got) == set(range(1, 9001))
    for c in (1, 2, 5, 6, 30, 31, 9000):
        bases = Counter(s[c - 1].upper() for s, _ in rows if len(s) >= c)
        quals = sorted(ord(q[c - 1]) - 33 for _, q in rows if len(q) >= c)
        x, n = got[c], len(quals)
        assert (x["n"], x["a"], x["c"], x["g"], x["t"], x["other"]) == (n, bases["A"], bases["C"], bases["G"], bases["T"], bases["N"])
        assert abs(x["mean"] - sum(quals) / n) < 1e-9
        assert [x[k] for k in readqc.QUANTILES] == [next(v for i, v in enumerate(quals, 1) if sum(q <= v for q in quals) >= p * n) for p in readqc.QUANTILES.values()]
    assert readqc.cycle_profile(spark.createDataFrame([], "s string, q string"), "s", "q").count() == 0


def test_duplication_and_frequent_sequences(spark):
    r = random.Random(2)
    seqs = ["A" * 60] * 700 + ["A" * 50 + "C" * 9] * 30 + ["CG" * 10] * 12 + ["TT"] * 3 + ["".join(r.choice("ACGT") for _ in range(40)) for _ in range(3000)] + ["", None]
    r.shuffle(seqs)
    df = spark.createDataFrame([(s,) for s in seqs], "s string").repartition(7)
    copies = Counter(s[:50] for s in seqs if s)
    want: dict[int, list[int]] = {}
    for n in copies.values():
        level = max(x for x in readqc.LEVELS if x <= n)
        want[level] = [a + b for a, b in zip(want.get(level, [0, 0]), (1, n), strict=True)]
    assert {x["level"]: [x["sequences"], x["reads"]] for x in readqc.duplication_levels(df, "s").collect()} == want
    total = sum(copies.values())
    for share in (0.003, 0.05, 0.5):
        got = {x["sequence"]: x["n"] for x in readqc.overrepresented(df, "s", share=share).collect()}
        assert got == {s: n for s, n in copies.items() if n >= share * total}
    held = {x["value"]: x["least"] for x in readqc.frequent(df.where("s <> ''"), "s", 20).collect()}
    exact = Counter(s for s in seqs if s)
    assert all(n - total / 21 <= held.get(s, 0) <= n for s, n in exact.items() if n > total / 21) and all(v <= exact[s] for s, v in held.items())


def test_boxes(spark):
    r = random.Random(3)
    rows = [(f"k{i % 3}", float(r.randrange(100) + (1000 if i % 50 == 0 else 0))) for i in range(900)]
    df = spark.createDataFrame(rows, "k string, v double")
    for accuracy in (None, 10_000, 20):
        got = {x["k"]: x for x in qc.box_statistics(df, "v", "k", accuracy=accuracy).collect()}
        for k in ("k0", "k1", "k2"):
            values, x = sorted(v for c, v in rows if c == k), got[k]
            n = len(values)
            for p, name in ((0.25, "q1"), (0.5, "median"), (0.75, "q3")):
                if accuracy is None:
                    at = (n - 1) * p
                    low = values[int(at)]
                    assert abs(x[name] - (low + (values[min(int(at) + 1, n - 1)] - low) * (at - int(at)))) < 1e-9
                else:  # the rank is off by n / accuracy at most
                    below, upto = sum(v < x[name] for v in values), sum(v <= x[name] for v in values)
                    assert below - n / accuracy - 1 <= p * n <= upto + n / accuracy + 1
            edge = 1.5 * (x["q3"] - x["q1"])
            inside = [v for v in values if x["q1"] - edge <= v <= x["q3"] + edge]
            assert (x["n"], x["low"], x["high"], x["outliers"]) == (n, min(inside), max(inside), n - len(inside))
    assert qc.box_statistics(df.limit(0), "v", "k").count() == 0


def test_the_aligner_log(spark, tmp_path):
    path = tmp_path / "x.Log.final.out"
    path.write_text("  Number of input reads |\t100\n  Number of reads mapped to multiple loci |\t12345\n  % of reads mapped to multiple loci |\t1.50%\n")
    assert readers.multimapper_metric(spark, str(path)) == "12,345 (1.50% of input)"
    path.write_text("nothing of it\n")
    assert readers.multimapper_metric(spark, str(path)) is None and readers.multimapper_metric(spark, str(tmp_path / "none")) is None


def test_probe_of_the_first_reads(spark):
    df = spark.createDataFrame([(i, "A" * (5 if i < 3 else 7 if i < 6 else 9)) for i in range(20)], "n long, s string")
    assert [tuple(x) for x in qc.probe_length(df, "n", "s", 6).collect()] == [(5, 3)] and [tuple(x) for x in qc.probe_length(df, "n", "s").collect()] == [(9, 14)]
