"""FASTQ lanes zipped by position over any cut, against lanes read in lock-step."""

from __future__ import annotations

import gzip
import random

import pytest
from pyspark.sql import functions as F

from cellquant import config, storage
from cellquant.plans import queries
from cellquant.sources import readers
from tests.main.test_counting import settings


def _lane(folder, name, n, seed, *, end="\n", tail=""):
    r = random.Random(seed)
    out = []
    for mate in ("r1", "r2", "i1", "i2"):
        size = 10 if mate[0] == "i" else r.randrange(20, 90)
        rows = []
        for k in range(n):
            seq = "".join(r.choice("ACGTN") for _ in range(size + k % 3))
            qual = "".join(r.choice("@+I#5") for _ in seq)  # lines that look like others
            rows += [f"@{name}:{k} {mate}", seq, "+" if k % 2 else f"+{name}:{k}", qual]
        path = folder / f"{name}_{mate}.fq"
        path.write_bytes((end.join(rows) + (end if n else "") + tail).encode())
        out.append(str(path))
    return tuple(out)


def _rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("size", ["97", "1000", "100000"])
def test_any_cut_gives_the_lanes(spark, tmp_path, size):
    lanes = [_lane(tmp_path, "a", 300, 1), _lane(tmp_path, "b", 57, 2, end="\r\n"), _lane(tmp_path, "c", 0, 3), _lane(tmp_path, "d", 41, 4, tail="\n\n")]
    want = _rows(readers.read_fastq4(spark, lanes))
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "50")
        got = readers.zip_fastq(spark, lanes)
        assert _rows(got) == want and len(want) == 398 and got.columns == readers.read_fastq4(spark, lanes).columns
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_folders_of_parts(spark, tmp_path):
    """A mate's records over several files, cut elsewhere than the other mates'."""
    lane = _lane(tmp_path, "p", 50, 7)
    folders = []
    for k, p in enumerate(lane):
        lines = open(p).read().splitlines(keepends=True)
        (tmp_path / f"m{k}").mkdir()
        for i, at in enumerate(range(0, len(lines), 12 + 8 * k)):
            (tmp_path / f"m{k}" / f"part-{i:05d}.txt").write_text("".join(lines[at : at + 12 + 8 * k]))
        folders.append(str(tmp_path / f"m{k}"))
    assert _rows(readers.zip_fastq(spark, [tuple(folders)])) == _rows(readers.read_fastq4(spark, [lane]))


def test_lanes_that_do_not_fit(spark, tmp_path):
    good, short = _lane(tmp_path, "a", 20, 1), _lane(tmp_path, "s", 19, 1)
    with pytest.raises(ValueError, match="lane 1: its files hold different numbers"):
        readers.zip_fastq(spark, [good, (*good[:3], short[3])])
    (tmp_path / "cut.fq").write_text("@a\nAC\n+\n")
    with pytest.raises(ValueError, match="a part of one"):
        readers.zip_fastq(spark, [(str(tmp_path / "cut.fq"),) * 4])
    (tmp_path / "odd.fq").write_text("@a\nAC\n+\nII\n\n@b\nACG\n+\n")
    with pytest.raises(Exception, match="not a FASTQ record: lane 0, number 1"):
        readers.zip_fastq(spark, [(str(tmp_path / "odd.fq"),) * 4]).collect()


def test_lanes_of_both_kinds(spark, tmp_path):
    lanes = [_lane(tmp_path, n, 30, i) for i, n in enumerate("xyz")]
    packed = []
    for p in lanes[1]:
        with gzip.open(f"{p}.gz", "wb") as f:
            f.write(open(p, "rb").read())
        packed.append(f"{p}.gz")
    got = readers.read_lanes(spark, [lanes[0], tuple(packed), lanes[2]])
    assert _rows(got) == _rows(readers.read_fastq4(spark, lanes))


def test_a_configuration_with_several_lanes(tmp_path):
    files = {f"file{i}": [f"/d/l1_{i}.fq", f"/d/l2_{i}.fq"] for i in range(1, 5)}
    raw = settings(tmp_path)
    for k, names in files.items():
        raw["sequence_files"][k]["name"] = names
    got = config.from_mapping(raw, exists=False)
    assert got.lanes == [tuple(f"/d/l{n}_{i}.fq" for i in range(1, 5)) for n in (1, 2)]
    raw["sequence_files"]["file3"]["name"] = "/d/one.fq"
    with pytest.raises(ValueError, match="go together"):
        config.from_mapping(raw, exists=False)


def test_the_query_keeps_little_beside_its_input(spark, tmp_path, monkeypatch):
    """Files and what they are made of take less than the text of the records, of which nothing else is stored."""
    for module in (queries, storage):
        monkeypatch.setattr(module, "shared_dir", lambda _: f"file://{tmp_path}")
    rows = queries.fastq_zip(spark, "/root/testdata/sf0.01")
    text = rows.select(F.sum(F.length(F.concat(*(c for c in rows.columns if c != "n"))))).first()[0]
    held = sum(p.stat().st_size for p in tmp_path.rglob("*") if p.is_file())
    assert 0 < held < 0.7 * text
