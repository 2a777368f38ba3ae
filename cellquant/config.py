"""The run's configuration: a YAML file as dataclasses, with paths expanded and everything checked before a job starts."""

from __future__ import annotations

import os
import re
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from cellquant.operators.filtering import ReadLayout

STAGES = ("Filtering", "Mapping", "Counting", "Summarising")
MODES = ("Unique", "Uniform", "Rescue", "PropUnique", "EM")
PATHS = ("out_dir", "star_tmp", "name", "STAR_index", "GTF_file", "additional_files", "adapter_fasta", "index_table", "alignments")


def expand_path(path: str) -> str:
    """A leading ~ and $HOME or ${HOME} become the home folder; nothing else is expanded."""
    home = os.environ.get("HOME", "~")
    if path == "~" or path.startswith("~/"):
        path = home + path[1:]
    return path.replace("${HOME}", home).replace("$HOME", home)


def parse_base(text: str) -> tuple[str, int, int]:
    """(kind, start, end), 0-based half-open, of a definition like UMI(12-19), 1-based inclusive."""
    m = re.fullmatch(r"\s*(\w+)\s*\(\s*(\d+)\s*-\s*(\d+)\s*\)\s*", text)
    if not m or m[1] not in ("BC", "UMI", "cDNA") or int(m[2]) < 1:
        raise ValueError(f"no base definition like KIND(first-last): {text}")
    return m[1], int(m[2]) - 1, int(m[3])


@dataclass(frozen=True)
class Config:
    project: str
    out_dir: str
    files: tuple[str, str, str, str]
    layout: ReadLayout
    gtf: str
    index_table: str
    extra_contigs: str | None = None
    alignments: tuple[str, ...] = ()
    least_reads: int = 0
    introns: bool = True
    strand: int = 0
    levels: str = "0"
    multi_overlap: bool = False
    fraction: float = 0.0
    mode: str = "Unique"
    most_places: int = 20
    start_stage: str = "Filtering"
    adapter_fasta: str | None = None
    other: dict[str, Any] = field(default_factory=dict)
    more_lanes: tuple[tuple[str, str, str, str], ...] = ()

    @property
    def lanes(self) -> list[tuple[str, str, str, str]]:
        return [self.files, *self.more_lanes]

    def runs(self, stage: str) -> bool:
        """Whether a stage is run: those before the first one are read from what an earlier run left."""
        return STAGES.index(self.start_stage) <= STAGES.index(stage)


def _expanded(value: Any, key: str = "") -> Any:
    if isinstance(value, dict):
        return {k: _expanded(v, k) for k, v in value.items()}
    return expand_path(value) if key in PATHS and isinstance(value, str) else value


def _several(value: str | list[str] | None) -> tuple[str, ...]:
    """One value, or several."""
    return () if value is None else (value,) if isinstance(value, str) else tuple(map(expand_path, value))


def from_mapping(raw: dict[str, Any], *, exists: bool = True) -> Config:
    """Check and convert what the file says. ``exists``: input paths must be there."""
    c = _expanded(raw)
    files = [c["sequence_files"][f"file{i}"] for i in range(1, 5)]
    found: dict[str, list[tuple[int, int, int]]] = {"BC": [], "UMI": [], "cDNA": []}
    for i, f in enumerate(files):
        for text in f["base_definition"]:
            kind, start, end = parse_base(text)
            found[kind].append((i, start, end))
    tagged = [i for i, f in enumerate(files) if f.get("find_pattern") or any(i == x[0] for x in found["UMI"])]
    if not tagged or not found["UMI"]:
        raise ValueError("no read defines a UMI and a find_pattern")
    cdna = {i: start for i, start, _ in found["cDNA"]}
    if tagged[-1] not in cdna or not set(cdna) - {tagged[-1]}:
        raise ValueError("the tagged read and one other need a cDNA definition")
    if (tagged[-1], *(set(cdna) - {tagged[-1]})) != (0, 1):
        raise ValueError("the tagged read must be file1 and the other cDNA read file2")
    pattern = files[tagged[-1]].get("find_pattern")
    if not pattern:
        raise ValueError("the tagged read needs a find_pattern")
    tag, _, mismatches = pattern.partition(";")
    bc = sorted(found["BC"])
    if [x[0] for x in bc] != [2, 3]:
        raise ValueError(f"two BC definitions are needed, one each on file3 and file4, found {len(bc)}")
    cut = {k: c["filter_cutoffs"][f"{k}_filter"] for k in ("BC", "UMI")}
    layout = ReadLayout(
        tag=tag.strip(), tag_mismatches=int(mismatches or 0), umi=found["UMI"][-1][1:], cdna_start=cdna[tagged[-1]], i7=bc[0][1:], i5=bc[1][1:],
        quality=int(c["read_filtering"]["quality"]), min_length=int(c["read_filtering"]["min_length"]), bc_low=int(cut["BC"]["num_bases"]), bc_phred=int(cut["BC"]["phred"]),
        umi_low=int(cut["UMI"]["num_bases"]), umi_phred=int(cut["UMI"]["phred"]), budget=int(c["barcodes"]["BarcodeBinning"]),
    )
    n = c["counting_opts"]
    mode, stage = n.get("multi_mappers") or "Unique", c.get("start_stage") or "Filtering"
    for value, allowed, name in ((mode, MODES, "multi_mappers"), (stage, STAGES, "start_stage")):
        if value not in allowed:
            raise ValueError(f"{name} is {value}, not one of {', '.join(allowed)}")
    threads = [int(c[k]) if c.get(k) is not None else None for k in ("num_threads", "compress_threads", "filter_threads")]
    if threads[0] is not None and threads[0] < 1 or any(t is not None and t < 1 for t in threads[1:]):
        raise ValueError("numbers of threads must be 1 or more")
    if None not in threads and threads[1] + threads[2] > threads[0]:
        raise ValueError(f"compress_threads and filter_threads, {threads[1]} and {threads[2]}, are more than num_threads, {threads[0]}")
    if c.get("star_tmp") and Path(c["star_tmp"]).absolute().is_relative_to(Path(c["out_dir"]).absolute()):
        raise ValueError("star_tmp must not lie under out_dir")
    r = c["reference"]
    names = [(f["name"],) if isinstance(f["name"], str) else tuple(map(expand_path, f["name"])) for f in files]  # a list: a file a lane
    if len({len(n) for n in names}) != 1 or not names[0]:
        raise ValueError(f"the files of a lane go together, but there are {', '.join(str(len(n)) for n in names)} of them")
    lanes = list(zip(*names, strict=True))
    out = Config(
        project=str(c["project"]), out_dir=c["out_dir"], files=lanes[0], more_lanes=tuple(lanes[1:]), layout=layout, gtf=r["GTF_file"], index_table=c["barcodes"]["index_table"], extra_contigs=r.get("additional_files"),
        alignments=_several(c.get("alignments")), least_reads=int(c["barcodes"]["nReadsperCell"]), introns=bool(n["introns"]), strand=int(n["strand"]), levels=str(n["downsampling"]), multi_overlap=bool(n["multi_overlap"]),
        fraction=float(n["fraction_overlap"]), mode=mode, most_places=int(n.get("multimapper_cap") or 20), start_stage=stage, adapter_fasta=c["read_filtering"].get("adapter_fasta"), other={"num_threads": threads[0], "mem_limit": c.get("mem_limit")},
    )
    if exists:
        needed = {f"sequence_files.file{i + 1}, lane {n + 1}": p for n, lane in enumerate(out.lanes) for i, p in enumerate(lane) if out.runs("Filtering")} | {"reference.GTF_file": out.gtf, "barcodes.index_table": out.index_table}
        needed |= {k: p for k, p in (("reference.additional_files", out.extra_contigs), ("read_filtering.adapter_fasta", out.adapter_fasta)) if p}
        for name, path in needed.items():
            if "://" not in path and not Path(path).exists():
                raise ValueError(f"{name}: there is no {path}")
    return out


def check_index_lengths(config: Config, i7: int, i5: int) -> None:
    """The index slices must be as long as the table's codes."""
    for name, span, length in (("i7_index", config.layout.i7, i7), ("i5_index", config.layout.i5, i5)):
        if span[1] - span[0] != length:
            raise ValueError(f"the slice of {name} has {span[1] - span[0]} bases, the table's codes {length}")


def load(path: str) -> Config:
    try:
        import yaml
    except ImportError as e:
        raise RuntimeError("reading a configuration file needs PyYAML; give its content to from_mapping instead") from e
    return from_mapping(yaml.safe_load(Path(path).read_text()))
