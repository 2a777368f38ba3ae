"""Personal data by weak supervision: labelers vote on candidate spans, expectation-maximisation finds how far each can be
trusted for each kind of data, and a span classifier trained on the estimates decides on spans beyond the base patterns. It
sees the votes, the span's shape and the word before it (hashed).

Only counts of patterns leave the executors: there are at most kinds * 3 ** labelers * shapes * (cues + 1) of them, whatever
the number of documents, so EM and the classifier's training are small and cover every document.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellquant.llm.common import with_fields

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("pattern", "gazetteer", "context", "shape", "checksum")
SHAPES, CUES = 4, 64

_ANY = re.compile(r"[0-9@]|[\[(]at").search
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+").match
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A look-behind keeps long digit runs linear; a match cannot start inside one anyway.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++").finditer
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++").finditer
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]").finditer
# Wider candidates; the classifier decides on them.
_WIDE = {
    "email": re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?[\[(](?:at|@)[\])] ?[A-Za-z0-9-]+(?: ?(?:\.|[\[(]dot[\])]) ?[A-Za-z0-9-]+)+").finditer,
    "ip": re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])").finditer,
    "card": re.compile(r"(?<![0-9.])[0-9]{4}(?:[ .-]?[0-9]{4}){3}(?![0-9])").finditer,
    "phone": re.compile(r"(?<![0-9A-Za-z+])(?:00[1-9][0-9]{0,2}[ .-]?)?\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])").finditer,
}
_NEAR = {
    "email": re.compile(r"mail|contact|write to|reach", re.I).search,
    "ip": re.compile(r"\bip\b|host|server|address", re.I).search,
    "card": re.compile(r"card|visa|payment|credit", re.I).search,
    "phone": re.compile(r"tel|phone|call|fax|mobile|whatsapp", re.I).search,
}
_AGAINST = re.compile(r"version|order|invoice|isbn|\bid\b|serial|part no|build|section", re.I).search
_LETTERS = re.compile(r"[^\W\d_]+").findall
_TLDS = frozenset("com net org edu gov io de fr es uk it nl eu us ca info co".split())
_ISSUERS = re.compile(r"4|5[1-5]|2[2-7]|3[47]|6(?:011|5)").match


def luhn(digits: str) -> bool:
    twice = [int(d) * 2 for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 * (d > 9) for d in twice)) % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches found from each ``@``: its longest run of local characters, then the domain. Linear."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN(text, at + 1) if start < at else None
        if m:
            done = m.end()
            yield start, done
        at = text.find("@", max(done, at + 1))


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base patterns, by start, then kind as listed. Code points."""
    if not text or not _ANY(text):
        return []
    out = [("email", a, b) for a, b in _emails(text)]
    out += [("ip", *m.span()) for m in _IP(text) if all(len(p.lstrip("0")) < 4 and int(p[-4:] if len(p) > 4 else p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in _CARD(text) if 12 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
    out += [("phone", *m.span()) for m in _PHONE(text) if 9 <= len(_digits(m[0])) <= 15]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def candidates(text: str | None) -> list[tuple[str, int, int, bool, tuple[int, ...], int, int]]:
    """Base spans and wider ones that overlap none of them: (kind, start, end, base, votes, shape, cue)."""
    base = base_spans(text)
    out = [(k, a, b, True, *_votes(text, k, a, b, True)) for k, a, b in base]
    if text and _ANY(text):
        taken = bytearray(len(text))
        for _, a, b in base:
            taken[a:b] = b"\1" * (b - a)
        for kind in KINDS:
            for m in _WIDE[kind](text):
                a, b = m.span()
                if 1 not in taken[a:b]:
                    out.append((kind, a, b, False, *_votes(text, kind, a, b, False)))
                    taken[a:b] = b"\1" * (b - a)
    return out


def _votes(text: str, kind: str, a: int, b: int, base: bool) -> tuple[tuple[int, ...], int, int]:
    """-1, 0 or 1 from each labeler, a shape class, and the hash of the last word before (0: none within 40 characters)."""
    s, digits = text[a:b], _digits(text[a:b])
    before = text[max(0, a - 40) : a]
    gazetteer = {
        "email": lambda: 1 if re.split(r"\.|[\[( ]dot[\]) ]", s)[-1].strip().lower() in _TLDS else -1,
        "ip": lambda: -1 if s.split(".")[0] in ("0", "127") else 0 if ":" in s else 1,
        "card": lambda: 1 if _ISSUERS(digits) else -1,
        "phone": lambda: 1 if re.match(r"1?[2-9]", digits) else 0,
    }[kind]()
    context = -1 if _AGAINST(before) else 1 if _NEAR[kind](before) else 0
    apart = not (a and text[a - 1].isalnum()) and not (b < len(text) and text[b].isalnum())
    checksum = {"card": (1 if luhn(digits) else -1) if digits else 0, "phone": 1 if 9 <= len(digits) <= 15 else -1, "ip": 0, "email": 0}[kind]
    words = _LETTERS(before.lower())
    cue = zlib.crc32(words[-1].encode()) % CUES + 1 if words else 0
    return (1 if base else 0, gazetteer, context, 1 if apart else -1, checksum), min(SHAPES - 1, len(s) // 10), cue


SIZE = len(KINDS) * (1 + 3 * len(LABELERS)) + SHAPES + CUES + 1


@dataclass(frozen=True)
class PiiModel:
    prior: np.ndarray  # by kind
    reliability: np.ndarray  # kind, labeler, truth, vote + 1: P(vote | truth)
    weights: np.ndarray
    accept: float = 0.9

    def probability(self, kind: str, votes: tuple[int, ...], shape: int, cue: int = 0) -> float:
        return float(1 / (1 + np.exp(-self.weights[_features(KINDS.index(kind), votes, shape, cue)].sum())))


def _features(kind: int, votes: tuple[int, ...], shape: int, cue: int) -> list[int]:
    """Which of the classifier's features are 1: the kind, each vote of a labeler on that kind, the shape and the cue."""
    per_kind = 1 + 3 * len(LABELERS)
    rest = len(KINDS) * per_kind
    return [kind * per_kind, *(kind * per_kind + 1 + 3 * i + v + 1 for i, v in enumerate(votes)), rest + shape, rest + SHAPES + cue]


def estimate(kind: np.ndarray, votes: np.ndarray, n: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Dawid-Skene EM over counted vote patterns: prior by kind, P(vote | truth) by kind and labeler, P(true) of each pattern.
    It starts from the mean vote. An abstention says nothing about its span, only how often the labeler speaks. Each kind's table leans on that of all kinds together as on ten candidates, so that rare
    kinds have sound ones, and that on Laplace counts."""
    p = np.clip(0.5 + votes.mean(1) / 2, 0.05, 0.95)
    kinds, labelers = len(KINDS), votes.shape[1]
    for _ in range(rounds):
        prior = (np.bincount(kind, n * p, kinds) + 1) / (np.bincount(kind, n, kinds) + 2)
        table = np.zeros((kinds, labelers, 2, 3))
        for truth, w in enumerate((n * (1 - p), n * p)):
            for i in range(labelers):
                table[:, i, truth] = np.bincount(kind * 3 + votes[:, i] + 1, w, kinds * 3).reshape(kinds, 3)
        whole = table.sum(0) + 1
        table += 10 * whole / whole.sum(2, keepdims=True)
        table /= table.sum(3, keepdims=True)
        log = [np.log(q[kind]) + sum(np.where(votes[:, i] == 0, 0, np.log(table[kind, i, truth, votes[:, i] + 1])) for i in range(labelers)) for truth, q in enumerate((1 - prior, prior))]
        p = 1 / (1 + np.exp(np.clip(log[0] - log[1], -40, 40)))
    return prior, table, p


def _each_candidate(documents: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(KINDS.index(c[0]), *c[4], *c[5:]) for t in b.column(0) for c in candidates(t.as_py())]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int32()) for c in (zip(*rows, strict=True) if rows else [[]] * (len(LABELERS) + 3))], ["kind", *LABELERS, "size_class", "cue"])

    return documents.select("text").mapInArrow(run, ", ".join(f"{c} int" for c in ("kind", *LABELERS, "size_class", "cue")))


def train_pii(documents: DataFrame, *, accept: float = 0.9, rounds: int = 300) -> PiiModel:
    """Votes of all documents, counted by pattern; EM; then a logistic span classifier on the estimates. With no candidate at
    all (no documents, null texts) nothing beyond the base patterns is accepted."""
    counted = _each_candidate(documents).groupBy("kind", *LABELERS, "size_class", "cue").agg(F.count(F.lit(1)).alias("n")).collect()
    rows = sorted(tuple(r) for r in counted)
    if not rows:
        return PiiModel(np.full(len(KINDS), 0.5), np.full((len(KINDS), len(LABELERS), 2, 3), 1 / 3), np.zeros(SIZE), accept)
    a = np.array(rows)
    prior, table, p = estimate(a[:, 0], a[:, 1 : 1 + len(LABELERS)], a[:, -1].astype(float))
    x, n = np.zeros((len(rows), SIZE)), np.log1p(a[:, -1].astype(float))
    for i, r in enumerate(rows):
        x[i, _features(r[0], r[1 : 1 + len(LABELERS)], r[-3], r[-2])] = 1
    w = np.zeros(SIZE)
    for _ in range(rounds):  # damped gradient steps over a bounded number of patterns
        q = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        w += 0.5 * (x.T @ (n * (p - q)) / n.sum() - 1e-3 * w)
    return PiiModel(prior, table, w, accept)


SPAN = "array<struct<kind:string,`start`:int,`end`:int,base:boolean>>"


def spans_of(text: str | None, model: PiiModel) -> list[tuple[str, int, int, bool]]:
    """Base spans, and candidates that the classifier accepts, by start, then kind as listed."""
    kept = [c[:4] for c in candidates(text) if c[3] or model.probability(c[0], *c[4:]) >= model.accept]
    return sorted(kept, key=lambda s: (s[1], KINDS.index(s[0])))


def find_pii(documents: DataFrame, model: PiiModel) -> DataFrame:
    """Every row with spans (array of kind, start, end, base; code points, end exclusive) and redacted (the text with
    each span, overlapping ones joined, replaced by its kind in brackets).

    A null text counts as empty for spans, and stays null in redacted. Repeated rows stay, an empty table gives an empty
    result. Columns named spans or redacted are replaced; all others are kept.
    """
    kept = [c for c in documents.columns if c not in ("spans", "redacted")]
    place = kept.index("text")
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(place).to_pylist()
            found = [spans_of(t, model) for t in texts]
            spans = [[dict(zip(("kind", "start", "end", "base"), s, strict=True)) for s in one] for one in found]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(spans, kind), pa.array([redact(t, s) for t, s in zip(texts, found, strict=True)], pa.string())], [*kept, "spans", "redacted"])

    rows = documents.select(*kept)
    return rows.mapInArrow(run, with_fields(rows, f"spans {SPAN}, redacted string"))


def redact(text: str | None, spans: list[tuple[str, int, int, bool]]) -> str | None:
    if not text or not spans:
        return text
    out, done = [], 0
    for kind, a, b, _ in spans:
        if a >= done:
            out += [text[done:a], f"[{kind.upper()}]"]
        done = max(done, b)
    return "".join(out) + text[done:]


def pii_digest(found: DataFrame) -> DataFrame:
    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = F.filter("spans", lambda s: s["base"])
    def count(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
