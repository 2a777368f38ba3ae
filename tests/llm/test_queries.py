"""Every registered query as it is registered, on whole small tables: against SQL where there is one, else against plain
versions of its contract."""

from __future__ import annotations

import re
from html import unescape

import duckdb
import numpy as np
import pytest

from cellquant.llm import queries
from tests.llm import plain

TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def _texts(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{plain.SF}/documents.parquet").collect()}


def _op3(spark, got):
    for i, t in _texts(spark).items():
        r = got[i]
        assert r["lossless"] and r["decoded_sha256"] == plain.sha(t or "") and r["n_chars"] == len(t or "") and bool(r["n_pieces"]) == bool(t)


def _op5(spark, got):
    fps = {i: plain.fingerprint(t) for i, t in _texts(spark).items()}
    roots = plain.components(fps)
    assert {i: (r["fingerprint"], r["component_id"]) for i, r in got.items()} == {i: (f"{fps[i]:016x}", roots[i]) for i in fps}


def _op6(spark, got):
    for i, t in _texts(spark).items():
        base = plain.personal(t)
        assert got[i]["base_sha256"] == plain.sha(",".join(f"{k}:{a}:{b}" for k, a, b in base))
        assert {f"{k}:{a}:{b}" for k, a, b in base} <= set(got[i]["spans"].split(","))


def _op7(spark, got):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{plain.SF}/labels.parquet").collect()}
    assert set(got) == set(_texts(spark)) and all(0 <= r["severity"] <= 2 and r["grade"] in (0, 1, 2) for r in got.values())
    assert sum(got[i]["toxic"] == (labels[i] == 1) for i in labels if i in got) >= 0.9 * sum(i in got for i in labels)


def _op8(spark, got):
    for i, (held, n, known, train, base) in plain.base_scores(_texts(spark).items()).items():
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held, n, known, train) and abs(r["base_score"] - base) < 1e-6 * max(1, abs(base))
        assert r["base_score"] - 0.5 * n < r["score"] < 0


def _op9(spark, got):
    pages = spark.read.parquet(f"{plain.SF}/pages.parquet").count()
    assert len(got) == pages and {r["verdict"] for r in got.values()} <= {"allow", "block"}
    ruled = {f"{h}{p}": v for v, h, p in queries.URL_RULES}
    assert all(r["verdict"] == ruled[r["rule"]] for r in got.values() if r["rule"])


def _op12(spark, got):
    for r in spark.read.parquet(f"{plain.SF}/pages.parquet").collect():
        inner = r["html"].split("<article>")[1].split("</article>")[0].replace("<br>", " ")
        blocks = (" ".join(unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1)>", inner))
        text = "\n".join(b for b in blocks if b)
        assert (got[r["page_id"]]["text"], got[r["page_id"]]["n_chars"], got[r["page_id"]]["url"]) == (text, len(text), r["url"])


KEYS = {"op9_url_filter": "page_id", "op12_html_text": "page_id"}
PLAIN = {"op12_html_text": _op12, "op3_sentencepiece": _op3, "op5_simhash": _op5, "op6_pii": _op6, "op7_toxicity": _op7, "op8_lm_scores": _op8, "op9_url_filter": _op9}


@pytest.mark.parametrize("name", [n for n in queries.queries() if n != "op10_nearest"])
def test_registered_query(spark, name, tmp_path):
    out = str(tmp_path / "out")
    queries.queries()[name](spark, plain.SF).write.parquet(out)
    if name not in queries.oracle_sql():
        rows = spark.read.parquet(out).collect()
        got = {r[KEYS.get(name, "doc_id")]: r for r in rows}
        assert len(got) == len(rows)
        return PLAIN[name](spark, got)
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{plain.SF}/{t}.parquet'")
    db.execute(f"CREATE TABLE want AS {queries.oracle_sql()[name]}")
    cols = ", ".join(f'"{c}"' for c in sorted(spark.read.parquet(out).columns))
    for a, b in (("want", f"'{out}/*.parquet'"), (f"'{out}/*.parquet'", "want")):
        assert db.execute(f"SELECT {cols} FROM {a} EXCEPT ALL SELECT {cols} FROM {b} LIMIT 3").fetchall() == []


def test_registered_search(spark):
    """Recall of the search as registered, against all inner products."""
    rows = spark.read.parquet(f"{plain.SF}/embeddings.parquet").collect()
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], float)
    got = {}
    for r in queries.op10_nearest(spark, plain.SF).collect():
        got.setdefault(r["query_id"], []).append(r["score"])
    assert set(got) == set(ids[ids % 20 == 0].tolist())
    right = 0
    for q, scores in got.items():
        s = x @ x[ids == q][0]
        best = np.sort(s[ids != q])[::-1][:20]
        assert len(scores) == min(20, len(ids) - 1)
        right += sum(v >= best[-1] - 1e-9 for v in scores)
    assert right >= 0.9 * sum(map(len, got.values()))
