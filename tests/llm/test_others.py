"""Chat formatting, pieces, URLs, nearest neighbours and the pipeline."""

from __future__ import annotations

import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from cellquant.llm import ann, chat, common, pieces, queries, urls
from tests.llm import plain


def test_chat_round_trip(spark):
    odd = ["", None, "\\", "\\b\\h", "### User: x </turn>\n", " </turn>\n", "a\\### Assistant: </turn> ok", "#" * 50, "<<\\<", "x" * 50_000, "é\u2028\n"]
    roles = ["user", "assistant", "system", "tool:er", "### User", None, "a: b"]
    rng = random.Random(3)
    rows = [(c, t, rng.choice(roles), rng.choice(odd), 1) for c in range(40) for t in range(rng.randrange(1, 7))]
    rows += [(50, 0, "user", "b", 1), (50, 0, "user", "a", 1), (50, 0, "user", "a", 1), (None, 1, "user", "n", 1)]
    out = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, segments int"))
    back = out.select("conv_id", "formatted", chat.parse_formatted(out.formatted).alias("t"), chat.loss_text(out.segments).alias("loss"), "segments").collect()
    key = lambda r: (r[1], r[2] or "", r[3] or "")
    for r in back:
        want = sorted((x for x in rows if x[0] == r["conv_id"]), key=key)
        assert [(x["role"], x["text"]) for x in r["t"]] == [(x[2] or "", x[3] or "") for x in want]
        assert r["loss"] == "".join(x[3] or "" for x in want if x[2] == "assistant")
        assert "".join(s["text"] for s in r["segments"]) == r["formatted"]
    assert out.limit(0).count() == 0


def test_chat_turn_order(spark):
    talks = {1: "system user assistant user", 2: "user assistant", 3: "assistant user", 4: "user user", 5: "system assistant", 6: "user tool"}
    rows = [(c, i, r, "x") for c, t in talks.items() for i, r in enumerate(t.split())]
    got = {r["conv_id"]: (r["valid"], r["first_error"]) for r in chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")).collect()}
    assert got == {1: (True, None), 2: (True, None), 3: (False, 0), 4: (False, 1), 5: (False, 1), 6: (False, 1)}


TEXTS = ["", "hello world", "  two  spaces \n\t", "▁literal ▁ mark", "日本語のテキスト", "naïve café 😀\x00", "a" * 5000, " ", "The quick brown fox", "été " * 50]


def test_pieces_round_trip():
    for dropout in (0.0, 0.1, 0.7, 1.0):
        caches = pieces._caches(pieces.MODEL, dropout, 5, 2)
        for t in TEXTS:
            assert pieces.pieces(pieces.MODEL).decode(pieces.encode_text(t, caches)) == t


def test_agendas_agree_with_plain_merging():
    model = pieces.pieces(pieces.MODEL)
    rng = random.Random(4)
    words = ["".join(rng.choice("theionsr éß中") for _ in range(rng.randrange(1, 30))) for _ in range(300)] + ["a" * 200, "▁", " ▁x", "\0"]

    def plain_merge(word, dropout):
        row, places = [int(model.piece_of[ord(c)]) for c in word], list(range(len(word)))
        dead = set()  # candidates that were skipped: (left, right, place) with the state of that place
        while True:
            best = None
            for i in range(len(row) - 1):
                both = model.merge_of.get((row[i] << 32) + row[i + 1]) if row[i] >= 0 and row[i + 1] >= 0 else None
                if both is not None and (row[i], row[i + 1], places[i]) not in dead and (best is None or model.rank[both] < best[0]):
                    best = (model.rank[both], i, both)
            if best is None:
                return [x for k, s in zip(places, row, strict=True) for x in ([s] if s >= 0 else [model.byte_id[y] for y in word[k].encode()])]
            i = best[1]
            if dropout.limit and dropout.of_one(row[i], row[i + 1], places[i]):
                dead.add((row[i], row[i + 1], places[i]))
                continue
            row[i : i + 2], places[i : i + 2] = [best[2]], [places[i]]

    for rate in (0.0, 0.1, 0.5, 1.0):
        dropout = pieces.Dropout(rate, 9)
        want = [plain_merge(w, dropout) for w in words]
        assert model.encode_words(words, dropout) == want
        for word, ids in zip(words, want, strict=True):
            symbols = model.piece_of[np.array([[ord(c) for c in word]])]
            again = symbols.copy()
            assert (model._merge_block(symbols, dropout) == model._merge_long(again, dropout)).all()
            assert (symbols[:, 0] == again[:, 0]).all() and model.decode(ids) == word


def test_pieces_match_the_library_without_dropout(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    texts = [r["text"] for r in spark.read.parquet(f"{plain.SF}/documents.parquet").limit(40).collect()]
    caches = pieces._caches(pieces.MODEL, 0.0, 1, 1)
    for t in [*texts, *TEXTS[1:2], *TEXTS[4:5], *TEXTS[8:]]:
        t = t or ""
        if "  " not in t and t == t.strip() and t:
            assert pieces.encode_text(f" {t}", caches) == sp.encode(t)


def test_pieces_seeds(spark):
    text = "Different segmentations of uncommonly interesting sentences " * 20
    df = spark.createDataFrame([(1, text, 7), (2, None, 7), (3, text, 7)], "doc_id long, text string, ids int")
    one, same, other = ([r["ids"] for r in pieces.encode(df, seed=s).orderBy("doc_id").collect()] for s in (1, 1, 2))
    assert one == same != other and one[1] == [] and one[0] == one[2]
    assert [r["decoded"] for r in pieces.decode(pieces.encode(df)).orderBy("doc_id").collect()] == [text, "", text]
    both = pieces.encode(df.withColumnRenamed("ids", "decoded"), decoded=True)
    assert both.columns == ["doc_id", "text", "ids", "decoded"] and [r["decoded"] for r in both.orderBy("doc_id").collect()] == [text, "", text]
    assert pieces.decode(pieces.encode(df.limit(0))).count() == 0


def test_pieces_vary(spark):
    """By default the words of a text take turns among several segmentations, also where texts share a long header."""
    texts = ["headers of uncommonly interesting documentation " * 3 + f"number {i}" for i in range(12)]
    rows = pieces.encode(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")).collect()
    assert all(pieces.pieces(pieces.MODEL).decode(r["ids"]) == texts[r["doc_id"]] for r in rows)
    assert len({tuple(r["ids"][:8]) for r in rows}) > 1, "one header, several segmentations"


def test_words_have_several_segmentations_in_a_corpus(spark):
    """Of the longer words that occur often, about half are split in more than one way by eight variants at a rate of 0.1."""
    df = spark.read.parquet(f"{plain.SF}/documents.parquet").select("text")
    model, seen = pieces.pieces(pieces.MODEL), {}
    for r in pieces.encode(df).collect():
        ids, at = r["ids"], 0
        while at < len(ids):  # a word begins with the blank before it
            end = at + 1
            while end < len(ids) and not model.bytes_of[ids[end]].startswith(b" "):
                end += 1
            seen.setdefault(model.decode(ids[at:end]), []).append(tuple(ids[at:end]))
            at = end
    often = [x for w, x in seen.items() if len(x) >= 20 and len(w) > 6]
    assert len(often) > 20 and sum(len(set(x)) > 1 for x in often) > 0.5 * len(often)


def test_pieces_of_slices(monkeypatch):
    """Whatever the slices and the generations of remembered words, a text has the same ids."""
    texts = [*TEXTS, *(f"{t} {k}" for k in range(40) for t in TEXTS)]
    want = pieces.encode_texts(texts, pieces._Words(pieces.pieces(pieces.MODEL), 0.2, 1, 3))
    monkeypatch.setattr(pieces, "SLICE", 500)
    monkeypatch.setattr(pieces, "REMEMBERED", 5000)
    caches, got = pieces._Words(pieces.pieces(pieces.MODEL), 0.2, 1, 3), []
    batch = pa.RecordBatch.from_arrays([pa.array(["cut", *texts, None])], ["text"])
    for _, part in pieces._slices(batch.slice(1), 0):
        got += pieces.encode_array(part, caches).to_pylist()
    assert got == [*want, []] and caches.old[0]
    bad = pa.array([[caches.model.byte_id[0xFF]], None, []], pa.list_(pa.int32()))
    assert pieces.decode_array(bad, caches.model).to_pylist() == ["\ufffd", "", ""]


RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def test_url_rules(spark):
    cases = {
        None: ("", "", None),
        "no scheme/x": ("", "", None),
        "http://": ("", "", None),
        "http://A.Example.ORG/es/1?x#y": ("a.example.org", "/es/1", "example.org/es/"),
        "http://example.org/en/12": ("example.org", "/en/12", "example.org/en/1"),
        "http://example.org/en/2": ("example.org", "/en/2", "org/"),
        "http://badexample.org/es/": ("badexample.org", "/es/", "org/"),
        "http://example.org": ("example.org", "", None),
        "https://x.com/de/?q=/fr/": ("x.com", "/de/", "com/de/"),
        "https://x.com?/de/": ("x.com", "", None),
        "a://b://c/d": ("b:", "//c/d", None),
        "https://x.net/fr/#" + "y" * 20_000: ("x.net", "/fr/", None),
    }
    df = spark.createDataFrame([(i, u, "h", 1) for i, u in enumerate(cases)], "page_id long, url string, host string, rule int")
    got = {r["page_id"]: r for r in urls.judge_urls(df, RULES).collect()}
    for i, (u, want) in enumerate(cases.items()):
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == want, u
        assert got[i]["verdict"] in ("allow", "block")
    assert urls.judge_urls(df.limit(0), RULES).count() == 0
    assert urls.judge_urls(df.limit(2), RULES).count() == 2


def test_url_model_learns(spark):
    """Held-out accuracy where the labels follow a lexical feature: rules block hosts with deep paths."""
    rng = random.Random(8)
    rows = [(i, f"http://{'a' if i % 2 else 'b'}.{'net' if i % 4 < 2 else 'test'}/" + "/".join(str(rng.randrange(1000)) for _ in range(8 if i % 2 else 2))) for i in range(600)]
    got = urls.judge_urls(spark.createDataFrame(rows, "page_id long, url string"), [("block", "a.net", "/"), ("allow", "b.net", "/")])
    held = [r for r in got.collect() if r["rule"] is None]
    assert len(held) == 300 and sum((r["verdict"] == "block") == bool(r["page_id"] % 2) for r in held) >= 285


def test_url_rules_equal_sql(spark):
    """Host, path, rule and ruled verdict of all pages, against DuckDB."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"] if r["rule"] else None) for r in urls.judge_urls(pages, queries.URL_RULES).collect()}
    cases = " ".join(
        f"WHEN (host = '{h}' OR host LIKE '%.{h}') AND starts_with(path, '{p}') THEN '{h}{p}:{v}'" for v, h, p in sorted(queries.URL_RULES, key=lambda r: -len(r[1] + r[2]))
    )
    sql = f"""WITH a AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM '/root/testdata/sf0.01/pages.parquet'),
    h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM a)
    SELECT page_id, host, path, split_part(r, ':', 1), split_part(r, ':', 2) FROM (SELECT *, CASE {cases} END AS r FROM h)"""
    assert got == {(i, h, p, r or None, v or None) for i, h, p, r, v in duckdb.sql(sql).fetchall()}


def test_url_trees_on_hidden_labels(spark):
    """Accuracy on ruled URLs of a fold whose labels the trees never saw."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    hidden = pages.where(F.pmod(F.xxhash64("url"), F.lit(urls.FOLDS)) == 0).select("page_id")
    rows = urls.judge_urls(pages, queries.URL_RULES, hidden_fold=0).join(hidden, "page_id").where("rule IS NOT NULL").collect()
    right = sum((r["p_block"] > 0.5) == (r["verdict"] == "block") for r in rows)
    print("ruled URLs of the hidden fold", len(rows), "right", right)
    assert len(rows) > 10 and right >= 0.9 * len(rows)


def test_nearest(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((900, 16))
    x[300:600] = x[5] + 0.05 * rng.standard_normal((300, 16))
    x /= np.linalg.norm(x, axis=1)[:, None]
    x[700:740] = x[40]  # ties
    rows = [(i, [float(v) for v in r], 0) for i, r in enumerate(x)]
    odd = [(1000, None, 0), (1020, [0.0] * 16, 0), (1040, [float("nan")] * 16, 0), (1060, [1.0, None] * 8, 0), (1080, [], 0), (None, [1.0] * 16, 0), (1100, [1.0, 2.0], 0)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, score int")
    got = {}
    for r in ann.nearest(df, block_rows=256, query_rows=16).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == set(range(0, 900, 20))
    right = 0
    for q, found in got.items():
        found.sort()
        s = x @ x[q]
        want = [int(i) for i in np.lexsort((np.arange(900), -s)) if i != q][:20]
        assert [f[0] for f in found] == list(range(1, 21)) and all(abs(s[f[1]] - f[2]) < 1e-12 for f in found)
        right += len(set(want) & {f[1] for f in found})
    assert right / (20 * len(got)) > 0.95
    assert [f[1] for f in got[40]] == list(range(700, 720))
    few = ann.nearest(df.where("vec_id < 5")).collect()
    assert sorted((r["query_id"], r["rank"]) for r in few) == [(0, 1), (0, 2), (0, 3), (0, 4)]
    assert ann.nearest(df.limit(0)).count() == 0
    huge = spark.createDataFrame([(0, [1e200, 0.0]), (1, [1e200, 1e199]), (2, [-1e200, 1.0]), (3, [1e150, 0.0])], "vec_id long, embedding array<double>")
    assert [(r["vec_id"], r["score"]) for r in ann.nearest(huge).orderBy("rank").collect()] == [(1, float("inf")), (3, float("inf")), (2, float("-inf"))]


def test_nearest_over_many_blocks(spark):
    """Most queries visit few of the blocks, whatever lies in one (a third of all rows are one vector), and recall holds."""
    rng = np.random.default_rng(7)
    centres = rng.standard_normal((40, 24)) * 3
    x = centres[rng.integers(0, 40, 6000)] + rng.standard_normal((6000, 24)) * 0.3
    x[rng.permutation(6000)[:2000]] = x[17]
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in ann.nearest(df, block_rows=200, query_rows=50, sample_rows=3000).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["score"]))
    assert set(got) == set(range(0, 6000, 20))
    right = 0
    for q, found in got.items():
        s = x @ x[q]
        s[q] = -np.inf
        best = np.sort(s)[::-1][:20]
        right += sum(score >= best[-1] - 1e-9 for _, score in found)
    assert right / (20 * len(got)) > 0.95


def test_chi_square():
    rng = np.random.default_rng(1)
    x = (rng.standard_normal((200_000, 8)) ** 2).sum(1)
    for at in (3.0, 8.0, 15.0):
        assert abs((x <= at).mean() - ann.chi2_cdf(np.array([at]))[0]) < 0.005


def test_pipeline(spark):
    docs = spark.read.parquet(f"{plain.SF}/documents.parquet")
    out = corpus_pipeline.run(spark, plain.SF)
    rows = out.collect()
    assert {r["doc_id"] for r in rows} <= {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert all(r["lossless"] for r in rows) and out.columns == [*docs.columns, "ids", "lossless"]
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{plain.SF}/benchmark.parquet").collect()]
    assert not any(hit for _, hit, _ in plain.contamination([(r["doc_id"], texts[r["doc_id"]]) for r in rows], items).values())
    left = [plain.shingles(texts[r["doc_id"]]) for r in rows]
    assert not any(plain.jaccard(a, b) >= 0.9 for k, a in enumerate(left) for b in left[:k])
    assert not any(plain.personal(r["text"]) for r in rows)


def test_stages_keep_clean_documents(spark):
    """Stage by stage against plain versions; the toxic ones are exactly those that the model says."""
    docs = spark.read.parquet(f"{plain.SF}/documents.parquet")
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{plain.SF}/benchmark.parquet").collect()]
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, plain.SF)
    sets = {i: plain.shingles(t) for i, t in text.items()}
    pairs = {(a, b): j for a in sets for b in sets if a < b and (j := plain.jaccard(sets[a], sets[b])) > 0.4}
    stay = {r["doc_id"] for r in kept.collect()}
    assert kept.columns == docs.columns
    assert stay >= set(text) - {x for p in pairs for x in p}, "documents like no other stay"
    found = [not (a in stay and b in stay) for (a, b), j in pairs.items() if j >= 0.8]
    assert sum(found) >= 0.95 * len(found) and stay & set(sets)
    kept = corpus_pipeline.drop_benchmark_leaks(spark, docs, plain.SF)
    assert {r["doc_id"] for r in kept.collect()} == {i for i, v in plain.contamination(text.items(), items).items() if not v[1]} and kept.columns == docs.columns
    kept = corpus_pipeline.drop_toxic(spark, docs, plain.SF)
    toxic = {r["doc_id"] for r in spark.read.parquet(f"{plain.SF}/labels.parquet").where("toxic = 1").collect()}
    left = {r["doc_id"] for r in kept.collect()}
    assert len(left) > 0.9 * len(text) - len(toxic) and kept.columns == docs.columns


CLASHES = ("severity", "grade", "toxic", "words", "spans", "redacted", "ids", "decoded", "lossless", "others", "fp", "th", "hit_id", "stays", "component_id", "Row", "a b")


def test_stages_keep_columns_of_any_name(spark, tmp_path):
    """Every stage on nulls, empty and long texts, repeated rows, empty tables, and columns with the names that operators make."""
    spark.createDataFrame([(0, 1), (1, 0)], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, "a passage of the benchmark that nobody should have in training data at all")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    texts = [(1, None), (2, ""), (3, "one text like no other " * 3), (3, "one text like no other " * 3), (None, "mail a.b@c.org"), (4, "words " * 20_000), (5, "x a passage of the benchmark that nobody should have in training data")]
    rows = [(i, t, len(t or ""), *(f"{c}{n}" for c in CLASHES)) for n, (i, t) in enumerate(texts)]
    fields = ", ".join(f"`{c}` string" for c in CLASHES)
    docs = spark.createDataFrame(rows, f"doc_id long, text string, n_chars long, {fields}")
    stays = {"toxicity": range(7), "near_duplicates": (0, 2, 3, 4, 5, 6), "decontamination": range(6), "personal_data": range(7), "sentencepiece": range(7)}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        path = str(tmp_path / name)
        out.write.parquet(path)
        got = spark.read.parquet(path)
        assert got.columns[: len(docs.columns)] == docs.columns
        assert got.columns[len(docs.columns) :] == (["ids_0", "lossless_0"] if name == "sentencepiece" else [])
        found = sorted(int(r["grade"].removeprefix("grade")) for r in got.collect())
        assert found == list(stays[name]), name
        for r in got.collect():
            n = int(r["grade"].removeprefix("grade"))
            assert [r[c] for c in CLASHES] == [f"{c}{n}" for c in CLASHES] and r["doc_id"] == texts[n][0]
            if name == "personal_data" and n == 4:
                assert (r["text"], r["n_chars"]) == ("mail [EMAIL]", 12)
            else:
                assert (r["text"], r["n_chars"]) == (texts[n][1], len(texts[n][1] or ""))
            assert name != "sentencepiece" or (r["lossless_0"] and bool(r["ids_0"]) == bool(texts[n][1]))
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0


def test_intermediate_tables_need_a_shared_folder(spark, monkeypatch):
    class Cluster:
        class sparkContext:  # noqa: N801
            master, applicationId = "yarn", "a"

        class conf:  # noqa: N801
            get = staticmethod(lambda key, other: other)

    with pytest.raises(RuntimeError, match="checkpoint"):
        common.shared_dir(Cluster)
    first = common.materialize(spark.range(3), "first")
    kept = common.settle(lambda: common.materialize(common.materialize(spark.range(3), "a").where("id > 0"), "b").where("id > 1"), "kept")
    assert kept.count() == 1 and first.count() == 3 and [p.rsplit("/", 1)[1].split("-")[0] for p in common._WRITTEN[-2:]] == ["first", "kept"]
