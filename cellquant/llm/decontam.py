"""Benchmark decontamination with a stored positional inverted index, in DataFrame functions only.

Training tokens become postings (term, row, pos), written once as a table that counts, phrases and proximity all read.
The index is sharded by document: each shard is sorted by the term's hash, one long, and holds all postings of its rows, so
writing it shuffles nothing, a scan for some terms skips the other row groups, and a frequent term is spread over all
shards. Terms are looked up by hash and then compared.

Each benchmark window is looked up by its rarest terms: their postings, shifted back by the term's offset in the window,
must meet at one start. What meets is verified word by word against the document, so a result is exact whatever the index
offers.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cellquant.llm.common import ascii_lower, fresh, materialize

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: what stands between words while A-Z are not lower-cased yet: the rest of ASCII
BETWEEN = "".join(c for c in map(chr, range(128)) if not c.isalnum())
#: looked-up terms beyond which they are dealt to salted shuffles instead of a broadcast, and the salts
BROADCAST_ROWS, SALTS = 200_000, 32
#: shards that the rows of one part of the documents are dealt to and sorted by, one after another
SLICES = 4


def words_of(text: str) -> Column:
    """Words of a text column, A-Z lower-cased; null has none."""
    return F.coalesce(F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def cased_words(text: str) -> Column:
    """As ``words_of``, with A-Z as they are; null if the text is. What stands between words is cut off at both ends, so that
    no part of the split is empty but that of a text without words."""
    inner = F.btrim(F.col(text), F.lit(BETWEEN))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, f"[{re.escape(BETWEEN)}]+"))


def lowered(term: str) -> Column:
    """A-Z of a word lower-cased; ``lower`` does just that to ASCII, and ``translate``, character by character, to the rest."""
    return F.when(F.octet_length(term) == F.length(term), F.lower(term)).otherwise(ascii_lower(term))


@dataclass(frozen=True)
class PositionalIndex:
    """``postings``: (h, term, row, pos), h the term's hash, pos from 0. ``records``: (row, doc_id, text_hash, n_words) of every document row.
    Rows that share doc_id and text_hash are alike and get the same results."""

    postings: DataFrame
    records: DataFrame


def _postings(documents: DataFrame, slices: int, k: int) -> DataFrame:
    """The sorted postings of every document row whose hash names slice ``k``; each row has a number that no other slice has."""
    own = documents.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(slices)) == k)
    row = F.monotonically_increasing_id() * slices + k
    rows = own.select(row.alias("row"), "doc_id", F.xxhash64("text").alias("text_hash"), F.concat(F.coalesce(cased_words("text"), F.array().cast("array<string>")), F.array(F.lit(None).cast("string"))).alias("ws"))
    each = rows.select("row", "doc_id", "text_hash", F.posexplode("ws").alias("pos", "cased")).select("*", lowered("cased").alias("term"))
    last = F.col("term").isNull()
    slim = each.select(F.xxhash64("term").alias("h"), "term", "row", "pos", F.when(last, F.col("doc_id")).alias("doc_id"), F.when(last, F.col("text_hash")).alias("text_hash"))
    return slim.sortWithinPartitions("h")


def build_index(documents: DataFrame) -> PositionalIndex:
    """Write the index of all words of (doc_id, text). Null and empty texts have a record and no postings; rows that repeat
    each have their own; an empty table gives an empty index.

    A document's record is stored as one more posting: behind its last word, without a term. A task sorts its shards one
    after another into one file, so it holds the postings of one of them at a time. Each slice reads ``documents`` again,
    which costs less than to shuffle their texts: store them first if they are dear to make."""
    parts = max(1, documents.rdd.getNumPartitions())
    shards = reduce(DataFrame.unionAll, [_postings(documents, SLICES, k) for k in range(SLICES)])
    stored = materialize(shards.coalesce(parts), "postings")
    return PositionalIndex(
        stored.where("term IS NOT NULL").select("h", "term", "row", "pos"),
        stored.where((F.col("h") == F.xxhash64(F.lit(None).cast("string"))) & F.col("term").isNull()).select("row", "doc_id", "text_hash", F.col("pos").cast("long").alias("n_words")),
    )


def benchmark_windows(benchmark: DataFrame, width: int = 10) -> DataFrame:
    """Distinct windows (win, w, words, items): ``width`` consecutive words of an item; a shorter item is one window. Written,
    so that a window keeps its number."""
    words = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words_of("text").alias("ws")).where(F.size("ws") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("ws") - width + 1, F.lit(1)))
    each = words.select("item", F.explode(F.transform(starts, lambda i: F.slice("ws", i, F.lit(width)))).alias("words"))
    distinct = each.groupBy(F.array_join("words", " ").alias("w")).agg(F.first("words").alias("words"), F.array_sort(F.collect_set("item")).alias("items"))
    return materialize(distinct.select(F.monotonically_increasing_id().alias("win"), "w", "words", "items"), "windows")


def _meet(postings: DataFrame, asked: DataFrame) -> DataFrame:
    """Postings with the rows of ``asked`` for their term. Few asked rows are broadcast; otherwise both sides are salted by
    document, so that a term's postings never meet in one task."""
    asked = asked.withColumnRenamed("term", "asked").withColumn("h", F.xxhash64("asked"))
    if asked.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        met = postings.join(F.broadcast(asked), "h")
    else:
        salted = asked.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = postings.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int")).join(salted, ["h", "salt"]).drop("salt")
    return met.where(F.col("term") == F.col("asked")).drop("h", "asked")


def term_counts(index: PositionalIndex, benchmark: DataFrame) -> DataFrame:
    """(term, count) of the benchmark's terms that occur in the documents. Written: searches rank terms by it."""
    terms = benchmark.select(F.explode(words_of("text")).alias("term")).distinct()
    return materialize(_meet(index.postings.select("h", "term", "row"), terms).groupBy("term").agg(F.count(F.lit(1)).alias("count")), "term-counts")


def phrase_candidates(index: PositionalIndex, windows: DataFrame, counts: DataFrame, anchors: int = 2) -> DataFrame:
    """(row, start, win) where the shifted postings of a window's ``anchors`` rarest terms all meet; windows with a term that
    no document holds have none."""
    places = windows.select("win", F.posexplode("words").alias("offset", "term"))
    by_window = Window.partitionBy("win")
    ranked = places.join(counts, "term", "left").withColumns(
        {"rank": F.row_number().over(by_window.orderBy("count", "term", "offset")), "missing": F.max(F.col("count").isNull()).over(by_window), "size": F.count(F.lit(1)).over(by_window)}
    )
    seeds = materialize(ranked.where(~F.col("missing") & (F.col("rank") <= anchors)).select("win", "term", "offset", F.least("size", F.lit(anchors)).alias("n")), "window-anchors")
    met = _meet(index.postings, seeds).groupBy("row", (F.col("pos") - F.col("offset")).alias("start"), "win", "n").agg(F.count(F.lit(1)).alias("found"))
    return met.where((F.col("found") >= F.col("n")) & (F.col("start") >= 0)).select("row", "start", "win")


def phrase_matches(index: PositionalIndex, documents: DataFrame, windows: DataFrame, counts: DataFrame, anchors: int = 2) -> DataFrame:
    """(doc_id, text_hash, start, size, win) of every exact occurrence of a window: candidates whose words stand in the text."""
    found = phrase_candidates(index, windows, counts, anchors).join(windows.select("win", F.size("words").alias("size")), "win")
    by_doc = found.join(index.records, "row").groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("start", "size", "win")).alias("found"))
    texts = documents.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("th"), "text")
    both = texts.join(by_doc, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("th") == F.col("text_hash"))).select("doc_id", "text_hash", words_of("text").alias("ws"), "found")
    read = F.transform("found", lambda c: F.struct(c.start.alias("start"), c["size"].alias("size"), c.win.alias("win"), F.array_join(F.slice("ws", c.start + 1, c["size"]), " ").alias("w")))
    return both.select("doc_id", "text_hash", F.inline(read)).join(windows.select("win", "w"), ["win", "w"]).select("doc_id", "text_hash", "start", "size", "win").distinct()


def _covered(spans: Column) -> Column:
    """How many places the spans (start, stop) cover, overlaps once."""
    first = F.struct(F.lit(0).alias("upto"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(F.array_sort(spans), first, lambda a, c: F.struct(F.greatest(a["upto"], c["stop"]).alias("upto"), (a["n"] + F.greatest(F.lit(0), c["stop"] - F.greatest(a["upto"], c["start"]))).alias("n")), lambda a: a["n"])


def hits(index: PositionalIndex, documents: DataFrame, benchmark: DataFrame, counts: DataFrame, *, width: int = 10, anchors: int = 2) -> DataFrame:
    """(doc_id, text_hash, n_hit, item_ids) of contaminated documents: words inside any occurrence of a window, and the
    sorted ids of the items with occurring windows."""
    windows = benchmark_windows(benchmark, width)
    matches = materialize(phrase_matches(index, documents, windows, counts, anchors), "phrase-matches")
    covered = matches.groupBy("doc_id", "text_hash").agg(_covered(F.collect_set(F.struct("start", (F.col("start") + F.col("size")).alias("stop")))).alias("n_hit"))
    items = matches.select("doc_id", "text_hash", "win").distinct().join(windows.select("win", F.explode("items").alias("item")), "win")
    named = items.groupBy(F.col("doc_id").alias("id"), F.col("text_hash").alias("th")).agg(F.array_sort(F.collect_set("item")).alias("item_ids"))
    return covered.join(named, F.col("doc_id").eqNullSafe(F.col("id")) & F.col("text_hash").eqNullSafe(F.col("th"))).select("doc_id", "text_hash", "n_hit", "item_ids")


def decontaminate(documents: DataFrame, benchmark: DataFrame, *, width: int = 10, anchors: int = 2) -> DataFrame:
    """Every document row with its exact phrase matches.

    Adds n_words, n_hit (words inside any occurrence of a window), item_ids (sorted as strings) of the items with
    occurring windows, and contaminated (n_hit > 0). Other columns stay, unless they have one of these names.

    A null or empty text has no words. Rows that share a doc_id (null too) are judged each by its own text, and repeated
    rows stay. A null item_id counts as the empty string. An empty benchmark, or one without words, hits nothing; an empty
    table gives an empty result.
    """
    made = ("n_words", "n_hit", "item_ids", "contaminated")
    kept = [c for c in documents.columns if c not in made]
    index = build_index(documents.select("doc_id", "text"))
    found = hits(index, documents.select("doc_id", "text"), benchmark, term_counts(index, benchmark), width=width, anchors=anchors)
    own_id, own_hash, th = (fresh(documents, x) for x in ("id", "hash", "th"))
    found = found.select(F.col("doc_id").alias(own_id), F.col("text_hash").alias(own_hash), "n_hit", "item_ids")
    rows = documents.select(*kept, F.xxhash64("text").alias(th)).join(found, F.col("doc_id").eqNullSafe(F.col(own_id)) & (F.col(th) == F.col(own_hash)), "left")
    return rows.select(*kept, F.size(words_of("text")).cast("long").alias("n_words"), *_filled())


def _filled() -> tuple[Column, ...]:
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return n_hit.alias("n_hit"), F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"), (n_hit > 0).alias("contaminated")


def proximity_matches(index: PositionalIndex, benchmark: DataFrame, counts: DataFrame, *, terms: int = 3, within: int = 20) -> DataFrame:
    """(row, item, start, end): places where an item's ``terms`` rarest distinct terms all stand within ``within`` words, in
    any order; one row for each minimal end.

    The posting lists of the rarest terms are merged by a window over (row, item): at each posting the last place of
    every term is known, and the oldest of them bounds the span. Items with fewer distinct terms use all they have; terms
    that no document holds are passed over. A null item_id counts as the empty string.
    """
    item_terms = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.explode(words_of("text")).alias("term")).distinct()
    by_item = Window.partitionBy("item")
    ranked = item_terms.join(counts, "term").withColumn("rank", F.row_number().over(by_item.orderBy("count", "term"))).where(F.col("rank") <= terms)
    picked = materialize(ranked.select("item", "term", "rank", F.max("rank").over(by_item).alias("n")), "proximity-terms")
    merged = _meet(index.postings, picked)
    upto = Window.partitionBy("row", "item").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    last = [F.last(F.when(F.col("rank") == r, F.col("pos")), ignorenulls=True).over(upto) for r in range(1, terms + 1)]
    merged = merged.withColumns({f"last_{r}": c for r, c in enumerate(last, 1)})
    lasts = [F.col(f"last_{r}") for r in range(1, terms + 1)]
    full = reduce(lambda a, b: a & b, [(F.col("n") < r) | c.isNotNull() for r, c in enumerate(lasts, 1)])
    start = F.array_min(F.array(*lasts))  # nulls are passed over
    return merged.where(full).select("row", "item", start.cast("long").alias("start"), F.col("pos").cast("long").alias("end")).where(F.col("end") - F.col("start") < within)


def decontamination_report(documents: DataFrame, benchmark: DataFrame, *, width: int = 10, anchors: int = 2, terms: int = 3, within: int = 20) -> DataFrame:
    """(doc_id, n_words, n_hit, item_ids, contaminated, n_near) of every row, all from one index: as ``decontaminate``, and
    of how many items the rarest terms stand together somewhere."""
    index = build_index(documents)
    counts = term_counts(index, benchmark)
    found = hits(index, documents, benchmark, counts, width=width, anchors=anchors).select(F.col("doc_id").alias("id"), F.col("text_hash").alias("th"), "n_hit", "item_ids")
    near = proximity_matches(index, benchmark, counts, terms=terms, within=within).groupBy("row").agg(F.count_distinct("item").alias("n_near"))
    rows = index.records.join(near, "row", "left").join(found, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("th")), "left")
    return rows.select("doc_id", "n_words", *_filled(), F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"))


def decontamination_digest(report: DataFrame) -> DataFrame:
    return report.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
        "n_near",
    )
