"""Corpus pipeline: toxicity, near-duplicates, benchmark decontamination, personal data, tokenisation.

Each stage takes the documents that its predecessor kept and returns what it keeps, with the columns of documents; the
last one adds token ids. Documents need doc_id and text; whatever other columns they have, of whatever names, stay as they
are. In every stage a null text counts as empty, rows that repeat are judged alike, and an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellquant.llm import decontam, pieces, pii, simhash, toxicity
from cellquant.llm.common import fresh, settle

#: SQL cannot express a trained model or a seeded segmentation; the stages are tested against plain versions instead.
ORACLE_SQL = None
_OWN = ("doc_id", "text")


def _packed(docs: DataFrame) -> DataFrame:
    """doc_id, text and all other columns as one, so that none has the name of a column that an operator makes."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in _OWN]
    return docs.select(*_OWN, F.struct(*(others or [F.lit(0).alias("none")])).alias("others"))


def _unpacked(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.select(*(F.col(c) if c in _OWN else F.col("others").getField(c).alias(c) for c in columns))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal model does not hold toxic; null and empty texts stay. Without labels of both classes all
    stay."""
    model = toxicity.train_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _unpacked(toxicity.score_toxicity(_packed(docs), model).where(~F.col("toxic")), docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones (five-word shingles, 0.8 or more): the one whose doc_id names the group,
    the least. Null, empty and wordless texts are one group. Rows that repeat a doc_id all stay or all go."""
    stays = fresh(docs, "stays")
    found = simhash.similar_documents(docs)
    kept = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias(stays)).distinct()
    return docs.join(kept, F.col("doc_id").eqNullSafe(F.col(stays)), "left_semi")


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any occurrence of a benchmark window; null, empty and wordless texts stay. Rows that share a doc_id
    are judged each by its own text. An empty benchmark drops nothing."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    index = decontam.build_index(docs)
    found = decontam.hits(index, docs, benchmark, decontam.term_counts(index, benchmark))
    hit_id, hit_hash = fresh(docs, "hit_id"), fresh(docs, "hit_hash")
    hit = found.select(F.col("doc_id").alias(hit_id), F.col("text_hash").alias(hit_hash))
    return docs.join(hit, F.col("doc_id").eqNullSafe(F.col(hit_id)) & (F.xxhash64("text") == F.col(hit_hash)), "left_anti")


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind in brackets; n_chars, if there is one, follows a text that
    changed. A null text stays null."""
    found = pii.find_pii(_packed(docs), pii.train_pii(docs))
    made = {"doc_id": F.col("doc_id"), "text": F.col("redacted").alias("text")}
    if "n_chars" in docs.columns:
        n_chars = F.when(F.col("text") != F.col("redacted"), F.length("redacted").cast(docs.schema["n_chars"].dataType))
        made["n_chars"] = F.coalesce(n_chars, F.col("others.n_chars")).alias("n_chars")
    return found.select(*(made.get(c, F.col("others").getField(c).alias(c)) for c in docs.columns))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their token ids; each row is decoded again and lossless says that nothing was lost. Null and empty
    texts have no ids. Where documents have columns of these names, the new ones get a number."""
    coded = pieces.encode(_packed(docs), decoded=True)
    ids, lossless = fresh(docs, "ids"), fresh(docs, "lossless")
    same = F.col("decoded") == F.coalesce("text", F.lit(""))
    kept = (F.col(c) if c in _OWN else F.col("others").getField(c).alias(c) for c in docs.columns)
    return coded.select(*kept, F.col("ids").alias(ids), same.alias(lossless))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("personal_data", redact_personal_data),
    ("sentencepiece", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each one's rows written and read again before the next; what a stage wrote on the way is
    deleted then."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(lambda stage=stage, docs=docs: stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
