"""From raw documents to token ids: five operators of ``cinderfield.llm`` one after another."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cinderfield.llm import bpe_codec, decontamination, language_id, line_dedup, minhash
from cinderfield.llm.registry import RANKS
from cinderfield.scratch import settle


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be told; null texts and those without letters go. Repeated rows stay."""
    identify = language_id.identifier(docs, language_id.fit(docs))
    return docs.where(identify("text")["lang"] != language_id.UNDEFINED)


def remove_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that spread over many sources; only copies of whole documents keep them.

    Null texts stay null, and repeated rows stay.
    """
    cut = line_dedup.remove_lines(docs)
    changed = F.col("n_removed") > 0
    new = {
        "text": F.col("text"),
        "n_chars": F.when(changed, F.length("text").cast("long")).otherwise(F.col("row.n_chars")),
    }
    return cut.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near copies (0.8 on 5-word shingles).

    Rows that repeat an id and its text go too. Documents without words, and those
    without id, are copies of nothing and stay.
    """
    copies = settle(minhash.link(docs).where(~F.col("kept")).select("doc_id").distinct(), "copies")
    ids = docs.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    repeated = settle(ids.where(F.col("n") > 1).select("doc_id"), "repeated")
    left = docs.join(copies, "doc_id", "left_anti").select(*docs.columns)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    place = F.row_number().over(Window.partitionBy("row.doc_id", "row.text").orderBy(F.col("row.text")))
    again = left.join(repeated, "doc_id", "left_semi").select(row).withColumn("place", place)
    first = again.where(F.col("place") == 1).select("row.*")
    return left.join(repeated, "doc_id", "left_anti").select(*docs.columns).unionByName(first)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth are benchmark words; null texts hold none. Repeated rows stay."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the bytes they decode to; a null text has no tokens."""
    return bpe_codec.digests(docs, RANKS)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", remove_boilerplate),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("bpe_codec", encode),
]

#: Merging byte pairs by rank is not expressible in SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    *first, (_, last) = STAGES
    for name, stage in first:
        docs = settle(stage(spark, docs, sf_dir), name)
    return last(spark, docs, sf_dir)
