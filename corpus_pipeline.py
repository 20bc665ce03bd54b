"""Preparation of a training corpus: quality rules, line dedup, near-duplicates, mixing, packing.

Each stage works on all rows that the stage before has kept, and its decisions take effect: rejected documents go, dropped
lines leave the text, one document of each group of near copies stays, the mix repeats or cuts documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brillouin.llm.jaccard_join import jaccard_components
from brillouin.llm.line_dedup import dedup_lines
from brillouin.llm.mixing import expanded, mix_sources
from brillouin.llm.packing import pack_sequences
from brillouin.llm.quality import rate_quality
from brillouin.llm.shared import table, written


def _bundled(docs: DataFrame, *own: str) -> DataFrame:
    """The columns `own`, and all others in one column `row`, where their names clash with nothing."""
    return docs.select(*own, F.struct(F.lit(0).alias("__"), *(c for c in docs.columns if c not in own)).alias("row"))


def _unbundled(rows: DataFrame, columns: list[str], *own: str, **new: Column) -> DataFrame:
    return rows.select(*((new[c] if c in new else F.col(c) if c in own else F.col("row")[c]).alias(c) for c in columns))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep.

    Defined cases: null and empty texts have no words and go; repeated rows stay or go together; nulls in other columns change
    nothing; an empty table gives an empty table; extra columns pass through, whatever their names are (as in every stage but the last).
    """
    return _unbundled(rate_quality(_bundled(docs, "text")).where("kept"), docs.columns, "text")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that three or more share (but in the one with the largest id).

    Defined cases: a null text becomes empty; a null id is the smallest; repeated rows count as documents each and are treated alike;
    an empty table gives an empty table.
    """
    left = dedup_lines(_bundled(docs, "doc_id", "text"))
    return _unbundled(left, docs.columns, "doc_id", text=F.col("kept_text"), n_chars=F.length("kept_text").cast("long"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group linked at a Jaccard index of 0.8 of five-word shingles: that with the smallest id.

    Defined cases: rows decide, not ids: of repeated rows one stays, of two different texts with one id both can stay; null ids come last
    in a group and are linked like all others; texts without words are linked with nothing and stay; an empty table gives an empty table.
    """
    if docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 OR doc_id IS NULL").isEmpty():
        groups = jaccard_components(docs, n=5, threshold=(80, 100))
        return docs.join(groups.where("component_id = doc_id").select("doc_id"), "doc_id", "left_semi").select(docs.columns)
    keyed = written(_bundled(docs, "doc_id", "text").withColumn("key", F.monotonically_increasing_id()))
    groups = jaccard_components(keyed, id_col="key", n=5, threshold=(80, 100))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key"))["key"]
    kept = groups.select("key", "component_id").join(keyed.select("key", "doc_id"), "key").groupBy("component_id").agg(first.alias("key"))
    return _unbundled(keyed.join(kept, "key", "left_semi"), docs.columns, "doc_id", "text")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, as often as they are taken; the last row of a document at the edge of a budget is cut.

    Defined cases: documents without words are not taken; null is a source of its own; repeated rows are taken one by one; an empty
    table gives an empty table.
    """
    left = expanded(mix_sources(_bundled(docs, "doc_id", "source", "text")), ["doc_id", "source", "text", "row"])
    return _unbundled(left, docs.columns, "doc_id", "source", "text", n_chars=F.length("text").cast("long"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the training windows.

    Defined cases: a null or empty text is one id, its end; repeated rows are documents each; nulls in other columns change nothing; an empty table
    gives an empty table; no other column is read.
    """
    return pack_sequences(docs, tokenizer=public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality rules", quality), ("line dedup", lines), ("n-gram Jaccard join", near_copies), ("mixing", mixing), ("packing", packing)]

#: Posterior probabilities, the join of near copies and the tokenizer can't be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = written(docs)
    return docs
