"""A training-data pipeline over documents: quality, near-duplicates, secrets, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next one's docs. All but the last return the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tenderlake.llm import queries, quality_rules, secret_scan, simhash_dedup, source_mix
from tenderlake.llm.common import written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules' posterior keeps.

    Each row is judged by its text alone. Null and empty texts and those of fewer
    than 10 words go; nulls elsewhere, repeated rows and ties change no verdict.
    """
    return quality_rules.only_kept(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, also of groups without doc_id.

    The smallest doc_id stays, of rows alike in it one. Null texts and those
    without words are one group. Columns stay, whatever their names; an empty
    table gives an empty one.
    """
    return simhash_dedup.one_of_each(docs, without_id=True)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark.

    Null texts stay null, empty ones empty; very long ones are scanned whole and
    repeated rows alike. Other columns, whatever their names, stay as they are.
    An empty table gives an empty one.
    """
    return secret_scan.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, better ones first by the rules' posterior.

    Null is a source of its own. Documents without words have size 0 and go with
    the epochs and keys like others. Of rows alike in id, text and source, where
    the target's edge falls among them, as many are taken as come nearest to it.
    Columns stay as they are.
    """
    tag = ""
    while {f"quality{tag}", f"words{tag}"} & {c.lower() for c in docs.columns}:  # names of their own for the weight and the size
        tag += "_"
    weight, size = f"quality{tag}", f"words{tag}"
    return source_mix.repeated(quality_rules.posteriors(docs, out=weight, words=size), quality=weight, size=size)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded text, a row for each document taken.

    Null and empty texts have no ids and an empty text; repeated rows a row each.
    No other column is read, whatever its name. An empty table gives no rows.
    """
    return queries.codec_digest(docs)


STAGES = [("quality rules", quality), ("near-duplicates", near_duplicates), ("secret scan", secrets), ("source mix", mixture), ("bpe codec", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, name.replace(" ", "-"))
    return docs


#: Fingerprints, sampling keys and token ids have no SQL form; the stages are tested against brute force instead.
ORACLE_SQL = None
