"""A training corpus from raw documents, in five stages, each written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from casemill.llm import decontam, mixing, near_dedup, token_output, toxicity
from casemill.llm.files import remove
from casemill.llm.shared import materialize, new_path, scratch


# Each stage takes nulls in any column, empty and very long texts, ties, repeated rows, empty tables, and columns of any names,
# also of those that the operators use themselves. All but the last return docs' own columns, in which nothing is changed.


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't predicted toxic.

    Null and empty texts score the share of toxic labels, and go only if that is 0.3 or more. Very long texts are scored whole. Equal
    rows stay or go together. Of an empty table nothing is left; without labels for its documents all stay.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.ordinary_of(docs, toxicity.learn(docs, labels))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that with the smallest id.

    Texts without words, null ones included, are copies of nothing: all stay. Of rows equal in id and text one stays, whichever. A
    null id stays only if its group has no other. Very long texts are compared whole. An empty table stays empty.
    """
    return near_dedup.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items.

    Null and empty texts hold none and stay; null and empty items are never found. Very long texts are searched whole. Equal rows stay or
    go together. An empty table stays empty, and an empty benchmark drops nothing.
    """
    return decontam.clean_of(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks for, in the order of training along the curriculum.

    A null source is a source of its own. Null and empty texts have no words; they are taken, or not, with their source's whole passes.
    Repeated rows are taken each by itself, ties in the order follow the digest of the id. Very long texts are taken whole
    or not at all. An empty table stays empty.
    """
    return mixing.mixed_rows(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shards of token ids; the rows tell where each document's ids are.

    A null or empty text has the end id only. Null ids come first; rows of one id follow each other, by the hash of their text, and
    repeated rows are written each. Very long texts are one document of one shard. An empty table has no shards and no rows.
    """
    shards = token_output.write_shards(docs, token_output.tokenizer_path(), new_path(spark, "tokens"))
    return token_output.read_shards(shards)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_output", write_tokens),
]

#: SQL can't express the stages: tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before: list[str] = []
    for name, stage in STAGES:
        with scratch() as made:
            docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
        # What the stage wrote on its way, and its input, isn't needed any more once its result is there.
        for path in (*before, *made[:-1]):
            remove(path)
        before = made[-1:]
    return docs
