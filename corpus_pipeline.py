"""A corpus pipeline of five stages, each of which applies one operator of ``bibweave.llm``.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bibweave.llm import bpe, langid, minhash, mixing, pii
from bibweave.llm.queries import vocabulary
from bibweave.scratch import Scratch
from bibweave.sources.files import numbered_rows, spread

#: Models of characters, rules and random orders can't be written as SQL.
ORACLE_SQL = None
#: A column that only stands between language identification and its filter.
SCORE = "_lang_score_of_this_stage"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter (``und``) go; the others carry the language found in ``lang``.

    Null and empty texts have no letter. Repeated rows each stay; further columns are handed on.
    """
    model = langid.fit(docs.where(~langid.held_out()))
    found = langid.identify(docs.drop("lang"), model, lang="lang", probability=SCORE).where(F.col("lang") != langid.UND)
    return found.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest doc_id.

    Texts without words are alike to none; rows that repeat a doc_id are one document; rows without a doc_id stay.
    """
    return minhash.deduplicate(docs)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data give way to their kind; n_chars follows (null for a null text). All rows stay."""
    return pii.redact(docs).withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, as often as the mix takes them; texts without words are never taken."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row, with the check that they decode to its text, in training order.

    ``position`` (0, 1, ...) is the place of the row among the rows of ``docs``,
    which the stage before wrote in training order; ``take`` says how often the
    document came before. Rows without a doc_id are each a document of their own.
    Null and empty texts have no ids.
    """
    scratch = Scratch(spark)
    return bpe.round_trip_in_order(numbered_rows(docs, "position", scratch), vocabulary(), "position", "take", scratch)


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("redact_pii", redact_pii), ("mix_sources", mix_sources), ("encode", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, from the table documents."""
    scratch = Scratch(spark)
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    for i, (_, stage) in enumerate(STAGES):
        done = stage(spark, docs, sf_dir)
        docs = done if i == len(STAGES) - 1 else scratch.save(done)
    return docs
