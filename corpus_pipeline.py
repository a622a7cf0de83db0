"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read by the next.

language ID -> exact dedup -> SimHash near-dedup -> mixing to target weights -> best-fit packing.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refinery.llm.common import held_out, written
from refinery.llm.exactdedup import without_copies
from refinery.llm.langid import UNKNOWN, identify, learn
from refinery.llm.mixing import mix
from refinery.llm.packing import pack
from refinery.llm.simhash import near_dedup
from refinery.sources.tables import load

# A text whose n-grams are on average this near to the end of every list is in no learned language.
LEAST_SCORE = 0.1


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; those without a letter or far from every profile go."""
    profiles = learn(docs.filter(~held_out(F.col("doc_id"))))
    told = identify(docs, profiles, out=("__lang", "__score"))
    return told.filter((F.col("__lang") != UNKNOWN) & (F.col("__score") >= LEAST_SCORE)).select(*docs.columns)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts."""
    return without_copies(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component (three-word shingles, at most three bits)."""
    return near_dedup(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out by their fitted rates."""
    return mix(docs, load(spark, sf_dir, "labels"))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents, placed in sequences of 2048 tokens."""
    # the workers of the stages before are still there, so this one's encoder takes less memory than alone
    return pack(docs, memo=100_000, unit=1 << 20)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("exact_dedup", exact_duplicates),
    ("simhash_near_dedup", near_duplicates),
    ("mixing", mixed_sources),
    ("best_fit_packing", packed_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each but the last returns is written to the shared folder."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


# Language profiles, fitted rates and the tokenizer have no SQL form; the tests hold run() against plain versions.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
