"""Stages of the corpus pipeline: functions (spark, docs, sf_dir) -> DataFrame.

Every stage works on all documents that the stage before kept, whatever their
columns, and all but the last return the columns they were given.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from drover.llm import decontamination, language, near, packing, repeats
from drover.llm.queries import TOKENIZER, benchmark_items, held_out
from drover.llm.shipping import ship


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go.

    So do NULL and empty texts and those without a letter; repeated rows stay or go together.
    """
    ship(spark)
    model = language.fit(docs.where(~held_out(5)))
    return language.identify(docs, model).where("NOT rejected").select(docs.columns)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates the document with the least doc_id stays.

    Repeated rows with that id and text are kept once; NULL ids and texts without words all stay.
    """
    ship(spark)
    return near.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 200 bytes that occur again are cut out of the texts; every document stays.

    A text may become empty; NULL stays NULL; characters that are covered in part stay.
    """
    ship(spark)
    return repeats.remove_repeats(docs, repeats.find_repeats(docs))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of `benchmark` go.

    NULL and empty texts hold none and stay; equal texts stay or go together.
    """
    ship(spark)
    return decontamination.without_leaks(docs, benchmark_items(spark, sf_dir))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences with power-of-two lengths, with their token ids.

    NULL and empty texts give one sequence with the end alone; other columns are dropped.
    """
    ship(spark)
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("language-id", keep_known_languages),
    ("near-duplicates", keep_one_of_each_group),
    ("suffix-repeats", cut_repeats),
    ("decontamination", drop_leaks),
    ("packing", pack_sequences),
]
