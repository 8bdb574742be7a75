"""From raw documents to packed training sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; its result
is written as Parquet and read again as the next stage's ``docs``, so a lost
executor never costs more than its stage.  All but the last return the columns
of ``documents``, with ``text`` as the stage leaves it and ``n_chars`` counted
anew where the text changes.  A null text stays null and is rejected by the
first stage; a text left empty by a later stage stays a row (its one token is
the end id).  Rows with a null id take no part in line, near-duplicate and
substring matching and stay as they are.  Empty input gives empty output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tributary.llm.bpe import token_pieces
from tributary.llm.common import stage, table
from tributary.llm.langid import accepted, held_out, learn_dictionaries
from tributary.llm.line_dedup import drop_repeated_lines
from tributary.llm.pack_bestfit import pack
from tributary.llm.simhash import first_of_each
from tributary.llm.suffix_dedup import remove_repeats


def _with_text(df: DataFrame, columns: list[str], text: str = "text") -> DataFrame:
    """``columns`` of ``df`` with the given text, ``n_chars`` (where there is one) counted anew."""
    made = {"text": F.col(text), "n_chars": F.char_length(F.coalesce(F.col(text), F.lit(""))).cast("long")}
    return df.select(*(made[c].alias(c) if c in made else F.col(c) for c in columns))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told from their text; und and narrow margins go."""
    return accepted(docs, learn_dictionaries(docs.where(~held_out("doc_id"))))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of 40 code points or more found in 5 documents stay only in the largest id."""
    return _with_text(drop_repeated_lines(docs, min_chars=40, min_docs=5), docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest id) of each group within 4 bits of fingerprints of 4-word shingles."""
    return first_of_each(docs, k=4, distance=4)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every byte of a 100-byte string that starts earlier goes, characters whole."""
    return _with_text(remove_repeats(docs, depth=100), docs.columns, "kept_text")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of at most 1024 ids and their places in sequences."""
    pieces = token_pieces(docs, capacity=1024, end_id=2)
    return pack(pieces, capacity=1024, order_by=("doc_id", "piece", "ids_crc32"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("best_fit_packing", best_fit_packing),
]

#: SQL can't express the stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, f in STAGES:
        docs = stage(f(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
