"""Substring dedup: difference-cover anchors over words.

Anchors are 8-word runs at the word positions that are 0, 1, 3 or 9 modulo 13
(a perfect difference cover), so two equal 20-word windows always share one;
windows around shared anchors are then compared whole.  See ``repeats`` for
the plan and for nulls, ties, repeated rows and clashing columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table
from .repeats import BLOCK_BYTES, Cover, remove_repeats

WORDS_20 = Cover("words", 20, 13, (0, 1, 3, 9))


def substring_dedup(docs: DataFrame, cover: Cover = WORDS_20, id_col: str = "doc_id", text_col: str = "text",
                    block_bytes: int = BLOCK_BYTES, keep_text: bool = True, digest: bool = False) -> DataFrame:
    """Rows of ``docs`` with n_units (words), n_removed, n_spans and the kept words."""
    return remove_repeats(docs, cover, id_col, text_col, block_bytes, keep_text, digest)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return (substring_dedup(docs, keep_text=False, digest=True)
            .select("doc_id", F.col("n_units").alias("n_words"), "n_removed", "kept_sha256"))
