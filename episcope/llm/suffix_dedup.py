"""Dedup of repeated 100-byte passages: difference-cover anchors on bytes.

This is the method of ``substring_dedup`` with bytes as units, not a suffix
sort: nothing is ranked, and no suffix is compared or ordered.  The anchors are
the 28-byte runs at the positions on a perfect difference cover modulo 73 (9
residues, 12 % of all positions).  Two equal windows of 100 bytes share an
equal anchor, so a window without an anchor that occurs again is no repeat.
64-byte runs around the repeated anchors sharpen this.  The remaining windows
are dealt into buckets as 64-bit hashes, and a bucket finds the first of each;
a task holds one bucket's hashes and never the text of other documents.

Removal only needs which windows are equal and which of them starts first; the
order among different suffixes never shows in the result.  See ``repeats`` for
the plan and for nulls, ties, repeated rows and clashing columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table
from .repeats import BLOCK_BYTES, Cover, remove_repeats

BYTES_100 = Cover("bytes", 100, 73, (0, 1, 3, 7, 15, 31, 36, 54, 63), refine=37)


def suffix_dedup(docs: DataFrame, cover: Cover = BYTES_100, id_col: str = "doc_id", text_col: str = "text",
                 block_bytes: int = BLOCK_BYTES, keep_text: bool = True, digest: bool = False) -> DataFrame:
    """Rows of ``docs`` with n_units (bytes), n_removed, n_spans and the kept bytes (binary)."""
    return remove_repeats(docs, cover, id_col, text_col, block_bytes, keep_text, digest)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return (suffix_dedup(docs, keep_text=False, digest=True)
            .select("doc_id", F.col("n_units").alias("n_bytes"), "n_removed", "n_spans", "kept_sha256"))
