"""The corpus pipeline: from raw documents to packed training sequences.

Five stages, each calling one operator on all that the stage before kept:

1. toxicity: documents scored 0.3 or more go;
2. quality_rules: documents that the base rule or a learned rule rejects go;
3. near_duplicates: of each group of near-duplicates (five-word shingles,
   similarity 0.8) the document of the smallest id stays;
4. substring_dedup: words under a 20-word window that starts earlier go;
   documents that lose none keep their text as it is;
5. packing: token ids are cut into sequences of 4096.

All stages but the last return the columns of ``documents``.  Null texts are
clean and empty (the quality rules reject them), rows with a null id are
nobody's near-duplicate, and rows that repeat an id stay or go together.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from episcope.llm.common import quoted, read_table
from episcope.llm.minhash import near_duplicates
from episcope.llm.packing import pack
from episcope.llm.quality_rules import quality_filter
from episcope.llm.repeats import decode_kept
from episcope.llm.substring_dedup import substring_dedup
from episcope.llm.toxicity import score, train
from episcope.session import release_scratch, scratch_mark, scratch_path

TOXIC = 0.3


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = train(docs, read_table(spark, sf_dir, "labels"))
    scored = score(docs, model, out_col="__toxicity")
    return scored.where(F.col("__toxicity") < TOXIC).select(*quoted(docs))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_filter(docs, read_table(spark, sf_dir, "labels"))[0]


def near_duplicate_groups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    gone = near_duplicates(docs, words=5, percent=80).where(~F.col("kept")).select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(*quoted(docs))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # The other columns travel as one struct, so that none clashes with the operator's results.
    rest = [c for c in docs.columns if c.lower() not in ("doc_id", "text", "n_chars")]
    others = F.struct(F.lit(True).alias("__"), *[c for n, c in zip(docs.columns, quoted(docs)) if n in rest])
    cut = substring_dedup(docs.select("doc_id", "text", others.alias("__rest")))
    text = decode_kept("text")
    made = {"doc_id": F.col("doc_id"), "text": text, "n_chars": F.char_length(text).cast("long")}
    return cut.select(*[made.get(c.lower(), F.col("__rest")[c]).alias(c) for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicate_groups),
    ("substring_dedup", repeated_passages),
    ("packing", packing),
]

#: Learned models, sketches and token ids are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the documents that all stages keep.

    Each stage's rows are stored; what it wrote on the way is then released.
    """
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        mark = scratch_mark()
        kept = stage(spark, docs, sf_dir)
        kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
        release_scratch(spark, since=mark)
    return STAGES[-1][1](spark, docs, sf_dir)
