"""A training-corpus pipeline: quality filter, line dedup, near dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept, and returns a
DataFrame that is written as Parquet and read again as the docs of the next one. Tables that a stage
keeps for its result are deleted when the next stage is called, so the result has to be written by then.

Nulls, empty and repeated rows have the results that the operators state: a null text is an empty one, rows
are judged by their texts whatever their ids, and an empty table gives an empty one. Columns beside
those of documents are dropped.
"""

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from modlake.llm.store import drop_paths, stored, written_since

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
_scratch: list[str] = []


def stage(function: Callable) -> Callable:
    """The stage, which first deletes what the stage before it has kept."""

    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        drop_paths(spark, _scratch)
        with written_since() as paths:
            out = function(spark, docs, sf_dir)
        _scratch[:] = paths
        return out

    return run_stage


@stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from the labels beside the documents."""
    from modlake.llm.quality import keep_good

    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).select(*COLUMNS)


@stage
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that occur in several documents stay in the first only; n_chars follows the text."""
    from pyspark.sql import functions as F

    from modlake.llm.line_dedup import drop_repeated_lines

    return drop_repeated_lines(docs).withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


@stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest doc_id."""
    from modlake.llm.simhash_dedup import drop_near_copies

    return drop_near_copies(docs).select(*COLUMNS)


@stage
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled so that sources, languages and forms of text get nearer to equal shares."""
    from modlake.llm.mixing import mix

    return mix(docs).select(*COLUMNS)


@stage
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 4096 token ids at most: one row for each piece of a document, with its ids."""
    import public_tokenizers

    from modlake.llm.packing import pack

    # executors hold what the stages before have left in their heaps, so a worker remembers a quarter of what packing by itself does
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"), times=0.5, slice_bytes=1 << 20)


STAGES = [
    ("quality classifier", quality),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("mixing sources to target weights", mixing),
    ("packing", packing),
]

#: SQL has no form for the trained classifier, the covering search or the tokenizer of these stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs, f"stage{k}")
    return docs
