"""The corpus pipeline: stages in order, each written and read again by the next."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docengine.llm.lines import without_repeats
from docengine.llm.minhash_join import near_copies
from docengine.llm.mixing import mixed
from docengine.llm.packing import packed
from docengine.llm.quality import good
from docengine.sources.workspace import RunFolder


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_repeats(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays; rows that repeat a doc_id stay or go together."""
    found = near_copies(docs, words=5, percent=80)
    gone = found.where("not kept").select("doc_id").distinct()
    # The documents' columns travel in one, so that no name of theirs can clash.
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(whole, F.col("doc_id").cast("long").alias("doc_id"))
    return rows.join(gone.hint("merge"), "doc_id", "left_anti").select("row.*")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packed(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("lines", lines),
    ("near", near),
    ("mixing", mixing),
    ("packing", packing),
]

# Learned scores and token ids are beyond SQL; tests hold the stages against plain models.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = RunFolder(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (name, stage) in enumerate(STAGES):
        docs = folder.write(stage(spark, docs, sf_dir), f"{at}-{name}")
        if at:
            folder.drop(f"{at - 1}-{STAGES[at - 1][0]}")
    return docs
