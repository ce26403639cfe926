"""The operators of this package over the given tables, with their settings."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docengine.llm.lines import line_verdicts
from docengine.llm.minhash_join import near_copies
from docengine.llm.mixing import mix
from docengine.llm.oracle import DOCUMENTS, VECTORS
from docengine.llm.packing import packed
from docengine.llm.periods import periodic_runs, run_digests, with_planted_runs
from docengine.llm.quality import score
from docengine.llm.secrets import dictionary, reviewed, scan
from docengine.llm.sentence_pieces import encoded_digests
from docengine.llm.suffixes import passages
from docengine.llm.syncmers import fingerprints
from docengine.llm.url_lists import ORACLE as URL_ORACLE
from docengine.llm.url_lists import captures_of, dated_list, judge
from docengine.llm.vectors import near_vectors
from docengine.llm.whitening import whiten


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors(_table(spark, folder, "embeddings"))


def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_verdicts(_table(spark, folder, "documents"))


def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packed(_table(spark, folder, "documents"))


def op4_minhash_join(spark: SparkSession, folder: str) -> DataFrame:
    return near_copies(_table(spark, folder, "documents"), words=2, percent=80)


def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    return score(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op6_syncmers(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints(_table(spark, folder, "documents"))


def op7_secrets(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents")
    words = dictionary(_table(spark, folder, "benchmark").select("text"))
    return scan(documents, reviewed(documents, _table(spark, folder, "labels")), words)


def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mix(_table(spark, folder, "documents")).drop("source")


def op9_url_lists(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "pages").select("page_id", "url")
    return judge(captures_of(pages), dated_list(pages))


def op10_suffixes(spark: SparkSession, folder: str) -> DataFrame:
    return passages(_table(spark, folder, "documents"))


def op11_periods(spark: SparkSession, folder: str) -> DataFrame:
    return run_digests(periodic_runs(with_planted_runs(_table(spark, folder, "documents"))))


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whiten(_table(spark, folder, "embeddings"))


def op13_sentence_pieces(spark: SparkSession, folder: str) -> DataFrame:
    from public_tokenizers import path

    return encoded_digests(_table(spark, folder, "documents"), path("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_embedding_dedup": op1_embedding_dedup,
    "op2_line_dedup": op2_line_dedup,
    "op3_packing": op3_packing,
    "op4_minhash_join": op4_minhash_join,
    "op5_quality": op5_quality,
    "op6_syncmers": op6_syncmers,
    "op7_secrets": op7_secrets,
    "op8_mixing": op8_mixing,
    "op9_url_lists": op9_url_lists,
    "op10_suffixes": op10_suffixes,
    "op11_periods": op11_periods,
    "op12_whitening": op12_whitening,
    "op13_sentence_pieces": op13_sentence_pieces,
}

ORACLE: dict[str, str] = {
    "op1_embedding_dedup": VECTORS,
    "op4_minhash_join": DOCUMENTS,
    "op9_url_lists": URL_ORACLE,
}
