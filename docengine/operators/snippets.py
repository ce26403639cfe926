"""Text around a term, and chunks of text."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docengine.functions.fixed_values import CHUNK_LIMIT, CONTEXT_LINES
from docengine.functions.text import chunk_words, context_lines
from docengine.operators.columns import unfold


def context_snippets(
    documents: DataFrame, term: Column, k: int = CONTEXT_LINES
) -> DataFrame:
    """Replace `text` by its distinct lines within `k` lines of one holding `term`."""
    return documents.withColumn(
        "text", F.array_join(context_lines(F.col("text"), term, k), "\n")
    )


def chunk_text(
    documents: DataFrame, key: str = "doc_id", limit: int = CHUNK_LIMIT
) -> DataFrame:
    """`(key, chunk, chunk_text)`: greedy chunks of whole words."""
    chunks = F.transform(
        chunk_words(F.col("text"), limit),
        lambda c, i: F.struct(i.alias("chunk"), c.alias("chunk_text")),
    )
    return unfold(documents, [key], chunks, "chunk")
