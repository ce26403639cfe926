"""Documents out of page texts."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docengine.functions.text import join_in_order, strip


def unprocessed(documents: DataFrame, done: DataFrame, key: str = "doc_id") -> DataFrame:
    """Documents that have no finished text yet."""
    return documents.join(done.select(key), key, "left_anti")


def page_flags(pages: DataFrame, documents: DataFrame | None = None) -> DataFrame:
    """`(doc_id, scanned)`: whether no page of the document has native text.

    A document of `documents` without any page counts as scanned.
    """
    empty = F.coalesce(F.col("native_text"), F.lit("")) == ""
    flags = pages.groupBy("doc_id").agg(F.every(empty).alias("scanned"))
    if documents is not None:
        flags = documents.select("doc_id").join(flags, "doc_id", "left")
    return flags.select("doc_id", F.coalesce("scanned", F.lit(True)).alias("scanned"))


def assemble_documents(
    pages: DataFrame,
    done: DataFrame | None = None,
    cleaned: DataFrame | None = None,
    delimiter: str = "",
) -> DataFrame:
    """`(doc_id, scanned, text)`: page texts joined in page order.

    `pages(doc_id, page_no, native_text, ocr_text)`; the scan text is used only when
    no page has native text, and `cleaned(doc_id, text)` replaces it where given.
    Finished documents (`done`) are left out before their pages are moved.  A
    document's text is one value of the result, so its pages meet in one row.
    """
    if done is not None:
        pages = unprocessed(pages, done)
    native = F.coalesce(F.col("native_text"), F.lit(""))
    # Scan text is dropped here from documents' pages that need none.
    ocr = F.when(native == "", F.coalesce(F.col("ocr_text"), F.lit(""))).otherwise("")
    joined = pages.groupBy("doc_id").agg(
        F.every(native == "").alias("scanned"),
        F.collect_list(
            F.struct("page_no", native.alias("native"), ocr.alias("ocr"))
        ).alias("parts"),
    )
    text = F.when(
        F.col("scanned"), join_in_order(F.col("parts"), delimiter, "ocr")
    ).otherwise(join_in_order(F.col("parts"), delimiter, "native"))
    out = joined.select("doc_id", "scanned", text.alias("text"))
    if cleaned is not None:
        better = cleaned.select("doc_id", strip(F.col("text")).alias("_clean"))
        out = out.join(better, "doc_id", "left").select(
            "doc_id",
            "scanned",
            F.when(F.col("scanned"), F.coalesce("_clean", "text"))
            .otherwise(F.col("text")).alias("text"),
        )
    return out


def prefer_scan_text(native: DataFrame, scanned: DataFrame) -> DataFrame:
    """`(doc_id, text)` of both tables; text from a scan replaces native text."""
    return (
        native.select("doc_id", F.col("text").alias("_native"))
        .join(scanned.select("doc_id", F.col("text").alias("_scan")), "doc_id", "full")
        .select("doc_id", F.coalesce("_scan", "_native").alias("text"))
    )
