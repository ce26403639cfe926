"""Summaries and the showcase table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docengine.functions.fixed_values import (
    BUNDLES,
    FLAG_COLUMN,
    NOT_AVAILABLE,
    SHOWCASE_COLUMNS,
    SUMMARY_FIELDS,
    WHOLE_TEXT_COLUMN,
)
from docengine.functions.responses import read_fields
from docengine.functions.text import strip
from docengine.operators.columns import col_or, fill_text, true_or_false


def bundle_topics(entities: DataFrame, key: str = "species_id") -> DataFrame:
    """`(key, by_sections, whole_text, bundle_0, bundle_1)`: texts to summarize.

    The texts of a bundle are joined by one space, empty ones included.
    """
    filled = fill_text(entities)
    bundles = []
    for i, field in enumerate(SUMMARY_FIELDS):
        parts = [col_or(filled, c, F.lit("")) for c in BUNDLES[field]]
        spaced = [x for p in parts for x in (F.lit(" "), p)][1:]
        bundles.append(F.concat(*spaced).alias(f"bundle_{i}"))
    return filled.select(
        key,
        true_or_false(F.col(FLAG_COLUMN)).alias("by_sections"),
        col_or(filled, WHOLE_TEXT_COLUMN, F.lit("")).alias("whole_text"),
        *bundles,
    )


def summaries(
    entities: DataFrame,
    responses: DataFrame,
    default: str = NOT_AVAILABLE,
    key: str = "species_id",
) -> DataFrame:
    """Add the summary fields from the responses, by key; none gives `default`."""
    per_entity = (
        responses.filter(F.col("kind").isin("section", "summary"))
        .groupBy(F.col(key).alias("_key"))
        .agg(
            F.max(F.when(F.col("kind") == "summary", F.col("response"))).alias("_whole"),
            *[
                F.max(
                    F.when(
                        (F.col("kind") == "section") & (F.col("chunk") == i),
                        F.col("response"),
                    )
                ).alias(f"_part{i}")
                for i in range(len(SUMMARY_FIELDS))
            ],
        )
        .withColumn("_fields", read_fields(F.col("_whole"), SUMMARY_FIELDS, default))
    )
    by_sections = true_or_false(F.col(FLAG_COLUMN))
    fields = [
        F.coalesce(
            F.when(by_sections, strip(F.col(f"_part{i}"))).otherwise(
                F.try_element_at("_fields", F.lit(f))
            ),
            F.lit(default),
        ).alias(f)
        for i, f in enumerate(SUMMARY_FIELDS)
    ]
    return entities.join(per_entity, F.col(key) == F.col("_key"), "left").select(
        *[F.col(f"`{c}`") for c in entities.columns if c not in SUMMARY_FIELDS],
        *fields,
    )


def showcase(
    entities: DataFrame, columns: list[str] = SHOWCASE_COLUMNS
) -> DataFrame:
    return entities.select(*[F.col(f"`{c}`") for c in columns])
