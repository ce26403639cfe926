"""Request tables for an outside text model, and its response tables read back.

Nothing here calls a model: requests go out as rows `(key, kind, chunk, system,
prompt)`, responses come back as rows `(key, kind, chunk, response)`.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docengine.functions.fixed_values import (
    CHUNK_LIMIT,
    NOT_AVAILABLE,
    PROMPTS,
    SUMMARY_FIELDS,
    SYSTEM_MESSAGES,
    TOPICS,
)
from docengine.functions.responses import last_value, read_fields, read_topics
from docengine.functions.text import (
    chunk_words,
    join_in_order,
    render,
    strip,
)
from docengine.operators.columns import unfold
from docengine.operators.routing import SNIPPETS, TOC_MULTI, TOC_SINGLE


def _request(kind: str, prompt: Column, template: str | None = None) -> Column:
    return F.struct(
        F.lit(kind).alias("kind"),
        F.lit(SYSTEM_MESSAGES[template or kind]).alias("system"),
        prompt.alias("prompt"),
    )


def _numbered(df: DataFrame, key: str, requests: Column) -> DataFrame:
    numbered = F.transform(
        requests,
        lambda r, i: F.struct(
            r["kind"].alias("kind"),
            i.alias("chunk"),
            r["system"].alias("system"),
            r["prompt"].alias("prompt"),
        ),
    )
    return unfold(df, [key], numbered, "chunk")


def clean_requests(documents: DataFrame) -> DataFrame:
    """Clean-up request for every scanned document."""
    return documents.filter("scanned").select(
        "doc_id",
        F.inline(F.array(_request("clean", render(PROMPTS["clean"], text=F.col("text"))))),
    )


def section_requests(
    routed: DataFrame,
    key: str = "species_id",
    limit: int = CHUNK_LIMIT,
) -> DataFrame:
    """Topic and passage requests of routed entities, in one pass over them.

    A contents route asks once for the topics' sections; the snippet route asks once
    per chunk of the text around the name.
    """
    name, toc = F.col("Estonian Name"), F.col("toc_text")

    def topics(template: str) -> Column:
        prompt = render(PROMPTS[template], name=name, toc=toc)
        return F.array(_request("topics", prompt, template))

    requests = (
        F.when(F.col("route") == TOC_MULTI, topics("topics_multi"))
        .when(F.col("route") == TOC_SINGLE, topics("topics_single"))
        .when(
            F.col("route") == SNIPPETS,
            F.transform(
                chunk_words(F.col("reading"), limit),
                lambda text: _request(
                    "passages", render(PROMPTS["passages"], name=name, text=text)
                ),
            ),
        )
    )
    return _numbered(routed, key, requests)


def summary_requests(bundles: DataFrame, key: str = "species_id") -> DataFrame:
    """Summary requests: one per field from topic texts, or one from the whole text."""
    per_field = F.array(
        *[
            _request(
                "section",
                render(PROMPTS["section"], field=F.lit(f), text=F.col(f"bundle_{i}")),
            )
            for i, f in enumerate(SUMMARY_FIELDS)
        ]
    )
    whole = F.array(
        _request("summary", render(PROMPTS["summary"], text=F.col("whole_text")))
    )
    requests = F.when(F.col("by_sections"), per_field).otherwise(whole)
    return _numbered(bundles, key, requests)


def combine_responses(
    responses: DataFrame,
    kind: str = "passages",
    key: str = "species_id",
    delimiter: str = "\n",
) -> DataFrame:
    """`(key, text)`: responses to an entity's chunks, joined in order and stripped."""
    parts = F.collect_list(F.struct("chunk", F.col("response").alias("value")))
    return (
        responses.filter(F.col("kind") == kind)
        .groupBy(key)
        .agg(strip(join_in_order(parts, delimiter)).alias("text"))
    )


def parse_responses(
    responses: DataFrame,
    fields: list[str] = SUMMARY_FIELDS,
    default: str = NOT_AVAILABLE,
) -> DataFrame:
    """Replace `response` by a column per field."""
    read = responses.withColumn(
        "_fields", read_fields(F.col("response"), fields, default)
    )
    keep = [c for c in responses.columns if c != "response"]
    return read.select(
        *keep,
        *[
            F.coalesce(F.try_element_at("_fields", F.lit(f)), F.lit(default)).alias(f)
            for f in fields
        ],
    )


def parse_topics(
    responses: DataFrame,
    topics: list[str] = TOPICS,
    key: str = "species_id",
) -> DataFrame:
    """`(key, one list of section names per topic)`; a topic named twice counts last."""
    read = responses.select(key, read_topics(F.col("response")).alias("_topics"))
    return read.select(
        key, *[last_value(F.col("_topics"), F.lit(t)).alias(t) for t in topics]
    )
