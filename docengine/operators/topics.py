"""Section texts gathered per topic."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docengine.functions.fixed_values import FLAG_COLUMN, TOPICS
from docengine.functions.text import document_key, strip
from docengine.operators.columns import true_or_false, unfold
from docengine.operators.toc import named_sections


def requested_sections(
    entities: DataFrame, topics: list[str] = TOPICS, key: str = "species_id"
) -> DataFrame:
    """`(key, doc_key, topic, pos, section)` of the flagged entities."""
    asked = F.flatten(
        F.array(
            *[
                F.coalesce(
                    F.transform(
                        F.col(f"`{t}`"),
                        lambda s, i: F.struct(
                            F.lit(n).alias("topic"),
                            i.alias("pos"),
                            strip(s).alias("section"),
                        ),
                    ),
                    F.array().cast("array<struct<topic:int,pos:int,section:string>>"),
                )
                for n, t in enumerate(topics)
            ]
        )
    )
    flagged = entities.filter(true_or_false(F.col(FLAG_COLUMN)))
    doc_key = document_key(F.col("strategy_file")).alias("doc_key")
    return unfold(flagged, [key, doc_key], asked, "topic")


def topic_texts(
    entities: DataFrame,
    documents: DataFrame,
    topics: list[str] = TOPICS,
    key: str = "species_id",
) -> DataFrame:
    """Add `<topic>_text`: the texts of a topic's sections, in the order asked for.

    Entities that are not flagged keep the text they have, if any.  Sections that are not
    found are left out.  The different names asked of a document are gathered to one list,
    which rides in the document's row: its text is read once and only the sections asked for
    are cut.  Entities meet their texts in the aggregation itself, so that they are moved once;
    those without a key meet no other row there.
    """
    asked = requested_sections(entities, topics, key)
    names = asked.groupBy("doc_key").agg(F.collect_set("section").alias("names"))
    texts = named_sections(names, documents)

    part = F.struct("topic", "pos", F.col("section_text").alias("value"))
    parts = asked.join(texts, ["doc_key", "section"]).select(
        F.col(key).alias("_key"), F.lit(None).cast("long").alias("_alone"), part.alias("_part")
    )
    columns = [F.col(f"`{c}`") for c in entities.columns]
    rows = entities.select(
        F.col(key).alias("_key"),
        F.when(F.col(key).isNull(), F.xxhash64(*columns)).alias("_alone"),
        F.struct(*columns).alias("_row"),
    )
    met = (
        rows.unionByName(parts, allowMissingColumns=True)
        .groupBy("_key", "_alone")
        .agg(
            F.collect_list("_row").alias("_rows"),
            F.array_sort(F.collect_list("_part")).alias("_parts"),
        )
        .select(F.explode("_rows").alias("_row"), "_parts")
    )

    def of_topic(n: int) -> Column:
        own = F.filter(F.col("_parts"), lambda p: p["topic"] == n)
        return F.array_join(own["value"], "\n")

    flagged = true_or_false(F.col(f"_row.`{FLAG_COLUMN}`"))
    texts_by_name = {}
    for n, t in enumerate(topics):
        name = f"{t}_text"
        own = F.col(f"_row.`{name}`") if name in entities.columns else F.lit(None)
        texts_by_name[name] = F.when(flagged, of_topic(n)).otherwise(own)
    return met.select(
        *[F.col(f"_row.`{c}`") for c in entities.columns if c not in texts_by_name],
        *[text.alias(name) for name, text in texts_by_name.items()],
    )
