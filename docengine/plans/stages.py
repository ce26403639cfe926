"""The stages, in the order their data depend on one another.

Each stage is a function of tables.  `run_stages` chains them.  It writes a stage's table
once, to a folder all executors reach, commits it and goes on from the written table, so that
a lost executor or a restart costs one stage at most.
"""

from collections.abc import Callable, Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docengine.functions.fixed_values import (
    FLAG_COLUMN,
    LINK_COLUMN,
    LIST_COLUMNS,
    SECTIONS,
    TOPICS,
    WHOLE_TEXT_COLUMN,
)
from docengine.operators.candidates import backfill_candidates, pick_best_document
from docengine.operators.exchange import (
    combine_responses,
    parse_topics,
    section_requests,
    summary_requests,
)
from docengine.operators.registry import enrich_pages, lookup_links
from docengine.operators.routing import WHOLE_TEXT, needs_enrichment, route_documents
from docengine.operators.rows import clean_rows, extract_rows
from docengine.operators.showcase import bundle_topics, showcase, summaries
from docengine.operators.toc import with_toc
from docengine.operators.topics import topic_texts
from docengine.sources.stages import StageFolder
from docengine.sources.tables import null_tokens, write_csv


Answer = Callable[[DataFrame, DataFrame], DataFrame]

# Stage tables that a later stage reads.
HANDED_OVER = ("st1", "st2", "st3", "st4", "st5", "st6", "st7")


def species_list(pages: DataFrame, sections=tuple(SECTIONS)) -> DataFrame:
    """st1: names and category out of law pages, keyed by place of origin."""
    rows = clean_rows(extract_rows(pages, sections))
    key = F.concat_ws("-", "page_id", "section", "pos")
    return rows.select(key.alias("species_id"), *LIST_COLUMNS)


def linked_list(species: DataFrame, index: DataFrame) -> DataFrame:
    """st2: with registry links."""
    return lookup_links(species, index)


def profiles(linked: DataFrame, registry_pages: DataFrame) -> DataFrame:
    """st3: with registry values, of the kept group only.

    The pages are keyed by `species_id` or by the link.
    """
    on = LINK_COLUMN if LINK_COLUMN in registry_pages.columns else "species_id"
    return enrich_pages(linked, registry_pages, on=on)


def with_candidates(profiled: DataFrame, candidates: DataFrame) -> DataFrame:
    """st4: with candidate files where no plan is known."""
    return backfill_candidates(profiled, candidates)


def with_document(gathered: DataFrame, documents: DataFrame) -> DataFrame:
    """st5: with one file each."""
    return pick_best_document(gathered, documents)


def routed(chosen: DataFrame, documents: DataFrame) -> DataFrame:
    """Entities that need enrichment, with their document and route."""
    return route_documents(needs_enrichment(chosen), documents)


def with_sections(routed: DataFrame, responses: DataFrame) -> DataFrame:
    """st6: with the section names per topic, or the text to summarize.

    An entity without a usable response keeps its row, with null topics.
    """
    topics = parse_topics(responses.filter(F.col("kind") == "topics")).withColumnRenamed(
        "species_id", "_tkey"
    )
    passages = combine_responses(responses, "passages").select(
        F.col("species_id").alias("_pkey"), F.col("text").alias("_passages")
    )
    whole = F.when(F.col("route") == WHOLE_TEXT, F.col("reading")).otherwise(
        F.col("_passages")
    )
    keep = [c for c in routed.columns if c not in ("reading", "toc_text", FLAG_COLUMN)]
    return (
        routed.join(topics, F.col("species_id") == F.col("_tkey"), "left")
        .join(passages, F.col("species_id") == F.col("_pkey"), "left")
        .select(
            *[F.col(f"`{c}`") for c in keep],
            *[F.when(F.col(FLAG_COLUMN), F.col(f"`{t}`")).alias(t) for t in TOPICS],
            whole.alias(WHOLE_TEXT_COLUMN),
            F.col(FLAG_COLUMN),
        )
    )


def with_texts(sectioned: DataFrame, documents: DataFrame) -> DataFrame:
    """st7: with the text of each topic."""
    return topic_texts(sectioned, documents)


def summarized(texts: DataFrame, responses: DataFrame) -> DataFrame:
    """st8: with the summary fields."""
    return summaries(texts, responses)


def run_stages(
    law_pages: DataFrame,
    index: DataFrame,
    registry_pages: DataFrame,
    candidates: DataFrame,
    documents: DataFrame,
    answer_sections: Answer,
    answer_summaries: Answer,
    folder: str,
    sections=tuple(SECTIONS),
    written: Collection[str] | None = None,
    run: str | None = None,
) -> dict[str, DataFrame]:
    """All stage tables by name, with both request tables and the showcase.

    `documents(doc_key, text)` are finished texts, used for choosing a document as
    well as for reading it.  `answer_sections(requests, routed)` and
    `answer_summaries(requests, texts)` give the response tables, usually by reading
    what an outside service has written.  Stages named in `written` go to the folder, or
    all when none are named.  The others stay part of the plan; tables that more than one
    later stage reads should be written, or their plan is repeated in each.

    With `run`, a name for the data at hand, stages that a run of that name has committed to
    the folder are taken as they are: a run that died goes on at its first open stage.
    """
    stages = StageFolder(documents.sparkSession, folder, run)

    def stage(df: DataFrame, name: str) -> DataFrame:
        # Handed-over cells that a table reader takes as null are null from here on.
        df = null_tokens(df) if name in HANDED_OVER else df
        keep = written is None or name in written
        return stages.once(df, name) if keep else df

    out = {}
    out["documents"] = with_contents = stage(with_toc(documents), "documents")
    out["st1"] = stage(species_list(law_pages, sections), "st1")
    out["st2"] = stage(linked_list(out["st1"], index), "st2")
    out["st3"] = stage(profiles(out["st2"], registry_pages), "st3")
    out["st4"] = stage(with_candidates(out["st3"], candidates), "st4")
    out["st5"] = stage(with_document(out["st4"], with_contents), "st5")
    out["routed"] = stage(routed(out["st5"], with_contents), "routed")
    out["section_requests"] = stage(section_requests(out["routed"]), "section_requests")
    responses = answer_sections(out["section_requests"], out["routed"])
    out["st6"] = stage(with_sections(out["routed"], responses), "st6")
    out["st7"] = stage(with_texts(out["st6"], with_contents), "st7")
    out["summary_requests"] = stage(
        summary_requests(bundle_topics(out["st7"])), "summary_requests"
    )
    responses = answer_summaries(out["summary_requests"], out["st7"])
    out["st8"] = stage(summarized(out["st7"], responses), "st8")
    out["showcase"] = stage(showcase(out["st8"]), "showcase")
    return out


def export_stages(tables: dict[str, DataFrame], folder: str) -> None:
    """Stage tables and showcase as CSV folders, lists of files joined by `"; "`."""
    for name in (*HANDED_OVER, "st8", "showcase"):
        write_csv(tables[name], f"{folder.rstrip('/')}/{name}", {"strategy_file": "; "})
