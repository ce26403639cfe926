"""Every job bound to the given tables: name → function of session and folder."""


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docengine.functions import html, text as X
from docengine.functions.fixed_values import PROFILE_KEYS, SUMMARY_FIELDS, TOPICS
from docengine.operators import columns as C
from docengine.operators.candidates import (
    backfill_candidates,
    candidate_files,
    first_candidates,
    mention_counts,
    pick_best_document,
    search_queries,
)
from docengine.operators.documents import (
    assemble_documents,
    page_flags,
    prefer_scan_text,
    unprocessed,
)
from docengine.operators.exchange import (
    clean_requests,
    combine_responses,
    parse_responses,
    parse_topics,
    section_requests,
    summary_requests,
)
from docengine.operators.registry import (
    enrich_kv,
    lookup_links,
    page_key_values,
    pivot_keys,
    plan_files,
)
from docengine.operators.routing import needs_enrichment, route_documents
from docengine.operators.rows import clean_rows, extract_rows
from docengine.operators.showcase import bundle_topics, summaries
from docengine.operators.snippets import chunk_text, context_snippets
from docengine.operators.toc import match_sections, slice_sections, toc_rows, with_toc
from docengine.operators.topics import requested_sections, topic_texts
from docengine.plans import inputs as I
from docengine.plans.stages import run_stages
from docengine.sources.tables import (
    list_files,
    null_tokens,
    read_csv,
    read_table,
    read_texts,
    write_csv,
    write_stage,
)
from docengine.sources.workspace import RunFolder


# Documents, contents lists and sections.


def synth_reports(spark: SparkSession, sf: str) -> DataFrame:
    return I.reports(spark, sf).select("doc_id", "text")


def toc_scan(spark: SparkSession, sf: str) -> DataFrame:
    return toc_rows(with_toc(I.reports(spark, sf)), "doc_id")


def toc_bounds(spark: SparkSession, sf: str) -> DataFrame:
    return with_toc(I.reports(spark, sf)).select(
        "doc_id",
        F.col("toc.first").alias("first_line"),
        F.col("toc.last").alias("last_line"),
        F.size("toc.entries").alias("entries"),
    )


def section_slices(spark: SparkSession, sf: str) -> DataFrame:
    return slice_sections(with_toc(I.reports(spark, sf)), "doc_id")


def section_match(spark: SparkSession, sf: str) -> DataFrame:
    """Number and two words of every line, without the dot of the heading."""
    lines = read_table(spark, sf, "documents").select(
        "doc_id", F.posexplode(F.split("text", "\n")).alias("i", "line")
    )
    words = X.split_words(F.col("line"))
    requested = lines.select(
        "doc_id",
        F.concat_ws(" ", (F.col("i") + 1).cast("string"), F.slice(words, 1, 2)).alias("section"),
    )
    return match_sections(requested, with_toc(I.reports(spark, sf)), "doc_id")


def normalized_lines(spark: SparkSession, sf: str) -> DataFrame:
    lines = read_table(spark, sf, "documents").select(
        "doc_id", F.posexplode(F.split("text", "\n")).alias("i", "line")
    )
    dotted = F.concat(F.lit("\t "), "line", F.lit(" ..... "), F.col("i").cast("string"))
    return lines.select("doc_id", "i", X.normalize_line(dotted).alias("normalized"))


def topic_texts_wide(spark: SparkSession, sf: str) -> DataFrame:
    wide = topic_texts(I.asked_topics(spark, sf), with_toc(I.reports(spark, sf)))
    return wide.select(
        "species_id", *[F.col(f"`{t}_text`").alias(f"text_{n}") for n, t in enumerate(TOPICS)]
    )


def context_lines(spark: SparkSession, sf: str) -> DataFrame:
    docs = I.plain_documents(spark, sf).select("doc_id", "text")
    return context_snippets(docs, F.lit("tion"), k=2)


def chunk_greedy(spark: SparkSession, sf: str) -> DataFrame:
    return chunk_text(I.plain_documents(spark, sf), limit=500)


# Choosing and assembling documents.


def mentions(spark: SparkSession, sf: str) -> DataFrame:
    pairs = candidate_files(I.mention_entities(spark, sf))
    return mention_counts(pairs, I.plain_documents(spark, sf))


def best_document(spark: SparkSession, sf: str) -> DataFrame:
    return pick_best_document(
        I.mention_entities(spark, sf), I.plain_documents(spark, sf)
    )


def unprocessed_documents(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents").select("doc_id", "source")
    return unprocessed(docs, read_table(spark, sf, "labels"))


def assembled_documents(spark: SparkSession, sf: str) -> DataFrame:
    return assemble_documents(I.turn_pages(spark, sf))


def scanned_documents(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents").select("doc_id")
    return page_flags(I.turn_pages(spark, sf), docs)


def cleaned_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Scanned conversations with a cleaned text for some; the rest as assembled."""
    cleaned = read_table(spark, sf, "documents").select(
        "doc_id", F.concat(F.lit("  "), "text", F.lit("\n\n")).alias("text")
    )
    done = read_table(spark, sf, "labels").filter("toxic = 1")
    return assemble_documents(I.turn_pages(spark, sf), done, cleaned, "\n")


def scan_over_native(spark: SparkSession, sf: str) -> DataFrame:
    native = read_table(spark, sf, "documents").select("doc_id", "text")
    scanned = read_table(spark, sf, "benchmark").select(
        F.col("item_id").alias("doc_id"), "text"
    )
    return prefer_scan_text(native, scanned)


# Rows out of pages.


def html_rows(spark: SparkSession, sf: str) -> DataFrame:
    pages = read_table(spark, sf, "pages")
    rows = extract_rows(pages, [(None, None, "I")], "nav", "li", "a", 1)
    return rows.select("page_id", "pos", F.col("cells")[0].alias("cell"))


def species_list(spark: SparkSession, sf: str) -> DataFrame:
    return clean_rows(extract_rows(I.law_pages(spark, sf), I.LAW_SECTIONS)).select(
        "page_id",
        "section",
        "pos",
        F.col("Estonian Name").alias("name"),
        F.col("Latin Name").alias("latin"),
        F.col("Category").alias("category"),
    )


def clean_names(spark: SparkSession, sf: str) -> DataFrame:
    part = read_table(spark, sf, "part")
    name = F.concat(F.col("p_partkey").cast("string"), F.lit(")¹ "), "p_name")
    latin = F.concat("p_name", F.lit("; ["), "p_brand", F.lit("] ("), "p_type", F.lit(") [x];., "))
    return part.select(
        "p_partkey",
        X.clean_name(name).alias("name"),
        X.clean_latin(X.strip(latin)).alias("latin"),
    )


def registry_union(spark: SparkSession, sf: str) -> DataFrame:
    """Titles, main headings and links of each page, appended with their category."""
    pages = read_table(spark, sf, "pages")

    def named(tag: str, category: str):
        return F.transform(
            html.blocks(F.col("html"), tag),
            lambda b: F.struct(
                F.lit(category).alias("category"),
                html.one_line(html.inner_text(b)).alias("name"),
            ),
        )

    parts = [named("title", "I"), named("h1", "II"), named("li", "III")]
    return pages.select("page_id", F.inline(F.concat(*parts)))


# Registry values.


def link_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Customers against an index of two thirds of them, in two key forms."""
    customer = read_table(spark, sf, "customer")
    entities = customer.select(
        F.col("c_custkey").alias("species_id"),
        F.col("c_name").alias("Estonian Name"),
        F.col("c_mktsegment").alias("Latin Name"),
    )
    nation = read_table(spark, sf, "nation")
    hits = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.when(F.col("c_custkey") % 3 == 0, X.full_name(F.col("c_name"), F.col("c_mktsegment")))
        .when(F.col("c_custkey") % 3 == 1, F.col("c_name"))
        .otherwise(F.col("n_name"))
        .alias("name"),
        F.col("c_custkey").alias("pos"),
        F.concat_ws("/", "n_name", F.col("c_custkey").cast("string")).alias("link"),
    )
    return lookup_links(entities, hits).select(
        "species_id", F.col("EELIS link").alias("link")
    )


def kv_pivot(spark: SparkSession, sf: str) -> DataFrame:
    events = read_table(spark, sf, "events").select(
        F.col("user_id").alias("species_id"),
        F.struct("ts", "event_id").alias("pos"),
        F.col("event_type").alias("name"),
        F.col("props").alias("value"),
    )
    return pivot_keys(events, ["view", "click", "purchase", "signup", "error", "absent"])


def page_values(spark: SparkSession, sf: str) -> DataFrame:
    return page_key_values(I.profile_pages(I.species_rows(spark, sf)))


def plan_links(spark: SparkSession, sf: str) -> DataFrame:
    files = plan_files(I.profile_pages(I.species_rows(spark, sf)))
    return files.select("species_id", F.array_join("files", "; ").alias("files"))


def enriched_profiles(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with values of their nation and region; one region is kept."""
    customer = read_table(spark, sf, "customer")
    nation = read_table(spark, sf, "nation")
    region = read_table(spark, sf, "region")
    entities = customer.select(
        F.col("c_custkey").alias("species_id"),
        F.col("c_name").alias("Estonian Name"),
        F.col("c_mktsegment").alias("Latin Name"),
        F.lit("I").alias("Category"),
        F.when(F.col("c_custkey") % 10 == 0, "NotFound")
        .otherwise(F.col("c_name"))
        .alias("EELIS link"),
        F.col("c_mktsegment").alias("Kirjeldus"),
    )
    places = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    kv = places.select(
        F.col("c_custkey").alias("species_id"),
        F.posexplode(
            F.array(
                *[
                    F.struct(name.alias("name"), value.alias("value"))
                    for name, value in [
                        (F.lit("Rühm"), F.lit("?")),
                        (F.lit("Tüüp"), F.col("n_name")),
                        (F.lit("Rühm"), F.col("r_name")),
                        (
                            F.when(F.col("c_custkey") % 4 == 0, "Kirjeldus").otherwise("Muu"),
                            F.col("n_name"),
                        ),
                    ]
                ]
            )
        ).alias("pos", "kv"),
    ).select("species_id", "pos", "kv.name", "kv.value")
    out = enrich_kv(entities, kv, keys=PROFILE_KEYS, keep=("Rühm", "EUROPE"))
    return out.select(
        "species_id",
        F.col("EELIS link").alias("link"),
        "strategy_present",
        F.col("`Tüüp`").alias("kind"),
        F.col("`Rühm`").alias("grp"),
        F.col("Kirjeldus").alias("description"),
        F.col("`Nimi inglise k`").alias("english"),
    )


# Candidates.


def page_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "pages").select(
        F.regexp_extract("url", r"/(\w\w)/\d+", 1).alias("lang"),
        F.col("page_id").alias("rank"),
        "url",
    )


def top3_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return first_candidates(page_candidates(spark, sf), ".html", 3, "lang")


def backfilled_candidates(spark: SparkSession, sf: str) -> DataFrame:
    """Documents without a label get the pages that carry their number."""
    docs = read_table(spark, sf, "documents").select(F.col("doc_id").alias("species_id"))
    labels = read_table(spark, sf, "labels").select(F.col("doc_id").alias("l_id"))
    entities = docs.join(labels, F.col("species_id") == F.col("l_id"), "left").select(
        "species_id",
        F.col("l_id").isNotNull().alias("strategy_present"),
        F.when(F.col("l_id").isNotNull(), F.array(F.lit("own.pdf"))).alias("strategy_file"),
    )
    found = read_table(spark, sf, "pages").select(
        I.page_number().cast("bigint").alias("species_id"),
        F.col("page_id").alias("rank"),
        F.concat("url", F.lit(".pdf")).alias("url"),
    )
    return backfill_candidates(entities, found).withColumn(
        "strategy_file", F.array_join("strategy_file", ",")
    )


def candidate_queries(spark: SparkSession, sf: str) -> DataFrame:
    supplier = read_table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("species_id"),
        F.col("s_name").alias("Estonian Name"),
        F.when(F.col("s_acctbal") > 5000, True)
        .when(F.col("s_acctbal") > 2000, False)
        .alias("strategy_present"),
    )
    return search_queries(supplier)


def file_names(spark: SparkSession, sf: str) -> DataFrame:
    """File name forms of page addresses."""
    url = F.concat(F.regexp_replace("url", r"[?#].*$", ""), F.lit(".Pdf"))
    return read_table(spark, sf, "pages").select(
        "page_id",
        X.basename(url).alias("file"),
        X.document_key(url).alias("doc_key"),
        X.cleaned_name(url).alias("text_file"),
        X.ends_with_pdf(url).alias("is_pdf"),
        X.name_stem(F.col("url")).alias("stem"),
        F.array_join(X.split_list(F.concat_ws(" , ", "url", "page_id")), "|").alias("listed"),
    )


# Routing, requests and responses.


def unlabelled_entities(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents").select("doc_id", "source")
    labels = read_table(spark, sf, "labels").select(
        F.col("doc_id").alias("l_id"),
        F.when(F.col("quality") == 1, "good").alias("Kirjeldus"),
        F.when(F.col("toxic") == 0, "fine").alias("Ohutegurite kirjeldus"),
    )
    joined = docs.join(labels, F.col("doc_id") == F.col("l_id"), "left")
    return needs_enrichment(joined).select("doc_id", "source")


def routing_entities(spark: SparkSession, sf: str) -> DataFrame:
    """List rows, each with a report named by its page; a few name no report."""
    number = (
        F.when(F.col("pos") % 3 == 0, F.col("number"))
        .when(F.col("pos") % 3 == 1, F.col("page_id").cast("string"))
        .otherwise("none")
    )
    stem = F.when(F.col("pos") == 4, F.col("Estonian Name")).otherwise("")
    return I.species_rows(spark, sf).select(
        "species_id",
        "Estonian Name",
        (F.col("pos") < 3).alias("strategy_present"),
        F.concat(stem, F.lit("/doc_"), number, F.lit(".pdf")).alias("strategy_file"),
    )


def routed_entities(spark: SparkSession, sf: str) -> DataFrame:
    docs = with_toc(I.reports(spark, sf))
    return route_documents(routing_entities(spark, sf), docs, k=3)


def routed(spark: SparkSession, sf: str) -> DataFrame:
    return routed_entities(spark, sf).select(
        "species_id", "route", F.col("Analyze_by_sisukord").alias("flag")
    )


def requests_for_sections(spark: SparkSession, sf: str) -> DataFrame:
    requests = section_requests(routed_entities(spark, sf), limit=2000)
    return requests.select("species_id", "kind", "chunk", F.md5("prompt").alias("prompt"))


def requests_for_cleaning(spark: SparkSession, sf: str) -> DataFrame:
    """Two thirds of the conversations keep their native pages, the rest are scans."""
    native = F.when(F.col("doc_id") % 3 != 0, F.col("native_text")).otherwise("")
    scanned = assemble_documents(I.turn_pages(spark, sf).withColumn("native_text", native))
    return clean_requests(scanned).select("doc_id", F.md5("prompt").alias("prompt"))


def topic_entities(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations as entities: a topic text per turn, or one whole text."""
    turns = read_table(spark, sf, "conversations")
    return turns.select(
        F.concat_ws("-", "conv_id", "turn").alias("species_id"),
        (F.col("role") == "user").alias("Analyze_by_sisukord"),
        F.col("text").alias("Elupaik_text"),
        F.when(F.col("turn") > 1, F.col("role")).alias("Seisund ELis_text"),
        F.col("role").alias("Elupaiga seisund_text"),
        F.reverse("text").alias("Ohud_text"),
        F.col("text").alias("Kokkuvõte_text"),
    )


def bundled_topics(spark: SparkSession, sf: str) -> DataFrame:
    return bundle_topics(topic_entities(spark, sf))


def requests_for_summaries(spark: SparkSession, sf: str) -> DataFrame:
    requests = summary_requests(bundle_topics(topic_entities(spark, sf)))
    return requests.select("species_id", "kind", "chunk", F.md5("prompt").alias("prompt"))


def combined_responses(spark: SparkSession, sf: str) -> DataFrame:
    turns = read_table(spark, sf, "conversations").select(
        F.col("conv_id").alias("species_id"),
        F.when(F.col("role") == "system", "other").otherwise("passages").alias("kind"),
        F.col("turn").alias("chunk"),
        F.concat(F.lit(" "), "text", F.lit(" ")).alias("response"),
    )
    return combine_responses(turns)


def parsed_responses(spark: SparkSession, sf: str) -> DataFrame:
    return parse_responses(I.shaped_responses(spark, sf), ["Desc", "Threat"])


def parsed_topics(spark: SparkSession, sf: str) -> DataFrame:
    wide = parse_topics(I.shaped_topics(spark, sf))
    return wide.select(
        "species_id",
        *[F.array_join(f"`{t}`", ", ").alias(f"topic_{n}") for n, t in enumerate(TOPICS)],
    )


def asked_sections(spark: SparkSession, sf: str) -> DataFrame:
    return requested_sections(I.asked_topics(spark, sf))


def merged_summaries(spark: SparkSession, sf: str) -> DataFrame:
    entities = topic_entities(spark, sf)
    requests = summary_requests(bundle_topics(entities))
    answers = I.answer_summaries(requests, entities)
    # Some entities stay without an answer.
    answers = answers.filter(~F.col("species_id").endswith("-3"))
    out = summaries(entities, answers)
    return out.select(
        "species_id", *[F.col(f"`{f}`").alias(f"field_{i}") for i, f in enumerate(SUMMARY_FIELDS)]
    )


# Tables.


def ragged_union(spark: SparkSession, sf: str) -> DataFrame:
    benchmark = read_table(spark, sf, "benchmark").select(
        F.col("item_id").alias("doc_id"), F.length("text").cast("bigint").alias("n_chars")
    )
    return C.ragged_union(
        read_table(spark, sf, "documents").select("doc_id", "lang", "n_chars"),
        read_table(spark, sf, "labels"),
        benchmark,
    )


def null_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Text cells that a table hand-over reads as null, and the rest filled again."""
    turns = read_table(spark, sf, "conversations").select(
        "conv_id",
        "turn",
        F.when(F.col("role") == "user", "NA").otherwise(F.col("role")).alias("role"),
        F.when(F.col("turn") % 4 == 0, "").otherwise(F.col("text")).alias("text"),
    )
    handed = null_tokens(turns)
    return C.fill_text(handed.withColumn("role_is_null", F.col("role").isNull()))


def csv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Documents through a CSV file in the shared folder and back."""
    docs = read_table(spark, sf, "documents").select(
        "doc_id",
        F.when(F.col("lang") == "en", "NA").otherwise(F.col("lang")).alias("lang"),
        F.concat(F.lit('"'), "text").alias("text"),
        (F.col("n_chars") > 1000).alias("long"),
    )
    path = f"{RunFolder(spark).path}/csv"
    write_csv(docs, path)
    # Another order than the file's: columns are found by their names.
    schema = T.StructType().add("text", "string").add("long", "boolean")
    schema = schema.add("doc_id", "long").add("lang", "string")
    return read_csv(spark, path, schema)


def text_files(spark: SparkSession, sf: str) -> DataFrame:
    """Text files of conversations, asked for by the number of each document."""
    folder = f"{RunFolder(spark).path}/texts"
    I.file_folder(spark, sf, folder, F.lit("_cleaned.txt"))
    named = read_table(spark, sf, "documents").select(
        "doc_id", F.concat(F.lit("conv_"), F.col("doc_id").cast("string")).alias("doc_key")
    )
    return named.join(read_texts(spark, folder), "doc_key", "left").select(
        "doc_id", "file_name", F.md5("text").alias("digest")
    )


def file_listing(spark: SparkSession, sf: str) -> DataFrame:
    """Document files below a folder, and those right in it."""
    folder = f"{RunFolder(spark).path}/files"
    suffixes = F.array(*[F.lit(s) for s in (".pdf", ".PDF", ".Pdf", ".txt")])
    I.file_folder(spark, sf, folder, F.get(suffixes, (F.col("conv_id") % 4).cast("int")))
    return C.ragged_union(
        *[
            list_files(spark, folder, recursive=deep).select(
                F.lit(deep).alias("recursive"), "doc_key", "length"
            )
            for deep in (True, False)
        ]
    )


# The whole chain.


def stage_tables(
    spark: SparkSession, sf: str, folder: str, written=None
) -> dict[str, DataFrame]:
    species = write_stage(I.species_rows(spark, sf), folder, "species")
    return run_stages(
        I.law_pages(spark, sf),
        I.name_index(species),
        I.profile_pages(species),
        I.search_results(species),
        I.reports(spark, sf),
        I.answer_sections,
        I.answer_summaries,
        folder,
        I.LAW_SECTIONS,
        written,
    )


def showcase_end_to_end(spark: SparkSession, sf: str) -> DataFrame:
    """From raw pages and documents to the showcase table.

    The stages that several later ones read are written; the rest is planned as one.
    """
    folder = RunFolder(spark).path
    written = {"documents", "st1", "st3", "st4", "st5", "routed", "st7"}
    out = stage_tables(spark, sf, folder, written)["showcase"]
    names = [
        "name", "latin", "category", "link", "strategy_present", "english", "grp",
        "protection", "description", "threats",
    ]
    return out.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(out.columns, names)])


QUERIES = {
    "synth_reports": synth_reports,
    "toc_scan": toc_scan,
    "toc_bounds": toc_bounds,
    "section_slices": section_slices,
    "section_match": section_match,
    "normalized_lines": normalized_lines,
    "topic_texts": topic_texts_wide,
    "context_lines": context_lines,
    "chunk_greedy": chunk_greedy,
    "mention_counts": mentions,
    "best_document": best_document,
    "unprocessed_documents": unprocessed_documents,
    "assemble_documents": assembled_documents,
    "scanned_documents": scanned_documents,
    "cleaned_documents": cleaned_documents,
    "scan_over_native": scan_over_native,
    "html_rows": html_rows,
    "species_list": species_list,
    "clean_names": clean_names,
    "registry_union": registry_union,
    "lookup_links": link_lookup,
    "kv_pivot": kv_pivot,
    "page_key_values": page_values,
    "plan_files": plan_links,
    "enrich_filter_project": enriched_profiles,
    "top3_candidates": top3_candidates,
    "backfill_candidates": backfilled_candidates,
    "search_queries": candidate_queries,
    "file_names": file_names,
    "needs_enrichment": unlabelled_entities,
    "route_documents": routed,
    "section_requests": requests_for_sections,
    "clean_requests": requests_for_cleaning,
    "summary_requests": requests_for_summaries,
    "combine_responses": combined_responses,
    "parse_responses": parsed_responses,
    "parse_topics": parsed_topics,
    "requested_sections": asked_sections,
    "bundle_topics": bundled_topics,
    "merge_responses": merged_summaries,
    "ragged_union": ragged_union,
    "null_cells": null_cells,
    "csv_round_trip": csv_round_trip,
    "text_files": text_files,
    "file_listing": file_listing,
    "showcase_end_to_end": showcase_end_to_end,
}
