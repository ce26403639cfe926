"""Link lookup and registry page values."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docengine.functions import html
from docengine.functions.fixed_values import (
    GROUP_COLUMN,
    GROUP_KEPT,
    LINK_COLUMN,
    NOT_FOUND,
    PAGE_CONTAINER,
    PLAN_DEFAULT_NAME,
    PLAN_LABEL,
    PLAN_LINK_MARK,
    PROFILE_COLUMNS,
    PROFILE_KEYS,
)
from docengine.functions.text import full_name, let
from docengine.operators.columns import col_or, salted_left_join, unfold


def lookup_links(
    entities: DataFrame,
    index: DataFrame,
    sentinel: str = NOT_FOUND,
    key: str = "species_id",
) -> DataFrame:
    """Add the link found by `"name (latin)"`, else by name, else `sentinel`.

    `index(name, pos, link)` may hold a name many times; its first link counts.  That
    is reduced map-side, once, and looked up by narrow rows (key, tier, name); the entities
    themselves, unique by `key`, are shuffled for one join only.
    """
    first = index.groupBy("name").agg(F.min_by("link", "pos").alias("link"))
    name = F.col("Estonian Name")
    tiers = F.array(full_name(name, F.col("Latin Name")), name)
    asked = entities.select(F.col(key).alias("_key"), F.posexplode(tiers).alias("tier", "name"))
    found = (
        asked.join(first, "name")
        .where("link is not null")
        .groupBy("_key")
        .agg(F.min_by("link", "tier").alias("_link"))
    )
    return (
        entities.join(found, F.col(key) == F.col("_key"), "left")
        .withColumn(LINK_COLUMN, F.coalesce("_link", F.lit(sentinel)))
        .drop("_key", "_link")
    )


def page_key_values(
    pages: DataFrame,
    key: str = "species_id",
    container: str | None = PAGE_CONTAINER,
    row: str = "tr",
    cell: str = "td",
) -> DataFrame:
    """`(key, pos, name, value)` of the shown two-cell rows of each page.

    Rows are taken from the `container` divisions, up to the end of each.
    """
    return unfold(pages, [key], _pairs(container, row, cell), "pos")


def _pairs(container: str | None, row: str, cell: str) -> Column:
    """Position, name and value of the shown two-cell rows, in order."""
    shown = html.drop_hidden(F.col("html"))
    bodies = F.array(shown) if container is None else html.divisions(shown, container)
    found = F.flatten(F.transform(bodies, lambda body: html.blocks(body, row)))
    rows = F.transform(
        found,
        lambda r, i: F.struct(
            i.alias("pos"),
            F.transform(
                F.slice(html.blocks(r, cell), 1, 2),
                lambda c: html.one_line(html.inner_text(c)),
            ).alias("cells"),
        ),
    )
    return F.transform(
        F.filter(rows, lambda r: F.size(r["cells"]) == 2),
        lambda r: F.struct(
            r["pos"].alias("pos"),
            r["cells"][0].alias("name"),
            r["cells"][1].alias("value"),
        ),
    )


def plan_files(
    pages: DataFrame,
    key: str = "species_id",
    label: str = PLAN_LABEL,
    mark: str = PLAN_LINK_MARK,
    row: str = "tr",
    cell: str = "td",
) -> DataFrame:
    """`(key, files)`: file names of the plan documents a page links to."""
    return pages.select(key, _plans(label, mark, row, cell).alias("files"))


def _plans(label: str, mark: str, row: str, cell: str) -> Column:
    link = rf"(?is)<a\s[^>]*href\s*=\s*[\"'][^\"'>]*(?-i:{mark})[^>]*>(.*?)</a\s*>"

    def row_files(cells):
        at = F.array_position(
            F.transform(cells, lambda c: html.inner_text(c).contains(label)), F.lit(True)
        )
        after = F.when(
            at > 0, F.slice(cells, (at + 1).cast("int"), F.size(cells))
        ).otherwise(F.array().cast("array<string>"))
        names = F.flatten(
            F.transform(after, lambda c: F.regexp_extract_all(c, F.lit(link), 1))
        )
        return F.transform(
            names,
            lambda n: F.concat(
                F.coalesce(
                    F.nullif(html.one_line(html.inner_text(n)), F.lit("")),
                    F.lit(PLAN_DEFAULT_NAME),
                ),
                F.lit(".pdf"),
            ),
        )

    def files(r):
        # A row without the mark has no such link; a comment may stand within the mark.
        linked = r.rlike(mark) | r.contains("<!--")
        return F.when(linked, let(html.blocks(r, cell), row_files)).otherwise(
            F.array().cast("array<string>")
        )

    return F.flatten(F.transform(html.blocks(F.col("html"), row), files))


def page_profiles(
    pages: DataFrame, keys: list[str] = PROFILE_KEYS, key: str = "species_id"
) -> DataFrame:
    """`(key, values, files)`: the last value of each of `keys`, null without one, and plans.

    Both are taken from the page's row in one scan; no pair leaves it. Of pages that share a
    key the one with the greatest values is taken, by an aggregation whose exchange is that of
    the join with the entities.
    """
    wanted = let(
        _pairs(PAGE_CONTAINER, "tr", "td"),
        lambda pairs: F.array(
            *[
                F.try_element_at(F.filter(pairs, lambda p: p["name"] == k), F.lit(-1))["value"]
                for k in keys
            ]
        ),
    )
    plans = _plans(PLAN_LABEL, PLAN_LINK_MARK, "tr", "td")
    rows = pages.select(key, F.struct(wanted.alias("values"), plans.alias("files")).alias("page"))
    return rows.groupBy(key).agg(F.max("page").alias("page")).select(key, "page.*")


def pivot_keys(
    kv: DataFrame, keys: list[str], key: str = "species_id", pos="pos"
) -> DataFrame:
    """One row per entity, one column per key, the last value of each.

    The keys are given, so no job is needed to find them, and one pass with map-side
    reduction fills all columns.
    """
    order = F.col(pos) if isinstance(pos, str) else pos
    return (
        kv.filter(F.col("name").isin(keys))
        .groupBy(key)
        .agg(
            *[
                F.max_by("value", F.when(F.col("name") == k, order)).alias(k)
                for k in keys
            ]
        )
    )


def enrich_kv(
    entities: DataFrame,
    kv: DataFrame,
    files: DataFrame | None = None,
    keys: list[str] = PROFILE_KEYS,
    keep: tuple[str, str] | None = (GROUP_COLUMN, GROUP_KEPT),
    columns: list[str] | None = PROFILE_COLUMNS,
    key: str = "species_id",
    on: str | None = None,
    sentinel: str = NOT_FOUND,
    salts: int = 1,
) -> DataFrame:
    """Add page values and plan files; then filter and project.

    A page value replaces a same-named entity value.  Entities whose link is the
    sentinel keep their row as it is.  Values and files are keyed like the entities, or
    by another entity column `on`, such as the link; that one may be shared by many
    entities, and `salts` deals the rows of each value out to as many tasks.
    """
    on = on or key
    wide = pivot_keys(kv, keys, on).select(
        F.col(on).alias("_key"), *[F.col(f"`{k}`").alias(f"_kv{i}") for i, k in enumerate(keys)]
    )
    out = _add(entities, wide, "_key", key, on, salts)
    if files is not None:
        found = files.filter(F.size("files") > 0).select(
            F.col(on).alias("_fkey"), F.col("files").alias("_files")
        )
        out = _add(out, found, "_fkey", key, on, salts)
    return _resolved(out, entities, keys, files is not None, keep, columns, key, sentinel)


def enrich_pages(
    entities: DataFrame,
    pages: DataFrame,
    keys: list[str] = PROFILE_KEYS,
    keep: tuple[str, str] | None = (GROUP_COLUMN, GROUP_KEPT),
    columns: list[str] | None = PROFILE_COLUMNS,
    key: str = "species_id",
    on: str | None = None,
    sentinel: str = NOT_FOUND,
    salts: int = 1,
) -> DataFrame:
    """`enrich_kv` with the values and files of raw pages, by a single join."""
    on = on or key
    wide = page_profiles(pages, keys, on).select(
        F.col(on).alias("_key"),
        *[F.get("values", F.lit(i)).alias(f"_kv{i}") for i in range(len(keys))],
        F.when(F.size("files") > 0, F.col("files")).alias("_files"),
    )
    out = _add(entities, wide, "_key", key, on, salts)
    return _resolved(out, entities, keys, True, keep, columns, key, sentinel)


def _add(
    left: DataFrame, right: DataFrame, right_key: str, key: str, on: str, salts: int
) -> DataFrame:
    if on != key:
        return salted_left_join(left, right, F.col(on), right_key, key, salts)
    return left.join(right, F.col(key) == F.col(right_key), "left").drop(right_key)


def _resolved(
    out: DataFrame,
    entities: DataFrame,
    keys: list[str],
    with_files: bool,
    keep: tuple[str, str] | None,
    columns: list[str] | None,
    key: str,
    sentinel: str,
) -> DataFrame:
    """Joined values and files in the entities' columns; then filter and project."""
    linked = F.coalesce(F.col(LINK_COLUMN) != sentinel, F.lit(False))
    present = col_or(entities, "strategy_present", F.lit(False))
    named = col_or(entities, "strategy_file", F.lit(None).cast("array<string>"))
    if with_files:
        present = F.when(linked, F.col("_files").isNotNull()).otherwise(present)
        named = F.when(linked, F.coalesce(F.col("_files"), named)).otherwise(named)
    values = {
        k: F.coalesce(
            F.when(linked, F.col(f"_kv{i}")), col_or(entities, k, F.lit(None).cast("string"))
        )
        for i, k in enumerate(keys)
    }
    out = out.select(
        *[
            F.col(f"`{c}`")
            for c in entities.columns
            if c not in values and c not in ("strategy_present", "strategy_file")
        ],
        present.alias("strategy_present"),
        named.alias("strategy_file"),
        *[v.alias(k) for k, v in values.items()],
    )
    if keep is not None:
        out = out.filter(F.col(f"`{keep[0]}`") == keep[1])
    if columns is not None:
        out = out.select(key, *[F.col(f"`{c}`") for c in columns])
    return out
