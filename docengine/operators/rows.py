"""Rows of entities out of raw pages."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docengine.functions import html
from docengine.functions.fixed_values import LIST_COLUMNS, SECTIONS
from docengine.functions.text import clean_latin, clean_name, strip
from docengine.operators.columns import unfold


def extract_rows(
    pages: DataFrame,
    sections=tuple(SECTIONS),
    container: str = "table",
    row: str = "tr",
    cell: str = "td",
    min_cells: int = 2,
) -> DataFrame:
    """`(page_id, section, pos, category, cells)` of the rows in each section.

    A section is `(url, anchor, category)`; a null url stands for every page, a null
    anchor for the first container.  Sections are a short list, so they are held in
    the expression and no join is needed.
    """
    found = [
        F.struct(
            F.lit(i).alias("section"),
            F.lit(category).alias("category"),
            F.when(
                F.lit(True) if url is None else F.col("url") == url,
                html.after_anchor(F.col("html"), anchor, container)
                if anchor is not None
                else F.get(html.blocks(F.col("html"), container), F.lit(0)),
            ).alias("body"),
        )
        for i, (url, anchor, category) in enumerate(sections)
    ]
    cells = F.transform(
        html.blocks(F.col("body"), row),
        lambda r, i: F.struct(
            i.alias("pos"),
            F.transform(html.blocks(r, cell), html.inner_text).alias("cells"),
        ),
    )
    found_rows = F.filter(cells, lambda r: F.size(r["cells"]) >= min_cells)
    bodies = unfold(pages, ["page_id"], F.array(*found), "body")
    return unfold(bodies, ["page_id", "section", "category"], found_rows, "pos")


def clean_rows(rows: DataFrame) -> DataFrame:
    """Name, Latin name and category out of extracted cells."""
    name, latin, category = LIST_COLUMNS
    return rows.select(
        "page_id",
        "section",
        "pos",
        clean_name(strip(F.get("cells", F.lit(0)))).alias(name),
        clean_latin(strip(F.btrim(F.get("cells", F.lit(1)), F.lit(";")))).alias(latin),
        F.col("category").alias(category),
    )
