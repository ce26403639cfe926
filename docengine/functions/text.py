"""Column functions over text.

Every function maps columns to a column with built-in expressions, so a document
is handled where its row lies: no explode, no shuffle; and no Python worker, but for texts
that are longer than a chunk.
"""

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from docengine.functions.patterns import chunk_each

# Unicode white space, as a regex class and as the set of characters itself.
WS = r"(?U:[\s\x1c-\x1f])"
NOT_WS = r"(?U:[^\s\x1c-\x1f])"
WS_CHARS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
LINE_BREAK = r"\R|[\x1c-\x1e]"
NO_BREAK = r"^[^\n\x0b\f\r\x1c-\x1e\x{85}\x{2028}\x{2029}]*+"
# Leader dots, then a page number at the end; tried once per run of dots.
TOC_LINE = r"(?<!\.)\.{5,}+" + WS + r"*+\p{Nd}++\z"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of `value`, with `value` computed once per row.

    A column used inside a lambda may be inlined there by the optimizer and then
    be computed once per array element; a lambda variable never is.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WS_CHARS))


def split_lines(c: Column) -> Column:
    """Lines at every line or page break; text after the last break counts too."""
    return F.split(c, LINE_BREAK)


def split_words(c: Column) -> Column:
    return F.filter(F.split(c, WS + "+"), lambda w: w != "")


def split_list(c: Column, delimiter: str = ",") -> Column:
    """Delimited cell to a list of trimmed parts."""
    return F.transform(F.split(c, re.escape(delimiter)), strip)


def join_in_order(items: Column, delimiter: str, value: str = "value") -> Column:
    """Join collected structs by their leading fields."""
    return F.array_join(F.array_sort(items)[value], delimiter)


def normalize_line(c: Column) -> Column:
    """Single spaces, cut after the last letter; a line without letters stays whole."""
    return let(
        strip(F.regexp_replace(c, WS + "+", " ")),
        lambda s: F.coalesce(
            F.nullif(F.regexp_extract(s, r"(?s)^(.*\p{L})", 1), F.lit("")), s
        ),
    )


def dotless(c: Column) -> Column:
    """Form in which section names are compared."""
    return F.lower(F.replace(c, F.lit("."), F.lit("")))


def name_stem(c: Column, cut: int = 2) -> Column:
    return F.substr(c, F.lit(1), F.greatest(F.length(c) - cut, F.lit(0)))


def basename(c: Column) -> Column:
    return F.substring_index(c, "/", -1)


def document_key(c: Column) -> Column:
    """File name without folder and without `.pdf` or `_cleaned.txt`."""
    return F.regexp_replace(basename(c), r"(?i)(\.pdf|_cleaned\.txt)\z", "")


def cleaned_name(c: Column) -> Column:
    """Name of the text file made from a document file."""
    return F.concat(document_key(c), F.lit("_cleaned.txt"))


def ends_with_pdf(c: Column) -> Column:
    return F.lower(c).endswith(".pdf")


def full_name(name: Column, latin: Column) -> Column:
    return F.concat(name, F.lit(" ("), latin, F.lit(")"))


def render(template: str, **values: Column) -> Column:
    """Fill `{name}`-like places of a template with columns."""
    parts = re.split(r"\{(" + "|".join(values) + r")\}", template)
    return F.concat(
        *[values[p] if i % 2 else F.lit(p) for i, p in enumerate(parts) if i % 2 or p]
    )


def clean_name(c: Column) -> Column:
    """Drop list numbering and footnote marks in front of a name."""
    return strip(F.regexp_replace(c, r"^\p{Nd}+[)¹]*" + WS + "*", ""))


def clean_latin(c: Column) -> Column:
    """Drop bracketed notes, then closing punctuation."""
    without_notes = strip(F.regexp_replace(c, ";?" + WS + r"*\[[^\n]*?\]", ""))
    return strip(F.regexp_replace(without_notes, r"[;,.]*\z", ""))


def count_mentions(text: Column, name: Column) -> Column:
    """Non-overlapping literal occurrences, any case; no text counts 0."""
    quoted = F.replace(name, F.lit(r"\E"), F.lit(r"\E\\E\Q"))
    pattern = F.concat(F.lit(r"(?iu)\Q"), quoted, F.lit(r"\E"))
    return F.coalesce(F.regexp_count(text, pattern), F.lit(0))


def context_lines(text: Column, term: Column, k: int = 30) -> Column:
    """Distinct lines at most `k` lines away from a line holding `term`, in order."""

    def ranges(hits: Column) -> Column:
        # Each hit adds only what the hit before it did not reach.
        before = F.concat(F.array(F.lit(-k - 1)), hits)
        return F.zip_with(
            hits, before, lambda hit, prev: F.when(hit.isNotNull(), F.struct(
                F.greatest(hit - k, prev + k + 1).alias("lo"), (hit + k).alias("hi")
            ))
        )

    def pick(lines: Column, term: Column) -> Column:
        hits = F.filter(
            F.transform(lines, lambda line, i: F.when(line.contains(term), i)),
            lambda i: i.isNotNull(),
        )
        return F.array_distinct(
            F.flatten(
                F.transform(
                    F.filter(let(hits, ranges), lambda r: r.isNotNull()),
                    lambda r: F.slice(lines, r["lo"] + 1, r["hi"] - r["lo"] + 1)
                )
            )
        )

    found = let(F.split(text, "\n"), lambda lines: let(term, lambda t: pick(lines, t)))
    return F.when(text.contains(term), found).when(
        text.isNotNull(), F.array().cast("array<string>")
    )


def chunk_words(text: Column, limit: int = 128000) -> Column:
    """Greedy chunks of whole words; spaces do not count towards the limit.

    A text within the limit, the usual case, is one chunk and stays in the JVM; of a longer
    one the chunks' ends are looked up in the running sums of its words' lengths.
    """
    small = F.octet_length(text) <= limit
    words = F.array_join(split_words(text), " ")
    whole = let(words, lambda w: F.filter(F.array(w), lambda w: w != ""))
    return F.when(small, whole).otherwise(chunk_each(F.when(~small, text), limit))


def table_of_contents(
    text: Column,
    marker: str = "Sisukord",
    max_miss: int = 10,
    late_count: bool = False,
) -> Column:
    """`struct<first, last, entries>` of the contents list, null when there is none.

    From the marker on, lines ending in leader dots and a page number are kept,
    until more than `max_miss` other non-blank lines follow one another.  `first`
    is the marker's line and `last` that of the last entry, counted from 1.

    With `late_count`, `last` is one higher, and both are one higher again when the
    marker stands inside a line.  This is how the lists were counted originally; it
    costs the text the line after the list.
    """

    def up_to_last_leader(rest: Column) -> Column:
        # No entry can follow the last line with leader dots, so that the body of the
        # document, by far the most of it, need not be taken apart.
        return let(
            F.substring_index(rest, ".....", -1),
            lambda after: F.concat(
                F.left(rest, F.length(rest) - F.length(after)),
                F.regexp_extract(after, NO_BREAK, 0),
            ),
        )

    def entries(lines: Column) -> Column:
        # Ordinal among non-blank lines shows the number of misses between two hits.
        marked = F.transform(
            lines,
            lambda line, i: F.struct(i.alias("i"), line.alias("raw")),
        )
        filled = F.filter(marked, lambda e: F.rlike(e["raw"], F.lit(NOT_WS)))
        hits = F.filter(
            F.transform(
                filled,
                lambda e, j: F.struct(
                    j.alias("ord"), e["i"].alias("i"), e["raw"].alias("raw")
                ),
            ),
            lambda e: e["raw"].contains(".....") & F.rlike(e["raw"], F.lit(TOC_LINE)),
        )

        def until_gap(hits: Column) -> Column:
            too_far = F.zip_with(
                hits["ord"],
                F.concat(F.array(F.lit(-1)), hits["ord"]),
                lambda a, b: a - b - 1 > max_miss,
            )
            return let(
                F.array_position(too_far, F.lit(True)),
                lambda cut: F.when(
                    cut > 0, F.slice(hits, F.lit(1), (cut - 1).cast("int"))
                ).otherwise(hits),
            )

        return let(hits, until_gap)

    def build(at: Column) -> Column:
        before = split_lines(F.substr(text, F.lit(1), at - 1))
        first = F.size(before)
        late = 0
        if late_count:
            first = let(
                before,
                lambda b: F.size(b) + F.when(F.element_at(b, -1) == "", 0).otherwise(1),
            )
            late = 1
        kept = entries(split_lines(let(F.substr(text, at), up_to_last_leader)))
        return let(
            first,
            lambda first: let(
                kept,
                lambda kept: F.when(
                    F.size(kept) > 0,
                    F.struct(
                        first.alias("first"),
                        (first + F.element_at(kept, -1)["i"] + late).alias("last"),
                        F.transform(
                            kept,
                            lambda e: F.struct(
                                (first + e["i"] + late).alias("line"),
                                e["raw"].alias("raw"),
                                normalize_line(e["raw"]).alias("title"),
                            ),
                        ).alias("entries"),
                    ),
                ),
            ),
        )

    return F.when(
        text.contains(marker) & text.contains("....."), let(F.instr(text, marker), build)
    )


def without_lines(text: Column, first: Column, last: Column) -> Column:
    """Text without the lines `first` to `last`."""
    return let(
        split_lines(text),
        lambda lines: F.array_join(
            F.concat(
                F.slice(lines, F.lit(1), first - 1),
                F.slice(lines, last + 1, F.size(lines)),
            ),
            "\n",
        ),
    )
