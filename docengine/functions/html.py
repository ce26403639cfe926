"""Column functions over raw HTML.

Blocks are found by pattern; where one holds another of its kind, by element intervals: the
page is split at the kind's tags, each with its depth, and an element reaches from its own
tag to where the depth falls below it.  Pages with unclosed tags elsewhere do no harm, as only
the asked-for blocks are read.
"""

import html
import re
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from docengine.functions.text import let, strip

def _map(names: dict[str, str]) -> Column:
    """A map literal, made from one text."""
    return F.str_to_map(
        F.lit("\x02".join(f"{n}\x01{c}" for n, c in names.items())), F.lit(r"\x02"), F.lit(r"\x01")
    )


# The standard's names: those that need their semicolon, and the older ones that do not.
_BARE = {n: c for n, c in html5.items() if not n.endswith(";")}
_NAMED = {n[:-1]: c for n, c in html5.items() if n.endswith(";") and n[:-1] not in _BARE}
_BARE_FIRST = "^(?:" + "|".join(sorted(_BARE, key=len, reverse=True)) + ")"
# What the numbers 128 to 159 stand for in pages.
_LATE_CONTROLS = "".join(html.unescape(f"&#{c};") for c in range(128, 160))
_REPLACEMENT = "\ufffd"
_TOO_LARGE = 0x110000


def _char(code: Column) -> Column:
    """Character of a code point; no such character gives the replacement character.

    Controls and the standard's non-characters give empty text.
    """

    def pick(n: Column) -> Column:
        surrogate = n.between(0xD800, 0xDFFF)
        control = n.between(1, 8) | (n == 11) | n.between(14, 31) | (n == 127)
        nothing = n.between(0xFDD0, 0xFDEF) | (n.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
        return (
            F.when(n.between(128, 159), F.substr(F.lit(_LATE_CONTROLS), n - 127, F.lit(1)))
            .when((n < 1) | (n > 0x10FFFF) | surrogate, _REPLACEMENT)
            .when(control | nothing, "")
            .when(
                n.isNotNull(),
                F.decode(F.unhex(F.lpad(F.hex(n.cast("long")), 8, "0")), "UTF-32"),
            )
        )

    return let(code.cast("int"), pick)


def unescape(c: Column) -> Column:
    """Decode named and numbered character references in one pass.

    Numbers have any length; they and the older names may lack their semicolon.
    """
    bare, named = _map(_BARE), _map(_NAMED)

    def after(piece: Column, used: Column) -> Column:
        return F.substr(piece, F.length(used) + 1)

    def decode(piece: Column) -> Column:
        hexa = F.regexp_extract(piece, "^#[xX]0*([0-9a-fA-F]+)", 1)
        deci = F.regexp_extract(piece, "^#0*([0-9]+)", 1)
        code = F.when(
            hexa != "", F.when(F.length(hexa) > 6, _TOO_LARGE).otherwise(F.conv(hexa, 16, 10))
        ).when(deci != "", F.when(F.length(deci) > 7, _TOO_LARGE).otherwise(deci))
        number = F.regexp_extract(piece, "^#(?:[xX][0-9a-fA-F]+|[0-9]+);?", 0)
        name = F.regexp_extract(piece, r"^([^\t\n\f <&#;]{1,32});", 1)
        first = F.regexp_extract(piece, _BARE_FIRST, 0)
        return F.coalesce(
            F.when(piece.startswith("#"), F.concat(_char(code), after(piece, number))),
            let(
                name,
                lambda n: F.concat(
                    F.coalesce(F.try_element_at(bare, n), F.try_element_at(named, n)),
                    F.substr(piece, F.length(n) + 2),
                ),
            ),
            let(first, lambda n: F.concat(F.try_element_at(bare, n), after(piece, n))),
            F.concat(F.lit("&"), piece),
        )

    decoded = let(
        F.split(c, "&"),
        lambda parts: F.concat(
            F.get(parts, F.lit(0)),
            F.array_join(
                F.transform(F.slice(parts, F.lit(2), F.size(parts)), decode), ""
            ),
        ),
    )
    return F.when(c.contains("&"), decoded).otherwise(c)


COMMENT = r"(?s)<!--.*?-->"


def _kind(part: Column, tag: str) -> Column:
    """1 for a part that begins with the opening tag, -1 with the closing one, else 0."""
    return F.when(part.rlike(rf"(?i)^</{tag}[\s/>]"), -1).when(
        part.rlike(rf"(?i)^<{tag}[\s/>]"), 1
    ).otherwise(0)


def _elements(c: Column, tag: str, body) -> Column:
    """`body` of the page's parts, cut before every `<tag>` and `</tag>`, and a length function.

    The function gives for the opening tag at a part the number of parts up to its closing
    tag: to the first part with a smaller depth, else to the page's end.
    """

    def depths(parts: Column) -> Column:
        start = F.struct(F.lit(0).alias("depth"), F.array().cast("array<int>").alias("all"))

        def step(acc: Column, kind: Column) -> Column:
            depth = F.greatest(acc["depth"] + kind, F.lit(0))
            return F.struct(depth.alias("depth"), F.array_append(acc["all"], depth).alias("all"))

        kinds = F.transform(parts, lambda p: _kind(p, tag))
        return F.aggregate(kinds, start, step, lambda acc: acc["all"])

    def with_depths(parts: Column, depths: Column) -> Column:
        def length(i: Column) -> Column:
            after = F.slice(depths, i + 2, F.size(depths))
            below = F.transform(after, lambda d: d < F.get(depths, i))
            return let(
                F.array_position(below, F.lit(True)).cast("int"),
                lambda at: F.when(at > 0, at).otherwise(F.size(parts) - i),
            )

        return body(parts, length)

    cut = F.split(F.regexp_replace(c, COMMENT, ""), rf"(?i)(?=</?{tag}[\s/>])")
    return let(cut, lambda p: let(depths(p), lambda d: with_depths(p, d)))


def nested_blocks(c: Column, tag: str) -> Column:
    """Inner HTML of every `<tag>` element, in the order of their opening tags.

    An element inside another one is part of it and also one of its own.  A closing tag
    closes the last open element; what is not closed reaches to the end.
    """

    def inner(parts: Column, length) -> Column:
        def one(part: Column, i: Column) -> Column:
            rest = F.array_join(F.slice(parts, i + 2, length(i) - 1), "")
            return F.when(
                _kind(part, tag) == 1, F.concat(F.regexp_replace(part, "^<[^>]*>", ""), rest)
            )

        return F.filter(F.transform(parts, one), lambda b: b.isNotNull())

    return _elements(c, tag, inner)


def _holds_tag(c: Column, tag: str) -> Column:
    return c.rlike(rf"(?i)<{tag}[\s/>]")


def blocks(c: Column, tag: str) -> Column:
    """Inner HTML of every `<tag>` block, in order; also of those inside others."""
    flat = F.regexp_extract_all(c, F.lit(rf"(?is)<{tag}(?:\s[^>]*)?>(.*?)</{tag}\s*>"), 1)
    return let(
        flat,
        lambda found: F.when(
            F.exists(found, lambda b: _holds_tag(b, tag)), nested_blocks(c, tag)
        ).otherwise(found),
    )


def inner_text(c: Column) -> Column:
    """Text of a fragment: comments and tags away, references decoded."""
    return let(F.regexp_replace(c, r"(?s)<!--.*?-->|<[^>]*>", ""), unescape)


def one_line(c: Column) -> Column:
    return F.replace(strip(c), F.lit("\n"), F.lit(" "))


def after_anchor(c: Column, anchor: str, container: str) -> Column:
    """Inner HTML of the first `container` after the named anchor, else empty.

    Containers inside it are part of it.
    """
    name = re.escape(anchor)
    before = rf"(?s)<[aA]\s(?:[^>]*\s)?name\s*=\s*[\"']?{name}[\"']?(?:\s[^>]*)?/?>"
    opens = rf"<{container}(?:\s[^>]*)?>"
    flat = F.regexp_extract(c, rf"{before}(?i:.*?{opens}(.*?)</{container}\s*>)", 1)
    rest = F.regexp_extract(c, rf"{before}(?i:.*?({opens}.*))", 1)
    return let(
        flat,
        lambda found: F.when(
            _holds_tag(found, container), F.get(nested_blocks(rest, container), F.lit(0))
        ).otherwise(found),
    )


def divisions(c: Column, name: str, tag: str = "div") -> Column:
    """Every outermost `<tag>` of class `name`, each up to its own end tag.

    Divisions inside count; one that is not closed reaches to the page's end.
    """
    opens = rf"(?is)^<{tag}\s(?:[^>]*\s)?class\s*=\s*[\"'](?-i:{re.escape(name)})[\"'][^>]*>"
    start = F.struct(
        F.lit(0).alias("depth"),
        F.lit(0).alias("i"),
        F.lit(0).alias("lo"),
        F.array().cast("array<struct<lo:int,hi:int>>").alias("found"),
    )

    def step(acc: Column, kind: Column) -> Column:
        inside = acc["depth"] > 0
        depth = F.when(inside, acc["depth"] + F.least(kind, F.lit(1))).otherwise(
            (kind == 2).cast("int")
        )
        ends = F.array_append(
            acc["found"], F.struct(acc["lo"].alias("lo"), acc["i"].alias("hi"))
        )
        return F.struct(
            depth.alias("depth"),
            (acc["i"] + 1).alias("i"),
            F.when(inside, acc["lo"]).otherwise(acc["i"]).alias("lo"),
            F.when(inside & (depth == 0), ends).otherwise(acc["found"]).alias("found"),
        )

    def cut(parts: Column) -> Column:
        kinds = F.transform(
            parts,
            lambda p: F.when(p.rlike(opens), 2)
            .when(p.rlike(rf"(?i)^<{tag}"), 1)
            .when(p.rlike(rf"(?i)^</{tag}"), -1)
            .otherwise(0),
        )
        end = F.struct(F.lit(-1).alias("lo"), F.lit(-1).alias("hi"))
        whole = let(
            F.aggregate(kinds, start, step),
            lambda acc: F.concat(
                acc["found"],
                F.when(
                    acc["depth"] > 0,
                    F.array(F.struct(acc["lo"].alias("lo"), acc["i"].alias("hi"))),
                ).otherwise(F.filter(F.array(end), lambda e: F.lit(False))),
            ),
        )
        return F.transform(
            whole,
            lambda f: F.array_join(F.slice(parts, f["lo"] + 1, f["hi"] - f["lo"]), ""),
        )

    plain = F.regexp_replace(c, COMMENT, "")
    return let(F.split(plain, rf"(?i)(?=</?{tag}[\s/>])"), cut)


def drop_hidden(c: Column) -> Column:
    """Without table bodies that are not displayed, and what they hold."""
    opens = r"(?is)<tbody\s[^>]*style\s*=\s*[\"']display:none[\"'][^>]*>"
    flat = rf"{opens}.*?</tbody\s*>"

    def shown(parts: Column, length) -> Column:
        hidden = F.filter(
            F.transform(
                parts,
                lambda p, i: F.when(
                    p.rlike(opens.replace("<", "^<", 1)),
                    F.struct(i.alias("lo"), (i + length(i)).alias("hi")),
                ),
            ),
            lambda s: s.isNotNull(),
        )

        def kept(p: Column, i: Column, spans: Column) -> Column:
            return (
                F.when(F.exists(spans, lambda s: (i >= s["lo"]) & (i < s["hi"])), "")
                .when(
                    F.exists(spans, lambda s: i == s["hi"]),
                    F.regexp_replace(p, r"(?i)^</tbody[^>]*>", ""),
                )
                .otherwise(p)
            )

        return let(
            hidden,
            lambda spans: F.array_join(F.transform(parts, lambda p, i: kept(p, i, spans)), ""),
        )

    inside = F.exists(
        F.regexp_extract_all(c, F.lit(flat), 0), lambda b: _holds_tag(F.substr(b, F.lit(2)), "tbody")
    )
    return F.when(inside, _elements(c, "tbody", shown)).otherwise(F.regexp_replace(c, flat, ""))
