"""Column functions that read JSON out of free-form responses.

A response is either one JSON object, or text with a fenced JSON block.  Anything
else, trailing text after the object included, is no JSON and gives null.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from docengine.functions.fixed_values import FENCE
from docengine.functions.text import let

STRICT = {"allowSingleQuotes": "false"}


def _only(c: Column, item: str) -> Column:
    """The text as one JSON value of type `item`; null for more, less or other."""
    return _sole(
        F.from_json(F.concat(F.lit("["), c, F.lit("]")), f"array<{item}>", STRICT)
    )


def _sole(items: Column) -> Column:
    return let(items, lambda a: F.when(F.size(a) == 1, F.get(a, F.lit(0))))


def fence(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, FENCE, 1), F.lit(""))


def parse_object(c: Column, item: str = "map<string,variant>") -> Column:
    """Response to a map; a fenced list holding one object is unwrapped."""
    return F.coalesce(
        _only(c, item),
        let(fence(c), lambda f: F.coalesce(_only(f, item), _sole(_only(f, f"array<{item}>")))),
    )


def last_value(entries: Column, key: Column) -> Column:
    """Value of `key` in map entries; of repeated keys the last one counts."""
    return F.try_element_at(F.filter(entries, lambda e: e["key"] == key), F.lit(-1))[
        "value"
    ]


def _is_list(v: Column) -> Column:
    return F.schema_of_variant(v).startswith("ARRAY")


def _is_text_list(v: Column) -> Column:
    return F.forall(
        v.cast("array<variant>"), lambda x: F.schema_of_variant(x) == "STRING"
    )


def field_text(v: Column) -> Column:
    """Field value as text: a list is joined by `", "`, other values are written out."""
    return F.when(
        _is_list(v), F.array_join(v.cast("array<string>"), ", ")
    ).otherwise(v.cast("string"))


def read_fields(c: Column, fields: list[str], default: str = "NA") -> Column:
    """`map<field, text>` of a response; `default` for what cannot be read.

    A list with anything but strings in it spoils the whole response.
    """

    def read(entries: Column) -> Column:
        spoilt = F.exists(
            entries, lambda e: _is_list(e["value"]) & ~_is_text_list(e["value"])
        )
        values = F.transform(
            F.array(*[F.lit(f) for f in fields]),
            lambda f: F.coalesce(
                F.when(~spoilt, field_text(last_value(entries, f))), F.lit(default)
            ),
        )
        return F.map_from_arrays(F.array(*[F.lit(f) for f in fields]), values)

    return let(F.map_entries(parse_object(c)), read)


def read_topics(c: Column) -> Column:
    """`array<struct<key, value>>` of topic and section names, as listed in a response.

    Only the first name of the response counts.  Null when there is no such object.
    """

    def sections(value: Column) -> Column:
        listed = F.from_json(value, "array<string>")
        return F.coalesce(
            F.when(F.startswith(value, F.lit("[")), listed), F.array(value)
        )

    def read(entries: Column) -> Column:
        topics = F.from_json(
            last_value(entries, F.get(entries, F.lit(0))["key"]),
            "array<map<string,string>>",
        )
        return F.transform(
            F.flatten(F.transform(topics, F.map_entries)),
            lambda e: F.struct(e["key"].alias("key"), sections(e["value"]).alias("value")),
        )

    parsed = F.coalesce(
        _only(c, "map<string,string>"),
        let(fence(c), lambda f: _only(f, "map<string,string>")),
    )
    return let(F.map_entries(parsed), read)
