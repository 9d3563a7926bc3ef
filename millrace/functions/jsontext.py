"""JSON text <-> columns.

Objects whose columns are not known ahead are held as ``map<string,variant>``:
unknown fields, JSON types and explicit nulls all survive a round trip.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OBJECT_TYPE = "map<string,variant>"


def parsed_object(text: Column) -> Column:
    """An array of one ``map<string,variant>``, null unless the text is one JSON object.

    The text is parsed as the only element of an array, so that trailing garbage
    after the closing brace makes it invalid instead of being ignored.
    """
    wrapped = F.from_json(F.concat(F.lit("["), text, F.lit("]")), f"array<{OBJECT_TYPE}>")
    return F.transform(F.array(wrapped), lambda a: F.when(F.size(a) == 1, F.get(a, F.lit(0))))


def with_parsed(df: DataFrame, parsed: Column, name: str) -> DataFrame:
    """Add the only element of ``parsed`` as a column that is computed once per row.

    Filters are pushed through a projection by copying the projected expression,
    which would parse the text again in every filter.  They are not pushed through
    a generator, so the parse is emitted by a one-element explode.
    """
    return df.select("*", F.explode(parsed).alias(name))


def field(obj: str, name: str, type_: str = "string") -> Column:
    """A field of a ``map<string,variant>`` column; a dotted name reaches inside."""
    head, _, rest = name.partition(".")
    path = f"$.{rest}" if rest else "$"
    return F.expr(f"try_variant_get({obj}['{head}'], '{path}', '{type_}')")


def present(obj: str, name: str) -> Column:
    """True when the field exists and is not JSON null."""
    return F.expr(f"{obj}['{name}'] is not null and not is_variant_null({obj}['{name}'])")


def encode(obj: Column, keep_nulls: bool = False) -> Column:
    """JSON text of a struct or map.

    Structs drop null fields unless ``keep_nulls``; for maps the same choice applies
    to their entries.
    """
    return F.to_json(obj, {"ignoreNullFields": "false" if keep_nulls else "true"})


# One JSON string; every quote outside a string begins one, so a scan from the left stays in step.
_STRING = r'"(?:[^"\\]|\\.)*+"'


def without_nulls(text: Column) -> Column:
    """JSON text as ``to_json`` writes it, without the fields that are null, at every level.

    Nulls in arrays stay.  Strings are passed over whole, so what they hold is never taken for a field.
    """
    fields = F.regexp_replace(text, rf"{_STRING}:null,?|({_STRING})", "$1")
    ends = F.regexp_replace(fields, rf"({_STRING})|,(?=\}})", "$1")
    return F.when(text.contains(":null"), ends).otherwise(text)


def drop_nulls(obj: Column) -> Column:
    """Remove entries that are JSON null from a ``map<string,variant>``."""
    return F.map_filter(obj, lambda k, v: ~F.is_variant_null(v))


def as_text(value: Column) -> Column:
    """A variant as plain text: strings unquoted, objects and arrays as JSON."""
    return F.try_variant_get(value, "$", "string")
