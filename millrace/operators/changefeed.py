"""Database change records: normalise to one envelope, filter, decode images."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.jsontext import OBJECT_TYPE, encode, field, parsed_object, with_parsed

# Operation names of the envelope by record code (fixed values).
OPERATIONS = {
    "c": "insert",
    "create": "insert",
    "u": "update",
    "d": "delete",
    "r": "read",
}

_IMAGES = "op:string,before:variant,after:variant"
_RECORD = f"struct<{_IMAGES},payload:struct<{_IMAGES}>>"
# Fields of the envelope (fixed values).
ENVELOPE = ("type", "data", "before", "database", "tableName")


def normalise(
    records: DataFrame, topic: str = "topic", value: str = "value", keep_dirty: bool = False
) -> DataFrame:
    """Change records -> envelope columns ``type, data, before, database, tableName``.

    ``topic`` is ``server.database.table``; ``value`` is the record as JSON with
    ``op, before, after``, bare or under ``payload``.  Absent images become ``{}``;
    null columns inside an image are kept.  Other columns pass through.  With ``keep_dirty``
    records that are no JSON text or name no operation keep their text and get a ``dirty_reason``.
    """
    parsed = with_parsed(records, F.array(F.from_json(F.col(value), _RECORD)), "_r")
    parsed = parsed.withColumn(
        "_r",
        F.coalesce(
            F.col("_r.payload"),
            F.struct(F.col("_r.op"), F.col("_r.before"), F.col("_r.after")),
        ),
    )
    parts = F.split(F.col(topic), r"\.")
    op = F.lower("_r.op")
    codes = F.create_map(*[F.lit(x) for pair in OPERATIONS.items() for x in pair])
    passed = [c for c in records.columns if c not in (topic, value)]
    reason = F.when(F.try_parse_json(value).isNull(), "not_json").when(op.isNull(), "no_operation")
    dirty = [F.when(reason.isNotNull(), F.col(value)).alias(value), reason.alias("dirty_reason")]
    return parsed.select(
        *passed,
        *(dirty if keep_dirty else []),
        F.coalesce(codes[op], op).alias("type"),
        _image("_r.after").alias("data"),
        _image("_r.before").alias("before"),
        F.get(parts, F.lit(1)).alias("database"),
        F.get(parts, F.lit(2)).alias("tableName"),
    )


def _image(name: str) -> Column:
    absent = F.col(name).isNull() | F.is_variant_null(name)
    return F.when(absent, F.lit("{}")).otherwise(F.to_json(name))


def encode_envelope(changes: DataFrame) -> DataFrame:
    """Add ``value``: the envelope as JSON text, nulls kept."""
    return changes.withColumn("value", encode(F.struct(*ENVELOPE), keep_nulls=True))


def decode_envelope(lines: DataFrame, text: str = "value", keep_dirty: bool = False) -> DataFrame:
    """Envelope columns from JSON text.

    Lines that are not one JSON object are dropped, or with ``keep_dirty`` kept with
    their text and a ``dirty_reason``.
    """
    parsed = with_parsed(lines, parsed_object(F.col(text)), "_doc")
    is_dirty = F.col("_doc").isNull()
    if not keep_dirty:
        parsed = parsed.where(~is_dirty)
    passed = [c for c in lines.columns if c != text]
    dirty = [
        F.when(is_dirty, F.col(text)).alias(text),
        F.when(is_dirty, "not_json_object").alias("dirty_reason"),
    ]
    return parsed.select(*passed, *[field("_doc", c).alias(c) for c in ENVELOPE], *(dirty if keep_dirty else []))


def only_tables(changes: DataFrame, tables: Sequence[str] = (), keep: str | None = None) -> DataFrame:
    """Keep changes of the given ``database.table`` names; none given keeps all.

    Rows with a value in the column ``keep`` stay whatever their table, such as records that name none.
    """
    if not tables:
        return changes
    wanted = F.concat_ws(".", "database", "tableName").isin(list(tables))
    return changes.where(wanted | F.col(keep).isNotNull() if keep else wanted)


def nonempty(
    changes: DataFrame, keep_deletes: bool = False, read_as_insert: bool = False
) -> DataFrame:
    """Keep changes that carry an image.

    Deletes have none and fall out; ``keep_deletes`` lets them carry the old image.
    ``read_as_insert`` treats rows of an initial snapshot as inserts.
    """
    if keep_deletes:
        old = F.when(F.col("type") == "delete", F.col("before")).otherwise(F.col("data"))
        changes = changes.withColumn("data", old)
    if read_as_insert:
        op = F.when(F.col("type") == "read", "insert").otherwise(F.col("type"))
        changes = changes.withColumn("type", op)
    return changes.where(F.length("data") > 2)


def decode_image(changes: DataFrame, image: str = "data") -> DataFrame:
    """Replace the JSON text of an image with ``map<string,variant>``."""
    parsed = with_parsed(changes, F.array(F.from_json(F.col(image), OBJECT_TYPE)), "_image")
    return parsed.withColumn(image, F.col("_image")).drop("_image")
