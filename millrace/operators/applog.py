"""App log lines: validity split, parsing, three-way routing, display explode."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.jsontext import (
    OBJECT_TYPE,
    drop_nulls,
    encode,
    field,
    parsed_object,
    present,
    with_parsed,
    without_nulls,
)

START, DISPLAY, PAGE, DIRTY = "start", "display", "page", "dirty"


@dataclass(frozen=True)
class LogTopics:
    """Where each kind of line goes."""

    start: str = "dwd_start_log"
    display: str = "dwd_display_log"
    page: str = "dwd_page_log"
    dirty: str = "dirty_log"


def valid_lines(lines: DataFrame, text: str = "value") -> DataFrame:
    """Lines that are one JSON object, re-encoded without null fields."""
    parsed = with_parsed(lines, parsed_object(F.col(text)), "_doc").where("_doc is not null")
    return parsed.withColumn(text, without_nulls(encode(drop_nulls(F.col("_doc"))))).drop("_doc")


def dirty_lines(lines: DataFrame, text: str = "value") -> DataFrame:
    """Lines that are anything but one JSON object, untouched, with a reason."""
    parsed = with_parsed(lines, parsed_object(F.col(text)), "_doc").where("_doc is null")
    return parsed.drop("_doc").withColumn("reason", F.lit("not_json_object"))


def parse_lines(lines: DataFrame, text: str = "value", keep_dirty: bool = False) -> DataFrame:
    """Add ``doc`` (``map<string,variant>``); other lines are dropped unless ``keep_dirty``."""
    parsed = with_parsed(lines, parsed_object(F.col(text)), "doc")
    return parsed if keep_dirty else parsed.where("doc is not null")


def parse_log(lines: DataFrame, text: str = "value") -> DataFrame:
    """Parse and classify every line once.

    Adds ``doc``, the fields the jobs read (``mid, is_new, page_id, last_page_id, ts``),
    ``route`` (start, display, page, dirty) and, for dirty lines, ``dirty_reason``.
    """
    parsed = parse_lines(lines, text, keep_dirty=True).withColumns(
        {
            "_common": field("doc", "common", "struct<mid:string,is_new:string>"),
            "_page": field("doc", "page", "struct<page_id:string,last_page_id:string>"),
            "ts": field("doc", "ts", "bigint"),
        }
    )
    dirty_reason = (
        F.when(F.col("doc").isNull(), "not_json_object")
        .when(F.col("_common.mid").isNull(), "no_mid")
        .when(present("doc", "start"), F.lit(None))
        .when(F.col("_page").isNull(), "no_page")
        .when(present("doc", "displays") & ~_all_objects(_displays()), "bad_displays")
    )
    route = (
        F.when(F.col("dirty_reason").isNotNull(), DIRTY)
        .when(present("doc", "start"), START)
        .when(present("doc", "displays"), DISPLAY)
        .otherwise(PAGE)
    )
    return (
        parsed.withColumns(
            {
                "mid": F.col("_common.mid"),
                "is_new": F.col("_common.is_new"),
                "page_id": F.col("_page.page_id"),
                "last_page_id": F.col("_page.last_page_id"),
                "dirty_reason": dirty_reason,
            }
        )
        .withColumn("route", route)
        .drop("_common", "_page")
    )


def explode_displays(routed: DataFrame) -> DataFrame:
    """One row per display item of each display line: its object with ``page_id`` added."""
    shown = routed.where(F.col("route") == DISPLAY)
    return shown.withColumn("item", F.explode(_displays())).withColumn("item", _with_page_id())


def log_outputs(
    routed: DataFrame, topics: LogTopics = LogTopics(), pages_with_displays: bool = False
) -> DataFrame:
    """Every output of the log job as rows of ``topic, value, reason``, from one pass.

    The arrival position ``seq`` of the line is passed on where there is one.
    Lines with displays feed only the display topic; ``pages_with_displays`` sends
    them to the page topic as well.
    """
    whole_line = F.array(F.lit(None).cast(OBJECT_TYPE))
    shown = F.when(
        F.col("route") == DISPLAY,
        F.concat(_displays(), whole_line) if pages_with_displays else _displays(),
    ).otherwise(whole_line)
    rows = routed.withColumn("item", F.explode(shown))
    is_item = F.col("item").isNotNull()
    topic = (
        F.when(F.col("route") == DIRTY, topics.dirty)
        .when(F.col("route") == START, topics.start)
        .when(is_item, topics.display)
        .otherwise(topics.page)
    )
    value = (
        F.when(F.col("route") == DIRTY, F.col("value"))
        .when(is_item, without_nulls(encode(drop_nulls(_with_page_id()))))
        .otherwise(without_nulls(encode(drop_nulls(line_object(routed)))))
    )
    passed = [c for c in ("seq",) if c in rows.columns]
    return rows.select(
        topic.alias("topic"), value.alias("value"), F.col("dirty_reason").alias("reason"), *passed
    )


def line_object(df: DataFrame) -> Column:
    """``doc`` with the repaired flag written back where the repair changed it."""
    doc = F.col("doc")
    if "flag_repaired" not in df.columns:
        return doc
    common = F.expr(f"try_variant_get(doc['common'], '$', '{OBJECT_TYPE}')")
    flag = F.create_map(F.lit("is_new"), F.col("is_new").cast("variant"))
    common = F.map_concat(F.map_filter(common, lambda k, v: k != "is_new"), flag)
    repaired = F.map_concat(
        F.map_filter(doc, lambda k, v: k != "common"),
        F.create_map(F.lit("common"), F.to_variant_object(common)),
    )
    return F.when(F.col("flag_repaired"), repaired).otherwise(doc)


def _displays() -> Column:
    return field("doc", "displays", f"array<{OBJECT_TYPE}>")


def _all_objects(items: Column) -> Column:
    return F.coalesce(F.forall(items, lambda item: item.isNotNull()), F.lit(False))


def _with_page_id() -> Column:
    kept = F.map_filter(F.col("item"), lambda k, v: k != "page_id")
    return F.when(
        F.col("page_id").isNotNull(),
        F.map_concat(kept, F.create_map(F.lit("page_id"), F.col("page_id").cast("variant"))),
    ).otherwise(kept)
