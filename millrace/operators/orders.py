"""Orders: parse, join with details by time interval, build and enrich the wide row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.jsontext import with_parsed
from millrace.functions.timetext import age_years, date_part, hour_part, time_millis, time_text
from millrace.operators.dimensions import DimSpec, HotKeys, hot_keys, join_dim
from millrace.operators.timeslices import default_width, slice_of, with_slices

MONEY = "decimal(16,2)"

# Record layouts (fixed values).
ORDER_FIELDS = {
    "id": "bigint",
    "province_id": "bigint",
    "order_status": "string",
    "user_id": "bigint",
    "total_amount": MONEY,
    "activity_reduce_amount": MONEY,
    "coupon_reduce_amount": MONEY,
    "original_total_amount": MONEY,
    "feight_fee": MONEY,
    "expire_time": "string",
    "create_time": "string",
    "operate_time": "string",
}
DETAIL_FIELDS = {
    "id": "bigint",
    "order_id": "bigint",
    "sku_id": "bigint",
    "order_price": MONEY,
    "sku_num": "bigint",
    "sku_name": "string",
    "create_time": "string",
    "split_total_amount": MONEY,
    "split_activity_amount": MONEY,
    "split_coupon_amount": MONEY,
}
WIDE_FIELDS = {
    "detail_id": "bigint",
    "order_id": "bigint",
    "sku_id": "bigint",
    "order_price": MONEY,
    "sku_num": "bigint",
    "sku_name": "string",
    "province_id": "bigint",
    "order_status": "string",
    "user_id": "bigint",
    "total_amount": MONEY,
    "activity_reduce_amount": MONEY,
    "coupon_reduce_amount": MONEY,
    "original_total_amount": MONEY,
    "feight_fee": MONEY,
    "split_feight_fee": MONEY,
    "split_activity_amount": MONEY,
    "split_coupon_amount": MONEY,
    "split_total_amount": MONEY,
    "expire_time": "string",
    "create_time": "string",
    "operate_time": "string",
    "create_date": "string",
    "create_hour": "string",
    "province_name": "string",
    "province_area_code": "string",
    "province_iso_code": "string",
    "province_3166_2_code": "string",
    "user_age": "int",
    "user_gender": "string",
    "spu_id": "bigint",
    "tm_id": "bigint",
    "category3_id": "bigint",
    "spu_name": "string",
    "tm_name": "string",
    "category3_name": "string",
}

# The six lookups of the wide row (fixed values: dimension and column names).
USER = DimSpec("dim_user_info", "user_id", {"gender": "user_gender", "birthday": "birthday"})
PROVINCE = DimSpec(
    "dim_base_province",
    "province_id",
    {
        "name": "province_name",
        "area_code": "province_area_code",
        "iso_code": "province_iso_code",
        "iso_3166_2": "province_3166_2_code",
    },
)
TRADEMARK = DimSpec("dim_base_trademark", "tm_id", {"tm_name": "tm_name"})
CATEGORY3 = DimSpec("dim_base_category3", "category3_id", {"name": "category3_name"})
SPU = DimSpec("dim_spu_info", "spu_id", {"spu_name": "spu_name"})
SKU = DimSpec(
    "dim_sku_info",
    "sku_id",
    {"tm_id": "tm_id", "category3_id": "category3_id", "spu_id": "spu_id"},
    then=(TRADEMARK, CATEGORY3, SPU),
)
WIDE_DIMS = (USER, PROVINCE, SKU)


def parse_orders(lines: DataFrame, text: str = "value", keep_dirty: bool = False) -> DataFrame:
    """Order records plus ``create_date, create_hour, create_ts``; see ``_parse`` for ``keep_dirty``."""
    orders = _parse(lines, text, ORDER_FIELDS, ("id",), keep_dirty)
    return orders.withColumns(
        {
            "create_date": date_part(F.col("create_time")),
            "create_hour": hour_part(F.col("create_time")),
        }
    )


def parse_details(lines: DataFrame, text: str = "value", keep_dirty: bool = False) -> DataFrame:
    """Order detail records plus ``create_ts``; see ``_parse`` for ``keep_dirty``."""
    return _parse(lines, text, DETAIL_FIELDS, ("id", "order_id"), keep_dirty)


def _parse(
    lines: DataFrame, text: str, fields: Mapping[str, str], needed: Sequence[str], keep_dirty: bool
) -> DataFrame:
    """Records by their layout, with ``create_ts``.

    A record that is no JSON object (such as one that was cut off), lacks a key or has no time can meet nothing.  With
    ``keep_dirty`` such records keep their text and get a ``dirty_reason``; otherwise those that are no
    JSON object are dropped and the others pass with nulls.
    """
    schema = "struct<" + ",".join(f"{n}:{t}" for n, t in fields.items()) + ",_broken:string>"
    record = F.from_json(F.col(text), schema, {"columnNameOfCorruptRecord": "_broken"})
    parsed = with_parsed(lines, F.array(record), "_o")
    broken = F.col("_o").isNull() | F.col("_o._broken").isNotNull()
    columns = [F.col(f"_o.{n}").alias(n) for n in fields]
    passed = [c for c in lines.columns if c != text]
    dirty = [F.col(text).alias("_text"), broken.alias("_is_broken")] if keep_dirty else []
    rows = (parsed if keep_dirty else parsed.where(~broken)).select(*passed, *columns, *dirty)
    rows = rows.withColumn("create_time", time_text(F.col("create_time")))
    rows = rows.withColumn("create_ts", time_millis(F.col("create_time")))
    if not keep_dirty:
        return rows
    lacking = F.lit(False)
    for name in needed:
        lacking = lacking | F.col(name).isNull()
    reason = (
        F.when(F.col("_is_broken"), "not_json_object")
        .when(lacking, "no_key")
        .when(F.col("create_ts").isNull(), "no_time")
    )
    rows = rows.withColumn("dirty_reason", reason)
    return rows.withColumn(text, F.when(F.col("dirty_reason").isNotNull(), F.col("_text"))).drop("_text", "_is_broken")


def dirty_records(parsed: DataFrame, text: str = "value") -> DataFrame:
    """``value, reason`` of the records a parse with ``keep_dirty`` found fault with."""
    return parsed.where("dirty_reason is not null").select(F.col(text).alias("value"), F.col("dirty_reason").alias("reason"))


def unmatched_orders(orders: DataFrame, details: DataFrame, bound_ms: int = 5_000) -> DataFrame:
    """Orders without any detail created within ``bound_ms``: what the interval join leaves out.

    Only the distinct (order, second) pairs of the details take part, so an order with very many details costs no more
    than the seconds it spans.  With watermarked ``event_time`` columns the same plan runs on streams: an order comes
    out, once, when the watermark has passed the end of its interval.
    """
    streaming = "event_time" in orders.columns and "event_time" in details.columns
    at = ["order_id", "event_time"] if streaming else ["order_id", "create_ts"]
    seen = details.select(*at).where(F.col(at[1]).isNotNull()).dropDuplicates(at)
    o, d = orders.where(F.col("id").isNotNull() & F.col("create_ts").isNotNull()).alias("o"), seen.alias("d")
    same = F.col("o.id") == F.col("d.order_id")
    if not streaming:
        near = F.col("d.create_ts").between(F.col("o.create_ts") - bound_ms, F.col("o.create_ts") + bound_ms)
        return o.join(d, same & near, "left_anti")
    bound = F.expr(f"interval {bound_ms} milliseconds")
    near = F.col("d.event_time").between(F.col("o.event_time") - bound, F.col("o.event_time") + bound)
    return o.join(d, same & near, "left_outer").where(F.col("d.order_id").isNull()).select("o.*")


def interval_join(
    orders: DataFrame,
    details: DataFrame,
    bound_ms: int = 5_000,
    slice_ms: int | None = None,
) -> DataFrame:
    """Wide rows of details created within ``bound_ms`` of their order, ends included.

    Joined on (order id, time slice): an order near a slice border is copied into the
    next slice, a detail is in one slice only, so every pair meets exactly once and an
    order id with very many details is spread over slices.  With watermarked
    ``event_time`` columns on both sides the same plan runs as a stream-stream join
    whose state is bounded by the interval.
    """
    width = slice_ms or default_width(bound_ms)
    o = with_slices(orders, "create_ts", width, bound_ms, bound_ms).drop("own").alias("o")
    d = details.withColumn("slice", slice_of(F.col("create_ts"), width)).alias("d")
    on = (
        (F.col("o.id") == F.col("d.order_id"))
        & (F.col("o.slice") == F.col("d.slice"))
        & F.col("d.create_ts").between(
            F.col("o.create_ts") - bound_ms, F.col("o.create_ts") + bound_ms
        )
    )
    if "event_time" in orders.columns and "event_time" in details.columns:
        bound = F.expr(f"interval {bound_ms} milliseconds")
        on = on & F.col("d.event_time").between(
            F.col("o.event_time") - bound, F.col("o.event_time") + bound
        )
    return o.join(d, on).select(*wide_columns())


def wide_columns() -> list[Column]:
    """The wide row of an (order ``o``, detail ``d``) pair; lookups are added later."""
    return [
        F.col("d.id").alias("detail_id"),
        F.col("o.id").alias("order_id"),
        "d.sku_id",
        "d.order_price",
        "d.sku_num",
        "d.sku_name",
        "o.province_id",
        "o.order_status",
        "o.user_id",
        "o.total_amount",
        "o.activity_reduce_amount",
        "o.coupon_reduce_amount",
        "o.original_total_amount",
        "o.feight_fee",
        F.lit(None).cast(MONEY).alias("split_feight_fee"),
        "d.split_activity_amount",
        "d.split_coupon_amount",
        "d.split_total_amount",
        "o.expire_time",
        "o.create_time",
        "o.operate_time",
        "o.create_date",
        "o.create_hour",
    ]


def enrich(
    wide: DataFrame,
    dims: Mapping[str, DataFrame],
    as_of: str | None = None,
    narrow: bool = False,
    n_rows: int = 0,
) -> DataFrame:
    """Add the user, province, sku, trademark, category and product-group columns.

    Trademark, category and product group hang off the sku, so they are joined to the
    sku table first and the wide rows are shuffled at most three times, not six.
    ``narrow`` suits a small cached ``wide``: each dimension is reduced to its keys.  With
    ``n_rows``, the number of its rows, keys that very many of them share are split.
    """
    joined = wide
    for spec in WIDE_DIMS:
        # the keys of every lookup are columns of the wide rows as given
        keys = wide.select(spec.left_key) if narrow else None
        hot = hot_keys(wide, spec.left_key, n_rows) if narrow else HotKeys()
        joined = join_dim(joined, dims, spec, keys, hot)
    today = F.lit(as_of).cast("timestamp") if as_of else F.now()
    joined = joined.withColumn("user_age", age_years(F.col("birthday"), today))
    return joined.select(*[_typed(n, t) for n, t in WIDE_FIELDS.items()])


def _typed(name: str, type_: str) -> Column:
    column = F.col(name)
    return (column.try_cast(type_) if type_ == "bigint" else column.cast(type_)).alias(name)


# --- merging wide rows ----------------------------------------------------------------

# Columns a merge fills from the other row (fixed values).
MERGED = (
    "order_status",
    "create_time",
    "create_date",
    "coupon_reduce_amount",
    "activity_reduce_amount",
    "original_total_amount",
    "feight_fee",
    "total_amount",
    "user_id",
    "sku_id",
    "sku_name",
    "order_price",
    "sku_num",
)


def merge_wide(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Fill null columns of ``left`` from the matching row of ``right``."""
    r = right.select(*on, *[F.col(c).alias(f"_{c}") for c in MERGED])
    joined = left.join(r, list(on), "left")
    filled = {c: F.coalesce(F.col(c), F.col(f"_{c}")) for c in MERGED if c not in on}
    return joined.withColumns(filled).select(*left.columns)


def merge_wide_group(rows: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Fold the rows of a key in ``order``: per column the first value that is not null."""
    position = F.struct(*order)
    columns = [c for c in MERGED if c not in key]
    return rows.groupBy(*key).agg(
        *[F.min_by(c, F.when(F.col(c).isNotNull(), position)).alias(c) for c in columns]
    )
