"""Order x detail interval join on streams, and the orders it leaves out, as keyed state shared by buckets of orders.

Spark's stream-stream join keeps an entry of the state store per row and looks up, writes and evicts each one, which costs
more than all else a row passes through.  Here orders and details are one stream, grouped by (bucket of orders, time slice), and a
group holds the rows that may still meet others as one Arrow stream per side.  A micro-batch reads the held rows of its groups,
matches them with the new ones by sorted search, and writes back those the watermark leaves.  The rows a wide row is made of pass through
Python as one packed text per row.  Rows, late rows and eviction are those of the stream-stream join.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState

from millrace.functions.timetext import event_time
from millrace.operators.orders import DETAIL_FIELDS, ORDER_FIELDS, parse_details, parse_orders, wide_columns
from millrace.operators.timeslices import default_width, slice_of, with_slices

BUCKETS = 256  # of orders; fixed for the life of a checkpoint
PAIRS_AT_ONCE = 10_000

# Python holds event times between 1677 and 2262; the years 1700 and 2200 stand for those beyond.
FIRST_MS, LAST_MS = -8_520_336_000_000, 7_258_118_400_000

_HELD = "orders binary, details binary"
_ORDER = {**ORDER_FIELDS, "create_date": "string", "create_hour": "string"}
_DETAIL = {name: type_ for name, type_ in DETAIL_FIELDS.items() if name not in ("order_id", "create_time")}


def watermarked(parsed: DataFrame, delay: str = "0 seconds") -> DataFrame:
    """Event time and watermark from ``create_ts``."""
    ts = F.greatest(F.least(F.col("create_ts"), F.lit(LAST_MS)), F.lit(FIRST_MS))
    timed = F.when(F.col("create_ts").isNotNull(), event_time(ts))
    return parsed.withColumn("event_time", timed).withWatermark("event_time", delay)


def interval_join_stream(
    order_lines: DataFrame,
    detail_lines: DataFrame,
    bound_ms: int = 5_000,
    delay: str = "0 seconds",
    slice_ms: int | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Wide rows from two streams of JSON text; rows later than ``delay`` are dropped.

    As in the batch form an order near a slice border is copied into the next slice and a detail is in one slice only, so
    every pair meets once and an order id with very many details is spread over slices.
    """
    width = slice_ms or default_width(bound_ms)
    orders = with_slices(watermarked(parse_orders(order_lines), delay), "create_ts", width, bound_ms, bound_ms)
    details = watermarked(parse_details(detail_lines), delay).where(F.col("order_id").isNotNull())
    details = details.withColumn("slice", slice_of(F.col("create_ts"), width))
    rows = _one_stream(orders, details, _packed(_ORDER), _packed(_DETAIL), buckets, "slice")
    pairs = rows.groupBy("bucket", "slice").applyInPandasWithState(
        PairsOfGroup(bound_ms), "o string, d string", _HELD, "append", "EventTimeTimeout"
    )
    return pairs.select(_unpacked("o", _ORDER).alias("o"), _unpacked("d", _DETAIL).alias("d")).select(*wide_columns())


def unmatched_orders_stream(
    order_lines: DataFrame,
    detail_lines: DataFrame,
    bound_ms: int = 5_000,
    delay: str = "0 seconds",
    buckets: int = BUCKETS,
) -> DataFrame:
    """Orders of two streams of JSON text that no detail met, each once, when their interval has passed.

    Only the distinct (order, time) pairs of the details are held, and of the orders those that none has met yet.  The event
    time of the result carries no watermark.
    """
    orders = watermarked(parse_orders(order_lines), delay).where(F.col("id").isNotNull())
    details = watermarked(parse_details(detail_lines), delay)
    fields = {name: type_ for name, type_ in orders.dtypes if name != "event_time"}
    rows = _one_stream(orders, details, _packed(fields), F.lit(None).cast("string"), buckets)
    alone = rows.groupBy("bucket").applyInPandasWithState(
        AloneInGroup(bound_ms), "o string", _HELD, "append", "EventTimeTimeout"
    )
    return alone.select(_unpacked("o", fields).alias("o")).select("o.*", event_time(F.col("o.create_ts")).alias("event_time"))


def _one_stream(orders: DataFrame, details: DataFrame, order: Column, detail: Column, buckets: int, *key: str) -> DataFrame:
    """Orders and details as rows of one layout; those without a key or a time meet nothing."""
    sides = []
    for rows, is_order, id_, text in ((orders, True, "id", order), (details, False, "order_id", detail)):
        bucket = F.pmod(F.xxhash64(id_), F.lit(buckets)).cast("int")
        # a filter on the event time stays above the watermark: times are not worked out once more, rows without key move it on
        rows = rows.where(F.when(F.col("event_time").isNotNull(), F.col(id_)).isNotNull())
        sides.append(
            rows.select(
                bucket.alias("bucket"), *key, "event_time", F.lit(is_order).alias("is_order"),
                F.col(id_).alias("id"), F.col("create_ts").alias("ts"), text.alias("text"),
            )
        )
    return sides[0].unionByName(sides[1])


# --- packed rows --------------------------------------------------------------------

_PLAIN = ("bigint", "int", "boolean", "date", "decimal")
_MICROS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
_END = "\x1f"


def _packed(fields: Mapping[str, str]) -> Column:
    r"""The fields of a row as one text: \b, \s and \N are a backslash, the sign between fields and null."""
    parts = []
    for name, type_ in fields.items():
        text = F.col(name).cast("string")
        if not type_.startswith((*_PLAIN, "string")):
            text = F.to_json(F.struct(name), {"ignoreNullFields": "false", **_MICROS})
        if not type_.startswith(_PLAIN):
            text = F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit(_END), F.lit("\\s"))
        parts.append(F.coalesce(text, F.lit("\\N")))
    return F.concat_ws(_END, *parts)


def _unpacked(packed: str, fields: Mapping[str, str]) -> Column:
    """A struct of the fields of a packed row."""
    parts, columns = F.split(packed, _END), []
    for place, (name, type_) in enumerate(fields.items()):
        text = F.nullif(F.get(parts, F.lit(place)), F.lit("\\N"))
        if not type_.startswith(_PLAIN):
            text = F.replace(F.replace(text, F.lit("\\s"), F.lit(_END)), F.lit("\\b"), F.lit("\\"))
        if type_.startswith((*_PLAIN, "string")):
            columns.append(text.cast(type_).alias(name))
        else:
            columns.append(F.from_json(text, f"struct<`{name}`:{type_}>", _MICROS)[name].alias(name))
    return F.struct(*columns)


# --- groups -------------------------------------------------------------------------


@dataclass(frozen=True)
class _Side:
    """Rows of orders or details: order id, time and packed text."""

    ids: np.ndarray
    ts: np.ndarray
    texts: np.ndarray

    def __len__(self) -> int:
        return len(self.ids)

    def at(self, places: np.ndarray) -> _Side:
        return _Side(self.ids[places], self.ts[places], self.texts[places])

    def to_bytes(self) -> bytes:
        columns = [pa.array(self.ids), pa.array(self.ts), pa.array(self.texts, pa.large_string())]
        rows, sink = pa.record_batch(columns, ["id", "ts", "text"]), pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as out:
            out.write_batch(rows)
        return sink.getvalue().to_pybytes()

    @staticmethod
    def from_bytes(held: bytes) -> _Side:
        ids, ts, texts = pa.ipc.open_stream(held).read_all().columns
        return _Side(ids.to_numpy(), ts.to_numpy(), texts.to_numpy())


def _joined(sides: Iterable[_Side]) -> _Side:
    sides = list(sides)
    if len(sides) == 1:
        return sides[0]
    ints = np.empty(0, np.int64)
    return _Side(
        np.concatenate([ints, *(s.ids for s in sides)]),
        np.concatenate([ints, *(s.ts for s in sides)]),
        np.concatenate([np.empty(0, object), *(s.texts for s in sides)]),
    )


def _new(chunks: Iterable[pd.DataFrame], state: GroupState) -> tuple[_Side, _Side]:
    """The orders and the details that came with a micro-batch."""
    sides: tuple[list[_Side], list[_Side]] = [], []
    for rows in chunks if not state.hasTimedOut else ():
        both = _Side(rows["id"].to_numpy(), rows["ts"].to_numpy(), rows["text"].to_numpy())
        is_order = rows["is_order"].to_numpy(bool)
        for kept, side in zip((is_order, ~is_order), sides, strict=True):
            if kept.any():
                side.append(both.at(kept))
    return _joined(sides[0]), _joined(sides[1])


def _held(state: GroupState) -> tuple[_Side, _Side]:
    orders, details = state.get if state.exists else (None, None)
    return tuple(_Side.from_bytes(bytes(side)) if side else _joined([]) for side in (orders, details))


def _hold(state: GroupState, orders: _Side, details: _Side, bound_ms: int) -> None:
    """Keep the rows given, and have the group looked at again when the watermark has passed the first of them."""
    if not (len(orders) or len(details)):
        if state.exists:
            state.remove()
        return
    state.update(tuple(side.to_bytes() if len(side) else None for side in (orders, details)))
    due = bound_ms + min(int(side.ts.min()) for side in (orders, details) if len(side))
    state.setTimeoutTimestamp(max(due, state.getCurrentWatermarkMs(), 1))


def _near(orders: _Side, details: _Side, bound_ms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order of the orders by (id, time) and, for each detail, the first of its orders there and their number."""
    ids, id_rank = np.unique(orders.ids, return_inverse=True)
    times, time_rank = np.unique(orders.ts, return_inverse=True)
    step = len(times) + 1
    codes = id_rank * step + time_rank
    by_code = np.argsort(codes, kind="stable")
    codes = codes[by_code]
    rank = np.minimum(np.searchsorted(ids, details.ids), max(len(ids) - 1, 0))
    known = ids[rank] == details.ids if len(ids) else np.zeros(len(details), bool)
    first = np.searchsorted(codes, rank * step + np.searchsorted(times, details.ts - bound_ms, "left"))
    end = np.searchsorted(codes, rank * step + np.searchsorted(times, details.ts + bound_ms, "right"))
    return by_code, first, np.where(known, end - first, 0)


@dataclass(frozen=True)
class PairsOfGroup:
    """The pairs of orders and details within ``bound_ms`` of each other, each in the micro-batch that completes it."""

    bound_ms: int

    def __call__(self, key: tuple, chunks: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        old_orders, old_details = _held(state)
        orders, details = _new(chunks, state)
        yield from self._pairs(_joined([old_orders, orders]), details)
        yield from self._pairs(orders, old_details)
        watermark = state.getCurrentWatermarkMs()
        both = (_joined([old_orders, orders]), _joined([old_details, details]))
        _hold(state, *(side.at(side.ts + self.bound_ms >= watermark) for side in both), self.bound_ms)

    def _pairs(self, orders: _Side, details: _Side) -> Iterator[pd.DataFrame]:
        if not (len(orders) and len(details)):
            return
        by_code, first, n = _near(orders, details, self.bound_ms)
        ends = np.cumsum(n)
        # some at a time, as one order may meet very many details
        for start in range(0, int(ends[-1]), PAIRS_AT_ONCE):
            pair = np.arange(start, min(start + PAIRS_AT_ONCE, int(ends[-1])))
            detail = np.searchsorted(ends, pair, "right")
            order = by_code[first[detail] + pair - (ends - n)[detail]]
            yield pd.DataFrame({"o": orders.texts[order], "d": details.texts[detail]})


@dataclass(frozen=True)
class AloneInGroup:
    """The orders that no detail met within ``bound_ms``, each once the watermark has passed its interval."""

    bound_ms: int

    def __call__(self, key: tuple, chunks: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        old_orders, old_details = _held(state)
        orders, details = _new(chunks, state)
        times = pd.DataFrame({"id": details.ids, "ts": details.ts})
        details = details.at(~times.duplicated().to_numpy())
        every, seen = _joined([old_orders, orders]), _joined([old_details, details])
        every = every.at(~self._met(every, seen))
        watermark = state.getCurrentWatermarkMs()
        passed = every.ts + self.bound_ms < watermark
        for start in range(0, int(passed.sum()), PAIRS_AT_ONCE):
            yield pd.DataFrame({"o": every.texts[passed][start : start + PAIRS_AT_ONCE]})
        _hold(state, every.at(~passed), seen.at(seen.ts + self.bound_ms >= watermark), self.bound_ms)

    def _met(self, orders: _Side, details: _Side) -> np.ndarray:
        """Whether an order has a detail; the ranges of the details are marked at their ends and summed."""
        by_code, first, n = _near(orders, details, self.bound_ms)
        met = np.zeros(len(orders), bool)
        marks = np.zeros(len(orders) + 1, np.int64)
        np.add.at(marks, first[n > 0], 1)
        np.add.at(marks, (first + n)[n > 0], -1)
        met[by_code] = np.cumsum(marks)[:-1] > 0
        return met
