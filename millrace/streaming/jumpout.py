"""Bounced visits on a stream: both definitions as one keyed stateful operator, or as window aggregates.

The operator emits a row as soon as it is decided; ``jumpouts_by_windows`` emits it when its window ends, and stays
out of Python.  Of the operator the key is (bucket of devices, time slice): devices are split by slices as in the batch form, so a busy
device is spread over tasks and its state ends with the slice, and those of one bucket share their state, as each access
to state from Python costs more than deciding a row.  Python code runs on the rows of one key that
are still undecided, which reach back no further than the bound.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from millrace.functions.timetext import event_time
from millrace.operators.timeslices import default_width, with_slices
from millrace.operators.visits import is_entry

BUCKETS = 256  # of devices; fixed for the life of a checkpoint

_STATE = "mid string, ts bigint, {position}, entry boolean, own boolean, done boolean, value string"
_OUTPUT = "mid string, ts bigint, {position}, value string, reason string"


class NeighbourDecisions(StatefulProcessor):
    """Decides each row once the row after it, or its absence, is certain.

    ``by_session`` selects the session definition, else the pattern definition.
    """

    def __init__(self, position: list[str], state: str, bound_ms: int, by_session: bool, emit_single: bool):
        self.position, self.state = position, state
        self.bound_ms, self.by_session, self.emit_single = bound_ms, by_session, emit_single

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", self.state)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        new = [
            (r.mid, r.ts, tuple(r[p] for p in self.position), r.entry, r.own, False, r.value) for r in rows
        ]
        yield from self._advance(new, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._advance([], timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass

    def _advance(self, new: list, watermark: int) -> Iterator[Row]:
        held = [(r[0], r[1], tuple(r[2:-4]), *r[-4:]) for r in self.rows.get()]
        # rows without a device are a group of their own
        together = sorted(held + new, key=lambda r: (r[0] is not None, r[0] or "", r[1], r[2]))
        kept, due = [], None
        for mid, group in groupby(together, key=lambda r: r[0]):
            open_rows, next_due = yield from self._decide(mid, [r[1:] for r in group], watermark)
            kept += [(mid, ts, *seq, *rest) for ts, seq, *rest in open_rows]
            if open_rows:
                due = next_due if due is None else min(due, next_due)
        if kept:
            self.rows.put(kept)
            self.handle.registerTimer(due)
        elif held:
            self.rows.clear()

    def _decide(self, mid, rows: list, watermark: int) -> Iterator[Row]:
        """Emit the decided rows of a device, sorted by time; returns those to keep and when to look again."""
        emitted = Row("mid", "ts", *self.position, "value", "reason")
        first_open = len(rows)
        for i, (ts, seq, entry, own, done, value) in enumerate(rows):
            after = rows[i + 1] if i + 1 < len(rows) else None
            # rows at or before the watermark can no longer arrive
            if not (ts + self.bound_ms <= watermark or (after and after[0] <= watermark)):
                first_open = i
                break
            if not done and own and entry:
                reason = self._reason(ts, rows[i - 1] if i else None, after)
                if reason:
                    yield emitted(mid, ts, *seq, value, reason)
        return self._open(rows, first_open, watermark)

    def _reason(self, ts: int, before: tuple | None, after: tuple | None) -> str | None:
        if self.by_session:
            goes_on = after is not None and after[0] - ts <= self.bound_ms
            joined = before is not None and ts - before[0] <= self.bound_ms
            if goes_on:
                return "match" if after[2] else None
            return "end" if joined or self.emit_single else None
        if after is None or after[0] - ts >= self.bound_ms:
            return "timeout"
        return "match" if after[2] else None

    def _open(self, rows: list, first_open: int, watermark: int) -> tuple[list, int | None]:
        """Open rows and, as their predecessor, the last decided one; and the time that decides the next."""
        kept = list(rows[first_open:])
        if first_open:
            ts, seq, entry, own, _, _ = rows[first_open - 1]
            if kept or ts + self.bound_ms > watermark:
                kept.insert(0, (ts, seq, entry, own, True, None))
        if not kept:
            return [], None
        if first_open < len(rows):
            due = rows[first_open][0] + self.bound_ms
            if first_open + 1 < len(rows):
                due = min(due, rows[first_open + 1][0])
        else:
            due = kept[0][0] + self.bound_ms
        return kept, due


def jumpouts_stream(
    pages: DataFrame,
    bound_ms: int = 10_000,
    by_session: bool = False,
    emit_single: bool = False,
    delay: str = "1 second",
    slice_ms: int | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Bounced visits of a stream of page rows ``mid, ts, seq, last_page_id, value``.

    A row is emitted once the watermark (``delay`` behind the newest event) has passed
    the row after it, or its time plus the bound.  Needs the RocksDB state store.
    """
    width = slice_ms or default_width(bound_ms)
    rows = (
        pages.where("ts is not null")
        .withColumn("event_time", event_time(F.col("ts")))
        .withWatermark("event_time", delay)
        .withColumn("entry", is_entry())
    )
    rows = with_slices(rows, "ts", width, bound_ms if by_session else 0, bound_ms)
    value = F.when(F.col("own") & F.col("entry"), F.col("value"))
    parts = _position_parts(pages)
    rows = rows.select(
        F.pmod(F.xxhash64("mid"), F.lit(buckets)).cast("int").alias("bucket"),
        "mid", "slice", "event_time", "ts", "entry", "own", value.alias("value"),
        *[(F.unix_micros(c) if t == "timestamp" else F.col(c)).alias(p) for p, c, t in parts],
    )
    flat = ", ".join(f"{p} {'bigint' if t == 'timestamp' else t}" for p, _, t in parts)
    decided = rows.groupBy("bucket", "slice").transformWithState(
        NeighbourDecisions(
            [p for p, _, _ in parts], _STATE.format(position=flat), bound_ms, by_session, emit_single
        ),
        outputStructType=_OUTPUT.format(position=flat),
        outputMode="append",
        timeMode="EventTime",
    )
    fields = [
        (F.timestamp_micros(p) if t == "timestamp" else F.col(p)).alias(c.rpartition(".")[2])
        for p, c, t in parts
    ]
    seq = F.struct(*fields).alias("seq") if len(fields) > 1 else fields[0]
    return decided.select("mid", "ts", seq, "value", "reason")


def _position_parts(pages: DataFrame) -> list[tuple[str, str, str]]:
    """``(flat name, column, type)`` of the arrival position; keyed state holds flat columns."""
    kind = pages.schema["seq"].dataType
    if not isinstance(kind, StructType):
        return [("position0", "seq", kind.simpleString())]
    return [
        (f"position{i}", f"seq.{f.name}", f.dataType.simpleString()) for i, f in enumerate(kind.fields)
    ]


def page_sessions_stream(
    pages: DataFrame, gap_ms: int = 10_000, key: str = "mid", ts: str = "ts", delay: str = "1 second"
) -> DataFrame:
    """Event-time sessions per device, emitted when the watermark has passed their end."""
    rows = pages.withColumn("event_time", event_time(F.col(ts))).withWatermark("event_time", delay)
    window = F.session_window("event_time", f"{gap_ms} milliseconds").alias("session")
    sessions = rows.groupBy(key, window).agg(
        F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"), F.count("*").alias("n_rows")
    )
    return sessions.select(key, "first_ts", "last_ts", "n_rows")


def jumpouts_by_windows(
    pages: DataFrame,
    bound_ms: int = 10_000,
    by_session: bool = False,
    emit_single: bool = False,
    delay: str = "1 second",
    slice_ms: int | None = None,
) -> DataFrame:
    """As ``jumpouts_stream``, with built-in aggregates only: no row passes through Python.

    The rows of a device are gathered in event-time windows, a slice plus the reach into its neighbours, sorted, and
    each looks at the rows before and after it.  A bounced visit is emitted once the watermark has passed the end
    of its window, so up to a slice later than by ``jumpouts_stream``; the rows are the same.  Run it in append mode.
    """
    width = slice_ms or default_width(bound_ms)
    back, ahead = (bound_ms if by_session else 0), bound_ms
    rows = (
        pages.where("ts is not null")
        .withColumn("event_time", event_time(F.col("ts")))
        .withWatermark("event_time", delay)
        .withColumn("entry", is_entry())
    )
    # windows begin ``back`` before a slice and end ``ahead`` after it
    span = F.window(
        "event_time", f"{width + back + ahead} milliseconds", f"{width} milliseconds", f"{(-back) % width} milliseconds"
    )
    rows = rows.withColumn("span", span)
    first = F.unix_millis("span.start") + back
    own = (F.col("ts") >= first) & (F.col("ts") < first + width)
    seen = F.struct(
        "ts", "seq", "entry", own.alias("own"), F.when(own & F.col("entry"), F.col("value")).alias("value")
    )
    gathered = rows.groupBy("mid", "span").agg(F.array_sort(F.collect_list(seen)).alias("rows"))
    decided = gathered.select("mid", F.explode(_decisions(bound_ms, by_session, emit_single)).alias("r"))
    return decided.select("mid", "r.ts", "r.seq", "r.value", "r.reason")


def _decisions(bound_ms: int, by_session: bool, emit_single: bool) -> Column:
    """The bounced visits among the sorted ``rows`` of a window, each with its reason."""

    def decide(row: Column, place: Column) -> Column:
        before, after = (F.get("rows", place + step) for step in (-1, 1))
        gap = after["ts"] - row["ts"]
        if by_session:
            goes_on = F.coalesce(gap <= bound_ms, F.lit(False))
            joined = F.lit(emit_single) | F.coalesce(row["ts"] - before["ts"] <= bound_ms, F.lit(False))
            reason = F.when(goes_on, F.when(after["entry"], "match")).otherwise(F.when(joined, "end"))
        else:
            goes_on = F.coalesce(gap < bound_ms, F.lit(False))
            reason = F.when(goes_on, F.when(after["entry"], "match")).otherwise("timeout")
        wanted = row["own"] & row["entry"] & reason.isNotNull()
        return F.when(wanted, F.struct(row["ts"].alias("ts"), row["seq"].alias("seq"), row["value"].alias("value"), reason.alias("reason")))

    return F.array_compact(F.transform("rows", decide))
