"""Routing over time: every change follows the rule that was valid when it arrived.

The change log of the rule table becomes versions, each valid from the position after its own up to the next write
of its key.  A change looks up the version of its (table, operation) at its own arrival position, so that a
replay of the whole log routes as the running job did, whatever the rules are today.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.routing import MAX_BROADCAST_RULES, RULE_COLUMNS, RULE_KEY, route_matched, rule_events

SLICES = 64  # of the arrival positions, where versions are too many to broadcast


def rule_versions(rule_changes: DataFrame, order: str = "seq") -> DataFrame:
    """``RULE_COLUMNS, valid_from, valid_to``: one row per rule and the positions it was valid for.

    ``rule_changes`` holds envelope columns and the arrival position ``order``.  A version is valid for
    positions after ``valid_from`` up to and including ``valid_to`` (null: still valid).  A deleted rule
    ends its version; a rule moved to another key ends the version of the old key.  Of several writes of
    a key at one position the last counts, a new rule after a removal.
    """
    events = rule_events(rule_changes, order)
    # one row per key and position, found before the shuffle
    last = events.groupBy(*RULE_KEY, "_order").agg(
        F.max_by(F.struct("live", *[c for c in RULE_COLUMNS if c not in RULE_KEY]), "live").alias("_rule")
    )
    by_key = Window.partitionBy(*RULE_KEY).orderBy("_order")
    spans = last.withColumn("valid_to", F.lead("_order").over(by_key)).where(F.col("_rule.live") == 1)
    return spans.select(
        *RULE_KEY,
        *[F.col(f"_rule.{c}").alias(c) for c in RULE_COLUMNS if c not in RULE_KEY],
        F.col("_order").alias("valid_from"),
        "valid_to",
    )


def match_asof(
    changes: DataFrame,
    versions: DataFrame,
    order: str = "seq",
    limit: int = MAX_BROADCAST_RULES,
    slices: int = SLICES,
) -> DataFrame:
    """``changes`` with the columns of the rule version valid at their position; null where none was.

    Versions are broadcast once they are known to be at most ``limit``.  Beyond that changes and versions meet on
    (table, operation, slice of the positions): a table that owns a third of the log is spread over the slices,
    and no change is compared with every version of its key.  That way needs positions that are numbers.
    """
    if versions.limit(limit + 1).count() <= limit:
        valid = (F.col(order) > F.col("valid_from")) & (
            F.col("valid_to").isNull() | (F.col(order) <= F.col("valid_to"))
        )
        joined = changes.join(F.broadcast(versions), _same_key() & valid, "left")
        return joined.drop("valid_from", "valid_to")
    return _match_sliced(changes, versions, order, slices)


def _same_key() -> Column:
    return (F.col("tableName") == F.col("source_table")) & (F.col("type") == F.col("operate_type"))


def _match_sliced(changes: DataFrame, versions: DataFrame, order: str, slices: int) -> DataFrame:
    """The last write at or before each change, per (key, slice), with the version that is valid as a slice begins."""
    limits = _limits(changes, order, slices)
    key = [F.col("tableName").alias("_table"), F.col("type").alias("_op")]
    rule_key = [F.col("source_table").alias("_table"), F.col("operate_type").alias("_op")]
    rule = F.struct(*RULE_COLUMNS)
    # a version that ends is a write of nothing, unless another one begins there
    starts = versions.select(*rule_key, F.col("valid_from").alias("_at"), rule.alias("_rule"))
    ends = versions.where("valid_to is not null").select(*rule_key, F.col("valid_to").alias("_at"))
    ends = ends.join(starts.select("_table", "_op", "_at"), ["_table", "_op", "_at"], "left_anti")
    writes = starts.unionByName(ends, allowMissingColumns=True).withColumn("_slice", _slice(F.col("_at"), limits))
    writes = writes.withColumn("_write", F.struct("_at", F.struct("_rule").alias("held")))

    rows = changes.select(
        *key, _slice(F.col(order), limits).alias("_slice"), F.col(order).alias("_at"), F.lit(1).alias("_kind"),
        F.struct(*changes.columns).alias("_row"),
    )
    # what a slice begins with: the last write of the slices before it; one row per key and slice
    held = writes.groupBy("_table", "_op", "_slice").agg(F.max_by("_write", "_at").alias("_last"))
    asked = rows.select("_table", "_op", "_slice").distinct()
    before = Window.partitionBy("_table", "_op").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        asked.join(held, ["_table", "_op", "_slice"], "full_outer")
        .withColumn("_write", F.last("_last", ignorenulls=True).over(before))
        .where("_write is not null")
        .select("_table", "_op", "_slice", "_write", F.lit(-1).alias("_kind"))
    )
    inside = writes.select("_table", "_op", "_slice", "_at", "_write", F.lit(2).alias("_kind"))
    union = rows.unionByName(inside, allowMissingColumns=True).unionByName(carried, allowMissingColumns=True)
    # at one position a change comes before the write: a rule holds for what arrives after it
    order_in = Window.partitionBy("_table", "_op", "_slice").orderBy(
        F.when(F.col("_kind") == -1, 0).otherwise(1), "_at", "_kind"
    )
    seen = F.last("_write", ignorenulls=True).over(order_in.rowsBetween(Window.unboundedPreceding, 0))
    matched = union.withColumn("_seen", seen).where(F.col("_kind") == 1)
    return matched.select("_row.*", *[F.col(f"_seen.held._rule.{c}").alias(c) for c in RULE_COLUMNS])


def _limits(changes: DataFrame, order: str, slices: int) -> Sequence:
    """Positions that part the changes into slices of about the same size."""
    shares = ",".join(str(k / slices) for k in range(1, slices))
    found = changes.agg(F.expr(f"approx_percentile({order}, array({shares}))")).first()[0]
    return sorted(set(found or []))


def _slice(position: Column, limits: Sequence) -> Column:
    """How many of the limits a position has passed."""
    if not limits:
        return F.lit(0)
    held = F.array(*[F.lit(x) for x in limits])
    return F.size(F.filter(held, lambda x: x < position))


def route_changes_asof(changes: DataFrame, versions: DataFrame, order: str = "seq", **how) -> DataFrame:
    """As ``routing.route_changes``, each change by the rule valid at its arrival."""
    return route_matched(match_asof(changes, versions, order, **how))
