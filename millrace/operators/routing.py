"""Rule-driven routing of changes to fact topics and dimension tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.changefeed import decode_image

FACT, DIM, UNROUTED = "fact", "dim", "unrouted"
DIM_SINK_TYPE = "hbase"  # fixed value: the sink type that marks a dimension rule

# Columns of a rule (fixed values).
RULE_COLUMNS = (
    "source_table",
    "operate_type",
    "sink_type",
    "sink_table",
    "sink_columns",
    "sink_pk",
    "sink_extend",
)
RULE_KEY = ("source_table", "operate_type")

MAX_BROADCAST_RULES = 50_000
DEFAULT_KEY = "id"  # of a dimension whose rule names none


def rule_events(rule_changes: DataFrame, order: str = "seq") -> DataFrame:
    """``_order, live`` and the rule's columns: a change of the rule table as writes (live 1) and removals (0) of keys.

    Deleting a rule removes it, and moving it to another key removes it from the old key.
    """
    after, before = _rule("data"), _rule("before")
    old_key = F.struct(*[F.col(f"_before.{c}") for c in RULE_KEY])
    new_key = F.struct(*[F.col(f"_after.{c}") for c in RULE_KEY])
    writes = rule_changes.withColumn("_after", after).withColumn("_before", before)
    events = F.array(
        F.when(
            F.col("type").isin("delete", "update") & (F.col("_after").isNull() | (old_key != new_key)),
            F.struct(F.col("_before").alias("rule"), F.lit(0).alias("live")),
        ),
        F.when(
            (F.col("type") != "delete") & F.col("_after").isNotNull(),
            F.struct(F.col("_after").alias("rule"), F.lit(1).alias("live")),
        ),
    )
    events = writes.select(F.col(order).alias("_order"), F.explode(F.array_compact(events)).alias("e"))
    return events.select("_order", "e.live", "e.rule.*")


def latest_rules(rule_changes: DataFrame, order: str = "seq") -> DataFrame:
    """Current rules from the change log of the rule table (envelope columns + ``order``).

    The last write per (source table, operation) wins; removed rules are gone.
    """
    events = rule_events(rule_changes, order)
    return last_rule_per_key(events, ("_order", "live")).where("live = 1").select(*RULE_COLUMNS)


def _rule(image: str) -> Column:
    fields = ",".join(f"{c}:string" for c in RULE_COLUMNS)
    parsed = F.from_json(F.col(image), f"struct<{fields}>")
    return F.when(parsed["source_table"].isNotNull(), parsed)


def last_rule_per_key(rules: DataFrame, order: tuple[str, ...] = ("seq",)) -> DataFrame:
    """One rule per (source table, operation): the last one in ``order``."""
    newest_first = [F.col(c).desc() for c in order]
    rank = F.row_number().over(Window.partitionBy(*RULE_KEY).orderBy(*newest_first))
    return rules.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def bounded_rules(rules: DataFrame, limit: int = MAX_BROADCAST_RULES) -> DataFrame:
    """Hint a broadcast of the rules once their number is known to be at most ``limit``.

    Beyond it the join is left to Spark, which splits skewed shuffle partitions.
    """
    return F.broadcast(rules) if rules.limit(limit + 1).count() <= limit else rules


def route_changes(changes: DataFrame, rules: DataFrame) -> DataFrame:
    """Match changes to rules and add ``route`` (fact, dim, unrouted) and the sink columns.

    ``data`` becomes ``map<string,variant>`` pruned to the rule's column list (exact
    names, no trimming).  ``rules`` holds one rule per key.  Unmatched changes keep
    their whole image, and so do changes of a dimension that lack a part of its key: they
    are unrouted too.
    """
    same = (F.col("tableName") == F.col("source_table")) & (F.col("type") == F.col("operate_type"))
    return route_matched(changes.join(rules.select(*RULE_COLUMNS), same, "left"))


def route_matched(matched: DataFrame) -> DataFrame:
    """The second half of ``route_changes``, for changes that carry the columns of their rule (null: none)."""
    matched = decode_image(matched)
    names = F.split(F.coalesce(F.nullif(F.trim("sink_pk"), F.lit("")), F.lit(DEFAULT_KEY)), ",")
    names = F.transform(names, F.trim)
    cell = lambda name: F.try_element_at("data", name)
    # a row without its key can be no row of a dimension: it stays whole, for the audit
    keyless = F.exists(names, lambda name: cell(name).isNull() | F.is_variant_null(cell(name)))
    route = (
        F.when(F.col("source_table").isNull(), UNROUTED)
        .when((F.col("sink_type") == DIM_SINK_TYPE) & keyless, UNROUTED)
        .when(F.col("sink_type") == DIM_SINK_TYPE, DIM)
        .otherwise(FACT)
    )
    listed = F.split("sink_columns", ",")
    # a dimension row needs its key, listed or not
    columns = F.when(F.col("route") == DIM, F.concat(listed, names)).otherwise(listed)
    pruned = F.map_filter(F.col("data"), lambda k, v: F.array_contains(columns, k))
    return matched.withColumn("route", route).withColumn(
        "data", F.when(F.col("route") == UNROUTED, F.col("data")).otherwise(pruned)
    )


def routed_records(routed: DataFrame, route: str) -> DataFrame:
    """``data, sinkTable, sinkColumns`` records of one route."""
    return routed.where(F.col("route") == route).select(
        "data", F.col("sink_table").alias("sinkTable"), F.col("sink_columns").alias("sinkColumns")
    )


def unrouted_changes(changes: DataFrame, rules: DataFrame) -> DataFrame:
    """Changes that no rule matches."""
    return changes.join(
        rules.select(*RULE_KEY),
        (F.col("tableName") == F.col("source_table")) & (F.col("type") == F.col("operate_type")),
        "left_anti",
    )


def tag_by_pulled_rules(changes: DataFrame, rules: DataFrame) -> DataFrame:
    """Whole images with ``sinkTable`` put inside; unmatched changes are dropped."""
    # images of dropped changes are not parsed
    matched = decode_image(
        changes.join(
            rules.select(*RULE_KEY, "sink_table"),
            (F.col("tableName") == F.col("source_table")) & (F.col("type") == F.col("operate_type")),
        )
    )
    kept = F.map_filter("data", lambda k, v: k != "sinkTable")
    tagged = F.map_concat(kept, F.create_map(F.lit("sinkTable"), F.col("sink_table").cast("variant")))
    return matched.withColumn("data", tagged).drop(*RULE_KEY)

