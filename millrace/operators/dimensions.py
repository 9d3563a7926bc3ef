"""Dimension tables: schema from a rule, upserts, current view, enrichment joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.jsontext import as_text
from millrace.operators.routing import DEFAULT_KEY, DIM


# --- schema from a rule ---------------------------------------------------------------


def key_columns(sink_pk: str | None) -> list[str]:
    """Key columns of a rule; ``id`` when none are named."""
    names = [c.strip() for c in (sink_pk or "").split(",") if c.strip()]
    return names or [DEFAULT_KEY]


def dim_schema(sink_columns: str) -> T.StructType:
    """Every column of a dimension is a string."""
    return T.StructType([T.StructField(c, T.StringType()) for c in sink_columns.split(",")])


def create_dim_table(
    spark: SparkSession,
    database: str,
    sink_table: str,
    sink_columns: str,
    sink_pk: str | None = None,
    sink_extend: str | None = None,
) -> None:
    """Create the table of a dimension rule unless it exists.

    The key and the extension text of the rule are kept as table properties.
    """
    columns = ", ".join(f"{_quote(f.name)} STRING" for f in dim_schema(sink_columns))
    properties = {"primary_key": ",".join(key_columns(sink_pk))}
    if sink_extend:
        properties["sink_extend"] = sink_extend
    listed = ", ".join(f"'{k}' = {_literal(v)}" for k, v in properties.items())
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {_quote(database)}.{_quote(sink_table)} ({columns}) "
        f"USING parquet TBLPROPERTIES ({listed})"
    )


def add_missing_columns(spark: SparkSession, database: str, sink_table: str, columns: Sequence[str]) -> list[str]:
    """Alter a dimension table once for the columns it lacks; rows written before read them as null."""
    name = f"{_quote(database)}.{_quote(sink_table)}"
    held = {c.lower() for c in spark.table(name).columns}
    missing = [c for c in dict.fromkeys(columns) if c.lower() not in held]
    if missing:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(f'{_quote(c)} STRING' for c in missing)})")
    return missing


def set_table_location(spark: SparkSession, database: str, table: str, path: str) -> None:
    name = f"{_quote(database)}.{_quote(table)}"
    spark.sql(f"ALTER TABLE {name} SET LOCATION {_literal(path)}")
    spark.catalog.refreshTable(name)


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


# --- upserts --------------------------------------------------------------------------


def dim_changes(routed: DataFrame, order: str = "seq") -> DataFrame:
    """Upserts of routed changes: ``sink_table, sink_columns, sink_pk, seq, data``.

    ``data`` maps column to text; JSON null becomes a real null.
    """
    texts = F.transform_values("data", lambda k, v: as_text(v))
    return routed.where(F.col("route") == DIM).select(
        "sink_table", "sink_columns", "sink_pk", F.col(order).alias("seq"), texts.alias("data")
    )


def current_rows(
    changes: DataFrame,
    columns: Sequence[str],
    key: Sequence[str] = (DEFAULT_KEY,),
    order: Sequence[str] = ("seq",),
) -> DataFrame:
    """Current row per key: for every column the last upsert that listed it.

    Columns an upsert does not list keep their older value.  The aggregate is combined
    before the shuffle, so a key that is written all the time stays cheap.
    """
    position = F.struct(*order)
    listed = changes.withColumn("_listed", F.split("sink_columns", ","))
    keys = [F.try_element_at("data", F.lit(k)).alias(k) for k in key]
    values = [
        F.max_by(
            F.try_element_at("data", F.lit(c)), F.when(F.array_contains("_listed", c), position)
        ).alias(c)
        for c in columns
        if c not in key
    ]
    rows = listed.groupBy(*keys).agg(*values) if values else listed.select(*keys).distinct()
    return rows.select(*columns)


# --- enrichment -----------------------------------------------------------------------


@dataclass(frozen=True)
class DimSpec:
    """A lookup: which dimension, by which column, and what it adds.

    ``then`` names lookups that start from a column added here; they are resolved
    between the dimensions, before the wide side is touched.
    """

    dim: str
    left_key: str
    columns: Mapping[str, str]
    dim_key: str = DEFAULT_KEY
    then: tuple[DimSpec, ...] = field(default=())


def added_columns(spec: DimSpec) -> list[str]:
    return [*spec.columns.values(), *[c for s in spec.then for c in added_columns(s)]]


@dataclass(frozen=True)
class HotKeys:
    """Lookup keys that many rows share: their rows are dealt over ``salts`` partitions, their dimension rows copied."""

    keys: tuple[str, ...] = ()
    salts: int = 1


MANY_ROWS = 200_000  # of one key in one micro-batch


def hot_keys(left: DataFrame, left_key: str, rows: int, many: int = MANY_ROWS) -> HotKeys:
    """The keys that more than ``many`` rows of a cached ``left`` of so many ``rows`` share: fewer than rows / many."""
    if rows <= many:
        return HotKeys()
    counts = left.groupBy(F.col(left_key).cast("string").alias("key")).count()
    found = counts.where((F.col("count") > many) & F.col("key").isNotNull()).collect()
    most = max((r["count"] for r in found), default=0)
    return HotKeys(tuple(sorted(r["key"] for r in found)), -(-most // many) or 1)


def join_dim(
    left: DataFrame,
    dims: Mapping[str, DataFrame],
    spec: DimSpec,
    keys: DataFrame | None = None,
    hot: HotKeys = HotKeys(),
) -> DataFrame:
    """Left join: a miss keeps the row, with nulls.  A dimension holds one row per key (see ``one_row_per_key``).

    There is no broadcast hint: Spark broadcasts a dimension when its measured size
    allows and otherwise shuffles, splitting skewed keys at run time.  ``keys``, a cached
    column of all the keys of a small ``left``, reduces a large dimension first, so that
    it is scanned but not shuffled.  Where Spark does not split keys at run time, in
    micro-batches, ``hot`` names those to split.
    """
    left_key = left[spec.left_key].cast("string")
    if keys is not None:
        keys = keys.select(keys[spec.left_key].cast("string").alias("_left_key")).distinct()
    dim = _flattened(dims, spec, keys).withColumnRenamed(spec.dim_key, "_dim_key")
    if not hot.keys:
        return left.join(dim, left_key == F.col("_dim_key"), "left").drop("_dim_key")
    number = F.pmod(F.xxhash64(*left.columns), F.lit(hot.salts)).cast("int")
    salted = left.withColumn("_salt", F.when(left_key.isin(list(hot.keys)), number).otherwise(0))
    copies = F.when(F.col("_dim_key").isin(list(hot.keys)), hot.salts).otherwise(1)
    dim = dim.withColumn("_dim_salt", F.explode(F.sequence(F.lit(0), copies - 1)))
    same = (salted[spec.left_key].cast("string") == F.col("_dim_key")) & (F.col("_salt") == F.col("_dim_salt"))
    return salted.join(dim, same, "left").drop("_dim_key", "_salt", "_dim_salt")


def join_dims(
    left: DataFrame, dims: Mapping[str, DataFrame], specs: Sequence[DimSpec]
) -> DataFrame:
    for spec in specs:
        left = join_dim(left, dims, spec)
    return left


def _least_rows(dim: DataFrame, key: str) -> DataFrame:
    columns = [c for c in dim.columns if c != key]
    least = F.min(F.struct(*columns)).alias("_least")
    return dim.groupBy(key).agg(least).select(key, *[F.col(f"_least.{c}").alias(c) for c in columns])


def one_row_per_key(dim: DataFrame, key: str = DEFAULT_KEY) -> DataFrame:
    """``dim`` itself if no key repeats, else its least row per key.

    A repeated key would multiply the rows that look it up.  The check is one aggregate over the keys; it is not part of
    the lookup, where an aggregate would keep Spark from splitting a hot key of the other side.
    """
    repeated = dim.groupBy(key).count().where("count > 1")
    return _least_rows(dim, key).select(dim.columns) if repeated.limit(1).count() else dim


def unique_dims(dims: Mapping[str, DataFrame], specs: Sequence[DimSpec]) -> dict[str, DataFrame]:
    """The dimensions of the lookups, checked to hold one row per key."""
    out = dict(dims)
    for spec in specs:
        out[spec.dim] = one_row_per_key(dims[spec.dim], spec.dim_key)
        out |= {then.dim: one_row_per_key(dims[then.dim], then.dim_key) for then in spec.then}
    return out


def _flattened(
    dims: Mapping[str, DataFrame], spec: DimSpec, keys: DataFrame | None = None
) -> DataFrame:
    """``dim_key`` and the added columns, with follow-up lookups already joined."""
    dim = dims[spec.dim].select(
        F.col(spec.dim_key).cast("string").alias(spec.dim_key),
        *[F.col(source).alias(target) for source, target in spec.columns.items()],
    )
    if keys is not None:
        # few rows are left, so this costs little
        dim = _least_rows(dim.join(keys, dim[spec.dim_key] == keys["_left_key"], "left_semi"), spec.dim_key)
    return join_dims(dim, dims, spec.then)
