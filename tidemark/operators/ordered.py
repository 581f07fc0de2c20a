"""Running and sliding-row computations per key that stay parallel when one key is hot.

A window function over ``partitionBy(key)`` sends all rows of a key to one task. Here a key with more
than ``max_rows`` rows is cut into slices along its order, and only the little a slice needs from the
slices before it travels between them:

* :func:`running` (unbounded frames) prepends to every slice one *carry row* that holds the aggregate
  of all earlier slices of the key;
* :func:`over_rows` (the last k rows) prepends the last k rows before the slice, its *halo*.

Rows, carry rows and halo rows are shuffled once by ``(key, slice)`` and sorted once. Keys below the
limit form one slice and need neither; without any hot key the result is the plain window.

Hot keys and their cuts are found when an operator is applied, by jobs that count rows per key and range-sort the
order columns of hot keys' rows. Every ``max_rows``-th row of a key in its order is a cut. Cuts are whole order values
(all order columns, NULLs first, any type Spark can sort), they are written to the shared folder, and rows are compared
with the written values, so every later reading of the input is cut alike. A slice has at most ``max_rows`` rows however
the order values are spread; only rows with equal order values, which no order tells apart, stay together.

Sizes: a key of n rows has n / max_rows cuts, so all cuts are at most rows / max_rows values. They are broadcast below
``BROADCAST_CUTS`` of them and otherwise joined as Spark sees fit.

The input is read more than once and must give the same rows each time.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec, functions as F, types as T

from tidemark.session import shared_folder

MAX_ROWS_CONF = "spark.tidemark.maxRowsPerSlice"
DEFAULT_MAX_ROWS = 4_000_000

#: Cut values that are broadcast at most.
BROADCAST_CUTS = 100_000
_SLICE = "_slice"
_EVERYTHING = "_everything"
_IS_ROW = "_is_row"


def max_rows_per_slice(spark: SparkSession) -> int:
    return int(spark.conf.get(MAX_ROWS_CONF, str(DEFAULT_MAX_ROWS)))


def position(df: DataFrame, column: str) -> Column | None:
    """An order column as a number that grows with it, if it has one."""
    kind = df.schema[column].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(column).cast("timestamp"))
    return F.col(column).cast("long") if isinstance(kind, T.IntegralType) else None


def floor_div(value: Column, width: int | Column) -> Column:
    """Integer division rounding down, also for negative numbers."""
    width = F.lit(width).cast("long") if isinstance(width, int) else width
    return F.call_function("div", value - F.pmod(value, width), width)


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read again: later steps neither repeat it nor depend on its executors."""
    folder = shared_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def same(left: Sequence[str], right: Sequence[str]) -> Column:
    return reduce(Column.__and__, (F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right, strict=True)))


def hot_keys(sizing: DataFrame, keys: Sequence[str], limit: int) -> DataFrame | None:
    """Keys of more than ``limit`` rows, as a written table; None when there are none."""
    names = [f"_cut_{k}" for k in keys]
    sizes = sizing.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)]).agg(F.count(F.lit(1)).alias("_n"))
    hot = written(sizes.where(F.col("_n") > limit), "hot-keys")
    return None if hot.isEmpty() else hot


def _cuts(sizing: DataFrame, hot: DataFrame, keys: Sequence[str], order: Sequence[str], limit: int) -> DataFrame:
    """For every hot key, the order values of every ``limit``-th row as an ascending array, and every so many of these.

    Rows of hot keys are range-sorted by key and order, which tasks share however few the keys are; a row's place in its
    key follows from its place in its task and the rows of earlier tasks.
    """
    names = [f"_cut_{k}" for k in keys]
    at = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)]).alias("_at")
    rows = sizing.join(hot, same(keys, names), "inner").select(*names, at)
    ranked = written(rows.orderBy(*names, "_at").withColumn("_id", F.monotonically_increasing_id()), "hot-rows")
    by_task = ranked.withColumn("_task", F.shiftrightunsigned("_id", 33))
    sizes = by_task.groupBy(*names, "_task").agg(F.count(F.lit(1)).alias("_rows"), F.min("_id").alias("_first"))
    earlier = Window.partitionBy(*names).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        *[F.col(n).alias(f"_s{n}") for n in names],
        F.col("_task").alias("_s_task"),
        "_first",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
    )
    matched = by_task.join(starts, same([*names, "_task"], [f"_s{n}" for n in [*names, "_task"]]))
    place = F.col("_before") + F.col("_id") - F.col("_first")
    chosen = matched.where((place > 0) & (F.pmod(place, F.lit(limit)) == 0)).select(*names, "_at")
    per_key = chosen.groupBy(*names).agg(F.array_sort(F.collect_set("_at")).alias("_points"))  # rows / limit values
    step = F.ceil(F.sqrt(F.size("_points").cast("double"))).cast("int")
    heads = F.filter("_points", lambda _, i: i % F.col("_step") == 0)
    return per_key.withColumn("_step", step).withColumn("_heads", heads)


def _slice_number(order: Sequence[str]) -> Column:
    """How many cuts are at or below a row's order value: first over the heads, then over the points behind one head."""
    at = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])
    group = F.size(F.filter("_heads", lambda point: point <= at))
    inner = F.slice("_points", (F.greatest(group, F.lit(1)) - 1) * F.col("_step") + 1, F.col("_step"))
    within = (group - 1) * F.col("_step") + F.size(F.filter(inner, lambda point: point <= at))
    return F.when(F.col("_points").isNull() | (group == 0), 0).otherwise(within).cast("long")


def _sliced(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], sizing: DataFrame | None
) -> tuple[DataFrame, DataFrame, list[str]] | None:
    """All rows with their slice, the rows of cut keys, and the slice column; None without hot keys.

    Cuts are found from ``sizing``, by default ``df`` itself, in jobs that run at once.
    """
    if df.isStreaming:
        raise ValueError("row-order windows are batch only; use tidemark.streaming.processors on streams")
    sizing = (df if sizing is None else sizing).select(*dict.fromkeys([*keys, *order]))
    limit = max_rows_per_slice(df.sparkSession)
    hot = hot_keys(sizing, keys, limit)
    if hot is None:
        return None
    cuts = written(_cuts(sizing, hot, keys, order, limit), "cuts")
    points = cuts.agg(F.sum(F.size("_points"))).first()[0] or 0
    if points <= BROADCAST_CUTS:
        cuts = F.broadcast(cuts)
    names = [f"_cut_{k}" for k in keys]
    rows, hot_rows = (
        df.join(cuts, same(keys, names), how).select(*df.columns, _slice_number(order).alias(_SLICE)) for how in ("left", "inner")
    )
    return rows, hot_rows, [_SLICE]


@dataclass(frozen=True)
class Run:
    """One running aggregate: ``kind`` is count, sum, max, min, first or last.

    ``inclusive=False`` leaves the current row out of its own frame.
    """

    kind: str
    value: Column | None = None
    inclusive: bool = True

    def lifted(self) -> Column:
        if self.kind == "count":
            return F.lit(1).cast("long")
        # first / last must tell "no row" from "row with a NULL"
        return F.struct(self.value.alias("v")) if self.kind in ("first", "last") else self.value


_MERGE: dict[str, Callable[[Column], Column]] = {
    "count": F.sum,
    "sum": F.sum,
    "max": F.max,
    "min": F.min,
    "first": lambda c: F.first(c, ignorenulls=True),
    "last": lambda c: F.last(c, ignorenulls=True),
}


def _summary(run: Run, value: str, order: Sequence[str], reverse: bool) -> Column:
    if run.kind in ("first", "last"):
        pick = F.min if (run.kind == "first") != reverse else F.max
        return pick(F.struct(*order, value))[value]
    return _MERGE[run.kind](F.col(value))


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    aggregates: dict[str, Run],
    reverse: bool = False,
    sizing: DataFrame | None = None,
) -> DataFrame:
    """Add running aggregates over each key's rows in ``order`` (a total order).

    ``reverse=True`` runs from the end, i.e. over the *following* rows. Without keys the whole table is
    one ordered sequence. Where ``df`` is costly to compute, ``sizing`` may be any cheaper DataFrame with
    the same keys and order columns; it only serves to find hot keys.
    """
    values = {name: f"_value_{name}" for name in aggregates}
    lifted = df.select("*", *[run.lifted().alias(values[name]) for name, run in aggregates.items()])
    sizing = None if sizing is None else _keyed(sizing, keys)[0]
    lifted, keys = _keyed(lifted, keys)
    direction = (lambda c: F.col(c).desc()) if reverse else (lambda c: F.col(c).asc())
    stacked = lifted.withColumn(_IS_ROW, F.lit(True))
    partition = keys
    if sliced := _sliced(lifted, keys, order, sizing):
        rows, hot_rows, slices = sliced
        partition = [*keys, *slices]
        earlier = Window.partitionBy(*keys).orderBy(*map(direction, slices)).rowsBetween(Window.unboundedPreceding, -1)
        summaries = hot_rows.groupBy(*partition).agg(
            *[_summary(run, values[name], order, reverse).alias(values[name]) for name, run in aggregates.items()]
        )
        carries = summaries.select(
            *partition,
            *[_MERGE[run.kind](F.col(values[name])).over(earlier).alias(values[name]) for name, run in aggregates.items()],
            F.count(F.lit(1)).over(earlier).alias("_before"),
        )
        carries = carries.where("_before > 0").drop("_before").withColumn(_IS_ROW, F.lit(False))
        stacked = rows.withColumn(_IS_ROW, F.lit(True)).unionByName(carries, allowMissingColumns=True)
    in_slice = Window.partitionBy(*partition).orderBy(_IS_ROW, *[direction(c) for c in order])
    results = []
    for name, run in aggregates.items():
        frame = in_slice.rowsBetween(Window.unboundedPreceding, 0 if run.inclusive else -1)
        result = _MERGE[run.kind](F.col(values[name])).over(frame)
        if run.kind == "count":
            result = F.coalesce(result, F.lit(0).cast("long"))
        elif run.kind in ("first", "last"):
            result = result["v"]
        results.append(result.alias(name))
    return stacked.select(*df.columns, _IS_ROW, *results).where(_IS_ROW).drop(_IS_ROW)


def over_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    before: int,
    expressions: Callable[[WindowSpec], dict[str, Column]],
) -> DataFrame:
    """Add window expressions whose frames reach at most ``before`` rows back.

    ``expressions`` receives the ordered window specification and returns named columns.
    """
    lifted, keys = _keyed(df, keys)
    stacked = lifted.withColumn(_IS_ROW, F.lit(True))
    in_slice = Window.partitionBy(*keys)
    if sliced := _sliced(lifted, keys, order, None):
        rows, hot_rows, slices = sliced
        in_slice = Window.partitionBy(*keys, *slices)
        newest_first = in_slice.orderBy(*[F.col(c).desc() for c in order])
        per_key = Window.partitionBy(*keys).orderBy(*order)
        # at most `before` rows per slice and per list
        ends = (
            hot_rows.withColumn("_rank", F.row_number().over(newest_first))
            .where(F.col("_rank") <= before)
            .withColumn("_tail", F.collect_list(F.struct(*lifted.columns)).over(per_key.rowsBetween(1 - before, 0)))
            .where("_rank = 1")
            .select("_tail", *[F.lead(c).over(per_key).alias(c) for c in slices])
        )
        halos = ends.where(F.col(slices[0]).isNotNull()).select(*slices, F.inline("_tail"))
        stacked = rows.withColumn(_IS_ROW, F.lit(True)).unionByName(halos.withColumn(_IS_ROW, F.lit(False)))
    named = expressions(in_slice.orderBy(*order))
    return (
        stacked.select(*df.columns, _IS_ROW, *[c.alias(n) for n, c in named.items()])
        .where(_IS_ROW)
        .drop(_IS_ROW)
    )


def _keyed(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Without keys, one constant key: the whole table is then cut like a hot key."""
    return (df, list(keys)) if keys else (df.withColumn(_EVERYTHING, F.lit(0)), [_EVERYTHING])


def number_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """1-based row number within each key."""
    return running(df, keys, order, {name: Run("count")})
