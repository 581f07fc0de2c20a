"""Mixing sources to target weights: a time-varying curriculum that decides what is taken, how often and when.

Every source gets a share of the demand by water filling, its documents stand in a hashed order, and its weight schedule
is integrated and inverted: the document whose words begin at share u of the source's demand is trained on at the time t
by which the schedule has asked for u.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import numbered, stored

#: Relative weight of a source over training time, linear between evenly spaced knots, by weight class in turn.
SCHEDULES: tuple[tuple[float, ...], ...] = ((1.5, 1.0, 0.5), (1.0, 1.0), (0.5, 1.0, 1.5))
ROWS_PER_BUCKET = 20_000


@dataclass(frozen=True)
class Plan:
    """What to ask of the sources: weights repeat over the sources in code point order, null last."""

    weights: Sequence[float] = (3, 1, 2)
    demand: float = 1.5  # of all words
    most: float = 2.0  # of a source's words
    schedules: Sequence[Sequence[float]] = SCHEDULES


def words(text: Column) -> Column:
    """Runs of anything but ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, plan: Plan) -> DataFrame:
    """``source, source_size`` with its weight class and ``target``: words by weight, none above ``most`` times the size.

    The level (words per weight) is raised until nobody is above a cap; every round is one aggregate over the sources
    and caps at least one source more, so rounds end; there are seldom more than a few.
    """
    ranked = numbered(sizes, F.col("source").asc_nulls_last(), name="__rank", purpose="sources")
    classes = F.array(*(F.lit(float(w)) for w in plan.weights))
    known = ranked.select(
        "source",
        "source_size",
        (F.col("__rank") % len(plan.schedules)).cast("int").alias("schedule"),
        F.element_at(classes, (F.col("__rank") % len(plan.weights) + 1).cast("int")).alias("weight"),
        (F.col("source_size") * F.lit(float(plan.most))).alias("cap"),
    )
    total = known.agg(F.sum("source_size"), F.sum("weight")).first()
    demand, level, capped = plan.demand * (total[0] or 0), 0.0, -1
    full, open_weight = 0.0, total[1] or 0.0
    while True:
        level = (demand - full) / open_weight if open_weight else level
        above = F.col("weight") * F.lit(level) > F.col("cap")
        row = known.agg(
            F.count(F.when(above, 1)), F.sum(F.when(above, F.col("cap"))), F.sum(F.when(~above, F.col("weight")))
        ).first()
        if row[0] == capped or not row[0]:
            break
        capped, full, open_weight = row[0], row[1], row[2] or 0.0
    return known.select("source", "source_size", "schedule", F.least("cap", F.col("weight") * F.lit(level)).alias("target"))


def _inverse(knots: Sequence[float], share: Column) -> Column:
    """The time at which the integral of a piecewise linear schedule reaches ``share`` of its total."""
    n = len(knots) - 1
    areas = [(a + b) / 2 / n for a, b in zip(knots, knots[1:], strict=False)]
    out, before = None, 0.0
    for i, area in enumerate(areas):
        slope = (knots[i + 1] - knots[i]) * n
        rest = F.greatest(share * F.lit(sum(areas)) - F.lit(before), F.lit(0.0))
        root = F.sqrt(F.greatest(F.lit(knots[i] ** 2) + 2 * F.lit(slope) * rest, F.lit(0.0)))
        time = F.lit(i / n) + F.when(rest > 0, 2 * rest / (F.lit(knots[i]) + root)).otherwise(F.lit(0.0))
        before += area
        here = share * F.lit(sum(areas)) < F.lit(before) if i < n - 1 else F.lit(True)
        out = F.when(here, time) if out is None else out.when(here, time)
    return out


def decisions(docs: DataFrame, plan: Plan = Plan(), text: str = "text", source: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with __size, __source_size, __target, __taken, __whole and __times.

    ``__taken`` counts the words the mix takes of a document: as the source's documents, in an order hashed from id and
    text, are passed through up to ``most`` times, all words until the target (rounded to a word) is met; the document at
    which it is met is taken in part. ``__whole`` counts whole takes instead: a pass takes the document if the target
    reaches its middle. ``__times`` has, by pass, the training time in [0, 1] of its first word, null if that takes none.

    A null source is a source; null and empty texts have no words and take nothing; rows with equal id and text are told
    apart in no stated order. A source's rows are cut into hashed buckets, so that a hot source is many tasks' work.
    """
    spark = docs.sparkSession
    buckets = max(1, docs.count() // ROWS_PER_BUCKET)
    order = F.xxhash64(F.col(f"`{doc_id}`"), F.col(f"`{text}`"))
    rows = docs.withColumns(
        {"__size": words(F.col(f"`{text}`")), "__order": order, "__bucket": F.pmod(order, F.lit(buckets)), "__source": F.col(f"`{source}`")}
    )
    sums = stored(rows.groupBy("__source", "__bucket").agg(F.sum("__size").alias("__words")), "mix-buckets")
    sources = sums.groupBy(F.col("__source").alias("source")).agg(F.sum("__words").alias("source_size"))
    aims = targets(sources, plan)
    earlier = Window.partitionBy("__source").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("__source", "__bucket", F.coalesce(F.sum("__words").over(earlier), F.lit(0)).alias("__before"))
    about = offsets.join(aims, F.col("__source").eqNullSafe(F.col("source"))).select(
        F.col("__source").alias("__s"),
        F.col("__bucket").alias("__b"),
        "__before",
        F.col("source_size").alias("__source_size"),
        F.col("target").alias("__target"),
        F.col("schedule").alias("__schedule"),
    )
    joined = rows.join(stored(about, "mix-offsets"), F.col("__source").eqNullSafe(F.col("__s")) & (F.col("__bucket") == F.col("__b")))
    inside = Window.partitionBy("__s", "__b").orderBy("__order", F.col(f"`{doc_id}`")).rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("__before") + F.coalesce(F.sum("__size").over(inside), F.lit(0))
    placed = joined.withColumn("__start", start)
    budget, passes = F.round("__target").cast("long"), range(int(-(-plan.most // 1)))
    left = [budget - F.lit(e) * F.col("__source_size") - F.col("__start") for e in passes]
    taken = sum((F.greatest(F.lit(0), F.least(F.col("__size"), x)) for x in left), F.lit(0)).cast("long")
    whole = sum((F.when((F.col("__size") > 0) & (2 * x >= F.col("__size")), 1).otherwise(0) for x in left), F.lit(0))
    times = []
    for e, x in zip(passes, left, strict=True):
        share, by_class = (F.col("__start") + F.lit(e) * F.col("__source_size")) / F.greatest(budget, F.lit(1)), None
        for i, knots in enumerate(plan.schedules):
            when = F.when if by_class is None else by_class.when
            by_class = when(F.col("__schedule") == i, _inverse(knots, share))
        times.append(F.when((x > 0) & (F.col("__size") > 0), F.least(by_class, F.lit(1.0))))
    return placed.withColumns({"__taken": taken, "__whole": whole.cast("int"), "__times": F.array(*times)}).drop(
        "__order", "__bucket", "__source", "__s", "__b", "__before", "__schedule", "__start"
    )


def mixed(docs: DataFrame, plan: Plan = Plan(), text: str = "text", source: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """The training order: ``docs`` once per whole take, sorted by the training time of that pass's first word."""
    placed = decisions(docs, plan, text, source, doc_id).where("__whole > 0")
    copies = placed.select("*", F.posexplode(F.slice("__times", 1, F.col("__whole"))).alias("__pass", "__time"))
    return copies.orderBy("__time", F.col(f"`{doc_id}`"), "__pass").select(*(F.col(f"`{c}`") for c in docs.columns))
