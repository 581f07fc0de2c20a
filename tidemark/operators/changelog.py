"""Explicit changelog rows (insert, update-before, update-after) of grouped aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.operators.keyed import running_count
from tidemark.operators.ordered import Run, over_rows, running, written

INSERT, UPDATE_BEFORE, UPDATE_AFTER = "+I", "-U", "+U"


def count_changelog(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "cnt") -> DataFrame:
    """One ``+I`` for a key's first row, then a ``-U`` / ``+U`` pair per further row.

    ``part`` orders the two rows of a pair.
    """
    counted = running_count(df, keys, order, out="_new")

    def change(part: int, op: str, cnt):
        return F.struct(F.lit(part).alias("part"), F.lit(op).alias("op"), cnt.alias(out))

    changes = F.when(F.col("_new") == 1, F.array(change(0, INSERT, F.col("_new")))).otherwise(
        F.array(change(0, UPDATE_BEFORE, F.col("_new") - 1), change(1, UPDATE_AFTER, F.col("_new")))
    )
    return counted.select(*order, *[k for k in keys if k not in order], F.inline(changes))


def value_changelog(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """The changes of running ``values`` that ``df`` has after each row, whatever aggregate made them.

    A key's first row inserts; a later row that changes any value takes the old ones back (``-U``) and sets the new
    ones (``+U``); a row that changes none makes no row. ``part`` orders the two rows of a pair.
    """
    now = F.struct(*values)

    def earlier(window):
        return {"_before": F.lag(F.struct(*values)).over(window)}

    compared = over_rows(df.select(*dict.fromkeys([*keys, *order, *values])), keys, order, 1, earlier)

    def change(part: int, op: str, which):
        return F.struct(F.lit(part).alias("part"), F.lit(op).alias("op"), which.alias("_v"))

    before = F.col("_before")
    changes = (
        F.when(before.isNull(), F.array(change(0, INSERT, now)))
        .when(~before.eqNullSafe(now), F.array(change(0, UPDATE_BEFORE, before), change(1, UPDATE_AFTER, now)))
        .otherwise(F.array())
    )
    kept = [*order, *[k for k in keys if k not in order]]
    return compared.select(*kept, F.inline(changes)).select(*kept, "part", "op", *[F.col("_v")[v].alias(v) for v in values])


def top_n_changelog(df: DataFrame, key: str, seq: str, n: int = 2, out: str = "cnt") -> DataFrame:
    """The changes of the n keys with the most rows, place by place, after each row in ``seq`` order (unique).

    Of keys with equal counts the one that got there first stands first. A place taken for the first time inserts, later
    changes of a place are a ``-U`` / ``+U`` pair; rows that change no place make none. A NULL key is a key of its own.

    When a key reaches count c as the r-th key to do so, exactly r - 1 keys stand before it: those that reached c
    earlier, wherever they are now. So the rows that change the first n places are the first n of each count, of which
    Spark keeps n per task before the exchange, and only these are walked. Place i then gets the key itself (r = i) or
    whoever stood at place i - 1, if the key came from behind; the last such row is a running maximum, cut into slices
    as any other, one pass a place. ``n`` is a small constant.
    """
    counted = running(df.select(key, seq), [key], [seq], {"_cnt": Run("count")})
    reached = F.row_number().over(Window.partitionBy("_cnt").orderBy(seq))
    state = written(counted.withColumn("_place", reached).where(F.col("_place") <= n), "top-n")
    me = F.struct(F.col(seq).alias("at"), F.col(key).alias("key"), F.col("_cnt").alias("cnt"))
    for i in range(1, n + 1):
        came = F.lit(None).cast(state.select(me.alias("_")).schema["_"].dataType)
        if i > 1:
            before = F.col(f"_before_{i - 1}")
            ahead = F.lit(False)
            for j in range(1, i):
                ahead = ahead | (F.col(f"_before_{j}").isNotNull() & F.col(f"_before_{j}.key").eqNullSafe(F.col(key)))
            moved = F.struct(F.col(seq).alias("at"), before["key"].alias("key"), before["cnt"].alias("cnt"))
            came = F.when((F.col("_place") < i) & before.isNotNull() & ~ahead, moved)
        state = state.withColumn(f"_set_{i}", F.when(F.col("_place") == i, me).otherwise(came))
        state = running(state, [], [seq], {f"_before_{i}": Run("max", F.col(f"_set_{i}"), inclusive=False)}, sizing=state.select(seq))

    def change(place: int, part: int, op: str, who: Column) -> Column:
        named = (F.lit(place).cast("long").alias("row_num"), F.lit(part).alias("part"), F.lit(op).alias("op"))
        return F.struct(*named, who["key"].alias("_key"), who["cnt"].alias(out))

    changes = []
    for i in range(1, n + 1):
        before, after = F.col(f"_before_{i}"), F.col(f"_set_{i}")
        pair = F.array(change(i, 0, UPDATE_BEFORE, before), change(i, 1, UPDATE_AFTER, after))
        changes.append(F.when(after.isNull(), F.array()).when(before.isNull(), F.array(change(i, 0, INSERT, after))).otherwise(pair))
    listed = state.select(F.col(seq).alias("_seq"), F.inline(F.flatten(F.array(*changes))))
    return listed.select(F.col("_seq").alias(seq), "row_num", "part", "op", F.col("_key").alias(key), out)
