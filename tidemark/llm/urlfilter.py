"""URL filters: dated block-list entries as validity intervals, and captures judged by what was listed at fetch time.

An entry is a host (with all hosts below it) or a host with a path (with all paths below it, by whole segments).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ADD, REMOVE = "add", "remove"
#: Seconds of the slots that time is cut into for the join.
SLOT_SECONDS = 30 * 86_400
_AUTHORITY = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#]*@)?(\[[^\]/?#]*\]|[^/?#:@]*)"
_PATH = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)"


def host(url: Column) -> Column:
    """The host in lower case without port, user and trailing dots; '' for what is not an absolute url."""
    return F.rtrim(F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), _AUTHORITY, 1)), F.lit("."))


def segments(url: Column) -> Column:
    """The segments of the path that aren't empty."""
    return F.array_remove(F.split(F.regexp_extract(F.coalesce(url, F.lit("")), _PATH, 1), "/"), "")


def keys(url: Column, labels: int, depth: int) -> Column:
    """What may list an url: its host and domains above it of ``labels`` labels at most, and ``depth`` path prefixes."""
    parts, path = F.split(host(url), r"\."), segments(url)
    n = F.least(F.size(parts), F.lit(labels))
    domains = F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(parts, F.size(parts) - i + 1, i), "."))
    deep = F.least(F.size(path), F.lit(depth))
    prefixes = F.when(
        deep > 0, F.transform(F.sequence(F.lit(1), deep), lambda i: F.concat(host(url), F.lit("/"), F.array_join(F.slice(path, 1, i), "/")))
    ).otherwise(F.array().cast("array<string>"))
    return F.when(host(url) == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.concat(domains, prefixes)))


#: Slots between the first and the last usual capture at most.
MOST_SLOTS = 4_096


def _host_folded(entry: str) -> Column:
    """An entry with its host in lower case; paths tell cases apart, as :func:`keys` does."""
    host_part = F.substring_index(entry, "/", 1)
    return F.concat(F.lower(host_part), F.substring(F.col(entry), F.length(host_part) + 1, F.length(entry)))


def intervals(events: DataFrame) -> DataFrame:
    """``entry, category, since, until`` from ``entry, category, action, at`` (seconds): half-open, disjoint by entry.

    An entry is listed from an ``add`` until its next event; ``until`` is null while it is still listed. An ``add``
    while listed starts a new interval, with its own category. At equal times removals come first, then categories in
    order, and the last counts. Events without entry, time or known action are left out; repeated events count once.
    """
    known = events.where(F.col("entry").isNotNull() & F.col("at").isNotNull() & F.col("action").isin(ADD, REMOVE)).select(
        _host_folded("entry").alias("entry"), "category", "action", F.col("at").cast("long").alias("at")
    )
    last = known.groupBy("entry", "at").agg(F.max(F.struct((F.col("action") == ADD).alias("adds"), "category")).alias("e"))
    following = F.lead("at").over(Window.partitionBy("entry").orderBy("at"))
    spans = last.select("entry", F.col("e.category").alias("category"), F.col("e.adds").alias("adds"), F.col("at").alias("since"), following.alias("until"))
    return spans.where("adds").drop("adds")


def judged(captures: DataFrame, listed: DataFrame, url: str = "url", at: str = "fetched_at", slot: int = SLOT_SECONDS) -> DataFrame:
    """``captures`` with ``blocked, entry, category, since, until``: the longest entry that was active at ``at`` seconds.

    Both sides meet by entry and time slot: an interval stands in every slot it touches between the first and the last
    capture, so a capture meets the intervals of its own slot alone, and an entry of a third of all captures is dealt by
    slots (and by skew handling within one). Only as many domain labels and path segments are tried as the longest entries
    have. Times outside the middle 99.8 % of captures share the first or the last slot, and slots are as wide as it takes to
    have ``MOST_SLOTS`` between, so a few wrong times make no slots. Null or relative urls and null times are never blocked; every row is returned, repeated ones too. Columns of
    ``captures`` that are named as the added ones are replaced.
    """
    captures = captures.drop("blocked", "entry", "category", "since", "until")
    shape = listed.agg(
        F.max(F.size(F.split(F.substring_index("entry", "/", 1), r"\."))), F.max(F.size(F.split("entry", "/")) - 1)
    ).first()
    when = F.col(f"`{at}`").cast("long")
    first, last, low, high = captures.agg(F.min(when), F.max(when), *(F.percentile_approx(when, q, 1000) for q in (0.001, 0.999))).first()
    low, high = low or 0, high or 0
    slot = max(slot, (high - low) // MOST_SLOTS)
    placed = lambda t: F.floor(F.least(F.greatest(t, F.lit(low)), F.lit(high)) / slot)
    rows = captures.withColumn("__row", F.monotonically_increasing_id())
    own = [F.col(f"`{c}`") for c in captures.columns]
    tried = keys(F.col(f"`{url}`"), shape[0] or 0, shape[1] or 0) if shape[0] else F.array().cast("array<string>")
    asked = rows.select("__row", *own, F.explode_outer(tried).alias("__key"), placed(when).alias("__slot"))
    until = F.coalesce("until", F.lit(1 << 62))
    inside = (F.col("since") <= F.lit(last or 0)) & (until > F.lit(first or 0))
    named = {"entry": "__e", "category": "__c", "since": "__s", "until": "__u"}
    slots = F.explode(F.sequence(placed(F.col("since")), placed(until))).alias("__k")
    active = listed.where(inside).select(*(F.col(old).alias(new) for old, new in named.items()), slots)
    current = (F.col("__s") <= when) & (F.col("__u").isNull() | (when < F.col("__u")))
    met = (F.col("__key") == F.col("__e")) & (F.col("__slot") == F.col("__k")) & current
    best = F.max(F.when(F.col("__e").isNotNull(), F.struct(F.length("__e").alias("n"), *named.values()))).alias("__best")
    decided = asked.join(active, met, "left").groupBy("__row", *own).agg(best)
    found = [F.col(f"__best.{new}").alias(old) for old, new in named.items()]
    return decided.select(*own, F.col("__best").isNotNull().alias("blocked"), *found)
