"""User functions. The column forms stay inside the JVM; the registered ones are inlined SQL functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

# fixed values: multiplier and modulus of the 32-bit polynomial string hash
_HASH_BASE = 31
_TWO_31 = 2_147_483_648
_TWO_32 = 4_294_967_296

# code units of a string: one per character, two (a surrogate pair) beyond the basic plane
_HASH_SQL = """
CAST(aggregate(
    flatten(transform(
        filter(split(s, ''), c -> c <> ''),
        c -> CASE WHEN ascii(c) < 65536 THEN array(CAST(ascii(c) AS BIGINT))
                  ELSE array(CAST(55296 + ((ascii(c) - 65536) div 1024) AS BIGINT),
                             CAST(56320 + pmod(ascii(c) - 65536, 1024) AS BIGINT)) END)),
    CAST(0 AS BIGINT),
    (h, unit) -> pmod(31 * h + unit + 2147483648, 4294967296) - 2147483648) AS INT)
"""


def string_hash(text: Column | str) -> Column:
    """32-bit polynomial hash (base 31, wrapping) over UTF-16 code units; ``'Alice'`` gives 63350368."""
    characters = F.filter(F.split(text, ""), lambda c: c != "")

    def units(c: Column) -> Column:
        code = F.ascii(c).cast("long")
        beyond = code - 0x10000
        pair = F.array(F.lit(0xD800) + F.shiftright(beyond, 10), F.lit(0xDC00) + beyond.bitwiseAND(0x3FF))
        return F.when(code < 0x10000, F.array(code)).otherwise(pair)

    def fold(h: Column, unit: Column) -> Column:
        return F.pmod(h * _HASH_BASE + unit + _TWO_31, F.lit(_TWO_32)) - _TWO_31

    return F.aggregate(F.flatten(F.transform(characters, units)), F.lit(0).cast("long"), fold).cast("int")


def weighted_average(value: Column | str, weight: Column | str) -> Column:
    """Whole-number weighted average; NULL when the weights sum to zero. A mergeable aggregate."""
    value = F.col(value) if isinstance(value, str) else value
    weight = F.col(weight) if isinstance(weight, str) else weight
    total = F.sum(weight)
    return F.call_function("div", F.sum(value * weight), F.nullif(total, F.lit(0).cast("long")))


def java_split(text: Column | str, pattern: str) -> Column:
    """``split`` without the trailing empty parts; a text without a match stays whole."""
    parts = F.split(text, pattern)
    kept = F.array_max(F.transform(parts, lambda part, i: F.when(part != "", i + 1).otherwise(F.lit(0))))
    return F.when(F.size(parts) == 1, parts).otherwise(F.slice(parts, 1, kept))


def split_words(df: DataFrame, column: str = "url", pattern: str = "[?]") -> DataFrame:
    """One row per part of ``column``, with the part's length."""
    exploded = df.withColumn("word", F.explode(java_split(column, pattern)))
    return exploded.withColumn("length", F.length("word"))


def register_functions(spark: SparkSession) -> None:
    """Register ``MyHash(str)`` and ``MySplit(str)`` for SQL.

    Both are SQL functions, which Spark inlines into the calling plan. ``MySplit`` returns an array of
    ``(word, length)``; ``FROM (SELECT *, MySplit(url) AS parts FROM t), LATERAL inline(parts)`` turns it
    into rows without a join. The weighted average is an aggregate, which a SQL function cannot wrap; in SQL write
    ``sum(value * weight) div nullif(sum(weight), 0)``.
    """
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION MyHash(s STRING) RETURNS INT RETURN {_HASH_SQL}")
    spark.sql(
        """
        CREATE OR REPLACE TEMPORARY FUNCTION MySplit(str STRING)
        RETURNS ARRAY<STRUCT<word: STRING, length: INT>>
        RETURN transform(
            CASE WHEN instr(str, '?') = 0 THEN array(str)
                 WHEN regexp_replace(str, '[?]+$', '') = '' THEN CAST(array() AS ARRAY<STRING>)
                 ELSE split(regexp_replace(str, '[?]+$', ''), '[?]') END,
            part -> struct(part AS word, length(part) AS length))
        """
    )
