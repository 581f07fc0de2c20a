"""Scalar, aggregate and table functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import functions
from tidemark.plans.registry import query, table

# a whole multiple of the modulus keeps the operand of % non-negative
_HASH = """
    CAST(list_reduce(list_prepend(CAST(0 AS BIGINT),
             list_transform(string_split(s, ''), lambda c: CAST(unicode(c) AS BIGINT))),
         lambda h, x: ((31 * h + x + 2147483648 + 68719476736) % 4294967296) - 2147483648) AS INTEGER)
"""
_SPLIT = """
    SELECT page_id, word, CAST(length(word) AS INTEGER) AS length
    FROM (SELECT page_id, unnest(CASE WHEN contains(url, '?') THEN string_split(regexp_replace(url, '[?]+$', ''), '?')
                                      ELSE [url] END) AS word FROM pages)
"""


@query("udf_scalar_hash", f"SELECT page_id, {_HASH.replace('(s,', '(url,')} AS url_hash FROM pages")
def udf_scalar_hash(spark, sf):
    return table(spark, sf, "pages").select("page_id", functions.string_hash("url").alias("url_hash"))


@query("udf_scalar_hash_sql", f"SELECT event_id, {_HASH.replace('(s,', '(event_type,')} AS type_hash FROM events")
def udf_scalar_hash_sql(spark, sf):
    functions.register_functions(spark)
    table(spark, sf, "events").createOrReplaceTempView("clicks_table")
    return spark.sql("SELECT event_id, MyHash(event_type) AS type_hash FROM clicks_table")


@query(
    "udaf_weighted_avg",
    """SELECT user_id, CAST(sum((epoch_us(ts) // 1000) * (event_id % 3)) // nullif(sum(event_id % 3), 0) AS BIGINT) AS w_avg
       FROM events GROUP BY user_id""",
)
def udaf_weighted_avg(spark, sf):
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    weighted = table(spark, sf, "events").select("user_id", millis.alias("ms"), (F.col("event_id") % 3).alias("weight"))
    return weighted.groupBy("user_id").agg(functions.weighted_average("ms", "weight").alias("w_avg"))


@query("udtf_split", _SPLIT)
def udtf_split(spark, sf):
    return functions.split_words(table(spark, sf, "pages").select("page_id", "url")).drop("url")


@query("lateral_split", _SPLIT)
def lateral_split(spark, sf):
    functions.register_functions(spark)
    table(spark, sf, "pages").createOrReplaceTempView("pages_table")
    return spark.sql(
        """SELECT page_id, t.word, t.length
           FROM (SELECT page_id, MySplit(url) AS parts FROM pages_table), LATERAL inline(parts) AS t"""
    )
