"""The registered ``opN_`` queries: each applies one operator to whole tables and derives the columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import alignment, decontaminate, fingerprints, flatfiles, infill, jaccard, mixing, oracles, owners, passages, planes, tables, toxicity, urlfilter, warc

Run = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def byte_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = fingerprints.compared(_table(spark, sf_dir, "documents"))
    own, edited, following = (F.col(c) for c in ("sketch", "edited_sketch", "next_sketch"))
    return both.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited"), 256).alias("edited_sha256"),
        fingerprints.printed(own).alias("fingerprint"),
        fingerprints.printed(edited).alias("edited_fingerprint"),
        fingerprints.likeness(own, edited).alias("near_edited"),
        fingerprints.likeness(own, following).alias("near_next"),
    )


def op2_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated(_table(spark, sf_dir, "documents"))


def op3_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = mixing.decisions(_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    position = F.col("__times")[0]
    columns = {"size": "__size", "source_size": "__source_size", "target": "__target", "taken": "__taken"}
    named = [F.col(old).alias(new) for new, old in columns.items()]
    return placed.select("doc_id", *named, position.alias("position")).orderBy(F.asc_nulls_last("position"), "doc_id")


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.joined(_table(spark, sf_dir, "documents"))


LISTS_BEGIN = 1_704_067_200  # 2024-01-01
_HALF_DAY = 43_200


def _listing(pages: DataFrame) -> DataFrame:
    """Dated events of a list over hosts, domains and first path segments of the pages, dealt by their digests."""
    names = pages.select(F.explode(urlfilter.keys(F.col("url"), 3, 1)).alias("entry")).distinct()
    digit = lambda i: F.conv(F.substring(F.md5("entry"), 2 * i + 1, 2), 16, 10).cast("long")
    added = F.lit(LISTS_BEGIN) + digit(1) * (_HALF_DAY // 2)
    removed = added + (digit(2) + 1) * _HALF_DAY
    again = removed + (digit(3) + 1) * _HALF_DAY
    category = F.when(digit(4) % 2 == 0, "spam").otherwise("adult")
    event = lambda action, at, use: F.struct(F.lit(action).alias("action"), at.alias("at"), use.alias("use"))
    always = F.lit(True)
    events = F.array(event("add", added, always), event("remove", removed, always), event("add", again, digit(5) % 2 == 0))
    listed = names.where((digit(0) < 64) & F.col("entry").contains("."))
    return listed.select("entry", category.alias("category"), F.explode(events).alias("e")).where("e.use").select(
        "entry", "category", "e.action", "e.at"
    )


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    captures = pages.withColumn("fetched_at", F.lit(LISTS_BEGIN) + F.col("page_id") * 60)
    listed = tables.stored(urlfilter.intervals(_listing(pages)), "url-list")
    return urlfilter.judged(captures, listed)


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.judged(decontaminate.matches(docs, _table(spark, sf_dir, "benchmark")))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op7_bit_planes(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return planes.read(planes.write(docs, tokenizer or byte_bpe(), end_id=2))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.scored(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))
    return scored.select("doc_id", "n_words", "severity", "toxic_chance", "grade", (F.col("grade") > 0).alias("toxic"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    whole = warc.captures(warc.read(archives))
    notes = F.map_from_entries("metadata.notes")
    return whole.select(
        notes["page-id"].cast("long").alias("page_id"),
        F.col("response.payload_bytes").alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"),
        F.col("response.type").alias("record_type"),
        notes["refers-to-page-id"].cast("long").alias("refers_to"),
    )


def op10_separator_scan(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    end_id = 50256  # the special token of this vocabulary
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    written = flatfiles.write(docs, tokenizer or byte_bpe(), end_id)
    counts = flatfiles.named(flatfiles.scan(written.select("address", "size"), end_id), written)
    return counts.select("doc_id", "n_tokens")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    met = alignment.aligned(docs, byte_bpe(), public_tokenizers.path("piece_bpe_32k.model"))
    return alignment.scored(met, alignment.pair_counts(met))


def op12_exact_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    return owners.owners(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op13_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = infill.infilled(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    restored = infill.restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(restored, 256).alias("restored_sha256"),
    )


RUNS: dict[str, Run] = {
    "op1_fingerprints": op1_fingerprints,
    "op2_passages": op2_passages,
    "op3_mix": op3_mix,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_url_filter": op5_url_filter,
    "op6_decontaminate": op6_decontaminate,
    "op7_bit_planes": op7_bit_planes,
    "op8_toxicity": op8_toxicity,
    "op9_warc": op9_warc,
    "op10_separator_scan": op10_separator_scan,
    "op11_alignment": op11_alignment,
    "op12_exact_owners": op12_exact_owners,
    "op13_infill": op13_infill,
}
SQL: dict[str, str] = {
    "op4_jaccard_join": oracles.JACCARD,
    "op5_url_filter": oracles.URL_FILTER,
    "op9_warc": oracles.WARC,
    "op6_decontaminate": oracles.DECONTAMINATE,
    "op12_exact_owners": oracles.OWNERS,
    "op13_infill": oracles.INFILL,
}


def queries() -> dict[str, Run]:
    return dict(RUNS)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
