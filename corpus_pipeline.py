"""A training corpus from ``documents``: toxic documents go, one of each group of near copies stays, contaminated ones go,
sources are mixed to their target weights, and what is left becomes token files.

``STAGES`` are (name, function of session, documents and table folder). Each works on all that its predecessor kept and
decides for itself, with batches of few rows for Python (``few_rows``), as executors hold them twice: null texts are kept by the filters (they have no words to object to), but never drawn by the mix, and
so the token files have none. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, jaccard, mixing, planes, toxicity
from tidemark.llm.queries import byte_bpe
from tidemark.llm.tables import few_rows, stored, written_order


def _columns(frame: DataFrame, docs: DataFrame) -> DataFrame:
    return frame.select(*(F.col(f"`{c}`") for c in docs.columns))


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose severity grade is 0; the model is fitted on the labelled ones of ``docs``."""
    few_rows(spark)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    names = ("__n_words", "__severity", "__toxic_chance", "__grade")
    return _columns(toxicity.scored(docs, model, names=names).where("__grade = 0"), docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each component of links of 0.75 or more."""
    return _columns(jaccard.deduplicated(docs), docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of whose words less than a twentieth stands in benchmark windows."""
    few_rows(spark)
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, once per whole take of their source's target."""
    return mixing.mixed(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of each take of a document, read back from its plane file.

    The files hold the takes in the training order, which is that of the rows that the mix wrote.
    """
    few_rows(spark)
    return planes.read(planes.write(docs, byte_bpe(), end_id=2, order=written_order(docs)))


STAGES = [
    ("toxicity", not_toxic),
    ("near copies", without_near_copies),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
    ("token files", token_files),
]
#: The model of the first stage is no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what each returns is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
