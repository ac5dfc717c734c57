"""A corpus pipeline: quality, language, near copies, mix, sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next one's docs. All but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm import jaccard, langid, mixing, packing, quality
from starmart.llm.tables import materialize, name

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

_SCORE, _KEY = "__score", "__key"


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores below its threshold go.

    Where nothing could be learned (no examples, or less than a hundredth of them of one label), all
    documents stay.
    """
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    if not model.learned:
        return docs
    scored = quality.score_quality(docs, model, score=_SCORE)
    return scored.filter(F.col(_SCORE) >= quality.THRESHOLD).select(docs.columns)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or unlike every language learned, go.

    Of texts too short to be told from chance, only those go that score below nearly all their like.
    Where no language could be learned, all documents stay.
    """
    # Every labelled row that is not held out, not a bounded sample, gives the prototypes and the least cosines.
    model = langid.fit(docs, rows=None)
    if not model.languages:
        return docs
    return langid.keep_known(docs, model, langid.least_cosines(docs, model, rows=None))


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts joined by links of 80 % of five-word shingles, one row stays.

    It is the one of least id (rows without an id come last), then of least fingerprint of id and
    text, so rows of one id with different texts are told apart and rows without an id are not
    spared. A text without words is in a group of its own id and text.
    """
    keyed = docs.withColumn(_KEY, F.xxhash64("doc_id", "text"))
    groups = jaccard.jaccard_components(keyed, _KEY).select("id", "component_id").distinct()
    ids = keyed.select(_KEY, F.struct(F.col("doc_id").isNull(), "doc_id", _KEY).alias("order")).distinct()
    first = groups.join(ids, F.col("id") == F.col(_KEY)).groupBy("component_id").agg(F.min("order").alias("least"))
    kept = keyed.join(first.select(F.col(f"least.{_KEY}").alias(_KEY)), _KEY, "left_semi")
    # Rows that repeat id and text can differ in other columns: the same one stays in every run.
    columns = [name(c) for c in docs.columns]
    one = kept.groupBy(_KEY).agg(F.min_by(F.struct(*columns), F.xxhash64(*columns)).alias("row"))
    return one.select("row.*")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The stream of the mix: rows as often as it takes them, in its order.

    Rows that repeat an id are told apart by their texts, so a task that is run again deals them alike.
    """
    marked = docs.withColumnsRenamed(_away(docs)).withColumn(_KEY, F.xxhash64("text"))
    mixed = mixing.mix_sources(marked, ["doc_id", _KEY])
    ordered = mixed.orderBy("position")
    back = {new: old for old, new in _away(docs).items()}
    return ordered.drop("slot", "position", "block", "epoch").withColumnsRenamed(back).select(docs.columns)


def _away(docs: DataFrame) -> dict[str, str]:
    """Other names for columns that are called like those the mix adds."""
    return {c: f"__kept_{c}" for c in docs.columns if c in ("slot", "position", "block", "epoch")}


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents of the mix and their places in sequences of 4,096 tokens."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality_stage),
    ("language ID", language_stage),
    ("n-gram Jaccard join", near_copy_stage),
    ("mixing sources to target weights", mixing_stage),
    ("best-fit packing", packing_stage),
]

#: SQL cannot express the two learned stages; the tests hold each stage against plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each on all that its predecessor kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = materialize(docs, f"stage{number}")
    return docs
