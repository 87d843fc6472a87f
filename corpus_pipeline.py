"""A corpus pipeline of five stages, each over all documents that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hostscope.llm import dedup, langid, mixing, ngram_join, pieces
from hostscope.llm.common import with_small, written

#: A document is rejected if no language holds this share of its words.
LEAST_LANG_SCORE = 0.5


def _keep(docs: DataFrame, decisions: DataFrame) -> DataFrame:
    """The documents that are kept (doc_id, kept), in their own columns; rows of one id stay if any of them is to stay.

    The ids to drop are sent to the documents if they are few enough by count; else both sides are shuffled.
    """
    ids = written(decisions.groupBy(F.col("doc_id").alias("__kept_id")).agg(F.max("kept").alias("__kept")), "pipeline-ids")
    same = docs["doc_id"].cast("long").eqNullSafe(F.col("__kept_id"))
    return with_small(docs, ids.where("not __kept").select("__kept_id"), same, "left_anti", 24)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in an identified language stay; letterless ones and mixtures without a main language go.

    Null, empty and letterless texts go, very long ones are read whole; a score of exactly 0.5 stays; rows of one id and
    different texts all stay if one does; repeated rows fare alike; without any lang to learn from all go; an empty
    table stays empty; other columns pass through.
    """
    found = langid.identify(docs)
    kept = (F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_LANG_SCORE)
    return _keep(docs, found.select("doc_id", kept.alias("kept")))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text stays, that of the largest id.

    Null counts as empty text; a null id stays only if its text has no other; of rows equal in id and text one stays,
    the least by its other columns; an empty table stays empty; other columns pass through.
    """
    found = dedup.exact_dedup(docs).select("doc_id", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
    found = written(found, "pipeline-exact")
    kept = _keep(docs, found)
    twice = written(found.where("kept").groupBy("doc_id", "text_sha256").count().where("count > 1").select("doc_id").distinct(), "pipeline-twice")
    if twice.isEmpty():
        return kept
    same = kept["doc_id"].cast("long").eqNullSafe(F.col("__twice"))
    ids = twice.select(F.col("doc_id").alias("__twice"))
    rest = with_small(kept, ids, same, "left_anti", 24)
    again = with_small(kept, ids, same, "left_semi", 24)
    order = F.to_json(F.struct(*[c for c in docs.columns if c not in ("doc_id", "text")]), {"ignoreNullFields": "false"})
    first = again.withColumn("__text", F.coalesce("text", F.lit(""))).withColumn("__nth", F.row_number().over(Window.partitionBy("doc_id", "__text").orderBy(order)))
    return rest.unionByName(first.where("__nth = 1").select(*docs.columns))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies stays, that of the least id.

    Null and blank texts link with nothing and stay; texts of any length are read whole; ids decide, so rows of one id
    stay together, and a null id stays only by itself; an empty table stays empty; other columns pass through.
    """
    return _keep(docs, ngram_join.near_duplicates(docs).select("doc_id", F.col("component_id").eqNullSafe(F.col("doc_id")).alias("kept")))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeat, or go, as the mix to the target weights says.

    Null and empty texts have size 0 and go; null is a source of its own, the last; rows of one id appear as often as
    the most taken of them; a document at a source's cut stays if at least half of it is taken; reruns agree; an empty
    table stays empty; other columns pass through.
    """
    taken = mixing.mix(docs).groupBy(F.col("doc_id").alias("__mix_id")).agg(F.max("epochs").alias("__mix_epochs")).where("__mix_epochs > 0")
    joined = with_small(docs, written(taken, "pipeline-mix"), docs["doc_id"].cast("long").eqNullSafe(F.col("__mix_id")), "inner", 32)
    return joined.withColumn("__mix_nth", F.explode(F.sequence(F.lit(1), F.col("__mix_epochs")))).select(*[docs[c] for c in docs.columns])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left, with the proof that they decode to its text.

    Null and empty texts have no ids; very long ones are encoded whole; repeated rows get equal ids; an empty table
    gives an empty result; other columns are left out.
    """
    return pieces.encode_documents(docs)


#: In this order; each but the last returns the columns of documents.
STAGES = [("language_id", language), ("exact_dedup", exact), ("ngram_join", near), ("mixing", mix), ("sentencepiece", encode)]

#: SQL expresses neither the fitted field nor the Viterbi encoding; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what each returns is written to the shared folder and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
