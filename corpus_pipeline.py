"""A corpus from raw documents to packed token sequences, in four stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``documents``. The
operators are those of the queries, with their production parameters. Part of the subpackage ``logsift.llm``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logsift.llm.common import cut, table
from logsift.llm.ngram_join import BROADCAST_ROWS, ngram_join
from logsift.llm.packing import best_fit_packing
from logsift.llm.quality_rules import quality_rules
from logsift.llm.queries import tokenizer_path
from logsift.llm.toxicity import toxicity


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones, does not call toxic.

    Null and empty texts have the model's bias as their score and stay where it is under the threshold. Rows that come
    again, with whatever id, are judged one by one. Empty table: no rows. Extra columns stay, whatever their names.
    """
    return _kept(docs, lambda x: toxicity(x, table(spark, sf_dir, "labels")), F.col("predicted") == 0)


def of_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base and every quality rule.

    Null and empty texts fail the base. Rows that come again are judged one by one. Empty table: no rows. Extra columns
    stay, whatever their names.
    """
    return _kept(docs, quality_rules, F.col("kept"))


def _kept(docs: DataFrame, operator: Callable[[DataFrame], DataFrame], holds: Column) -> DataFrame:
    """Rows for which the operator's verdict holds. Columns other than id and text go round it in one of their own, as an
    operator replaces those named like its results."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    packed = docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in rest]).alias("_rest")) if rest else docs.select("doc_id", "text")
    found = operator(packed).where(holds)
    return found.select(*[F.col(f"_rest.`{c}`").alias(c) if c in rest else F.col(c) for c in docs.columns])


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents one: that of the smallest id, then of the smallest hash of its text.

    Rows of one id with different texts are documents of their own; rows of one id and text are copies, of which the one
    with the smallest hash of all its columns stays, with or without an id. A text without words is linked with nothing.
    Empty table: no rows. Extra columns stay.
    """
    ids = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    total = ids.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("d")).first()
    if total["n"] == total["d"]:  # every row has an id of its own
        found = cut(ngram_join(ids))
        stay = found.where("doc_id = component_id").select("doc_id")
        return docs.join(F.broadcast(stay) if stay.count() <= BROADCAST_ROWS else stay, "doc_id", "left_semi").select(*docs.columns)
    named = docs.withColumn("_row", F.xxhash64("doc_id", F.coalesce("text", F.lit(""))))
    found = cut(ngram_join(named.select(F.col("_row").alias("doc_id"), "text")).select(F.col("doc_id").alias("_row"), F.col("component_id").alias("_group")).distinct())
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("_row"), F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return named.join(found, "_row").groupBy("_group").agg(F.min_by(whole, order).alias("_d")).select("_d.*").select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents with their places in sequences.

    Null text is the end id alone. Rows that come again have pieces of their own. Empty table: no rows. Extra columns are
    not carried.
    """
    return best_fit_packing(docs, tokenizer_path())


STAGES = [("toxicity", without_toxic), ("quality_rules", of_quality), ("ngram_jaccard_join", without_near_copies), ("best_fit_packing", packed)]

#: Packing and the classifier are not expressible; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
