"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.graph import cut as cut

#: Words are maximal runs of characters other than space and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body) -> Column:
    """``body(v)`` with ``v`` bound to ``value``, which is then computed once a row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    """Words of a text in order; a null text has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def ratio(num: Column, den: Column) -> Column:
    """num / den as double, 0 where den is 0."""
    return F.when(den == 0, F.lit(0.0)).otherwise(num.cast("double") / F.greatest(den, F.lit(1)).cast("double"))


def crc_mod(col: str, mod: int) -> Column:
    """crc32 of the value as text, modulo; a null counts as the empty text."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit(""))) % mod


#: Rows that Python gets at once, at most: texts are long, and workers have little memory.
BATCH_ROWS = 500
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(df: DataFrame) -> None:
    """Holds the session's Arrow batches at ``BATCH_ROWS`` rows, or at fewer if it asks for fewer.

    Spark reads this setting when a plan runs, after an operator has returned its frame, so it stays set. All operators
    ask for the same number, and none raises it.
    """
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(_BATCH)) <= BATCH_ROWS:
        conf.set(_BATCH, BATCH_ROWS)


def labelled(docs: DataFrame, labels: DataFrame, label: str, mod: int, held: int, limit: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """At most ``limit`` labelled rows (those of the smallest hashes) outside the held-out fold: key, text, y.

    Labels are bounded before the join, and the rows that they find after it: a key may come again in ``docs``.
    """
    few = labels.where(F.col(label).isNotNull() & (crc_mod(key, mod) != held)).groupBy(key).agg(F.max(label).alias("y"))
    few = few.orderBy(F.xxhash64(key), key).limit(limit)
    found = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("text")).join(F.broadcast(few), key)
    return found.orderBy(F.xxhash64(key), key, F.xxhash64("text")).limit(limit)
