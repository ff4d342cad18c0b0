"""L5: metrics of probabilities, choices, scores and routing against labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .graph import cut
from .route import SURFACED


def _share(num: Column, den: Column, digits: int = 4) -> Column:
    """num / den rounded, null where den is 0."""
    return F.round(num / F.nullif(den, F.lit(0)), digits)


def binary_metrics(rows: DataFrame, threshold: float = 0.5, by: tuple[str, ...] = ()) -> DataFrame:
    """rows: y (boolean), p. Confusion counts, precision, recall and f1 (0 on an empty denominator), brier."""
    hit = F.col("p") >= threshold
    n = lambda c: F.count_if(c)
    x = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), n(F.col("y")).alias("positives"), n(F.col("y") & hit).alias("tp"), n(~F.col("y") & hit).alias("fp"), n(F.col("y") & ~hit).alias("fn"), n(~F.col("y") & ~hit).alias("tn"),
        F.round(F.avg(F.pow(F.col("p") - F.col("y").cast("double"), F.lit(2.0))), 4).alias("brier"),
    )
    p = F.coalesce(F.col("tp") / F.nullif(F.col("tp") + F.col("fp"), F.lit(0)), F.lit(0.0))
    r = F.coalesce(F.col("tp") / F.nullif(F.col("tp") + F.col("fn"), F.lit(0)), F.lit(0.0))
    x = x.withColumns({"_p": p, "_r": r})
    f1 = F.coalesce(2 * F.col("_p") * F.col("_r") / F.nullif(F.col("_p") + F.col("_r"), F.lit(0.0)), F.lit(0.0))
    return x.withColumns({"precision": F.round("_p", 4), "recall": F.round("_r", 4), "f1": F.round(f1, 4)}).drop("_p", "_r")


def reliability(rows: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """bin (0 to 9), n, mean_p, observed; empty bins are left out."""
    b = F.least(F.floor(F.col("p") * 10).cast("int"), F.lit(9))
    return rows.groupBy(*by, b.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("p"), 4).alias("mean_p"), F.round(F.avg(F.col("y").cast("double")), 4).alias("observed"))


def ece(rows: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Expected calibration error over the rounded bins."""
    x = reliability(rows, by).groupBy(*by).agg(F.sum(F.col("n") * F.abs(F.col("observed") - F.col("mean_p"))).alias("_s"), F.sum("n").alias("_n"))
    return x.select(*by, F.round(F.coalesce(F.col("_s") / F.nullif("_n", F.lit(0)), F.lit(0.0)), 4).alias("ece"))


def best_threshold(rows: DataFrame, target: float = 0.9) -> DataFrame:
    """The lowest p rounded to 3 digits at which precision reaches the target, else null.

    Thresholds are at most 1001, so rows are counted by the largest threshold that they pass, and then accumulated. A
    row's p can be below its own rounded value: it passes the next lower threshold.
    """
    t = F.round(F.col("p"), 3)
    x = rows.select("y", "p", t.alias("t"))
    marks = x.select(F.col("t").alias("m")).distinct()
    up = x.withColumn("k", F.round(F.when(F.col("p") >= F.col("t"), F.col("t") * 1000).otherwise(F.col("t") * 1000 - 1), 0).cast("int")).groupBy("k").agg(F.count_if("y").alias("tp"), F.count(F.lit(1)).alias("n"))
    points = up.select("k", "tp", "n", F.lit(False).alias("mark")).union(marks.select(F.round(F.col("m") * 1000, 0).cast("int"), F.lit(0).cast("long"), F.lit(0).cast("long"), F.lit(True)))
    per = points.groupBy("k").agg(F.sum("tp").alias("tp"), F.sum("n").alias("n"), F.max("mark").alias("mark"))
    w = Window.partitionBy(F.lit(0)).orderBy(F.desc("k"))  # at most 1001 rows
    cum = per.select("k", "mark", F.sum("tp").over(w).alias("tp"), F.sum("n").over(w).alias("n"))
    ok = cum.where(F.col("mark") & (F.col("tp") > 0) & (F.col("tp") / F.col("n") >= target))
    return ok.agg((F.min("k") / 1000).alias("threshold"))


def choice_metrics(rows: DataFrame) -> DataFrame:
    """rows: label, pred, p (of the prediction). One row: n, accuracy, top1_ece."""
    x = rows.select((F.col("label") == F.col("pred")).alias("y"), "p")
    a = x.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(F.col("y").cast("double")), 4).alias("accuracy"))
    one = ece(x).select(F.col("ece").alias("top1_ece"), F.lit(1).alias("_j"))
    return a.withColumn("_j", F.lit(1)).join(F.broadcast(one), "_j").drop("_j")


def confusions(rows: DataFrame, most: int = 5, order: str = "seq") -> DataFrame:
    """confusion (``label->pred``), n: the most frequent ones, equals by first sight."""
    x = rows.where(F.col("label") != F.col("pred")).groupBy(F.concat("label", F.lit("->"), "pred").alias("confusion")).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("_f"))
    return x.orderBy(F.desc("n"), "_f").limit(most).drop("_f")


def score_metrics(rows: DataFrame) -> DataFrame:
    """rows: label (int), pred (int), expected. One row: n, exact, within_1, mae_expected."""
    d = F.abs(F.col("label") - F.col("pred"))
    avg = lambda c: F.round(F.avg(c.cast("double")), 4)
    return rows.agg(F.count(F.lit(1)).alias("n"), avg(d == 0).alias("exact"), avg(d <= 1).alias("within_1"), avg(F.abs(F.col("label") - F.col("expected"))).alias("mae_expected"))


def routing_quality(rows: DataFrame) -> DataFrame:
    """rows: id, decision, actionable (boolean label or null). Shares are null on an empty denominator."""
    y, sup, sur = F.col("actionable"), F.col("decision") == "suppress", F.col("decision").isin(*SURFACED)
    x = rows.where(y.isNotNull()).agg(
        F.count_if(y).alias("positives"), F.count_if(sup).alias("suppressed"), F.count_if(sur).alias("surfaced"), F.count_if(y & sup).alias("ys"), F.count_if(~y & sup).alias("ns"), F.count_if(y & sur).alias("yu"),
    )
    return x.select(
        _share(F.col("ys"), F.col("positives")).alias("false_suppression_rate"), _share(F.col("ns"), F.col("suppressed")).alias("suppression_precision"),
        _share(F.col("yu"), F.col("surfaced")).alias("surfaced_precision"), _share(F.col("yu"), F.col("positives")).alias("surfaced_recall"), F.col("ys").alias("false_suppressions"),
    )


def gate(quality: DataFrame, most: float) -> bool:
    """Whether the false suppression rate is at most ``most``; an undefined rate passes."""
    rate = quality.first()["false_suppression_rate"]
    return rate is None or rate <= most


def golden_rows(clusters: DataFrame) -> DataFrame:
    """Unlabelled golden rows of clusters."""
    return clusters.select(F.col("template_id").alias("id"), "service", "level", "template", "examples", "count", F.create_map().cast("map<string,string>").alias("labels"))


def nearest_rank(rows: DataFrame, value: str, percents: list[float]) -> DataFrame:
    """percent, value: the element at round((n - 1) · percent / 100), halves to even; 0 without rows.

    Distinct values are counted first and dealt to partitions by range; only the counts of partitions come to the driver,
    and values are ranked within their partition.
    """
    spark = rows.sparkSession
    per = rows.groupBy(F.col(value).alias("v")).agg(F.count(F.lit(1)).alias("c"))
    per = cut(per.repartitionByRange("v").withColumn("_p", F.spark_partition_id()))
    sizes = sorted((r["lo"], r["_p"], r["n"]) for r in per.where("v IS NOT NULL").groupBy("_p").agg(F.min("v").alias("lo"), F.sum("c").alias("n")).collect())
    n = sum(s for _, _, s in sizes)
    if not n:
        return spark.createDataFrame([(float(p), 0.0) for p in percents], "percent double, value double")
    before, wanted = 0, []
    for _, part, size in sizes:
        wanted += [(float(p), part, i - before) for p in percents if before <= (i := round(p / 100 * (n - 1))) < before + size]
        before += size
    w = Window.partitionBy("_p").orderBy("v")
    cum = per.where("v IS NOT NULL").select("_p", "v", F.sum("c").over(w).alias("hi"), (F.sum("c").over(w) - F.col("c")).alias("lo"))
    want = spark.createDataFrame(wanted, "percent double, _p int, i long")
    return cum.join(F.broadcast(want), "_p").where((F.col("i") >= F.col("lo")) & (F.col("i") < F.col("hi"))).select("percent", F.col("v").cast("double").alias("value"))
