"""Evaluation metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def binary_metrics(pred: DataFrame, truth: Column, predicted: Column, by: list[str] | None = None) -> DataFrame:
    """tp, fp, fn, tn, correct, incorrect, f1 (0 when nothing is positive)."""
    count = lambda c, name: F.count_if(c).alias(name)
    out = pred.groupBy(*(by or [])).agg(count(truth & predicted, "tp"), count(~truth & predicted, "fp"), count(truth & ~predicted, "fn"), count(~truth & ~predicted, "tn"))
    d = 2 * F.col("tp") + F.col("fp") + F.col("fn")
    return out.withColumns({"correct": F.col("tp") + F.col("tn"), "incorrect": F.col("fp") + F.col("fn"), "f1": F.when(d == 0, F.lit(0.0)).otherwise(2 * F.col("tp") / d)})


def confusion(pred: DataFrame, truth: str, predicted: str) -> DataFrame:
    return pred.groupBy(F.col(truth).alias("truth"), F.col(predicted).alias("predicted")).agg(F.count(F.lit(1)).alias("n"))


def multiclass_metrics(pred: DataFrame, truth: str, predicted: str, labels: list[str]) -> DataFrame:
    """accuracy, macro_f1 over the listed labels seen in truth or prediction, matched and total."""
    cells = confusion(pred, truth, predicted)
    sides = cells.select(F.explode(F.array(F.struct(F.col("truth").alias("label"), F.lit("t").alias("side")), F.struct(F.col("predicted").alias("label"), F.lit("p").alias("side")))).alias("x"), "n", (F.col("truth") == F.col("predicted")).alias("hit"))
    per = sides.groupBy("x.label").agg(F.sum(F.when((F.col("x.side") == "t") & F.col("hit"), F.col("n")).otherwise(0)).alias("tp"), F.sum("n").alias("both")).where(F.col("label").isin(labels))
    macro = per.agg(F.coalesce(F.avg(2 * F.col("tp") / F.col("both")), F.lit(0.0)).alias("macro_f1"))
    total = cells.agg(F.sum(F.when(F.col("truth") == F.col("predicted"), F.col("n")).otherwise(0)).alias("matched"), F.sum("n").alias("total"))
    return total.join(F.broadcast(macro), F.lit(True)).withColumn("accuracy", F.col("matched") / F.col("total"))  # one row each


def review_cost(pred: DataFrame, truth: Column, predicted: Column, order: list[str], day: str = "day_id") -> DataFrame:
    """Per day: runs of neighbouring false splits (merge actions), missed splits (split actions), and both."""
    w = Window.partitionBy(day).orderBy(*order)
    rows = pred.withColumn("_f", predicted & ~truth).withColumn("_m", truth & ~predicted)
    rows = rows.withColumn("_run", F.col("_f") & ~F.coalesce(F.lag("_f").over(w), F.lit(False)))
    return rows.groupBy(day).agg(F.count_if("_run").alias("merge_runs"), F.count_if("_m").alias("split_actions")).withColumn("actions", F.col("merge_runs") + F.col("split_actions"))


def vote_segment_type(votes: DataFrame, group: str, kind: str) -> DataFrame:
    """The majority type of each group; a tie at the top is blank."""
    n = votes.groupBy(group, kind).agg(F.count(F.lit(1)).alias("n"))
    top = n.groupBy(group).agg(F.max("n").alias("m"))
    best = n.join(top, group).where("n = m").groupBy(group).agg(F.count(F.lit(1)).alias("k"), F.min(kind).alias("t"))
    return best.select(group, F.when(F.col("k") == 1, F.col("t")).otherwise("").alias("segment_type"))


def class_balance(rows: DataFrame, left: str, right: str) -> DataFrame:
    sets = rows.groupingSets([[left], [right]], left, right).agg(F.count(F.lit(1)).alias("row_count"), F.grouping(left).alias("_g"))
    return sets.select(F.when(F.col("_g") == 0, "left").otherwise("right").alias("side"), F.coalesce(left, right).alias("segment_type"), "row_count")


def throughput(rows: DataFrame, by: list[str], counts: str, ms: str) -> DataFrame:
    out = rows.groupBy(*by).agg(F.sum(counts).alias("total_count"), F.sum(ms).alias("total_ms"))
    return out.withColumn("per_second", F.when(F.col("total_ms") > 0, F.col("total_count") / (F.col("total_ms") / 1000)).otherwise(F.lit(0.0)))


def status_counts(rows: DataFrame, run: str, status: str, kinds: list[str]) -> DataFrame:
    return rows.groupBy(run).agg(*(F.count_if(F.col(status) == k).alias(f"n_{k}") for k in kinds))


def cut_votes(results: DataFrame) -> DataFrame:
    """For each neighbouring pair of usable answers: hits, reasons and type votes."""
    ok = results.where("response_status = 'ok' and cut_left is not null and cut_right is not null")
    return ok.groupBy("cut_left", "cut_right").agg(F.count(F.lit(1)).alias("hits"), F.array_sort(F.collect_list("reason")).alias("reasons"), F.array_sort(F.collect_list("left_type")).alias("left_types"), F.array_sort(F.collect_list("right_type")).alias("right_types"))


def model_scoreboard(results: DataFrame) -> DataFrame:
    """Per model: cases with any detection that matches the expected event, number, ordinal, and all of them; errors and seconds."""
    hit = lambda test: F.exists("detections", test)
    event = hit(lambda d: d["event_type"] == F.col("expected_event"))
    number = hit(lambda d: d["start_number"].eqNullSafe(F.col("expected_number")))
    ordinal = hit(lambda d: d["category_ordinal"].eqNullSafe(F.col("expected_ordinal")))
    strict = hit(lambda d: (d["event_type"] == F.col("expected_event")) & d["start_number"].eqNullSafe(F.col("expected_number")) & d["category_ordinal"].eqNullSafe(F.col("expected_ordinal")))
    out = results.groupBy("model").agg(F.count(F.lit(1)).alias("cases"), *(F.count_if(c).alias(n) for c, n in ((event, "event_correct"), (number, "number_correct"), (ordinal, "ordinal_correct"), (strict, "strict_correct"))), F.count_if(F.col("error").isNotNull()).alias("errors"), F.sum("seconds").alias("total_seconds"))
    return out.withColumn("strict_percent", 100 * F.col("strict_correct") / F.col("cases"))
