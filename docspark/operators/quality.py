"""Score thresholds, three-way routing and quality reports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docspark.operators.extract import parse_judgement, parse_reply

LOAD, REVIEW, REJECT = "load", "review", "reject"

# --- Fixed values ---
NO_RESULTS = "Extraction produced no results"
REVIEW_ABOVE = 0.5


@dataclass(frozen=True)
class Thresholds:
    completeness: float = 0.8
    accuracy: float = 0.9


# --- Fixed values: thresholds per environment ---
THRESHOLDS = {
    "base": Thresholds(0.8, 0.9),
    "development": Thresholds(0.7, 0.9),
    "production": Thresholds(0.9, 0.95),
}


def _at_least(score: Column, bound: float) -> Column:
    score = F.coalesce(score, F.lit(0.0))
    return ~F.isnan(score) & (score >= bound)  # not-a-number is never enough


def passes(completeness: Column, accuracy: Column, t: Thresholds) -> Column:
    """Both scores reach their threshold; a missing score is 0."""
    return _at_least(completeness, t.completeness) & _at_least(accuracy, t.accuracy)


def judge(df: DataFrame, reply: str = "judge_reply", t: Thresholds = Thresholds(), success: str = "success") -> DataFrame:
    """Scores, overall, issues, passed, flagged and route per record.

    A failed extraction, a failed call or a score outside 0..1 sends the record to review with
    zero scores; otherwise it passes by the thresholds, or is flagged when its overall is over 0.5.
    """
    df = df.withColumns({f"_{k}": v for k, v in parse_judgement(F.col(reply)).items()})
    usable = F.col(success) & F.col("_completeness").between(0.0, 1.0) & F.col("_accuracy").between(0.0, 1.0)
    if "judge_error" in df.columns:
        usable = usable & F.col("judge_error").isNull()
    df = df.withColumn("_usable", F.coalesce(usable, F.lit(False)))
    ok = F.col("_usable")
    df = df.withColumns(
        {
            "completeness": F.when(ok, F.col("_completeness")).otherwise(0.0),
            "accuracy": F.when(ok, F.col("_accuracy")).otherwise(0.0),
            "issues": F.when(ok, F.col("_issues")).otherwise(F.array().cast("array<string>")),
        }
    )
    df = df.withColumns(
        {
            "overall": (F.col("completeness") + F.col("accuracy")) / 2,
            "passed": ok & passes(F.col("completeness"), F.col("accuracy"), t),
        }
    )
    df = df.withColumn("flagged", ~F.col("passed") & (~ok | (F.col("overall") > REVIEW_ABOVE)))
    return df.withColumn("route", route(F.col("passed"), F.col("flagged"))).drop(
        "_completeness", "_accuracy", "_issues", "_usable"
    )


def skip_judging(df: DataFrame) -> DataFrame:
    """Let every record pass without a judge: overall 1, the other scores 0."""
    return df.withColumns(
        {
            "completeness": F.lit(0.0),
            "accuracy": F.lit(0.0),
            "issues": F.array().cast("array<string>"),
            "overall": F.lit(1.0),
            "passed": F.lit(True),
            "flagged": F.lit(False),
            "route": F.lit(LOAD),
        }
    )


def route(passed: Column, flagged: Column) -> Column:
    return F.when(passed, LOAD).when(flagged, REVIEW).otherwise(REJECT)


def quality_report(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Counts, mean scores and pass rate over all records, or per group of ``by``.

    Plain sums and counts: partial results are combined before the shuffle, so a group of any
    size costs one row per task. Scores are summed as decimals, so the means do not depend on how
    the rows are spread.
    """
    total = F.count("*")
    passed, flagged = F.col("passed"), F.col("flagged")

    def mean(score: str) -> Column:
        total_score = F.sum(F.col(score).cast("decimal(18,17)")).cast("double")
        return F.bround(F.coalesce(total_score / F.nullif(total, F.lit(0)), F.lit(0.0)), 3)

    agg = df.groupBy(*(by or [])).agg(
        total.alias("total_documents"),
        F.count_if(passed).alias("passed_count"),
        F.count_if(~passed & ~flagged).alias("failed_count"),
        F.count_if(flagged).alias("flagged_count"),
        mean("completeness").alias("average_completeness"),
        mean("accuracy").alias("average_accuracy"),
    )
    rate = F.when(F.col("total_documents") > 0, F.col("passed_count") / F.col("total_documents"))
    return agg.withColumn("pass_rate", F.coalesce(rate, F.lit(0.0)))


def reply_agreement(replies: DataFrame, key: str = "document_id", reply: str = "reply") -> DataFrame:
    """How far repeated replies on a document agree: (key, replies, usable, fields, consistency).

    A reply is usable if it is a JSON object with a key at least. Per field the replies with its most frequent value count,
    a reply without the field having the value "absent"; their share of the usable replies, averaged over all fields, is the
    consistency (1 for a single reply, null without a usable one). Values are equal if their JSON texts are.
    Counts per (key, field, value) are combined before the shuffle, so a document with many replies sends one row per value and task.
    """
    parsed = parse_reply(replies.select(key, F.col(reply).alias("reply"))).select(key, F.when(F.col("success"), F.col("extracted")).alias("_fields"))
    totals = parsed.groupBy(key).agg(F.count("*").alias("replies"), F.count("_fields").alias("usable"))
    values = parsed.select(key, F.explode("_fields").alias("_field", "_value")).withColumn("_value", F.to_json("_value"))
    counts = values.groupBy(key, "_field", "_value").agg(F.count("*").alias("_n"))
    most = counts.groupBy(key, "_field").agg(F.max("_n").alias("_most"), F.sum("_n").alias("_present"))
    own = totals.withColumnRenamed(key, "_key")
    joined = own.join(most, own["_key"].eqNullSafe(most[key]), "left")
    best = F.greatest(F.col("_most"), F.col("usable") - F.col("_present"))
    out = joined.groupBy("_key", "replies", "usable").agg(F.count("_field").alias("fields"), F.sum(best).alias("_best"))
    consistency = F.when(F.col("usable") > 0, F.col("_best") / (F.col("fields") * F.col("usable")))
    return out.select(F.col("_key").alias(key), "replies", "usable", "fields", consistency.alias("consistency"))


def extract_response(df: DataFrame, reply: str = "judge_reply", t: Thresholds = Thresholds()) -> DataFrame:
    """Answer to a single extraction: quality score, passed and issues, or an error when nothing was extracted."""
    scores = parse_judgement(F.col(reply))
    ok = F.col("success")
    return df.withColumns({f"_{k}": v for k, v in scores.items()}).withColumns(
        {
            "quality_score": F.when(ok, (F.col("_completeness") + F.col("_accuracy")) / 2),
            "passed_validation": F.when(ok, passes(F.col("_completeness"), F.col("_accuracy"), t)),
            "issues": F.when(ok, F.col("_issues")).otherwise(F.array().cast("array<string>")),
            "error": F.when(~ok, NO_RESULTS),
        }
    ).drop("_completeness", "_accuracy", "_issues")


def batch_responses(judged: DataFrame) -> DataFrame:
    """Answers to a batch request, one per document, with the record itself (``quality_report`` has the summary)."""
    data = [F.col("data").alias("extracted_data")] if "data" in judged.columns else []
    return judged.select(
        "document_id", *data, F.col("overall").alias("quality_score"), F.col("passed").alias("passed_validation"), "issues"
    )
