"""Model logs: deployments, trainings, alerts, retrain decisions, A/B scores.

Log tables are append-only; each function returns the rows to append or a view of the log.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spinledger.functions.ranking import first_per_group

MODEL = ["model_name", "deployment_environment"]


def active_versions(log: DataFrame) -> DataFrame:
    """The version in use per model and environment: that of the latest event."""
    order = [F.desc("deployment_timestamp"), F.desc("version")]
    return first_per_group(log, MODEL, order)


def deploy(log: DataFrame, requests: DataFrame) -> DataFrame:
    """Log rows of new deployments.

    ``requests``: model_name, version, deployment_environment, deployment_timestamp, one per
    model and environment. The version in use becomes the previous version.
    """
    current = active_versions(log).select(*MODEL, F.col("version").alias("previous_version"))
    return requests.join(current, MODEL, "left").select(
        "model_name",
        "version",
        "deployment_environment",
        "deployment_timestamp",
        F.lit("active").alias("deployment_status"),
        "previous_version",
        F.lit(True).alias("rollback_available"),
    )


def rollback(log: DataFrame, requests: DataFrame) -> DataFrame:
    """Log rows that bring back the previous version; models without one get no row.

    ``requests``: model_name, deployment_environment, deployment_timestamp.
    """
    current = active_versions(log).select(
        *MODEL, F.col("version").alias("_current"), F.col("previous_version").alias("_previous")
    )
    return (
        requests.join(current, MODEL)
        .filter(F.col("_previous").isNotNull())
        .select(
            "model_name",
            F.col("_previous").alias("version"),
            "deployment_environment",
            "deployment_timestamp",
            F.lit("active_rollback").alias("deployment_status"),
            F.col("_current").alias("previous_version"),
            F.lit(True).alias("rollback_available"),
        )
    )


def deployment_history(log: DataFrame) -> DataFrame:
    """Every deployment with the state it is in now.

    The latest event of a model is active; an event is rolled back when the next event is a
    rollback, and replaced when it is not.
    """
    events = W.partitionBy(*MODEL).orderBy("deployment_timestamp", "version")
    following = F.lead("deployment_status").over(events)
    state = (
        F.when(following.isNull(), F.col("deployment_status"))
        .when(following == "active_rollback", "rolled_back")
        .otherwise("replaced")
    )
    return log.withColumn("current_status", state)


def training_history(log: DataFrame) -> DataFrame:
    """Completed trainings with the change against the previous one of the model."""
    runs = W.partitionBy("model_name").orderBy("training_timestamp", "version")
    before = F.lag("overall_performance").over(runs)
    gap = F.datediff("training_timestamp", F.lag("training_timestamp").over(runs))
    return log.filter("training_completed").withColumns(
        {
            "previous_performance": before,
            "performance_change": F.col("overall_performance") - before,
            "days_since_last_training": gap,
        }
    )


def alerts(scores: DataFrame, at: Column, channel: str = "email") -> DataFrame:
    """Alert rows from ``model_name``, ``performance_score`` and ``threshold``."""
    ratio = F.col("performance_score") / F.col("threshold")
    severity = F.when(ratio < 0.5, "CRITICAL").when(ratio < 0.7, "HIGH").otherwise("MEDIUM")
    message = F.concat(
        F.lit("["), severity, F.lit("] Model Performance Alert: "), "model_name",
        F.lit(" performance ("), F.col("performance_score").cast("string"),
        F.lit(") below threshold ("), F.col("threshold").cast("string"), F.lit(")"),
    )
    return scores.select(
        at.alias("alert_timestamp"),
        "model_name",
        F.lit("performance_degradation").alias("alert_type"),
        severity.alias("severity"),
        message.alias("message"),
        "performance_score",
        "threshold",
        F.lit(channel).alias("alert_channel"),
    )


def retrain_decision(
    scores: DataFrame, performance_threshold: float = 0.7, drift_threshold: float = 0.2
) -> DataFrame:
    """Recommended actions per row of overall_score, drift_score and model_age_days.

    A missing drift counts as 0 and a missing age as 999 days.
    """
    performance = F.col("overall_score")
    drift = F.coalesce("drift_score", F.lit(0.0))
    age = F.coalesce("model_age_days", F.lit(999))
    low, moved = performance < performance_threshold, drift > drift_threshold
    excellent = (performance > 0.8) & (drift < 0.1)
    actions = F.array_compact(
        F.array(
            F.when(low, "retrain_model"),
            F.when(low, "analyze_user_feedback"),
            F.when(moved, "concept_drift_detected"),
            F.when(moved, "incremental_update"),
            F.when(excellent, "performance_excellent"),
            F.when(age > 14, "model_aging"),
        )
    )
    return scores.withColumn("recommendations", actions).withColumn(
        "needs_attention", F.size("recommendations") > 1
    )


def model_scores(models: DataFrame, test_popularity: Column, today: Column) -> DataFrame:
    """Scores of model versions from their metadata and the mean popularity of test plays.

    ``models``: model_name, version, model_type, training_data_days, n_components,
    training_timestamp.
    """
    age = F.datediff(today, F.to_date("training_timestamp"))
    kind = F.coalesce("model_type", F.lit(""))
    alignment = (
        F.when(kind.contains("collaborative"), 1 - F.abs(F.col("_popularity") - 50) / 50)
        .when(kind.contains("content"), 0.8)
        .otherwise(0.6)
    )
    scored = models.withColumn("_popularity", test_popularity).withColumns(
        {
            "coverage_score": F.least(
                F.coalesce("training_data_days", F.lit(180)) / 180, F.lit(1.0)
            ),
            "diversity_score": F.least(F.coalesce("n_components", F.lit(20)) / 30, F.lit(1.0)),
            "freshness_score": F.when(
                F.col("training_timestamp").isNotNull(), F.greatest(F.lit(0.0), 1 - age / 30)
            ).otherwise(0.0),
            "popularity_alignment": alignment,
        }
    )
    return scored.drop("_popularity").withColumn(
        "overall_score",
        F.col("coverage_score") * 0.3
        + F.col("diversity_score") * 0.25
        + F.col("freshness_score") * 0.25
        + F.col("popularity_alignment") * 0.2,
    )


def compare_models(
    scored: DataFrame, model_a: tuple[str, str], model_b: tuple[str, str]
) -> DataFrame:
    """Winner and confidence of two models, each a (name, version), out of ``model_scores``.

    One row, or none if a model is missing; a model that is listed twice is an error.
    """

    def is_model(model: tuple[str, str]) -> Column:
        return (F.col("model_name") == model[0]) & (F.col("version") == model[1])

    def score(model: tuple[str, str]) -> Column:
        twice = F.raise_error(F.lit(f"model {model[0]} {model[1]} is listed more than once"))
        return F.when(F.count_if(is_model(model)) > 1, twice.cast("double")).otherwise(
            F.max(F.when(is_model(model), F.col("overall_score")))
        )

    sides = scored.filter(is_model(model_a) | is_model(model_b)).agg(
        score(model_a).alias("model_a_score"), score(model_b).alias("model_b_score")
    )
    confidence = F.abs(F.col("model_a_score") - F.col("model_b_score"))
    first = F.col("model_a_score") > F.col("model_b_score")
    return sides.dropna().select(
        *[
            F.lit(text).alias(f"{side}_{part}")
            for side, model in (("model_a", model_a), ("model_b", model_b))
            for part, text in zip(("name", "version"), model, strict=True)
        ],
        "model_a_score",
        "model_b_score",
        F.when(first, "model_a").otherwise("model_b").alias("winner"),
        confidence.alias("confidence"),
        (confidence > 0.05).alias("significant"),
        F.when(confidence > 0.05, "deploy_winner").otherwise("continue_testing").alias(
            "recommendation"
        ),
    )
