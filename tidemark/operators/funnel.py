"""Curriculum funnel and coaching priorities from a long checklist.

Input rows are ``learner, track, help, day, task_seq, task, done``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import texts
from tidemark.operators.ordering import number_rows


@dataclass(frozen=True)
class CoachWeights:
    unfinished: float = 50
    late_unfinished: float = 20
    asked_help: float = 30


def funnel(checklist: DataFrame) -> DataFrame:
    """Per task in order: who finished, the rate, the change from the task before,
    and whether it is a hot spot (the lowest rate). The tasks of a curriculum, a row each
    by then, go through one task of Spark; learners and their marks do not."""
    counts = checklist.groupBy("task_seq", "day", "task").agg(
        F.count_if("done").alias("done"), F.count("*").alias("learners")
    ).withColumn("rate", F.col("done") / F.col("learners"))
    in_order = Window.orderBy("task_seq", "day", "task")
    lowest = F.min("rate").over(in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return counts.select(
        "task_seq", "day", "task", "done", "learners", "rate",
        F.coalesce(F.col("done") - F.lag("done").over(in_order), F.lit(0)).alias("change"),
        (F.col("rate") == lowest).alias("hot_spot"),
    ).orderBy("task_seq")


def bottom_tasks(tasks: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` funnel tasks with the lowest rate, earlier tasks first among equals."""
    return tasks.orderBy("rate", "task_seq").limit(k)


def coach_score(
    checklist: DataFrame, late_day: str = "day2", weights: CoachWeights = CoachWeights()
) -> DataFrame:
    """Progress and risk score per learner."""
    late = F.col("day") == late_day
    done = F.count_if("done")
    per_learner = checklist.groupBy("learner", "track").agg(
        F.max(F.coalesce("help", F.lit(False))).alias("help"),
        F.count_if(~late & F.col("done")).alias("day1_done"),
        F.count_if(late & F.col("done")).alias("day2_done"),
        done.alias("done"),
        F.count("*").alias("_tasks"),
        F.count_if(late).alias("_late_tasks"),
    )
    open_share = 1 - F.col("done") / F.col("_tasks")
    late_share = F.coalesce(1 - F.col("day2_done") / F.nullif(F.col("_late_tasks"), F.lit(0)), F.lit(0.0))
    risk = (
        weights.unfinished * open_share
        + weights.late_unfinished * late_share
        + weights.asked_help * F.col("help").cast("int")
    )
    return per_learner.withColumns({
        "progress_pct": F.col("done") / F.col("_tasks") * 100,
        "risk": F.round(risk, 1),
        "finished": F.col("done") == F.col("_tasks"),
    }).drop("_tasks", "_late_tasks")


def coach_grade(scored: DataFrame, hi: float = 40, mid: float = 20) -> DataFrame:
    """Add the coaching grade for the risk score."""
    top, watch, fine = texts.GRADES
    return scored.withColumn(
        "grade", F.when(F.col("risk") >= hi, top).when(F.col("risk") >= mid, watch).otherwise(fine)
    )


def coaching_priority(graded: DataFrame) -> DataFrame:
    """Learners, highest risk first, under the list's headings."""
    h = texts.COACHING_HEADINGS
    return graded.orderBy(F.col("risk").desc(), "learner").select(
        *[F.col(name).alias(heading) for name, heading in h.items()]
    )


def coach_names(graded: DataFrame, grade: str = texts.GRADES[0]) -> DataFrame:
    """Names in one grade with their place, highest risk first: one row per learner, whatever their number."""
    chosen = graded.where(F.col("grade") == grade).select("learner", "risk")
    return number_rows(chosen, [F.col("risk").desc(), F.col("learner")], "place").select("place", "learner")


def coach_kpis(graded: DataFrame, tasks: DataFrame) -> DataFrame:
    """Mean progress, learners who finished all, help requests and lowest task rate, as one row."""
    lowest = tasks.agg(F.min("rate")).scalar()
    return graded.agg(
        F.avg("progress_pct").alias("mean_progress_pct"),
        F.count_if("finished").alias("finished_all"),
        F.count_if("help").alias("help_requests"),
    ).withColumn("lowest_task_rate", lowest)
