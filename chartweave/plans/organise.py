"""What a run leaves behind: every answer with its verdict, and the run's telemetry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartweave.operators.validation import checked_json


def organised(steps: DataFrame, answers: DataFrame, group: str, schemas: dict[str, dict]) -> DataFrame:
    """``(group, recipe, data, answered_by, ok, errors, warnings, steps_that_errored, found)``, a row per answer of ``run_recipes``.

    An answer is ok if it fits its recipe's schema, no step of it failed and every value points at its source.  Errors say which
    of these it was, warnings hold the classes of the steps' errors.  A recipe without a schema is an error before any work.
    """
    if unknown := sorted({r.recipe for r in answers.select("recipe").distinct().collect()} - set(schemas)):
        raise ValueError(f"no output schema for {unknown}")
    judged = None
    for name, schema in schemas.items():
        one = checked_json(answers.where(F.col("recipe") == name), [group, "recipe"], "data", schema)
        judged = one if judged is None else judged.unionByName(one)
    item = lambda c: F.transform(F.sort_array(F.collect_list(F.when(F.col("status") == "failed", F.struct("ord", F.col(c).alias("x"))))), lambda s: s["x"])
    failed = steps.groupBy(group, "recipe").agg(item("step").alias("steps_that_errored"), F.array_compact(item("error")).alias("warnings"))
    j = answers.join(judged, [group, "recipe"]).join(failed, [group, "recipe"], "left")
    broken, unsupported = F.size("steps_that_errored") > 0, F.size("unprovenanced") > 0
    said = F.array_compact(F.array(
        F.when(broken, F.concat(F.lit("steps that failed: "), F.array_join("steps_that_errored", ", "))),
        F.when(unsupported, F.concat(F.lit("no source: "), F.array_join("unprovenanced", ", "))),
    ))
    return j.select(group, "recipe", "data", "answered_by", (F.col("schema_ok") & ~broken & ~unsupported).alias("ok"), F.concat("errors", said).alias("errors"), "warnings", "steps_that_errored", "found")


def telemetry(steps: DataFrame, group: str) -> DataFrame:
    """``(recipe, step, status, groups, calls, input_tokens, rejected)``: what a run cost and how it went, without any text of it."""
    return steps.groupBy("recipe", "step", "status").agg(F.count("*").alias("groups"), F.sum("calls").alias("calls"), F.sum("input_tokens").alias("input_tokens"), F.sum("rejected").alias("rejected"))


def write_run(steps: DataFrame, answers: DataFrame, group: str, schemas: dict[str, dict], folder: str) -> DataFrame:
    """Results by recipe, step records and telemetry as tables of a run's folder; gives the results back as they were written."""
    organised(steps, answers, group, schemas).write.mode("overwrite").partitionBy("recipe").parquet(f"{folder}/results")
    steps.write.mode("overwrite").parquet(f"{folder}/steps")
    telemetry(steps, group).write.mode("overwrite").parquet(f"{folder}/telemetry")
    return answers.sparkSession.read.parquet(f"{folder}/results")
