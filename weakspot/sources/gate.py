"""Schema gate: rows with a list of what breaks their schema."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weakspot import fixed_values as fixed
from weakspot.functions.text import strings

VIOLATIONS = "violations"


def key_violations(raw: Column, keys: list[str]) -> Column:
    """Unknown and missing keys of a JSON object."""
    found = F.coalesce(F.json_object_keys(raw), strings([]))
    unknown = F.transform(F.array_except(found, strings(keys)), lambda k: F.concat(F.lit("unknown "), k))
    missing = F.transform(F.array_except(strings(keys), found), lambda k: F.concat(F.lit("missing "), k))
    return F.concat(unknown, missing)


def _flags(checks: dict[str, Column]) -> Column:
    return F.array_compact(
        F.array(*[F.when(F.coalesce(bad, F.lit(True)), F.lit(name)) for name, bad in checks.items()])
    )


def diagnosis_violations() -> Column:
    return _flags({
        "task_id": F.col("task_id").isNull(),
        "fault_type": ~F.col("fault_type").isin(*fixed.FAULT_TYPES),
        "sub_tags": F.col("sub_tags").isNull(),
        "severity": ~F.col("severity").isin(*fixed.SEVERITIES),
        "description": F.col("description").isNull(),
        "evidence": F.expr(
            "evidence.wrong_line IS NULL OR evidence.correct_approach IS NULL OR evidence.failed_test IS NULL"
        ),
        "enriched_labels": F.col("enriched_labels").isNull(),
        "confidence": ~F.col("confidence").between(0.0, 1.0),
        "diagnosis_source": ~F.col("diagnosis_source").isin(*fixed.DIAGNOSIS_SOURCES),
        "prompt_version": F.col("prompt_version").isNull(),
    })


def weakness_violations() -> Column:
    return _flags({
        "rank": F.col("rank").isNull(),
        "fault_type": ~F.col("fault_type").isin(*fixed.FAULT_TYPES),
        "sub_tags": F.col("sub_tags").isNull(),
        "frequency": F.col("frequency").isNull(),
        "sample_task_ids": F.col("sample_task_ids").isNull(),
        "trainability": ~F.col("trainability").between(0.0, 1.0),
        "cluster_coherence": ~F.col("collective_diagnosis.cluster_coherence").between(0.0, 1.0),
    })


def spec_violations() -> Column:
    limits = "problem_spec.constraints"
    return _flags({
        "spec_id": F.col("spec_id").isNull(),
        "fault_type": ~F.col("target_weakness.fault_type").isin(*fixed.FAULT_TYPES),
        "difficulty": ~F.col("problem_spec.difficulty").isin(*fixed.DIFFICULTIES),
        "n_range": F.size(F.col(f"{limits}.n_range")) != 2,
        "value_range": F.size(F.col(f"{limits}.value_range")) != 2,
        "min_test_cases": F.col("verification_spec.min_test_cases") <= 0,
    })


def gate(rows: DataFrame, schema: T.StructType, violations: Column) -> DataFrame:
    """Type the JSON text in ``raw`` and list its key and value violations."""
    names = schema.fieldNames()
    typed = rows.withColumn("_r", F.from_json("raw", schema))
    keys = key_violations(F.col("raw"), names)
    return (
        typed.select("raw", "_r.*")
        .withColumn(VIOLATIONS, F.array_distinct(F.concat(keys, violations)))
    )


def accepted(gated: DataFrame) -> DataFrame:
    return gated.filter(F.size(VIOLATIONS) == 0).drop("raw", VIOLATIONS)


def rejected(gated: DataFrame) -> DataFrame:
    return gated.filter(F.size(VIOLATIONS) > 0)
