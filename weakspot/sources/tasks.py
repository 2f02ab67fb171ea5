"""Task tables from merged, real-log and split inputs."""

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weakspot import fixed_values as fixed
from weakspot.functions.responses import field, kind, text_or_empty
from weakspot.functions.text import first, one_of
from weakspot.schemas import TASK
from weakspot.sources import jsonl

MERGED, REAL_LOG, SPLIT = "merged", "real_log", "split"


def first_keys(spark: SparkSession, path: str) -> set[str]:
    """Keys of the first row of an input; reads one row, not the input."""
    rows = jsonl.strict_rows(jsonl.scan(spark, path)).select(F.json_object_keys("raw")).take(1)
    if not rows:
        raise ValueError(f"Input file is empty: {path}")
    return set(rows[0][0])


class Role(NamedTuple):
    """A part of an input, told by keys its first row has and has not all of."""

    name: str
    has: frozenset
    lacks: frozenset = frozenset()

    def fits(self, keys: set[str]) -> bool:
        return self.has <= keys and not (self.lacks and self.lacks <= keys)


_TASK, _INFERENCE = frozenset(fixed.TASK_KEYS), frozenset(fixed.INFERENCE_KEYS)
#: input kinds with the roles their files play; the first that all files fit counts
LAYOUTS = {
    MERGED: [Role("tasks", _TASK)],
    REAL_LOG: [Role("log", frozenset(fixed.REAL_LOG_KEYS))],
    SPLIT: [Role("inference", _INFERENCE, _TASK), Role("results", frozenset(fixed.RESULT_KEYS), _INFERENCE)],
}


def cast(roles: list[Role], keys: dict[str, set[str]]) -> dict[str, str] | None:
    """Role to path, if each role is played by one path and none is left over."""
    players = {role.name: [path for path, found in keys.items() if role.fits(found)] for role in roles}
    if len(keys) != len(roles) or any(len(paths) != 1 for paths in players.values()):
        return None
    return {name: paths[0] for name, paths in players.items()}


def layout_of(keys: dict[str, set[str]]) -> tuple[str, dict[str, str]]:
    """Input kind and who plays which role, from the keys of the first rows."""
    for kind_name, roles in LAYOUTS.items():
        if found := cast(roles, keys):
            return kind_name, found
    wanting = "; ".join(
        f"{path} lacks for {role.name}: {', '.join(sorted(role.has - found)) or 'nothing, but holds more'}"
        for path, found in keys.items() for roles in LAYOUTS.values() for role in roles if not role.fits(found)
    )
    raise ValueError(f"Could not detect the input kind of the given paths ({wanting})")


def detect(spark: SparkSession, paths: list[str]) -> str:
    return layout_of({path: first_keys(spark, path) for path in paths})[0]


def load(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Task table of whatever kind the paths are."""
    found = detect(spark, paths)
    if found == MERGED:
        return load_merged(spark, paths[0])
    if found == REAL_LOG:
        return load_real_log(spark, paths[0])
    return load_split(spark, *paths)


def with_key_problems(scanned: DataFrame, keys: list[str], optional: tuple = ()) -> DataFrame:
    """Rows with unknown or missing keys have a problem, too."""
    found = F.json_object_keys("raw")
    allowed = F.array(*map(F.lit, [*keys, *optional]))
    needed = F.array(*map(F.lit, keys))
    wrong = F.concat(F.array_except(found, allowed), F.array_except(needed, found))
    named = F.when(F.size(wrong) > 0, F.concat(F.lit("unknown or missing key: "), first(wrong)))
    return scanned.withColumn("problem", F.coalesce("problem", named))


def load_merged(spark: SparkSession, path: str) -> DataFrame:
    return jsonl.typed(jsonl.strict_rows(with_key_problems(jsonl.scan(spark, path), fixed.TASK_KEYS)), TASK)


def spaced_json(text: Column) -> Column:
    """Compact JSON text with a space after each separator outside strings."""
    token = r'\G((?:"(?:[^"\\]++|\\.)*+"|[^",:]++)*+)([,:])'
    return F.regexp_replace(text, token, "$1$2 ")


def harness_text(test: Column, test_json: Column) -> Column:
    """Harness code of a ``test`` value given as variant and as JSON text.

    Objects carry it under ``code`` (text, or JSON kept as text), plain text is
    the code itself, anything else empty counts as no harness.
    """
    code = field(test, "code")
    code_json = F.get_json_object(test_json, "$.code")
    is_a = lambda value, name: F.startswith(kind(value), F.lit(name))
    empty = test.isNull() | test_json.isin("", "[]", "0", "0.0", "false") | is_a(test, "VOID")
    return (
        F.when(empty, F.lit(""))
        .when(
            is_a(test, "OBJECT"),
            F.when(code.isNull(), F.lit(""))
            .when(is_a(code, "STRING"), F.try_variant_get(code, "$", "string"))
            .when(is_a(code, "VOID"), F.lit("null"))
            .otherwise(spaced_json(code_json)),
        )
        .when(is_a(test, "STRING"), F.try_variant_get(test, "$", "string"))
        .otherwise(spaced_json(test_json))
    )


def kept_labels(labels_json: Column) -> Column:
    """Labels without the housekeeping keys; anything but an object has none."""
    labels = F.from_json(labels_json, "map<string,string>")
    return F.coalesce(
        F.map_filter(labels, lambda k, _: ~one_of(k, fixed.HOUSEKEEPING_LABELS)),
        F.create_map().cast("map<string,string>"),
    )


def real_log_tasks(rows: DataFrame) -> DataFrame:
    """Task table from parsed real-log rows (columns ``raw`` and ``row``)."""
    row = F.col("row")
    parts = F.from_json("raw", "labels STRING, model STRING, test STRING")
    return rows.withColumn("_p", parts).select(
        field(row, "id", "bigint").alias("task_id"),
        *[text_or_empty(field(row, name)).alias(name)
          for name in ["content", "canonical_solution", "completion"]],
        harness_text(field(row, "test"), F.col("_p.test")).alias("test_code"),
        kept_labels(F.col("_p.labels")).alias("labels"),
        jsonl.is_one(field(row, "pass_at_1")).alias("accepted"),
        F.lit("{}").alias("metrics"),
        F.to_json(F.struct(F.col("_p.model").alias("model")), {"ignoreNullFields": "false"}).alias("extra"),
    )


def with_log_problems(scanned: DataFrame) -> DataFrame:
    """Real-log rows without an id that reads as a whole number have a problem, too."""
    value = field(F.col("row"), "id")
    wrong = F.when(value.isNull(), F.lit("id is missing")).when(
        F.try_variant_get(value, "$", "bigint").isNull(), F.lit("id is no whole number")
    )
    return scanned.withColumn("problem", F.coalesce("problem", wrong))


def load_real_log(spark: SparkSession, path: str) -> DataFrame:
    return real_log_tasks(jsonl.strict_rows(with_log_problems(jsonl.scan(spark, path))))


def split_issues(inference: DataFrame, results: DataFrame, key: str = "task_id") -> DataFrame:
    """Ids that break the pairing: duplicate, missing and extra results.

    One full outer join of the ids with the per-id result counts finds all three.
    """
    left = inference.select(key).distinct().withColumn("_i", F.lit(True))
    right = results.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    issue = (
        F.when(F.col("_n") > 1, F.lit("duplicate_result"))
        .when(F.col("_n").isNull(), F.lit("missing_result"))
        .when(F.col("_i").isNull(), F.lit("extra_result"))
    )
    return (
        left.join(right, key, "full_outer").select(key, issue.alias("issue"))
        .filter(F.col("issue").isNotNull())
    )


def join_results(inference: DataFrame, results: DataFrame, key: str = "task_id") -> DataFrame:
    """Pair the two sides; fields of the results win."""
    overlap = [c for c in inference.columns if c in results.columns and c != key]
    return inference.drop(*overlap).join(results, key, "inner")


def check_split(inference: DataFrame, results: DataFrame) -> None:
    """Raise on the first issue: duplicates, then missing, then the smallest extra id."""
    messages = {
        "duplicate_result": "Duplicate result row for task_id",
        "missing_result": "Missing result row for task_id",
        "extra_result": "Extra result row for task_id",
    }
    found = {
        row["issue"]: row["task_id"]
        for row in split_issues(inference, results).groupBy("issue").agg(F.min("task_id").alias("task_id")).collect()
    }
    for issue, message in messages.items():
        if issue in found:
            raise ValueError(f"{message} {found[issue]}")


def load_split(spark: SparkSession, first_path: str, second_path: str) -> DataFrame:
    paths = [first_path, second_path]
    if "accepted" in first_keys(spark, first_path):
        paths.reverse()
    fields = {f.name: f for f in TASK.fields}
    sides = []
    for path, keys in zip(paths, [fixed.INFERENCE_KEYS, fixed.RESULT_KEYS]):
        rows = jsonl.strict_rows(with_key_problems(jsonl.scan(spark, path), keys))
        schema = type(TASK)([fields[k] for k in keys])
        sides.append(jsonl.typed(rows, schema))
    check_split(*sides)
    return join_results(*sides).select(*TASK.fieldNames())


def duplicate_ids(tasks: DataFrame, key: str = "task_id") -> DataFrame:
    return (
        tasks.groupBy(key).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)
    )


def check_unique(tasks: DataFrame) -> None:
    twice = duplicate_ids(tasks).agg(F.min("task_id")).first()[0]
    if twice is not None:
        raise ValueError(f"Duplicate task_id in input tasks: {twice}")


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)
