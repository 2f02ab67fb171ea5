"""Line-delimited JSON: strict scan, filter job, append sink."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weakspot import fixed_values as fixed
from weakspot.functions.responses import field, kind
from weakspot.functions.text import pinned, strip


def with_problems(lines: DataFrame, raw: str = "raw") -> DataFrame:
    """Drop blank lines, parse the rest into ``row`` and say in ``problem`` what is wrong."""
    written = lines.filter(strip(F.col(raw)) != "")
    # parsed once, whatever checks and fields are read from it
    return pinned(written, "row", F.try_parse_json(F.col(raw))).withColumn(
        "problem",
        F.when(F.col("row").isNull(), F.lit("not JSON")).when(
            ~F.startswith(kind(F.col("row")), F.lit("OBJECT")), F.lit("not an object")
        ),
    )


def with_id_problems(scanned: DataFrame, key: str = "task_id") -> DataFrame:
    """Rows whose id is missing or no whole number have a problem, too."""
    value = field(F.col("row"), key)
    wrong = F.when(value.isNull(), F.lit(f"{key} is missing")).when(
        ~F.startswith(kind(value), F.lit("BIGINT")), F.lit(f"{key} is no whole number")
    )
    return scanned.withColumn("problem", F.coalesce("problem", wrong))


def scan(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Lines of JSONL files with their file and parse problem.

    A split file has no global line numbers; the file and the raw line identify
    a bad row instead.
    """
    reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    lines = reader.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("value").alias("raw")
    )
    return with_problems(lines)


def good_rows(scanned: DataFrame) -> DataFrame:
    return scanned.filter(F.col("problem").isNull())


def quarantined(scanned: DataFrame) -> DataFrame:
    return scanned.filter(F.col("problem").isNotNull()).select("file", "raw", "problem")


def strict_rows(scanned: DataFrame) -> DataFrame:
    """The scan with every bad line turned into an error when it is read.

    The checked line and its parsed row come out of a one-element generator: whatever
    is selected, counted or filtered by their fields, the check is made first.
    """
    message = F.concat(F.lit("bad row in "), F.col("file"), F.lit(": "), F.col("problem"), F.lit(": "), F.col("raw"))
    checked = F.when(F.col("problem").isNull(), F.struct("raw", "row")).otherwise(
        F.raise_error(message).cast("struct<raw: string, row: variant>")
    )
    others = [c for c in scanned.columns if c not in ("raw", "row")]
    return scanned.select(*others, F.inline(F.array(checked)))


def read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Strict typed read."""
    return typed(strict_rows(scan(spark, path)), schema)


def typed(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows of JSON text as columns."""
    return rows.select(F.from_json("raw", schema).alias("r")).select("r.*")


def read_log(spark: SparkSession, path: str, schema: T.StructType, key: str = "task_id") -> DataFrame:
    """Strict typed read of a log in which every row names its task."""
    return typed(strict_rows(with_id_problems(scan(spark, path), key)), schema)


def is_zero(value: Column) -> Column:
    """Numeric zero, also as a float or ``false``; text and null are not."""
    return F.coalesce(
        F.when(F.startswith(kind(value), F.lit("BOOLEAN")), ~F.try_variant_get(value, "$", "boolean"))
        .when(
            kind(value).rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"),
            F.try_variant_get(value, "$", "double") == 0,
        ),
        F.lit(False),
    )


def is_one(value: Column) -> Column:
    """Numeric one, also as a float or ``true``."""
    return F.coalesce(
        F.when(F.startswith(kind(value), F.lit("BOOLEAN")), F.try_variant_get(value, "$", "boolean"))
        .when(
            kind(value).rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"),
            F.try_variant_get(value, "$", "double") == 1,
        ),
        F.lit(False),
    )


def failed_rows(rows: DataFrame) -> DataFrame:
    """Rows whose ``pass_at_1`` is numeric zero."""
    return rows.filter(is_zero(field(F.col("row"), "pass_at_1")))


def filter_stats(rows: DataFrame, by: str = "file") -> DataFrame:
    """Rows and kept rows per file, counted in one pass."""
    return rows.groupBy(by).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(is_zero(field(F.col("row"), "pass_at_1"))).alias("kept_rows"),
    )


def filter_directory(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Write the failed rows of every JSONL file to ``target``; return the counts per file.

    Own earlier outputs are skipped.  Sources are never rewritten.
    """
    scanned = scan(spark, source, glob="*.jsonl")
    ours = F.endswith(F.col("file"), F.lit(fixed.FILTERED_SUFFIX))
    rows = strict_rows(scanned.filter(~ours))
    kept = failed_rows(rows).withColumn("source_file", F.regexp_extract("file", r"([^/]+)\.jsonl$", 1))
    kept.select("raw", "source_file").write.mode("overwrite").partitionBy("source_file").text(target)
    return filter_stats(rows)


def append(df: DataFrame, path: str) -> None:
    """Append rows as JSON lines; folders are made as needed."""
    df.write.mode("append").option("ignoreNullFields", "false").json(path)
