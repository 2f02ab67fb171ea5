"""Session settings."""

from pyspark.sql import SparkSession

# results do not depend on these; they are what the plans are laid out for
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # checkpoints of RDDs go once nothing refers to them; for written tables see sources.artifacts.scratch
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # plans are built from many small expressions; recording a stack trace for
    # each takes longer than building it
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def configured(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def local_session(cpus: str = "8", memory: str = "8g") -> SparkSession:
    """Session for tests and trial runs on one machine; a cluster brings its own."""
    builder = configured(SparkSession.builder.master(f"local[{cpus}]").appName("weakspot"))
    spark = (
        builder.config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark

