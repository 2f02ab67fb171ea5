"""Word rules, row identity and table steps that the corpus operators share."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# between words stand runs of these; upper-case ASCII letters are lowered before
WORD_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: UTF-8 bytes to word bytes: A-Z lowered, everything between words a blank
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def lowered(text: Column) -> Column:
    """A-Z in lower case and no other letter; plain ASCII texts take the fast way."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def words(text: Column) -> Column:
    """Words of a text as an array; none for null."""
    return F.array_remove(F.split(lowered(F.coalesce(text, F.lit(""))), WORD_BREAK), "")


def word_list(text: str | None) -> list[bytes]:
    """The same words within a task, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_names(df: DataFrame, taken: list[str]) -> dict[str, str]:
    """Names for helper columns that clash with no column of the table."""
    used = {c.lower() for c in df.columns}
    names = {}
    for name in taken:
        free = f"_{name}"
        while free.lower() in used:
            free = f"_{free}"
        used.add(free.lower())
        names[name] = free
    return names


def draw_of(*columns: Column) -> Column:
    """A number below 2^40 by a hash of columns."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 40))


def fraction_of(column: Column, share: float) -> Column:
    """Whether a row falls into a share of all rows, by a hash of a column."""
    return draw_of(column) < F.lit(int(share * (1 << 40)))


def row_key(doc_id: Column, text: Column) -> Column:
    """What samples are drawn by: null and repeated ids differ by their texts."""
    return F.struct(doc_id, F.xxhash64(text))


def held(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is worked out once, however often it is used.

    The one-element explode keeps the optimizer from writing the expression into each
    use, lambdas included.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def shared_folder(spark: SparkSession) -> str:
    """The folder that the session names for checkpoints.

    Only a session on one machine that names none gets one beside its warehouse.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.match(r"local($|\[)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"


def checkpoints(spark: SparkSession) -> None:
    """See that checkpoints go to the shared folder."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def written(df: DataFrame) -> tuple[DataFrame, str]:
    """Write a table to the shared folder and read it back."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def removed(spark: SparkSession, path: str) -> None:
    """Take a table out of the shared folder again."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def pinned(df: DataFrame) -> DataFrame:
    """Cut lineage: computed once, kept in the shared folder, lost executors or not."""
    checkpoints(df.sparkSession)
    return df.checkpoint()


def room_for(df: DataFrame, results: list[str]) -> DataFrame:
    """Move columns that bear the name of a result column aside.

    The rule of all operators: the result has its name, and a column of the table that
    is called so stays under that name with as many underscores in front as it takes.
    """
    taken = {c.lower() for c in df.columns} | {r.lower() for r in results}
    wanted, renamed = {r.lower() for r in results}, {}
    for name in df.columns:
        if name.lower() in wanted:
            free = f"_{name}"
            while free.lower() in taken:
                free = f"_{free}"
            taken.add(free.lower())
            renamed[name] = free
    return df.withColumnsRenamed(renamed)


def smallest(rows: DataFrame, draw: str, most: int) -> DataFrame:
    """At most `most` rows, of distinct draws, with the smallest draws (`draw_of`).

    Draws are counted by ranges first, so that only about as many rows as are wanted
    leave the tasks, however many tasks there are.  Rows of equal draw count once.
    """
    span = F.shiftright(F.col(draw), 28)
    sizes = {
        row.span: row.n for row in rows.select(draw).distinct().groupBy(span.alias("span")).agg(F.count("*").alias("n")).collect()  # at most 4,096
    }
    beyond, taken = 0, 0
    for place in sorted(sizes):
        if taken >= most:
            break
        beyond, taken = place + 1, taken + sizes[place]
    others = [c for c in rows.columns if c != draw]
    once = rows.filter(span < beyond).groupBy(draw).agg(F.min(F.struct(*others)).alias("_rest"))
    return once.orderBy(draw).limit(most).select(draw, "_rest.*")
