"""Token budgets: shortening of task texts."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weakspot import fixed_values as fixed
from weakspot.functions.text import join_tokens, let, token_count, tokens


def shorten_middle(text: Column, limit: int) -> Column:
    """Keep the head and the tail around ``...``; unchanged when short enough."""
    head = limit // 2
    tail = limit - head
    return let(
        tokens(text),
        lambda t: F.when(F.size(t) <= limit, text).otherwise(
            join_tokens(
                F.concat(F.slice(t, 1, head), F.array(F.lit("...")), F.slice(t, -tail, tail))
            )
        ),
    )


def shorten_around_marker(text: Column, limit: int) -> Column:
    """Keep a third (rounded up) before the insertion marker, the rest from it on."""
    before = -(-limit // 3)
    at = F.instr(text, fixed.INSERT_MARKER)
    prefix = tokens(F.substring(text, F.lit(1), at - 1))
    suffix = tokens(F.substring(text, at, F.length(text)))

    def cut(t):
        start = F.greatest(F.size(t) - before, F.lit(0))
        return F.slice(t, start + 1, F.lit(before))

    kept = let(
        cut(prefix),
        lambda p: F.concat(p, F.slice(suffix, F.lit(1), F.lit(limit) - F.size(p))),
    )
    return F.when(at == 0, shorten_middle(text, limit)).otherwise(join_tokens(kept))


def keep_head(text: Column, limit: Column) -> Column:
    """First ``limit`` tokens; empty for a limit of 0."""
    return let(
        tokens(text),
        lambda t: F.when(limit <= 0, F.lit(""))
        .when(F.size(t) <= limit, text)
        .otherwise(join_tokens(F.slice(t, F.lit(1), F.greatest(limit, F.lit(1))))),
    )


def staged_budget(tasks: DataFrame, max_tokens: int) -> DataFrame:
    """Fit each task into ``max_tokens`` step by step.

    The solution goes first, then the tests, the completion and the prompt are
    shortened, each only while the total is still too large.  Token counts are
    carried along, so every text is counted once and recounted only when cut.
    """
    texts = ["content", "completion", "canonical_solution", "test_code"]
    df = tasks.withColumns({f"n_{t}": token_count(F.col(t)) for t in texts})
    total = sum((F.col(f"n_{t}") for t in texts[1:]), F.col("n_content"))

    def stage(df, name, shortened, flag):
        cut = (total > max_tokens) & (F.col(name) != "")
        df = df.withColumn("_cut", cut)
        df = df.withColumn(name, F.when(F.col("_cut"), shortened).otherwise(F.col(name)))
        changed = {f"n_{name}": F.when(F.col("_cut"), token_count(F.col(name))).otherwise(F.col(f"n_{name}"))}
        if flag:
            changed[f"{name}_truncated"] = F.col("_cut")
        return df.withColumns(changed)

    quarter = max(40, max_tokens // 4)
    third = max(80, max_tokens // 3)
    df = stage(df, "canonical_solution", F.lit(""), True)
    df = stage(df, "test_code", shorten_around_marker(F.col("test_code"), quarter), True)
    df = stage(df, "completion", shorten_middle(F.col("completion"), third), True)
    df = stage(df, "content", shorten_middle(F.col("content"), third), False)
    return df.drop("_cut", *[f"n_{t}" for t in texts])


def proportional_budget(tasks: DataFrame, max_tokens: int) -> DataFrame:
    """Keep the prompt whole; take the overflow from the tests, then the solution."""
    df = tasks.withColumns(
        {
            "_c": token_count(F.col("content")),
            "_t": token_count(F.col("test_code")),
            "_s": token_count(F.col("canonical_solution")),
        }
    )
    overflow = F.col("_c") + F.col("_t") + F.col("_s") - max_tokens
    keep_tests = F.greatest(F.col("_t") - overflow, F.lit(0))
    rest = F.greatest(overflow - F.col("_t"), F.lit(0))
    keep_solution = F.greatest(F.col("_s") - rest, F.lit(0))
    full = F.col("_c") >= max_tokens
    fits = overflow <= 0

    def cut(name, keep):
        text = F.col(name)
        return F.when(full, F.lit("")).when(fits, text).otherwise(keep_head(text, keep))

    return df.withColumns(
        {
            "test_code": cut("test_code", keep_tests),
            "canonical_solution": cut("canonical_solution", keep_solution),
        }
    ).drop("_c", "_t", "_s")
