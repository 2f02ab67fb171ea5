"""Rule tables and text screening.

A rule set is configuration: a short list whose patterns become literals of the
plan, so Spark compiles each pattern once per task and screens texts without a
join or a shuffle.
"""

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weakspot import fixed_values as fixed
from weakspot.functions.text import contains_any, matches, pinned, quoted

RULE_TYPE = "struct<rule_id:string,fault_type:string,sub_tag:string,severity:string,priority:int>"


class Rule(NamedTuple):
    """A screening rule.

    ``hints`` are lower-case words of which every match contains at least one;
    a text without any of them is not searched with the pattern.
    """

    rule_id: str
    pattern: str
    fault_type: str
    sub_tag: str
    severity: str
    priority: int
    hints: tuple = ()


# every alternative of a built-in pattern contains one of its rule's words
HINTS = {
    "R007": ("timeout", "timed", "exceeded", "tle"),
    "R006": ("recursion", "overflow"),
    "R009": ("error:", "symbol", "expected", "undefined", "compil", "javac", "g++", "gcc", "go:"),
    "R001": ("syntaxerror", "taberror", "indent", "invalid"),
    "R002": ("nameerror", "defined", "cannot"),
    "R003": ("importerror", "module", "package"),
    "R004": ("typeerror:", "argument"),
    "R008": ("output", "return", "nonetype"),
    "R012": ("zero", "domain"),
    "R005": ("index", "keyerror", "found", "nosuchelement"),
    "R011": ("format", "presentation"),
    "R010": ("assert",),
}
# letters outside ASCII that ignoring case makes equal to one inside it
FOLDED = {"\u017f": "s", "\u212a": "k", "\u0131": "i", "\u0130": "i"}


def default_rules() -> list[Rule]:
    return [
        Rule(*row, priority, HINTS.get(row[0], ()))
        for priority, row in enumerate(fixed.RULES, start=1)
    ]


RULE_COLUMNS = "rule_id string, pattern string, fault_type string, sub_tag string, severity string, priority int"


def rules_table(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    return spark.createDataFrame([r[:6] for r in rules], RULE_COLUMNS)


def _twice(named: DataFrame) -> DataFrame:
    """Names that stand more than once, at their second place."""
    places = named.groupBy("name").agg(F.sort_array(F.collect_list("at")).alias("places"))
    return places.filter(F.size("places") > 1).select("name", F.col("places")[1].alias("at"))


def problems(custom: DataFrame, order: DataFrame, known: DataFrame) -> DataFrame:
    """(step, at, message) of everything wrong with custom names and the explicit order.

    ``custom`` and ``order`` are (name, at), ``known`` holds the ids in force.
    """
    built_in = F.broadcast(rules_table(custom.sparkSession, default_rules()).select(F.col("rule_id").alias("name")))
    found = [
        (0, 0, "custom rule name must not be empty", custom.filter("name = ''")),
        (0, 1, "duplicate custom rule name: %s", _twice(custom.filter("name <> ''"))),
        (0, 2, "custom rule name collides with built-in rule ID: %s", custom.join(built_in, "name", "left_semi")),
        (1, 0, "duplicate rule_priority ID: %s", _twice(order)),
        (2, 0, "unknown rule_priority ID: %s", order.join(known.select(F.col("rule_id").alias("name")), "name", "left_anti")),
    ]
    tables = [
        rows.select(F.lit(step).alias("step"), "at", F.lit(turn).alias("turn"), F.format_string(text, *(["name"] if "%s" in text else [])).alias("message"))
        for step, turn, text, rows in found
    ]
    return reduce(DataFrame.unionByName, tables)


def compose_rules(
    custom: list[dict] = (), disabled: list[str] = (), severities: dict[str, str] | None = None,
    order: list[str] = (),
) -> list[Rule]:
    """Defaults minus the disabled ones plus custom ones, re-ordered and renumbered.

    ``severities`` overrides by tag and by rule id, the id winning; ``order``
    lists rule ids that come first.  Rules are configuration, so their table is small.
    """
    spark = SparkSession.active()
    first_free = fixed.CUSTOM_RULE_BASE_PRIORITY + 1
    names = spark.createDataFrame(list(enumerate((c["name"].strip() for c in custom))), "at int, name string").select("name", "at")
    wanted = spark.createDataFrame(list(enumerate(order)), "at int, name string").select("name", "at")
    extra = [
        Rule(c["name"].strip(), c["pattern"], c["fault_type"], c["sub_tag"], c["severity"], first_free + at)
        for at, c in enumerate(custom)
    ]
    built_in = default_rules()
    table = rules_table(spark, built_in).unionByName(rules_table(spark, extra))
    active = table.filter(~F.col("rule_id").isin(list(disabled))) if disabled else table
    worst = problems(names, wanted, active).orderBy("step", "at", "turn").first()
    if worst:
        raise ValueError(worst.message)
    overrides = F.create_map(*[F.lit(x) for pair in (severities or {}).items() for x in pair]) if severities else F.lit(None).cast("map<string,string>")
    placed = active.join(wanted.select(F.col("name").alias("rule_id"), F.col("at").alias("place")), "rule_id", "left")
    turn = Window.orderBy(F.col("place").asc_nulls_last(), "priority", "rule_id")
    composed = placed.select(
        "rule_id", "pattern", "fault_type", "sub_tag",
        F.coalesce(F.try_element_at(overrides, "rule_id"), F.try_element_at(overrides, "sub_tag"), "severity").alias("severity"),
        F.row_number().over(turn).alias("number"),
    )
    hints = {r.rule_id: r.hints for r in built_in}
    rows = composed.orderBy("number").collect()
    return [Rule(*row, hints.get(row.rule_id, ())) for row in rows]


def _in_order(rules: list[Rule]) -> list[Rule]:
    return sorted(rules, key=lambda r: (r.priority, r.rule_id))


def folded(text: Column) -> Column:
    """Lower case in the sense of the patterns, which ignore case for all letters."""
    special = contains_any(text, FOLDED)
    plain = F.translate(text, "".join(FOLDED), "".join(FOLDED.values()))
    return F.lower(F.when(special, plain).otherwise(text))


def _hit(text: Column, words: Column, rule: Rule) -> Column:
    """The pattern matches; texts without a hint are passed over by a plain search."""
    found = matches(text, rule.pattern, "im")
    return contains_any(words, rule.hints) & found if rule.hints else found


def _literal(rule: Rule) -> Column:
    return F.expr(
        f"named_struct('rule_id', {quoted(rule.rule_id)}, 'fault_type', {quoted(rule.fault_type)}, "
        f"'sub_tag', {quoted(rule.sub_tag)}, 'severity', {quoted(rule.severity)}, 'priority', {rule.priority})"
    )


def with_first_hit(texts: DataFrame, text: str, rules: list[Rule] | None = None) -> DataFrame:
    """Add ``rule``: the struct of the first rule that matches, null when none does.

    The branches are lazy, so later patterns are not tried after a hit.
    """
    rules = _in_order(default_rules() if rules is None else rules)
    if not rules:
        return texts.withColumn("rule", F.lit(None).cast(RULE_TYPE))
    chain = F
    for rule in rules:
        chain = chain.when(_hit(F.col(text), F.col("_words"), rule), _literal(rule))
    hinted = texts.withColumn("_words", folded(F.col(text)))
    return pinned(hinted, "rule", chain.otherwise(F.lit(None).cast(RULE_TYPE))).drop("_words")


def hits(texts: DataFrame, text: str, rules: list[Rule] | None = None) -> DataFrame:
    """One row per text and matching rule, in rule order: the audit form of the screen.

    The rules ride along as literals, so this is a projection and an explode
    instead of a join of every text with every rule.
    """
    rules = _in_order(default_rules() if rules is None else rules)
    matching = F.array_compact(
        F.array(*[F.when(_hit(F.col(text), F.col("_words"), r), _literal(r)) for r in rules])
    )
    hinted = texts.withColumn("_words", folded(F.col(text)))
    return hinted.select(*texts.columns, F.explode(matching).alias("rule")).select(*texts.columns, "rule.*")
