"""Schema gate over JSON text at every depth, each violation named by its path.

The walk follows a StructType.  It tells apart

- ``unknown p``: a key that the schema has not, at any depth
- ``missing p``: a key of the schema that isn't there
- ``type p``: another kind of JSON value; null is none, whole numbers count as doubles
- ``value p``: a value of the right type that a rule refuses

with ``p`` like ``problem_spec.constraints.n_range[1]``.  Below a missing or mistyped
value nothing more is told.  Text that is no JSON object has the one violation
``type $``.  Numbers written as strings are no numbers.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weakspot import fixed_values as fixed
from weakspot.functions.text import strings
from weakspot.sources.gate import VIOLATIONS

# a rule takes the typed value and says whether it is fine
Rule = Callable[[Column], Column]
Rules = dict[str, Rule]

_KINDS = {T.StringType: "STRING", T.BooleanType: "BOOLEAN", T.LongType: "BIGINT", T.IntegerType: "BIGINT"}


def one_of(values) -> Rule:
    return lambda x: x.isin(*values)


def share(x: Column) -> Column:
    return x.between(0.0, 1.0)


def pair(x: Column) -> Column:
    return F.size(x) == 2


DIAGNOSIS_RULES: Rules = {
    "fault_type": one_of(fixed.FAULT_TYPES), "severity": one_of(fixed.SEVERITIES), "confidence": share,
    "diagnosis_source": one_of(fixed.DIAGNOSIS_SOURCES),
}
WEAKNESS_RULES: Rules = {
    "fault_type": one_of(fixed.FAULT_TYPES), "trainability": share, "collective_diagnosis.cluster_coherence": share,
}
REPORT_RULES: Rules = {f"weaknesses[].{path}": rule for path, rule in WEAKNESS_RULES.items()}
SPEC_RULES: Rules = {
    "target_weakness.fault_type": one_of(fixed.FAULT_TYPES), "problem_spec.difficulty": one_of(fixed.DIFFICULTIES),
    "problem_spec.constraints.n_range": pair, "problem_spec.constraints.value_range": pair,
    "verification_spec.min_test_cases": lambda x: x > 0,
}


def _fits(value: Column, kind: T.DataType) -> Column:
    """Whether a variant that isn't null holds the kind of JSON value that a type without parts asks for."""
    found = F.schema_of_variant(value)
    if isinstance(kind, T.DoubleType):
        return found.rlike(r"^(BIGINT|DOUBLE|FLOAT|DECIMAL\(.*)$")
    right = found == _KINDS[type(kind)]
    # beyond its range a number has no value
    return right & F.try_variant_get(value, "$", "int").isNotNull() if isinstance(kind, T.IntegerType) else right


def _one(problem: str, path: Column) -> Column:
    return F.array(_told(problem, path))


def _told(problem: str, path: Column) -> Column:
    return F.concat(F.lit(f"{problem} "), path)


def _once(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is worked out once, however often `body` uses it."""
    return F.get(F.transform(F.array(value), body), 0)


def _below(path: Column, name: Column, top: bool) -> Column:
    return name if top else F.concat(path, F.lit("."), name)


def _has_parts(kind: T.DataType) -> bool:
    return isinstance(kind, (T.StructType, T.ArrayType, T.MapType))


def _refused(value: Column, kind: T.DataType, place: str, rules: Rules) -> Column:
    """Whether a rule refuses a variant of the right kind; a value whose parts can't be typed is told of by its parts."""
    return ~rules[place](F.try_variant_get(value, "$", kind.simpleString()))


def _walk(value: Column, kind: T.DataType, path: Column, place: str, rules: Rules) -> Column:
    """Violations of a variant: `path` names it in messages, `place` in the rules."""
    if not _has_parts(kind):
        return F.array_compact(F.array(_leaf(value, kind, path, place, rules)))
    if place not in rules:
        return _parts(value, kind, path, place, rules)
    return _once(value, lambda v: F.concat(
        _parts(v, kind, path, place, rules), F.when(_refused(v, kind, place, rules), _one("value", path)).otherwise(strings([]))
    ))


def _leaf(value: Column, kind: T.DataType, path: Column, place: str, rules: Rules) -> Column:
    """The violation of a value without parts, or null."""
    def told(v: Column) -> Column:
        wrong = F.when(~F.coalesce(_fits(v, kind), F.lit(False)), _told("type", path))
        return wrong.when(_refused(v, kind, place, rules), _told("value", path)) if place in rules else wrong

    return _once(value, told) if place in rules or isinstance(kind, T.IntegerType) else told(value)


def _parts(value: Column, kind: T.DataType, path: Column, place: str, rules: Rules) -> Column:
    """Violations of a variant with parts: they are taken out once, and only a value of the right kind has them."""
    held = F.try_variant_get(value, "$", "array<variant>" if isinstance(kind, T.ArrayType) else "map<string,variant>")
    return _once(held, lambda parts: F.when(parts.isNull(), _one("type", path)).otherwise(_inside(parts, kind, path, place, rules)))


def _inside(parts: Column, kind: T.DataType, path: Column, place: str, rules: Rules) -> Column:
    """Violations of the parts of a variant, an array or a map of variants."""
    top = not place
    if isinstance(kind, T.ArrayType):
        return F.flatten(F.transform(parts, lambda x, i: _walk(
            x, kind.elementType, F.concat(path, F.lit("["), i.cast("string"), F.lit("]")), f"{place}[]", rules
        )))
    if isinstance(kind, T.MapType):
        return F.flatten(F.transform(F.map_entries(parts), lambda e: _walk(
            e["value"], kind.valueType, _below(path, e["key"], top), f"{place}{{}}", rules
        )))
    unknown = F.array_except(F.map_keys(parts), strings(kind.fieldNames()))
    leaves, found = [], [F.transform(unknown, lambda k: F.concat(F.lit("unknown "), _below(path, k, top)))]
    for field in kind.fields:
        # null for a key that isn't there; null in JSON is a variant
        there, named = F.try_element_at(parts, F.lit(field.name)), _below(path, F.lit(field.name), top)
        below = field.dataType, named, field.name if top else f"{place}.{field.name}", rules
        if _has_parts(field.dataType):
            found.append(F.when(there.isNull(), _one("missing", named)).otherwise(_walk(there, *below)))
        else:
            leaves.append(F.when(there.isNull(), _told("missing", named)).otherwise(_leaf(there, *below)))
    return F.concat(*found, F.array_compact(F.array(*leaves))) if leaves else F.concat(*found)


def gated(rows: DataFrame, schema: T.StructType, rules: Rules, raw: str = "raw") -> DataFrame:
    """The rows with the sorted violations of the JSON text in `raw`; none for a row that fits."""
    found = _walk(F.try_parse_json(raw), schema, F.lit("$"), "", rules)
    return rows.withColumn(VIOLATIONS, F.array_sort(found))


def typed(checked: DataFrame, schema: T.StructType, raw: str = "raw") -> DataFrame:
    """The rows without a violation, typed."""
    return checked.filter(F.size(VIOLATIONS) == 0).select(F.from_json(raw, schema).alias("row")).select("row.*")
