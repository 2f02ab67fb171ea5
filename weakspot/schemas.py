"""Row types of the tables that flow between stages."""

from pyspark.sql import types as T

STRING, LONG, INT, DOUBLE, BOOLEAN = (
    T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType()
)
STRINGS, LONGS, INTS = (T.ArrayType(t) for t in (STRING, LONG, INT))
TEXT_MAP = T.MapType(STRING, STRING)


def row(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


TASK = row(
    task_id=LONG, content=STRING, canonical_solution=STRING, completion=STRING, test_code=STRING,
    labels=TEXT_MAP, accepted=BOOLEAN, metrics=STRING, extra=STRING,
)

EVIDENCE_ROW = row(wrong_line=STRING, correct_approach=STRING, failed_test=STRING)
EVIDENCE = EVIDENCE_ROW.simpleString()

DIAGNOSIS = row(
    task_id=LONG, fault_type=STRING, sub_tags=STRINGS, severity=STRING, description=STRING,
    evidence=EVIDENCE_ROW, enriched_labels=TEXT_MAP, confidence=DOUBLE, diagnosis_source=STRING,
    prompt_version=STRING,
)

COLLECTIVE = row(
    refined_root_cause=STRING, capability_cliff=STRING, misdiagnosed_ids=LONGS,
    misdiagnosis_corrections=TEXT_MAP, cluster_coherence=DOUBLE,
)

WEAKNESS = row(
    rank=INT, fault_type=STRING, sub_tags=STRINGS, frequency=LONG, sample_task_ids=LONGS,
    trainability=DOUBLE, collective_diagnosis=COLLECTIVE,
)

REPORT = row(
    weaknesses=T.ArrayType(WEAKNESS),
    rankings=row(by_frequency=INTS, by_difficulty=INTS, by_trainability=INTS),
    causal_chains=T.ArrayType(row(root=STRING, downstream=STRINGS, training_priority=STRING)),
    tag_mappings=TEXT_MAP,
)

LIMITS_ROW = row(n_range=LONGS, value_range=LONGS, time_limit=STRING, memory_limit=STRING)
VERIFICATION_ROW = row(
    min_test_cases=INT, must_include_edge_cases=STRINGS, brute_force_verifiable=BOOLEAN,
    brute_force_complexity_limit=STRING,
)
HINTS_ROW = row(solution_approach=STRING, common_wrong_approach=STRING, distinguishing_test=STRING)
LANGUAGE_ROW = row(target_languages=STRINGS, language_specific=BOOLEAN)
DIVERSITY_ROW = row(narrative_theme=STRING, data_structure=STRING, constraint_scale=STRING)
LIMITS, VERIFICATION, HINTS, LANGUAGE = (
    r.simpleString() for r in (LIMITS_ROW, VERIFICATION_ROW, HINTS_ROW, LANGUAGE_ROW)
)

SPEC = row(
    spec_id=STRING,
    target_weakness=row(fault_type=STRING, sub_tags=STRINGS, root_cause=STRING, capability_cliff=STRING),
    problem_spec=row(
        algorithm_type=STRING, difficulty=STRING, narrative_theme=STRING, constraints=LIMITS_ROW,
        key_trap=STRING, must_cover=STRINGS, must_avoid=STRINGS,
    ),
    verification_spec=VERIFICATION_ROW,
    diversity_tags=DIVERSITY_ROW,
    generation_hints=HINTS_ROW,
    language_constraint=LANGUAGE_ROW,
    prompt_version=STRING,
)

RESPONSE = row(
    algorithm_type=STRING, difficulty=STRING, narrative_theme=STRING, constraints=LIMITS_ROW,
    key_trap=STRING, must_cover=STRINGS, must_avoid=STRINGS, verification_spec=VERIFICATION_ROW,
    generation_hints=HINTS_ROW, language_constraint=LANGUAGE_ROW,
)

EVENT_LOG = row(
    seq=LONG, stage=STRING, weakness=STRING, error_type=STRING, event_type=STRING, message=STRING,
    attempts=INT, cluster=row(fault_type=STRING, sub_tags=STRINGS, task_ids=LONGS),
)
