"""Aggregate stage."""

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weakspot import fixed_values as fixed
from weakspot.functions.tags import report_tag
from weakspot.operators import clusters as cl
from weakspot.operators import merges, report
from weakspot.operators.collective import analyzed, failure_events, with_lists
from weakspot.operators.diagnose import failures
from weakspot.operators.repair import repaired
from weakspot.sources.artifacts import written


class Report(NamedTuple):
    weaknesses: DataFrame
    rankings: DataFrame
    chains: DataFrame
    tag_map: DataFrame

    def document(self) -> DataFrame:
        return report.as_document(*self)



def aggregate(
    diagnoses: DataFrame,
    level: str = "auto",
    reachable: bool = False,
    verifiers: dict | None = None,
    rediagnose: Callable | None = None,
    collective: Callable | None = None,
    causal: Callable | None = None,
    on_events: Callable[[DataFrame], None] | None = None,
    on_log: Callable[[DataFrame], None] | None = None,
) -> Report:
    """Weakness report of the failures among ``diagnoses``.

    One pass over the diagnoses, with their long texts, leaves the narrow columns
    of the failures.  Those are reduced to partials per fault type and tag, which
    are written, as is the weakness table made from them; everything else works on
    those small tables.

    ``collective`` and ``causal`` are analyzers (see ``operators.collective``);
    ``on_events`` receives the clusters whose answers had to be replaced, ``on_log`` the log
    rows of these and of unusable answers of verifiers.
    """
    rows = repaired(failures(diagnoses), level, reachable, verifiers, rediagnose, on_log)
    narrow = written(cl.keyed(rows), "keyed")
    parts = cl.Partials(*[written(part, "partials") for part in cl.partials(narrow)])
    groups = cl.named(parts)
    own_tags = groups.counts.select("tag").distinct()

    if collective is None:
        # the default analysis proposes no merges: every tag maps to itself
        edges, resolved = None, own_tags.select(F.col("tag").alias("source"), F.col("tag").alias("target"))
        merged = cl.clusters(groups).withColumn("narrative", cl.narrative(fixed.MERGED_CLIFF_FORMAT))
    else:
        first_look = analyzed(cl.clusters(groups), rows, None, collective)
        edges = merges.accepted_edges(first_look.proposals)
        resolved = merges.closure(edges, own_tags)
        regrouped = cl.clusters(cl.regrouped(cl.remapped(groups, resolved), F.col("tag")))
        looked = analyzed(regrouped, rows, resolved, collective)
        merged = looked.clusters
        if on_events is not None:
            on_events(merged.filter("problem IS NOT NULL"))
        if on_log is not None:
            on_log(failure_events(merged))

    narratives = cl.narratives_by_key(merged)
    if collective is not None:
        narratives = with_lists(narratives, looked)
    final = cl.clusters(cl.final(parts, None if edges is None else resolved))
    # at most 35 rows, read by every later step
    rows = written(report.weaknesses(final, narratives), "weaknesses")
    chains = report.default_chains(rows) if causal is None else causal(rows)
    tag_map = resolved.select("source", report_tag(F.col("target")).alias("target"))
    return Report(rows, report.rankings(rows), chains, tag_map)
