"""License scan: exact set-similarity join of text blocks with license templates.

A block is a paragraph (lines up to a blank one).  A template is found in a block
that holds at least `threshold` of its distinct words.  Words are put in order of
their document frequency in the corpus, rarest first.  A block that reaches the
threshold must hold one of the first |T| - need + 1 words of a template T (prefix
filter), at least `need` words (length filter), and from the first word found on
enough words of T must be left (positional filter).  Only blocks that pass are
counted out, so the result is exact.

Null and empty texts have no words and no labels.  Repeated rows are worked off one
by one; further columns are kept.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from weakspot.llm.common import UPPER, WORD_BREAK, WORD_BYTES, read, with_names, word_list

# fixed values: phrases with their labels, and words of well-known notices
PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]
TEMPLATES = [
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files, to deal in the software without restriction"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "You may not use this file except in compliance with the license. You may obtain a copy of the license at"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted"),
    ("cc-by", "Licensed under the Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("public-domain", "This is free and unencumbered software released into the public domain"),
]

BLANK_LINE = re.compile(r"\n[^\S\n]*\n")
RESULT = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "blocks array<struct<label: string, template: int, block: int, containment: double>>"
)


def document_frequencies(docs: DataFrame, vocabulary: set[bytes], text: str = "text") -> dict[bytes, int]:
    """In how many rows each word of the templates stands; one row per template word comes back."""

    def counted(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts = Counter()
            for value in batch.iloc[:, 0]:
                counts.update(vocabulary.intersection(word_list(value)))
            if counts:  # an empty frame has no types
                yield pd.DataFrame({"word": [w.decode() for w in counts], "n": list(counts.values())})

    rows = docs.select(F.col(text)).mapInPandas(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {row.word.encode(): row.n for row in rows.collect()}  # at most the words of the templates


class Templates:
    """Templates with their words in global order and the needed counts."""

    def __init__(self, templates: list[tuple[str, str]], frequencies: dict[bytes, int], threshold: float):
        self.entries = []
        self.prefix: dict[bytes, list[int]] = {}
        for number, (label, text) in enumerate(templates):
            ordered = sorted(set(word_list(text)), key=lambda w: (frequencies.get(w, 0), w))
            need = max(1, math.ceil(threshold * len(ordered) - 1e-9))
            self.entries.append((label, ordered, need))
            for word in ordered[: len(ordered) - need + 1]:
                self.prefix.setdefault(word, []).append(number)

    def found(self, block: set[bytes]) -> list[tuple[int, float]]:
        """Templates whose containment in the block reaches the threshold."""
        hits = []
        for number in sorted({n for word in block.intersection(self.prefix) for n in self.prefix[word]}):
            _, ordered, need = self.entries[number]
            if len(block) < need:
                continue
            missing, spare = 0, len(ordered) - need
            for word in ordered:
                if word not in block:
                    missing += 1
                    if missing > spare:
                        break
            else:
                hits.append((number, (len(ordered) - missing) / len(ordered)))
        return hits


def places(words: list[bytes], phrase: bytes) -> list[int]:
    """Word numbers at which the words of a phrase stand one after the other."""
    joined = b" " + b" ".join(words) + b" "
    wanted, at, starts = b" " + phrase + b" ", -1, []
    while (at := joined.find(wanted, at + 1)) >= 0:
        starts.append(joined.count(b" ", 0, at))
    return starts


def scanned(value: str | None, templates: Templates, phrases: list[tuple[bytes, str]]) -> tuple:
    raw = (value or "").encode("utf-8", "surrogatepass").translate(WORD_BYTES)
    words = raw.split()
    starts, base = [], set()
    for phrase, label in phrases:
        if phrase.split()[-1] in raw:
            here = places(words, phrase)
            starts += here
            if here:
                base.add(label)
    blocks = []
    if not templates.prefix.keys().isdisjoint(words):
        for number, block in enumerate(BLANK_LINE.split(value or "")):
            for template, share in templates.found(set(word_list(block))):
                blocks.append((templates.entries[template][0], template, number, share))
    labels = base | {b[0] for b in blocks}
    score = 1.0 if base else max((b[3] for b in blocks), default=0.0)
    return (
        len(words), len(starts), min(starts, default=None), max(starts, default=None),
        ",".join(sorted(base)), ",".join(sorted(labels)), score, blocks,
    )


def scan_licenses(
    docs: DataFrame, text: str = "text", threshold: float = 0.9, templates: list | None = None, phrases: list | None = None,
) -> DataFrame:
    """Add a struct column `license`: counts, labels, score and the blocks found."""
    templates = TEMPLATES if templates is None else templates
    wanted = [(p.encode(), label) for p, label in (PHRASES if phrases is None else phrases)]
    vocabulary = {w for _, t in templates for w in word_list(t)}
    ready = Templates(templates, document_frequencies(docs, vocabulary, text), threshold)

    @F.pandas_udf(RESULT)
    def scan(values: pd.Series) -> pd.DataFrame:
        rows = [scanned(v, ready, wanted) for v in values]
        # plain objects: columns of numbers with gaps keep their type
        frame = pd.DataFrame(rows, columns=[part.split()[0] for part in RESULT.split(", ")[:7]] + ["blocks"], dtype=object)
        frame["blocks"] = [[dict(zip(("label", "template", "block", "containment"), b)) for b in row] for row in frame["blocks"]]
        return frame

    name = with_names(docs, ["license"])["license"] if "license" in docs.columns else "license"
    return docs.withColumn(name, scan(F.col(text)))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "license.*").drop("blocks")


def _words_sql(text: str) -> str:
    low = f"translate(coalesce({text}, ''), '{UPPER}', '{UPPER.lower()}')"
    return f"list_filter(string_split_regex({low}, '{WORD_BREAK}'), lambda w: w <> '')"


def _rows(rows: list[tuple[str, str]]) -> str:
    return ", ".join(f"({n}, '{a}', '{b}')" for n, (a, b) in enumerate(rows))


OP8_SQL = rf"""
WITH phrase AS (SELECT label, string_split(p, ' ') AS p FROM (VALUES {_rows(PHRASES)}) AS v(n, p, label)),
template AS (SELECT n, label, list_distinct({_words_sql('t')}) AS t FROM (VALUES {_rows(TEMPLATES)}) AS v(n, label, t)),
doc AS (SELECT row_number() OVER () AS r, doc_id, text, {_words_sql('text')} AS w FROM documents),
place AS (SELECT r, label, i FROM (SELECT r, w, label, p, unnest(range(1, len(w) - len(p) + 2)) AS i FROM doc, phrase WHERE len(w) >= len(p))
  WHERE w[i:i + len(p) - 1] = p),
base AS (SELECT r, count(*) AS n, min(i) - 1 AS first, max(i) - 1 AS last, list(DISTINCT label) AS labels FROM place GROUP BY r),
block AS (SELECT r, list_distinct({_words_sql('b')}) AS b FROM (SELECT r, unnest(string_split_regex(coalesce(text, ''), '
[^\S
]*
')) AS b FROM doc)),
found AS (SELECT r, label, len(list_intersect(b, t)) / len(t) AS share FROM block, template
  WHERE len(list_intersect(b, t)) >= ceil(0.9 * len(t) - 1e-9)),
method AS (SELECT r, max(share) AS share, list(DISTINCT label) AS labels FROM found GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_base, CAST(first AS BIGINT) AS first_word,
  CAST(last AS BIGINT) AS last_word, coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(method.labels, [])))), ','), '') AS labels,
  CASE WHEN n > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0)::DOUBLE END AS score
FROM doc LEFT JOIN base USING (r) LEFT JOIN method USING (r)
"""
