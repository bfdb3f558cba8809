"""License scans: hundreds of signature rules over a text's words, opened by keywords, overlaps resolved.

A text is read as lower-case words joined by one blank. A rule is tried only where all of its keywords are among
the words. Of the detections, one that lies inside another of the same or a more telling level is suppressed (of equal intervals
on one level the earlier rule stays). Places of pinned rules are all kept.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm.common import slices
from tidemark.llm.license_rules import LEVELS, WEIGHTS, compiled

#: Phrases whose places are all reported, with their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

DETECTION = T.StructType([
    T.StructField("label", T.StringType()), T.StructField("level", T.StringType()), T.StructField("first", T.LongType()),
    T.StructField("last", T.LongType()), T.StructField("pinned", T.BooleanType()), T.StructField("weight", T.DoubleType()),
])

#: A-Z lower-cased, other ASCII than letters and digits as blanks, all else as it is.
AS_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def detections(line: bytes, present: set[bytes], phrases: tuple[tuple[str, str], ...]) -> list[tuple[int, int, int]]:
    """start, end and rule of every match in the words joined by blanks; present are the different words."""
    rules, patterns, opened, needed = compiled(phrases)
    found = []
    for word in present.intersection(opened):
        for i in opened[word]:
            if needed[i] <= present:
                found += [(*m.span(1), i) for m in patterns[i].finditer(line)]
    return found


def resolved(found: list[tuple[int, int, int]], phrases: tuple[tuple[str, str], ...]) -> list[tuple[int, int, int]]:
    """The detections that no other suppresses, by start, longest first.

    Seen in that order, a detection lies inside an earlier one if that ends no sooner. Suppression is transitive, so it
    makes no difference whether the earlier one is suppressed itself.
    """
    rules = compiled(phrases)[0]
    reach = [-1] * len(LEVELS)  # the furthest end so far of the detections of a level or a more telling one
    out = []
    for start, end, i in sorted(found, key=lambda d: (d[0], -d[1], rules[d[2]].level, d[2])):
        level = rules[i].level
        if rules[i].pinned or reach[level] < end:
            out.append((start, end, i))
        for k in range(level, len(LEVELS)):
            reach[k] = max(reach[k], end)
    return out


def scan(docs: DataFrame, text: str = "text", phrases: Mapping[str, str] = PHRASES) -> DataFrame:
    """docs with n_words and detections, which replace input columns of their names.

    A detection has its label, level, first and last word (from 0), whether its rule is one of the phrases', and a weight from 0
    to 1. They stand in the order of first words, longer ones first. Words are runs of characters other than ASCII ones that are neither letter
    nor digit. A null or empty text has no words and an empty list; whole texts are read however long; every row is
    judged by itself, so ties and repeated rows change nothing; an empty table gives no rows.
    """
    names = ["n_words", "detections"]
    docs = docs.drop(*names)
    named = tuple(phrases.items())

    def run(batches):
        import pyarrow as pa

        rules = compiled(named)[0]
        kind = pa.struct([
            ("label", pa.string()), ("level", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("pinned", pa.bool_()),
            ("weight", pa.float64()),
        ])
        for batch in batches:
            for part in slices(batch, text):
                sizes, lists = [], []
                for raw in part.column(text).cast(pa.binary()).to_pylist():
                    words = raw.translate(AS_WORDS).split() if raw else []
                    sizes.append(len(words))
                    line = b" ".join(words)
                    kept, at, n = [], 0, 0
                    for start, end, i in resolved(detections(line, set(words), named), named):
                        n += line.count(b" ", at, start)
                        at = start
                        rule = rules[i]
                        kept.append((rule.label, LEVELS[rule.level], n, n + line.count(b" ", start, end), rule.pinned, WEIGHTS[rule.level]))
                    lists.append([dict(zip(kind.names, d)) for d in kept])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(sizes, pa.int64()), pa.array(lists, pa.list_(kind))], names=[*part.schema.names, *names]
                )

    schema = T.StructType([*docs.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("detections", T.ArrayType(DETECTION))])
    return docs.mapInArrow(run, schema)
