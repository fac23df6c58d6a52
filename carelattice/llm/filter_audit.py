"""What each of several filters removes, alone and beside the others, in every order.

A document is a set of failed filters, so a part of the corpus is fully described by
how many of its documents fail which set: Spark counts those, and from them the
documents that each coalition of filters removes. A step of an order removes the
difference of two coalitions. Shapley values are the exact solution of a least
squares problem over all coalitions: weighted by the Shapley kernel, and bound to
share out exactly what all filters together remove. Its normal equations are solved
in rationals.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from fractions import Fraction
from itertools import combinations, permutations
from math import comb, factorial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelattice.llm.common import written

# Orders are listed one by one, so their number must stay small.
MOST_FILTERS = 6
_MEASURES = ("removed", "good", "toxic")


def text_filters(text: Column) -> dict[str, Column]:
    """The failure conditions of one text: few words, repeated words, capitals, symbols."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    return {
        "A": F.size(words) < 100,
        "B": 100 * F.size(F.array_distinct(words)).cast("bigint") < 80 * F.size(words).cast("bigint"),
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")).cast("bigint") > 10 * F.length(text).cast("bigint"),
        "D": text.rlike("[#$%&*|]"),
    }


def failed_sets(docs: DataFrame, labels: DataFrame, *, part: str = "lang") -> DataFrame:
    """(part, failed, good, toxic, n): documents per set of failed filters, as a bit mask.

    Bit 0 is filter A. Bit 4, filter E, is set if any row with a smaller id has the
    same text. A document is good or toxic if a row of ``labels`` with its id says so;
    labels without a document or an id do not count.

    NULL texts are empty, NULL parts the empty string. A row without an id has no
    label and no smaller id, so it does not fail E, and fails it for no other row. Rows
    that share id and text are all first; each row counts. Texts are compared by
    SHA-256. Other columns are ignored; an empty table gives no row.

    Rows equal in id, text, part and failures meet before anything else. The first
    rows of a text are found by id and text together, so copies of one text are spread.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    slim = docs.select("doc_id", text.alias("text"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"))
    bits = [F.when(failed, 1 << i).otherwise(0) for i, failed in enumerate(text_filters(F.col("text")).values())]
    masks = bits[0]
    for bit in bits[1:]:
        masks = masks + bit
    key = F.when(F.col("doc_id").isNotNull(), F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    rows = written(
        slim.select("doc_id", key.alias("text_key"), "part", masks.alias("failed"))
        .groupBy("doc_id", "text_key", "part", "failed").agg(F.count(F.lit(1)).alias("n")), "audited")

    named = rows.where("doc_id is not null")
    first = named.groupBy("text_key").agg(F.min("doc_id").alias("doc_id")).withColumn("is_first", F.lit(True))
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    again = F.col("doc_id").isNotNull() & F.col("is_first").isNull()
    return (
        rows.join(first, ["text_key", "doc_id"], "left").join(marks, "doc_id", "left")
        .select("part", (F.col("failed") + F.when(again, 16).otherwise(0)).alias("failed"),
                *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")], "n")
        .groupBy("part", "failed", "good", "toxic").agg(F.sum("n").alias("n"))
    )


def coalition_removals(sets: DataFrame, n_filters: int) -> DataFrame:
    """(part, coalition, total, removed, good, toxic) for all coalitions of filters.

    ``coalition`` is a bit mask; ``removed`` counts the documents that fail any of its
    filters, ``good`` and ``toxic`` those of them with that label. ``sets`` is as
    :func:`failed_sets` returns it; a part with documents has 2^n rows.
    """
    hit = F.col("failed").bitwiseAND(F.col("coalition")) != 0

    def count(where: Column) -> Column:
        return F.sum(F.when(where, F.col("n")).otherwise(0))

    return (
        sets.withColumn("coalition", F.explode(F.sequence(F.lit(0), F.lit((1 << n_filters) - 1))))
        .groupBy("part", "coalition")
        .agg(F.sum("n").alias("total"), count(hit).alias("removed"),
             count(hit & F.col("good")).alias("good"), count(hit & F.col("toxic")).alias("toxic"))
    )


def _solved(matrix: list[list[Fraction]]) -> list[list[Fraction]]:
    """The inverse of a regular matrix, by elimination in rationals."""
    size = len(matrix)
    rows = [row + [Fraction(i == j) for j in range(size)] for i, row in enumerate(matrix)]
    for i in range(size):
        pivot = next(r for r in range(i, size) if rows[r][i])
        rows[i], rows[pivot] = rows[pivot], rows[i]
        rows[i] = [x / rows[i][i] for x in rows[i]]
        for r in range(size):
            if r != i and rows[r][i]:
                rows[r] = [x - rows[r][i] * y for x, y in zip(rows[r], rows[i])]
    return [row[size:] for row in rows]


class KernelSolver:
    """Shapley values of a coalition function by constrained weighted least squares.

    Minimises the sum over proper coalitions S of w(S) (v(S) - sum of phi over S)^2,
    where the phi add up to v of all players; w is the Shapley kernel.
    """

    def __init__(self, players: int) -> None:
        self.players = players
        self.proper = [
            (sum(1 << i for i in members), members,
             Fraction(players - 1, comb(players, size) * size * (players - size)))
            for size in range(1, players) for members in combinations(range(players), size)]
        normal = [[Fraction(0)] * (players + 1) for _ in range(players + 1)]
        for _, members, weight in self.proper:
            for i in members:
                for j in members:
                    normal[i][j] += weight
        for i in range(players):
            normal[i][players] = normal[players][i] = Fraction(1)
        self.inverse = _solved(normal)

    def __call__(self, values: list[int]) -> list[Fraction]:
        """``values[S]`` is what coalition S is worth; that of the empty one is 0."""
        right = [Fraction(0)] * self.players + [Fraction(values[-1])]
        for mask, members, weight in self.proper:
            for i in members:
                right[i] += weight * values[mask]
        return [sum(a * b for a, b in zip(row, right)) for row in self.inverse[:self.players]]


def _steps(letters: str, total: int, removed: list[int], good: list[int], toxic: list[int],
           shares: list[Fraction]) -> Iterator[tuple]:
    every = len(removed) - 1
    orders = factorial(len(letters))
    for order in permutations(range(len(letters))):
        before = 0
        for step, i in enumerate(order, 1):
            after = before | 1 << i
            here = removed[after] - removed[before]
            yield ("".join(letters[j] for j in order), step, total - removed[after], here, removed[1 << i] - here,
                   removed[every] - removed[every ^ 1 << i], good[after] - good[before], toxic[after] - toxic[before],
                   int(shares[i] * orders))
            before = after


def audit(sets: DataFrame, letters: str = "ABCDE") -> DataFrame:
    """One row per part, order of the filters and step.

    (part, filter_order, step, kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley): documents left after the step, removed by it, failing its
    filter but removed before, failing no other filter, good and toxic ones removed,
    and the removals of the step's filter added up over all orders. Parts without
    documents do not exist; steps that remove nothing are listed.

    ``sets`` is (part, failed, good, toxic, n), as from :func:`failed_sets`; only its
    counts per coalition, 2^n rows a part, leave Spark's aggregation for Python.
    """
    if not 2 <= len(letters) <= MOST_FILTERS:
        raise ValueError(f"2 to {MOST_FILTERS} filters, not {len(letters)}")
    counts = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        solve = KernelSolver(len(letters))
        for batch in batches:
            for part, total, table in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                table.sort(key=lambda c: c["coalition"])
                measures = [[c[m] for c in table] for m in _MEASURES]
                rows = list(_steps(letters, total, *measures, solve(measures[0])))
                order, step, *numbers = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(rows), pa.string()), pa.array(order, pa.string()), pa.array(step, pa.int32()),
                     *[pa.array(c, pa.int64()) for c in numbers]],
                    names=["part", "filter_order", "step", *counts])

    tables = coalition_removals(sets, len(letters)).groupBy("part").agg(
        F.max("total").alias("total"), F.collect_list(F.struct("coalition", *_MEASURES)).alias("coalitions"))
    return tables.mapInArrow(
        run, "part string, filter_order string, step int, " + ", ".join(f"{c} bigint" for c in counts))
