"""Bind a computed value once inside an expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, with the value computed once per row.

    A lambda inside a higher-order function would otherwise compute an outer expression again for
    every element.
    """
    return F.get(F.transform(F.array(value), lambda v: body(v)), F.lit(0))


def occurrence_runs(ordered: Column, term: Callable[[Column], Column],
                    build: Callable[[Column, Column, Column], Column]) -> Column:
    """Cut a sorted array into runs of equal ``term`` and build one value per run from the array,
    the start of the run and its length."""
    def cut(items: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(items) - 1), lambda i: (i == 0) | (
            term(F.get(items, i)) != term(F.get(items, i - 1))))
        return let(starts, lambda at: F.transform(at, lambda i, j: build(
            items, i, F.coalesce(F.get(at, j + 1), F.size(items)) - i)))

    return let(ordered, lambda items: F.when(F.size(items) > 0, cut(items)))


def token_counts(tokens: Column) -> Column:
    """term/tf structs of a token array, counted inside the row: a text is one row, so its
    distinct words need no shuffle."""
    return occurrence_runs(F.sort_array(tokens), lambda x: x, lambda items, at, n: F.struct(
        F.get(items, at).alias("term"), n.cast("long").alias("tf")))


def token_places(tokens: Column) -> Column:
    """term/tf/positions structs of a token array."""
    placed = F.sort_array(F.transform(tokens, lambda t, i: F.struct(t.alias("t"), i.alias("p"))))
    return occurrence_runs(placed, lambda x: x["t"], lambda items, at, n: F.struct(
        F.get(items, at)["t"].alias("term"), n.cast("long").alias("tf"),
        F.transform(F.slice(items, at + 1, n), lambda x: x["p"]).alias("positions")))
