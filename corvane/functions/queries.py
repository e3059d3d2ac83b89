"""Query strings of the search client, taken apart into columns."""

from __future__ import annotations

import datetime
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The two query notations.
DATE_CLAUSE = r"published\s*:\s*([<>]=|[<>]|=)\s*([\d\-]+)"
FIELD_CLAUSE = r'(\w+):"([^"]+)"'


def partial_date(text: Column) -> Column:
    """``2024``, ``2024-05``, ``2024-05-01`` or an ISO instant as a timestamp (start of period)."""
    return F.coalesce(
        F.when(text.rlike(r"^\d{4}$"), F.try_to_timestamp(F.concat(text, F.lit("-01-01")))),
        F.when(text.rlike(r"^\d{4}-\d{2}$"), F.try_to_timestamp(F.concat(text, F.lit("-01")))),
        F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(text)))


def normalise_queries(queries: DataFrame, text: str = "query") -> DataFrame:
    """Add kind, date_op, date_from, date_to and clauses to a table of query strings.

    A date clause replaces the whole query; OR is looked for before AND; without either, the
    first field clause counts; without field clauses all default fields are searched.  A date
    clause without a valid date is of the kind ``invalid_date`` and finds nothing.
    """
    q = F.col(text)
    op = F.regexp_extract(q, DATE_CLAUSE, 1)
    value = F.regexp_extract(q, DATE_CLAUSE, 2)
    start = partial_date(value)
    is_eq = op == "="
    period_end = (F.when(F.length(value) == 4, F.add_months(start, 12).cast("timestamp"))
                  .when(F.length(value) == 7, F.add_months(start, 1).cast("timestamp")))
    pairs = F.arrays_zip(
        F.regexp_extract_all(q, F.lit(FIELD_CLAUSE), F.lit(1)).alias("field"),
        F.regexp_extract_all(q, F.lit(FIELD_CLAUSE), F.lit(2)).alias("text"))
    kind = (F.when((op != "") & start.isNull(), "invalid_date")
            .when(op != "", F.when(is_eq, "date_eq").otherwise("date_range"))
            .when(q.contains(" OR "), "should")
            .when(q.contains(" AND "), "must")
            .when(F.size(pairs) > 0, "match")
            .otherwise("multi_match"))
    none = F.lit(None)
    return (queries
            .withColumn("kind", kind)
            .withColumn("date_op", F.when(op != "", op))
            .withColumn("date_from", F.when(is_eq | op.isin(">", ">="), start).otherwise(none))
            .withColumn("date_to", F.when(is_eq, F.coalesce(period_end, start))
                        .when(op.isin("<", "<="), start).otherwise(none))
            .withColumn("clauses", F.when(F.col("kind") == "match", F.slice(pairs, 1, 1))
                        .when(F.col("kind").isin("should", "must"), pairs)
                        .otherwise(F.slice(pairs, 1, 0))))


def valid_date(value: str) -> bool:
    """Whether a text is a year, a month or begins with a day of the calendar."""
    if not re.match(r"\d{4}(-\d{2}(-\d{2}.*)?)?$", value):
        return False
    try:
        datetime.date.fromisoformat((value + "-01-01")[:10])
    except ValueError:
        return False
    return True


def period(value: str) -> tuple[str, str | None]:
    """Start of a partial date, and the start of the next period for a year or a month."""
    if len(value) == 4:
        return f"{value}-01-01", f"{int(value) + 1:04d}-01-01"
    if len(value) == 7:
        year, month = int(value[:4]), int(value[5:])
        return f"{value}-01", f"{year + month // 12:04d}-{month % 12 + 1:02d}-01"
    return value, None


def date_matches(published: Column, op: str, value: str) -> Column:
    """Date predicate on a date or timestamp column.  Bounds are text literals, which Spark turns
    into the type of the column, so the comparison reaches the scan.

    Equality on a year or a month is the half-open period; on a full date it is that instant.  An
    invalid date matches nothing.
    """
    if not valid_date(value):
        return F.lit(False)
    start, end = period(value)
    first = F.lit(start)
    if op == "=" and end is not None:
        return (published >= first) & (published < F.lit(end))
    compare = {"=": published == first, ">": published > first, ">=": published >= first,
               "<": published < first, "<=": published <= first}
    return compare[op]


def field_query_clauses(queries: DataFrame, text: str = "query",
                        fields: tuple[str, ...] = ("title", "abstract")) -> DataFrame:
    """``title:x,abstract:y`` strings: adds valid, clauses and one flag per queried field.

    At most two clauses, each ``field:text`` with a known field; anything else is invalid.
    """
    parts = F.split(F.regexp_replace(F.col(text), ",+$", ""), ",")
    clauses = F.transform(parts, lambda p: F.struct(
        F.trim(F.get(F.split(p, ":", 2), F.lit(0))).alias("field"),
        F.trim(F.get(F.split(p, ":", 2), F.lit(1))).alias("text")))
    known = F.forall(clauses, lambda c: c["field"].isin(*fields) & c["text"].isNotNull())
    out = (queries.withColumn("clauses", clauses)
           .withColumn("valid", (F.size("clauses") <= 2) & F.coalesce(known, F.lit(False))))
    for name in fields:
        out = out.withColumn(f"{name}_queried", F.coalesce(
            F.array_contains(F.col("clauses.field"), name), F.lit(False)))
    return out


def explode_clauses(queries: DataFrame) -> DataFrame:
    """query_id, clause, field, text of every clause."""
    return (queries.select("query_id", F.posexplode_outer("clauses").alias("clause", "c"))
            .filter(F.col("c").isNotNull()).select("query_id", "clause", "c.field", "c.text"))
