"""Filtered aggregates, suppressed views and descriptive statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.bounds import derived_predicate
from millrace.operators.joins import Size, keyed_join


def critical_query(
    df: DataFrame,
    key: str,
    value: str,
    date: str,
    start: str,
    end: str,
    sums: Mapping[str, str | Column],
    count_as: str = "Registros",
) -> DataFrame:
    """Rows and totals for one key value between two dates, both included.

    Both predicates reach the file scan, and only the named columns are read.  If the frame declares
    partitions made from the date (see ``bounds``), only those between the two dates are opened.
    """
    day = F.col(date).cast("date")
    chosen = df.filter((F.col(key) == value) & day.between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    derived = derived_predicate(df.schema, date, start, end)
    chosen = chosen if derived is None else chosen.filter(derived)
    return chosen.groupBy(key).agg(
        F.count("*").alias(count_as), *[F.sum(c).alias(name) for name, c in sums.items()]
    )


def critical_query_sql(
    df: DataFrame,
    key: str,
    value: str,
    date: str,
    start: str,
    end: str,
    sums: Mapping[str, str],
    count_as: str = "Registros",
) -> DataFrame:
    """The same question as SQL text over a named frame."""
    totals = ", ".join(f"sum({expr}) AS {name}" for name, expr in sums.items())
    text = f"""
        SELECT {key}, count(*) AS {count_as}, {totals}
        FROM {{frame}}
        WHERE {key} = :value
          AND CAST({date} AS DATE) BETWEEN CAST(:start AS DATE) AND CAST(:end AS DATE)
        GROUP BY {key}
    """
    return df.sparkSession.sql(text, args={"value": value, "start": start, "end": end}, frame=df)


def critical_query_by_lookup(
    fact: DataFrame,
    lookup: DataFrame,
    fact_key: str,
    lookup_key: str,
    name: str,
    value: str,
    date: str,
    start: str,
    end: str,
    sums: Mapping[str, str | Column],
    name_as: str | None = None,
    count_as: str = "Registros",
    lookup_size: Size | None = None,
) -> DataFrame:
    """The same question on the normalised model.

    The fact is summed per foreign key *before* the join, so the join sees one row per key
    and a key with a third of the fact costs no more than any other.
    """
    day = F.col(date).cast("date")
    per_key = (
        fact.filter(day.between(F.lit(start).cast("date"), F.lit(end).cast("date")))
        .groupBy(F.col(fact_key).alias("_k"))
        .agg(F.count("*").alias(count_as), *[F.sum(c).alias(n) for n, c in sums.items()])
    )
    names = lookup.filter(F.col(name) == value).select(F.col(lookup_key).alias("_k"), F.col(name))
    joined = keyed_join(per_key, names, ["_k"], "inner", lookup_size, balance=False)
    return joined.groupBy(F.col(name).alias(name_as or name)).agg(
        F.sum(count_as).alias(count_as), *[F.sum(n).alias(n) for n in sums]
    )


def totals_by(
    df: DataFrame, path: str | Column, as_name: str, sums: Mapping[str, str | Column], order_by: str
) -> DataFrame:
    """Sum measures by one (nested) path, largest first; NULL is a group, ties by name."""
    by = F.col(path) if isinstance(path, str) else path
    return (
        df.groupBy(by.alias(as_name))
        .agg(*[F.sum(c).alias(n) for n, c in sums.items()])
        .orderBy(F.desc(order_by), F.asc(as_name))
    )


def suppress_small_cells(
    df: DataFrame, by: Sequence[str], sums: Mapping[str, str | Column], people: str, k: int = 5
) -> DataFrame:
    """Multi-key totals, keeping only cells with at least ``k`` people (not rows)."""
    return (
        df.groupBy(*by)
        .agg(*[F.sum(c).alias(n) for n, c in sums.items()])
        .filter(F.col(people) >= k)
    )


def describe_population(df: DataFrame, c: str | Column) -> DataFrame:
    """n, mean, population standard deviation, min and max of the non-negative values.

    One aggregate over one scan.
    """
    value = F.col(c) if isinstance(c, str) else c
    return (
        df.select(value.alias("v"))
        .filter(F.col("v") >= 0)
        .agg(
            F.count("v").alias("n"),
            F.avg("v").alias("mean"),
            F.stddev_pop("v").alias("stddev"),
            F.min("v").alias("min"),
            F.max("v").alias("max"),
        )
    )


def partial_moments(df: DataFrame, c: str, by: Mapping[str, Column]) -> DataFrame:
    """Per group what any coarser statistic needs: ``n, mean, m2, min, max`` of the non-negative values.

    ``m2`` is the sum of squared distances from the group's own mean, so that large values lose nothing.
    Stored once (say by month), it answers for any range of groups without the facts, and the groups of
    later loads are just more rows of it.
    """
    value = F.col(c)
    kept = df.filter(value >= 0).select(*[e.alias(n) for n, e in by.items()], value.cast("double").alias("_v"), value.alias("_x"))
    return kept.groupBy(*by).agg(
        F.count("_v").alias("n"), F.avg("_v").alias("mean"), (F.var_pop("_v") * F.count("_v")).alias("m2"),
        F.min("_x").alias("min"), F.max("_x").alias("max"),
    )


def merged_moments(partials: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The statistics of ``describe_population`` from ``partial_moments``, by ``by`` or of all.

    Means are averaged by counts; squares add up, with each group's distance from the whole mean.  The
    same group may come in several rows (of several loads): rows merge in any order.
    """
    keys = list(by)
    whole = partials.groupBy(*keys).agg(
        F.sum("n").alias("_n"), (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("_mean")
    )
    if keys:
        named = whole.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_n", "_mean")
        match = F.lit(True)
        for k in keys:
            match = match & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
        both = partials.join(named, match)
    else:
        both = partials.crossJoin(F.broadcast(whole))  # one row
    apart = F.col("mean") - F.col("_mean")
    return both.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.max("_mean").alias("mean"),
        F.sqrt(F.sum(F.col("m2") + F.col("n") * apart * apart) / F.sum("n")).alias("stddev"),
        F.min("min").alias("min"), F.max("max").alias("max"),
    )


def count_conditions(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """How many rows meet each condition, in one pass; ``n_rows`` is the row count."""
    return df.agg(
        F.count("*").alias("n_rows"), *[F.count_if(c).alias(n) for n, c in conditions.items()]
    )
