"""Relational operators: joins, conditional counts, group counts, previews."""

from __future__ import annotations

from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _keys(on) -> tuple[str, str]:
    return (on, on) if isinstance(on, str) else tuple(on)


def cohort_join(fact: DataFrame, dim: DataFrame, on, select: Sequence[str] | None = None,
                how: str = "inner") -> DataFrame:
    """Equi-join a fact table to a dimension; the key appears once in the result.

    ``on`` is a column name present on both sides or a ``(fact_key, dim_key)``
    pair.  No broadcast hint: Catalyst broadcasts the dimension when its
    estimated size is under the threshold and AQE re-checks at run time;
    otherwise a sort-merge join runs with AQE skew splitting.  NULL keys never
    match.
    """
    fk, dk = _keys(on)
    if fk == dk:
        joined = fact.join(dim, fk, how)
    else:
        joined = fact.join(dim, fact[fk] == dim[dk], how).drop(dim[dk])
    return joined.select(*select) if select else joined


def code_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
              mode: str = "exact", select: Sequence[str] | None = None) -> DataFrame:
    """Join on a code column whose two sides may be typed differently.

    ``mode="exact"``: both keys compared as text (``'0845' != '845'``).
    ``mode="numeric"``: both keys converted with ``try_cast`` to bigint, so
    ``'0845'`` and ``'00845'`` both match ``845`` and alphanumeric codes such
    as ``'V3001'`` simply never match (no run-time cast error under ANSI).
    """
    if mode == "exact":
        lk, rk = F.col(left_key).cast("string"), F.col(right_key).cast("string")
    elif mode == "numeric":
        lk, rk = F.col(left_key).try_cast("bigint"), F.col(right_key).try_cast("bigint")
    else:
        raise ValueError(f"unknown mode {mode!r}")
    l2 = left.withColumn("__jk", lk)
    r2 = right.withColumn("__jk", rk)
    joined = l2.join(r2, "__jk", "inner").drop("__jk")
    return joined.select(*select) if select else joined


def row_count(df: DataFrame, name: str = "n") -> DataFrame:
    """One-row frame with the number of rows."""
    return df.agg(F.count(F.lit(1)).alias(name))


def _any(predicates) -> Column:
    return reduce(lambda a, b: a | b, list(predicates))


def count_where(df: DataFrame, predicate: Column, name: str = "n") -> DataFrame:
    """Rows where ``predicate`` is true (NULL counts as false), as a one-row frame.

    Written as filter-then-count so the predicate reaches the scan
    (parquet row-group skipping) instead of being evaluated per row.
    """
    return df.where(predicate).agg(F.count(F.lit(1)).alias(name))


def conditional_counts(df: DataFrame, predicates: Mapping[str, Column]) -> DataFrame:
    """Several filtered counts in one pass: one ``count_if`` per predicate.

    Replaces N separate ``filter(...).count()`` jobs (each a full scan) with a
    single aggregate; partial aggregation means each task ships one row.  The
    OR of all predicates is applied first (rows failing every predicate add
    nothing), so it can be pushed to the scan.
    """
    return (df.where(_any(predicates.values()))
            .agg(*[F.count_if(p).alias(name) for name, p in predicates.items()]))


def cohort_counts(fact: DataFrame, dim: DataFrame, on, cohorts: Mapping[str, Column],
                  events: Mapping[str, Column]) -> DataFrame:
    """Count joined rows per (cohort, event) without materialising the join.

    ``cohorts`` are predicates on ``dim``, ``events`` predicates on ``fact``;
    the result has one row per pair: ``(cohort, event, n)`` where ``n`` is the
    number of rows of ``fact JOIN dim`` satisfying both.

    Both sides keep only rows of some cohort or event (the filters reach the
    scans) and are reduced to one row per key holding the per-predicate
    counts; the two reduced sides are joined and ``n = sum(dim_count *
    fact_count)``.  Exact for any key multiplicity.  A key holding a third of
    all fact rows is combined map-side by the partial aggregate, so it cannot
    skew the join.  AQE decides how the reduced sides are joined.

    NULL keys never match, as in the inner join.
    """
    fk, dk = _keys(on)
    ev, co = list(events), list(cohorts)
    pairs = [(j, i) for j in range(len(co)) for i in range(len(ev))]
    flags = (dim.where(_any(cohorts.values()))
             .select(F.col(dk).alias("__k"), *[F.coalesce(p, F.lit(False)).alias(f"__c{j}")
                                              for j, p in enumerate(cohorts.values())]))
    facts = fact.where(_any(events.values()))
    fact_agg = (facts.groupBy(F.col(fk).alias("__k"))
                .agg(*[F.count_if(p).alias(f"__e{i}") for i, p in enumerate(events.values())]))
    dim_agg = flags.groupBy("__k").agg(*[F.count_if(f"__c{j}").alias(f"__c{j}") for j in range(len(co))])
    joined = fact_agg.join(dim_agg, "__k", "inner")
    wide = joined.agg(*[
        F.coalesce(F.sum(F.col(f"__c{j}") * F.col(f"__e{i}")), F.lit(0)).cast("long").alias(f"{j}|{i}")
        for j, i in pairs])
    long = wide.unpivot([], [f"`{j}|{i}`" for j, i in pairs], "__pair", "n")
    labels = F.split(F.col("__pair"), r"\|")
    cohort_names = F.array(*[F.lit(c) for c in co])
    event_names = F.array(*[F.lit(e) for e in ev])
    return long.select(
        F.element_at(cohort_names, labels[0].cast("int") + 1).alias("cohort"),
        F.element_at(event_names, labels[1].cast("int") + 1).alias("event"),
        F.col("n").cast("long").alias("n"))


def group_count(df: DataFrame, keys: Sequence[str] | str, name: str = "n") -> DataFrame:
    """Rows per key value (partial + final hash aggregate; hot keys combine map-side)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def preview(df: DataFrame, order_by: Sequence[str] | str, n: int = 20) -> DataFrame:
    """Deterministic first ``n`` rows (top-n sort; each task keeps only ``n``)."""
    order_by = [order_by] if isinstance(order_by, str) else list(order_by)
    return df.orderBy(*order_by).limit(n)
