"""Property-based checks of the distributed algorithms against brute force."""

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clinlake.operators.ranking import running_total
from clinlake.operators.relate import cohort_counts

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

keys = st.one_of(st.none(), st.integers(0, 5))


@SETTINGS
@given(fact=st.lists(st.tuples(keys, st.sampled_from(["a", "b", "c"])), min_size=1, max_size=40),
       dim=st.lists(st.tuples(keys, st.one_of(st.none(), st.sampled_from(["M", "F", "X"]))), min_size=1,
                    max_size=15))
def test_cohort_counts_equals_join_then_count(spark, fact, dim):
    f = spark.createDataFrame(fact, "k int, ev string")
    d = spark.createDataFrame(dim, "k int, g string")
    cohorts = {"M": F.col("g") == "M", "other": ~F.col("g").isin("M", "F")}
    events = {"a": F.col("ev") == "a", "bc": F.col("ev").isin("b", "c")}
    got = {(r.cohort, r.event): r.n
           for r in cohort_counts(f, d, "k", cohorts, events).collect()}
    fp, dp = pd.DataFrame(fact, columns=["k", "ev"]), pd.DataFrame(dim, columns=["k", "g"])
    j = fp.dropna(subset=["k"]).merge(dp.dropna(subset=["k"]), on="k")
    coh = {"M": j.g == "M", "other": j.g.notna() & ~j.g.isin(["M", "F"])}
    ev = {"a": j.ev == "a", "bc": j.ev.isin(["b", "c"])}
    expect = {(c, e): int((cm & em).sum()) for c, cm in coh.items() for e, em in ev.items()}
    assert got == expect


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(0, 2), st.integers(-20, 20), st.integers(1, 9)), min_size=1,
                     max_size=60),
       buckets=st.integers(1, 9))
def test_running_total_equals_cumsum(spark, rows, buckets):
    data = [(g, v, i, w) for i, (g, v, w) in enumerate(rows)]
    df = spark.createDataFrame(data, "g int, v int, id int, w int")
    out = {r.id: r.cum_w for r in running_total(df, ["v", "id"], ["w"], ["g"], n_buckets=buckets).collect()}
    pdf = pd.DataFrame(data, columns=["g", "v", "id", "w"]).sort_values(["g", "v", "id"])
    pdf["c"] = pdf.groupby("g").w.cumsum()
    assert out == dict(zip(pdf.id, pdf.c))
