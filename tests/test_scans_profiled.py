"""Type inference that keeps codes, quarantined records, and size probes without jobs."""

import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinlake.operators.profile import observe_size, observed_sizes, table_size
from clinlake.sources import read_checked, read_profiled
from clinlake.sources.inference import column_profile, inferred_types
from clinlake.plans.standins import table

from conftest import SF01


def _write(folder, name, lines):
    (folder / name).write_text("\n".join(lines) + "\n")
    return str(folder)


def test_codes_stay_text_and_marked_columns_become_numbers(spark, tmp_path):
    lines = ["code,plain,bmi,whole,day,stamp,flag,text,wide,blank,mixed"]
    for i in range(40):
        bmi = "N/A" if i % 7 == 0 else f"{20 + i / 10}"
        lines.append(f"{i:04d},{i},{bmi}, {i - 5} ,2020-01-{i % 28 + 1:02d},2020-01-01 10:{i:02d}:00,{'True' if i % 2 else 'false'},t{i},{i}12345678901234567890,,"
                     f"{'n/a' if i % 4 else i}")
    df = read_profiled(spark, _write(tmp_path, "a.csv", lines))
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    assert kinds == {"code": "string", "plain": "bigint", "bmi": "double", "whole": "bigint", "day": "date", "stamp": "timestamp_ntz",
                     "flag": "boolean", "text": "string", "wide": "string", "blank": "string", "mixed": "string"}
    rows = sorted(df.collect(), key=lambda r: r.plain)
    assert rows[7].code == "0007" and rows[7].bmi is None and rows[8].bmi == 20.8 and rows[8].whole == 3
    assert rows[3].day == datetime.date(2020, 1, 4) and rows[3].flag is True
    assert rows[1].mixed == "n/a"  # three quarters are marks: no gaps between numbers


def test_a_bad_day_is_no_date(spark):
    df = spark.createDataFrame([("2020-02-30", "1e5", "9" * 18), ("2020-02-01", "-.5", "9" * 19), (None, "NaN", None)], "a string, b string, c string")
    assert inferred_types(column_profile(df)) == {"a": "string", "b": "double", "c": "string"}
    assert inferred_types(column_profile(df.limit(0))) == {"a": "string", "b": "string", "c": "string"}


def test_the_profile_reads_the_file_once(spark, tmp_path):
    path = _write(tmp_path, "a.csv", ["x,y"] + [f"{i},{i}" for i in range(10)])
    plan = column_profile(spark.read.option("header", True).csv(path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("partial_") > 0


SCHEMA = T.StructType([T.StructField("id", T.IntegerType(), False), T.StructField("v", T.DoubleType()), T.StructField("name", T.StringType())])


def test_quarantine_by_file_and_line(spark, tmp_path):
    a = ["id,v,name", "1,1.5,a", "2,x,b", "", "3,,c", ",4,d", "5,5", "6,6,f,g", 'seven,7,"h, i"', '8,8,"j, k"']
    b = ["id,v,name"] + [f"{i},{i / 2},n{i}" if i % 97 else f"{i},?,n{i}" for i in range(100, 900)] + ["id,v,name"]
    _write(tmp_path, "a.csv", a)
    path = _write(tmp_path, "b.csv", b)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "900")  # several splits a file
    try:
        good, bad = read_checked(spark, path, SCHEMA)
        kept, wrong = good.collect(), bad.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = {("a.csv", 3, "v is no double", "2,x,b"), ("a.csv", 6, "id is missing", ",4,d"), ("a.csv", 7, "fields", "5,5"),
            ("a.csv", 8, "fields", "6,6,f,g"), ("a.csv", 9, "id is no int", 'seven,7,"h, i"'), ("b.csv", len(b), "header", "id,v,name")}
    want |= {("b.csv", i - 100 + 2, "v is no double", f"{i},?,n{i}") for i in range(100, 900) if i % 97 == 0}
    assert {(r.file.rsplit("/", 1)[1], r.line, r.reason, r.text) for r in wrong} == want and len(wrong) == len(want)
    assert {(r.id, r.v, r.name) for r in kept} == {(1, 1.5, "a"), (3, None, "c"), (8, 8.0, "j, k")} | {
        (i, i / 2, f"n{i}") for i in range(100, 900) if i % 97}
    assert good.schema.names == SCHEMA.names


def test_a_file_without_its_header_is_refused(spark, tmp_path):
    path = _write(tmp_path, "a.csv", ["1,1,a", "2,2,b"])
    with pytest.raises(ValueError, match="is not the header"):
        read_checked(spark, path, SCHEMA)
    good, bad = read_checked(spark, path, SCHEMA, header=False)
    assert good.count() == 2 and bad.count() == 0


def test_probes_run_no_job_of_their_own(spark, tmp_path):
    orders, customer = table(spark, SF01, "orders"), table(spark, SF01, "customer")
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey)
    tracker, context = spark.sparkContext.statusTracker(), spark.sparkContext

    def jobs(group, df):
        context.setJobGroup(group, group)
        df.write.parquet(str(tmp_path / group))
        context.setLocalProperty("spark.jobGroup.id", None)
        return len(tracker.getJobIdsForGroup(group))

    plain = jobs("plain", joined)
    o, first = observe_size(orders, "orders")
    c, second = observe_size(customer, "customer")
    j, third = observe_size(o.join(c, o.o_custkey == c.c_custkey), "joined")
    assert jobs("probed", j) == plain
    got = {r.step: (r.n_rows, r.n_bytes) for r in observed_sizes(spark, {"orders": first, "customer": second, "joined": third}).collect()}
    assert got == {name: tuple(table_size(df).first()) for name, df in {"orders": orders, "customer": customer, "joined": joined}.items()}


def test_an_empty_frame_is_observed(spark):
    df, probe = observe_size(spark.range(10).where(F.col("id") < 0), "none")
    assert df.count() == 0 and probe.get == {"n_rows": 0, "n_bytes": 0}
