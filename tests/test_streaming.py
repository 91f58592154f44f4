import os
import tempfile
import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinlake.operators.relate import conditional_counts, group_count
from clinlake.streaming import read_delimited_stream, run_available

SCHEMA = T.StructType([T.StructField("DRUG_TYPE", T.StringType()), T.StructField("VALUE", T.DoubleType())])


def _name():
    return f"test-{uuid.uuid4().hex}"


def test_stream_group_count_matches_batch(spark):
    d = tempfile.mkdtemp(prefix="clinlake-stream-", dir="/tmp")
    for i, body in enumerate(["MAIN,1.0\nBASE,2.0\nMAIN,300\n", "ADDITIVE,5\nMAIN,250\n"]):
        with open(os.path.join(d, f"f{i}.csv"), "w") as f:
            f.write("DRUG_TYPE,VALUE\n" + body)
    stream = read_delimited_stream(spark, d, SCHEMA)
    run_available(group_count(stream, "DRUG_TYPE"), _name(), query_name="drug_counts")
    got = {r.DRUG_TYPE: r.n for r in spark.table("drug_counts").collect()}
    assert got == {"MAIN": 3, "BASE": 1, "ADDITIVE": 1}
    run_available(conditional_counts(stream, {"high": F.col("VALUE") >= 200}), _name(), query_name="high_counts")
    assert spark.table("high_counts").first().high == 2


def test_stream_rows_to_parquet_sink(spark):
    from clinlake.session import derived_path
    d = tempfile.mkdtemp(prefix="clinlake-stream-", dir="/tmp")
    with open(os.path.join(d, "f0.csv"), "w") as f:
        f.write("DRUG_TYPE,VALUE\nMAIN,1.0\nBASE,250\n")
    stream = read_delimited_stream(spark, d, SCHEMA).where(F.col("VALUE") >= 200)
    out = derived_path(spark, "stream-out")
    name = _name()
    run_available(stream, name, sink_path=out, output_mode="append", fmt="parquet")
    assert [tuple(r) for r in spark.read.parquet(out).collect()] == [("BASE", 250.0)]
    # A file that arrives between two runs is picked up by the second, and only that one.
    with open(os.path.join(d, "f1.csv"), "w") as f:
        f.write("DRUG_TYPE,VALUE\nADDITIVE,300\n")
    again = read_delimited_stream(spark, d, SCHEMA).where(F.col("VALUE") >= 200)
    run_available(again, name, sink_path=out, output_mode="append", fmt="parquet")
    assert sorted(tuple(r) for r in spark.read.parquet(out).collect()) == [("ADDITIVE", 300.0), ("BASE", 250.0)]
