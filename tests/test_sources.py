import os
import tempfile

import pytest
from pyspark.sql import types as T

from clinlake.sources import read_delimited, read_label_matrix


def _write(text):
    d = tempfile.mkdtemp(prefix="clinlake-src-", dir="/tmp")
    with open(os.path.join(d, "part.csv"), "w") as f:
        f.write(text)
    return d


def test_typed_scan_keeps_leading_zeros_inferred_loses_them(spark):
    path = _write("ICD9_CODE,SUBJECT_ID\n0845,1\n4019,2\n")
    typed = read_delimited(spark, path, T.StructType([T.StructField("ICD9_CODE", T.StringType()),
                                                      T.StructField("SUBJECT_ID", T.IntegerType())]))
    assert [r.ICD9_CODE for r in typed.collect()] == ["0845", "4019"]
    inferred = read_delimited(spark, path, None)
    assert dict(inferred.dtypes)["ICD9_CODE"] == "int"
    assert [r.ICD9_CODE for r in inferred.collect()] == [845, 4019]


def test_label_matrix_scan(spark):
    path = _write("1,0.5,2.0,3.5\n0,1.0,1.0,1.0\n\n")
    rows = read_label_matrix(spark, path).collect()
    assert [(r.label, r.features) for r in rows] == [(1, [0.5, 2.0, 3.5]), (0, [1.0, 1.0, 1.0])]
    vec = read_label_matrix(spark, path, as_vector=True)
    assert dict(vec.dtypes)["features"] == "vector"


def test_header_names_must_be_the_schema(spark):
    path = _write("b,a\n1,2\n")
    with pytest.raises(Exception, match="(?i)header|schema"):
        read_delimited(spark, path, "a int, b int").collect()


def test_parse_mode(spark):
    path = _write("a,b\n1,x\n")
    assert [tuple(r) for r in read_delimited(spark, path, "a int, b int").collect()] == [(1, None)]
    with pytest.raises(Exception, match="MALFORMED"):
        read_delimited(spark, path, "a int, b int", mode="FAILFAST").collect()


def test_separator_is_literal(spark):
    path = _write("1|0.5|2.0\n")
    assert [(r.label, r.features) for r in read_label_matrix(spark, path, sep="|").collect()] == [(1, [0.5, 2.0])]
