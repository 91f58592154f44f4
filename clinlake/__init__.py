"""clinlake: cohort and risk-model analytics on Spark DataFrames.

Every operator is a plain function over DataFrames (or a fitted Spark ML
model).  All work is declared with the DataFrame API so Catalyst and AQE
choose the physical plan; no Python UDFs, no driver-side copies of data.

Sub-packages
------------
sources     delimited and label-first matrix readers
functions   column expressions (casts, buckets, hashes, rounding)
operators   relational, cleaning, imputation, features, splits, models,
            metrics and profiling operators
plans       the end-to-end workloads and the query registry
streaming   incremental variants of the scan/count operators
"""

__version__ = "0.1.0"
