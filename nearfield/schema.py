"""Schemas and keys of the two tables."""

from pyspark.sql import types as T

# Table columns and keys.
HITS = T.StructType(
    [
        T.StructField("observationgroup", T.IntegerType()),
        T.StructField("observationorder", T.IntegerType()),
        T.StructField("frequency", T.DoubleType()),
        T.StructField("snr", T.DoubleType()),
        T.StructField("driftrate", T.DoubleType()),
        T.StructField("uncorrectedfrequency", T.DoubleType()),
    ]
)

GROUPS = T.StructType(
    [
        T.StructField("observationgroup", T.IntegerType()),
        T.StructField("grouphit", T.IntegerType()),
        T.StructField("source", T.StringType()),
        T.StructField("mjd", T.DoubleType()),
        T.StructField("ra", T.StringType()),
        T.StructField("dec", T.StringType()),
        T.StructField("filename1", T.StringType()),
        T.StructField("filename2", T.StringType()),
        T.StructField("filename3", T.StringType()),
        T.StructField("filename4", T.StringType()),
        T.StructField("filename5", T.StringType()),
        T.StructField("filename6", T.StringType()),
    ]
)

HIT_KEY = ["observationgroup", "observationorder", "snr", "driftrate", "frequency"]
GROUP_KEY = ["observationgroup"]
