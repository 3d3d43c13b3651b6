"""Frames of lines, for the cleaners' tests."""


def lines_df(spark, lines):
    return spark.createDataFrame([(v,) for v in lines], "value string")
