from __future__ import annotations


def rows(df):
    """Rows as plain tuples, in an order that does not depend on the plan."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


def values(spark, texts):
    """A frame of messages."""
    return spark.createDataFrame([(t,) for t in texts], "value string")
