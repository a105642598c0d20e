"""Small helpers of the tests."""

from collections import Counter


def rows(df):
    """Rows of a result as a list of tuples, in the order given."""
    return [tuple(r) for r in df.collect()]


def bag(df):
    """Rows of a result as a multiset."""
    return Counter(rows(df))


def plan(df):
    """The physical plan as text."""
    return df._jdf.queryExecution().executedPlan().toString()


def messages(spark, *texts, topic):
    """Topic records with the given JSON texts."""
    return spark.createDataFrame(
        [(bytearray(t, "utf-8"), topic) for t in texts], "value binary, topic string"
    )
