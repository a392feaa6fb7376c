from collections import Counter


def rows(df):
    """Rows as a multiset of tuples."""
    return Counter(tuple(r) for r in df.collect())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
