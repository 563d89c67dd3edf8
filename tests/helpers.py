from collections import Counter


def bag(df):
    """Rows as a multiset, columns by name."""
    cols = sorted(df.columns)
    return Counter(tuple(row) for row in df.select(*cols).collect())


def column(df, order, name):
    return [r[name] for r in df.orderBy(order).collect()]
