"""Order-free comparison of rows."""

import math


def normal(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return (0, "")
    return (1, repr(value) if isinstance(value, float) else str(value))


def rows_by_name(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(normal(r[i]) for i in order) for r in rows)


def frame_rows(df):
    return rows_by_name(df.columns, [tuple(r) for r in df.collect()])
