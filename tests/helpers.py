"""Helpers of the tests."""

from __future__ import annotations


def values(df, *columns, order=None):
    rows = df.orderBy(*(order or ())).collect() if order else df.collect()
    names = columns or df.columns
    return [r[names[0]] if len(names) == 1 else tuple(r[c] for c in names) for r in rows]
