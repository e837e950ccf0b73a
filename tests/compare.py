"""Rows of two engines in one comparable form."""

from __future__ import annotations

import pandas as pd


def value(x) -> str:
    if x is None or x is pd.NaT or x is pd.NA:
        return "~"
    if type(x).__name__ in ("bool", "bool_"):
        return str(bool(x))
    if type(x).__name__.startswith(("float", "Decimal")):
        x = float(x)
        return "~" if x != x else str(int(x)) if x == int(x) and abs(x) < 1e15 else repr(round(x, 9))
    if hasattr(x, "isoformat"):
        return x.isoformat().removesuffix("T00:00:00")
    if hasattr(x, "__len__") and not isinstance(x, str):
        return str([value(y) for y in x])
    return str(x)


def rows(df: pd.DataFrame) -> list[tuple]:
    names = sorted(df.columns)
    return sorted(tuple(value(x) for x in r) for r in df[names].itertuples(index=False, name=None))
