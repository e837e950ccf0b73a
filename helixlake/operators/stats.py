"""Statistics: contingency tables, exact and chi-squared tests, Poisson trends."""

from __future__ import annotations

from math import erfc, exp, lgamma, sqrt

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def contingency(rows: DataFrame, category: str, lineage: Column) -> DataFrame:
    """category, a, b, c, d: rows of the category and of others, in the lineage (a, c) and out of it (b, d).

    A null lineage counts as another one. The totals of all rows come from sums over the categories, so the rows are read once.
    """
    mine = F.coalesce(lineage, F.lit(False))
    per = rows.groupBy(category).agg(F.count_if(mine).alias("a"), F.count_if(~mine).alias("b"))
    total = per.agg(F.sum("a").alias("ta"), F.sum("b").alias("tb")).first()
    ta, tb = total["ta"] or 0, total["tb"] or 0
    out = per.select(category, "a", "b", (F.lit(ta) - F.col("a")).alias("c"), (F.lit(tb) - F.col("b")).alias("d"))
    return out.where("a + b > 0 and c + d > 0 and a + c > 0 and b + d > 0")


def fisher(a: int, b: int, c: int, d: int) -> float:
    """Two-sided exact p: the probability of all tables with these margins that aren't likelier than this one."""
    n, row, col = a + b + c + d, a + b, a + c
    choose = lambda m, k: lgamma(m + 1) - lgamma(k + 1) - lgamma(m - k + 1)
    log = lambda k: choose(row, k) + choose(n - row, col - k) - choose(n, col)
    seen = log(a)
    return min(1.0, sum(exp(x) for k in range(max(0, col - (n - row)), min(row, col) + 1) if (x := log(k)) <= seen + 1e-7))


def chi_squared(a: int, b: int, c: int, d: int) -> float:
    """p of the chi-squared test with continuity correction; for one degree of freedom it is erfc(sqrt(x / 2))."""
    n = a + b + c + d
    cut = min(abs(a * d - b * c), n / 2)
    return erfc(sqrt(n * (abs(a * d - b * c) - cut) ** 2 / ((a + b) * (c + d) * (a + c) * (b + d)) / 2))


def association_test(tables: DataFrame, lineages: int, least: int = 5) -> DataFrame:
    """tables + test, p: Fisher's below 30 rows or with a cell below 5, else chi-squared. A few rows of counts, in Arrow batches.

    Nothing is tested of fewer than two lineages, nor a table of fewer than `least` rows.
    """
    tables = tables.where((F.col("a") + F.col("b") + F.col("c") + F.col("d") >= least) & F.lit(lineages >= 2))

    def run(batches):
        for t in batches:
            exact = (t[["a", "b", "c", "d"]].sum(axis=1) < 30) | (t[["a", "b", "c", "d"]].min(axis=1) < 5)
            p = [fisher(*map(int, x)) if e else chi_squared(*map(int, x)) for e, x in zip(exact, t[["a", "b", "c", "d"]].to_numpy(), strict=True)]
            yield t.assign(test=["fisher" if e else "chi_squared" for e in exact], p=pd.Series(p, index=t.index, dtype=float))

    fields = ", ".join(f"{n} {k}" for n, k in tables.dtypes)
    return tables.mapInPandas(run, f"{fields}, test string, p double")


def poisson_trend(counts: DataFrame, group: str, year: str = "year", n: str = "n", least: int = 3, steps: int = 30) -> DataFrame:
    """group, slope, p: log-linear trend of counts by year, for groups of at least `least` years.

    Maximum likelihood by Newton steps on each group's few yearly counts; p by the slope's Wald statistic.
    """

    def fit(g: pd.DataFrame) -> pd.DataFrame:
        import numpy as np

        x = g[year].to_numpy(float)
        y = g[n].to_numpy(float)
        x = np.stack([np.ones_like(x), x - x.mean()], axis=1)
        beta = np.array([np.log(max(y.mean(), 1e-9)), 0.0])
        for _ in range(steps):
            mu = np.exp(np.clip(x @ beta, -30, 30))
            info = (x * mu[:, None]).T @ x
            step = np.linalg.solve(info, x.T @ (y - mu))
            beta = beta + step
            if np.abs(step).max() < 1e-10:
                break
        z = beta[1] / np.sqrt(np.linalg.inv((x * np.exp(x @ beta)[:, None]).T @ x)[1, 1])
        return pd.DataFrame({group: [g[group].iloc[0]], "slope": [round(float(beta[1]), 6)], "p": [round(float(erfc(abs(z) / sqrt(2))), 6)]})

    enough = counts.groupBy(group).agg(F.count(F.lit(1)).alias("k"), F.sum(n).alias("t")).where((F.col("k") >= least) & (F.col("t") > 0)).select(group)
    kind = dict(counts.dtypes)[group]
    return counts.select(group, year, n).join(enough, group, "left_semi").groupBy(group).applyInPandas(fit, f"{group} {kind}, slope double, p double")
