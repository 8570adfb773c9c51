"""Exact quantiles per group in two scans, any number of columns at once.

Scan 1 aggregates, per group and column, the number of values and a coarse sketch
(``percentile_approx``), from which each quantile gets a window of values: bounds whose
ranks enclose the wanted ones by the sketch's error guarantee. Scan 2 counts what lies
below each window and the distinct values inside it; partial aggregation makes the former
one row a group and task. The few values inside (about 8 n / accuracy) are then walked
by running count. No buffer grows with the values' type or range; ties are one row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ACCURACY = 10_000


def _distances(accuracy: int) -> list[tuple[float, int]]:
    """(d, least n): the sketch's values at p - d and p + d enclose the ranks of quantile p
    once d * n >= 4, that is one rank for rounding at either end, and the sketch's error,
    n / accuracy, is at most a quarter of d * n (below ``accuracy`` values it has none)."""
    out, d = [], 0.25
    while d > 4 / accuracy:
        out.append((d, int(4 / d)))
        d /= 8
    return [*out, (4 / accuracy, accuracy)]


def exact_quantiles(df: DataFrame, keys: list[str], columns: dict[str, Column], probs: list[float],
                    more: dict[str, Column] | None = None, accuracy: int = ACCURACY) -> DataFrame:
    """Per group of ``keys`` (one at least): for every name in ``columns`` an array of its
    interpolated quantiles at ``probs`` over the non-null values (null elements without
    any), and the numeric aggregates ``more``, taken in the first scan."""
    keys, more, values = list(keys), more or {}, list(columns.values())
    steps = _distances(accuracy)
    low = lambda p, d: max(0.0, p - d)
    high = lambda p, d: min(1.0, p + d)
    asked = sorted({0.0, 1.0} | {f(p, d) for p in probs for d, _ in steps for f in (low, high)})
    aggs = [c.alias(f"_m{k}") for k, c in enumerate(more.values())]
    for i, v in enumerate(values):
        aggs += [F.count(v).alias(f"_n{i}"), F.percentile_approx(v, asked, accuracy).alias(f"_q{i}")]

    def bound(i: int, p: float, side) -> Column:
        at = lambda x: F.col(f"_q{i}")[asked.index(x)]
        return reduce(lambda out, s: F.when(F.col(f"_n{i}") >= s[1], at(side(p, s[0]))).otherwise(out), steps, at(side(p, 1.0)))

    places = [(i, p) for i in range(len(values)) for p in probs]
    kept = [f"_n{i}" for i in range(len(values))] + [f"_m{k}" for k in range(len(more))]
    first = df.groupBy(*keys).agg(*aggs).select(
        *[F.col(k).alias(f"_k{n}") for n, k in enumerate(keys)], *kept,
        *[bound(i, p, side).alias(f"_{name}{at}") for at, (i, p) in enumerate(places) for name, side in (("low", low), ("high", high))])
    rows = df.select(*keys, *[v.alias(f"_v{i}") for i, v in enumerate(values)])
    j = rows.join(first, reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{n}")) for n, k in enumerate(keys)]))
    # A value is counted with every window it is in (as itself) or below (as null); place -1
    # keeps groups without values.
    seen = [F.when(F.col(f"_v{i}") <= F.col(f"_high{at}"), F.struct(
        F.lit(at).alias("at"), F.when(F.col(f"_v{i}") >= F.col(f"_low{at}"), F.col(f"_v{i}").cast("double")).alias("v")))
        for at, (i, _) in enumerate(places)]
    seen.append(F.struct(F.lit(-1).alias("at"), F.lit(None).cast("double").alias("v")))
    counted = (j.select(*keys, *kept, F.explode(F.filter(F.array(*seen), lambda x: x.isNotNull())).alias("s"))
               .groupBy(*keys, "s.at", "s.v").agg(F.count(F.lit(1)).alias("_c"), *[F.first(c).alias(c) for c in kept]))
    walk = Window.partitionBy(*keys, "at").orderBy(F.col("v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    n = F.coalesce(*[F.when(F.col("at") == at, F.col(f"_n{i}")) for at, (i, _) in enumerate(places)])
    prob = F.coalesce(*[F.when(F.col("at") == at, F.lit(float(p))) for at, (_, p) in enumerate(places)])
    ranked = counted.withColumn("_upto", F.sum("_c").over(walk)).withColumn("_pos", (n - 1) * prob)
    at_rank = lambda r: F.min(F.when(F.col("_upto") > r, F.col("v")))  # noqa: E731  (min skips the null below the window)
    part = F.col("_pos") - F.floor("_pos")
    found = ranked.groupBy(*keys, "at").agg(at_rank(F.floor("_pos")).alias("_a"), at_rank(F.ceil("_pos")).alias("_b"),
                                            F.first(part).alias("_part"), *[F.first(c).alias(c) for c in kept])
    found = found.withColumn("_x", (1 - F.col("_part")) * F.col("_a") + F.col("_part") * F.col("_b"))
    wide = found.groupBy(*keys).agg(*[F.max(F.when(F.col("at") == at, F.col("_x"))).alias(f"_x{at}") for at in range(len(places))],
                                    *[F.first(c).alias(c) for c in kept])
    arrays = [F.array(*[F.col(f"_x{at}") for at, (k, _) in enumerate(places) if k == i]).alias(name) for i, name in enumerate(columns)]
    return wide.select(*keys, *arrays, *[F.col(f"_m{k}").alias(name) for k, name in enumerate(more)])
