"""Exact percentiles and ranks from counted values.

A percentile aggregate keeps every value of a group in one buffer, a rank
window sorts a whole group in one task. Here equal values are counted first
(reduced on every map task); what is left per group is one row for each
different value, and running counts over these give places.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

c = F.col


def counted(df: DataFrame, group: list[str], value: str | Column, name: str = "_v") -> DataFrame:
    """``group, _v, _n``: how often each value occurs in a group; NULLs do not count."""
    v = c(value) if isinstance(value, str) else value
    return df.select(*group, v.alias(name)).filter(c(name).isNotNull()).groupBy(*group, name).agg(F.count(F.lit(1)).alias("_n"))


def running_counts(counts: DataFrame, group: list[str], parts: int = 1) -> DataFrame:
    """``counts`` with ``_before`` (rows of the group with smaller values) and
    ``_total``. With ``parts`` > 1 the values of a group are dealt by size over
    that many ranges: the counts of whole ranges, a few rows a group, are summed
    first, so no task sorts more than one range of a group."""
    if parts == 1:
        by = Window.partitionBy(*group)
        run = by.orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return counts.withColumn("_before", F.sum("_n").over(run) - c("_n")).withColumn("_total", F.sum("_n").over(by))
    v = c("_v").cast("double")
    finite = F.when(F.abs(v) < float("inf"), v)
    span = counts.groupBy(*group).agg(F.min(finite).alias("_lo"), F.max(finite).alias("_hi"))
    same = reduce(lambda a, b: a & b, [c(f"a.{g}").eqNullSafe(c(f"b.{g}")) for g in group])
    width = c("_hi") - c("_lo")
    part = (F.when(v == float("-inf"), 0).when(v == float("inf"), parts - 1)
            .when(width > 0, F.least(F.floor((v - c("_lo")) / width * parts), F.lit(parts - 1))).otherwise(0))
    ranged = (counts.alias("a").join(span.alias("b"), same).select("a.*", "_lo", "_hi").withColumn("_part", part.cast("int"))
              .drop("_lo", "_hi"))
    sums = ranged.groupBy(*group, "_part").agg(F.sum("_n").alias("_s"))
    by = Window.partitionBy(*group)
    sums = sums.withColumn("_base", F.sum("_s").over(by.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow))
                           - c("_s")).withColumn("_total", F.sum("_s").over(by)).drop("_s")
    inside = Window.partitionBy(*group, "_part").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranged = ranged.withColumn("_before", F.sum("_n").over(inside) - c("_n"))
    same = same & (c("a._part") == c("b._part"))
    return (ranged.alias("a").join(sums.alias("b"), same).select("a.*", "_base", "_total")
            .withColumn("_before", c("_before") + c("_base")).drop("_base", "_part"))


def percentiles(running: DataFrame, group: list[str], wanted: dict[str, float]) -> DataFrame:
    """``group`` and each wanted percentile, interpolated between the two
    values around its place."""
    out = []
    for name, p in wanted.items():
        place = (c("_total") - 1) * F.lit(p)
        for part, at in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            here = (c("_before") <= at) & (at < c("_before") + c("_n"))
            out.append(F.max(F.when(here, c("_v").cast("double"))).alias(f"_{part}_{name}"))
    got = running.groupBy(*group).agg(F.max("_total").alias("_total"), *out)
    cols = []
    for name, p in wanted.items():
        place = (c("_total") - 1) * F.lit(p)
        lo, hi = c(f"_lo_{name}"), c(f"_hi_{name}")
        between = (F.ceil(place) - place) * lo + (place - F.floor(place)) * hi
        cols.append(F.when(lo == hi, lo).otherwise(between).alias(name))
    return got.select(*group, *cols)


def grouped_percentiles(df: DataFrame, group: list[str], wanted: dict[str, tuple[str | Column, float]], parts: int = 1) -> DataFrame:
    """``group`` and each percentile ``name -> (value, p)`` of ``df``."""
    by_value: dict[str, tuple] = {}
    for name, (value, p) in wanted.items():
        by_value.setdefault(str(value), (value, {}))[1][name] = p
    out = None
    for value, ps in by_value.values():
        one = percentiles(running_counts(counted(df, group, value), group, parts), group, ps)
        if out is None:
            out = one
            continue
        same = reduce(lambda a, b: a & b, [c(f"a.{g}").eqNullSafe(c(f"b.{g}")) for g in group])
        keys = [F.coalesce(c(f"a.{g}"), c(f"b.{g}")).alias(g) for g in group]
        rest = [x for x in [*out.columns, *one.columns] if x not in group]
        out = out.alias("a").join(one.alias("b"), same, "full").select(*keys, *rest)
    return out


def percent_ranks(df: DataFrame, group: list[str], wanted: dict[str, tuple[str, bool]], parts: int = 64) -> DataFrame:
    """``df`` with percent ranks in its groups, ``name -> (number column,
    descending)``: rows before a value over all other rows, 0 in a group of one.
    NULLs come last, with ``descending`` first.

    A rank is read from the counted values of the group, which are dealt by
    size over ``parts`` ranges; so a task sorts the different values of one
    range and never the rows of a group. ``df`` is read once a column and once
    more: pass a written table, or a cheap one."""
    keys = {name: F.coalesce(-c(v).cast("double"), F.lit(float("-inf"))) if desc else
            F.coalesce(c(v).cast("double"), F.lit(float("inf"))) for name, (v, desc) in wanted.items()}
    out = df.withColumns({f"_key_{name}": key for name, key in keys.items()})
    same = reduce(lambda a, b: a & b, [c(f"a.{g}").eqNullSafe(c(f"b.{g}")) for g in group])
    for name, key in keys.items():
        places = running_counts(counted(df, group, key), group, parts)
        rank = F.when(c("_total") > 1, c("_before") / (c("_total") - 1)).otherwise(0.0)
        places = places.select(*group, "_v", rank.alias(name))
        out = out.alias("a").join(places.alias("b"), same & (c(f"a._key_{name}") == c("b._v")), "left").select("a.*", f"b.{name}")
    return out.drop(*(f"_key_{name}" for name in keys))


def grouped_summary(df: DataFrame, group: list[str], plain: dict[str, tuple[str, str | Column]],
                    distinct: dict[str, tuple[str, Column | None]] | None = None,
                    percentile: dict[str, tuple[str | Column, float]] | None = None) -> DataFrame:
    """Sums, distinct counts and percentiles of groups in one pass over ``df``.

    ``plain``: name -> (sum | count | min | max, column). ``distinct``: name ->
    (id column, condition or None): the ids of rows that meet the condition.
    ``percentile``: name -> (value, p).

    Rows are first reduced by group, ids and values (on the map side too), with
    all conditions of an id as one bit mask. What is left is dealt by group
    once; an id counts at its first row, with the mask of all its rows, and
    running counts in the order of a value give the places of percentiles. So
    no row is repeated for a distinct count and no aggregate buffers values."""
    distinct, percentile = distinct or {}, percentile or {}
    ids: dict[str, list[tuple[str, Column | None]]] = {}
    for name, (key, when) in distinct.items():
        ids.setdefault(key, []).append((name, when))
    values: dict[str, tuple[str | Column, dict[str, float]]] = {}
    for name, (value, p) in percentile.items():
        values.setdefault(str(value), (value, {}))[1][name] = p
    fold = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}
    cols, first = [c(g) for g in group], []
    for i, (key, conditions) in enumerate(ids.items()):
        mask = reduce(lambda a, b: a + b, [F.when(F.lit(True) if w is None else w, 1 << k).otherwise(0) for k, (_, w) in enumerate(conditions)])
        cols += [c(key).alias(f"_id{i}"), mask.alias(f"_mask{i}")]
        first.append(F.bit_or(f"_mask{i}").alias(f"_mask{i}"))
    for i, (value, _) in enumerate(values.values()):
        cols.append((c(value) if isinstance(value, str) else value).alias(f"_v{i}"))
        first.append(F.count(f"_v{i}").alias(f"_n{i}"))
    for i, (name, (how, value)) in enumerate(plain.items()):
        cols.append((c(value) if isinstance(value, str) else value).alias(f"_p{i}"))
        first.append((F.count if how == "count" else fold[how])(f"_p{i}").alias(name))
    keys = [*group, *(f"_id{i}" for i in range(len(ids))), *(f"_v{i}" for i in range(len(values)))]
    rows = df.select(*cols).groupBy(*keys).agg(*first)
    by = Window.partitionBy(*group)
    for i in range(len(ids)):
        one = Window.partitionBy(*group, f"_id{i}")
        rows = rows.withColumn(f"_first{i}", (F.row_number().over(one.orderBy(f"_id{i}")) == 1) & c(f"_id{i}").isNotNull()).withColumn(
            f"_mask{i}", F.bit_or(f"_mask{i}").over(one))
    for i in range(len(values)):
        run = by.orderBy(f"_v{i}").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        rows = (rows.withColumn(f"_before{i}", F.sum(f"_n{i}").over(run) - c(f"_n{i}"))
                .withColumn(f"_total{i}", F.sum(f"_n{i}").over(by)))
    aggs = [fold[how](name).alias(name) for name, (how, _) in plain.items()]
    for i, conditions in enumerate(ids.values()):
        aggs += [F.count_if(c(f"_first{i}") & (F.getbit(f"_mask{i}", F.lit(k)) == 1)).alias(name) for k, (name, _) in enumerate(conditions)]
    for i, (_, ps) in enumerate(values.values()):
        for name, p in ps.items():
            place = (c(f"_total{i}") - 1) * F.lit(p)
            for part, at in (("lo", F.floor(place)), ("hi", F.ceil(place))):
                here = (c(f"_before{i}") <= at) & (at < c(f"_before{i}") + c(f"_n{i}"))
                aggs.append(F.max(F.when(here, c(f"_v{i}").cast("double"))).alias(f"_{part}_{name}"))
            aggs.append(F.max(place).alias(f"_at_{name}"))
    out = rows.groupBy(*group).agg(*aggs)
    final = [*group, *plain, *distinct]
    for name in percentile:
        lo, hi, at = c(f"_lo_{name}"), c(f"_hi_{name}"), c(f"_at_{name}")
        final.append(F.when(lo == hi, lo).otherwise((F.ceil(at) - at) * lo + (at - F.floor(at)) * hi).alias(name))
    return out.select(*final)
