"""Windows over long sequences, cut into chunks.

A window over one key runs in one task. Here a key's rows are cut into chunks of their order (time),
the window runs inside (key, chunk), and what a chunk needs from those before it comes from one summary
row per chunk. So a key with a third of all rows spreads over all tasks. `chunk` is a column that never
decreases along the order.

The rows are shuffled once, by (key, chunk). The summaries start from the same shuffle, which Spark
reuses where both sides read the same columns; the keys are packed into a struct that is never null, so
that plain equality joins null keys, too, and no filter on them parts the two sides.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The chunk of rows without a place in the order; Spark sorts nulls first.
NO_CHUNK = -(1 << 62)


def time_chunk(column: Column, size: float) -> Column:
    return F.floor(column / size).cast("bigint")


def _spread(df: DataFrame, keys: Sequence[str], chunk: str) -> DataFrame:
    """df shuffled by its keys, packed into `_key`, and its chunks."""
    rest = [c for c in df.columns if c not in keys and c != chunk]
    packed = df.select(F.struct(*keys).alias("_key"), F.coalesce(F.col(chunk), F.lit(NO_CHUNK)).alias("_at"), *rest)
    return packed.repartition("_key", "_at")


def _unpacked(df: DataFrame, keys: Sequence[str], chunk: str) -> DataFrame:
    """The columns of `_spread` under their own names again."""
    rest = [c for c in df.columns if c not in ("_key", "_at")]
    return df.select(*[F.col("_key")[k].alias(k) for k in keys], F.col("_at").alias(chunk), *rest)


def _with_summary(base: DataFrame, own: Column, combine: Callable[[Column], Callable[..., Column]], name: str, backwards: bool) -> DataFrame:
    """base with column `name`: `combine` over the summaries `own` of the chunks before (or after) each row's chunk."""
    per_chunk = base.groupBy("_key", "_at").agg(own.alias("_own"))
    order = Window.partitionBy("_key").orderBy(F.col("_at").desc() if backwards else F.col("_at"))
    carried = per_chunk.select(
        F.col("_key").alias("_key_of"), F.col("_at").alias("_at_of"),
        combine(F.col("_own"))(order.rowsBetween(Window.unboundedPreceding, -1)).alias(name))
    on = (F.col("_key") == F.col("_key_of")) & (F.col("_at") == F.col("_at_of"))
    return base.join(carried, on, "left").drop("_key_of", "_at_of")


def running_all(df: DataFrame, keys: Sequence[str], chunk: str, order: Sequence[str], values: Mapping[str, tuple[Column, str]], backwards: bool = False) -> DataFrame:
    """df with, for each name in `values`, the running `sum`, `max` or `last` (last non-null) of its value up to and with each
    row; from the end with `backwards`. All values share one shuffle."""
    base = _spread(df.withColumns({f"_v_{out}": value for out, (value, _) in values.items()}), keys, chunk)
    ordered = [F.col(c).desc() if backwards else F.col(c) for c in order]
    inside = Window.partitionBy("_key", "_at").orderBy(*ordered).rowsBetween(Window.unboundedPreceding, 0)
    latest = F.min_by if backwards else F.max_by
    plain = {"sum": F.sum, "max": F.max}
    own, results = [], {}
    for out, (_, how) in values.items():
        value = F.col(f"_v_{out}")
        before = F.col("_before")[out]
        if how == "last":
            own.append(latest(value, F.when(value.isNotNull(), F.struct(*order))).alias(out))
            results[out] = F.coalesce(F.last(value, ignorenulls=True).over(inside), before)
        else:
            own.append(plain[how](value).alias(out))
            here = plain[how](value).over(inside)
            results[out] = F.coalesce(before, F.lit(0)) + here if how == "sum" else F.greatest(before, here)

    def combine(summary: Column) -> Callable[..., Column]:
        def over(window) -> Column:
            parts = [F.last(summary[out], ignorenulls=True) if how == "last" else plain[how](summary[out]) for out, (_, how) in values.items()]
            return F.struct(*[part.over(window).alias(out) for part, out in zip(parts, values)])

        return over

    joined = _with_summary(base, F.struct(*own), combine, "_before", backwards)
    return _unpacked(joined.withColumns(results).drop("_before", *[f"_v_{out}" for out in values]), keys, chunk)


def running(df: DataFrame, keys: Sequence[str], chunk: str, order: Sequence[str], value: Column, how: str, out: str, backwards: bool = False) -> DataFrame:
    """`running_all` of one value."""
    return running_all(df, keys, chunk, order, {out: (value, how)}, backwards)


def neighbour(df: DataFrame, keys: Sequence[str], chunk: str, order: Sequence[str], columns: Sequence[str], prefix: str, following: bool = False) -> DataFrame:
    """The columns of the row before (or after) each row, as prefix + name; null where there is none, and
    `prefix + found` says whether there is one."""
    # keys are packed away, so a key column among `columns` is kept under a name of its own
    base = _spread(df.withColumn("_row", F.struct(*columns)), keys, chunk)
    inside = Window.partitionBy("_key", "_at").orderBy(*order)
    nearest = F.min_by if following else F.max_by
    joined = _with_summary(base, nearest("_row", F.struct(*order)), lambda c: F.last(c, ignorenulls=True).over, "_beyond", following)
    near = F.lead("_row").over(inside) if following else F.lag("_row").over(inside)
    joined = joined.withColumn("_near", F.coalesce(near, F.col("_beyond")))
    picked = {f"{prefix}{c}": F.col("_near")[c] for c in columns}
    found = joined.withColumns({**picked, f"{prefix}found": F.col("_near").isNotNull()}).drop("_near", "_beyond", "_row")
    return _unpacked(found, keys, chunk)
