"""Global ranks, tiles and places without a single-partition sort.

Rows are counted by value first, so a frequent value is one row from there on. The counts are stored in ranges
of the values' order (Spark samples the splitters), each range with its number. How many rows lie before a value is
then what lies before it within its range, plus the sum of the ranges before; there are as many of these sums as
ranges. Ranges are of a bounded size, whatever the distribution, for a counted value occurs once.

Counting and storing run while a query is built; what is returned joins the ranks to the rows, which so are
derived twice in all.
"""

from __future__ import annotations

from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import stored

_FIRST, _LAST = Window.unboundedPreceding, -1


def _same(columns: tuple[str, ...], prefix: str) -> Column:
    """Equality of columns with their prefixed namesakes; nulls are equal."""
    return reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"{prefix}{c}")) for c in columns))


def ordering(by: tuple[str, ...], descending: bool) -> list[Column]:
    """The first column in the direction asked for, the others ascending; nulls last."""
    first = F.col(by[0]).desc_nulls_last() if descending else F.col(by[0]).asc_nulls_last()
    return [first, *(F.col(c).asc_nulls_last() for c in by[1:])]


def ranged(counts: DataFrame, within: tuple[str, ...], by: tuple[str, ...], descending: bool) -> DataFrame:
    """``counts`` stored in ranges by group and value, with the range's number as __part."""
    dealt = counts.repartitionByRange(*(F.col(c).asc_nulls_first() for c in within), *ordering(by, descending))
    return stored(dealt.withColumn("__part", F.spark_partition_id()), "ranges")


def _offsets(parts: DataFrame, within: tuple[str, ...]) -> DataFrame:
    """Rows of a group in the ranges before, where there are any: fewer rows than ranges, for only a group that
    goes on from one range to the next has them."""
    sums = parts.groupBy(*within, "__part").agg(F.sum("n").alias("__n"))
    if within:
        earlier = Window.partitionBy(*within).orderBy("__part").rowsBetween(_FIRST, _LAST)
        return sums.select(*within, "__part", F.sum("__n").over(earlier).alias("__offset")).where("__offset > 0")
    found = sorted(sums.collect())  # a row for each range
    upto = accumulate((r["__n"] for r in found), initial=0)
    return parts.sparkSession.createDataFrame([(r["__part"], n) for r, n in zip(found, upto, strict=False)], "__part int, __offset bigint")


def with_before(counts: DataFrame, within: tuple[str, ...], by: tuple[str, ...], descending: bool = False) -> DataFrame:
    """counts (within, by, n; each value of a group once) with __before, the rows of earlier values of the group; nulls
    are the last value."""
    parts = ranged(counts, within, by, descending)
    keys = (*within, "__part")
    offsets = _offsets(parts, within).withColumnsRenamed({c: f"__o_{c}" for c in keys})
    own = Window.partitionBy(*keys).orderBy(*ordering(by, descending)).rowsBetween(_FIRST, _LAST)
    placed = parts.withColumn("__own", F.coalesce(F.sum("n").over(own), F.lit(0))).join(F.broadcast(offsets), _same(keys, "__o_"), "left")
    return placed.withColumn("__before", F.col("__own") + F.coalesce("__offset", F.lit(0))).select(*counts.columns, "__before")


def _counted(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def value_counts(df: DataFrame, *keys: str) -> DataFrame:
    """keys and n, stored: what ranks and sums by value can share."""
    return stored(_counted(df, *keys), "counted-values")


def with_ranks(df: DataFrame, by: str, outs: dict[str, tuple[str, ...]], counted: DataFrame | None = None) -> DataFrame:
    """df with RANK() OVER (PARTITION BY within ORDER BY by DESC NULLS LAST) for each out: within, for groups
    of any size. Rows are counted once for all ranks; ``counted`` is value_counts of all groups and the value."""
    groups = tuple(dict.fromkeys(c for within in outs.values() for c in within))
    if counted is None:
        counted = value_counts(df, *groups, by) if len(outs) > 1 else _counted(df, *groups, by)
    ranks = None
    for out, within in sorted(outs.items(), key=lambda x: -len(x[1])):
        sums = counted if set(within) == set(groups) else counted.groupBy(*within, by).agg(F.sum("n").alias("n"))
        one = with_before(sums, within, (by,), True).select(*within, by, (F.col("__before") + 1).cast("int").alias(out))
        if ranks is None:
            ranks = one if set(within) == set(groups) else counted.drop("n")
        if out not in ranks.columns:
            keys = (*within, by)
            ranks = ranks.join(one.withColumnsRenamed({c: f"__r_{c}" for c in keys}), _same(keys, "__r_")).drop(*(f"__r_{c}" for c in keys))
    keys = (*groups, by)
    return df.join(ranks.withColumnsRenamed({c: f"__k_{c}" for c in keys}), _same(keys, "__k_")).drop(*(f"__k_{c}" for c in keys)).select(*df.columns, *outs)


def with_rank(df: DataFrame, by: str, out: str, within: tuple[str, ...] = ()) -> DataFrame:
    return with_ranks(df, by, {out: within})


def with_place(df: DataFrame, within: tuple[str, ...], by: tuple[str, ...], out: str, descending: bool = False) -> DataFrame:
    """df with the place (from 0) of each row of its group in the order of ``by``, which tells the rows of a
    group apart; rows that are equal in it share the first one's place."""
    places = with_before(_counted(df, *within, *by), within, by, descending).select(*within, *by, F.col("__before").alias(out))
    keys = (*within, *by)
    return df.join(places.withColumnsRenamed({c: f"__p_{c}" for c in keys}), _same(keys, "__p_")).drop(*(f"__p_{c}" for c in keys))


def numbered(df: DataFrame, within: tuple[str, ...], by: tuple[str, ...], out: str, descending: bool = False) -> DataFrame:
    """The other columns of df, and the number (from 0) of each row of its group in the order of ``by``; rows that are equal in it
    are in any order. Rows are stored in ranges of that order, so they are sorted once and not joined."""
    dealt = df.repartitionByRange(*(F.col(c).asc_nulls_first() for c in within), *ordering(by, descending))
    dealt = dealt.sortWithinPartitions(*(F.col(c).asc_nulls_first() for c in within), *ordering(by, descending))
    kept = [c for c in df.columns if c not in by or c in within]
    rows = stored(dealt.select(*kept, F.spark_partition_id().alias("__part"), F.monotonically_increasing_id().alias("__nth")), "numbered-rows")
    keys = (*within, "__part")
    parts = rows.groupBy(*keys).agg(F.min("__nth").alias("__first"), F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy(*within).orderBy("__part").rowsBetween(_FIRST, _LAST)), F.lit(0))
    parts = parts.withColumn("__from", before - F.col("__first")).drop("n", "__first").withColumnsRenamed({c: f"__n_{c}" for c in keys})  # a row for a range and group
    return rows.join(F.broadcast(parts), _same(keys, "__n_")).select(*kept, (F.col("__nth") + F.col("__from")).alias(out))


def with_ntile(df: DataFrame, n: int, by: str, tiebreak: str, out: str) -> DataFrame:
    """NTILE(n) OVER (ORDER BY by NULLS LAST, tiebreak): the first count % n tiles have one row more.

    Most values have all their rows in one tile. Rows of the at most n - 1 values that lie across a border are placed
    by the tiebreak, again in ranges, so a value may be as frequent as it likes. Of rows that are equal in both, any may be
    in the earlier tile; those that a border divides are numbered together.
    """
    keys = stored(df.select(by, tiebreak), "tile-keys")
    small, more = divmod(keys.count(), n)

    def tile(row: Column) -> Column:
        early = F.floor(row / (small + 1))
        return (F.when(row < more * (small + 1), early).otherwise(more + F.floor((row - more * (small + 1)) / max(small, 1))) + 1).cast("int")

    def tiled(counts: DataFrame, first: Column) -> DataFrame:
        return counts.withColumns({"__tile": tile(first), "__until": tile(first + F.col("n") - 1)})

    values = stored(tiled(with_before(_counted(keys, by), (), (by,)), F.col("__before")), "tiled-values")
    borders = values.where("__tile < __until").select(F.col(by).alias("__value"), F.col("__before").alias("__from"))  # n - 1 rows at most
    rows = df.join(values.select(F.col(by).alias("__v"), "__tile", "__until"), F.col(by).eqNullSafe(F.col("__v"))).drop("__v")
    if borders.isEmpty():
        return rows.withColumn(out, F.col("__tile")).drop("__tile", "__until")
    across = keys.join(F.broadcast(borders), F.col(by).eqNullSafe(F.col("__value"))).drop("__value")
    ids = with_before(_counted(across, by, "__from", tiebreak), (by, "__from"), (tiebreak,))
    divided = not ids.where("n > 1").isEmpty()
    ids = tiled(ids, F.col("__from") + F.col("__before")).withColumn("__first", F.col("__from") + F.col("__before"))
    named = ids.select(F.col(by).alias("__v"), F.col(tiebreak).alias("__t"), F.lit(True).alias("__of_border"), F.col("__tile").alias("__id_tile"), F.col("__until").alias("__id_until"), "__first")
    # the tiebreak is among the keys, so rows of other values are dealt out as well
    on = F.col(by).eqNullSafe(F.col("__v")) & F.col(tiebreak).eqNullSafe(F.col("__t")) & (F.col("__tile") < F.col("__until")).eqNullSafe(F.col("__of_border"))
    rows = rows.join(named, on, "left").withColumn(out, F.coalesce("__id_tile", "__tile"))
    if divided:
        both = F.col("__id_tile") < F.col("__id_until")
        order = Window.partitionBy(by, tiebreak).orderBy(F.lit(0))
        numbered = rows.where(both).withColumn(out, tile(F.col("__first") + F.row_number().over(order) - 1))
        rows = rows.where(~F.coalesce(both, F.lit(False))).unionByName(numbered)
    return rows.select(*df.columns, out)
