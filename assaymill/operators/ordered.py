"""Numbering, running values and neighbours over groups of any size.

A window with ``partitionBy(key)`` puts a whole group into one task, and one
without puts the whole table there. The functions here cut the sorted rows into
slices of even size instead: a window runs inside each slice, and a table with
at most two rows per slice carries results from one slice to the next.

The slices are cut at ``bounds``: quantiles of the order columns, drawn from a sample when the
frame is built and from then on constants. So the slice of a row follows from the row
alone and is the same in every pass and after a task is run again. As the rows are read several times, to
draw bounds, for the edges of the slices and inside them, they are written once and read back (``_read_often``),
whatever it took to compute them.

Order columns are names or columns, ascending with nulls first; ``descending`` turns one
around, with nulls last.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from pyspark.sql.types import NullType

from assaymill.runtime import bounded, dealt, new_scratch_path

DRAWN = 20  # sampled rows for each bound
BOUND_CHARS = 1024  # texts are cut to this length in a bound; rows that agree so far share a slice
CHUNK = 1 << 16


class Descending(NamedTuple):
    column: Column


Key = str | Column | Descending


def descending(column: str | Column) -> Descending:
    return Descending(F.col(column) if isinstance(column, str) else column)


def _column(key: Key) -> Column:
    if isinstance(key, Descending):
        return key.column
    return F.col(key) if isinstance(key, str) else key


def _sorted(key: Key) -> Column:
    return key.column.desc_nulls_last() if isinstance(key, Descending) else _column(key).asc_nulls_first()


def _reaches(keys: Sequence[Key], bound: Column) -> Column:
    """Whether a row stands at or behind a bound."""
    reaches = F.lit(True)
    for i, key in reversed(list(enumerate(keys))):
        mine, theirs = _column(key), bound[f"_k{i}"]
        if isinstance(key, Descending):
            behind = theirs.isNotNull() & (mine.isNull() | (mine < theirs))
        else:
            behind = mine.isNotNull() & (theirs.isNull() | (mine > theirs))
        reaches = behind | (mine.eqNullSafe(theirs) & reaches)
    return reaches


def _read_often(df: DataFrame) -> DataFrame:
    """``df`` written once to a scratch folder and read back, so that several passes do not each compute it."""
    if any(isinstance(f.dataType, NullType) for f in df.schema):
        return df  # files hold no columns without a type
    path = new_scratch_path(df.sparkSession, "ordered")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sliced(df: DataFrame, keys: Sequence[Key], edges: bool = False) -> DataFrame:
    """``df`` with ``_slice``: how many bounds a row reaches, found by halving.

    Bounds are keys of rows, so a slice after the first begins with the rows equal to its bound;
    ``edges`` asks for ``_edge``, true for these (texts cut in the bounds aside).

    Two passes over the key columns alone draw the bounds: one counts, one samples
    ``DRAWN`` rows for each shuffle partition.
    """
    spark = df.sparkSession
    slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
    named = df.select(*[_column(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    total = named.count()
    # Always 0, but not a constant: a join on it stays an equi join.
    zero = F.pmod(F.hash(*[_column(k) for k in keys]), F.lit(1)) if keys else F.lit(0)
    uncut = df.withColumns({"_slice": zero} | ({"_edge": F.lit(False)} if edges else {}))
    if slices < 2 or not total or not keys:
        return uncut
    kinds = dict(named.dtypes)
    drawn = named.where(F.rand(7) < DRAWN * slices / total)
    along = Window.orderBy(*[_sorted(Descending(F.col(c)) if isinstance(k, Descending) else c)
                             for c, k in zip(named.columns, keys)])
    cuts = drawn.withColumn("_n", F.row_number().over(along)).where(F.col("_n") % DRAWN == 0)
    cuts = cuts.orderBy("_n").select(
        *[F.substring(c, 1, BOUND_CHARS).alias(c) if kinds[c] == "string" else c for c in named.columns])
    table = cuts.toArrow()
    rows = table.to_pylist()
    table = table.take(pa.array([i for i, row in enumerate(rows) if not i or row != rows[i - 1]], pa.int64()))
    count = table.num_rows
    if not count:
        return uncut
    table = table.append_column("_i", pa.array(range(count), pa.int32()))
    bounds = spark.createDataFrame(table).agg(F.array_sort(F.collect_list(F.struct("_i", *named.columns)))).scalar()
    steps = F.array(*[F.lit(1 << b) for b in range(count.bit_length() - 1, -1, -1)])

    def onward(at: Column, step: Column) -> Column:
        bound = F.get(F.col("_cuts"), at + step - 1)
        return F.when((at + step <= count) & _reaches(keys, bound), at + step).otherwise(at)

    cut = df.withColumn("_cuts", bounds).withColumn("_slice", F.aggregate(steps, F.lit(0), onward))
    if edges:
        first, edge = F.get("_cuts", F.col("_slice") - 1), F.col("_slice") > 0
        for i, key in enumerate(keys):
            edge = edge & _column(key).eqNullSafe(first[f"_k{i}"])
        cut = cut.withColumn("_edge", edge)
    return cut.drop("_cuts")


def _carried(edges: DataFrame, group: Sequence[str], carry: Mapping[str, Callable[[WindowSpec], Column]]) -> DataFrame:
    """For groups that cross a slice border, what the earlier slices pass on: at most two rows per slice."""
    spread = Window.partitionBy(*group)
    earlier = spread.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    if group:
        edges = edges.withColumn("_spans", F.count("*").over(spread)).where("_spans > 1")
    return edges.select(
        *[F.col(g).alias(f"_k_{g}") for g in group], F.col("_slice").alias("_k_slice"),
        *[over(earlier).alias(name) for name, over in carry.items()])


def _with_carry(local: DataFrame, carried: DataFrame, group: Sequence[str]) -> DataFrame:
    same = F.col("_slice") == F.col("_k_slice")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_k_{g}"))
    return local.join(bounded(carried), same, "left")


def _inside(group: Sequence[str], order: Sequence[Key]) -> WindowSpec:
    return Window.partitionBy("_slice", *group).orderBy(*map(_sorted, order)).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)


def prefix_sums(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Key],
    sums: Mapping[str, Column],
) -> DataFrame:
    """Running sums (current row included) of whole numbers, per group, along ``order``.

    ``order`` must be total within a group, else ties are broken arbitrarily.
    """
    addends = {f"_add_{name}": value for name, value in sums.items()}
    prepared = _read_often(df).select("*", *[v.cast("long").alias(a) for a, v in addends.items()])
    cut = sliced(prepared, [*group, *order])
    edges = cut.groupBy(*group, "_slice").agg(*[F.sum(a).alias(a) for a in addends])
    carried = _carried(edges, group, {
        f"_carry{a}": lambda w, a=a: F.coalesce(F.sum(a).over(w), F.lit(0)) for a in addends})
    local = cut.select("*", *[F.sum(a).over(_inside(group, order)).alias(f"_run{a}") for a in addends])
    return _with_carry(local, carried, group).select(
        *df.columns,
        *[
            (F.col(f"_run_add_{n}") + F.coalesce(f"_carry_add_{n}", F.lit(0))).alias(n)
            for n in sums
        ],
    )


def row_numbers(
    df: DataFrame, group: Sequence[str], order: Sequence[Key], name: str = "row_num"
) -> DataFrame:
    """1, 2, 3, ... per group along a total order."""
    return prefix_sums(df, group, order, {name: F.lit(1)})


def surrogate_key(df: DataFrame, natural_key: str, name: str) -> DataFrame:
    """Dense 1..N over the whole table in natural-key order."""
    return row_numbers(df, [], [natural_key], name)


def ranks(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    *,
    descending: bool = True,
    rank: str | None = None,
    dense_rank: str | None = None,
) -> DataFrame:
    """Rank with gaps and/or without, per group by ``value``.

    Numbers the distinct values with their row counts, then joins back, so a
    value shared by very many rows is one row while it is being ranked.
    """
    levels = df.groupBy(*group, value).agg(F.count("*").alias("_rows"))
    by = Descending(F.col(value)) if descending else value
    numbered = prefix_sums(levels, group, [by], {"_upto": F.col("_rows"), "_level": F.lit(1)})
    keyed = numbered.select(
        *[F.col(c).alias(f"_k_{c}") for c in (*group, value)],
        (F.col("_upto") - F.col("_rows") + 1).alias("_rank"),
        "_level",
    )
    same = F.lit(True)
    for c in (*group, value):
        same = same & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    wanted = [F.col(s).alias(n) for s, n in (("_rank", rank), ("_level", dense_rank)) if n]
    return df.join(dealt(keyed), same).select(*df.columns, *wanted)


def running_extreme(
    df: DataFrame, group: Sequence[str], order: Sequence[Key], value: str, name: str, largest: bool = True
) -> DataFrame:
    """The largest (or smallest) value so far, per group along a total order; nulls count for nothing."""
    best, either = (F.max, F.greatest) if largest else (F.min, F.least)
    cut = sliced(_read_often(df), [*group, *order])
    carried = _carried(cut.groupBy(*group, "_slice").agg(best(value).alias("_edge")), group, {
        "_carry": lambda w: best("_edge").over(w)})
    local = cut.withColumn("_run", best(value).over(_inside(group, order)))
    return _with_carry(local, carried, group).select(*df.columns, either("_run", "_carry").alias(name))


def last_known(df: DataFrame, group: Sequence[str], order: Sequence[Key], value: str, name: str) -> DataFrame:
    """The last value so far that is not null (current row included), per group along a total order."""
    cut = sliced(_read_often(df), [*group, *order])
    placed = cut.withColumn("_at", F.row_number().over(
        Window.partitionBy("_slice", *group).orderBy(*map(_sorted, order))))
    known = F.max_by(value, F.when(F.col(value).isNotNull(), F.col("_at")))
    carried = _carried(placed.groupBy(*group, "_slice").agg(known.alias("_edge")), group, {
        "_carry": lambda w: F.last("_edge", ignorenulls=True).over(w)})
    local = cut.withColumn("_run", F.last(value, ignorenulls=True).over(_inside(group, order)))
    return _with_carry(local, carried, group).select(*df.columns, F.coalesce("_run", "_carry").alias(name))


def over_neighbours(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Key],
    values: Mapping[str, Callable[[WindowSpec], Column]],
    before: int = 0,
    after: int = 0,
    chunk: int = CHUNK,
) -> DataFrame:
    """Window functions that look at most ``before`` rows back and ``after`` rows ahead, per group along a total order.

    Rows are numbered within their group and cut into chunks of ``chunk`` rows. The rows next
    to a border are sent to the other side as well, so that every chunk sees all it
    needs; the copies are dropped afterwards.
    """
    if max(before, after) > chunk:
        raise ValueError("a chunk must hold as many rows as the window reaches")
    numbered = row_numbers(df, group, order, "_pos").withColumn("_home", F.floor((F.col("_pos") - 1) / chunk))
    within = (F.col("_pos") - 1) % chunk
    none = F.lit(None).cast("bigint")
    places = F.array_compact(F.array(
        F.col("_home"), F.when(within >= chunk - before, F.col("_home") + 1).otherwise(none),
        F.when((within < after) & (F.col("_home") > 0), F.col("_home") - 1).otherwise(none)))
    copied = numbered.withColumn("_chunk", F.explode(places))
    w = Window.partitionBy(*group, "_chunk").orderBy("_pos")
    seen = copied.select("*", *[make(w).alias(name) for name, make in values.items()])
    return seen.where("_chunk = _home").select(*df.columns, *values)


def previous_value(df: DataFrame, group: Sequence[str], order: Sequence[Key], value: str, name: str, n: int = 1,
                   chunk: int = CHUNK) -> DataFrame:
    return over_neighbours(df, group, order, {name: lambda w: F.lag(value, n).over(w)}, before=n, chunk=chunk)


def following_value(df: DataFrame, group: Sequence[str], order: Sequence[Key], value: str, name: str, n: int = 1,
                    chunk: int = CHUNK) -> DataFrame:
    return over_neighbours(df, group, order, {name: lambda w: F.lead(value, n).over(w)}, after=n, chunk=chunk)


def moving_mean(df: DataFrame, group: Sequence[str], order: Sequence[Key], value: str, name: str, n: int,
                chunk: int = CHUNK) -> DataFrame:
    """Mean of the last ``n`` money values, in whole cents; fewer at the start, nulls left out."""
    cents = F.rint(F.col(value) * 100).cast("long")

    def mean(w: WindowSpec) -> Column:
        w = w.rowsBetween(1 - n, Window.currentRow)
        return F.round(F.sum(cents).over(w) / 100 / F.count(value).over(w), 2)

    return over_neighbours(df, group, order, {name: mean}, before=n - 1, chunk=chunk)


def page(df: DataFrame, order: Sequence[Key], offset: int, limit: int) -> DataFrame:
    """Rows ``offset`` + 1 to ``offset`` + ``limit`` along a total order, however far down.

    Counts per slice tell which slices hold the page; only their rows are sorted.
    """
    cut = sliced(_read_often(df), order)
    counts = cut.groupBy("_slice").agg(F.count("*").alias("_rows"))
    upto = counts.withColumn("_upto", F.sum("_rows").over(Window.orderBy("_slice")))  # a row per slice
    held = upto.where((F.col("_upto") > offset) & (F.col("_upto") - F.col("_rows") < offset + limit))
    rows = cut.join(bounded(held), "_slice")
    place = F.row_number().over(Window.partitionBy("_slice").orderBy(*map(_sorted, order)))
    placed = rows.withColumn("_place", place + F.col("_upto") - F.col("_rows"))
    return placed.where((F.col("_place") > offset) & (F.col("_place") <= offset + limit)).select(*df.columns).orderBy(*map(_sorted, order))
