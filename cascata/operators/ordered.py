"""Previous-row and latest-row lookups per key.

A plain ``lag`` window sorts all rows of one key in one task. That is right when a key holds
few rows, which ``bounded=True`` states (for example rows that are unique per key and month).
Otherwise keys above ``hot_rows`` rows take a second path: their identical rows are collapsed to
one with a count, the rest is cut into pieces that follow the order, each piece is lagged on its
own, and the last row of the piece before is carried over. Both paths give the same result.
The second path reads its rows several times, so it first writes them to the shared folder: what
lies before is worked out once, however deep it is, and all branches see the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cascata.sources.sinks import stored

HOT_ROWS = 1_000_000
PIECES = 256
COPIES_PER_TASK = 1_000_000


def _order_columns(order: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in order]


def add_previous(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: dict[str, str],
    default=None,
    bounded: bool = False,
    hot_rows: int = HOT_ROWS,
    at_rest: bool = False,
) -> DataFrame:
    """Add ``new_name = value of the row before`` for every ``{new_name: column}``.

    ``order`` has one or more columns, numbers or dates, and sorts nulls first. Rows that tie on it are ordered by a hash of the whole row, so the result does not
    depend on the partitioning. ``default`` fills the first row of a key. Without ``bounded`` the
    rows are written once when this is called, unless they are ``at_rest``: read from storage as they are.
    """
    tie = F.xxhash64(*df.columns)
    if bounded:
        return _lag(df, keys, [*_order_columns(order), tie], values, default)
    df = df if at_rest else stored(df)
    match = [F.col(k).eqNullSafe(F.col(f"__hot_{k}")) for k in keys]
    # With no hot key AQE drops the second scan.
    hot, same = _hot_keys(df, keys, hot_rows), reduce(and_, match)
    cold = _lag(df.join(hot, same, "left_anti"), keys, [*_order_columns(order), tie], values, default)
    cut = _lag_in_pieces(df.join(hot, same, "left_semi"), keys, order, values, default)
    return cold.unionByName(cut)


def _lag(df, keys, order, values, default) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumns({new: F.lag(col, 1, default).over(w) for new, col in values.items()})


def _hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int) -> DataFrame:
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    return counts.where(F.col("__n") > hot_rows).select(
        *[F.col(k).alias(f"__hot_{k}") for k in keys]
    )


def _lag_in_pieces(df, keys, order, values, default) -> DataFrame:
    """Lag of keys too large for one task.

    The piece numbers grow with the order: a range of the leading order column by the key's quantiles;
    where that range is a single value, a range of the second column; where that is one value too, the top
    bits of the row hash. So a key has a bounded number of pieces, whether its order column has few values or
    is nearly unique, and the pass over the piece ends stays small. The end of the piece before enters as
    one carrier row in front of a piece.
    """
    columns = df.columns
    rows = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("__copies"))
    rows = rows.withColumn("__hash", F.xxhash64(*columns))
    rows, ranges = _with_ranges(rows, keys, order)
    piece = [*keys, *ranges]
    own = F.struct(*[F.col(c).alias(new) for new, c in values.items()])
    position = F.struct(*order, "__hash", F.struct(*columns))
    ends = rows.groupBy(*piece).agg(F.max_by(own, position).alias("__end"))
    by_key = Window.partitionBy(*keys).orderBy(*ranges)
    carriers = (
        ends.withColumn("__own", F.lag("__end").over(by_key))
        .where(F.col("__own").isNotNull())
        .select(*piece, "__own", F.lit(True).alias("__carrier"))
    )
    both = rows.withColumns({"__own": own, "__carrier": F.lit(False)}).unionByName(
        carriers, allowMissingColumns=True
    )
    within = Window.partitionBy(*piece).orderBy(
        F.col("__carrier").desc(), *_order_columns([*order, "__hash", *columns])
    )
    lagged = both.withColumn("__before", F.lag("__own").over(within)).where(~F.col("__carrier"))
    before = F.col("__before")
    first = {
        new: before.getField(new)
        if default is None
        else F.when(before.isNull(), F.lit(default)).otherwise(before.getField(new))
        for new in values
    }
    one_each = lagged.withColumns(first).select(*columns, *values)
    return one_each.unionByName(_other_copies(rows, columns, values))


def _with_ranges(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Add the numbers of a row's piece; gives their names in order."""
    shares = [i / PIECES for i in range(1, PIECES)]
    marks = rows.groupBy(*[F.col(k).alias(f"__m_{k}") for k in keys]).agg(
        *[F.percentile_approx(c, shares, 4 * PIECES).alias(f"__marks_{n}") for n, c in enumerate(order)]
    )
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__m_{k}")) for k in keys])
    # One row per hot key; Spark measures it, and splits the hot side where it has to shuffle.
    marked = rows.join(marks, same).drop(*[f"__m_{k}" for k in keys])
    single, names = F.lit(True), []
    for n, column in enumerate(order):
        x, held = F.col(column), F.col(f"__marks_{n}")
        below = F.size(F.filter(held, _less_than(x)))
        at_mark = F.coalesce(F.array_contains(held, x), F.lit(False))
        # Odd for a quantile itself, even between two; nulls come first.
        number = F.when(x.isNull(), -1).otherwise(2 * below + at_mark.cast("int"))
        names.append(f"__range_{n}")
        marked = marked.withColumns({names[-1]: F.when(single, number).otherwise(0), f"__single_{n}": single & (at_mark | x.isNull())})
        single = F.col(f"__single_{n}")
    marked = marked.withColumn("__part", F.when(single, F.shiftright("__hash", 56)).otherwise(0))
    helpers = [f"__{h}_{n}" for n in range(len(order)) for h in ("marks", "single")]
    return marked.drop(*helpers), [*names, "__part"]


def _less_than(x: Column):
    return lambda value: value < x


def _other_copies(rows, columns, values) -> DataFrame:
    """All but one of identical rows: each follows a row like itself.

    They are written out in chunks spread over tasks.
    """
    left = F.col("__copies") - 1
    chunks = F.sequence(F.lit(1).cast("long"), F.ceil(left / COPIES_PER_TASK))
    spread = (
        rows.where(left > 0)
        .select(*columns, left.alias("__left"), F.explode(chunks).alias("__chunk"))
        .repartition("__chunk", *columns)
    )
    size = F.least(
        F.lit(COPIES_PER_TASK).cast("long"),
        F.col("__left") - (F.col("__chunk") - 1) * COPIES_PER_TASK,
    )
    copies = spread.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), size)))
    return copies.select(*columns, *[F.col(c).alias(new) for new, c in values.items()])


def latest_per(df: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    """One row per key, the one with the greatest ``order``; other columns break ties.

    An aggregate, not a ranked window: each task keeps one candidate per key before the shuffle.
    """
    return _pick(df, keys, order, F.max)


def first_per(df: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    """One row per key, the one with the least ``order``; other columns break ties."""
    return _pick(df, keys, order, F.min)


def _pick(df, keys, order, best):
    """The candidate is its own order, so a row is moved once."""
    others = [c for c in df.columns if c not in keys]
    ranked = F.struct(order.alias("__order"), F.struct(*others).alias("__row"))
    picked = df.groupBy(*keys).agg(best(ranked).alias("__best"))
    return picked.select(*[F.col(c) if c in keys else F.col("__best.__row").getField(c).alias(c) for c in df.columns])


def add_delta(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    name: str = "delta",
    bounded: bool = False,
    hot_rows: int = HOT_ROWS,
    at_rest: bool = False,
) -> DataFrame:
    """Change of ``value`` against the row before of the same key."""
    out = add_previous(
        df, keys, order, {"__before": value}, bounded=bounded, hot_rows=hot_rows, at_rest=at_rest
    )
    return out.withColumn(name, F.col(value) - F.col("__before")).drop("__before")
