"""Values of the n-th row before or after, by key, in time order.

``lag``/``lead`` over one window put every row of a key into one task. A change
log may have a single campaign with a third of all rows, so the rows of a key
are first cut into time slices:

1. inside a slice, ``lag``/``lead`` as usual (key *and* slice are the partition).
   Only the first and last n rows of a slice can need a row of another slice;
2. those edge rows, at most 2n for each key and slice, meet in a second window
   by key. Between two of them that are neighbours across slices no other row
   lies, so the n-th edge row before is the n-th row before. The other rows
   stay spread by slice and keep the value from the first window.

The result equals the plain window. Rows with equal times stay in one slice.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Slice of the rows without a time; they come last.
_NO_TIME = "9999-12-31"


def with_neighbors(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    shifts: Mapping[str, tuple[str, int]],
    tie: str | None = "change_id",
    slice_by: str | None = "week",
) -> DataFrame:
    """Add columns ``{name: (column, n)}``: n > 0 looks back, n < 0 ahead.

    NULL keys form one group. ``tie`` makes the order total. ``slice_by`` is a
    ``date_trunc`` unit, or None for a plain window (groups known to be small).
    """
    order = [F.col(c).asc_nulls_last() for c in ([ts, tie] if tie else [ts])]
    if slice_by is None:
        w = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumns({out: F.lag(c, n).over(w) for out, (c, n) in shifts.items()})

    reach = max(abs(n) for _, n in shifts.values())
    one = F.count(F.lit(1))
    inside = Window.partitionBy(*keys, "__slice").orderBy(*order)
    sliced = df.withColumn(
        "__slice", F.coalesce(F.date_trunc(slice_by, ts), F.lit(_NO_TIME).cast("timestamp"))
    ).withColumns(
        {
            "__before": one.over(inside.rowsBetween(-reach, -1)),
            "__after": one.over(inside.rowsBetween(1, reach)),
            **{f"__in_{out}": F.lag(c, n).over(inside) for out, (c, n) in shifts.items()},
        }
    )
    is_edge = (F.col("__before") < reach) | (F.col("__after") < reach)
    sliced = sliced.withColumn("__part", F.when(~is_edge, F.col("__slice")))
    across = Window.partitionBy(*keys, "__part").orderBy(*order)
    out = {}
    for name, (c, n) in shifts.items():
        near = F.col("__before") if n > 0 else F.col("__after")
        out[name] = F.when(near >= abs(n), F.col(f"__in_{name}")).otherwise(F.lag(c, n).over(across))
    return sliced.withColumns(out).drop(
        "__slice", "__part", "__before", "__after", *[f"__in_{name}" for name in shifts]
    )


def with_last(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    columns: Mapping[str, str],
    tie: str | None = "change_id",
    slice_by: str | None = "week",
) -> DataFrame:
    """Add columns ``{name: column}``: the column's last value that is not NULL, up to this row, by key in time order.

    As in ``with_neighbors`` the rows of a key are cut into time slices. The last values of a slice, one row,
    are carried to later slices; a row without a value in its own slice takes those. Rows without a time come last.
    """
    order = [F.col(c).asc_nulls_last() for c in ([ts, tie] if tie else [ts])]
    upto = (Window.unboundedPreceding, 0)
    if slice_by is None:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(*upto)
        return df.withColumns({out: F.last(c, ignorenulls=True).over(w) for out, c in columns.items()})

    sliced = df.withColumn("__slice", F.coalesce(F.date_trunc(slice_by, ts), F.lit(_NO_TIME).cast("timestamp")))
    inside = Window.partitionBy(*keys, "__slice").orderBy(*order).rowsBetween(*upto)
    here = sliced.withColumns({f"__in_{out}": F.last(c, ignorenulls=True).over(inside) for out, c in columns.items()})

    # Times are compared as they come; those that are missing belong after all others.
    place = F.struct(F.col(ts).isNull(), *[F.col(c) for c in ([ts, tie] if tie else [ts])])
    ends = sliced.groupBy(*[F.col(k).alias(f"__k_{k}") for k in keys], F.col("__slice").alias("__k_slice")).agg(
        *[F.max_by(F.struct(F.col(c)), F.when(F.col(c).isNotNull(), place)).alias(f"__end_{out}") for out, c in columns.items()]
    )
    before = Window.partitionBy(*[f"__k_{k}" for k in keys]).orderBy("__k_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.withColumns(
        {f"__end_{out}": F.last(F.when(F.col(f"__end_{out}")[c].isNotNull(), F.col(f"__end_{out}")), ignorenulls=True).over(before) for out, c in columns.items()}
    )
    on = [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys] + [F.col("__slice") == F.col("__k_slice")]
    both = here.join(carried, on, "left")
    found = {out: F.coalesce(F.col(f"__in_{out}"), F.col(f"__end_{out}")[c]) for out, c in columns.items()}
    extra = [f"__k_{k}" for k in keys] + [f"__{p}_{out}" for p in ("in", "end") for out in columns]
    return both.withColumns(found).drop("__slice", "__k_slice", *extra)
