"""Change-log history: events, old/new pairs, validity intervals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginlab.functions.nested import json_scalar
from marginlab.functions.times import moment
from marginlab.operators.neighbors import with_last, with_neighbors


def change_events(
    changes: DataFrame,
    base: DataFrame,
    table_name: str,
    on: str = "id",
    fields: Mapping[str, str | tuple[str, str]] | None = None,
    op: str | None = None,
    where: Column | None = None,
) -> DataFrame:
    """Log rows of one table with the *current* base row beside each.

    ``fields`` maps output names to JSON keys of the new values, or to
    ``("old_values", key)``. Log rows without a base row keep NULLs. ``where``
    is applied to the log before the join.
    """
    log = changes.filter(F.col("table_name") == table_name)
    if op is not None:
        log = log.filter(F.col("operation") == op)
    if where is not None:
        log = log.filter(where)
    read = {}
    for out, key in (fields or {}).items():
        side, name = ("new_values", key) if isinstance(key, str) else key
        read[out] = json_scalar(side, name)
    log = log.select(
        "change_id", "row_id", "operation", "source", "logged_at",
        *[c.alias(n) for n, c in read.items()],
    )
    clash = (set(base.columns) - {on}) & set(log.columns)
    if clash:
        raise ValueError(f"base and log share columns {sorted(clash)}")
    return log.join(base.withColumnRenamed(on, "__base_id"), F.col("row_id") == F.col("__base_id"), "left").drop(
        "__base_id"
    )


def validity_intervals(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    as_of: str | datetime | date,
    lead: int = 1,
    trunc: str | None = None,
    tie: str | None = "change_id",
    slice_by: str | None = "week",
    start: str = "valid_from",
    end: str = "valid_to",
    open_end: Column | None = None,
) -> DataFrame:
    """Add ``[start, end)``: from a change to the ``lead``-th change after it.

    Changes at or after ``as_of`` are not known yet and are left out, so a run for
    the same ``as_of`` gives the same intervals however the log has grown since.
    The last changes of a key stay open until ``open_end``, by default ``as_of``. Changes are ordered by
    their raw time and cut to ``trunc`` afterwards, so that all but the last of
    the changes within one hour get an empty interval.
    """
    df = df.filter(F.col(ts) < moment(as_of))
    out = with_neighbors(df, keys, ts, {end: (ts, -lead)}, tie, slice_by)
    out = out.withColumns({start: F.col(ts), end: F.coalesce(F.col(end), moment(as_of) if open_end is None else open_end)})
    if trunc:
        out = out.withColumns({c: F.date_trunc(trunc, c) for c in (start, end)})
    return out


def with_previous(
    df: DataFrame,
    cols: Mapping[str, str],
    keys: Sequence[str],
    ts: str,
    default: float | None = None,
    tie: str | None = "change_id",
    slice_by: str | None = "week",
) -> DataFrame:
    """Add ``{new name: column}`` holding the value of the row before.

    ``default`` stands in for a missing row and for a NULL value alike.
    """
    out = with_neighbors(df, keys, ts, {n: (c, 1) for n, c in cols.items()}, tie, slice_by)
    if default is None:
        return out
    return out.withColumns({n: F.coalesce(F.col(n), F.lit(default)) for n in cols})


def any_change(pairs: Sequence[tuple[str, str]]) -> Column:
    """True if an old value differs from its new one. NULL on a side is no change."""
    return reduce(or_, [F.col(old) != F.col(new) for old, new in pairs])


def changed_only(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    return df.filter(any_change(pairs))


def change_flag(pairs: Sequence[tuple[str, str]]) -> Column:
    return F.when(any_change(pairs), "Yes").otherwise("No")


def control_vs_experiment(
    control: DataFrame,
    experiment: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    fallback: Mapping[str, str] | None = None,
    key_side: Mapping[str, str] | None = None,
) -> DataFrame:
    """One row per pair of control and experiment changes with equal keys.

    Every control change of a key meets every experiment change of it, as in the
    published reports, so the result is quadratic in the changes of one key.

    ``key_side`` says from which side a key column is taken ("control" or
    "experiment"); with a full join the other side's lone rows show NULL there.
    ``fallback`` fills a missing column from another, ``{column: other}``.
    """
    side = {k: (key_side or {}).get(k, "experiment") for k in keys}
    c = control.withColumnsRenamed({k: f"__c_{k}" for k in keys})
    e = experiment.withColumnsRenamed({k: f"__e_{k}" for k in keys})
    on = [c[f"__c_{k}"] == e[f"__e_{k}"] for k in keys]
    both = c.join(e, on, how)
    picked = [F.col(f"__{side[k][0]}_{k}").alias(k) for k in keys]
    rest = [
        F.coalesce(F.col(n), F.col(fallback[n])).alias(n) if fallback and n in fallback else F.col(n)
        for n in both.columns
        if not n.startswith(("__c_", "__e_"))
    ]
    return both.select(*picked, *rest)


def nearest_pairs(
    control: DataFrame,
    experiment: DataFrame,
    keys: Sequence[str],
    ts: str,
    fallback: Mapping[str, str] | None = None,
    tie: str = "change_id",
    slice_by: str | None = "week",
) -> DataFrame:
    """One row per change of either side, with the other side's last change up to its time.

    As many rows as there are changes, however many fall on one day. Rows have ``keys``, ``ts``, ``tie``,
    ``side`` ("control" or "experiment") and the columns of both sides; those of a side without a change so far are
    NULL but for ``fallback``, ``{column: other}``. Equal times follow ``tie``. Columns beside the keys, ``ts``
    and ``tie`` must have names of their own.
    """
    frame = {"control": control, "experiment": experiment}
    own = {s: [c for c in df.columns if c not in (*keys, ts, tie)] for s, df in frame.items()}
    packed = {s: F.struct(*[F.col(c) for c in own[s]]) for s in frame}
    kinds = {s: frame[s].select(packed[s].alias("p")).schema["p"].dataType for s in frame}
    rows = [
        df.select(
            *keys, ts, tie, F.lit(s).alias("side"),
            *[(packed[s] if s == p else F.lit(None).cast(kinds[p])).alias(f"__{p}") for p in frame],
        )
        for s, df in frame.items()
    ]
    both = with_last(rows[0].unionByName(rows[1]), keys, ts, {f"__last_{p}": f"__{p}" for p in frame}, tie, slice_by)
    values = {c: F.col(f"__last_{p}")[c] for p in frame for c in own[p]}
    filled = [F.coalesce(v, values[fallback[c]]) if fallback and c in fallback else v for c, v in values.items()]
    return both.select(*keys, ts, tie, "side", *[v.alias(c) for c, v in zip(values, filled)])


def merge_update_sources(
    branches: Sequence[DataFrame], columns: Mapping[str, str]
) -> DataFrame:
    """One timeline of several sources. A column a source lacks is NULL of its type."""
    aligned = [
        b.select(
            *[
                (F.col(n) if n in b.columns else F.lit(None)).cast(t).alias(n)
                for n, t in columns.items()
            ]
        )
        for b in branches
    ]
    return reduce(DataFrame.unionByName, aligned)
