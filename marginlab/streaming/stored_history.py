"""Validity intervals kept in storage, brought up to date with the log rows since the last run.

A run adds one folder: the intervals that it closed, the open ones, and the ids of closed
intervals that late log rows have split. Closed intervals are written once and stay. The open ones
of a key are its last ``lead`` changes, so their number does not grow with the log. A run
takes from storage the open intervals of the keys it has rows for, and those closed
after the earliest new row of their key; without late rows that is none, and the bounds that
files keep of ``valid_to`` skip them.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import date, datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marginlab.functions.times import moment
from marginlab.operators.neighbors import with_neighbors
from marginlab.sources.manifest import Manifest
from marginlab.sources.stored import stored


class StoredHistory:
    """A setting's history in ``path``.

    ``keys`` and ``ts`` of an interval, ``lead`` as in ``validity_intervals``. ``tie`` numbers the log
    rows in the order of their arrival: a run takes the rows above the greatest number
    it has seen, whatever their time. Rows without a time are left out. One run at a time.
    """

    def __init__(
        self, spark: SparkSession, path: str, keys: Sequence[str], ts: str = "logged_at", tie: str = "change_id",
        lead: int = 1, slice_by: str | None = "week",
    ):
        self.spark, self.path, self.keys = spark, path, list(keys)
        self.ts, self.tie, self.lead, self.slice_by = ts, tie, lead, slice_by
        self.runs = Manifest(spark, f"{path}/runs", "folder string, mark long, base boolean")

    def _complete(self) -> list:
        """Runs since the last compaction, in order."""
        rows = sorted(self.runs.rows().collect(), key=lambda r: r.seq)
        bases = [i for i, r in enumerate(rows) if r.base]
        return rows[bases[-1] :] if bases else rows

    def _same_key(self, prefix: str) -> Column:
        return reduce(and_, [F.col(k).eqNullSafe(F.col(prefix + k)) for k in self.keys])

    def _closed(self, runs: list) -> DataFrame:
        """Closed intervals that no later run has replaced, with ``__seq``."""
        def each(name: str) -> DataFrame:
            frames = [self.spark.read.parquet(f"{r.folder}/{name}").withColumn("__seq", F.lit(r.seq)) for r in runs]
            return reduce(DataFrame.unionByName, frames)

        gone = each("gone").select(F.col(self.tie).alias("__gone"), F.col("__seq").alias("__by"))
        replaced = (F.col(self.tie) == F.col("__gone")) & (F.col("__seq") < F.col("__by"))
        return each("closed").join(gone, replaced, "left_anti").drop("__seq")

    def _open(self, runs: list) -> DataFrame:
        return self.spark.read.parquet(f"{runs[-1].folder}/open", f"{runs[-1].folder}/still_open")

    def append(self, events: DataFrame) -> bool:
        """Take the log rows that arrived since the last run; False if there are none.

        ``events`` may hold older rows too. Its columns must be those of the first run.
        """
        runs = self._complete()
        new = events.filter(F.col(self.ts).isNotNull() & F.col(self.tie).isNotNull())
        if runs:
            new = new.filter(F.col(self.tie) > runs[-1].mark)
        new = stored(new, "new-events")
        mark, earliest = new.agg(F.max(self.tie), F.min(self.ts)).first()
        if mark is None:
            return False
        first = new.groupBy(*[F.col(k).alias("__" + k) for k in self.keys]).agg(F.min(self.ts).alias("__from"))
        touched, folder = new, f"{self.path}/run-{uuid.uuid4().hex}"
        if runs:
            still, closed = self._open(runs), self._closed(runs)
            late = closed.filter(F.col("valid_to") >= F.lit(earliest))
            late = late.join(first, self._same_key("__") & (F.col("valid_to") >= F.col("__from")), "left_semi")
            late = stored(late, "split-intervals")
            again = still.join(first, self._same_key("__"), "left_semi").unionByName(late).drop("valid_to")
            touched = new.unionByName(again)
            untouched = still.join(first, self._same_key("__"), "left_anti")
        full = with_neighbors(touched, self.keys, self.ts, {"valid_to": (self.ts, -self.lead)}, self.tie, self.slice_by)
        full = stored(full, "intervals")
        full.filter("valid_to IS NOT NULL").write.parquet(f"{folder}/closed")
        full.filter("valid_to IS NULL").write.parquet(f"{folder}/open")
        (untouched if runs else full.limit(0)).write.parquet(f"{folder}/still_open")
        (late if runs else full.limit(0)).select(self.tie).write.parquet(f"{folder}/gone")
        self.runs.append([(folder, mark, False)])
        return True

    def compact(self) -> None:
        """Rewrite all runs as one, so that readers open few files."""
        runs = self._complete()
        if not runs:
            return
        folder = f"{self.path}/run-{uuid.uuid4().hex}"
        closed = self._closed(runs)
        closed.write.parquet(f"{folder}/closed")
        self._open(runs).write.parquet(f"{folder}/open")
        for name in ("still_open", "gone"):
            empty = closed.limit(0)
            (empty if name == "still_open" else empty.select(self.tie)).write.parquet(f"{folder}/{name}")
        self.runs.append([(folder, runs[-1].mark, True)])

    def intervals(
        self, as_of: str | datetime | date, trunc: str | None = None, open_end: Column | None = None,
        start: str = "valid_from", end: str = "valid_to",
    ) -> DataFrame:
        """What ``validity_intervals`` gives for all rows taken so far, at any ``as_of``."""
        runs = self._complete()
        if not runs:
            raise ValueError(f"no run is complete in {self.path}")
        now = moment(as_of)
        rows = self._closed(runs).unionByName(self._open(runs)).filter(F.col(self.ts) < now)
        known = F.when(F.col("valid_to") < now, F.col("valid_to"))
        last = F.coalesce(known, now if open_end is None else open_end)
        out = rows.withColumns({"__end": last, "__start": F.col(self.ts)}).drop("valid_to")
        out = out.withColumnsRenamed({"__start": start, "__end": end})
        if trunc:
            out = out.withColumns({c: F.date_trunc(trunc, c) for c in (start, end)})
        return out
