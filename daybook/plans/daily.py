"""Day-by-day loading into tables partitioned by day, with Spark's dynamic partition overwrite.

    <root>/history    one row per entity and touched day, in folders by day
    <root>/books      each entity's newest row as of some days, in folders by that day (`as_of`)
    <root>/rejected   events that a load could not place, with reasons, in folders by the load's day
    <root>/staging    what the load at hand has computed and checks

A load reads the events of its own days, the newest books before them and the history since, and writes rows
aside. Checked, they replace the folders of their days and no others, so a day can be loaded again, and what was
loaded before stays as it is. Days that were skipped, or that the gate held back, come with the next load, in
day order. One load runs at a time, as a scheduler sees to; one that breaks off is run again.

Late events change the past from their day on: rows of the entities concerned are computed again, days are
compared by digests (a sum of row hashes for each day), and only days that differ are written. Equal rows keep their
load time.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions.literals import as_date, date_literal
from daybook.functions.rules import gmv_eligible
from daybook.operators.snapshots import mark_current, touched_days
from daybook.operators.versions import as_of
from daybook.plans.history import fill_days
from daybook.plans.quality import gate, run_checks
from daybook.plans.storage import write_history
from daybook.schemas import DATE, PURCHASE, SNAPSHOT, Grain
from daybook.sources.feeds import REJECTED, Feed, rejected_events

_BOOKS = T.StructType([*SNAPSHOT, T.StructField("as_of", DATE)])


def _day(day: dt.date) -> Column:
    """A date literal, also of years before 1000."""
    return F.lit(day.isoformat()).cast("date")


def day_digests(rows: DataFrame, grain: Grain = PURCHASE) -> DataFrame:
    """Rows and a sum of row hashes for each day, of rows with a `digest`. Order doesn't matter, and
    sums of parts add up."""
    one = F.xxhash64(*grain.day, "digest").cast("decimal(38, 0)")
    return rows.groupBy(grain.date).agg(F.count(F.lit(1)).alias("rows"), F.sum(one).alias("digest"))


def changed_days(old: DataFrame, new: DataFrame, grain: Grain = PURCHASE) -> list[dt.date]:
    """The days on which the two differ; at most one per calendar day."""
    states = [
        day_digests(rows, grain).select(grain.date, F.struct("rows", "digest").alias(name))
        for rows, name in ((old, "old"), (new, "new"))
    ]
    both = states[0].join(states[1], grain.date, "full").where(~F.col("old").eqNullSafe(F.col("new")))
    return sorted(r[0] for r in both.select(grain.date).collect())


class DailyStore:
    """Snapshots of entities under one root folder, loaded in day order."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        state_every: int = 7,
        grain: Grain = PURCHASE,
        rule: Callable[[], Column] = gmv_eligible,
    ):
        self.spark, self.root, self.state_every = spark, root, state_every
        self.grain, self.rule = grain, rule

    # -- reading ---------------------------------------------------------------------------

    def snapshots(self) -> DataFrame:
        """All rows, without is_current."""
        return self._read("history", SNAPSHOT)

    def history(self) -> DataFrame:
        """All rows with is_current worked out. Costs a window over the whole history: for the
        newest rows alone use `current`."""
        return mark_current(self.snapshots(), self.grain)

    def as_of(self, cutoff: dt.date | str, columns: Sequence[str] | None = None) -> DataFrame:
        """Every entity as known on `cutoff`."""
        return as_of(self._source(as_date(cutoff)), cutoff, columns, self.grain)

    def current(self) -> DataFrame:
        """The newest row of every entity."""
        return self.as_of(self._started()).withColumn("is_current", F.lit(True))

    def rejected(self) -> DataFrame:
        """The events that no load could place. One without a day may have been seen by several."""
        return self._read("rejected", REJECTED).distinct()

    def last_day(self) -> dt.date | None:
        """The last day that has rows: told by the folders and the files' row counts."""
        return self.snapshots().agg(F.max(self.grain.date)).first()[0]

    # -- loading ---------------------------------------------------------------------------

    def start(
        self, feeds: Sequence[Feed], through: dt.date | str, run_ts: dt.datetime, check: bool = True
    ) -> list[dt.date]:
        """First load: the full history up to and including `through`. Returns the days written."""
        if self.last_day() is not None:
            raise ValueError(f"{self.root} has been started")
        return self._load(feeds, None, as_date(through), run_ts, check)

    def append_day(
        self, feeds: Sequence[Feed], day: dt.date | str, run_ts: dt.datetime, check: bool = True
    ) -> list[dt.date]:
        """Load all days after the last loaded one, up to and including `day`. Running the last
        day again replaces it; a day before it is late, see `rebuild`. Returns the days written."""
        last, day = self._started(), as_date(day)
        if day < last:
            raise ValueError(f"{day} is before the last loaded day {last}: use rebuild")
        after = day - dt.timedelta(days=1) if day == last else last
        return self._load(feeds, after, day, run_ts, check)

    def late_purchases(self, batch: Sequence[Feed]) -> DataFrame:
        """The entities that have events in `batch` dated on or before the last loaded day, each
        with the first such day. Hand them to `rebuild`, or leave the past as it was reported."""
        loaded = F.col(self.grain.date) <= _day(self._started())
        late = [feed.placed(self.grain).where(loaded).select(*self.grain.day) for feed in batch]
        days = F.min(self.grain.date).alias(self.grain.date)
        return reduce(DataFrame.union, late).groupBy(self.grain.key).agg(days)

    def rebuild(
        self, feeds: Sequence[Feed], purchases: DataFrame, run_ts: dt.datetime, check: bool = True
    ) -> list[dt.date]:
        """Late or corrected events: recompute the entities in `purchases` from the full feeds,
        from the given day on (without that column: from their first), up to the last loaded day.

        Days whose rows are all as before stay untouched, and so does the load time of equal rows.
        Returns the days that differ.
        """
        key, date, last = self.grain.key, self.grain.date, self._started()
        since = F.col(date) if date in purchases.columns else _day(dt.date.min)
        # Written first: read several times, and Spark can tell whether it is small enough to be
        # broadcast to the feeds and the snapshots.
        keys = self._stage(
            "keys", purchases.select(key, since.alias("since")).groupBy(key).agg(F.min("since").alias("since"))
        )
        first = keys.agg(F.min("since")).first()[0]
        if first is None:
            return []
        upto = (F.col(date) >= _day(first)) & (F.col(date) <= _day(last))
        touched = touched_days([feed.where(upto).since(keys, key, date) for feed in feeds], self.grain)
        before = None
        if first > dt.date.min:
            known = self._source(first - dt.timedelta(days=1)).join(keys, key)
            earlier = known.where(F.col(date) < F.col("since")).select(*SNAPSHOT.names)
            before = as_of(earlier, last, grain=self.grain)
        digest = F.xxhash64(*[c for c in SNAPSHOT.names if c not in (*self.grain.day, "etl_loaded_at")])
        own = self.snapshots().where(F.col(date) >= _day(first)).join(keys, key).where(F.col(date) >= F.col("since"))
        old = own.select(*self.grain.day, digest.alias("digest"), F.col("etl_loaded_at").alias("old_stamp"))
        fresh = self._snapshot(feeds, touched, before, run_ts).withColumn("digest", digest)
        stamp = F.coalesce("old_stamp", "etl_loaded_at")
        new = self._stage(
            "new", fresh.join(old, [*self.grain.day, "digest"], "left").withColumn("etl_loaded_at", stamp).drop("old_stamp")
        )
        changed = changed_days(old, new, self.grain)
        if not changed:
            return []
        if check:  # the recomputed rows, up to each entity's newest one
            self._gate(new.select(*SNAPSHOT.names), last, run_ts)
        again = F.col(date).isin(changed)
        others = self.snapshots().where(again).join(keys, key, "left")
        kept = others.where(F.col("since").isNull() | (F.col(date) < F.col("since")))
        rows = kept.select(*SNAPSHOT.names).unionByName(new.where(again).select(*SNAPSHOT.names))
        self._replace(self._stage("rows", rows), changed)
        for day in self._book_days():
            if day >= changed[0]:
                self._clear("books", "as_of", day, SNAPSHOT)
        return changed

    # -- parts -----------------------------------------------------------------------------

    def _load(
        self, feeds: Sequence[Feed], after: dt.date | None, day: dt.date, run_ts: dt.datetime, check: bool
    ) -> list[dt.date]:
        """Days after `after`, up to `day`: computed aside, checked, then put in place."""
        date = self.grain.date
        span = F.col(date) <= date_literal(day)
        if after is not None:
            span = span & (F.col(date) > date_literal(after))
        touched = touched_days([feed.where(span) for feed in feeds], self.grain)
        before = None
        if after is not None:
            # Written first: the events are read once, and Spark knows how many keys it joins
            # with the books.
            touched = self._stage("touched", touched)
            among = touched.select(self.grain.key).distinct()
            known = self._source(after).join(among, self.grain.key, "left_semi")
            before = as_of(known, after, grain=self.grain)
        rows = self._stage("rows", self._snapshot(feeds, touched, before, run_ts))
        if check:
            self._gate(rows, day, run_ts)
        unplaced = rejected_events([feed.where(F.col(date).isNull() | span) for feed in feeds], self.grain)
        unplaced.write.mode("overwrite").parquet(f"{self.root}/rejected/load_day={day}")
        days = self._days(rows)
        if after is None:
            self._replace(rows, days)
        else:
            for one in sorted({*days, day}):  # in day order: a load that breaks off leaves no gap
                self._replace(rows.where(F.col(date) == _day(one)), [one])
        self._keep_books(day)
        return days

    def _snapshot(
        self, feeds: Sequence[Feed], touched: DataFrame, before: DataFrame | None, run_ts: dt.datetime
    ) -> DataFrame:
        filled = fill_days(feeds, touched, run_ts, self.grain, self.rule, before)
        return filled.select(*SNAPSHOT.names)

    def _replace(self, rows: DataFrame, days: Sequence[dt.date]) -> None:
        """Put rows in place of those of the given days, which are all that they have."""
        write_history(rows.select(*SNAPSHOT.names), f"{self.root}/history", self.grain, overwrite_days=True)
        for day in set(days) - set(self._days(rows)):
            self._clear("history", self.grain.date, day, SNAPSHOT)

    def _clear(self, table: str, by: str, day: dt.date, schema: T.StructType) -> None:
        """Leave a folder without rows."""
        rest = T.StructType([f for f in schema if f.name != by])
        self.spark.createDataFrame([], rest).write.mode("overwrite").parquet(f"{self.root}/{table}/{by}={day}")

    def _keep_books(self, day: dt.date) -> None:
        """Write the books as of `day`, if the newest ones are `state_every` days old, or of that very day."""
        newest = max(self._book_days(), default=None)
        if newest is None or newest == day or (day - newest).days >= self.state_every:
            books = as_of(self._source(day - dt.timedelta(days=1)), day, grain=self.grain).select(*SNAPSHOT.names)
            by_key = books.repartition(self.grain.key).sortWithinPartitions(self.grain.key)
            by_key.write.mode("overwrite").parquet(f"{self.root}/books/as_of={day}")

    def _book_days(self) -> list[dt.date]:
        return sorted(r[0] for r in self._read("books", _BOOKS).select("as_of").distinct().collect())

    def _source(self, cutoff: dt.date) -> DataFrame:
        """The newest books up to `cutoff` and the rows since them."""
        newest = max((day for day in self._book_days() if day <= cutoff), default=None)
        if newest is None:
            return self.snapshots()
        since = self.snapshots().where(F.col(self.grain.date) > _day(newest))
        return self._read(f"books/as_of={newest}", SNAPSHOT).unionByName(since)

    def _days(self, rows: DataFrame) -> list[dt.date]:
        """The days that have rows; at most one per calendar day."""
        return sorted(r[0] for r in rows.select(self.grain.date).distinct().collect())

    def _gate(self, rows: DataFrame, run_date: dt.date | str, now: dt.datetime) -> None:
        """The load's own newest row of each entity is the current one."""
        gate(run_checks(mark_current(rows, self.grain), run_date, now, self.grain))

    def _stage(self, name: str, rows: DataFrame) -> DataFrame:
        path = f"{self.root}/staging/{name}"
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def _read(self, table: str, schema: T.StructType) -> DataFrame:
        """A table of the store; empty before it is first written."""
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{table}").select(*schema.names)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def _started(self) -> dt.date:
        last = self.last_day()
        if last is None:
            raise ValueError(f"{self.root} has not been started")
        return last
