"""Live matching of snapshots, as micro-batches over landed files."""

from __future__ import annotations

import logging
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import ExitStack, contextmanager
from datetime import datetime, timedelta, timezone
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import RUN_ERROR, RUN_OK, RUN_SKIPPED
from ..functions.clock import from_epoch, ntz, to_utc
from ..operators import integrity
from ..operators.match import ARRIVAL, FACT_COLUMNS, POSITION, match_snapshots, mentioned_trips
from ..operators.merge import keep_first
from ..operators.skip import mark_fresh, numbered
from ..operators.upsert import insertable
from ..plans.invalidate import log_touched
from ..schemas import FEED, PRIMARY_KEYS
from ..session import shared_folder, written
from ..sources.feed import epoch, stream_snapshots, unreadable
from ..warehouse import Warehouse, clock_now, week_start

log = logging.getLogger(__name__)

MAX_ERROR_CHARS = 500  # of a message in the audit table; the log has all of it
MOST_FAILURES = 64  # parts of a batch that may fail before what is left is set aside unhalved
MOST_ATTEMPTS = 10  # at a batch that is set aside, before it waits for a replay by hand
ATTEMPT = "run string, batch_id bigint, at timestamp_ntz, error string"


@contextmanager
def _persisted(df: DataFrame) -> Iterator[DataFrame]:
    df = df.persist()
    try:
        yield df
    finally:
        df.unpersist()


@contextmanager
def _stored(wh: Warehouse, df: DataFrame, purpose: str) -> Iterator[DataFrame]:
    """`df` as a table in the shared folder, for rows that grow with a batch; deleted at the end.

    A cache holds whole partitions in executors' memory, and again where they are fetched from or
    moved to disk. A table is read and written a page at a time, however large a partition is.
    """
    folder = shared_folder(wh.spark, purpose)
    try:
        df.write.parquet(folder)
        yield wh.spark.read.schema(df.schema).parquet(folder)
    finally:
        wh.delete(folder)


def _heads(batch: DataFrame) -> DataFrame:
    """One row per snapshot: when it arrived, from which file, and its time."""
    return batch.select(*ARRIVAL, epoch().alias("epoch")).distinct()


def last_processed(wh: Warehouse) -> int | None:
    """Epoch time of the newest snapshot that a cycle has stored; reads the newest weeks first."""
    for week in reversed(wh.partitions("fact_run")):
        stored = wh.read("fact_run", [week]).where(F.col("status") == RUN_OK)
        done = stored.agg(F.max("snapshot_ts")).first()[0]
        if done:
            return int(done.replace(tzinfo=timezone.utc).timestamp())
    return None


class Marker:
    """Time of the last processed snapshot; moves only when a batch has been stored."""

    def __init__(self, wh: Warehouse):
        self.epoch = last_processed(wh)

    def move(self, cycles: DataFrame) -> None:
        newest = cycles.where(F.col("status") == RUN_OK).agg(F.max("epoch")).first()[0]
        if newest is not None:
            self.epoch = newest if self.epoch is None else max(newest, self.epoch)


class Tried:
    """Newest snapshot time that any batch has tried to store.

    A fact's key holds its snapshot time, so facts of later snapshots cannot be stored yet: a batch
    that is newer as a whole need not look for its keys in the table. This one number is all the
    state that duplicate elimination takes for a feed in order; a batch that goes back, as after a
    restart or when files are landed again, is compared with the stored dates.
    """

    def __init__(self, wh: Warehouse):
        newest = wh.read("fact_delay", wh.partitions("fact_delay")[-1:]).agg(F.max("ts")).first()[0]
        self.epoch = int(newest.replace(tzinfo=timezone.utc).timestamp()) if newest else None

    def begin(self, first: int, last: int) -> bool:
        """Whether a batch of these snapshot times is newer than all before; from now on it has been tried."""
        newer = self.epoch is None or first > self.epoch
        self.epoch = last if newer else max(last, self.epoch)
        return newer


def _counts(df: DataFrame, name: str) -> DataFrame:
    return df.groupBy(F.col("ts").alias("snapshot_ts")).agg(F.count(F.lit(1)).cast("int").alias(name))


def _cycles(heads: DataFrame, facts: DataFrame | None = None, new: DataFrame | None = None) -> DataFrame:
    """One row per snapshot of the batch, with its counts and its place in the order of arrival."""
    rows = heads.withColumn("snapshot_ts", from_epoch(F.col("epoch")))
    for name, df in [("observed", facts), ("inserted", new)]:
        if df is None:
            rows = rows.withColumn(name, F.lit(0))
        else:
            count = F.when(F.col("fresh"), F.coalesce(name, F.lit(0))).otherwise(0)
            rows = rows.join(_counts(df, name), "snapshot_ts", "left").withColumn(name, count)
    status = F.when(F.col("fresh"), RUN_OK).otherwise(RUN_SKIPPED).alias("status")
    return rows.select(*ARRIVAL, "epoch", "snapshot_ts", "observed", "inserted", status)


def store_batch(
    wh: Warehouse,
    batch: DataFrame,
    marker: Marker | None = None,
    on_orphans: str = "fail",
    tried: Tried | None = None,
) -> DataFrame:
    """Match one batch, append its new facts and return its audit counts per snapshot.

    With a marker, snapshots that are not newer than it (or than earlier ones of the batch)
    are skipped. The schedule version is resolved anew for each batch, so a static load
    takes effect without a restart. Of several updates of one key the first to arrive is
    kept. `on_orphans` is `fail`, or `quarantine` to set bad facts aside. With `tried`, stored
    dates are only read when the batch is not newer than all before. The counts are a written
    table: they must not be worked out again once the facts are stored.
    """
    version_id = wh.current_version()
    with ExitStack() as kept_until_end:

        def keep(df: DataFrame) -> DataFrame:
            return kept_until_end.enter_context(_persisted(df))

        def store(df: DataFrame, purpose: str) -> DataFrame:
            return kept_until_end.enter_context(_stored(wh, df, purpose))

        heads = keep(_heads(batch))
        if marker:
            heads = keep(mark_fresh(heads, [*ARRIVAL, "epoch"], "epoch", marker.epoch))
        else:
            heads = heads.withColumn("fresh", F.lit(True))
        day = from_epoch(F.col("epoch")).cast("date").cast("string")
        first, last, dates = heads.where("fresh").agg(F.min("epoch"), F.max("epoch"), F.collect_set(day)).first()
        if first is None:
            return _kept_counts(wh, _cycles(heads))
        newer = tried is not None and tried.begin(first, last)
        fresh = batch.withColumn("epoch", epoch()).join(
            heads.where("fresh").select("file_path", "epoch"), ["file_path", "epoch"]
        )
        schedule = store(wh.schedule(version_id, mentioned_trips(fresh, wh.cfg)), "planned")
        facts = store(match_snapshots(fresh, schedule, version_id, wh.cfg), "matched")
        kept, bad = facts, keep(integrity.orphans(facts, wh.dimensions(version_id)))
        if on_orphans == "quarantine":
            kept, rejected = integrity.drop_orphans(facts, bad)
            rejected.write.mode("append").parquet(wh.path("_rejected_facts"))
        else:
            integrity.require_references(bad)

        order = [*ARRIVAL, *POSITION, F.asc("delay_s"), "status"]
        if newer:
            new = keep_first(kept, PRIMARY_KEYS["fact_delay"], order)
        else:  # stored rows can only clash on the snapshot times of this batch
            first, last = (datetime.fromtimestamp(s, timezone.utc) for s in (first, last))
            stored = wh.read("fact_delay", sorted(dates)).where(F.col("ts").between(ntz(first), ntz(last)))
            new = insertable(stored, kept, PRIMARY_KEYS["fact_delay"], order)
        new = store(new.select(*FACT_COLUMNS), "new")
        cycles = _kept_counts(wh, _cycles(heads, facts, new))
        wh.append("fact_delay", new.withColumn("ts_date", F.col("ts").cast("date")))
        log_touched(wh, "fact_delay", kept, "ts")
        return cycles


def _kept_counts(wh: Warehouse, cycles: DataFrame) -> DataFrame:
    folder = shared_folder(wh.spark, "cycles")
    cycles.write.parquet(folder)
    return wh.spark.read.schema(cycles.schema).parquet(folder)


def audit(
    wh: Warehouse, cycles: DataFrame, started: datetime, seconds: float, error: str | Column | None = None
) -> None:
    """Append one audit row per snapshot; a failure here is logged and nothing else.

    Rows of one batch are one microsecond apart, in the order of arrival, so that
    `started_at` stays a key. `error` is a message for all rows, or a column of them.
    """
    try:
        message = error if isinstance(error, Column) else F.lit(error).cast("string")
        rows = numbered(cycles, [*ARRIVAL, "epoch"]).select(
            _after(started, F.col("place")).alias("started_at"),
            "snapshot_ts",
            F.col("observed").cast("int").alias("observed"),
            F.col("inserted").cast("int").alias("inserted"),
            F.lit(Decimal(str(round(seconds, 3)))).cast("decimal(12,3)").alias("seconds"),
            "status",
            F.left(message, F.lit(MAX_ERROR_CHARS)).alias("error"),
        )
        wh.append("fact_run", rows.withColumn("week_start", week_start(F.col("started_at"))))
    except Exception:
        log.exception("audit rows not written")


def _after(started: datetime, micros: Column) -> Column:
    return ntz(to_utc(started)) + F.make_dt_interval(secs=micros.cast("decimal(18,6)") / F.lit(1_000_000).cast("decimal(18,6)"))


def _failed(heads: DataFrame) -> DataFrame:
    counts = heads.withColumn("fresh", F.lit(False))
    return _cycles(counts).withColumn("status", F.lit(RUN_ERROR))


def process_batch(
    wh: Warehouse,
    batch: DataFrame,
    batch_id: int,
    marker: Marker | None = None,
    clock: Callable[[], datetime] = clock_now,
    on_orphans: str = "fail",
    run_id: str = "",
    tried: Tried | None = None,
) -> None:
    """One micro-batch: store, audit; what fails is audited as error and set aside.

    A batch that fails is halved, by snapshot time, until only the snapshots that fail by
    themselves are left; the others are stored. Records that cannot be read are set aside for good
    and audited as errors, while the other snapshots go on. Input is set aside below the id of the
    query's run, so that no later run, whose batch ids start over, touches it; `retry_waiting`
    takes it up in later cycles. Replays are harmless: stored keys are not inserted again. Should
    even the set-aside fail, the error stops the query and Spark repeats the batch after a restart.
    """
    started, t0 = clock(), time.monotonic()
    with _stored(wh, batch, "batch") as batch:
        lost = batch.where(unreadable())
        if not lost.isEmpty():
            log.error("batch %s holds unreadable records", batch_id)
            lost.withColumn("run", F.lit(run_id)).write.mode("append").json(wh.path("_unreadable"))
            reason = F.concat(F.lit("unreadable record in "), F.col("file_path"))
            heads = lost.select(*ARRIVAL, epoch().alias("epoch"))
            audit(wh, _failed(heads), started, time.monotonic() - t0, reason)
            started = started + timedelta(seconds=1)  # keys of the rows that follow
        good = batch.where(~unreadable())
        try:
            stored, failed = [store_batch(wh, good, marker, on_orphans, tried)], []
        except Exception as error:
            log.exception("batch %s failed, its snapshots are tried in halves", batch_id)
            stored, failed = _in_halves(wh, good, marker, on_orphans, tried, error)
        for part, error in failed:
            log.error("batch %s: snapshots set aside: %s", batch_id, error)
            part.drop("corrupt").write.mode("append").parquet(f"{wh.path('_quarantine')}/run={run_id}/batch_id={batch_id}")
        if failed:
            _log_attempt(wh, run_id, batch_id, started, failed[0][1])
        for cycles in stored:
            if marker:
                marker.move(cycles)
        _audit_parts(wh, stored, failed, started, time.monotonic() - t0)


def _audit_parts(
    wh: Warehouse, stored: list[DataFrame], failed: list[tuple[DataFrame, str]], started: datetime, seconds: float
) -> None:
    """Audit rows of the parts of one batch, together, so that their keys differ."""
    rows = [cycles.withColumn("error", F.lit(None).cast("string")) for cycles in stored]
    rows += [_failed(_heads(part)).withColumn("error", F.lit(error)) for part, error in failed]
    if rows:
        audit(wh, reduce(DataFrame.unionByName, rows), started, seconds, F.col("error"))
    for cycles in stored:
        _forget(wh, cycles)


def _in_halves(
    wh: Warehouse, batch: DataFrame, marker: Marker | None, on_orphans: str, tried: Tried | None, first_error: Exception
) -> tuple[list[DataFrame], list[tuple[DataFrame, str]]]:
    """Counts of the parts of a failed batch that could be stored, and (part, error) of the rest.

    Which snapshots are stale is settled for the batch as a whole. Snapshots of one time stay
    together, as they share keys; parts are tried in the order of time. After MOST_FAILURES
    failed parts the remaining ones are not halved any more: the fault is not in a few snapshots.
    """
    stored, failed, failures = [], [], 1
    if marker:
        heads = written(mark_fresh(_heads(batch), [*ARRIVAL, "epoch"], "epoch", marker.epoch), "fresh")
        stale = _cycles(heads.where("not fresh"))
        if not stale.isEmpty():
            stored.append(_kept_counts(wh, stale))
        keys = heads.where("fresh").select("file_path", "epoch")
        batch = batch.withColumn("epoch", epoch()).join(keys, ["file_path", "epoch"]).select(*batch.columns)
    waiting = [(batch, first_error)]
    while waiting:
        part, error = waiting.pop()
        times = part.select(epoch().alias("epoch")).distinct()
        middle, newest = times.agg(F.percentile_approx("epoch", 0.5), F.max("epoch")).first()
        before = epoch() < middle if middle == newest else epoch() <= middle
        halves = [part.where(before), part.where(~before)]
        if failures > MOST_FAILURES or halves[0].isEmpty():
            failed.append((part, str(error)))
            continue
        for half in reversed(halves):  # the later one waits below
            waiting.append((half, None))
        while waiting and waiting[-1][1] is None:
            half, _ = waiting.pop()
            try:
                stored.append(store_batch(wh, half, None, on_orphans, tried))
            except Exception as again:
                failures += 1
                waiting.append((half, again))
    return stored, failed


def _log_attempt(wh: Warehouse, run: str, batch_id: int, at: datetime, error: str) -> None:
    row = [(run, batch_id, to_utc(at), error[:MAX_ERROR_CHARS])]
    wh.spark.createDataFrame(row, ATTEMPT).coalesce(1).write.mode("append").json(wh.path("_attempts"))


def attempts(wh: Warehouse) -> DataFrame:
    """Failed attempts to store batches that are, or were, set aside."""
    folder = wh.path("_attempts")
    return wh.spark.read.schema(ATTEMPT).json(folder) if wh.names(folder) else wh.spark.createDataFrame([], ATTEMPT)


def waiting_batches(wh: Warehouse) -> list[tuple[str, int]]:
    """(run, batch id) of what is set aside."""
    folder = wh.path("_quarantine")
    return [
        (run.split("=")[1], int(batch.split("=")[1])) for run in wh.names(folder) for batch in wh.names(f"{folder}/{run}")
    ]


def retry_waiting(
    wh: Warehouse, clock: Callable[[], datetime] = clock_now, on_orphans: str = "fail", tried: Tried | None = None
) -> bool:
    """Try one batch that is set aside again, the one due for longest; whether it is stored now.

    A batch is due once twice as long has passed, for each attempt so far, as between two cycles;
    after MOST_ATTEMPTS it waits for `replay_quarantine`.
    """
    waiting = set(waiting_batches(wh))
    if not waiting:
        return False
    last = attempts(wh).groupBy("run", "batch_id").agg(F.count(F.lit(1)).alias("n"), F.max("at").alias("at")).collect()
    now, pause = to_utc(clock()), wh.cfg.poll_seconds
    due = [
        (row["at"] + timedelta(seconds=pause * 2 ** row["n"]), row["run"], row["batch_id"])
        for row in last
        if (row["run"], row["batch_id"]) in waiting and row["n"] < MOST_ATTEMPTS
    ]
    due = sorted(entry for entry in due if entry[0] <= now)
    return bool(due) and _replay(wh, *due[0][1:], clock, on_orphans, tried)


def _forget(wh: Warehouse, cycles: DataFrame) -> None:
    """Delete a batch's written counts."""
    for path in {f.rsplit("/", 1)[0] for f in cycles.inputFiles()}:
        wh.delete(path)


def replay_quarantine(
    wh: Warehouse, clock: Callable[[], datetime] = clock_now, on_orphans: str = "fail"
) -> int:
    """Process the inputs of failed batches again; returns how many batches succeeded.

    A batch of which some snapshots fail again is audited, stays where it is and holds up no other.
    """
    return sum(_replay(wh, run, batch_id, clock, on_orphans, None) for run, batch_id in sorted(waiting_batches(wh)))


def _replay(
    wh: Warehouse, run: str, batch_id: int, clock: Callable[[], datetime], on_orphans: str, tried: Tried | None
) -> bool:
    folder = f"{wh.path('_quarantine')}/run={run}/batch_id={batch_id}"
    part = wh.spark.read.schema(f"{FEED}, arrived bigint, file_path string").parquet(folder)
    started, t0 = clock(), time.monotonic()
    try:
        stored, failed = [store_batch(wh, part, None, on_orphans, tried)], []
    except Exception as error:
        log.exception("batch %s of run %s failed again", batch_id, run)
        stored, failed = _in_halves(wh, part, None, on_orphans, tried, error)
    if failed:
        _log_attempt(wh, run, batch_id, started, failed[0][1])
    _audit_parts(wh, stored, failed, started, time.monotonic() - t0)
    if not failed:
        wh.delete(folder)
    return not failed


def run_live(
    wh: Warehouse,
    landing: str,
    checkpoint: str,
    once: bool = False,
    max_files: int = 1,
    on_orphans: str = "fail",
    clock: Callable[[], datetime] = clock_now,
    skip_stale: bool = True,
) -> StreamingQuery:
    """Start the live query; `once` processes everything that has landed and stops.

    With `max_files=1` each snapshot is its own cycle, as in live polling; a backlog is
    worked off faster with a larger number. `skip_stale=False` is for a backlog whose files
    do not arrive in the order of their snapshots.
    """
    wh.current_version()  # fail early when no schedule has been loaded
    marker = Marker(wh) if skip_stale else None
    tried = Tried(wh)
    run_id = uuid.uuid4().hex

    def handle(batch: DataFrame, batch_id: int) -> None:
        process_batch(wh, batch, batch_id, marker, clock, on_orphans, run_id, tried)
        retry_waiting(wh, clock, on_orphans, tried)

    writer = (
        stream_snapshots(wh.spark, landing, max_files)
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
    )
    trigger = {"availableNow": True} if once else {"processingTime": f"{wh.cfg.poll_seconds} seconds"}
    return writer.trigger(**trigger).start()
