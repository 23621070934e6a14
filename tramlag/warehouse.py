"""Stored tables: partitioned Parquet folders below one root on shared storage.

Dimensions are written whole per load (`load_id` = version id) and become visible with
their version row, which is written last. Schedules are append-only, laid out by trip.

Partitions of facts, audit rows and aggregates have generations, folders `gen=...` below the
date. Appends add files to the generation in force, which is `0` until the partition is
replaced. A replacement (refresh, compaction, retention) writes a new generation and then one
file of pointer rows, [commit, value, gen], which makes all its partitions visible at once:
a job that dies before leaves nothing that a reader sees. The generation before stays for
readers that have begun, until the next replacement.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import DEFAULTS, NO_SCHEDULE_LABEL, Settings
from .operators import integrity
from .operators.upsert import upsert
from .schemas import NOT_NULL, PARTITION_COLUMN, PRIMARY_KEYS, SCHEDULE_REFERENCES, TABLES

DIMENSIONS = ["dim_line", "dim_stop", "dim_operator", "dim_date"]
DATE_PARTITIONS = ["ts_date", "week_start", "bucket_date"]
FIRST_GENERATION = "0"
MOST_POINTER_FILES = 64  # a commit beyond that writes all pointers into one file


class NoVersionError(LookupError):
    """No schedule version is published yet."""


class ClaimedError(RuntimeError):
    """Another job holds the claim, or has taken it over."""


class ReplacedError(RuntimeError):
    """Data changed while a job was working on it; the job can be repeated."""


def dated(table: str) -> bool:
    """Whether a table's partitions are dates, which have generations."""
    return PARTITION_COLUMN.get(table) in DATE_PARTITIONS


class Warehouse:
    def __init__(self, spark: SparkSession, root: str, cfg: Settings = DEFAULTS):
        self.spark = spark
        self.root = root.rstrip("/")
        self.cfg = cfg
        self._pointers: dict[str, tuple[list[str], int, dict[str, str]]] = {}
        self._latest: tuple[list[str], int | None] | None = None

    # ------------------------------------------------------------ files

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _hadoop(self, path: str):
        jvm_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return jvm_path.getFileSystem(self.spark._jsc.hadoopConfiguration()), jvm_path

    def exists(self, path: str) -> bool:
        files, jvm_path = self._hadoop(path)
        return files.exists(jvm_path)

    def delete(self, path: str) -> None:
        files, jvm_path = self._hadoop(path)
        files.delete(jvm_path, True)

    def names(self, folder: str) -> list[str]:
        """Names in a folder, hidden ones left out; none if it is not there."""
        if not self.exists(folder):
            return []
        files, jvm_path = self._hadoop(folder)
        found = [status.getPath().getName() for status in files.listStatus(jvm_path)]
        return sorted(name for name in found if not name.startswith(("_", ".")))

    def text(self, path: str) -> str:
        """Content of a small file."""
        files, jvm_path = self._hadoop(path)
        stream = files.open(jvm_path)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, path: str, text: str) -> None:
        """Write a small file that appears with all its content, by renaming."""
        folder, name = path.rsplit("/", 1)
        files, hidden = self._hadoop(f"{folder}/_{name}")
        stream = files.create(hidden, True)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()
        if not files.rename(hidden, self._hadoop(path)[1]):
            raise OSError(f"{path} could not be written")

    def stored_bytes(self, table: str, value: str) -> int:
        """Size of what one partition holds."""
        files, jvm_path = self._hadoop(self._partition_path(table, value))
        return files.getContentSummary(jvm_path).getLength() if files.exists(jvm_path) else 0

    # ------------------------------------------------------------ generations

    def _pointer_folder(self, table: str) -> str:
        return f"{self.root}/_pointers/{table}"

    def generations(self, table: str) -> dict[str, str]:
        """Generation in force of every partition that was ever replaced."""
        return self._current(table)[2]

    def _current(self, table: str) -> tuple[list[str], int, dict[str, str]]:
        """(pointer files, last commit, generations); reads the files again only when there are others."""
        folder = self._pointer_folder(table)
        files = self.names(folder)
        known = self._pointers.get(table)
        if known is None or known[0] != files:
            rows = sorted(tuple(json.loads(line)) for f in files for line in self.text(f"{folder}/{f}").splitlines())
            known = files, rows[-1][0] if rows else 0, {value: gen for _, value, gen in rows}
            self._pointers[table] = known
        return known

    def _partition_path(self, table: str, value: str) -> str:
        folder = f"{self.path(table)}/{PARTITION_COLUMN[table]}={value}"
        return f"{folder}/gen={self.generations(table).get(value, FIRST_GENERATION)}" if dated(table) else folder

    def _point(self, table: str, values: Iterable[str], gen: str) -> None:
        """Make `gen` the generation of the partitions, all at once: one row each, in one new file."""
        files, last, known = self._current(table)
        rows = [(last + 1, value, gen) for value in sorted(values)]
        if len(files) >= MOST_POINTER_FILES:
            rows += [(last, value, old) for value, old in known.items() if value not in set(values)]
        self.put(f"{self._pointer_folder(table)}/{last + 1:012}-{gen}", "\n".join(map(json.dumps, rows)))
        if len(files) >= MOST_POINTER_FILES:
            for name in files:
                self.delete(f"{self._pointer_folder(table)}/{name}")

    def _stored(self, table: str) -> dict[str, list[str]]:
        """Generations that have a folder, in force or not, by partition."""
        prefix = PARTITION_COLUMN[table] + "="
        files, pattern = self._hadoop(f"{self.path(table)}/{prefix}*/gen=*")
        found: dict[str, list[str]] = {}
        for status in files.globStatus(pattern) or []:
            value, gen = status.getPath().toString().rsplit("/", 2)[-2:]
            found.setdefault(value[len(prefix) :], []).append(gen[len("gen=") :])
        return found

    def partitions(self, table: str) -> list[str]:
        """Values of the partition column that hold data; of tables without generations, published or not."""
        if dated(table):
            known = self.generations(table)
            return sorted(v for v, gens in self._stored(table).items() if known.get(v, FIRST_GENERATION) in gens)
        prefix = PARTITION_COLUMN[table] + "="
        return sorted(name[len(prefix) :] for name in self.names(self.path(table)) if name.startswith(prefix))

    def replace_partitions(self, table: str, df: DataFrame, values: Iterable[str]) -> None:
        """Make `df` the whole content of the partitions `values`; those without rows become empty.

        Readers see all of it or nothing. Generations before the one that is replaced are deleted,
        among them what replacements left behind that never became visible.
        """
        values, column, gen = set(values), PARTITION_COLUMN[table], uuid.uuid4().hex
        known = self.generations(table)
        (
            df.withColumn("gen", F.lit(gen))
            .hint("rebalance", column)
            .write.mode("append")
            .partitionBy(column, "gen")
            .parquet(self.path(table))
        )
        self._point(table, values, gen)
        for value, gens in self._stored(table).items():
            for old in gens:
                if value in values and old not in (gen, known.get(value, FIRST_GENERATION)):
                    self.delete(f"{self.path(table)}/{column}={value}/gen={old}")

    def drop_partitions(self, table: str, drop: Callable[[str], bool]) -> list[str]:
        """Empty the partitions whose value satisfies `drop`, all at once, and delete them; returns them."""
        dropped = [value for value in self.partitions(table) if drop(value)]
        if dropped and dated(table):
            self._point(table, dropped, uuid.uuid4().hex)
        for value in dropped:
            self.delete(f"{self.path(table)}/{PARTITION_COLUMN[table]}={value}")
        return dropped

    def files(self, table: str, value: str) -> list[str]:
        """Names of the data files of one partition."""
        return self.names(self._partition_path(table, value))

    def compact(self, table: str, value: str) -> None:
        """Rewrite one partition, to which nothing is appended any more, in full-sized files.

        Should something have been appended after all, nothing is replaced.
        """
        before = self.files(table, value)
        rows = self.read(table, [value])
        column, gen, old = PARTITION_COLUMN[table], uuid.uuid4().hex, self._partition_path(table, value)
        rows.withColumn("gen", F.lit(gen)).hint("rebalance", column).write.mode("append").partitionBy(
            column, "gen"
        ).parquet(self.path(table))
        if self.files(table, value) != before or self._partition_path(table, value) != old:
            self.delete(f"{self.path(table)}/{column}={value}/gen={gen}")
            raise ReplacedError(f"{table} {value} changed while it was compacted")
        self._point(table, [value], gen)

    # ------------------------------------------------------------ claims

    @contextmanager
    def claim(self, job: str, clock: Callable[[], datetime] | None = None) -> Iterator[Callable[[], None]]:
        """Exclusive right to a job; raises ClaimedError while another holds it.

        A claim is a numbered file, `N.done` says that it was given back. Creating a file that is
        there fails, so of two that want the next number only one gets it. A claim older than the
        lease, whose holder must have died, is followed by the next number as well. Yields a check,
        to be made before results become visible, that raises when the claim has been taken over.
        """
        folder = f"{self.root}/_claims/{job}"
        files, jvm_folder = self._hadoop(folder)
        held = {}
        if files.exists(jvm_folder):
            held = {s.getPath().getName(): s.getModificationTime() / 1000 for s in files.listStatus(jvm_folder)}
        top = self._top_claim(held)
        if top and f"{top}.done" not in held:
            age = (clock or clock_now)().timestamp() - held[str(top)]
            if age < self.cfg.claim_lease.total_seconds():
                raise ClaimedError(f"{job} is being done: claim {top} is {age:.0f} s old")
        number = top + 1

        def check() -> None:
            if self._top_claim(self.names(folder)) != number:
                raise ClaimedError(f"claim {number} to {job} was taken over")

        try:
            files.create(self._hadoop(f"{folder}/{number}")[1], False).close()
        except Py4JJavaError as error:
            raise ClaimedError(f"{job} was claimed by another at the same moment") from error
        check()
        for name in held:
            self.delete(f"{folder}/{name}")
        try:
            yield check
        finally:
            files.create(self._hadoop(f"{folder}/{number}.done")[1], True).close()

    @staticmethod
    def _top_claim(names: Iterable[str]) -> int:
        return max((int(name.split(".")[0]) for name in names), default=0)

    # ------------------------------------------------------------ reads

    def read(self, table: str, only: list[str] | None = None) -> DataFrame:
        """The stored table; empty while nothing has been written.

        `only` names the partitions to open. Other folders are then not even listed, which
        matters for tables that grow by a file per cycle.
        """
        folder, schema = self.path(table), TABLES[table]
        if dated(table):
            known, shown = self.generations(table), set(self.partitions(table))
            wanted = sorted(shown if only is None else shown.intersection(only))
            column, schema = PARTITION_COLUMN[table], schema + ", gen string"
            paths = [f"{folder}/{column}={value}/gen={known.get(value, FIRST_GENERATION)}" for value in wanted]
        else:
            wanted = [folder] if only is None else [self._partition_path(table, value) for value in only]
            paths = [path for path in wanted if self.exists(path)]
            schema += ", trip_part string" if table == "schedule" else ""
        if not paths:
            return self.spark.createDataFrame([], TABLES[table])
        return self.spark.read.schema(schema).option("basePath", folder).parquet(*paths).drop("gen", "trip_part")

    def current_version(self) -> int:
        """The version loaded last (ties: the greatest id); looked up again only when loads have been added."""
        files = self.names(self.path("dim_version"))
        if self._latest is None or self._latest[0] != files:
            latest = self.read("dim_version").orderBy(F.desc("loaded_at"), F.desc("version_id"))
            row = latest.select("version_id").first()
            self._latest = files, row[0] if row else None
        if self._latest[1] is None:
            raise NoVersionError("no schedule version; run the static load first")
        return self._latest[1]

    def dimension(self, table: str, version_id: int | None = None) -> DataFrame:
        """A dimension as published with a version, the current one by default."""
        if table == "dim_version":
            return self.read(table)
        version_id = self.current_version() if version_id is None else version_id
        return self.read(table, [str(version_id)]).drop("load_id")

    def schedule(self, version_id: int, trips: DataFrame | None = None) -> DataFrame:
        """Planned stops of one version; reads no other version's files.

        With `trips` (trip_id) just theirs, from the parts of the version that hold such trips.
        A part is known by its number, so the driver gets at most as many as a version has.
        """
        folder = f"{self.path('schedule')}/version_id={version_id}"
        if trips is None or not (stored := self.names(folder)):
            return self.read("schedule", [str(version_id)]).drop("version_id")
        trips = trips.select("trip_id").where("trip_id is not null").distinct()
        number = int(stored[0].split("=")[1].split("-")[0])  # as it was when the version was written
        wanted = {f"trip_part={row[0]}" for row in trips.select(trip_part(number)).distinct().collect()}
        paths = [f"{folder}/{name}" for name in stored if name in wanted]
        if not paths:
            return self.read("schedule", []).drop("version_id")
        reader = self.spark.read.schema(f"{TABLES['schedule']}, trip_part string").option("basePath", self.path("schedule"))
        return reader.parquet(*paths).drop("version_id", "trip_part").join(trips, "trip_id", "left_semi")

    def dimensions(self, version_id: int) -> dict[str, DataFrame]:
        return {t: self.dimension(t, version_id) for t in [*DIMENSIONS, "dim_version"]}

    def register_views(self) -> None:
        """Temporary views of all tables for `spark.sql` reports."""
        for table in TABLES:
            is_dim = table in DIMENSIONS
            df = self.dimension(table) if is_dim else self.read(table)
            df.createOrReplaceTempView(table)

    # ------------------------------------------------------------ writes

    def append(self, table: str, df: DataFrame) -> None:
        """Append rows. Rows of many dates are gathered by date first, in right-sized files."""
        column = PARTITION_COLUMN.get(table)
        if not dated(table):
            writer = df.write.mode("append")
            (writer.partitionBy(column) if column else writer).parquet(self.path(table))
            return
        gen, known = F.lit(FIRST_GENERATION), self.generations(table)
        if known:
            replaced = F.create_map(*[F.lit(part) for pair in known.items() for part in pair])
            gen = F.coalesce(replaced[F.col(column).cast("string")], gen)
        df.withColumn("gen", gen).hint("rebalance", column).write.mode("append").partitionBy(column, "gen").parquet(self.path(table))

    def next_version_id(self) -> int:
        """One past every id ever used, including loads that were never published."""
        used = [int(v) for table in ["schedule", *DIMENSIONS] for v in self.partitions(table)]
        published = self.read("dim_version").agg(F.max("version_id")).first()[0]
        return max([*used, published or 0]) + 1

    def publish(
        self,
        version: DataFrame,
        version_id: int,
        dims: dict[str, DataFrame],
        schedule: DataFrame,
        keep_known_day_type: bool = False,
        check: Callable[[], None] = lambda: None,
    ) -> None:
        """Store one load. Readers see nothing of it before its version row is written.

        The dimensions go on from the version in force. Should that have changed meanwhile, or
        `check` (of the load's claim) raise, the version row is not written.
        """
        previous = self._version_in_force()
        for table in DIMENSIONS:
            keys = PRIMARY_KEYS[table]
            batch = dims[table].persist()
            integrity.require_keys(batch, keys, NOT_NULL[table], table)
            merged = batch
            if previous is not None:
                target = self.dimension(table, previous)
                if table == "dim_date" and keep_known_day_type:
                    merged = keep_known_labels(target, merged)
                merged = upsert(target, merged, keys)
            self.append(table, merged.withColumn("load_id", F.lit(version_id)))
            batch.unpersist()
        by_trip = schedule.withColumn("trip_part", trip_part(self.cfg.schedule_parts)).hint("rebalance", "trip_part")
        placed = by_trip.sortWithinPartitions("trip_part", "trip_id", "stop_sequence")
        placed.write.mode("append").partitionBy("trip_part").parquet(f"{self.path('schedule')}/version_id={version_id}")
        stored = self.read("schedule", [str(version_id)])
        integrity.require_keys(stored, PRIMARY_KEYS["schedule"], NOT_NULL["schedule"], "schedule")
        version = version.coalesce(1).persist()
        integrity.require_references(integrity.orphans(stored, {"dim_version": version}, SCHEDULE_REFERENCES), "schedule")
        check()
        if self._version_in_force() != previous:
            raise ReplacedError(f"another load was published after version {previous}")
        self.append("dim_version", version)
        version.unpersist()

    def _version_in_force(self) -> int | None:
        try:
            return self.current_version()
        except NoVersionError:
            return None


def keep_known_labels(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Batch days without a schedule keep the label that an earlier load gave them."""
    known = target.where(F.col("day_type") != NO_SCHEDULE_LABEL).select(
        "date", F.col("day_type").alias("_known")
    )
    label = F.when(F.col("day_type") == NO_SCHEDULE_LABEL, F.coalesce("_known", "day_type"))
    return batch.join(known, "date", "left").withColumn("day_type", label.otherwise(F.col("day_type"))).drop("_known")


def trip_part(number: int) -> Column:
    """Label of the part, of so many, in which a trip's planned stops are stored: `number-part`."""
    return F.concat(F.lit(f"{number}-"), F.pmod(F.xxhash64("trip_id"), F.lit(number)).cast("string"))


def week_start(ts: Column) -> Column:
    """Monday of the UTC week, the partition of audit rows."""
    day = ts.cast("date")
    return F.date_sub(day, F.weekday(day))


def clock_now() -> datetime:
    return datetime.now(timezone.utc)
