"""The star tables and cuboids of one data folder, written once and read many times.

Tables live under the shared folder that `spark.checkpoint.dir` names, so an
executor that is lost takes no state with it and every later query starts from
a table instead of the raw joins. A manifest beside them says which table was
written where and from which version of its input; later sessions find it there.
"""

from __future__ import annotations

import hashlib
import pathlib
import threading
import time
import uuid
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starlattice.functions.periods import ALL_TIME_COLUMNS, time_key
from starlattice.operators import cuboids, distinct, grams, star
from starlattice.operators.conform import conform
from starlattice.operators.upsert import replace_partitions
from starlattice.sources import given_tables
from starlattice.sources.files import write_buckets, write_full_refresh
from starlattice.sources.storage import drop_folder, exists, fingerprint, partition_values, read_if_there, replace_folder

# A dimension up to this many rows is broadcast: keys and a few short strings, about 10 MB.
BROADCAST_ROWS = 100_000

# Tables that are written at the same time.
CONCURRENT_JOBS = 8

# The month that dim_time always contains when the given tables are loaded.
AS_OF = date(2001, 12, 31)

# Rows of one customer or product that one task of a refresh may take.
HOT_ROWS = 4_000_000

# Where true, Spark reads in buckets only for a sum or join.
AUTO_BUCKETED_SCAN = "spark.sql.sources.bucketing.autoBucketedScan.enabled"

# Refreshes of a cube that stay for readers of an earlier one.
KEPT_REFRESHES = 2

FACT_OF = {"sales": "fact_sales", "inventory": "fact_inventory"}

MANIFEST = "version string, name string, path string, schema string, row_count bigint, measure_sum bigint, refresh string, at bigint"


def shared_folder(spark: SparkSession) -> str | None:
    """The cluster's shared folder, if the session names one."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return configured.rstrip("/") if configured else None


@dataclass(frozen=True)
class Stored:
    """A written table: where it lies, its rows and the sum of its first measure."""

    name: str
    path: str
    schema: str
    row_count: int
    measure_sum: int | None


Builder = Callable[["Warehouse"], DataFrame]


class Warehouse:
    """Star tables by name, cuboids by name, each built on first use.

    With a `root` folder every table is written there, below a name of its own,
    and read back, except the `views`; without one the tables stay lazy
    DataFrames. `version` names the content of the input; tables that another
    session wrote from the same version are read instead of built.
    """

    def __init__(
        self,
        spark: SparkSession,
        builders: Mapping[str, Builder],
        root: str | None = None,
        *,
        folder: str = "",
        partition_by: Mapping[str, str] | None = None,
        sort_by: Mapping[str, str] | None = None,
        views: frozenset[str] = frozenset(),
        dealt: frozenset[str] = frozenset(),
        broadcast_rows: int = BROADCAST_ROWS,
        version: Callable[[], str] | None = None,
        changed_years: Callable[[str, str], list[int]] | None = None,
        view_rows: Callable[[str], int | None] = lambda name: None,
    ):
        self.spark = spark
        self.root = root
        self.folder = folder
        self._builders = {**distinct.BUILDERS, **grams.BUILDERS, **builders}
        derived = dict.fromkeys(distinct.BUILDERS, "year") | dict.fromkeys(grams.BUILDERS, grams.LEAD)
        self._partition_by = derived | dict(partition_by or {})
        self._sort_by = dict.fromkeys(grams.BUILDERS, grams.GRAM) | dict(sort_by or {})
        self._views = views
        # Tables whose builders leave the rows where they are written.
        self._dealt = dealt
        self._broadcast_rows = broadcast_rows
        self._version = version
        self._changed_years = changed_years
        self._view_rows = view_rows
        self._tables: dict[str, DataFrame] = {}
        self._stored: dict[str, Stored] = {}
        self._small: dict[str, bool] = {}
        self._lock = threading.Lock()
        self._building: dict[str, threading.RLock] = {}
        self._find_stored()

    # --- what earlier sessions wrote ---

    def _find_stored(self) -> None:
        """The newest table of each name that was written from the current version."""
        if self.root is None or self._version is None:
            return
        manifest = read_if_there(self.spark, f"{self.root}/manifest", MANIFEST, nested=True)
        if manifest is None:
            return
        rows = manifest.where(F.col("version") == self._version()).orderBy("at").collect()
        for row in rows:
            found = Stored(row["name"], row["path"], row["schema"], row["row_count"], row["measure_sum"])
            self._stored[row["name"]] = found
        for name, found in list(self._stored.items()):
            if exists(self.spark, found.path):
                self._tables[name] = self._read(found)
            else:
                del self._stored[name]

    def _publish(self, written: Iterable[Stored], refresh: str = "") -> None:
        if self._version is None:
            return
        version, at = self._version(), time.time_ns()
        rows = [(version, w.name, w.path, w.schema, w.row_count, w.measure_sum, refresh, at) for w in written]
        # A folder of its own: tables are published at the same time.
        path = f"{self.root}/manifest/{uuid.uuid4().hex}"
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.parquet(path)

    def _read(self, found: Stored) -> DataFrame:
        rows = self.spark.read.schema(found.schema).parquet(found.path)
        # A cuboid without years that was written beside others has a folder of no year.
        return rows.select(*StructType.fromDDL(found.schema).names)

    def _write(self, name: str, df: DataFrame, folder: str, partition_by: str | None) -> Stored:
        """Writes a table below a path that nothing has used; its counts come with the write."""
        path = f"{self.root}/{folder}/{name}-{uuid.uuid4().hex[:12]}"
        counts, watch = self._counts(name)
        write_full_refresh(
            df,
            path,
            partition_by=partition_by,
            sort_by=self._sort_by.get(name),
            # Cuboids come out of a shuffle in parts of like size, and a part has few years.
            spread=name not in self._dealt and name not in cuboids.CUBOIDS and name not in distinct.BUILDERS,
            watch=watch,
        )
        schema = ", ".join(f"`{column}` {kind}" for column, kind in df.dtypes)
        return Stored(name, path, schema, counts.get["row_count"], counts.get["measure_sum"])

    def _keep(self, name: str, df: DataFrame, folder: str, partition_by: str | None) -> DataFrame:
        if self.root is None:
            return df
        found = self._write(name, df, folder, partition_by)
        self._publish([found])
        self._stored[name] = found
        return self._read(found)

    # --- tables ---

    def _once(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The named table, built by the first caller while others of the same name wait."""
        with self._lock:
            building = self._building.setdefault(name, threading.RLock())
        with building:
            if name not in self._tables:
                self._tables[name] = build()
            return self._tables[name]

    def table(self, name: str) -> DataFrame:
        def build() -> DataFrame:
            built = self._builders[name](self)
            return built if name in self._views else self._keep(name, built, "star", self._partition_by.get(name))

        return self._once(name, build)

    def stored_paths(self, names: Iterable[str]) -> dict[str, str]:
        """Where the named tables are written; tables that are views or not stored are left out."""
        for name in names:
            self.table(name)
        return {name: self._stored[name].path for name in names if name in self._stored}

    def prepare(self, names: Iterable[str]) -> None:
        """Build several tables at the same time; one that needs another waits for it."""
        with ThreadPoolExecutor(CONCURRENT_JOBS) as jobs:
            list(jobs.map(inheritable_thread_target(self.spark)(self.table), names))

    def is_small(self, name: str) -> bool:
        """True when the table has at most `broadcast_rows` rows; stops counting there."""
        if name not in self._small:
            bound = self._broadcast_rows
            self._small[name] = self.root is not None and self.table(name).limit(bound + 1).count() <= bound
        return self._small[name]

    def row_count(self, name: str) -> int | None:
        """How many rows a stored table has, a view at most; None where that is not known."""
        self.table(name)
        return self._stored[name].row_count if name in self._stored else self._view_rows(name)

    def _is_view(self, cuboid: cuboids.Cuboid) -> bool:
        """The finest cuboids have the rows of their fact; with few dimension rows they stay a join."""
        people = {"sales": "dim_customer", "inventory": "dim_store"}[cuboid.cube]
        return cuboid.is_detail and cuboid.time == "month" and self.is_small(people)

    def cuboid(self, name: str) -> DataFrame:
        """A cuboid, summed from the smallest stored parent or else from the fact."""
        cuboid = cuboids.CUBOIDS[name]
        if name not in self._tables and self._is_view(cuboid):
            return cuboids.build(self, cuboid)

        def build() -> DataFrame:
            known = [self._stored[p.name] for p in cuboids.parents(cuboid) if p.name in self._stored]
            return self._keep(name, self._rows(cuboid, known), "cuboids", self._by_year(cuboid))

        return self._once(name, build)

    def _rows(self, cuboid: cuboids.Cuboid, known: Iterable[Stored]) -> DataFrame:
        """The rows of a cuboid from the written parent with the fewest rows, else from the fact."""
        parent = min(known, key=lambda p: p.row_count, default=None)
        if parent is None:
            return cuboids.build(self, cuboid)
        return cuboids.build_from(cuboids.CUBOIDS[parent.name], self._read(parent), cuboid, parent.row_count)

    @staticmethod
    def _by_year(cuboid: cuboids.Cuboid) -> str | None:
        return "year" if cuboid.time != "none" else None

    def _write_sales_roots(self, folder: str) -> dict[str, Stored]:
        """One scan of the fact and one write for the sales cuboids without a parent, a partition for each."""
        path = f"{self.root}/{folder}/from-one-scan-{uuid.uuid4().hex[:12]}"
        rows, roots, counts = cuboids.sales_roots_from_one_scan(self), cuboids.sales_roots(), Observation()
        seen = []
        for place, cuboid in enumerate(roots):
            own = F.col("cuboid") == cuboid.name
            first = F.when(own, F.col(cuboid.measures[0]))
            seen += [F.count_if(own).alias(f"rows_{place}"), F.sum(first).cast("bigint").alias(f"sum_{place}")]
        write_full_refresh(rows, path, partition_by=("cuboid", "year"), watch=lambda r: r.observe(counts, *seen))
        kinds, found = dict(rows.dtypes), {}
        for place, cuboid in enumerate(roots):
            schema = ", ".join(f"`{c}` {kinds[c]}" for c in (*cuboid.dimensions, *cuboid.measures))
            own = Stored(cuboid.name, f"{path}/cuboid={cuboid.name}", schema, counts.get[f"rows_{place}"], counts.get[f"sum_{place}"])
            if not own.row_count:
                write_full_refresh(self.spark.createDataFrame([], schema), own.path)
            found[cuboid.name] = own
        return found

    def _counts(self, name: str) -> tuple[Observation, Callable[[DataFrame], DataFrame]]:
        """The rows and the first measure's sum of a table, counted as it is written."""
        counts = Observation()
        measures = cuboids.CUBOIDS[name].measures if name in cuboids.CUBOIDS else ()
        first = F.sum(next(iter(measures))).cast("bigint") if measures else F.max(F.lit(None).cast("bigint"))
        seen = (F.count(F.lit(1)).alias("row_count"), first.alias("measure_sum"))
        return counts, lambda rows: rows.observe(counts, *seen)

    def _keys_are_unique(self, name: str, key: str) -> bool:
        known = self.table(name).where(F.col(key).isNotNull())
        return known.groupBy(key).count().where("count > 1").isEmpty()

    def _fits_buckets(self, cube: str) -> bool:
        """True unless a key of sales is so frequent that its bucket would be one large task, or stands twice in its dimension.

        Stock has at most a row a month and store of a product, so its buckets need no look.
        """
        if cube == "inventory":
            return True
        keys = {"dim_time": "time_key", "dim_customer": "customer_key", "dim_location": "location_key"}
        if not all(self._keys_are_unique(name, key) for name, key in keys.items()):
            return False
        tops = [F.expr(f"get(approx_top_k({key}, 1, 10000), 0).count").alias(key) for key in ("customer_key", "product_key")]
        nulls = [F.count_if(F.col(key).isNull()) for key in ("customer_key", "product_key")]
        return max(n or 0 for n in self.table("fact_sales").agg(*tops, *nulls).first()) <= HOT_ROWS

    def refresh_cuboids(self, cube: str, *, one_scan: bool = False) -> list[Stored]:
        """Rebuild every cuboid of a cube from its smallest parent; what was written, by name.

        The fact is read once and shuffled by customer and by product; large cuboids lie in
        buckets of these keys, so that the next are summed from them without a shuffle. Where
        buckets do not fit, each cuboid is shuffled for itself, and with `one_scan` the sales
        cuboids that read the fact come from one scan of it and one write.
        The star tables are looked up anew. A cuboid starts as soon as the parents it
        may be summed from are there. A refresh fills a new folder and is
        published when all of it is written: readers of the last one, in this
        session or another, are not disturbed, and a failed one changes nothing.
        """
        if self.root is None:
            raise ValueError("a refresh needs a shared folder")
        with self._lock:
            for name in self._views:
                self._tables.pop(name, None)
            self._small.clear()
        people = {"sales": "dim_customer", "inventory": "dim_store"}[cube]
        self.prepare([FACT_OF[cube], "dim_time"])
        for name in ("dim_location", people):
            self.is_small(name)
        refresh = f"{cube}-{uuid.uuid4().hex[:12]}"
        folder = f"refresh/{refresh}"
        if self._fits_buckets(cube):
            written = self._refresh_in_buckets(cube, folder)
        else:
            scanned = self._write_sales_roots(folder) if one_scan and cube == "sales" else {}

            def build(cuboid: cuboids.Cuboid, known: list[Stored]) -> Stored:
                if cuboid.name in scanned:
                    return scanned[cuboid.name]
                return self._write(cuboid.name, self._rows(cuboid, known), folder, self._by_year(cuboid))

            written = self._each(cube, cuboids.smallest_parents, build)
        self._publish(written, refresh)
        with self._lock:
            self._stored.update({w.name: w for w in written})
            self._tables.update({w.name: self._read(w) for w in written})
        for name in (*distinct.OF_CUBE[cube], *grams.OF_CUBE[cube]):
            with self._lock:
                self._tables.pop(name, None)
            self.table(name)
        self._expire(cube)
        return written

    def _each(
        self,
        cube: str,
        parents: Callable[[cuboids.Cuboid], list[cuboids.Cuboid]],
        build: Callable[[cuboids.Cuboid, list[Stored]], Stored],
    ) -> list[Stored]:
        """Every cuboid of a cube, several at the same time, each once its parents are there."""
        running: dict[str, Future[Stored]] = {}

        def after_parents(cuboid: cuboids.Cuboid) -> Stored:
            return build(cuboid, [running[p.name].result() for p in parents(cuboid)])

        with ThreadPoolExecutor(CONCURRENT_JOBS) as jobs:
            submitted = inheritable_thread_target(self.spark)(after_parents)
            # Parents are submitted first, so a waiting cuboid waits for one that runs.
            for cuboid in cuboids.refresh_order(cube, parents):
                running[cuboid.name] = jobs.submit(submitted, cuboid)
        return [f.result() for f in running.values()]

    def _refresh_in_buckets(
        self, cube: str, folder: str, years: list[int] | None = None, held: Mapping[str, Stored] | None = None
    ) -> list[Stored]:
        """All cuboids of a cube, the large ones in buckets; the session forgets these when all are written.

        With `years`, cuboids with a time grain have these years alone. Those of all time are whole: sales are
        summed from the fact, stock comes from the yearly snapshots of these years and of the others, which are in the refresh `held`.
        """
        some = self if years is None else _Years(self, years)
        buckets = cuboids.bucket_count(self.row_count(FACT_OF[cube]), self.spark.sparkContext.defaultParallelism)
        if cube == "sales":
            buckets = cuboids.dividing(buckets, int(self.spark.conf.get("spark.sql.shuffle.partitions")))
        in_session: dict[str, str] = {}

        def write(name: str, rows: DataFrame, key: str, by_year: bool, riding: tuple[str, ...] = ()) -> Stored:
            path, table = f"{self.root}/{folder}/{name}-{uuid.uuid4().hex[:12]}", f"{name}_{uuid.uuid4().hex[:12]}"
            counts, watch = self._counts(name)
            keys = [k for k in (key, "product_key", "store_key", *ALL_TIME_COLUMNS[1:]) if k in rows.columns]
            partition_by = "year" if by_year else None
            write_buckets(
                rows, path, table, buckets=buckets, key=key, sort_by=list(dict.fromkeys(keys)), partition_by=partition_by, watch=watch
            )
            in_session[name] = table
            schema = ", ".join(f"`{column}` {kind}" for column, kind in rows.dtypes if column not in riding)
            return Stored(name, path, schema, counts.get["row_count"], counts.get["measure_sum"])

        def rows_of(name: str) -> DataFrame:
            return self.spark.table(in_session[name])

        def build(cuboid: cuboids.Cuboid, known: list[Stored]) -> Stored:
            key = cuboids.bucket_key(cuboid)
            parent = min(known, key=lambda p: p.row_count, default=None)
            if years is not None and cuboid.name == cuboids.ALL_TIME_STOCK:
                rows = self._folded_snapshots(held, cuboid, rows_of(parent.name), years, buckets)
            elif parent is not None:
                finer = cuboids.CUBOIDS[parent.name]
                lies = parent.name in in_session
                read = rows_of(parent.name) if lies else self._read(parent)
                rows = cuboids.build_from(finer, read, cuboid, parent.row_count, in_buckets=lies)
            elif cube == "inventory":
                rows = cuboids.stock_by_product(some, buckets) if key else cuboids.stock_by_store(some)
            else:
                whole = {"customer_key": "sales", "product_key": "sales_by_product"}[key]
                sold = rows_of(whole)
                if years is not None and cuboid.time != "none":
                    sold = cuboids.of_years(sold, years)
                rows = cuboids.known_sums(self, sold, cuboid)
            if key not in cuboids.CUBE_BUCKETS[cube]:
                return self._write(cuboid.name, rows, folder, self._by_year(cuboid))
            return write(cuboid.name, rows, key, cuboid.time != "none", cuboids.riding(cuboid, rows))

        # A plain selection would be read by file, and each task would write to most buckets.
        as_set = self.spark.conf.get(AUTO_BUCKETED_SCAN)
        self.spark.conf.set(AUTO_BUCKETED_SCAN, "false")
        try:
            passing = []
            if cube == "sales":
                passing.append(write("sales", cuboids.sales_with_attributes(self, buckets), "customer_key", False))
                whole = cuboids.sales_by_product(self, rows_of("sales"), buckets)
                passing.append(write("sales_by_product", whole, "product_key", False))
            written = self._each(cube, cuboids.bucket_parents if years is None else cuboids.year_parents, build)
        finally:
            self.spark.conf.set(AUTO_BUCKETED_SCAN, as_set)
            for table in in_session.values():
                self.spark.sql(f"DROP TABLE IF EXISTS `{table}`")
        for stored in passing:
            drop_folder(self.spark, stored.path)
        return written

    # --- refresh of what changed ---

    def _last_refresh(self, cube: str) -> tuple[str, str, dict[str, Stored]] | None:
        """Name and version of the newest refresh of a cube, and what it holds."""
        manifest = read_if_there(self.spark, f"{self.root}/manifest", MANIFEST, nested=True)
        if manifest is None:
            return None
        rows = manifest.where(F.col("refresh").startswith(f"{cube}-")).orderBy("at").collect()
        if not rows:
            return None
        newest = [r for r in rows if r["at"] == rows[-1]["at"]]
        held = {r["name"]: Stored(r["name"], r["path"], r["schema"], r["row_count"], r["measure_sum"]) for r in newest}
        return newest[0]["refresh"], newest[0]["version"], held

    def refresh_changed(self, cube: str) -> list[Stored]:
        """Bring the last refresh of a cube up to date; only years with changed facts are summed again.

        Cuboids with a time grain replace these years. In buckets, as a whole refresh has them, these years are
        written beside the others and then moved among them, and sales of all time are summed from the fact.
        Where buckets do not fit, years are replaced by dynamic partition overwrite, and sales without a time grain
        or a parent are summed from sums that are kept by year of the fact. Stock of all time comes from the yearly
        snapshots, the others from their parents. The result is that of a whole refresh. One that stops half-way is begun again from the same years. Facts
        are added to and changed, never taken out, so no year loses all its rows.
        Readers of the cuboids meanwhile have to begin again.
        """
        last = self._last_refresh(cube) if self.root is not None and self._version is not None else None
        if last is None or self._changed_years is None:
            return self.refresh_cuboids(cube)
        refresh, before, held = last
        if before == self._version():
            return list(held.values())
        with self._lock:
            for name in self._views:
                self._tables.pop(name, None)
            self._small.clear()
        years = sorted(self._changed_years(cube, before))
        replaced: list[str] = []

        def bring_up(cuboid: cuboids.Cuboid) -> Stored:
            old, known = held[cuboid.name], [held[p.name] for p in cuboids.parents(cuboid)]
            if cuboid.time != "none":
                if years:
                    parent = min(known, key=lambda p: p.row_count, default=None)
                    if parent is None:
                        rows = cuboids.build(_Years(self, years), cuboid)
                    else:
                        some = self._read(parent).where(F.col("year").isin(years))
                        rows = cuboids.build_from(cuboids.CUBOIDS[parent.name], some, cuboid, parent.row_count)
                    spread = rows.hint("rebalance", "year") if cuboid.is_detail else rows
                    replace_partitions(spread, old.path, "year")
                return self._counted(old)
            if cuboid.cube == "inventory" and all(cuboids.CUBOIDS[p.name].time != "none" for p in known):
                rows = self._folded_snapshots(held, cuboid)
            elif known:
                rows = self._rows(cuboid, known)
            else:
                rows = self._from_years(cuboid, f"{self.root}/refresh/{refresh}/{cuboid.name}-by-year", years)
            replaced.append(old.path)
            return self._write(cuboid.name, rows, f"refresh/{refresh}", None)

        people = {"sales": "dim_customer", "inventory": "dim_store"}[cube]
        for name in ("dim_location", people):
            self.is_small(name)
        if years and self._fits_buckets(cube):
            written, replaced = self._years_in_buckets(cube, f"refresh/{refresh}", years, held)
        else:
            with ThreadPoolExecutor(CONCURRENT_JOBS) as jobs:
                on_session = inheritable_thread_target(self.spark)(bring_up)
                for level in cuboids.refresh_levels(cube):
                    held |= {w.name: w for w in jobs.map(on_session, level)}
            written = [held[c.name] for level in cuboids.refresh_levels(cube) for c in level]
        self._publish(written, refresh)
        with self._lock:
            self._stored.update({w.name: w for w in written})
            self._tables.update({w.name: self._read(w) for w in written})
        for name in (*distinct.OF_CUBE[cube], *grams.OF_CUBE[cube]):
            with self._lock:
                self._tables.pop(name, None)
        for path in replaced:
            drop_folder(self.spark, path)
        return written

    def _years_in_buckets(
        self, cube: str, folder: str, years: list[int], held: Mapping[str, Stored]
    ) -> tuple[list[Stored], list[str]]:
        """The cuboids of a cube with changed years, summed in buckets, and the folders of `held` that they replace."""
        fresh = self._refresh_in_buckets(cube, folder, years, held)
        replaced: list[str] = []

        def place(new: Stored) -> Stored:
            old = held[new.name]
            if cuboids.CUBOIDS[new.name].time == "none":
                replaced.append(old.path)
                return new
            for year in partition_values(self.spark, new.path, "year"):
                replace_folder(self.spark, f"{new.path}/year={year}", f"{old.path}/year={year}")
            drop_folder(self.spark, new.path)
            return self._counted(old)

        with ThreadPoolExecutor(CONCURRENT_JOBS) as jobs:
            return list(jobs.map(inheritable_thread_target(self.spark)(place), fresh)), replaced

    def _counted(self, old: Stored) -> Stored:
        """The entry of a table whose files changed."""
        rows = self._read(old)
        first = next(iter(cuboids.CUBOIDS[old.name].measures))
        found = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(first).cast("bigint").alias("total")).first()
        return Stored(old.name, old.path, old.schema, found["n"], found["total"])

    def _folded_snapshots(
        self,
        held: Mapping[str, Stored],
        cuboid: cuboids.Cuboid,
        fresh: DataFrame | None = None,
        years: Iterable[int] = (),
        buckets: int | None = None,
    ) -> DataFrame:
        """The latest stock of all time, from the latest of each year, which for some years may be `fresh`; in `buckets` if given."""
        yearly = held[cuboids.YEARLY_STOCK]
        rows = self._read(yearly)
        if fresh is not None:
            rows = rows.where(~F.col("year").isin(list(years))).unionByName(fresh.select(*rows.columns))
        if buckets is not None:
            rows = rows.repartition(buckets, "product_key")
        latest = cuboids.latest_stock(
            rows, (), "total_quantity_on_hand", "year", ("city", "state"), yearly.row_count, in_place=buckets is not None
        )
        return latest.select(*cuboid.dimensions, *cuboid.measures)

    def _from_years(self, cuboid: cuboids.Cuboid, path: str, years: list[int]) -> DataFrame:
        """A cuboid without a time grain or a parent: summed from sums by year of the fact, changed years anew."""
        known = self.table("fact_sales").select(F.expr("time_key div 100").cast("int").alias("year")).distinct()
        missing = {r["year"] for r in known.collect()} - set(partition_values(self.spark, path, "fact_year"))
        for year in sorted({*years, *missing}):
            rows = cuboids.build(_Years(self, [year]), cuboid).withColumn("fact_year", F.lit(year))
            replace_partitions(rows, path, "fact_year")
        kinds = ", ".join(f"`{c}` {k}" for c, k in cuboids.build(self, cuboid).dtypes)
        parts = self.spark.read.schema(f"{kinds}, fact_year int").parquet(path)
        return cuboids.sums(parts, cuboid.dimensions, cuboid.measures)

    def _expire(self, cube: str) -> None:
        """Drops the folders of refreshes that are older than those kept."""
        manifest = read_if_there(self.spark, f"{self.root}/manifest", MANIFEST, nested=True)
        if manifest is None:
            return
        found = manifest.where(F.col("refresh").startswith(f"{cube}-")).groupBy("refresh").agg(F.max("at").alias("at"))
        for row in found.orderBy(F.col("at").desc()).collect()[KEPT_REFRESHES:]:
            drop_folder(self.spark, f"{self.root}/refresh/{row['refresh']}")


class _Years:
    """A star whose facts are cut to some years; their months are partitions, so others are not read."""

    def __init__(self, whole: Warehouse, years: Iterable[int]):
        self._whole, self._years = whole, list(years)

    def table(self, name: str) -> DataFrame:
        found = self._whole.table(name)
        if not name.startswith("fact_"):
            return found
        inside = [F.col("time_key").between(y * 100 + 1, y * 100 + 12) for y in self._years]
        return found.where(reduce(lambda a, b: a | b, inside))

    def is_small(self, name: str) -> bool:
        return self._whole.is_small(name)

    def row_count(self, name: str) -> int | None:
        return self._whole.row_count(name)


# --- the warehouse of the given tables --------------------------------------


def conformed(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return conform(given_tables.SOURCES[table](spark, folder), table)


def star_builders(spark: SparkSession, folder: str) -> dict[str, Builder]:
    def load(table: str) -> DataFrame:
        return conformed(spark, folder, table)

    def months(w: Warehouse) -> DataFrame:
        """The months of both facts, from the tables the facts are made of: a query needs one fact, not both."""
        keys = star.sold_months(load("order_product"), load("order"))
        keys = keys.union(movements().select(time_key(F.col("last_updated_time")).alias("time_key")).distinct())
        current = spark.range(1).select(F.lit(AS_OF.year * 100 + AS_OF.month).alias("time_key"))
        return star.calendar_months(keys.union(current))

    def movements() -> DataFrame:
        return given_tables.monthly_stock(spark, folder).withColumnRenamed("time", "last_updated_time")

    def sales(w: Warehouse) -> DataFrame:
        lines, orders = load("order_product"), load("order")
        if w.root is None:
            return star.fact_sales(lines, orders)
        lines_an_order = lines.count() / max(orders.count(), 1)
        return star.fact_sales(lines, orders, sizes=star.month_sizes(orders, "order_date", lines_an_order))

    def stock(w: Warehouse) -> DataFrame:
        sizes = None if w.root is None else star.month_sizes(movements(), "last_updated_time")
        return star.fact_inventory_by_month(movements(), sizes)

    return {
        "dim_time": months,
        "dim_location": lambda w: star.dim_location(load("representative_office")),
        "dim_product": lambda w: star.dim_product(load("product")),
        "dim_store": lambda w: star.dim_store(load("store"), load("representative_office")),
        "dim_customer": lambda w: star.dim_customer(
            load("customer"), load("tourist_customer"), load("mail_order_customer")
        ),
        "fact_sales": sales,
        "fact_inventory": stock,
    }


# The given tables that the star is built from.
GIVEN = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def _code_version() -> str:
    """A digest of the code that builds tables: what other code wrote is built again."""
    package = pathlib.Path(__file__).resolve().parent.parent
    seen = hashlib.sha256()
    for part in ("schemas.py", "functions/*.py", "operators/*.py", "sources/*.py"):
        for path in sorted(package.glob(part)):
            seen.update(path.read_bytes())
    return seen.hexdigest()[:16]


_open: dict[tuple[str, str], Warehouse] = {}
_open_lock = threading.Lock()


def open_warehouse(spark: SparkSession, folder: str) -> Warehouse:
    """The warehouse of a data folder, shared by all queries of this application and found again by later ones."""
    application = spark.conf.get("spark.app.id", "application")
    with _open_lock:
        key = (application, folder)
        if key not in _open:
            shared = shared_folder(spark)
            label = hashlib.sha256(folder.encode()).hexdigest()[:12]
            content = f"{fingerprint(spark, [f'{folder}/{t}.parquet' for t in GIVEN])}-{_code_version()}" if shared else ""
            _open[key] = Warehouse(
                spark,
                star_builders(spark, folder),
                f"{shared}/starlattice/{label}" if shared else None,
                folder=folder,
                # Products are a projection of the given table: copying them would gain nothing.
                views=frozenset({"dim_product"}),
                dealt=frozenset({"fact_sales", "fact_inventory"}),
                partition_by={"fact_sales": "time_key", "fact_inventory": "time_key"},
                sort_by={"fact_sales": "customer_key", "fact_inventory": "product_key"},
                version=lambda: content,
            )
        return _open[key]
