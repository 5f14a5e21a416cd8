"""Incremental loads: sources to conformed tables, conformed tables to the star.

Targets are partitioned, facts by month and the others by range of their first key. A load
reads and rewrites only the partitions its batch falls in: it writes them aside, records that
it did, and replaces them by dynamic partition overwrite. A load that stops before the
record has changed nothing; one that stops after it is finished by whoever comes next. Either
way it gives the same rows and counts. A load that changes nothing leaves nothing.

Sources are read by business date, rows dated on the mark again. Between the layers rows
are carried by load number instead: the star takes every conformed row that is newer than its
last load, whatever its date. A line without its order (a store without its office) goes
to a pending table, which later loads join with new orders alone.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import asdict, dataclass, replace
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starlattice.operators import star, upsert
from starlattice.operators.conform import EXTRACTS, NEVER_LOADED, conform
from starlattice.schemas import PRIMARY_KEYS
from starlattice.sources.storage import drop_folder, exists, partition_values, read_texts, write_text
from starlattice.sources.warehouse import Warehouse

# Load order, parents before children.
SOURCE_TABLES = (
    "representative_office", "product", "customer", "store", "tourist_customer", "mail_order_customer",
    "order", "order_product", "stocked_product",
)
STAR_TABLES = (
    "dim_time", "dim_location", "dim_product", "dim_store", "dim_customer", "fact_sales", "fact_inventory",
)
# The conformed table and column whose newest date is reported as the mark of a star table.
STAR_CHANGES = {
    "dim_time": ("order", "order_date"),
    "dim_location": ("representative_office", "last_updated_time"),
    "dim_product": ("product", "last_updated_time"),
    "dim_store": ("store", "last_updated_time"),
    "dim_customer": ("customer", "first_order_date"),
    "fact_sales": ("order_product", "last_updated_time"),
    "fact_inventory": ("stocked_product", "last_updated_time"),
}
FACTS = ("fact_sales", "fact_inventory")
# Star tables whose rows wait for a parent: child and parent table, and the key they share.
WAITING = {
    "fact_sales": ("order_product", "order", "order_id"),
    "dim_store": ("store", "representative_office", "city_id"),
}
NUMBER, RANGE, MONTH = "load_number", "key_range", "time_key"
# Consecutive numbers of the first key that share a partition, where these make at most `MOST_RANGES`; with more
# keys a range is two, four, ... times as wide. A table that has grown to four times as many is cut anew.
KEYS_A_RANGE = 1 << 20
MOST_RANGES = 256


@dataclass(frozen=True)
class State:
    """What the newest load of a table did; `finished` when its partitions are in place.

    `parts` has, for each folder of the table, its schema, its partition column, the keys a
    range has, the partitions that the load touched and those of them that have rows. `batch` is the
    newest batch of arriving files that the table holds.
    """

    layer: str
    table: str
    number: int
    finished: bool
    mark: date
    inserted: int
    updated: int
    at: datetime
    parts: dict[str, dict]
    batch: int = -1

    def text(self) -> str:
        return json.dumps(asdict(self), default=lambda value: value.isoformat())

    @staticmethod
    def of(text: str) -> State:
        found = json.loads(text)
        dates = {"mark": date.fromisoformat(found["mark"]), "at": datetime.fromisoformat(found["at"])}
        return State(**{**found, **dates})


@dataclass(frozen=True)
class LoadReport:
    table: str
    rows_inserted: int
    rows_updated: int
    mark: date


def _schema(df: DataFrame) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in df.dtypes)


def _in_ranges(df: DataFrame, key: str, width: int) -> DataFrame:
    return df.withColumn(RANGE, F.expr(f"`{key}` div {width}L").cast("bigint"))


class LoadStore:
    """The loaded tables under one shared folder, and the state that says what is loaded.

    A table has one current content. Loads of a store come one at a time; a
    query that reads a table while a load replaces its partitions has to be run again.
    """

    def __init__(self, spark: SparkSession, root: str, keys_a_range: int = KEYS_A_RANGE):
        self.spark = spark
        self.root = root.rstrip("/")
        self.keys_a_range = keys_a_range
        self._held: dict[tuple[str, str], State] | None = None

    # --- state ---

    def _state_path(self, state: State) -> str:
        return f"{self.root}/state/{state.layer}-{state.table}/{state.number}-{'done' if state.finished else 'written'}.json"

    def current(self) -> dict[tuple[str, str], State]:
        """The newest state of every table, read once while `held`; unfinished loads are finished."""
        if self._held is not None:
            return self._held
        newest: dict[tuple[str, str], State] = {}
        for text in read_texts(self.spark, f"{self.root}/state"):
            state = State.of(text)
            known = newest.get((state.layer, state.table))
            if known is None or (state.number, state.finished) > (known.number, known.finished):
                newest[state.layer, state.table] = state
        return {key: state if state.finished else self._finish(state) for key, state in newest.items()}

    @contextmanager
    def held(self) -> Iterator[None]:
        """Reads the state once for the loads inside, of which a store has one at a time."""
        self._held = self.current()
        try:
            yield
        finally:
            self._held = None

    def state(self, layer: str, table: str) -> State | None:
        return self.current().get((layer, table))

    def next_number(self) -> int:
        return max((state.number for state in self.current().values()), default=0) + 1

    def record(self, state: State) -> None:
        write_text(self.spark, self._state_path(state), state.text())

    def publish(self, state: State) -> None:
        """Takes what a load wrote aside into its table."""
        before = self.state(state.layer, state.table)
        self.record(state)
        done = self._finish(state)
        if before is not None:
            drop_folder(self.spark, self._state_path(before))
        if self._held is not None:
            self._held[state.layer, state.table] = done

    def _finish(self, state: State) -> State:
        """Replaces the partitions that a load touched; doing it again changes nothing."""
        for folder, part in state.parts.items():
            aside, target = f"{self.root}/aside/{folder}/{state.number}", f"{self.root}/{folder}"
            if part["kept"]:
                rows = self.spark.read.schema(part["schema"]).parquet(aside)
                upsert.replace_partitions(rows, target, part["by"])
            for value in set(part["touched"]) - set(part["kept"]):
                drop_folder(self.spark, f"{target}/{part['by']}={value}")
        done = replace(state, finished=True)
        self.record(done)
        drop_folder(self.spark, self._state_path(state))
        for folder in state.parts:
            drop_folder(self.spark, f"{self.root}/aside/{folder}/{state.number}")
        return done

    def version(self) -> str:
        """Names the published content of the star."""
        states = self.current()
        found = [states.get(("star", t)) for t in STAR_TABLES]
        return "-".join(str(s.number if s else 0) for s in found)

    # --- tables ---

    def stored(self, layer: str, table: str, folder: str | None = None) -> DataFrame | None:
        """The rows with load number and partition column, None if never loaded."""
        known = self.state(layer, table)
        folder = folder or f"{layer}/{table}"
        part = known.parts.get(folder) if known else None
        if part is None:
            return None
        path = f"{self.root}/{folder}"
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], part["schema"])
        return self.spark.read.schema(part["schema"]).parquet(path)

    def table(self, layer: str, table: str, *, numbered: bool = False) -> DataFrame:
        """The published rows, with the number of the load that last changed each if `numbered`."""
        found = self.stored(layer, table)
        if found is None:
            raise ValueError(f"{layer} table {table} was never loaded")
        return found.drop(RANGE) if numbered else found.drop(RANGE, NUMBER)

    def near(self, layer: str, table: str, keys: DataFrame) -> DataFrame:
        """The rows in the key ranges of `keys`, one column named like the table's first key; other ranges are not read."""
        found = self.stored(layer, table)
        if found is None:
            raise ValueError(f"{layer} table {table} was never loaded")
        width = self.held_width(layer, table, f"{layer}/{table}")
        ranges = upsert.touched_values(_in_ranges(keys, keys.columns[0], width), RANGE)
        return found.where(F.col(RANGE).isin(ranges)).drop(RANGE, NUMBER)

    def held_width(self, layer: str, table: str, folder: str) -> int:
        """How many keys a range of the folder has."""
        known = self.state(layer, table)
        return (known.parts.get(folder, {}) if known else {}).get("width") or self.keys_a_range

    def width_for(self, layer: str, table: str, folder: str, rows: DataFrame, key: str) -> int:
        """How many keys a range of the folder has once `rows` are in it, so that its partitions stay few."""
        width = self.held_width(layer, table, folder)
        held = partition_values(self.spark, f"{self.root}/{folder}", RANGE)
        keys = rows.select(F.col(key).cast("bigint").alias(key))
        if held:
            keys = keys.union(self.spark.createDataFrame([(value * width,) for value in held], f"`{key}` bigint"))
        most = MOST_RANGES * 4 if held else MOST_RANGES
        # Twice the width makes at least half the ranges, so this never widens too far.
        while (count := _in_ranges(keys, key, width).select(RANGE).distinct().count()) > most:
            most = MOST_RANGES
            width <<= (math.ceil(count / most) - 1).bit_length()
        return width

    def write_aside(
        self, rows: DataFrame, folder: str, number: int, by: str, touched: Iterable[int]
    ) -> tuple[dict, tuple[int, int]]:
        """Writes the new content of touched partitions; what to publish and the counts that came with the write."""
        counts = Observation()
        spread = rows.hint("rebalance", by)
        watched = spread.observe(
            counts, F.sum("rows_inserted").alias("inserted"), F.sum("rows_updated").alias("updated")
        ).drop("rows_inserted", "rows_updated")
        path = f"{self.root}/aside/{folder}/{number}"
        watched.write.mode("overwrite").partitionBy(by).parquet(path)
        kept = partition_values(self.spark, path, by)
        part = {"schema": _schema(watched), "by": by, "touched": list(touched), "kept": kept}
        return part, (counts.get["inserted"] or 0, counts.get["updated"] or 0)


def _load(
    store: LoadStore,
    layer: str,
    table: str,
    batch: DataFrame,
    newest: date | str,
    at: datetime,
    *,
    waiting: tuple[DataFrame, DataFrame] | None = None,
    rebuild: bool = False,
    arrived: int | None = None,
) -> LoadReport:
    """Apply one batch and publish the result; `newest` is the latest business date seen, or its column in the batch.

    A batch of `arrived` files is recorded with its number, even if it changes nothing.

    With `rebuild` the batch is the whole table, which replaces the old one. `waiting` has
    the rows that arrive in the pending table and the keys that leave it.
    """
    spark, key = store.spark, list(PRIMARY_KEYS[table])
    known = store.state(layer, table)
    number = store.next_number()
    folder = f"{layer}/{table}"
    order_by = [c for c in batch.columns if c == "last_updated_time"]
    by = MONTH if table in FACTS else RANGE
    batch = batch.withColumn(NUMBER, F.lit(number))
    batch, seen = _written(store, batch, f"{folder}/{number}-batch", newest if isinstance(newest, str) else None)
    before_width = width = store.held_width(layer, table, folder)
    if by == RANGE:
        width = store.width_for(layer, table, folder, batch, key[0])
        batch = _in_ranges(batch, key[0], width)
    touched = sorted(upsert.touched_values(batch.where(F.col(by).isNotNull()), by))
    mark = max(d for d in (NEVER_LOADED, known and known.mark, seen if isinstance(newest, str) else newest) if d)
    old = store.stored(layer, table)
    if old is None or rebuild:
        touched = sorted({*touched, *partition_values(spark, f"{store.root}/{folder}", by)})
        held = batch.limit(0)
    elif width != before_width:
        touched = sorted({*touched, *partition_values(spark, f"{store.root}/{folder}", by)})
        held = _in_ranges(old, key[0], width).select(*batch.columns)
    else:
        held = old.select(*batch.columns).where(F.col(by).isin(touched))
    stamp = [NUMBER] if by == MONTH else [NUMBER, RANGE]
    merged = upsert.merge_counted(held, batch, table, key, order_by, stamp)
    part, counts = store.write_aside(merged, folder, number, by, touched)
    parts = {folder: part | {"width": width}}
    if waiting is not None:
        pending = _pending(store, layer, table, number, *waiting, rebuild=rebuild)
        if pending is not None:
            parts[f"{folder}-pending"] = pending
    changed = any(counts) or len(parts) > 1 or (rebuild and old is not None)
    if not changed:
        parts = {name: {**p, "touched": [], "kept": [], "width": before_width} for name, p in parts.items()}
    if known is None or changed or mark > known.mark or arrived is not None:
        before = known.parts if known else {}
        parts = {name: {**p, "touched": [], "kept": []} for name, p in before.items() if name not in parts} | parts
        done = arrived if arrived is not None else known.batch if known else -1
        store.publish(State(layer, table, number, False, mark, *counts, at, parts, done))
    drop_folder(spark, f"{store.root}/aside/{folder}")
    drop_folder(spark, f"{store.root}/aside/{folder}-pending")
    return LoadReport(table, counts[0], counts[1], mark)


def _written(store: LoadStore, rows: DataFrame, name: str, change: str | None = None) -> tuple[DataFrame, date | None]:
    """Rows written aside as they come and read again, and their newest `change`."""
    path, seen = f"{store.root}/aside/{name}", Observation()
    newest = F.max(change).cast("date") if change else F.max(F.lit(None).cast("date"))
    rows.observe(seen, newest.alias("newest")).write.mode("overwrite").parquet(path)
    return store.spark.read.schema(_schema(rows)).parquet(path), seen.get["newest"]


def _pending(
    store: LoadStore, layer: str, table: str, number: int, arriving: DataFrame, leaving: DataFrame, *, rebuild: bool
) -> dict | None:
    """The pending rows of the touched key ranges, written aside; None where nothing comes or goes."""
    folder, key = f"{layer}/{table}-pending", WAITING[table][2]
    arriving, _ = _written(store, arriving, f"{folder}/{number}-batch")
    old, before_width = store.stored(layer, table, folder), store.held_width(layer, table, folder)
    width = store.width_for(layer, table, folder, arriving, key)
    arriving = _in_ranges(arriving, key, width)
    touched = set(upsert.touched_values(arriving, RANGE))
    rows = arriving
    if old is not None and rebuild:
        touched |= set(partition_values(store.spark, f"{store.root}/{folder}", RANGE))
    elif old is not None:
        if width != before_width:
            touched |= set(partition_values(store.spark, f"{store.root}/{folder}", RANGE))
            held = _in_ranges(old, key, width)
        else:
            gone = old.join(leaving.select(key).distinct(), key, "left_semi")
            touched |= set(upsert.touched_values(gone, RANGE))
            held = old.where(F.col(RANGE).isin(sorted(touched)))
        stay = held.join(leaving.select(key).distinct(), key, "left_anti")
        rows = stay.select(*arriving.columns).unionByName(arriving)
    if not touched:
        return None
    none = F.lit(0).cast("bigint")
    counted = rows.withColumns({"rows_inserted": none, "rows_updated": none})
    return store.write_aside(counted, folder, number, RANGE, touched)[0] | {"width": width}


def load_sources(
    store: LoadStore,
    sources: Mapping[str, DataFrame],
    at: datetime,
    tables: Iterable[str] = SOURCE_TABLES,
    *,
    everything: bool = False,
) -> list[LoadReport]:
    """Changed source rows into the conformed tables; rows dated on the mark are read again.

    With `everything` the marks are left aside, which also takes rows that
    reached a source late with an older date.
    """
    with store.held():
        return [_load_source(store, sources[table], table, at, everything) for table in tables]


def _load_source(
    store: LoadStore, source: DataFrame, table: str, at: datetime, everything: bool, arrived: int | None = None
) -> LoadReport:
    known = store.state("conformed", table)
    since = known.mark if known and not everything else NEVER_LOADED
    batch = conform(source, table, since)
    change = next(target for name, target, _ in EXTRACTS[table].columns if name == EXTRACTS[table].change_column)
    return _load(store, "conformed", table, batch, change, at, arrived=arrived)


def load_batch(store: LoadStore, table: str, source: DataFrame, arrived: int, at: datetime) -> LoadReport | None:
    """One numbered batch of source rows into its conformed table; None if the table holds it already."""
    with store.held():
        known = store.state("conformed", table)
        if known is not None and known.batch >= arrived:
            return None
        return _load_source(store, source, table, at, True, arrived)


Batch = tuple[DataFrame, tuple[DataFrame, DataFrame] | None]


def star_batch(store: LoadStore, table: str, since: int, as_of: date) -> Batch:
    """Rows of a star table to which a conformed row newer than load `since` contributes.

    For tables whose rows may wait, also the child rows that have no parent yet and the
    new parents, for which waiting rows leave.
    """

    def new(name: str) -> DataFrame:
        # Files without a newer load are skipped by the statistics of the load number.
        return store.table("conformed", name, numbered=True).where(F.col(NUMBER) > since).drop(NUMBER)

    if table == "dim_time":
        return star.dim_time(new("order"), as_of), None
    if table == "dim_location":
        return star.dim_location(new("representative_office")), None
    if table == "dim_product":
        return star.dim_product(new("product")), None
    if table == "dim_customer":
        names = ("customer", "tourist_customer", "mail_order_customer")
        changed = reduce(DataFrame.union, [new(n).select("customer_id") for n in names]).distinct()
        customers, tourists, mails = (store.near("conformed", n, changed) for n in names)
        return star.dim_customer(customers.join(changed, "customer_id", "left_semi"), tourists, mails), None
    if table == "fact_inventory":
        return star.fact_inventory(store.table("conformed", "stocked_product")), None
    child, parent, key = WAITING[table]
    children, parents = new(child), new(parent)
    pending = store.stored("star", table, f"star/{table}-pending") if since else None
    if pending is not None:
        met = pending.drop(RANGE).join(parents.select(key), key, "left_semi")
        ready = children.unionByName(met.select(*children.columns))
    else:
        ready = children
    known = store.near("conformed", parent, ready.select(key))
    build = star.fact_sales if table == "fact_sales" else star.dim_store
    arriving = children.join(known.select(key), key, "left_anti").select(*children.columns)
    return build(ready, known), (arriving, parents.select(key))


def load_star(
    store: LoadStore, as_of: date, at: datetime, tables: Iterable[str] = STAR_TABLES, *, rebuild: bool = False
) -> list[LoadReport]:
    """Conformed rows after each table's last load into dimensions and facts.

    With `rebuild`, facts are made anew from all conformed rows.
    """
    with store.held():
        return [_load_star(store, table, as_of, at, rebuild and table in FACTS) for table in tables]


def _load_star(store: LoadStore, table: str, as_of: date, at: datetime, rebuild: bool) -> LoadReport:
    known = store.state("star", table)
    since = known.number if known and not rebuild else 0
    sources = [STAR_CHANGES[table][0]]
    if table == "dim_customer":
        sources += ["tourist_customer", "mail_order_customer"]
    states = [store.state("conformed", name) for name in sources]
    if None in states:
        raise ValueError(f"star table {table} needs {', '.join(sources)} to be loaded before")
    newest = max(state.mark for state in states)
    batch, waiting = star_batch(store, table, since, as_of)
    return _load(store, "star", table, batch, newest, at, waiting=waiting, rebuild=rebuild)


def changed_years(store: LoadStore, cube: str, before: str) -> list[int]:
    """Years whose cuboids a cube's facts and dimensions changed since the star had the version `before`.

    These are the years of changed fact rows, of new months, and of facts whose
    customer or store, or its place, changed.
    """
    since = dict(zip(STAR_TABLES, map(int, before.split("-"))))

    def new(name: str) -> DataFrame | None:
        """The rows that changed, None where no load did."""
        state = store.state("star", name)
        if state is None or state.number == since[name]:
            return None
        return store.table("star", name, numbered=True).where(F.col(NUMBER) > since[name])

    fact, people, key = {
        "sales": ("fact_sales", "dim_customer", "customer_key"),
        "inventory": ("fact_inventory", "dim_store", "store_key"),
    }[cube]
    months = [rows.select(MONTH) for rows in (new(fact), new("dim_time")) if rows is not None]
    changed, places = new(people), new("dim_location")
    keys = [] if changed is None else [changed.select(key)]
    if places is not None:
        keys.append(store.table("star", people).join(places, "location_key", "left_semi").select(key))
    if keys:
        months.append(store.table("star", fact).join(reduce(DataFrame.union, keys), key, "left_semi").select(MONTH))
    if not months:
        return []
    years = reduce(DataFrame.union, months).select(F.expr(f"{MONTH} div 100").cast("int").alias("year")).distinct()
    return [r["year"] for r in years.collect()]


def open_loaded(store: LoadStore, folder: str) -> Warehouse:
    """A warehouse over the loaded star; the star tables are read where they are, cuboids go to `folder`."""
    names = frozenset(STAR_TABLES)
    builders = {name: (lambda _, n=name: store.table("star", n)) for name in names}
    return Warehouse(
        store.spark,
        builders,
        folder,
        views=names,
        version=store.version,
        changed_years=lambda cube, before: changed_years(store, cube, before),
    )
