"""Loads of arriving files: new files only, batches that come again, restarts."""

import datetime as dt
import os

import pytest

from starlattice.plans import arrivals, loads

AT = dt.datetime(2024, 6, 1)


@pytest.fixture
def store(spark, tmp_path):
    return loads.LoadStore(spark, str(tmp_path / "store"), keys_a_range=10)


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()

    def drop(name, *rows):
        (tmp_path / name).write_text("order_id,customer_id,order_date\n" + "".join(f"{o},{c},{d}\n" for o, c, d in rows))
        os.rename(tmp_path / name, folder / f"{name}.csv")

    drop.folder = str(folder)
    return drop


def counts(reports):
    return [(r.rows_inserted, r.rows_updated) for r in reports]


def loaded(store):
    return sorted((r.order_id, r.customer_id) for r in store.table("conformed", "order").collect())


def test_two_drops(store, landing):
    landing("a", (1, 1, "2024-01-10"), (2, 2, "2024-02-10"), (25, 2, "2024-02-11"))
    assert counts(arrivals.load_arriving(store, "order", landing.folder, AT)) == [(3, 0)]
    assert arrivals.load_arriving(store, "order", landing.folder, AT) == []
    # An older date, a key that is there, and a file without rows.
    landing("b", (3, 3, "2020-01-01"), (2, 9, "2024-03-01"))
    landing("c")
    assert counts(arrivals.load_arriving(store, "order", landing.folder, AT)) == [(1, 0)]
    assert loaded(store) == [(1, 1), (2, 2), (3, 3), (25, 2)]
    assert store.state("conformed", "order").mark == dt.date(2024, 3, 1)
    assert store.state("conformed", "order").batch == 1


def test_batches_have_a_bound_of_files(store, landing):
    for i in range(3):
        landing(f"f{i}", (i, i, "2024-01-10"))
    assert counts(arrivals.load_arriving(store, "order", landing.folder, AT, files_a_batch=1)) == [(1, 0)] * 3
    assert store.state("conformed", "order").batch == 2


@pytest.mark.parametrize("stop", ["before the state", "after the state", "after the load"])
def test_restart(spark, store, landing, monkeypatch, stop):
    landing("a", (1, 1, "2024-01-10"), (2, 2, "2024-02-10"))
    arrivals.load_arriving(store, "order", landing.folder, AT)
    landing("b", (3, 3, "2024-01-01"), (30, 3, "2024-01-01"))

    def fail(*_, **__):
        raise RuntimeError("stopped")

    with monkeypatch.context() as patched:
        if stop == "before the state":
            patched.setattr(loads.LoadStore, "publish", fail)
        elif stop == "after the state":
            patched.setattr(loads.LoadStore, "_finish", fail)
        else:
            whole = loads.load_batch
            patched.setattr(loads, "load_batch", lambda *given: (whole(*given), fail()))
        with pytest.raises(Exception, match="stopped"):
            arrivals.load_arriving(store, "order", landing.folder, AT)
    again = loads.LoadStore(spark, store.root, keys_a_range=10)
    found = arrivals.load_arriving(again, "order", landing.folder, AT)
    # What the table holds already is passed over, not counted as a batch without changes.
    assert counts(found) == ([(2, 0)] if stop == "before the state" else [])
    assert loaded(again) == [(1, 1), (2, 2), (3, 3), (30, 3)]
    state = again.state("conformed", "order")
    assert (state.batch, state.inserted, state.finished) == (1, 2, True)


def test_other_loads_keep_the_batch_number(store, spark, landing):
    landing("a", (1, 1, "2024-01-10"))
    arrivals.load_arriving(store, "order", landing.folder, AT)
    more = spark.createDataFrame([(7, 7, dt.date(2024, 5, 1))], "order_id int, customer_id int, order_date date")
    loads.load_sources(store, {"order": more}, AT, ["order"])
    assert store.state("conformed", "order").batch == 0
    landing("b", (8, 8, "2024-01-10"))
    assert counts(arrivals.load_arriving(store, "order", landing.folder, AT)) == [(1, 0)]
    assert loaded(store) == [(1, 1), (7, 7), (8, 8)]


def test_a_lost_checkpoint_is_reported(spark, store, landing, tmp_path):
    landing("a", (1, 1, "2024-01-10"))
    arrivals.load_arriving(store, "order", landing.folder, AT)
    os.rename(f"{store.root}/arrivals", tmp_path / "elsewhere")
    with pytest.raises(ValueError, match="checkpoint"):
        arrivals.load_arriving(store, "order", landing.folder, AT)
