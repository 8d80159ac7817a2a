"""The snapshot store against whole rewrites, and what its visits write."""

import datetime as dt
import random

import pytest

from quaymart.operators import history as H
from quaymart.session import scratch_path

D = dt.datetime
COLUMNS = "id bigint, status string, at timestamp_ntz, note string"


def states(visits=4, n=60, seed=2):
    """What a source looks like at each visit: keys appear, change, change back, go missing; one key is NULL."""
    rnd = random.Random(seed)
    rows, out = {}, []
    for v in range(visits):
        for i in [None, *range(10 + 15 * v)]:
            if i not in rows or rnd.random() < 0.3:
                rows[i] = (i, rnd.choice(["a", "b", None]), rnd.choice([D(2020, 1, 1), D(2020, 1, 1, 0, 0, 0, 1), None]), f"n{rnd.randrange(9)}")
        out.append([r for i, r in rows.items() if i is None or i % 13 != v])
    return out


def test_store_equals_whole_rewrites(spark):
    store = H.SnapshotStore(spark, scratch_path(spark, "store"), "id", ["status", "at"])
    with pytest.raises(FileNotFoundError):
        store.history()
    plain = None
    for v, rows in enumerate(states()):
        source, when = spark.createDataFrame(rows, COLUMNS), D(2021, 1, 1 + v)
        store.visit(source, when)
        # The key NULL is left to the store: a full outer join on it does not meet.
        known = source.where("id IS NOT NULL")
        plain = H.first_snapshot(known, when) if plain is None else H.apply_snapshot(plain, known, "id", ["status", "at"], when)
        plain = spark.createDataFrame(plain.collect(), plain.schema)
        got = store.history()
        assert sorted(map(str, got.where("id IS NOT NULL").select(*plain.columns).collect())) == sorted(map(str, plain.collect()))
        assert got.where("id IS NULL AND dbt_valid_to IS NULL").count() == 1


def test_visits_write_changes_only(spark):
    where = scratch_path(spark, "store")
    store = H.SnapshotStore(spark, where, "id", ["status"])
    rows = [(i, "new", None, "") for i in range(1000)]
    store.visit(spark.createDataFrame(rows, COLUMNS), D(2021, 1, 1))
    before = {r[0]: r[1] for r in files(spark, store)}
    rows = [(i, "paid" if i % 100 == 0 else "new", None, "other") for i in range(1005)]
    folder = store.visit(spark.createDataFrame(rows, COLUMNS), D(2021, 1, 2))
    after = {r[0]: r[1] for r in files(spark, store)}
    assert before and all(after[f] == at for f, at in before.items())      # no stored file was written again
    assert spark.read.parquet(f"{folder}/started").count() == 15 and spark.read.parquet(f"{folder}/ended").count() == 10
    assert store.history().count() == 1015
    same = store.visit(spark.createDataFrame(rows, COLUMNS), D(2021, 1, 3))
    assert spark.read.parquet(f"{same}/started").count() == 0
    with pytest.raises(ValueError):
        store.visit(spark.createDataFrame(rows, COLUMNS), D(2021, 1, 3))


def files(spark, store):
    return [tuple(r) for r in store._started(store._state()).select("_metadata.file_path", "_metadata.file_modification_time").distinct().collect()]


def test_a_visit_that_dies_is_not_seen(spark, monkeypatch):
    store = H.SnapshotStore(spark, scratch_path(spark, "store"), "id", ["status"])
    store.visit(spark.createDataFrame([(1, "a", None, "")], COLUMNS), D(2021, 1, 1))
    with monkeypatch.context() as broken:
        broken.setattr(H, "commit_version", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            store.visit(spark.createDataFrame([(1, "b", None, "")], COLUMNS), D(2021, 1, 2))
    assert [r.status for r in store.history().collect()] == ["a"]
    store.visit(spark.createDataFrame([(1, "c", None, "")], COLUMNS), D(2021, 1, 2))
    assert sorted((r.status, r.dbt_valid_to) for r in store.history().collect()) == [("a", D(2021, 1, 2)), ("c", None)]


def test_visits_read_only_key_start_and_hash(spark):
    """The comparison prunes all other columns of the stored versions."""
    from compare import plan_of

    store = H.SnapshotStore(spark, scratch_path(spark, "store"), "id", ["status"])
    store.visit(spark.createDataFrame([(1, "a", None, "long")], COLUMNS), D(2021, 1, 1))
    state = store._state()
    open_ = store._started(state).select("id", H.VALID_FROM, "__hash").join(store._ended(state), store._same_version(), "left_anti")
    assert "note" not in plan_of(open_)


def test_hashes_are_bytes_and_text_stores_go_on(spark, monkeypatch):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(i, "a", None, "") for i in range(4)], COLUMNS)
    store = H.SnapshotStore(spark, scratch_path(spark, "store"), "id", ["status"])
    store.visit(rows, D(2021, 1, 1))
    assert {len(bytes(r[0])) for r in store._started(store._state()).select("__hash").collect()} == {32}
    old = H.SnapshotStore(spark, scratch_path(spark, "store"), "id", ["status"])
    with monkeypatch.context() as before:
        plain = H.row_hash
        before.setattr(H, "row_hash", lambda cols: F.lower(F.hex(plain(cols))))
        old.visit(rows, D(2021, 1, 1))
    folder = old.visit(spark.createDataFrame([(i, "b" if i == 3 else "a", None, "") for i in range(4)], COLUMNS), D(2021, 1, 2))
    assert [r.id for r in spark.read.parquet(f"{folder}/started").collect()] == [3] and old.history().count() == 5
