"""Watermarks, upserts, snapshots, jobs, sinks and streams."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quaymart.operators import history as H
from quaymart.operators import incremental as I
from quaymart.operators import jobs as J
from quaymart.operators import marts as M
from quaymart.session import scratch_path, shared_dir
from quaymart.sources import files
from quaymart.sources.tables import TABLES
from quaymart.streaming.incremental import load_new_files

D = dt.datetime
ROWS = "id bigint, v string, at timestamp_ntz"


def path(spark, name="t"):
    return scratch_path(spark, f"test-{name}")


def pairs(df):
    return sorted((r["id"], r["v"]) for r in df.collect())


def test_watermark_edges(spark):
    mark = D(2020, 1, 10)
    source = spark.createDataFrame([(1, "equal", mark), (2, "above", mark + dt.timedelta(0, 1)),
                                    (3, "late", D(2019, 1, 1))], ROWS)
    stored = spark.createDataFrame([(0, "x", mark)], ROWS)
    assert I.watermark(stored, "at") == mark
    assert I.watermark(stored.where("false"), "at") == I.EPOCH
    assert I.watermark(None, "at", I.FIRST_RUN) == I.FIRST_RUN
    assert pairs(I.newer_than(source, "at", mark)) == [(2, "above")]
    assert pairs(I.newer_than(source, "at", mark, lookback_days=1)) == [(1, "equal"), (2, "above")]


@pytest.mark.parametrize("part", [None, "p"])
def test_upsert_is_idempotent(spark, part):
    schema = "id bigint, v string, p string"
    where = path(spark, "upsert")
    one = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (3, "c", "y")], schema)
    two = spark.createDataFrame([(2, "B", "y"), (4, "d", "z")], schema)
    I.upsert_table(spark, where, one, "id", part)
    for _ in range(2):
        got = I.upsert_table(spark, where, two, "id", part)
        assert pairs(got) == [(1, "a"), (2, "B"), (3, "c"), (4, "d")]
    alone = spark.createDataFrame([(4, "D", "x")], schema)  # partition z is left empty
    got = I.upsert_table(spark, where, alone, "id", part)
    assert pairs(got) == [(1, "a"), (2, "B"), (3, "c"), (4, "D")]


def test_upsert_keeps_odd_partitions(spark):
    """Values that look like numbers, hold slashes or are NULL; keys that move between them."""
    schema = "id bigint, p string"
    where = path(spark, "odd")
    table = lambda rows: spark.createDataFrame(rows, schema)
    I.upsert_table(spark, where, table([(1, "01"), (2, "02"), (3, "a/b"), (4, None), (5, "x=y"), (6, "")]), "id", "p")
    got = I.upsert_table(spark, where, table([(1, "02"), (3, "02"), (4, "a/b"), (5, None), (7, "1")]), "id", "p")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [(1, "02"), (2, "02"), (3, "02"), (4, "a/b"), (5, None), (6, ""), (7, "1")], key=str)
    assert I.vacuum(spark, where) > 0
    assert I.read_keyed(spark, where).count() == 7
    with pytest.raises(ValueError, match="kept by"):
        I.upsert_table(spark, where, table([(1, "x")]), "id")


@pytest.mark.parametrize("part", [None, "v"])
def test_late_rows_lose(spark, part):
    where = path(spark, "late")
    rows = lambda *r: spark.createDataFrame(list(r), ROWS)
    I.upsert_table(spark, where, rows((1, "ten", D(2020, 1, 10)), (2, "b", D(2020, 1, 1))), "id", part, ["at"])
    got = I.upsert_table(spark, where, rows((1, "five", D(2020, 1, 5)), (2, "B", D(2020, 1, 2))), "id", part, ["at"])
    assert pairs(got) == [(1, "ten"), (2, "B")]


def test_crash_before_pointer_keeps_old_version(spark, monkeypatch):
    where = path(spark, "crash")
    I.upsert_table(spark, where, spark.createDataFrame([(1, "a")], "id bigint, v string"), "id")
    two = spark.createDataFrame([(1, "b"), (2, "c")], "id bigint, v string")

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(I, "commit_version", fail)
        with pytest.raises(OSError, match="lost"):
            I.upsert_table(spark, where, two, "id")
    assert pairs(I.read_keyed(spark, where)) == [(1, "a")]
    assert pairs(I.upsert_table(spark, where, two, "id")) == [(1, "b"), (2, "c")]


def test_upsert_over_plain_folder(spark):
    where = path(spark, "plain")
    spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, v string").write.parquet(where)
    got = I.upsert_table(spark, where, spark.createDataFrame([(2, "B")], "id bigint, v string"), "id")
    assert pairs(got) == [(1, "a"), (2, "B")]


def test_upsert_syncs_columns(spark):
    old = spark.createDataFrame([(1, "a", 5)], "id bigint, v string, gone int")
    new = spark.createDataFrame([(2, "b", 1.5)], "id bigint, v string, added double")
    out = I.upsert(old, new, "id")
    assert out.columns == ["id", "v", "added"]
    assert sorted(map(tuple, out.collect())) == [(1, "a", None), (2, "b", 1.5)]


def test_latest_per_key(spark):
    df = spark.createDataFrame([(1, "old", D(2020, 1, 1)), (1, "new", D(2020, 1, 2))], ROWS)
    assert pairs(I.latest_per_key(df, "id", "at")) == [(1, "new")]


SEEN = "order_id bigint, order_status string, delivered_at timestamp_ntz"


def test_snapshot_versions(spark):
    t1, t2, t3 = D(2020, 1, 1), D(2020, 1, 2), D(2020, 1, 3)
    make = spark.createDataFrame
    first = make([(1, "shipped", None), (2, "shipped", None), (3, "created", None), (4, "x", None)],
                 SEEN)
    second = make([(1, "shipped", None), (2, "delivered", t1), (3, "created", t1), (5, "new", None)],
                  SEEN)
    check = ["order_status", "delivered_at"]
    h1 = H.first_snapshot(first, t1)
    h2 = H.apply_snapshot(h1, second, "order_id", check, t2)
    got = sorted((r["order_id"], r["order_status"], r[H.VALID_FROM], r[H.VALID_TO])
                 for r in h2.collect())
    assert [g[0] for g in got] == [1, 2, 2, 3, 3, 4, 5]
    versions = {(g[0], g[2]): g[3] for g in got}
    assert versions[2, t1] == t2 and versions[2, t2] is None
    assert versions[3, t1] == t2 and versions[3, t2] is None   # NULL -> value is a change
    assert versions[1, t1] is None and versions[4, t1] is None  # unchanged, missing: stay open
    h3 = H.apply_snapshot(h2, second, "order_id", check, t3)    # seen again: nothing new
    assert sorted(map(str, h3.collect())) == sorted(map(str, h2.collect()))
    open_rows = H.current_versions(h3).groupBy("order_id").count()
    assert open_rows.where("count <> 1").count() == 0
    s = H.snapshot_summary(h3, "order_id").first()
    assert tuple(s) == (7, 5, 2, 5)
    assert {r["order_id"] for r in H.changed_keys(h3, "order_id").collect()} == {2, 3}


class Tiny(J.Job):
    source_table, target_table = "a", "b"

    def __init__(self, spark, target, fail=0, **kw):
        super().__init__(spark, target, **kw)
        self.fail, self.calls = fail, 0

    def extract(self):
        self.calls += 1
        if self.calls <= self.fail:
            raise RuntimeError("source not ready")
        return self.spark.range(10)

    def transform(self, df):
        return df.where(F.col("id") < 6)


def test_job_counts_come_from_the_load(spark):
    job = Tiny(spark, path(spark, "job"))
    done = job.run()
    assert (done.status, done.tries, done.rows_in, done.rows_out) == ("success", 1, 10, 6)
    assert job.loaded().count() == 6 and done.seconds > 0
    assert spark.read.option("header", True).csv(done.export).count() == 6


def test_job_retries_then_leaves_a_record(spark):
    waits, audit = [], path(spark, "audit")
    patient = J.Retry(3, 2, waits.append)
    assert Tiny(spark, path(spark, "job"), fail=2, retry=patient).run().tries == 3 and waits == [2, 4]
    with pytest.raises(J.JobFailed) as failed:
        Tiny(spark, path(spark, "job"), fail=9, retry=J.Retry(2, 0, lambda _: None), audit_path=audit).run()
    assert failed.value.outcome.tries == 2
    record = J.read_audit(spark, audit).first()
    assert (record.status, record.rows_loaded, record.error_message) == ("failed", 0, "source not ready")
    with pytest.raises(ValueError):
        J.Retry(0)


def test_empty_result_is_a_success(spark):
    class Nothing(Tiny):
        def transform(self, df):
            return df.where("false")

    done = Nothing(spark, path(spark, "job")).run()
    assert (done.status, done.rows_out) == ("success", 0)


def test_audit_never_fails_the_job(spark):
    where = path(spark, "audit")
    done = Tiny(spark, path(spark, "job"), audit_path=where).run()
    assert J.append_audit(spark, where, done)
    assert J.read_audit(spark, where).count() == 2
    assert J.append_audit(spark, "nosuchscheme://x/y", done) is False
    assert J.sla_missed(done, 0).status == "sla_miss" and J.sla_missed(done, 1e6) is None


@pytest.mark.parametrize("n,step", [(499, "notify_low_count"), (500, "validate_full_load")])
def test_row_gate(spark, n, step):
    assert J.row_gate(spark.range(n), 500).first()["next_step"] == step


def test_models_run_in_dependency_order(spark):
    models = {
        "c": J.Model(lambda b: b["a"].union(b["b"]), ("a", "b")),
        "a": J.Model(lambda b: spark.range(2), materialized="view"),
        "b": J.Model(lambda b: b["a"].where("id = 1"), ("a",), "incremental", "id")}
    built = J.build_models(spark, models, path(spark, "models"))
    assert {n: df.count() for n, df in built.items()} == {"a": 2, "b": 1, "c": 3}


def test_sink_modes(spark):
    where = path(spark, "sink")
    df = spark.range(3)
    assert files.write_table(df, where).count() == 3
    assert files.write_table(df, where, "append").count() == 6
    assert files.write_table(df, where, "replace").count() == 3
    assert files.write_table(spark.range(5), where, "upsert", key="id").count() == 5
    with pytest.raises(ValueError):
        files.write_table(df, where, "merge")


def test_csv_fails_on_bad_rows_and_skips_absent_files(spark, tmp_path):
    bad = tmp_path / "bad.csv"
    bad.write_text("r_regionkey,r_name\nnot-a-number,X\n")
    with pytest.raises(Exception):
        files.read_csv(spark, str(bad), TABLES["region"]).collect()
    got = files.load_csv_tables(spark, {"region": str(tmp_path / "absent.csv")}, TABLES,
                                path(spark, "raw"))
    assert got == {}


def test_month_partitions_are_pruned(spark):
    df = spark.createDataFrame([(i, "x", D(2020, 1 + i % 6, 3)) for i in range(60)], ROWS)
    table = files.write_month_partitions(df, path(spark, "months"), "at")
    one = table.where(F.col("purchase_month") == F.lit("2020-03-01").cast("date"))
    assert one.count() == 10
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(purchase_month" in plan


def test_stream_reads_each_file_once(spark):
    root = path(spark, "stream")
    for n in (4, 3):
        spark.range(n).write.mode("append").parquet(f"{root}/in")
        out = load_new_files(spark, f"{root}/in", spark.range(1).schema, f"{root}/out",
                             f"{root}/cp")
    assert out.count() == 7
    again = load_new_files(spark, f"{root}/in", spark.range(1).schema, f"{root}/out", f"{root}/cp")
    assert again.count() == 7


def test_shared_dir_follows_the_session(spark):
    assert spark.conf.get("spark.checkpoint.dir") == shared_dir(spark)


def test_crash_of_the_first_upsert_leaves_no_table(spark, monkeypatch):
    where = path(spark, "keyed")

    def fail(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(I, "commit_version", fail)
        with pytest.raises(RuntimeError):
            I.upsert_table(spark, where, spark.range(1, 3), "id")
    with pytest.raises(FileNotFoundError):
        I.read_keyed(spark, where)
    assert [r.id for r in I.upsert_table(spark, where, spark.range(3, 4), "id").collect()] == [3]


@pytest.mark.parametrize("part", [None, "p"])
def test_null_is_a_key_and_repeated_keys_are_refused(spark, part):
    where = path(spark, "keyed")
    rows = lambda *r: spark.createDataFrame(list(r), "id bigint, v string, n bigint, p string")
    for _ in range(2):
        got = I.upsert_table(spark, where, rows((None, "a", 1, "x"), (1, "b", 1, None)), "id", part)
        assert sorted(map(str, got.collect())) == sorted(map(str, rows((None, "a", 1, "x"), (1, "b", 1, None)).collect()))
    for twice in (rows((2, "c", 1, "x"), (2, "d", 2, "x")), rows((None, "c", 1, "x"), (None, "d", 2, "y"))):
        with pytest.raises(ValueError, match="2 rows with id"):
            I.upsert_table(spark, where, twice, "id", part)
        with pytest.raises(ValueError, match="2 rows with id"):
            I.upsert_table(spark, path(spark, "fresh"), twice, "id", part)
        assert I.read_keyed(spark, where).count() == 2
        newest = I.upsert_table(spark, path(spark, "fresh"), twice, "id", part, order=["n"])
        assert [r.v for r in newest.collect()] == ["d"]


def test_mark_and_parts_of_a_keyed_table(spark):
    where = path(spark, "keyed")
    assert I.stored_mark(spark, where, "t") is None
    rows = spark.createDataFrame([(i, D(2020, m, 2)) for i, m in enumerate((1, 1, 2, 4))] + [(9, None)], "id bigint, t timestamp_ntz")
    rows = rows.selectExpr("*", "CAST(date_trunc('month', t) AS date) AS month")
    I.upsert_table(spark, where, rows, "id", "month", fixed=True)
    assert I.stored_mark(spark, where, "t") == D(2020, 4, 2)
    assert sorted(r.id for r in I.read_keyed(spark, where, since="2020-02-01").collect()) == [2, 3]


def test_second_build_touches_new_months_only(spark, small):
    """The second build of the order models scans, reads and writes from the mark on."""
    from compare import plan_of

    from quaymart.plans import loading as P
    from quaymart.plans.marts import market

    m, root = market(spark, small), path(spark, "models")
    models = P.order_models(m, P.ORDER_CUT.isoformat())
    J.build_models(spark, models, root)
    before = {n: I.current_version(spark, f"{root}/{n}") for n in ("order_facts", "mart_order_metrics")}
    since = I.stored_mark(spark, f"{root}/order_facts", "purchased_at") - dt.timedelta(days=P.LOOKBACK_DAYS)
    plan = plan_of(P.order_models(m)["order_facts"].build({}, since))
    assert f"GreaterThanOrEqual(o_orderdate,{since.isoformat()[:10]}" in plan     # the source is cut at its scan
    J.build_models(spark, P.order_models(m), root)
    for name, old in before.items():
        new = I.current_version(spark, f"{root}/{name}")
        first = since.date().replace(day=1).isoformat()
        kept = {p for p, v in old["values"].items() if v < first}
        assert kept and all(new["parts"][p] == old["parts"][p] for p in kept)
        assert all(new["parts"][p] != old["parts"].get(p) for p, v in new["values"].items() if v > P.ORDER_CUT.date().isoformat())
    J.build_models(spark, P.order_models(m), root)       # nothing new: the look-back is read again, to the same end
    whole = M.order_metrics(m.order_facts(), m.customers)
    stored = I.read_keyed(spark, f"{root}/mart_order_metrics").select(*whole.columns)
    assert stored.count() == whole.count() and stored.exceptAll(whole).isEmpty()


def test_drift_checks_keep_their_baseline_and_log(spark):
    from quaymart.operators.models import DriftMonitor

    where = path(spark, "drift")
    assert DriftMonitor(spark, where).log().collect() == [] and DriftMonitor(spark, where).baseline() is None
    got = [DriftMonitor(spark, where).check(a, D(2024, 1, i)) for i, a in enumerate((0.95, 0.94, 0.93, 0.90, 0.9), 1)]
    assert got == ["ok", "ok", "warning", "drift", "drift"]       # the first against 0.90, the others against 0.95
    assert DriftMonitor(spark, where).baseline() == 0.95
    log = sorted(tuple(r) for r in DriftMonitor(spark, where).log().collect())
    assert [r[:2] + r[4:5] for r in log] == [(D(2024, 1, 3), 0.95, "warning"), (D(2024, 1, 4), 0.95, "drift"), (D(2024, 1, 5), 0.95, "drift")]
    low = path(spark, "drift")
    assert DriftMonitor(spark, low).check(0.8, D(2024, 1, 1)) == "drift" and DriftMonitor(spark, low).check(0.8, D(2024, 1, 2)) == "ok"
