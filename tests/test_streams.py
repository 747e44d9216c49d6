"""Streams give what the batch operators give, and a second run adds nothing."""

import pytest
from pyspark.sql import functions as F

from tests.rows import frame_rows
from tradeloom.operators import events as ev
from tradeloom.operators import state
from tradeloom.plans import queries_events
from tradeloom.plans.catalog import QUERIES
from tradeloom.plans.driver_tables import event_log, table
from tradeloom.schemas import TOPIC_FAMILIES, topic_pattern
from tradeloom.sources.external import RATE_LIMITS, kafka_options
from tradeloom.sources.files import file_event_source
from tradeloom.streaming import jobs, projection, sinks


@pytest.fixture(scope="module")
def log_path(spark, sf_dir, tmp_path_factory):
    """The log in time order, in four files that are read one per micro-batch."""
    path = str(tmp_path_factory.mktemp("log"))
    log = event_log(table(spark, sf_dir, "events"))
    ordered = log.repartitionByRange(4, "timestamp").sortWithinPartitions("timestamp")
    ordered.write.mode("overwrite").parquet(path)
    return path


@pytest.fixture(scope="module")
def log(spark, log_path):
    return spark.read.parquet(log_path)


def unique(log, families=None, currency=True):
    return ev.first_arrivals(jobs.arriving_transactions(log, families or TOPIC_FAMILIES, currency))


def test_append_sink_and_replay(spark, log, log_path, tmp_path):
    def run():
        rows = jobs.trade_events(file_event_source(spark, log_path, max_files=1))
        query = sinks.append_stream_sink(rows, str(tmp_path / "out"), str(tmp_path / "cp"))
        query.awaitTermination()
        return query

    first = run()
    batches = [p for p in first.recentProgress if p["numInputRows"] > 0]
    assert len(batches) == 4
    want = frame_rows(jobs.trade_events(log))
    got = spark.read.parquet(str(tmp_path / "out"))
    assert frame_rows(got) == want
    run()
    assert frame_rows(spark.read.parquet(str(tmp_path / "out"))) == want


def test_kpis_equal_batch(spark, log, log_path, tmp_path):
    root = str(tmp_path / "kpis")
    stream = file_event_source(spark, log_path, max_files=1)
    query = jobs.stream_currency_kpis(stream, root, str(tmp_path / "cp"))
    query.awaitTermination()
    want = ev.currency_kpis(unique(log))
    got = sinks.read_latest(spark, f"{root}/kpis", want.schema)
    assert frame_rows(got) == frame_rows(want)
    assert len([p for p in query.recentProgress if p["numInputRows"] > 0]) == 4
    assert len(list((tmp_path / "kpis" / "kpis").glob("slot=*"))) == 2


def test_complete_sink_keeps_two_versions(spark, log_path, tmp_path):
    rows = file_event_source(spark, log_path, max_files=1).groupBy("topic").count()
    path = str(tmp_path / "counts")
    sinks.complete_stream_sink(rows, path, str(tmp_path / "cp")).awaitTermination()
    want = spark.read.parquet(log_path).groupBy("topic").count()
    assert frame_rows(sinks.read_latest(spark, path, rows.schema)) == frame_rows(want)
    assert len(list((tmp_path / "counts").glob("slot=*"))) == 2


def test_alerts_equal_batch(spark, log, log_path, tmp_path):
    path = str(tmp_path / "alerts")
    stream = file_event_source(spark, log_path, max_files=1)
    jobs.stream_risk_alerts(stream, path, str(tmp_path / "cp")).awaitTermination()
    first = unique(log, jobs.ALERT_FAMILIES, currency=False)
    got = jobs.read_alerts(spark, path)
    assert frame_rows(got) == frame_rows(ev.high_risk_alerts(first))
    # What stands is what the sink itself holds.
    assert spark.read.parquet(path).agg(F.sum("change")).first()[0] == got.count()


@pytest.fixture(scope="module")
def late_log(spark, log, tmp_path_factory):
    """The log in nine files that are read newest first, so earlier arrivals come in later batches."""
    path = str(tmp_path_factory.mktemp("late"))
    parts = log.repartitionByRange(9, F.col("timestamp").desc()).sortWithinPartitions("timestamp")
    for part in range(9):
        parts.where(F.spark_partition_id() == part).coalesce(1).write.mode("append").parquet(path)
    return path


def test_earlier_arrivals_take_back_what_was_given(spark, log, late_log, tmp_path):
    """Each transaction's first arrival comes last; dedupe, KPIs and alerts end as in the batch."""
    alerts, seen, kpis = (str(tmp_path / n) for n in ("alerts", "unique", "kpis"))

    def stream():
        return file_event_source(spark, late_log, max_files=1)

    jobs.stream_risk_alerts(stream(), alerts, str(tmp_path / "cp1")).awaitTermination()
    jobs.stream_dedupe(stream(), seen, str(tmp_path / "cp2")).awaitTermination()
    query = jobs.stream_currency_kpis(stream(), kpis, str(tmp_path / "cp3"))
    query.awaitTermination()
    assert spark.read.parquet(alerts).where("change < 0").count() > 0
    first = unique(log, jobs.ALERT_FAMILIES, currency=False)
    assert frame_rows(jobs.read_alerts(spark, alerts)) == frame_rows(ev.high_risk_alerts(first))
    want = unique(log)
    got = jobs.read_first_arrivals(spark, seen, want.schema)
    assert frame_rows(got.select(want.columns)) == frame_rows(want)
    totals = ev.currency_kpis(want)
    assert frame_rows(sinks.read_latest(spark, f"{kpis}/kpis", totals.schema)) == frame_rows(totals)
    # The state store has a row per transaction, however many events and batches there are.
    progress = [p["stateOperators"][0] for p in query.recentProgress if p["numInputRows"] > 0]
    assert len(progress) == 9 and progress[-1]["numRowsTotal"] == want.count()
    assert all(p["numRowsUpdated"] <= want.count() for p in progress)


def test_a_kpi_batch_run_again_adds_nothing(spark, log_path, log, tmp_path):
    """The last batch is lost after its write and before its commit."""
    root, checkpoint = str(tmp_path / "kpis"), tmp_path / "cp"

    def run():
        jobs.stream_currency_kpis(file_event_source(spark, log_path, max_files=1), root, str(checkpoint)).awaitTermination()

    run()
    commits = sorted((checkpoint / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    commits[-1].unlink()
    run()
    want = ev.currency_kpis(unique(log))
    assert frame_rows(sinks.read_latest(spark, f"{root}/kpis", want.schema)) == frame_rows(want)


@pytest.fixture(scope="module")
def projected(spark, log_path, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("projection"))
    stream = file_event_source(spark, log_path, max_files=1)
    projection.stream_state_projection(stream, root, root + "/cp").awaitTermination()
    return root


def batch_tables(log):
    checked = projection.checked_log(log)
    return {
        "history": state.once_per_key(state.event_history(checked)),
        "transactions": state.latest_state_by_key(checked),
        "dead_letters": state.dead_letters(checked),
        "documents": state.document_projection(checked),
        "rates": state.fx_rate_projection(checked),
    }


def stream_tables(spark, root, log):
    schemas = projection.table_schemas(log)
    out = {n: projection.read_table(spark, root, n, schemas[n]) for n in projection.ALL_TABLES}
    out["transactions"] = state.state_view(out["transactions"])
    out["documents"] = out["documents"].drop("last_event_id")
    out["rates"] = out["rates"].drop("last_event_id")
    return out


def test_projection_equals_batch(spark, log, projected):
    want, got = batch_tables(log), stream_tables(spark, projected, log)
    for name in want:
        assert frame_rows(got[name]) == frame_rows(want[name]), name
    assert want["dead_letters"].count() > 0


def test_projection_replay_and_compaction_change_nothing(spark, log, log_path, projected):
    want = {n: frame_rows(df) for n, df in batch_tables(log).items()}
    # The same batches again, as after a lost commit, in another order.
    checked = projection.checked_log(log)
    for batch_id in (7, 5):
        projection.write_batch(checked, batch_id, projected)
        projection.write_batch(checked, batch_id, projected)
    schemas = projection.table_schemas(log)
    for name in ("transactions", "history", "documents", "rates"):
        assert projection.compact(spark, projected, name, schemas[name]) == 7
        projection.write_batch(checked, 9, projected, [name])
        assert projection.compact(spark, projected, name, schemas[name]) == 9
        assert projection.compact(spark, projected, name, schemas[name]) == 9
    got = stream_tables(spark, projected, log)
    for name in ("transactions", "history", "documents", "rates"):
        assert frame_rows(got[name]) == want[name], name


def test_folders_stay_few_over_many_batches(spark, log, tmp_path):
    """Late and repeated batches included, the base gives what one fold over everything gives."""
    root, tables = str(tmp_path / "projection"), ["history", "rates"]
    checked = projection.checked_log(log.where("offset % 29 = 0")).persist()
    schemas = projection.table_schemas(log)
    counts = []
    for batch_id in range(24):
        batch = checked.where(F.col("offset") % 24 == batch_id * 7 % 24)
        projection.run_batch(batch, batch_id, root, tables, compact_every=3)
        if batch_id % 5 == 0:
            projection.run_batch(batch, batch_id, root, tables, compact_every=3)
        if (batch_id + 1) % 3 == 0:
            counts.append([len(list((tmp_path / "projection" / n).glob("*=*"))) for n in ("history", "history_marks", "rates_marks")])
    assert max(c[0] for c in counts) <= 6 and max(max(c[1:]) for c in counts) == 2, counts
    versions = {p.name for p in (tmp_path / "projection" / "rates_base").glob("*/*")}
    assert len(list((tmp_path / "projection" / "rates_base").glob("*/*"))) <= 2 * len(versions)
    for name in tables:
        want = projection.TABLES[name][1](projection.TABLES[name][0](checked))
        assert frame_rows(projection.read_table(spark, root, name, schemas[name])) == frame_rows(want), name
    checked.unpersist()


def one_record(spark, value):
    rows = [("k", value, "tf.lc.events")]
    record = spark.createDataFrame(rows, "key string, value string, topic string").selectExpr(
        "CAST(key AS BINARY) AS key", "CAST(value AS BINARY) AS value", "topic", "0 AS partition",
        "0L AS offset", "current_timestamp() AS timestamp",
    )
    return projection.checked_log(record)


HEAD = (
    '{"event_id":"E","event_type":"LC_ISSUED","event_time":"2026-01-01T00:00:00+00:00","source":"s",'
    '"aggregate_type":"DOCUMENT","aggregate_id":"D","transaction_id":"TF-1"'
)


@pytest.mark.parametrize(
    "value, history, documents, stored, dead",
    [
        (HEAD + ',"payload":{"status":"ACTIVE"}}', 1, 1, 1, 0),
        (HEAD + "}", 1, 1, 1, 0),
        (HEAD + ',"payload":null}', 1, 0, 0, 1),
        (HEAD.replace('"source":"s",', "") + ',"payload":{}}', 0, 0, 0, 1),
        (HEAD.replace("LC_ISSUED", "FX_RATE_UPDATED") + ',"payload":{"quote_currency":"CAD","rate":1}}', 1, 1, 0, 1),
        ("not json", 0, 0, 0, 1),
        (None, 0, 0, 0, 1),
    ],
)
def test_where_a_record_goes(spark, value, history, documents, stored, dead):
    checked = one_record(spark, value)
    counts = (
        state.event_history(checked).count(),
        state.document_projection(checked).count(),
        state.latest_state_by_key(checked).count(),
        state.dead_letters(checked).count(),
    )
    assert counts == (history, documents, stored, dead)


def test_history_defaults(spark):
    row = state.event_history(one_record(spark, HEAD + "}")).first()
    assert (row.schema_version, row.payload) == ("1.0", "{}")
    assert row.row_key == "TF-1#2026-01-01T00:00:00+00:00#E"
    assert state.event_history(one_record(spark, HEAD + ',"payload":null}')).first().payload == "null"


def test_known_counts_of_the_log(spark):
    events = spark.range(10000).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-01 00:00:00' + make_interval(0,0,0,0,0,0,id) AS ts",
        "id % 150 AS user_id",
        "element_at(array('click','view','purchase','signup','error'), CAST(id % 5 + 1 AS INT)) AS event_type",
    )
    parsed = ev.parse_envelope(ev.kafka_metadata_projection(event_log(events)))
    got = parsed.agg(
        F.count_if(F.col("event").isNull()),
        F.count_if(F.col("event.event_id").isNotNull()),
        F.count_if(F.col("event.event_id").isNotNull() & F.col("event.transaction_id").isNotNull()),
        F.count_if(F.col("event.payload").isNotNull()),
    ).first()
    assert tuple(got) == (0, 9756, 9554, 9529)


@pytest.mark.parametrize(
    "event_type, topic",
    [
        ("LC_ISSUED", "tf.lc.events"),
        ("DOCUMENTS_COMPLIANT", "tf.document.events"),
        ("DISCREPANCY_IDENTIFIED", "tf.document.events"),
        ("FX_RATE_UPDATED", "tf.fx.events"),
        ("LIMIT_CHECK_COMPLETED", "tf.limit.events"),
        ("LCX", "tf.dlq.events"),
    ],
)
def test_routes(spark, event_type, topic):
    assert spark.range(1).select(ev.route_topic(F.lit(event_type))).first()[0] == topic


def test_kafka_options():
    options = kafka_options("broker:9092", "alerts", jobs.ALERT_FAMILIES)
    assert options["maxOffsetsPerTrigger"] == "500"
    assert options["subscribePattern"] == topic_pattern(jobs.ALERT_FAMILIES)
    assert "fx" not in options["subscribePattern"]
    assert RATE_LIMITS["events"] == 20


def test_complete_sink_gives_kpis_of_first_arrivals(spark, late_log, sf_dir, monkeypatch):
    """Over nine files, with the first arrivals last: all KPIs, in a number of versions that the files do not set."""
    written = []
    write = sinks.write_version
    monkeypatch.setattr(queries_events, "landed_log", lambda *_: late_log)
    monkeypatch.setattr(sinks, "write_version", lambda rows, n, path: (written.append(n), write(rows, n, path)))
    got = QUERIES["complete_stream_sink"](spark, sf_dir)
    assert frame_rows(got) == frame_rows(QUERIES["currency_kpis"](spark, sf_dir))
    assert 1 < len(set(written)) <= 4


def test_rate_limited_jobs_run_side_by_side(spark, sf_dir, monkeypatch):
    """Both jobs are started before either is waited for, and each reads every record."""
    done = []
    start = sinks.batch_sink

    class Watched:
        def __init__(self, query):
            done.append("start")
            self.query = query

        def awaitTermination(self):
            done.append("wait")
            self.query.awaitTermination()

    monkeypatch.setattr(sinks, "batch_sink", lambda *args: Watched(start(*args)))
    got = {r.job: (r.records, r.largest_batch, r.over_limit) for r in QUERIES["rate_limit"](spark, sf_dir).collect()}
    n = table(spark, sf_dir, "events").count()
    assert got == {job: (n, min(n, RATE_LIMITS[job]), 0) for job in ("kpis", "alerts")}
    assert done == ["start", "start", "wait", "wait"]
