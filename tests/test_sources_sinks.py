"""Table and payload sources, quarantine, writers and the command line job."""

import csv
import datetime as dt
import glob
import json

import pytest
from beats import DAY, T0, beat, check_metrics, frame

from playbeat.operators.reshape import distinct_labels
from playbeat.operators.sessions import key_columns
from playbeat.operators.summary import dominant_distribution, fleet_summary, label_counts
from playbeat.plans import job
from playbeat.plans.metrics import compute_metrics
from playbeat.schema import FLAT_COLUMNS, HEARTBEAT_TEXT, METRIC_COLUMNS, SESSION_METRICS
from playbeat.sinks.tables import upsert_metrics, upsert_table, write_csv, write_json, write_metrics
from playbeat.sources.heartbeats import load_snapshots, read_for_metrics, read_telemetry, with_source_file
from playbeat.sources.payload import decode_payload, split_decoded
from playbeat.sources.quarantine import split_malformed

DAY2 = dt.date(2024, 1, 2)
T1 = T0 + 86_400_000
ROWS = [
    beat(n=1, ms=900, src=50, p2p=5, quality={"720p": 30, "360p": 10}),
    beat(T0 + 30_000, T0 + 30_000, src=20, quality={"720p": 10}),
    beat(T1, T1, src=7, client="two", day=DAY2),
]


@pytest.fixture()
def table(spark, tmp_path):
    path = str(tmp_path / "beats")
    frame(spark, ROWS).write.partitionBy("eventDate").parquet(path)
    return path


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan(spark, table):
    assert read_telemetry(spark, table).count() == 3
    one = read_telemetry(spark, table, "2024-01-02")
    assert one.count() == 1
    scan = one._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(eventDate" in scan
    assert with_source_file(one).first().source_file.endswith(".parquet")


def test_narrow_scan_reads_only_byte_counters(spark, table):
    df = compute_metrics(read_for_metrics(spark, table))
    text = df._jdf.queryExecution().toString()
    assert "requestedData" not in text and "responses" not in text
    check_metrics(df, ROWS)


def test_load_snapshots(spark, table):
    assert load_snapshots(spark, table).count() == 3
    assert load_snapshots(spark, table, "2024-01-02").first().clientId == "two"
    assert load_snapshots(spark, table, "2024-01-02").first().eventDate == DAY2
    for path, day in ((table, "2024-03-01"), (table + "-missing", None)):
        with pytest.raises(FileNotFoundError):
            load_snapshots(spark, path, day)


def test_payloads(spark):
    good = json.dumps({
        "customerId": "c", "contentId": "w", "clientId": "v", "eventDate": "2024-01-01",
        "timestampInfo": {"agent": T0}, "player": {"bufferings": 2, "bufferingTime": 70},
        "qualityDistribution": {"720p": {"sourceTraffic": {"receivedData": 5}}},
    })
    lines = [good, good[:30], good.replace('"bufferings": 2', '"bufferings": "x"')]
    received = dt.datetime(2024, 1, 1, 0, 0, 1, tzinfo=dt.timezone.utc)
    raw = spark.createDataFrame([(x, received) for x in lines], "value string, timestamp timestamp")
    valid, corrupt = split_decoded(decode_payload(raw))
    row = valid.first()
    assert valid.count() == 1 and corrupt.count() == 2
    assert tuple(row.timestampInfo) == (T0 + 1_000, T0) and row.eventDate == DAY
    assert row.qualityDistribution["720p"].sourceTraffic.receivedData == 5


def test_quarantine(spark):
    def text(count, quality=None, day="2024-01-01", server=str(T0)):
        return ("c", "w", "v", (server, None), (count, "0"), None, quality, day)

    bad_map = {"720p": ((None, None, None, "many"), None)}
    good_map = {"720p": (("1", "0.5", "3", "4"), None)}
    rows = [text("x"), text("5"), text("1.5"), text("1.0"), text("1", bad_map), text("1", good_map),
            text("1", day="soon"), text(str(2**40)), text(None, server="99999999999999999999")]
    valid, bad = split_malformed(spark.createDataFrame(rows, HEARTBEAT_TEXT))
    assert sorted(r.player.bufferings for r in valid.collect()) == [1, 1, 5, 2**40]
    kept = [r.qualityDistribution for r in valid.collect() if r.qualityDistribution]
    assert tuple(kept[0]["720p"].sourceTraffic) == (1, 0.5, 3, 4)
    assert sorted(tuple(r.reasons) for r in bad.collect()) == [
        ("eventDate",), ("player.bufferings",), ("player.bufferings",),
        ("qualityDistribution",), ("timestampInfo.server",),
    ]


def test_write_replaces_only_dates_present(spark, tmp_path):
    path = str(tmp_path / "out")
    metrics = compute_metrics(frame(spark, ROWS))
    write_metrics(metrics, path)
    write_metrics(metrics.filter("event_date = '2024-01-02'").selectExpr(
        *[f"9L as {c}" if c == "snapshot_count" else c for c in METRIC_COLUMNS]), path)
    got = spark.read.schema(SESSION_METRICS).parquet(path)
    assert {r.client_id: r.snapshot_count for r in got.collect()} == {"v": 2, "two": 9}
    write_metrics(metrics.filter("client_id = 'v'"), path, replace_table=True)
    assert spark.read.schema(SESSION_METRICS).parquet(path).count() == 1


def test_write_by_customer_and_content(spark, tmp_path):
    path = str(tmp_path / "out")
    write_metrics(compute_metrics(frame(spark, ROWS)), path, "json", ("customer_id", "content_id"))
    assert glob.glob(f"{path}/customer_id=c/content_id=w/*.json")


def test_json_lines_keep_nulls(spark, tmp_path):
    write_json(compute_metrics(frame(spark, ROWS)), str(tmp_path / "j"))
    rows = [json.loads(x) for f in glob.glob(str(tmp_path / "j" / "*.json")) for x in open(f)]
    two = next(r for r in rows if r["client_id"] == "two")
    assert list(two) == METRIC_COLUMNS
    assert two["dominant_quality"] is None and two["quality_breakdown"] == [] and two["event_date"] == "2024-01-02"


def test_csv(spark, tmp_path):
    write_csv(compute_metrics(frame(spark, ROWS)).coalesce(1), str(tmp_path / "c"))
    (name,) = glob.glob(str(tmp_path / "c" / "*.csv"))
    raw = open(name).read()
    rows = {r["client_id"]: r for r in csv.DictReader(raw.splitlines())}
    assert raw.splitlines()[0].split(",") == FLAT_COLUMNS + [
        "quality_bytes_360p", "quality_bytes_720p", "quality_pct_360p", "quality_pct_720p"]
    assert rows["v"]["avg_buffering_duration_ms"] == "900.0" and rows["v"]["buffering_ratio"] == "0.015"
    assert rows["v"]["quality_pct_720p"] == "80.0" and rows["v"]["p2p_ratio"] == "0.0667"
    assert rows["two"]["dominant_quality"] == "" and rows["two"]["quality_bytes_720p"] == "0"
    assert '""' not in raw


def test_upsert(spark, tmp_path):
    path = str(tmp_path / "t")
    metrics = compute_metrics(frame(spark, ROWS))
    upsert_table(spark, metrics, path)
    more = [beat(n=4, src=1), beat(client="three")]
    updates = compute_metrics(frame(spark, more))
    merged = {r.client_id: r.total_buffering_events for r in upsert_metrics(metrics, updates).collect()}
    assert merged == {"v": 4, "two": 0, "three": 0}
    upsert_table(spark, updates, path)
    got = spark.read.schema(SESSION_METRICS).parquet(path)
    assert {r.client_id: r.total_buffering_events for r in got.collect()} == merged


def test_job(spark, table, tmp_path, capsys):
    out = str(tmp_path / "out")
    run = lambda *more: job.run_batch(spark, job.parse_args(["--input", table, "--output", out, *more]))
    assert run() == 0
    assert "viewers" in capsys.readouterr().out
    got = spark.read.schema(SESSION_METRICS).parquet(f"{out}/viewer_metrics")
    check_metrics(got, ROWS)
    assert glob.glob(f"{out}/viewer_metrics_csv/*.csv") and glob.glob(f"{out}/viewer_metrics_json/*.json")
    assert run("--date", "2024-01-02", "--no-files") == 0
    assert spark.read.schema(SESSION_METRICS).parquet(f"{out}/viewer_metrics").count() == 2
    assert run("--date", "2025-01-01") == 1
    assert run("--min-snapshots", "5") == 0
    assert "min_snapshots" in capsys.readouterr().err


def test_job_sets_rejected_sessions_aside(spark, tmp_path):
    path, out = str(tmp_path / "beats"), str(tmp_path / "out")
    frame(spark, [*ROWS, beat(src=10, p2p=-1, client="bad")]).write.partitionBy("eventDate").parquet(path)
    assert job.run_batch(spark, job.JobParams(path, out, files=False)) == 0
    assert spark.read.json(f"{out}/rejected_sessions").first().client_id == "bad"
    assert spark.read.parquet(f"{out}/viewer_metrics").count() == 2


def test_streaming_needs_a_checkpoint():
    with pytest.raises(SystemExit):
        job.parse_args(["--input", "a", "--output", "b", "--streaming"])


def test_scratch_is_below_the_shared_folder(spark):
    from playbeat.session import shared_dir

    assert shared_dir(spark, "x").startswith(spark.sparkContext.getConf().get("spark.checkpoint.dir") + "/x-")


def run_job(spark, *args):
    return job.run_batch(spark, job.parse_args(list(args)))


def output(spark, out):
    return sorted(map(str, spark.read.schema(SESSION_METRICS).parquet(f"{out}/viewer_metrics").select(*METRIC_COLUMNS).collect()))


@pytest.mark.parametrize("more", [(), ("--by-date",), ("--partition-by", "customer_id,content_id")])
def test_date_rerun_of_unchanged_input_changes_nothing(spark, tmp_path, more):
    path, out = str(tmp_path / "beats"), str(tmp_path / "out")
    midnight = [beat(T1 - 30_000, T1 - 30_000, client="late"), beat(T1 + 30_000, T1 + 30_000, client="late", day=DAY2)]
    frame(spark, [*ROWS, *midnight]).write.partitionBy("eventDate").parquet(path)
    assert run_job(spark, "--input", path, "--output", out, "--no-files", *more) == 0
    first = output(spark, out)
    for day in ("2024-01-02", "2024-01-01"):
        assert run_job(spark, "--input", path, "--output", out, "--no-files", "--date", day, *more) == 0
        assert output(spark, out) == first
    assert not glob.glob(f"{out}/*staging*")


def test_a_rerun_reads_the_dates_of_its_sessions_only(spark, tmp_path, monkeypatch):
    """The index names the dates; it follows a table that changes, and a hash met twice only costs a read."""
    path, out = str(tmp_path / "beats"), str(tmp_path / "out")
    day = 86_400_000
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(6)]
    rows = [beat(T0 + i * day, T0 + i * day, client=f"v{i}", day=d) for i, d in enumerate(days)]
    over = beat(T0 + 3 * day + 1, client="v1", day=days[3])
    frame(spark, [*rows, over]).write.partitionBy("eventDate").parquet(path)
    params = job.JobParams(path, out, str(days[1]), files=False)

    def dates_read():
        touched = job._load(spark, params, params.date)[0].selectExpr(*key_columns()).distinct()
        beats = job.load_sessions(spark, params, touched)
        files = {f for f in beats.inputFiles() if "eventDate=" in f}
        assert sorted(r.clientId for r in beats.select("clientId").distinct().collect()) == ["v1"]
        return sorted({f.split("eventDate=")[1].split("/")[0] for f in files})

    indexed = []
    build = job.refresh_index
    monkeypatch.setattr(job, "refresh_index", lambda s, i, x, load: build(s, i, x, lambda d: indexed.append(d) or load(d)))
    assert dates_read() == ["2024-01-02", "2024-01-04"]
    assert dates_read() == ["2024-01-02", "2024-01-04"]
    frame(spark, [beat(T0 + 5 * day + 1, client="v1", day=days[5])]).write.mode("append").partitionBy("eventDate").parquet(path)
    assert dates_read() == ["2024-01-02", "2024-01-04", "2024-01-06"]
    assert indexed == [[str(d) for d in days], ["2024-01-06"]]
    assert job.run_batch(spark, job.JobParams(path, out, files=False)) == 0
    first = output(spark, out)
    assert job.run_batch(spark, params) == 0
    assert output(spark, out) == first


def test_emptied_date(spark, tmp_path):
    path, out = str(tmp_path / "beats"), str(tmp_path / "out")
    frame(spark, ROWS).write.partitionBy("eventDate").parquet(path)
    for more in ((), ("--by-date",)):
        assert run_job(spark, "--input", path, "--output", out, *more) == 0
        assert run_job(spark, "--input", path, "--output", out, "--date", "2024-01-02", "--min-snapshots", "2", *more) == 0
        assert {r.client_id for r in spark.read.schema(SESSION_METRICS).parquet(f"{out}/viewer_metrics").collect()} == {"v"}


def test_upsert_follows_a_session_that_moves(spark, tmp_path):
    path = str(tmp_path / "t")
    late = [beat(T1, T1, day=DAY2), beat(T1, T1, client="other", day=DAY2)]
    upsert_table(spark, compute_metrics(frame(spark, late)), path)
    upsert_table(spark, compute_metrics(frame(spark, [beat(), late[0]])), path)
    got = {(r.client_id, str(r.event_date)): r.snapshot_count for r in spark.read.schema(SESSION_METRICS).parquet(path).collect()}
    assert got == {("v", "2024-01-01"): 2, ("other", "2024-01-02"): 1}


@pytest.mark.parametrize("counter,responses", [("int", "bigint"), ("bigint", "double"), ("double", "float"), ("string", "int")])
def test_files_in_their_own_types(spark, tmp_path, counter, responses):
    path, out = str(tmp_path / "beats"), str(tmp_path / "out")
    rows = [beat(n=2, ms=70, src=5, quality={"720p": 5}), beat(T0 + 30_000, T0 + 30_000, n=1, ms=5, src=6)]
    df = frame(spark, rows)
    leaf = f"struct<requests:{counter},responses:{responses},requestedData:{counter},receivedData:{counter}>"
    dist = f"struct<sourceTraffic:{leaf},p2pTraffic:{leaf}>"
    kinds = {"player": f"struct<bufferings:{counter},bufferingTime:{counter}>", "totalDistribution": dist, "qualityDistribution": f"map<string,{dist}>"}
    df.selectExpr(*[f"cast({c} as {kinds[c]}) as {c}" if c in kinds else c for c in df.columns]).write.partitionBy("eventDate").parquet(path)
    got = load_snapshots(spark, path)
    assert got.schema.simpleString() == df.select(*got.columns).schema.simpleString()
    assert run_job(spark, "--input", path, "--output", out, "--no-files") == 0
    check_metrics(spark.read.schema(SESSION_METRICS).parquet(f"{out}/viewer_metrics"), rows)


def test_job_quarantines_bad_values_and_clocks(spark, tmp_path):
    path, out = str(tmp_path / "beats"), str(tmp_path / "out")
    rows = [beat(n=i, client=f"v{i}") for i in range(4)] + [beat(10**17, client="far"), beat(None, T0, client="nodate", day=None)]
    df = frame(spark, rows)
    text = "struct(if(clientId = 'v2', 'x', cast(player.bufferings as string)) as bufferings, cast(player.bufferingTime as string) as bufferingTime) as player"
    df.selectExpr(*[text if c == "player" else c for c in df.columns]).write.partitionBy("eventDate").parquet(path)
    assert run_job(spark, "--input", path, "--output", out, "--no-files") == 0
    assert {r.client_id for r in spark.read.schema(SESSION_METRICS).parquet(f"{out}/viewer_metrics").collect()} == {"v0", "v1", "v3"}
    bad = spark.read.schema("row string, reasons array<string>").json(f"{out}/quarantine").collect()
    assert sorted(tuple(r.reasons) for r in bad) == [("no date",), ("player.bufferings",), ("timestampInfo.server out of range",)]
    assert any('"clientId":"far"' in r.row for r in bad)


def test_job_payload_and_dedup(spark, tmp_path):
    path, out = str(tmp_path / "payloads"), str(tmp_path / "out")
    body = json.dumps({"customerId": "c", "contentId": "w", "clientId": "v", "eventDate": "2024-01-01", "timestampInfo": {"agent": T0}, "totalDistribution": {"sourceTraffic": {"receivedData": 5}}})
    received = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    spark.createDataFrame([(x, received) for x in (body, body, body[:20])], "value string, timestamp timestamp").write.parquet(path)
    for more, count in ((), 2), (("--dedup",), 1):
        assert run_job(spark, "--input", path, "--output", out, "--no-files", "--payload", *more) == 0
        assert spark.read.schema(SESSION_METRICS).parquet(f"{out}/viewer_metrics").first().snapshot_count == count
    assert spark.read.schema("row string, reasons array<string>").json(f"{out}/quarantine").count() == 1


def test_streaming_refuses_a_date():
    with pytest.raises(SystemExit):
        job.parse_args(["--input", "a", "--output", "b", "--streaming", "--checkpoint", "c", "--date", "2024-01-01"])


def test_job_counts_on_its_one_write(spark, tmp_path, capsys, monkeypatch):
    """Counts, means and labels are those of the written table, and the metrics are computed by one write."""
    figures, stage = [], job.stage_metrics
    monkeypatch.setattr(job, "stage_metrics", lambda *a: figures.append(stage(*a)) or figures[-1])
    path, out = str(tmp_path / "beats"), str(tmp_path / "out")
    rows = [*ROWS, beat(src=10, p2p=-1, client="bad"), beat(client="plain"), beat(T0 + 1, client="plain")]
    frame(spark, rows).write.partitionBy("eventDate").parquet(path)
    assert job.run_batch(spark, job.JobParams(path, out, files=False, min_snapshots=2)) == 0
    written = spark.read.schema(SESSION_METRICS).parquet(f"{out}/viewer_metrics")
    assert figures[0]["sessions"] == compute_metrics(frame(spark, rows)).count()
    assert figures[0]["viewers"] == written.count() and figures[0]["rejected"] == 0
    assert job.run_batch(spark, job.JobParams(path, out, files=False)) == 0
    assert "1 sessions with values out of range" in capsys.readouterr().err
    written = spark.read.schema(SESSION_METRICS).parquet(f"{out}/viewer_metrics")
    assert figures[1]["rejected"] == 1
    summary = fleet_summary(written).first()
    assert (figures[1]["viewers"], figures[1]["viewers_with_buffering"]) == (summary.viewers, summary.viewers_with_buffering)
    assert figures[1]["avg_buffering_ratio"] == pytest.approx(summary.avg_buffering_ratio)
    labels = label_counts(written).collect()
    assert sorted(r.quality_label for r in labels if r.sessions) == [r[0] for r in distinct_labels(written).collect()]
    led = {r.quality_label: r.dominated for r in labels if r.dominated}
    assert led == {r.dominant_quality: r["count"] for r in dominant_distribution(written, include_missing=True).collect()}


def test_job_over_no_heartbeat_writes_nothing(spark, tmp_path, capsys):
    path, out = str(tmp_path / "beats"), str(tmp_path / "out")
    frame(spark, [beat()]).write.partitionBy("eventDate").parquet(path)
    frame(spark, [beat()]).limit(0).drop("eventDate").write.mode("overwrite").parquet(f"{path}/eventDate=2024-01-01")
    assert job.run_batch(spark, job.JobParams(path, out)) == 0
    assert "holds no usable heartbeat" in capsys.readouterr().err
    assert not glob.glob(f"{out}/viewer_metrics*") and not glob.glob(f"{out}/_staging*")
