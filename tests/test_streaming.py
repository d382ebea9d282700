"""Batch and stream give the same result, however the input is split and wherever the stream stops."""

import datetime as dt
from types import SimpleNamespace

import pandas as pd
import pytest
from beats import T0, beat, check_metrics, events_frame, expected_heartbeats, frame
from test_player import random_events, windows
from test_sessions import random_rows

from playbeat.operators.dedup import dedup_stream
from playbeat.operators.insights import window_metrics
from playbeat.operators.quality import quality_bytes
from playbeat.operators.sessions import buffering_metrics
from playbeat.operators.validate import validate_metrics
from playbeat.plans import catalog
from playbeat.plans.metrics import compute_metrics
from playbeat.schema import HEARTBEAT, PLAYER_EVENT, SESSION_METRICS
from playbeat.session import list_dir
from playbeat.sources.heartbeats import stream_telemetry
from playbeat.sources.quarantine import split_clocks
from playbeat.streaming import player, running, sessions, windows as late_windows


def texts(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def write_files(spark, rows, path, n, make=frame):
    for i in range(n):
        if rows[i::n]:
            make(spark, rows[i::n]).coalesce(1).write.mode("append").parquet(path)


def usable(rows):
    """Without the heartbeats that have neither a date nor a server time: the sink sets them aside."""
    return [r for r in rows if r[7] is not None or (r[3] and r[3][0] is not None)]


def stream(spark, path, schema=HEARTBEAT, per_batch=1):
    return stream_telemetry(spark, path, "parquet", schema, maxFilesPerTrigger=str(per_batch))


def run(spark, paths, **kw):
    sessions.start_sessions(
        stream(spark, paths["in"]), paths["out"], paths["check"], paths["state"], None, **kw
    ).awaitTermination()


@pytest.fixture()
def paths(tmp_path):
    return {k: str(tmp_path / k) for k in ("in", "out", "check", "state")}


@pytest.mark.parametrize("files", [1, 5])
def test_session_totals_across_batches(spark, paths, files):
    rows = random_rows(300, files)
    write_files(spark, rows, paths["in"], files)
    run(spark, paths, generation=2)
    assert published(spark, paths) == batch_result(spark, rows)
    check_metrics(sessions.current_metrics(spark, paths["state"]), usable(rows))
    assert len(sessions.open_deltas(spark, paths["state"])) <= 2


def published(spark, paths, **by):
    return texts(spark.read.schema(SESSION_METRICS).parquet(paths["out"]).drop("bucket"))


def batch_result(spark, rows, **kw):
    """What a batch run with the same settings publishes."""
    return texts(validate_metrics(compute_metrics(split_clocks(frame(spark, rows))[0], **kw))[0])


@pytest.mark.parametrize("kw", [{"by_date": True}, {"min_snapshots": 3}, {"publish_every": 3, "generation": 2}])
def test_stream_settings_equal_batch(spark, paths, kw):
    rows = random_rows(200, 8)
    write_files(spark, rows, paths["in"], 6)
    run(spark, paths, **kw)
    if "publish_every" in kw:
        sessions.SessionSink(paths["out"], paths["state"], **kw).flush(spark)
    assert published(spark, paths) == batch_result(spark, rows, **{k: v for k, v in kw.items() if k in ("by_date", "min_snapshots")})


def test_nothing_is_lost_when_settings_or_checkpoints_change(spark, paths, tmp_path):
    rows = random_rows(240, 31)
    write_files(spark, rows[:80], paths["in"], 4)
    run(spark, paths, generation=1)
    write_files(spark, rows[80:160], paths["in"], 3)
    run(spark, paths, generation=20)
    other = {**paths, "in": str(tmp_path / "in2"), "check": str(tmp_path / "check2")}
    write_files(spark, rows[160:], other["in"], 4)
    run(spark, other, generation=3)
    check_metrics(sessions.current_metrics(spark, paths["state"]), usable(rows))
    assert published(spark, paths) == batch_result(spark, rows)


def test_deltas_and_bases_do_not_pile_up(spark, paths):
    sink = sessions.microbatch_sink(paths["out"], paths["state"], generation=2, publish_every=100)
    rows = random_rows(90, 6)
    for i in range(15):
        sink(frame(spark, rows[i * 6 : i * 6 + 6]), i)
    state = paths["state"]
    assert len(list_dir(spark, f"{state}/delta")) <= 6 and len(list_dir(spark, f"{state}/commits")) <= 3
    sink.flush(spark)
    check_metrics(sessions.current_metrics(spark, state), usable(rows))
    assert published(spark, paths) == batch_result(spark, rows)


def test_rejected_sessions_of_the_stream(spark, paths):
    sink = sessions.microbatch_sink(paths["out"], paths["state"])
    sink(frame(spark, [beat(src=10, p2p=-1, client="bad"), beat(src=1, client="ok")]), 0)
    rejected = spark.read.schema("client_id string, reasons array<string>").json(paths["out"] + "_rejected")
    assert [r.client_id for r in rejected.collect()] == ["bad"]
    sink(frame(spark, [beat(p2p=50, client="bad")]), 1)
    assert {r.client_id for r in spark.read.schema(SESSION_METRICS).parquet(paths["out"]).collect()} == {"ok", "bad"}
    assert spark.read.schema("client_id string").json(paths["out"] + "_rejected").count() == 0


def test_restart(spark, paths):
    rows = random_rows(200, 21)
    write_files(spark, rows[:120], paths["in"], 2)
    run(spark, paths, generation=1)
    write_files(spark, rows[120:], paths["in"], 2)
    run(spark, paths, generation=1)
    assert published(spark, paths) == batch_result(spark, rows)


def test_partitioned_table_to_json_table(spark, paths):
    rows = [r for r in random_rows(80, 13) if r[7] is not None]
    frame(spark, rows).write.partitionBy("eventDate").parquet(paths["in"])
    sessions.run_streaming(
        spark, paths["in"], paths["out"], paths["check"], None, fmt="json", state_path=paths["state"]
    )
    assert texts(spark.read.schema(SESSION_METRICS).json(paths["out"]).drop("bucket")) == batch_result(spark, rows)


def test_replayed_batch_counts_once(spark, paths):
    rows = random_rows(60, 4)
    sink = sessions.microbatch_sink(paths["out"], paths["state"])
    for batch_id, part in ((0, rows[:30]), (1, rows[30:]), (1, rows[30:])):
        sink(frame(spark, part), batch_id)
    check_metrics(sessions.current_metrics(spark, paths["state"]), usable(rows))


def test_compaction_broken_off_is_not_read(spark, paths):
    rows = random_rows(60, 9)
    sink = sessions.microbatch_sink(paths["out"], paths["state"], generation=1)
    sink(frame(spark, rows[:30]), 0)
    junk = sessions.read_state(spark, paths["state"])
    junk.write.mode("overwrite").partitionBy("eventDate").parquet(paths["state"] + "/base/seq=0")
    check_metrics(sessions.current_metrics(spark, paths["state"]), usable(rows[:30]))
    sink(frame(spark, rows[30:]), 1)
    check_metrics(sessions.current_metrics(spark, paths["state"]), usable(rows))


def test_microbatch_function_is_the_batch_function(spark):
    df = frame(spark, random_rows(50, 2))
    assert texts(sessions.microbatch_metrics(df)) == texts(compute_metrics(df, by_date=True))


def latest(spark, df, name, keys, checkpoint):
    """Last row per key that an update-mode query gave."""
    seen = {}

    def keep(batch, _):
        for r in batch.collect():
            seen[tuple(r[k] for k in keys)] = r

    q = df.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", checkpoint)
    q.trigger(availableNow=True).start().awaitTermination()
    return sorted(map(str, seen.values()))


def test_stateful_forms(spark, paths):
    rows = random_rows(200, 5)
    write_files(spark, rows, paths["in"], 3)
    keys = ["customerId", "contentId", "clientId"]
    got = latest(spark, sessions.stream_sessions(stream(spark, paths["in"])), "s", keys, paths["check"])
    assert got == sorted(map(str, buffering_metrics(frame(spark, rows)).collect()))
    labels = sessions.stream_quality(stream(spark, paths["in"]))
    got = latest(spark, labels, "q", [*keys, "quality_label"], paths["state"])
    assert got == sorted(map(str, quality_bytes(frame(spark, rows)).collect()))


def test_running_metrics_are_the_session_metrics(spark, paths):
    rows = usable(random_rows(200, 5))
    rows += [beat(src=2**62, client="big", quality={"x": 2**62}), beat(T0 + 1, src=2**62, client="big", quality={"x": 2**62, "'odd": 1})]
    rows += [beat(T0 + i, src=1, client="hot", quality={"720p": 1, f"l{i % 3}": 2}) for i in range(300)]
    write_files(spark, rows, paths["in"], 3)
    got = latest(spark, running.running_metrics(stream(spark, paths["in"])), "r", ["customer_id", "content_id", "client_id"], paths["check"])
    want = sorted(map(str, compute_metrics(frame(spark, rows)).collect()))
    assert got == want


class Entries(dict):
    """A map state that counts how often it is asked."""

    calls = 0

    def containsKey(self, key):
        self.calls += 1
        return key in self

    def getValue(self, key):
        self.calls += 1
        return self[key]

    def updateValue(self, key, value):
        self.calls += 1
        self[key] = value


def test_one_call_serves_many_sessions_and_touches_the_state_of_each_once():
    held = Entries()
    processor = running.RunningSessions()
    processor.init(SimpleNamespace(getMapState=lambda *_: held))

    def part(clients, server):
        rows = [("c", "w", v, server, server + 1, 1, 2, 3, 4, 5.0, [{"label": f"l{v}", "label_bytes": 7}]) for v in clients]
        return pd.DataFrame(rows, columns=running.ROW)

    for turn in (1, 2):
        before = held.calls
        parts = [part([f"v{i}" for i in range(40)], 10 * turn), part(["v0"] * 5, 10 * turn + 5)]
        given = pd.concat(processor.handleInputRows((3,), iter(parts), None))
        assert held.calls - before <= 3 * 40 and len(given) == len(held) == 40
        row = given.set_index("clientId").loc["v0"]
        assert (row["snapshot_count"], row["session_start_ms"], row["last_agent_ms"]) == (6 * turn, 10, 10 * turn + 6)
        assert row["quality"] == {"lv0": 42 * turn} and row["p2p_received_bytes"] == 24 * turn


def test_few_buckets_give_the_same_running_metrics(spark, paths):
    rows = usable(random_rows(120, 8))
    write_files(spark, rows, paths["in"], 3)
    got = latest(spark, running.running_metrics(stream(spark, paths["in"]), buckets=2), "r", ["customer_id", "content_id", "client_id"], paths["check"])
    assert got == sorted(map(str, compute_metrics(frame(spark, rows)).collect()))


def test_reading_back_running_rows_leaves_the_schema_alone(spark, tmp_path):
    events = [(i, dt.datetime(2024, 1, 1 + i % 3), i % 4, "view", 1.5, '{"k": 1}') for i in range(20)]
    kind = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
    spark.createDataFrame(events, kind).write.parquet(f"{tmp_path}/events.parquet")
    names = SESSION_METRICS.fieldNames()
    assert catalog.running_sessions(spark, str(tmp_path)).count() == 4
    assert SESSION_METRICS.fieldNames() == names


def test_windows_with_watermark(spark, paths):
    rows = [beat(T0 + i * 1_000, n=i % 2, ms=i, src=i) for i in range(100)]
    write_files(spark, rows, paths["in"], 1)
    write_files(spark, [beat(T0 + 10**7)], paths["in"], 1)
    write_files(spark, [beat(T0 + 2 * 10**7)], paths["in"], 1)
    df = sessions.stream_window_metrics(stream(spark, paths["in"]))
    query = df.writeStream.format("memory").queryName("windows").outputMode("append")
    query.option("checkpointLocation", paths["check"]).trigger(availableNow=True).start().awaitTermination()
    closed = f"window_start_ms < {T0 + 10**6}"
    assert texts(spark.table("windows").filter(closed)) == texts(window_metrics(frame(spark, rows)).filter(closed))


def test_dedup_stream(spark, paths):
    write_files(spark, [beat(), beat(), beat(T0 + 1), beat(client="two")], paths["in"], 2)
    query = dedup_stream(stream(spark, paths["in"])).writeStream.format("memory").queryName("unique")
    query.option("checkpointLocation", paths["check"]).trigger(availableNow=True).start().awaitTermination()
    assert spark.table("unique").count() == 3


def test_dedup_stream_without_server_time(spark, paths):
    rows = [beat(None, T0), beat(None, T0), beat(None, T0 + 1), beat(None, None, n=1), beat(None, None, n=1), beat()]
    write_files(spark, rows, paths["in"], 1)
    query = dedup_stream(stream(spark, paths["in"])).writeStream.format("memory").queryName("clockless")
    query.option("checkpointLocation", paths["check"]).trigger(availableNow=True).start().awaitTermination()
    assert spark.table("clockless").count() == 5


@pytest.mark.parametrize("files", [3])
def test_player_stream(spark, paths, files):
    rows = random_events(8, 400, 700_000)
    df = events_frame(spark, rows).repartition(files)
    df.write.parquet(paths["in"])
    events = stream(spark, paths["in"], PLAYER_EVENT)
    player.start_player_stream(events, paths["state"], paths["out"], paths["check"], None).awaitTermination()
    start = T0 // 30_000 * 30_000
    got = windows(spark.read.schema(HEARTBEAT).parquet(paths["out"]), start)
    assert got == expected_heartbeats(rows, start=start)


def test_player_log_filled_by_two_checkpoints(spark, paths, tmp_path):
    """A new checkpoint counts its batches from 0 again; nothing of the first one's events is replaced."""
    rows = random_events(9, 120, 200_000)
    for i in (0, 1):
        source, check = str(tmp_path / f"in{i}"), str(tmp_path / f"check{i}")
        df = events_frame(spark, rows)
        df.filter(f"event_id {'<' if i == 0 else '>='} 70").coalesce(1).write.parquet(source)
        player.start_player_stream(stream(spark, source, PLAYER_EVENT), paths["state"], paths["out"], check, None).awaitTermination()
    assert spark.read.parquet(paths["state"]).count() == len(rows)
    start = T0 // 30_000 * 30_000
    assert windows(spark.read.schema(HEARTBEAT).parquet(paths["out"]), start) == expected_heartbeats(rows, start=start)


def files(path):
    """Data files and when each was written."""
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in path.rglob("part-*")}


def test_a_batch_opens_and_writes_only_its_buckets(spark, paths, tmp_path):
    contents = [f"w{i}" for i in range(40)]
    first = [beat(T0 + i, content=c, client=f"v{i}", src=5) for c in contents for i in range(3)]
    sink = sessions.microbatch_sink(paths["out"], paths["state"], generation=1)
    sink(frame(spark, first), 0)
    sink(frame(spark, [beat(T0 + 10, content="w0", client="v0", src=5)]), 1)  # compacts what was there
    before = files(tmp_path / "out")
    later = [beat(T0 + 50_000, content=c, client="v1", src=7) for c in ("w3", "w4")]
    own = {r.bucket for r in frame(spark, later).select(sessions.bucket_of(sessions.BUCKETS)).collect()}
    opened = sessions.read_state(spark, paths["state"], own).inputFiles()
    assert opened and {int(f.rsplit("bucket=", 1)[1].split("/")[0]) for f in opened} <= own
    sink(frame(spark, later), 2)
    after = files(tmp_path / "out")
    changed = {f for f in {*before, *after} if before.get(f) != after.get(f)}
    assert changed and {int(f.split("bucket=")[1].split("/")[0]) for f in changed} <= own and len(own) <= 2
    assert published(spark, paths) == batch_result(spark, [*first, beat(T0 + 10, content="w0", client="v0", src=5), *later])


def test_a_session_that_moves_to_an_earlier_date_leaves_the_later_one(spark, paths, tmp_path):
    day = 86_400_000
    sink = sessions.microbatch_sink(paths["out"], paths["state"])
    rows = [beat(T0 + day + 5, day=None), beat(T0 + day + 9, day=None, client="stays", content="else")]
    sink(frame(spark, rows), 0)
    sink(frame(spark, [beat(T0 + 5, day=None)]), 1)
    assert published(spark, paths) == batch_result(spark, [*rows, beat(T0 + 5, day=None)])
    assert len({f.split("/")[0] for f in files(tmp_path / "out")}) == 2


def test_the_number_of_buckets_is_that_of_the_state(spark, paths):
    rows = random_rows(90, 17)
    sessions.microbatch_sink(paths["out"], paths["state"], buckets=3)(frame(spark, rows[:40]), 0)
    sessions.microbatch_sink(paths["out"], paths["state"], buckets=50, generation=1)(frame(spark, rows[40:]), 1)
    assert sessions.bucket_count(spark, paths["state"]) == 3
    assert published(spark, paths) == batch_result(spark, rows)


def window_rows(n, spread):
    """Heartbeats of two contents whose order in the files is not that of time."""
    return [beat(T0 + (i * 7919 % n) * spread, n=i % 2, ms=i, src=i, content="wx"[i % 2], client=str(i)) for i in range(n)]


def drain_windows(spark, paths, delay_ms=60_000):
    late_windows.start_windows(stream(spark, paths["in"]), paths["out"], paths["check"], delay_ms, None).awaitTermination()


def test_late_heartbeats_are_kept(spark, paths):
    rows = window_rows(120, 5_000)
    write_files(spark, rows[:80], paths["in"], 3)
    drain_windows(spark, paths)
    write_files(spark, [*rows[80:], beat(T0 - 10**8, src=3)], paths["in"], 2)  # after a restart, one very late
    drain_windows(spark, paths)
    assert texts(late_windows.all_windows(spark, paths["out"])) == texts(window_metrics(frame(spark, [*rows, beat(T0 - 10**8, src=3)])))
    late = late_windows.read_windows(spark, paths["out"], "late")
    assert late.filter(f"window_start_ms < {T0}").count() == 1
    closed = late_windows.read_windows(spark, paths["out"], "closed").select(*late_windows.WINDOW_KEYS)
    assert closed.count() == closed.distinct().count() > 0
    assert len(list_dir(spark, paths["out"] + "/_commits")) <= 2


def test_closed_windows_are_those_of_the_watermarked_aggregate(spark, paths):
    """Where the aggregate has an empty micro-batch after each, in which it closes windows."""
    rows = window_rows(90, 4_000)
    for i in range(3):
        write_files(spark, rows[i::3], paths["in"], 1)
        drain_windows(spark, paths)
        plain = sessions.stream_window_metrics(stream(spark, paths["in"]), watermark="1 minute").writeStream
        plain.format("parquet").option("checkpointLocation", paths["check"] + "2").trigger(availableNow=True).start(
            paths["state"]
        ).awaitTermination()
    assert texts(late_windows.read_windows(spark, paths["out"], "closed").drop("batch", "kind")) == texts(
        spark.read.parquet(paths["state"])
    )


def test_window_batches_replayed_or_broken_off(spark, paths, monkeypatch):
    rows = window_rows(60, 5_000)
    sink = late_windows.WindowSink(paths["out"], None)
    parts = [frame(spark, rows[i::3]) for i in range(3)]
    sink(parts[0], 0)
    sink(parts[0], 0)
    with monkeypatch.context() as m:  # lost after the rows were written, before the commit
        m.setattr(late_windows, "COMMIT", "no type")
        with pytest.raises(Exception):
            sink(parts[1], 1)
    sink(parts[1], 1)
    sink(frame(spark, []), 2)
    sink(parts[2], 3)
    late_windows.WindowSink(paths["out"], None)(parts[2], 3)
    assert texts(late_windows.all_windows(spark, paths["out"])) == texts(window_metrics(frame(spark, rows)))


def test_windows_of_clocks_at_the_limits(spark, paths):
    assert late_windows.all_windows(spark, paths["out"]).count() == 0
    rows = [beat(-(2**63) + 1, src=1), beat(T0, src=2), beat(2**63 - 1, src=3), beat(None, src=4), beat(T0 + 1, src=5)]
    sink = late_windows.WindowSink(paths["out"], None)
    for i, row in enumerate(rows):
        sink(frame(spark, [row]), i)
    assert texts(late_windows.all_windows(spark, paths["out"])) == texts(window_metrics(frame(spark, rows)))
