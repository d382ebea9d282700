"""Session metrics on edge rows and on random rows against a plain loop."""

import datetime as dt
import random

import pytest
from beats import DAY, T0, beat, check_metrics, frame
from pyspark.sql import functions as F

from playbeat.operators import quality
from playbeat.operators.dedup import dedup_heartbeats
from playbeat.operators.insights import window_metrics
from playbeat.operators.reshape import flatten_metrics
from playbeat.operators.sessions import buffering_metrics
from playbeat.operators.summary import dominant_distribution, fleet_summary, fleet_summary_pct
from playbeat.plans.metrics import compute_metrics, process_all
from playbeat.operators.validate import validate_metrics
from playbeat.plans.partials import PARTIAL, finalize, merge_partials, session_partials
from playbeat.schema import HEARTBEAT_NARROW, SESSION_METRICS

LONG_MIN, LONG_MAX = -(2**63), 2**63 - 1

EDGES = {
    "single": [beat()],
    "agent_backwards": [beat(T0, T0 + 90_000), beat(T0 + 60_000, T0)],
    "agent_missing_or_zero": [beat(T0, None), beat(T0 + 30_000, 0), beat(T0 + 60_000, T0 + 59_000)],
    "no_times": [("c", "w", "v", None, (1, 5), None, None, DAY)],
    "null_times": [beat(None, None)],
    "server_missing_on_one": [beat(None, T0 + 5), beat(T0, T0 + 7)],
    "ratio_capped": [beat(n=1, ms=90_000)],
    "no_buffering": [beat(n=None, ms=None), beat(T0 + 30_000, T0 + 30_000)],
    "no_player": [("c", "w", "v", (T0, T0), None, None, None, DAY)],
    "map_null_and_empty": [beat(), beat(T0 + 1, T0 + 1, quality={}), beat(T0 + 2, T0 + 2, quality={"720p": 9})],
    "no_quality": [beat(), beat(T0 + 1, T0 + 1)],
    "tie": [beat(quality={"360p": 8, "270p": 8})],
    "zero_bytes": [beat(quality={"720p": 0})],
    "null_traffic": [beat(src=None, p2p=None, quality={"720p": None, "360p": 3})],
    "null_keys": [
        beat(customer=None, content=None, quality={"720p": 5}), beat(T0 + 9, T0 + 9, customer="", content="")
    ],
    "null_date": [beat(T0 + 86_400_000, T0, day=None)],
    "midnight": [beat(), beat(T0 + 86_400_000, T0 + 86_400_000, day=dt.date(2024, 1, 2))],
    "rare_labels": [beat(quality={"unknown": 4, "level_3": 5, "1080p": 1})],
    "same_server_time": [beat(T0, T0 + 9), beat(T0, T0 + 3), beat(T0, T0 + 5, day=dt.date(2023, 12, 31))],
    "agent_far_away": [beat(T0, 17), beat(T0, T0), beat(T0 + 5, T0 * 3), beat(T0 + 5, T0)],
    "server_out_of_range": [beat(-5, T0), beat(1 << 50, T0 + 70_000), beat(T0, T0)],
    "agent_extremes": [beat(T0, 1 - (1 << 61)), beat(T0 + 5, 1 << 61)],
}


@pytest.mark.parametrize("name", list(EDGES))
def test_edge(spark, name):
    check_metrics(compute_metrics(frame(spark, EDGES[name])), EDGES[name])


def test_all_edges_together_and_as_partials(spark):
    rows = [(r[0], r[1], f"{r[2]}-{name}", *r[3:]) for name, rows in EDGES.items() for r in rows]
    df = frame(spark, rows)
    check_metrics(compute_metrics(df.repartition(7)), rows)
    parts = [session_partials(frame(spark, rows[i::3])) for i in range(3)]
    check_metrics(finalize(merge_partials(*parts, by_date=False)), rows)


def random_rows(n, seed, hot=0.0):
    r = random.Random(seed)
    labels = ["1080p", "720p", "360p", "270p", "unknown", "level_2"]
    rows = []
    for _ in range(n):
        server = r.choice([None, T0 + 1_000 * r.randint(0, 40), T0 + r.randint(0, 10**7)])
        agent = r.choice([None, 0, T0 + r.randint(0, 10**7), T0 + 1_000 * r.randint(0, 40), r.randint(1, 10**12)])
        quality = r.choice([None, {}, {x: r.choice([None, 0, r.randint(0, 99)]) for x in r.sample(labels, 3)}])
        client = "hot" if r.random() < hot else f"v{r.randint(0, 30)}"
        rows.append(beat(
            server, agent, r.choice([None, 0, 2]), r.choice([None, 0, 7_000]), r.choice([None, r.randint(0, 99)]),
            r.choice([None, 0, r.randint(0, 9)]), quality, r.choice([None, "", "c"]), r.choice([None, "w"]),
            client, r.choice([None, DAY, dt.date(2024, 1, 2)]),
        ))
    return rows


@pytest.mark.parametrize("partitions", [1, 5])
def test_random_rows_in_any_order(spark, partitions):
    rows = random_rows(1_500, 7, hot=0.4)
    df = frame(spark, rows).orderBy(F.rand(partitions)).repartition(partitions)
    check_metrics(compute_metrics(df), rows)
    check_metrics(compute_metrics(df, 10_000), rows, 10_000)


@pytest.mark.parametrize("labels", [(), ("720p",), ("unknown", "it's", "a\\b", "1080p")])
def test_expected_labels_change_the_plan_only(spark, labels):
    rows = random_rows(300, 5) + [beat(quality={"it's": 3, "a\\b": 2, "a b": 1})]
    check_metrics(compute_metrics(frame(spark, rows), labels=labels), rows)


def test_partials_merge_in_any_grouping(spark):
    rows = random_rows(600, 11)
    parts = [session_partials(frame(spark, rows[i::4])) for i in range(4)]
    once = merge_partials(*parts)
    nested = merge_partials(merge_partials(parts[3], parts[1]), merge_partials(parts[0], parts[2]))
    for merged in (once, nested):
        check_metrics(finalize(merge_partials(merged, by_date=False)), rows)
    by_date = compute_metrics(frame(spark, rows), by_date=True)
    assert sorted(map(str, finalize(nested).collect())) == sorted(map(str, by_date.collect()))


def test_by_date_splits_at_midnight(spark):
    df = frame(spark, EDGES["midnight"])
    assert compute_metrics(df).count() == 1
    assert compute_metrics(df, by_date=True).count() == 2


def test_absurd_agent_clocks_do_not_fail_the_job(spark):
    df = frame(spark, [beat(T0, LONG_MIN), beat(T0 + 1, LONG_MAX), beat(client="ok")])
    watch = {r.client_id: r.watch_time_ms for r in compute_metrics(df).collect()}
    assert watch == {"v": LONG_MAX, "ok": 30_000}


def test_schema(spark):
    got = compute_metrics(frame(spark, [beat()])).schema
    assert [(f.name, f.dataType.simpleString()) for f in got] == [
        (f.name, f.dataType.simpleString()) for f in SESSION_METRICS
    ]


def test_min_snapshots(spark):
    df = frame(spark, [beat(), beat(client="two"), beat(T0 + 1, T0 + 1, client="two")])
    assert [r.client_id for r in compute_metrics(df, min_snapshots=2).collect()] == ["two"]


def test_empty_input(spark):
    out = compute_metrics(frame(spark, []))
    assert out.isEmpty() and len(out.columns) == 17


def test_out_of_range_sessions_are_set_aside(spark):
    df = frame(spark, [beat(client="ok"), beat(src=10, p2p=-3, client="p2p"), beat(n=1, ms=-5, client="ms")])
    valid, rejected = process_all(df)
    assert [r.client_id for r in valid.collect()] == ["ok"]
    assert {r.client_id: r.reasons for r in rejected.collect()} == {
        "p2p": ["p2p_ratio_out_of_range"], "ms": ["buffering_ratio_negative"],
    }


def test_duplicates(spark):
    df = frame(spark, [beat(n=1, ms=5), beat(n=1, ms=5), beat(T0 + 1, T0 + 1)])
    assert compute_metrics(df).first().snapshot_count == 3
    assert compute_metrics(dedup_heartbeats(df)).first().snapshot_count == 2


def test_copies_are_cut_before_the_shuffle(spark):
    plan = dedup_heartbeats(frame(spark, [beat()]))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_flat_form_has_all_labels(spark):
    df = frame(spark, [beat(quality={"unknown": 4, "720p": 12}, client="a"), beat(quality={"level_3": 1}, client="b")])
    flat = flatten_metrics(compute_metrics(df))
    assert flat.columns[16:] == [
        f"quality_{kind}_{label}" for kind in ("bytes", "pct") for label in ("720p", "level_3", "unknown")
    ]
    a, b = flat.orderBy("client_id").collect()
    assert (a.quality_bytes_unknown, a.quality_pct_720p, a.quality_bytes_level_3) == (4, 75.0, 0)
    assert (b.quality_bytes_level_3, b.quality_pct_level_3, b.quality_pct_unknown) == (1, 100.0, 0.0)


def test_summaries(spark):
    df = frame(spark, [beat(n=1, ms=15_000, src=3, p2p=1, quality={"720p": 1}, client="a"), beat(client="b")])
    m = compute_metrics(df)
    assert fleet_summary(m).first().asDict() == {
        "viewers": 2, "viewers_with_buffering": 1, "buffering_viewers_pct": 50.0, "avg_buffering_ratio": 0.25,
    }
    assert tuple(fleet_summary_pct(m).first()) == (2, 25.0, 12.5)
    assert [tuple(r) for r in dominant_distribution(m).collect()] == [("720p", 1)]
    assert dominant_distribution(m, include_missing=True).count() == 2


def test_breakdown_invariants(spark):
    m = compute_metrics(frame(spark, random_rows(800, 3)))
    rows = m.collect()
    assert rows
    for r in rows:
        sizes = [q.received_bytes for q in r.quality_breakdown]
        assert sizes == sorted(sizes, reverse=True)
        assert r.dominant_quality == (r.quality_breakdown[0].quality_label if sizes else None)
        if sum(sizes):
            assert abs(sum(q.share_pct for q in r.quality_breakdown) - 100) <= 0.05


def test_map_view(spark):
    per_label = quality.quality_bytes(frame(spark, [beat(quality={"720p": 3, "360p": 1})]))
    view = quality.quality_map(per_label).first().quality_breakdown
    assert {k: tuple(v) for k, v in view.items()} == {"720p": (3, 75.0), "360p": (1, 25.0)}


def test_session_totals_hash_aggregate(spark):
    """No aggregate of the buffering half may fall back to sorting its input."""
    from playbeat.operators.sessions import buffering_metrics

    plan = buffering_metrics(frame(spark, [beat()]))._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_dedup_without_server_time(spark):
    rows = [beat(None, T0), beat(None, T0), beat(None, T0 + 1), beat(None, None), beat(None, None), beat(T0, 1), beat(T0, 2), beat(0, 5), beat(0, 6)]
    got = dedup_heartbeats(frame(spark, rows)).collect()
    assert len(got) == 6 and sorted(r.timestampInfo.agent for r in got if r.timestampInfo.server is not None) == [1, 5]


def test_windows_keep_customers_apart(spark):
    rows = [beat(customer="one", src=3), beat(customer="two", src=5)]
    got = {r.customerId: r.received_bytes for r in window_metrics(frame(spark, rows)).collect()}
    assert got == {"one": 3, "two": 5}


def test_extreme_clocks_keep_their_order(spark):
    rng = random.Random(11)
    times = [0, 1, 5, 6, T0, 2**42, 2**42 + 1, -3, 8 * 10**17, -8 * 10**17]
    agents = [LONG_MIN, LONG_MAX, -9 * 10**18, 9 * 10**18, 0, T0, T0 + 2**20, T0 - 2**21]
    for _ in range(6):
        rows = [beat(rng.choice(times), rng.choice(agents) or None) for _ in range(12)]
        pairs = [(s, a if a else s) for (s, a) in (r[3] for r in rows)]
        got = buffering_metrics(frame(spark, rows)).first()
        assert (got.first_agent_ms, got.last_agent_ms) == (min(pairs)[1], max(pairs)[1])


def scans(df):
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan")


def test_session_metrics_scan_the_table_once(spark, tmp_path):
    frame(spark, [beat(quality={"1080p": 3, "8k": 1})]).write.parquet(str(tmp_path / "beats"))
    beats = spark.read.schema(HEARTBEAT_NARROW).parquet(str(tmp_path / "beats"))
    assert scans(compute_metrics(beats)) == scans(session_partials(beats)) == 1
    partials = session_partials(beats)
    partials.write.parquet(str(tmp_path / "partials"))
    assert scans(merge_partials(spark.read.schema(PARTIAL).parquet(str(tmp_path / "partials")))) == 1


@pytest.mark.parametrize("labels", [[], ["240p"], ["1080p", "720p"], ["it's", "a\\b", "1080p", "270p", "360p", "720p"]])
def test_unexpected_labels_do_not_change_the_result(spark, labels):
    rng = random.Random(5)
    ladder = ["2160p", "1440p", "1080p", "720p", "540p", "480p", "it's", "a\\b", ""]
    rows = [beat(T0 + i * 30_000, client=f"v{i % 7}", quality={x: rng.randint(0, 9) for x in rng.sample(ladder, rng.randint(0, 5))}) for i in range(80)]
    rows += [beat(client="none"), beat(client="empty", quality={})]
    got = sorted(map(str, compute_metrics(frame(spark, rows), labels=labels).collect()))
    assert got == sorted(map(str, compute_metrics(frame(spark, rows)).collect()))
    check_metrics(compute_metrics(frame(spark, rows), labels=labels), rows)


def test_an_overflow_sets_one_session_aside(spark):
    huge = 2**62
    rows = [beat(client="ok", src=5, quality={"1080p": 5})]
    rows += [beat(client="bytes", src=huge), beat(client="bytes", src=huge)]
    rows += [beat(client="row", src=huge, p2p=huge)]
    rows += [beat(client="label", quality={"1080p": huge}), beat(client="label", quality={"1080p": huge})]
    rows += [beat(client="other", quality={"8k": huge}), beat(client="other", quality={"8k": huge})]
    rows += [beat(T0, -9 * 10**18, client="span"), beat(T0 + 1, 9 * 10**18, client="span")]
    valid, rejected = process_all(frame(spark, rows))
    assert [r.client_id for r in valid.collect()] == ["ok"]
    reasons = {r.client_id: r.reasons for r in rejected.collect()}
    assert set(reasons) == {"bytes", "row", "label", "other", "span"}
    assert reasons["span"] == ["watch_time_out_of_range"] and all("counter_overflow" in v for k, v in reasons.items() if k != "span")
    halves = [session_partials(frame(spark, rows[i::2])) for i in range(2)]
    merged = validate_metrics(finalize(merge_partials(*halves, by_date=False)))
    assert [r.client_id for r in merged[0].collect()] == ["ok"]
