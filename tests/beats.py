"""Hand-made heartbeats and player events, and plain-Python results to compare with."""

from __future__ import annotations

import datetime as dt
from collections import defaultdict

from playbeat.schema import HEARTBEAT, PLAYER_EVENT

DAY = dt.date(2024, 1, 1)
T0 = 1_704_067_200_000


def traffic(received):
    return None if received is None else (1, 1.0, received, received)


def beat(
    server=T0, agent=T0, n=0, ms=0, src=0, p2p=0, quality=None, customer="c", content="w", client="v", day=DAY
):
    q = None if quality is None else {k: (traffic(b), None) for k, b in quality.items()}
    return (
        customer, content, client, (server, agent), (n, ms), (traffic(src), traffic(p2p)), q, day,
    )


def frame(spark, rows):
    return spark.createDataFrame(rows, HEARTBEAT)


def events_frame(spark, rows, client="v"):
    """Rows of (t, event, height, level, bytes)."""
    full = [
        ("c", "w", client, t, i, event, height, level, size, size, i)
        for i, (t, event, height, level, size) in enumerate(rows)
    ]
    return spark.createDataFrame(full, PLAYER_EVENT)


def expected_metrics(rows, interval=30_000):
    """Session metrics of heartbeat tuples by a loop over sorted rows."""
    sessions = defaultdict(list)
    for r in rows:
        sessions[tuple(k or "" for k in r[:3])].append(r)
    out = {}
    for key, beats in sessions.items():
        times = []
        for r in beats:
            server, agent = r[3] if r[3] else (None, None)
            server0 = server or 0
            times.append((server0, agent or server0))
        days = []
        for r, (server, _) in zip(beats, times):
            days.append((server, r[7] or dt.date(1970, 1, 1) + dt.timedelta(days=server // 86_400_000)))
        watch = max(max(times)[1] - min(times)[1] + interval, interval)
        events = sum((r[4] or (0, 0))[0] or 0 for r in beats)
        ms = sum((r[4] or (0, 0))[1] or 0 for r in beats)
        labels = defaultdict(int)
        total = p2p = 0
        for r in beats:
            for label, (s, p) in (r[6] or {}).items():
                labels[label] += (s[3] if s else 0) + (p[3] if p else 0)
            if r[5]:
                s, p = (x[3] if x else 0 for x in r[5])
                total, p2p = total + s + p, p2p + p
        bytes_ = sum(labels.values())
        breakdown = [
            (label, b, (b / bytes_ * 100) if bytes_ > 0 else 0.0)
            for label, b in sorted(labels.items(), key=lambda x: (-x[1], x[0]))
        ]
        out[key] = dict(
            event_date=min(days)[1], session_start_ms=min(times)[0], session_end_ms=max(times)[0],
            watch_time_ms=watch, snapshot_count=len(beats), total_buffering_events=events,
            total_buffering_time_ms=ms, buffering_ratio=min(1.0, ms / watch),
            avg_buffering_duration_ms=ms / events if events > 0 else None,
            dominant_quality=breakdown[0][0] if breakdown else None, breakdown=breakdown,
            total_received_bytes=total, p2p_received_bytes=p2p, p2p_ratio=p2p / total if total > 0 else 0.0,
        )
    return out


def check_metrics(df, rows, interval=30_000):
    """Every session of the DataFrame equals the loop's result."""
    want = expected_metrics(rows, interval)
    got = {(r.customer_id, r.content_id, r.client_id): r for r in df.collect()}
    assert set(got) == set(want) and df.count() == len(want)
    for key, w in want.items():
        g = got[key].asDict()
        for name, value in w.items():
            if name != "breakdown":
                assert g[name] == value, (key, name, g[name], value)
        entries = [(q.quality_label, q.received_bytes) for q in g["quality_breakdown"]]
        assert entries == [(a, b) for a, b, _ in w["breakdown"]]
        for q, (_, _, share) in zip(g["quality_breakdown"], w["breakdown"]):
            assert abs(q.share_pct - share) <= 0.00501


def expected_heartbeats(rows, interval=30_000, start=None):
    """Windows of one viewer's (t, event, height, level, bytes) events by a loop: {win: (n, ms, labels)}."""
    ordered = sorted(enumerate(rows), key=lambda x: (x[1][0], x[0]))
    first = ordered[0][1][0] if start is None else start
    out = {}
    for _, (t, event, height, level, size) in ordered:
        win = (t - first) // interval
        w = out.setdefault(win, {"n": 0, "ms": 0, "open": None, "label": None, "labels": defaultdict(lambda: [0, 0])})
        if event in ("waiting", "stalled") and w["open"] is None:
            w["open"], w["n"] = t, w["n"] + 1
        elif event == "playing" and w["open"] is not None:
            w["ms"], w["open"] = w["ms"] + t - w["open"], None
        elif event == "level" and (height or level is not None):
            w["label"] = f"{height}p" if height else f"level_{level}"
        if event in ("frag", "frag_loading"):
            w["labels"][w["label"] or "unknown"][0] += 1
        if event in ("frag", "frag_loaded"):
            w["labels"][w["label"] or "unknown"][1] += size
    for win, w in out.items():
        if w["open"] is not None:
            w["ms"] += first + (win + 1) * interval - w["open"]
    return {win: (w["n"], w["ms"], {k: tuple(v) for k, v in w["labels"].items()}) for win, w in out.items()}
