"""Keyed streams: hot keys by parts, restarts, streams against their batch twins."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerline.streaming import keyed, logs


class Counting(dict):
    """A store that knows the most rows it ever gave back at once."""

    most = puts = 0

    def __setitem__(self, key, value):
        self.puts += 1
        super().__setitem__(key, value)


@pytest.mark.parametrize("order", ["shuffled", "sorted", "reversed", "ties"])
def test_a_key_of_a_million_rows_comes_in_order_by_bounded_parts(order):
    n, frame = 1_000_000, 10_000
    seq = np.arange(n)
    seq = np.random.default_rng(1).permutation(n) if order == "shuffled" else seq[::-1].copy() if order == "reversed" else seq // 50_000 if order == "ties" else seq
    store = Counting()
    frames = (pd.DataFrame({"seq": seq[i : i + frame], "x": [f"r{k}" for k in range(i, i + frame)]}) for i in range(0, n, frame))
    last, total, most = -1, 0, 0
    for part in keyed.in_order(frames, "seq", store, run=50_000, part=1_000):
        s = part["seq"].to_numpy()
        assert (np.diff(s) >= 0).all() and s[0] >= last
        last, total, most = s[-1], total + len(s), max(most, len(s))
    # 20 runs, of each at most a part and what is left of one.
    assert total == n and most <= 2 * 20 * 1_000 and not store and store.puts >= n // 1_000


def test_few_rows_never_reach_the_store():
    store = Counting()
    rows = pd.DataFrame({"seq": [3, 1, 2]})
    assert [list(p["seq"]) for p in keyed.in_order([rows], "seq", store)] == [[1, 2, 3]] and not store.puts
    assert not list(keyed.in_order([], "seq", store))


def log_of(n):
    """A log in which one key has all rows but a few."""
    rng = np.random.default_rng(7)
    kinds = np.array(["signup", "view", "click", "purchase", "error"])
    return pd.DataFrame({"user_id": np.where(np.arange(n) % 97 == 0, np.arange(n) % 13, 5), "event_id": rng.permutation(n), "event_type": kinds[rng.integers(0, 5, n)]})


ALLOWED = (("SEM_FLUXO", "signup"), ("signup", "view"), ("view", "click"), ("click", "purchase"), ("purchase", "view"), ("click", "error"), ("error", "view"))


def judged_by_hand(rows):
    out = {}
    for user, g in rows.sort_values("event_id").groupby("user_id"):
        state = "SEM_FLUXO"
        for e, k in zip(g["event_id"], g["event_type"]):
            ok = (state, k) in ALLOWED
            out[user, e] = (state, k, ok)
            state = k if ok else state
    return out


def test_states_go_on_after_a_restart_and_a_hot_key_is_taken_in_order(spark, tmp_path, monkeypatch):
    rows = log_of(60_000)
    early, late = rows[rows["event_id"] < 40_000], rows[rows["event_id"] >= 40_000]
    inbox, at = tmp_path / "in", str(tmp_path / "out")
    inbox.mkdir()
    early.to_parquet(inbox / "a.parquet")
    stream = lambda: logs.stream_states(logs.file_stream(spark, str(inbox), spark.read.parquet(str(inbox / "a.parquet")).schema, "*.parquet", 1), "user_id", "event_id", "de", "event_type", ALLOWED, "SEM_FLUXO")
    assert logs.run_to_table(stream(), "states", at=at).count() == len(early)
    # The run has ended; another begins where it was, with the state of each key.
    assert logs.run_to_table(stream(), "states", at=at).count() == len(early)
    late.to_parquet(inbox / "b.parquet")
    got = {(r.user_id, r.event_id): (r.state, r.wanted, r.accepted) for r in logs.run_to_table(stream(), "states", at=at).collect()}
    assert got == judged_by_hand(rows)


def test_deltas_and_caps_over_batches(spark, tmp_path):
    rows = log_of(6_000)
    rows["event_id"] += 10
    inbox = tmp_path / "in"
    inbox.mkdir()
    for k, (lo, hi) in enumerate(((0, 2000), (2000, 2001), (2001, 9000))):
        rows[(rows["event_id"] >= lo) & (rows["event_id"] < hi)].to_parquet(inbox / f"{k}.parquet")
    schema = spark.read.parquet(str(inbox / "0.parquet")).schema
    stream = lambda: logs.file_stream(spark, str(inbox), schema, "*.parquet", 1)
    deltas = {(r.user_id, r.event_id): (r.was, r.now) for r in logs.run_to_table(logs.stream_deltas(stream(), "user_id", "event_id", "event_type"), "d").collect()}
    want = {}
    for user, g in rows.sort_values("event_id").groupby("user_id"):
        was = None
        for e, k in zip(g["event_id"], g["event_type"]):
            if k != was:
                want[user, e] = (was, k)
            was = k
    assert deltas == want
    cap = {(r.user_id, r.event_id): (r.used_before, r.admitted) for r in logs.run_to_table(logs.stream_cap(stream(), "user_id", "event_id", F.col("event_type") == "error", 6), "c").collect()}
    errors = rows[rows["event_type"] == "error"].sort_values("event_id")
    nth = errors.groupby("user_id").cumcount()
    assert cap == {(u, e): (n, n < 6) for u, e, n in zip(errors["user_id"], errors["event_id"], nth)}


def test_stale_versions_by_two_streams_with_and_without_watermarks(spark, tmp_path):
    v = spark.createDataFrame([(1, 10, "2026-01-01 00:00:00"), (1, 11, "2026-01-03 00:00:00"), (2, 12, "2026-01-01 00:00:00"), (3, 13, "2026-01-01 00:00:00")], "k int, id int, t string").selectExpr("k", "id", "CAST(t AS TIMESTAMP) AS t")
    c = spark.createDataFrame([(1, "2026-01-02 00:00:00"), (1, "2026-01-02 12:00:00"), (2, "2026-01-01 00:00:00"), (3, "2026-03-01 00:00:00")], "k int, t string").selectExpr("k", "CAST(t AS TIMESTAMP) AS t")
    v.write.parquet(str(tmp_path / "v"))
    c.write.parquet(str(tmp_path / "c"))
    streams = lambda: (logs.file_stream(spark, str(tmp_path / "v"), v.schema, "*.parquet"), logs.file_stream(spark, str(tmp_path / "c"), c.schema, "*.parquet"))
    found = lambda **kw: sorted(r.id for r in logs.run_to_table(logs.stale_versions(*streams(), "k", "t", "t", "id", **kw), "s").collect())
    assert found() == [10, 13]
    # Within ten days only: the change of March comes too late to count.
    assert found(horizon="10 days", delay="1 day") == [10]
