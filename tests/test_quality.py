import random

import numpy as np
import pytest
from models import issues_of
from pyspark.sql import functions as F

from episodica.operators import nearest, ordering
from episodica.operators import quality as Q
from episodica.operators.ordering import materialised, row_position, scan
from episodica.operators.transitions import transitions

SCHEMA = "episode_index long, frame_index long, done boolean, index long"


def table(spark, episodes, steps, dones, index=None):
    index = index or range(len(episodes))
    return spark.createDataFrame(list(zip(episodes, steps, map(bool, dones), index)), SCHEMA)


def as_map(lists):
    out = {}
    for r in sorted(lists.collect(), key=lambda r: (r.episode_index, r.part)):
        out.setdefault(r.episode_index, []).extend(r.issues)
    return out


@pytest.mark.parametrize(
    "episodes,steps,dones,expected",
    [
        ([0, 0, 0, 1, 1], [0, 1, 2, 0, 1], [0, 0, 1, 0, 1], {}),
        ([0, 0, 1, 1], [0, 1, 0, 1], [0, 0, 0, 0], {0: "not terminated cleanly", 1: "not terminated cleanly"}),
        ([0, 0, 0], [0, 1, 2], [0, 1, 1], {0: "before the episode terminal step"}),
        ([0, 0, 0], [0, 2, 3], [0, 0, 1], {0: "not contiguous"}),
    ],
)
def test_literal_tables(spark, episodes, steps, dones, expected):
    found = as_map(Q.issue_lists(Q.source_issues(table(spark, episodes, steps, dones))))
    assert set(found) == set(expected)
    for e, text in expected.items():
        assert any(text in m for m in found[e])


def random_rows(rng, n):
    rows, episode = [], 0
    while len(rows) < n:
        episode = rng.choice([episode + 1, episode + 1, rng.randint(0, 4)])
        length, start = rng.choice([1, 2, 5, 40]), rng.choice([0, 0, 0, 3])
        for k in range(length):
            gap = rng.random() < 0.03
            rows.append((episode, start + k + (7 if gap else 0), k == length - 1 if rng.random() < 0.95 else rng.random() < 0.5))
    return rows[:n]


@pytest.mark.parametrize("seed", range(6))
def test_random_tables_match_the_model(spark, seed):
    rng = random.Random(seed)
    rows = random_rows(rng, rng.choice([1, 60, 300]))
    index, at = [], -50
    for _ in rows:
        at += rng.choice([1, 1, 1, 2, 90])
        index.append(at)
    data = [(e, s, d, i) for (e, s, d), i in zip(rows, index)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, SCHEMA).repartition(rng.randint(1, 5))
    bits, one_window = rng.choice([((2, 3, 20), 4), ((5, 2, 20), 2), ((16, 20, 20), 1000)])
    issues = Q.source_issues(df, bits=bits, one_window=one_window)
    assert as_map(Q.issue_lists(issues, part_size=3, bits=bits)) == issues_of(rows)


def test_one_hot_episode_and_interleaved_episodes(spark):
    long = [(0, k, k == 899) for k in range(900)]
    mixed = [(1 + k % 2, k // 2, False) for k in range(200)]
    rows = long + mixed
    df = table(spark, *zip(*rows))
    issues = Q.source_issues(df, bits=(4, 3, 20), one_window=8)
    assert as_map(Q.issue_lists(issues, part_size=10, bits=(4, 20))) == issues_of(rows)


def test_parts_hold_every_message_in_order(spark):
    rows = [(k % 2, 5, False) for k in range(50)]
    lists = Q.issue_lists(Q.source_issues(table(spark, *zip(*rows))), part_size=7)
    assert lists.select(F.max(F.size("issues"))).first()[0] == 7
    assert as_map(lists) == issues_of(rows)


def test_groups_are_independent_and_switches_work(spark):
    df = table(spark, [0, 0, 1], [0, 1, 4], [0, 0, 1]).withColumn("split", F.lit("a"))
    both = df.unionByName(df.withColumn("split", F.lit("b")))
    issues = Q.source_issues(both, ["split"]).groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in issues} == {"a": 2, "b": 2}
    off = Q.source_issues(df, require_terminal_done=False, require_no_early_done=False, require_contiguous_steps=False)
    assert off.isEmpty()


def test_empty_input(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert Q.issue_lists(Q.source_issues(empty)).isEmpty()
    assert row_position(empty).isEmpty()


def test_policies(spark):
    df = table(spark, [0, 0, 1, 1], [0, 1, 0, 1], [0, 1, 0, 0])
    issues = Q.source_issues(df)
    assert Q.apply_policy(df, issues, "warn").count() == 4
    assert {r.episode_index for r in Q.apply_policy(df, issues, "drop").collect()} == {0}
    with pytest.raises(Q.DirtyEpisodes):
        Q.apply_policy(df, issues, "fail")
    with pytest.raises(ValueError):
        Q.apply_policy(df, issues, "ignore")
    clean = df.where("episode_index = 0")
    assert Q.apply_policy(clean, Q.source_issues(clean), "fail").count() == 2


@pytest.mark.parametrize("bits,one_window", [((2, 2, 20), 3), ((3, 20, 20), 10**6), ((16, 20, 20), 10**6)])
def test_scan_matches_a_plain_window(spark, bits, one_window):
    rng = random.Random(5)
    keys = rng.sample(range(-500, 3000), 400)
    data = [(g, k, rng.randint(-5, 9)) for k in keys for g in ("a", "b")]
    df = spark.createDataFrame(data, "g string, k long, v long")
    got = scan(
        df, "k", ["g"], position="pos", sums={"total": F.col("v")}, lags={"last": F.col("v")}, maxima={"top": F.col("v")},
        bits=bits, one_window=one_window,
    )
    want = []
    for g in ("a", "b"):
        seen = []
        for _, k, v in sorted(r for r in data if r[0] == g):
            want.append((g, k, v, sum(seen), len(seen), seen[-1] if seen else None, max(seen, default=None)))
            seen.append(v)
    cols = ["g", "k", "v", "total", "pos", "last", "top"]
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(want)


def issues_in_order(rows):
    """rows: (index, episode, step, done) in any order."""
    return issues_of([(e, s, d) for _, e, s, d in sorted(rows)])


@pytest.mark.parametrize("seed", range(3))
def test_repeated_index(spark, seed):
    """One total order by (index, episode, frame), whatever the partitioning and however often a value repeats."""
    rng = random.Random(40 + seed)
    rows = {(rng.choice([5, 5, 5, rng.randint(0, 200)]), rng.randint(0, 3), rng.randint(0, 60)) for _ in range(300)}
    rows = [(i, e, s, rng.random() < 0.2) for i, e, s in rows]
    rng.shuffle(rows)
    df = spark.createDataFrame([(e, s, d, i) for i, e, s, d in rows], SCHEMA).repartition(rng.randint(1, 5))
    for bits, crowd in (((2, 3, 20), 1), ((16, 20, 20), 20), ((4, 20, 20), 100)):
        got = {(r["index"], r.episode_index, r.frame_index): r.row for r in row_position(df, bits=bits, crowd=crowd).collect()}
        assert got == {k[:3]: n for n, k in enumerate(sorted(rows))}
        issues = Q.source_issues(df, bits=bits, one_window=5, crowd=crowd)
        assert as_map(Q.issue_lists(issues, part_size=4, bits=bits, crowd=crowd)) == issues_in_order(rows)


def test_crowded_ranges_are_cut(spark):
    """Rows that all share one value are many ranges, also when the list of crowded ranges is not sent along."""
    data = [(e, s, False, 7) for e in range(40) for s in range(25)] + [(50, s, False, 7) for s in range(1000)]
    df = spark.createDataFrame(data, SCHEMA)
    for listed in (100_000, 0):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(ordering, "LISTED_RANGES", listed)
            rows, _, _ = ordering.ranges_of(df, ordering.STEP_ORDER, [], [], "rng", 4, crowd=64)
            sizes = rows.groupBy("rng").count()
            assert sizes.agg(F.max("count")).first()[0] <= 16 * 25 and sizes.where("rng.cut_4 > 0").count() >= 1000 // 16 - 1
            assert row_position(df, bits=(4, 20, 20), crowd=64).where("row = 40 * 25 + frame_index and episode_index = 50").count() == 1000


def test_a_tie_raises(spark):
    df = spark.createDataFrame([(0, 0, False, 3), (0, 1, True, 3), (0, 1, False, 3)], SCHEMA)
    for job in (row_position(df), row_position(df.where("frame_index = 1"), "index")):
        with pytest.raises(Exception, match="their order is not defined"):
            job.collect()
    with pytest.raises(Exception, match="their order is not defined"):
        Q.runs(df).collect()


def test_messages_of_a_hot_episode(spark):
    """One episode holds nine tenths of all runs: its messages are ranges, and its ranges are ranges again."""
    rows = [r for k in range(300) for r in ((0, 5, False), (1 + k % 7, 0, True))] + [(9, 0, True)] * 30
    df = table(spark, *zip(*rows))
    issues, _ = materialised(Q.source_issues(df, bits=(3, 20, 20)))
    hot = issues.where("episode_index = 0")
    assert hot.count() > 0.5 * issues.count()
    spans = ordering.ranged(hot, ["run_start"], [], "rng", 3).groupBy("rng").count()
    assert spans.agg(F.max("count")).first()[0] <= 8 * 4 and spans.count() > 50
    lists = Q.issue_lists(issues, part_size=6, bits=(3, 2, 20), one_window=4)
    assert as_map(lists) == issues_of(rows)


def test_transitions(spark):
    rng = random.Random(3)
    data = []
    for e, n in ((0, 1), (1, 700), (2, 40), (3, 2)):
        frames = sorted(rng.sample(range(2 * n), n))
        data += [(e, f, [float(f)] * 2 if f % 5 else None, [float(k)], k) for k, f in enumerate(frames)]
    df = spark.createDataFrame(rng.sample(data, len(data)), "episode_index long, frame_index long, state array<double>, action array<double>, k long")
    want = [(*a[:2], a[2], a[3], b[1], b[2]) for a, b in zip(data, data[1:]) if a[0] == b[0]]
    for bits, one_window in (((1, 2, 20), 3), ((16, 20, 20), 10**6)):
        got = transitions(df, bits=bits, one_window=one_window).collect()
        assert sorted(map(tuple, got), key=lambda r: r[:2]) == want
    again = df.union(df.where("episode_index = 3"))
    with pytest.raises(Exception, match="their order is not defined"):
        transitions(again).collect()


def test_goal_topk(spark, monkeypatch):
    rng = np.random.default_rng(4)
    vectors = rng.integers(-3, 4, (400, 5)).astype(float)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)] + [(500, None), (501, [0.0]), (502, [0.0, None, 0.0, 0.0, 0.0]), (None, [0.0] * 5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(7)
    goals = spark.createDataFrame([(g, vectors[g].tolist()) for g in range(0, 60, 3)] + [(900, [0.0, 1.0]), (901, None)], "goal_id long, goal array<double>")
    for block, k in ((1024, 7), (4, 1), (1024, 1000)):
        monkeypatch.setattr(nearest, "GOALS", block)
        got = [tuple(r) for r in nearest.goal_topk(df, goals, k).orderBy("goal_id", "rank").collect()]
        want = []
        for g in range(0, 60, 3):
            order = sorted((((v - vectors[g]) ** 2).sum(), i) for i, v in enumerate(vectors))[:k]
            want += [(g, n + 1, i, d) for n, (d, i) in enumerate(order)]
        assert got == want
    assert nearest.goal_topk(df.limit(0), goals, 3).isEmpty() and nearest.goal_topk(df, goals.limit(0), 3).isEmpty()
    with pytest.raises(ValueError):
        nearest.goal_topk(df, goals, 0)
