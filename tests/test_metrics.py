import datetime as dt
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from threadlens.functions import fixed
from threadlens.operators import metrics

SCHEMA = "unit_id bigint, topic_id int, user string, chat_uuid string, week string, text_len_chars int, has_sql boolean"


def rows(seed=1, n=300):
    rng = random.Random(seed)
    return [
        (i, rng.choice([0, 0, 0, 1, 2, None]), f"u{rng.randrange(9)}", f"c{rng.randrange(20)}",
         f"2026-W{rng.randrange(1, 9):02d}", rng.randrange(5, 90), rng.random() < 0.3)
        for i in range(n)
    ]


def test_summary(spark):
    data = rows()
    groups = defaultdict(list)
    for r in data:
        groups[r[1]].append(r)
    got = metrics.topic_summary(spark.createDataFrame(data, SCHEMA)).collect()
    order = sorted(groups, key=lambda t: (-len(groups[t]), -1 if t is None else t))
    assert [r.topic_id for r in got] == order
    for r in got:
        g = groups[r.topic_id]
        assert (r.n_units, r.n_users, r.n_chats) == (len(g), len({x[2] for x in g}), len({x[3] for x in g}))
        assert r.share_of_total == pytest.approx(len(g) / len(data))
        assert r.avg_len_chars == pytest.approx(sum(x[5] for x in g) / len(g))
        assert r.has_sql_share == pytest.approx(sum(x[6] for x in g) / len(g))
        assert r.has_code_share == 0.0
    assert len(got[0]) == 19


def test_breakdown_is_a_projection(spark):
    table = metrics.domain_breakdown(metrics.topic_summary(spark.createDataFrame(rows(), SCHEMA)))
    assert table.columns == ["topic_id", *fixed.FLAG_SHARES.values()]
    assert [r.topic_id for r in table.collect()] == [None, 0, 1, 2]


def test_empty_input_gives_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert metrics.topic_summary(empty).count() == 0
    trends = metrics.topic_trends(empty)
    assert trends.count() == 0 and metrics.growth_scores(trends).count() == 0


def test_trends(spark):
    data = rows(2)
    want = Counter((r[4], r[1]) for r in data)
    got = metrics.topic_trends(spark.createDataFrame(data, SCHEMA)).collect()
    assert {(r.week, r.topic_id): r.n_units for r in got} == want
    key = [(r.week, -r.n_units, -1 if r.topic_id is None else r.topic_id) for r in got]
    assert key == sorted(key)


@pytest.mark.parametrize("periods", [1, 2, 4])
def test_growth(spark, periods):
    data = [("2026-W01", 0, 3), ("2026-W03", 0, 5), ("2026-W10", 0, 11), ("2025-W52", 1, 9), ("2026-W01", 1, 4), ("2026-W02", 2, 7)]
    got = metrics.growth_scores(spark.createDataFrame(data, "week string, topic_id int, n_units bigint"), periods).collect()
    scores = {}
    for topic in (0, 1, 2):
        values = [n for _, t, n in sorted(data) if t == topic][-periods:]
        deltas = [b - a for a, b in zip(values, values[1:])]
        scores[topic] = sum(deltas) / len(deltas) if deltas else 0.0
    assert {r.topic_id: r.growth_score for r in got} == scores
    assert [r.topic_id for r in got] == sorted(scores, key=lambda t: (-scores[t], t))


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_examples(spark, monkeypatch, limit):
    monkeypatch.setattr(metrics, "BROADCAST_BYTES", limit)
    rng = np.random.default_rng(3)
    data = [(i, int(rng.integers(0, 3)), [float(x) for x in rng.normal(size=5)]) for i in range(60)]
    vectors = spark.createDataFrame(data, "unit_id bigint, topic_id int, embedding array<float>")
    units = spark.createDataFrame(
        [(i, f"c{i}", f"u{i}", dt.datetime(2026, 1, 5, 10, 0, i), f"text {i}") for i in range(60)],
        "unit_id bigint, chat_uuid string, user string, timestamp timestamp_ntz, text string",
    )
    got = metrics.representative_examples(units, vectors, 4).collect()
    for topic in range(3):
        members = {i: np.array(v) for i, t, v in data if t == topic}
        middle = np.mean(list(members.values()), axis=0)
        score = {i: v @ middle / np.linalg.norm(v) / np.linalg.norm(middle) for i, v in members.items()}
        shown = [r for r in got if r.topic_id == topic]
        assert [r.unit_id for r in shown] == sorted(score, key=score.get, reverse=True)[:4]
        assert [r.example_rank for r in shown] == [1, 2, 3, 4]
        assert shown[0].timestamp == f"2026-01-05 10:00:{shown[0].unit_id:02d}" and shown[0].text == f"text {shown[0].unit_id}"
