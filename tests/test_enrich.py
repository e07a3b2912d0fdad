import json
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from threadlens.functions import fixed
from threadlens.operators import enrich
from threadlens.options import EnrichmentOptions

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FULL = {name: f"v{i}" for i, name in enumerate(fixed.ENRICHMENT_COLUMNS)}


def inputs(spark):
    summary = spark.createDataFrame(
        [(1, "sql", "sql, query", 5, 3, 2), (2, "sheets", "excel", 8, 4, 3), (-1, "outliers", "x", 1, 1, 1)],
        "topic_id int, topic_title_auto string, topic_keywords string, n_units bigint, n_users bigint, n_chats bigint",
    )
    examples = spark.createDataFrame(
        [(1, "second", 2), (1, "first", 1), (1, "third", 3), (-1, "lost", 1)], "topic_id int, text string, example_rank int"
    )
    return summary, examples


@pytest.mark.parametrize(
    ("value", "text"),
    [
        (None, None), ("  a b ", "a b"), (True, "True"), (1.5, "1.5"), (3, "3"), (["one", None, " ", ["x", "y"]], "one; x; y"),
        ({"b": 1, "a": "ж"}, '{"a": "ж", "b": 1}'), ([{"k": 1}, 2], '{"k": 1}; 2'),
    ],
)
def test_flatten(value, text):
    assert enrich.flatten(value) == text


def test_response_parsing(spark):
    body = json.dumps(FULL)
    replies = [
        body + "\n\nMore words {", "```json\n" + body + "\n```", "see {this} or " + body, '[1, {"topic_title": "T"}]', "no json", "{broken", None,
    ]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(replies)], "id int, response string")
    rows = enrich.parse_responses(df).orderBy("id").collect()
    for r in rows[:3]:
        assert r.parse_error is None and {c: r[c] for c in FULL} == FULL
    assert rows[3].topic_title == "T" and rows[3].confidence_note is None
    for r in rows[4:]:
        assert "no JSON object" in r.parse_error and r.topic_title is None
    assert "7 characters" in rows[4].parse_error


def test_mock_answers(spark):
    rows = {r.topic_id: r for r in enrich.enrich_topics(*inputs(spark)).collect()}
    assert rows[1].topic_title == "Sql" and "3 representative examples" in rows[1].suspected_business_value
    assert rows[2].topic_title == "Excel" and "0 representative" in rows[2].suspected_business_value
    assert all(rows[-1][c] is None for c in fixed.ENRICHMENT_COLUMNS)


def test_examples_are_limited_and_ordered(spark):
    requests = {r.topic_id: r for r in enrich.topic_requests(*inputs(spark), 2).collect()}
    assert requests.keys() == {1, 2} and requests[1].examples == ["first", "second"] and requests[2].examples == []
    body = json.loads(enrich.chat_request(enrich.topic_requests(*inputs(spark)), "m", 0.5).where("topic_id = 1").first().request)
    assert body["model"] == "m" and body["temperature"] == 0.5
    assert [m["role"] for m in body["messages"]] == ["system", "user"]
    assert all(name in body["messages"][0]["content"] for name in fixed.ENRICHMENT_COLUMNS)
    assert json.loads(body["messages"][1]["content"])["examples"] == ["first", "second", "third"]


def test_a_failing_topic_gets_placeholders(spark):
    def factory():
        def provider(payload):
            if payload["topic_id"] == 1:
                raise ValueError("synthetic failure")
            return json.dumps({**FULL, "suspected_jtbd": ["a", "b"], "suspected_business_value": {"level": "high"}})

        return provider

    rows = {r.topic_id: r for r in enrich.enrich_topics(*inputs(spark), factory).collect()}
    assert rows[1].topic_title == "sql" and "fallback" in rows[1].confidence_note
    assert "ValueError: synthetic failure" in rows[1].confidence_note
    assert rows[2].suspected_jtbd == "a; b" and rows[2].suspected_business_value == '{"level": "high"}'


def test_a_provider_is_called_once_without_a_cache(spark, tmp_path):
    calls = str(tmp_path / "calls")

    def factory():
        def provider(payload):
            with open(calls, "a", encoding="utf-8") as out:
                out.write("x")
            return FULL

        return provider

    found = enrich.enrich_topics(*inputs(spark), factory)
    assert found.count() == 3 and len(found.collect()) == 3 and len(open(calls, encoding="utf-8").read()) == 2


def test_deep_replies_and_title_case(spark):
    deep = '{"topic_title": ' + "[" * 100_000
    rows = enrich.parse_responses(spark.createDataFrame([(1, deep)], "id int, response string")).collect()
    assert rows[0].parse_error
    texts = ["sql query", "o'neil-x1y", "ÉCOLE", "", "4you"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(enrich.title_case(F.col("t")).alias("t")).collect()
    assert [r.t for r in got] == [t.title() for t in texts]


def test_disabled(spark):
    rows = enrich.enrich_topics(*inputs(spark), options=EnrichmentOptions(enabled=False)).collect()
    assert len(rows) == 3 and all(r[c] is None for r in rows for c in fixed.ENRICHMENT_COLUMNS)


def test_cache_keeps_answers_but_not_fallbacks(spark, tmp_path):
    calls, cache = str(tmp_path / "calls"), str(tmp_path / "cache")

    def factory(fail):
        def build():
            def provider(payload):
                with open(calls, "a", encoding="utf-8") as out:
                    out.write(f"{payload['topic_id']} ")
                if payload["topic_id"] == fail:
                    raise TimeoutError("later")
                return FULL

            return provider

        return build

    first = {r.topic_id: r for r in enrich.enrich_topics(*inputs(spark), factory(1), cache_path=cache).collect()}
    assert "TimeoutError" in first[1].confidence_note and first[2].topic_title == "v0"
    second = {r.topic_id: r for r in enrich.enrich_topics(*inputs(spark), factory(None), cache_path=cache).collect()}
    assert second[1].topic_title == second[2].topic_title == "v0" and len(second) == 3
    assert sorted(open(calls, encoding="utf-8").read().split()) == ["1", "1", "2"]
    enrich.enrich_topics(*inputs(spark), factory(None), EnrichmentOptions(model="other"), cache).count()
    assert len(open(calls, encoding="utf-8").read().split()) == 5
