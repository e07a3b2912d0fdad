import csv
import functools

import pytest
from sample import HEADER, ROWS

from threadlens.functions import fixed
from threadlens.functions.vectors import HashProvider
from threadlens.options import EnrichmentOptions, MessageOptions, ReportOptions, TopicOptions, UnitOptions
from threadlens.plans.topic_run import TopicRun
from threadlens.sources.tables import read_csv


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("export") / "chat.csv"
    with path.open("w", encoding="utf-8", newline="") as out:
        writer = csv.writer(out)
        writer.writerow(HEADER)
        writer.writerows(ROWS)
    return read_csv(spark, str(path))


def run(spark, folder, **topics):
    return TopicRun(
        spark,
        str(folder),
        messages=MessageOptions(min_chars=5, trivial_messages=("ok", "merci")),
        units=UnitOptions(max_gap_minutes=20),
        topics=TopicOptions(representative_examples=3, keyword_top_n=5, **topics),
        enrichment=EnrichmentOptions(max_examples_per_topic=3),
        report=ReportOptions(top_n_topics=10, top_n_examples=3, growth_periods=2),
        embed_factory=functools.partial(HashProvider, 32),
    )


@pytest.fixture(scope="module")
def done(spark, raw, tmp_path_factory):
    job = run(spark, tmp_path_factory.mktemp("run"))
    job.run(raw)
    return job


def test_messages_and_units(done):
    kept = [r.source_row_id for r in done.read("user_messages").orderBy("source_row_id").collect()]
    assert kept == [1, 2, 4, 7, 8, 9]  # no system, assistant, copied or trivial message
    units = {tuple(r.source_row_ids) for r in done.read("units").collect()}
    assert units == {(1, 4), (2,), (7,), (8,), (9,)}
    assert done.read("unit_message_map").count() == 6


def test_topics(done):
    by_row = {r.source_row_ids[0]: r.unit_id for r in done.read("units").collect()}
    topic = {r.unit_id: (r.topic_id, r.label) for r in done.read("assignments").collect()}
    labels = {row: topic[unit][1] for row, unit in by_row.items()}
    assert labels == {1: "jira", 2: "grafana", 7: "sql", 8: "excel", 9: "sql"}
    # labels are numbered by name
    assert {topic[unit] for unit in by_row.values()} == {(i, x) for i, x in enumerate(sorted(set(labels.values())))}
    summary = {r.topic_id: r for r in done.read("summary_base").collect()}
    assert {t: round(r.share_of_total, 9) for t, r in summary.items()} == {0: 0.2, 1: 0.2, 2: 0.2, 3: 0.4}
    assert summary[3].topic_keywords == "sql, branch, write, an, query"
    assert summary[2].has_error_terms_share == 1 and summary[3].has_sql_share == 1


def test_published_tables(done, spark):
    tables = {n: read_csv(spark, done.path(f"published/{n}")) for n in ("summary", "examples", "trends", "domain_breakdown")}
    assert tables["summary"].count() == 4 and "topic_title_llm" in tables["summary"].columns
    assert tables["examples"].columns == ["topic_id", "chat_uuid", "user", "timestamp", "text"]
    assert sorted((r.week, r.topic_id) for r in tables["trends"].collect()) == [*(("2026-W21", str(t)) for t in range(4)), ("2026-W22", "3")]
    assert len(tables["domain_breakdown"].columns) == 12
    assert spark.read.json(done.path("ingest_quality")).first().user_rows == 8


def test_report_text(done, spark):
    lines = [r.value for r in spark.read.text(done.path("published/report")).collect()]
    heads = [line for line in lines if line.startswith("#")]
    assert heads == [fixed.REPORT_TITLE, *(f"## {name}" for name in fixed.REPORT_SECTIONS)]
    assert lines[4] == "- Total input rows: 11"
    assert "- Analysis units: 5" in lines and "- Topics: 4" in lines
    assert "- Topic 3: Sql (units=2, users=1, keywords=sql, branch, write, an, query)" in lines
    assert "- Topic 2: Catalogue (error_share=100.00%)" in lines
    assert "- Excel: topic 0 (Now) with share 100.00%" in lines
    assert not any(line.startswith("- Jira: topic 3") for line in lines)
    assert "- Topic 1 | omar | 2026-05-18 22:12:00: Same here, the grafana dashboard is red" in lines


def test_run_log_counts_rows(done):
    log = {r.table: r.rows for r in done.read("run_log").collect()}
    assert (log["raw_normalized"], log["user_messages"], log["units"], log["summary"]) == (11, 6, 5, 4)


def test_a_stage_can_be_repeated_alone(done):
    before = done.read("summary_base").orderBy("topic_id").collect()
    done.embed()
    done.assign_topics()
    assert done.measure().orderBy("topic_id").collect() == before


@pytest.mark.parametrize("strategy", ["embeddings", "c-tf-idf"])
def test_density_backend(spark, raw, tmp_path, strategy):
    job = run(
        spark, tmp_path, backend="density", clustering="grid", components=2, cell_width=0.4, min_samples=1, min_cluster_size=2, nr_topics=2,
        reduce_outliers_strategy=strategy,
    )
    tables = job.run(raw)
    summary = tables["summary"].collect()
    assert sum(r.n_units for r in summary) == 5
    real = sorted(r.topic_id for r in summary if r.topic_id >= 0)
    assert real == list(range(len(real))) and len(real) <= 2
    assert all(r.topic_title_auto == "outliers" for r in summary if r.topic_id == -1)


def test_unknown_settings_are_refused(spark, raw, tmp_path):
    job = run(spark, tmp_path, backend="magic")
    job.ingest(raw)
    job.preprocess()
    job.build_units()
    job.embed()
    with pytest.raises(ValueError, match="magic"):
        job.assign_topics()


def test_rejects_and_stored_counters(spark, tmp_path):
    rows = [*ROWS[:3], ("some day", "nadia", "room-a", "Night shift", "user", "no time"), ("2026-05-18T22:30:00", "omar", " ", "x", "user", "no room")]
    raw = spark.createDataFrame([tuple(r) for r in rows], ", ".join(f"`{h}` string" for h in HEADER))
    job = run(spark, tmp_path)
    job.ingest(raw, on_error="quarantine")
    assert sorted(r.reason for r in job.read("ingest_rejects").collect()) == ["chat_uuid", "timestamp"]
    assert job.read("raw_normalized").count() == 3 and job._quality().first().total_rows == 3
    assert run(spark, tmp_path / "none")._quality() is None


def test_run_log_holds_numbers_of_the_texts(done):
    log = {r.table: r.rows for r in done.read("run_log").collect()}
    assert log["vector_width"] == 32 and log["sanitized_texts"] == 0 and log["truncated_texts"] == 0


def test_run_log_counts_topics(done):
    log = {r.table: r.rows for r in done.read("run_log").collect()}
    assert (log["topics"], log["outliers"]) == (4, 0)


class Killed(Exception):
    pass


def test_a_killed_run_resumes_behind_the_last_finished_stage(spark, raw, tmp_path, monkeypatch):
    job = run(spark, tmp_path)
    with monkeypatch.context() as m:
        m.setattr(TopicRun, "assign_topics", lambda self: (_ for _ in ()).throw(Killed))
        with pytest.raises(Killed):
            job.run(raw, resume=True)
    ran = []
    for name in ("ingest", "preprocess", "build_units", "embed", "assign_topics", "measure", "enrich"):
        monkeypatch.setattr(TopicRun, name, lambda self, *a, _name=name, _stage=getattr(TopicRun, name), **o: (ran.append(_name), _stage(self, *a, **o))[1])
    first = job.run(raw, resume=True)
    assert ran == ["assign_topics", "measure", "enrich"]
    before = sorted(map(str, first["summary"].collect()))
    ran.clear()
    again = job.run(raw.repartition(3), resume=True)
    assert ran == [] and sorted(map(str, again["summary"].collect())) == before
    replaced = TopicRun(spark, job.folder, job.messages, job.units, enrichment=EnrichmentOptions(max_examples_per_topic=2), topics=job.topics, report=job.report, embed_factory=job.embed_factory)
    replaced.run(raw, resume=True)
    assert ran == ["enrich"]
    ran.clear()
    job.run(raw.limit(9), resume=True)
    assert len(ran) == 7
    ran.clear()
    job.run(raw.limit(9))
    assert len(ran) == 7


def test_fingerprints_know_rows_and_not_their_order(spark):
    rows = [(1, "a"), (2, "b"), (2, "b"), (None, None)]
    from threadlens.plans.topic_run import table_fingerprint as f

    df = spark.createDataFrame(rows, "x int, `y.z` string")
    assert f(df) == f(df.orderBy("x").repartition(3)) != f(df.distinct())
    assert f(df) != f(spark.createDataFrame([(1, "b"), (2, "a"), (2, "b"), (None, None)], df.schema)) and f(df.limit(0)) == f(df.limit(0))
