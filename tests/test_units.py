import datetime as dt
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from threadlens.functions import fixed
from threadlens.operators import messages, units
from threadlens.options import MessageOptions, UnitOptions

START = dt.datetime(2026, 1, 5)
SCHEMA = "source_row_id bigint, timestamp timestamp_ntz, user string, chat_uuid string, chat_title string, role string, message string"


def chat(spark, rows):
    """rows: (id, minute, user, chat, role, message)"""
    data = [(i, START + dt.timedelta(minutes=m), u, c, f"title {c}", r, t) for i, m, u, c, r, t in rows]
    return spark.createDataFrame(data, SCHEMA)


def random_chat(seed, n, chats=3, users=2, span=600):
    rng = random.Random(seed)
    ids = rng.sample(range(n * 3), n)
    return [
        (i, rng.randint(0, span), f"u{rng.randrange(users)}", f"c{rng.randrange(chats)}", "user", f"message number {i}")
        for i in ids
    ]


def walk(rows, gap, cap):
    """Units as lists of ids, one message after the other."""
    found, groups = [], {}
    for row in sorted(rows, key=lambda r: (r[1], r[0])):
        unit = groups.get((row[3], row[2]))
        if unit is None or row[1] - unit[-1][1] > gap or len(unit) == cap:
            unit = []
            found.append(unit)
            groups[row[3], row[2]] = unit
        unit.append(row)
    return sorted([r[0] for r in unit] for unit in found)


@pytest.mark.parametrize(("gap", "cap"), [(5, 2), (15, 3), (0, 1), (200, 4), (2, 100)])
@pytest.mark.parametrize("hot", [10**9, 0, 25])
def test_merging_equals_a_sequential_walk(spark, gap, cap, hot):
    rows = random_chat(gap * 7 + cap, 160)
    options = UnitOptions(max_gap_minutes=gap, max_messages=cap, hot_group_rows=hot, slice_rows=9)
    built = units.build_units(chat(spark, rows), MessageOptions(min_chars=1), options)
    assert sorted(r.source_row_ids for r in built.select("source_row_ids").collect()) == walk(rows, gap, cap)


def test_one_session_over_many_slices(spark):
    """One user writes every minute: no gap anywhere, so positions carry through all slices."""
    rows = [(i, i, "u", "c", "user", f"message number {i}") for i in range(100)]
    options = UnitOptions(max_gap_minutes=5, max_messages=7, hot_group_rows=10, slice_rows=6)
    built = units.build_units(chat(spark, rows), MessageOptions(min_chars=1), options)
    got = sorted(r.source_row_ids for r in built.select("source_row_ids").collect())
    assert got == [list(range(i, min(i + 7, 100))) for i in range(0, 100, 7)]


@pytest.mark.parametrize("filled", [10, 100, 1000])
def test_many_small_slices_in_few_tasks(spark, monkeypatch, filled):
    monkeypatch.setattr(units, "TASK_ROWS", filled)
    rows = spark.range(400).selectExpr("id", "id % 3 AS g", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, CAST(id + id DIV 50 * 30 AS INT)) AS t")
    limits = (["g"], "t", "id", 20, 7)
    wanted = sorted(units.segment(rows, *limits).collect())
    # More slices than cores, so that a task has many of them.
    cores = spark.sparkContext.defaultParallelism
    slices = 9 * cores
    assert units.slice_tasks(slices, 400, 0, cores) == min(slices, max(cores, -(-400 // filled)))
    assert sorted(units.segment_sliced(rows, *limits, slices, 400).collect()) == wanted
    assert sorted(units.segment_sliced(rows, *limits, slices).collect()) == wanted


def test_all_messages_at_the_same_moment(spark):
    rows = [(i, 0, "u", "c", "user", f"message number {i}") for i in range(50)]
    options = UnitOptions(max_gap_minutes=0, max_messages=4, hot_group_rows=10, slice_rows=5)
    built = units.build_units(chat(spark, rows), MessageOptions(min_chars=1), options)
    got = sorted(r.source_row_ids for r in built.select("source_row_ids").collect())
    assert got == [list(range(i, min(i + 4, 50))) for i in range(0, 50, 4)]


def test_unit_columns(spark):
    rows = [
        (0, 0, "u", "c", "user", "join a where b"),
        (1, 10, "u", "c", "user", "excel  файл"),
        (2, 10 + 16, "u", "c", "user", "later message"),
    ]
    table = units.publish_units(units.build_units(chat(spark, rows), MessageOptions(min_chars=1)))
    assert len(table.columns) == 28
    first, second = table.orderBy("start_ts").collect()
    assert first.unit_id == "merged-" + hashlib.sha1(b"0|1").hexdigest()[:16]
    assert first.text == "join a where b\nexcel файл"
    assert first.modeling_text == "join where excel файл"
    assert (first.text_len_chars, first.text_len_words, first.modeling_len_tokens) == (25, 6, 4)
    assert (first.start_ts, first.end_ts) == (START, START + dt.timedelta(minutes=10))
    assert first.has_sql and first.has_excel_terms and not first.has_code and first.n_messages == 2
    assert (first.date, first.week, first.month) == ("2026-01-05", "2026-W02", "2026-01")
    assert second.n_messages == 1 and not second.has_sql


def test_message_mode_and_map(spark):
    rows = random_chat(3, 20)
    built = units.build_units(chat(spark, rows), MessageOptions(min_chars=1), UnitOptions(mode="message"))
    mapping = {r.unit_id: r.source_row_id for r in units.unit_message_map(built).collect()}
    assert mapping == {f"message-{r[0]:08d}": r[0] for r in rows}
    with pytest.raises(ValueError):
        units.build_units(chat(spark, rows), options=UnitOptions(mode="thread"))


def test_units_from_stored_messages_are_the_same(spark):
    source, options = chat(spark, random_chat(5, 120)), MessageOptions(min_chars=1)
    direct = units.build_units(source, options)
    stored = units.units_from_messages(messages.user_messages(source, options))
    assert direct.columns == stored.columns
    assert sorted(map(str, direct.collect())) == sorted(map(str, stored.collect()))


def test_map_covers_every_kept_message(spark):
    source, options = chat(spark, random_chat(8, 90)), MessageOptions(min_chars=1)
    mapped = units.unit_message_map(units.build_units(source, options, UnitOptions(hot_group_rows=20, slice_rows=10)))
    assert sorted(r.source_row_id for r in mapped.collect()) == sorted(
        r.source_row_id for r in messages.kept_messages(source, options).collect()
    )


# --- message cleaning -------------------------------------------------------------


def test_filters_and_duplicates(spark):
    rows = [
        (0, 0, "u", "c", "USER", "hello there"),
        (1, 0, "u", "c", "user", "hello \t there"),
        (2, 0, "u", "c", "user", "  \n "),
        (3, 0, "u", "c", "assistant", "hello there"),
        (4, 0, "u", "c", "user", "ОК"),
        (5, 0, "v", "c", "user", "hello there"),
        (6, 1, "u", "c", "user", "hello there"),
        (7, 2, "u", "c", "user", "hi"),
    ]
    options = MessageOptions(min_chars=2, trivial_messages=("ок", " Hi "))
    got = messages.user_messages(chat(spark, rows), options).orderBy("source_row_id").collect()
    assert [r.source_row_id for r in got] == [0, 5, 6]
    assert got[0].message_raw == "hello there" and got[0].message == "hello there"
    everything = messages.user_messages(
        chat(spark, rows), MessageOptions(min_chars=0, drop_trivial=False, deduplicate=False)
    )
    assert sorted(r.source_row_id for r in everything.collect()) == [0, 1, 4, 5, 6, 7]


def test_lowest_id_survives_in_a_group_of_many_copies(spark):
    rows = [(i, 0, "u", "c", "user", "copied again and again") for i in range(500, 0, -1)]
    kept = messages.kept_messages(chat(spark, rows).repartition(8), MessageOptions())
    assert [r.source_row_id for r in kept.collect()] == [1]


def test_trivial_table_equals_trivial_list(spark):
    df = spark.createDataFrame([("Да",), ("нет",), ("может",)], "message string")
    listed = messages.drop_trivial(df, ("да", " НЕТ"))
    table = messages.drop_trivial(df, spark.createDataFrame([("да",), (" НЕТ",)], "w string"))
    assert [r.message for r in listed.collect()] == [r.message for r in table.collect()] == ["может"]
    assert messages.drop_trivial(df, ()).count() == 3


@pytest.mark.parametrize("day", ["2026-12-31", "2027-01-01", "2024-12-30", "2021-01-03", "2020-12-31"])
def test_iso_weeks(spark, day):
    moment = dt.datetime.fromisoformat(day)
    df = spark.createDataFrame([(moment,)], "t timestamp_ntz")
    row = df.select(*[c.alias(n) for n, c in messages.calendar_features(F.col("t")).items()]).first()
    assert row.asDict() == {"date": day, "week": moment.strftime("%G-W%V"), "month": day[:7]}


def test_message_table_columns(spark):
    table = messages.user_messages(chat(spark, random_chat(1, 5)), MessageOptions(min_chars=1))
    assert table.columns == [
        "source_row_id", "timestamp", "user", "chat_uuid", "chat_title", "role", "message", "message_raw",
        "message_len_chars", "message_len_words", "message_for_modeling", "message_modeling_len_tokens", "date", "week",
        "month", *fixed.DOMAIN_FLAGS,
    ]
