import csv
import datetime as dt

import pytest
from pyspark.sql import functions as F
from sample import HEADER, ROWS

from threadlens.operators import ingest
from threadlens.sources.tables import read_csv, read_table, write_table


@pytest.fixture(scope="module")
def export(tmp_path_factory):
    path = tmp_path_factory.mktemp("export") / "chat.csv"
    with path.open("w", encoding="utf-8", newline="") as out:
        writer = csv.writer(out)
        writer.writerow(HEADER)
        writer.writerows(ROWS)
    return str(path)


def test_csv_export_becomes_the_canonical_table(spark, export):
    canonical = ingest.ingest(read_csv(spark, export))
    assert canonical.columns == ["source_row_id", "timestamp", "user", "chat_uuid", "chat_title", "role", "message"]
    rows = canonical.orderBy("source_row_id").collect()
    assert [r.source_row_id for r in rows] == list(range(11))
    assert [r.message for r in rows] == [r[5] for r in ROWS]
    report = ingest.quality_report(canonical).first().asDict()
    assert report == {
        "total_rows": 11, "user_rows": 8, "assistant_rows": 2, "empty_message_rows": 1, "unique_users": 2, "unique_chats": 2,
    }


def test_missing_columns_are_all_named(spark):
    df = spark.createDataFrame([("x", "y")], "role string, message string")
    with pytest.raises(ingest.IngestError, match="Время.*Чат"):
        ingest.project_columns(df)


def named(spark, rows):
    schema = "source_row_id bigint, timestamp string, user string, chat_uuid string, chat_title string, role string, message string"
    return ingest.normalise(spark.createDataFrame(rows, schema))


def test_unparsable_time_names_the_first_ten_rows(spark):
    rows = [(i, "soon" if i % 2 else "2026-01-01", "u", "" if i == 4 else "c", "", "user", "m") for i in range(40)]
    canonical = named(spark, rows)
    with pytest.raises(ingest.IngestError, match=r"timestamp.*\[1, 3, 5, 7, 9, 11, 13, 15, 17, 19\]"):
        ingest.validate(canonical)
    assert ingest.validate(canonical, "quarantine").count() == 19
    assert ingest.rejects(canonical).count() == 21


def test_empty_chat_is_rejected_after_trimming(spark):
    with pytest.raises(ingest.IngestError, match=r"chat_uuid in rows \[7\]"):
        ingest.validate(named(spark, [(7, "2026-01-01", "u", " \u00a0", "t", "user", "m")]))


def test_nulls_and_trimming(spark):
    row = named(spark, [(0, "2026-01-01", None, "\u2003c\t", " t ", " user ", None)]).first()
    assert (row.user, row.chat_uuid, row.chat_title, row.role, row.message) == ("", "c", " t ", "user", "")


def test_na_words_stay_text(spark, tmp_path):
    path = tmp_path / "na.csv"
    path.write_text('a,b\nNA,null\n"x\ny ""q""",\n', encoding="utf-8")
    rows = read_table(spark, str(path), "csv").collect()
    assert [tuple(r) for r in rows] == [("NA", "null"), ('x\ny "q"', None)]


def test_csv_encoding(spark, tmp_path):
    path = tmp_path / "old.csv"
    path.write_bytes("Чат,role\nПривет,user\n".encode("cp1251"))
    with pytest.raises(ValueError, match="javaCharsets"):
        read_csv(spark, str(path), "windows-1251")
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    try:
        assert read_csv(spark, str(path), "windows-1251").first()["Чат"] == "Привет"
    finally:
        spark.conf.unset("spark.sql.legacy.javaCharsets")


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2026-01-05 10:00:00", dt.datetime(2026, 1, 5, 10)),
        ("2026-01-05T10:00:00.250", dt.datetime(2026, 1, 5, 10, 0, 0, 250000)),
        ("2026-01-05", dt.datetime(2026, 1, 5)),
        (" 01/05/2026 7:08 ", dt.datetime(2026, 1, 5, 7, 8)),
        ("25.12.2025", dt.datetime(2025, 12, 25)),
        ("05.01.2026 10:00", dt.datetime(2026, 5, 1, 10)),
        ("20260105T101112", dt.datetime(2026, 1, 5, 10, 11, 12)),
        ("Jan 5, 2026", dt.datetime(2026, 1, 5)),
        ("5 Jan 2026 10:11:12", dt.datetime(2026, 1, 5, 10, 11, 12)),
        ("2026/13/45", None),
        ("yesterday", None),
        ("", None),
        (None, None),
    ],
)
def test_mixed_time_formats(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string").select(ingest.parse_timestamp(F.col("t")).alias("t"))
    assert df.first().t == expected


def test_row_ids_are_dense_and_follow_the_given_order(spark):
    df = spark.range(5000, numPartitions=7).withColumn("k", -F.col("id"))
    rows = ingest.with_row_id(df, ["k"], partitions=5).collect()
    assert sorted((r.source_row_id, r.id) for r in rows) == [(i, 4999 - i) for i in range(5000)]
    plain = ingest.with_row_id(spark.range(100, numPartitions=9)).collect()
    assert [r.source_row_id for r in sorted(plain, key=lambda r: r.id)] == list(range(100))


def test_sinks_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "b"\nc'), (2, "д")], "n int, s string")
    write_table(df, str(tmp_path / "p"), "parquet")
    write_table(df, str(tmp_path / "c"), "csv", single_file=True)
    write_table(df, str(tmp_path / "j"), "json")
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "p")).collect())) == [(1, 'a "b"\nc'), (2, "д")]
    assert sorted(tuple(r) for r in read_csv(spark, str(tmp_path / "c")).collect()) == [("1", 'a "b"\nc'), ("2", "д")]
    assert spark.read.json(str(tmp_path / "j")).count() == 2
    with pytest.raises(ValueError):
        read_table(spark, str(tmp_path), "xlsx")
