import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from threadlens.llm import token_store as ts
from threadlens.llm.queries import QUERIES, tokenizer_path

PATH = tokenizer_path()
WHOLE = Tokenizer.from_file(PATH)
ENCODER = ts.Encoder(open(PATH, encoding="utf-8").read())


def ids(text):
    return WHOLE.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*"ab's '  \n\t\r\x0b\x1c\x85\u3000\xa0é日1!$.😀A", "<|endoftext|>"]), max_size=25).map("".join), max_size=4))
def test_encoder_gives_the_ids_of_whole_texts(texts):
    got = [np.frombuffer(b, f"<u{ENCODER.width}").tolist() for b in ENCODER.encode(texts)]
    assert got == [ids(t) for t in texts]


def test_encoder_on_given_texts_and_when_it_forgets(spark, monkeypatch):
    from conftest import FOLDER

    monkeypatch.setattr(ts, "REMEMBERED", 50)
    texts = [r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    for i in range(0, len(texts), 20):
        got = [np.frombuffer(b, f"<u{ENCODER.width}").tolist() for b in ENCODER.encode(texts[i : i + 20])]
        assert got == [ids(t) for t in texts[i : i + 20]]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*"aZéÉßø×÷\u0110ȿɀʰ\u0301İ'.!-\u2009 \n1日", "Straße", "één", " où", "."]), max_size=20).map("".join), max_size=4))
def test_wide_letters_and_signs(texts):
    got = [np.frombuffer(b, f"<u{ENCODER.width}").tolist() for b in ENCODER.encode(texts)]
    assert got == [ids(t) for t in texts]


def test_punctuation_is_told_apart_from_wide_letters():
    data = np.frombuffer("é où, Straße!! a× b÷.".encode(), np.uint8)
    starts, ends, _, _ = ts._split(data, np.array([0, len(data)]), ts._letters(data))
    assert [data[a:b].tobytes().decode() for a, b in zip(starts, ends, strict=True)] == ["é", "où", ",", "Straße", "!!", "a×", "b÷."]


def fresh():
    return ts.Encoder(open(PATH, encoding="utf-8").read())


def test_repeated_pieces_outlive_new_ones(monkeypatch):
    monkeypatch.setattr(ts, "REMEMBERED", 40)
    encoder, learned = fresh(), []
    learn = encoder._learn
    monkeypatch.setattr(encoder, "_learn", lambda data, starts, ends, *rest: learned.extend(data[a:b].tobytes().decode() for a, b in zip(starts, ends, strict=True)) or learn(data, starts, ends, *rest))
    word = "a" * 20
    for i in range(60):
        text = f"some common words and {word[: i % 20]}x{chr(97 + i % 26)} {word[i % 7:]}y{chr(97 + i // 26)}{chr(97 + i % 26)}"
        assert np.frombuffer(encoder.encode([text])[0], f"<u{encoder.width}").tolist() == ids(text)
        assert len(encoder.keys) <= 60
    assert [learned.count(w) for w in ("common", "words", "and")] == [1, 1, 1] and len(learned) > 100


def test_long_pieces_do_not_pile_up(monkeypatch):
    monkeypatch.setattr(ts, "REMEMBERED", 40)
    encoder = fresh()
    for i in range(30):
        text = f"x{i}" * 200
        for _ in range(2):
            assert np.frombuffer(encoder.encode([text])[0], f"<u{encoder.width}").tolist() == ids(text)
        assert len(encoder.pool) <= 40 * ts.PIECE_IDS + 2000


def test_pieces_of_one_hash(monkeypatch):
    monkeypatch.setattr(ts, "hash_words", lambda data, starts, ends: np.zeros(len(starts), np.uint64))
    encoder = fresh()
    for texts in (["word"], ["other"], ["word"], [" word other"], ["", None]):
        assert [np.frombuffer(b, f"<u{encoder.width}").tolist() for b in encoder.encode(texts)] == [ids(t) for t in texts]


def test_a_table_that_is_too_small_grows(monkeypatch):
    monkeypatch.setattr(ts, "REMEMBERED", 1)
    text = " ".join(f"{a}{b}{c}" for a in "abcdefghij" for b in "klmnopqrst" for c in "uvwxyzäöüß")
    assert np.frombuffer(fresh().encode([text])[0], f"<u{ENCODER.width}").tolist() == ids(text)


def test_tasks_of_a_worker_share_an_encoder():
    config = open(PATH, encoding="utf-8").read()
    assert ts.worker_encoder(config) is ts.worker_encoder(config)


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 20_000])
def test_minimal_perfect_hash(n):
    rng = np.random.default_rng(n)
    keys, marks = (rng.integers(0, 2**63, n).astype(np.uint64) for _ in range(2))
    keys[: n // 2] = keys[n // 2 : n // 2 + n // 2]  # equal first hashes are told apart by the second
    slots = np.zeros(n, ts.SLOT)
    slots["mark"], slots["start"] = marks, np.arange(n)
    index = ts.Index(ts.Index.pack(keys, slots))
    at = index.find(keys, marks)
    assert sorted(at.tolist()) == list(range(n)) and (index.slots["start"][at] == np.arange(n)).all()
    others = index.find(keys, marks ^ np.uint64(1)) if n else np.zeros(0)
    assert (others == -1).all()


def test_two_equal_keys_are_refused():
    with pytest.raises(ValueError):
        ts.build_hash(np.zeros(2, np.uint64), np.zeros(2, np.uint64))


def test_round_trip(spark):
    rows = [(d, f"text {d} " + "word " * (d % 50)) for d in range(-20, 300)]
    rows += [(7, "again"), (7, "again"), (7, "other"), (None, "no id"), (None, None), (500, ""), (501, None), (502, "long " * 40_000), (503, "<|endoftext|> a  b")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("part", F.lit("x")).withColumn("salt", F.lit(1)).repartition(5)
    store = ts.write_store(docs, PATH, shard_bytes=600, bucket_keys=40)
    assert store.documents == len(rows) and store.buckets > 3
    got = store.ids(ts.keys_of(docs)).collect()
    assert len(got) == len(rows)
    want = {}
    for d, t in rows:
        want.setdefault(d, []).append([*ids(t), 0])
    found = {}
    for r in sorted(got, key=lambda r: r.start):
        found.setdefault(r.doc_id, []).append(r.ids)
        assert r.n_tokens == len(r.ids)
    assert {d: sorted(x) for d, x in found.items()} == {d: sorted(x) for d, x in want.items()}
    place = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == place
        place += r.n_tokens
    order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda d: (d is not None, d or 0))
    assert {(r.doc_id, r.nth) for r in got} == {(d, i) for d in want for i in range(len(want[d]))}
    sums = {(r.doc_id, r.nth): r.ids_crc32 for r in store.checksums(ts.keys_of(docs)).collect()}
    assert sums == {(r.doc_id, r.nth): zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in got}
    asked = spark.createDataFrame([(5, 0), (7, 3), (7, 4), (9999, 0), (6, 1)], "doc_id bigint, nth int")
    assert sorted((r.doc_id, r.nth) for r in store.ids(asked).collect()) == [(5, 0), (7, 3)]


def test_repeated_rows_over_several_ranges(spark):
    rows = [(1, f"t{i}") for i in range(200)] + [(2, "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    store = ts.write_store(docs, PATH)
    got = store.ids(ts.keys_of(docs)).collect()
    assert sorted(r.nth for r in got if r.doc_id == 1) == list(range(200)) and len(got) == 201


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    store = ts.write_store(docs, PATH)
    assert store.documents == 0 and store.ids(ts.keys_of(docs)).count() == 0


def test_query_on_the_given_table(spark):
    from conftest import FOLDER

    place = 0
    texts = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect())
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op6_tokens"](spark, FOLDER).collect()}
    for d, t in texts:
        own = [*ids(t), 0]
        assert got.pop(d) == (place, len(own), zlib.crc32(np.array(own, "<u4").tobytes()))
        place += len(own)
    assert not got
