import random
import re
import time
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from threadlens.llm import secret_scan as ss
from threadlens.llm.queries import QUERIES


def slow_base(text):
    """The fixed patterns by the letter: match, then drop what is too short."""
    text, found = text or "", []
    names = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in n) for n in ("password", "passwd", "secret", "token", "api_?key"))
    for m in re.finditer(rf"""({names})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 8:
            found.append((m.start(), 0, m.end()))
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


CASES = {
    'password: "secret: abcdefghi"': [],
    "TOKEN=token=abcdefgh": [("assign", "TOKEN=token=abcdefgh")],
    "paſſword=abcdefgh12": [],
    "AKIAAKIA x AKIA0123456789AB AKIAAKIA0123456789": [("access", "AKIA0123456789AB"), ("access", "AKIAAKIA0123456789")],
    "é" * 3 + "0123456789abcdef" * 2 + "g": [("hex", "0123456789abcdef0123456789abcdef")],
    'K = "abcd1234EFGH"\nsigning_key = K + "zz99"': [("literal", "abcd1234EFGH"), ("literal", "zz99")],
    "db.pwd: str = 'hunter2hunter2'": [("literal", "hunter2hunter2")],
    'cfg["privateKey"] => "q8Zk3Lm09xPw"': [("literal", "q8Zk3Lm09xPw")],
    '"credentials" : "q8Zk3Lm09xPw"': [("literal", "q8Zk3Lm09xPw")],
    'token_count = "q8Zk3Lm09xPw"': [],
    'if (passphrase == "q8Zk3Lm09xPw")': [],
    "DB_PWD=changeme99": [],
    "bearer: https://example.org/a1b2c3d4": [],
}


@pytest.mark.parametrize("text", CASES)
def test_spans(text):
    assert [(ss.KINDS[k], text[s:e]) for s, k, e in ss.spans(text)] == CASES[text]


@pytest.mark.parametrize("seed", range(5))
def test_fixed_patterns_like_brute_force(seed):
    rng = random.Random(seed)
    bits = ["password", "PassWd", "api_key", "apikey", "secret", "token", "=", ": ", " ", '"', "'", "AKIA", "ABCD0123", "deadbeef", "0123456789abcdef", "\n", "é", "x", "日", "-", "K = ", "+"]
    for _ in range(300):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(40)))
        assert [s for s in ss.spans(text) if s[1] < 3] == slow_base(text)


def test_long_names_and_constants_of_many_parts():
    for name in ("signing_key" + " " * 500, "config" + ".part" * 100 + ".signing_key", "signing_key: list[" + "a." * 200 + "b]"):
        assert [text[s:e] for text in (name + " = 'q8Zk3Lm09xPw'",) for s, _, e in ss.spans(text)] == ["q8Zk3Lm09xPw"]
    values = [f"q8Zk{i}" for i in range(150)]
    for text in (
        "signing_key = " + " + ".join(f"'{v}'" for v in values),
        "k = 'q8Zk0'\n" + "".join(f"k = k + '{v}'\n" for v in values[1:]) + "signing_key = k + k",
        "k = 'q8Zk149'\n" + "".join(f"k = '{v}' + k\n" for v in values[148::-1]) + "a = k + k\nsigning_key = a + k",
    ):
        assert sorted(text[s:e] for s, _, e in ss.spans(text)) == sorted(values)
    many = "k = 'v1'\n" + "k = k + 'w2'\n" * 40_000
    for text in (many.replace("k", "signing_key"), many + "token = k + k\n" * 20_000, "k = 'v1'\n" + "k = 'w2' + k\n" * 40_000 + "token = k"):
        begin = time.perf_counter()
        assert len([s for s in ss.spans(text) if s[1] == 3]) == 40_001
        assert time.perf_counter() - begin < 20


def test_joined_values_score_like_whole_ones():
    for parts in (["exam", "ple12"], ["ch", "ange_", "me"], ["<a", "bcdefghij"], ["q8Zk3L", "m09xPw", " "], ["", "xx", "", "x1234567"], ["null", "null"]):
        joined = ss.Look.of("")
        for part in parts:
            joined = joined + ss.Look.of(part)
        assert joined == ss.Look.of("".join(parts)) and joined.score() == ss.Look.of("".join(parts)).score()


def test_hostile_texts_stay_linear():
    for text in ('x="' * 40_000, "x = x + x\n" * 20_000, "password" * 50_000, "a=" * 100_000, "k = 'v1'\n" + "k = k + 'w2'\n" * 5_000, "f" * 2_000_000):
        begin = time.perf_counter()
        ss.spans(text)
        assert time.perf_counter() - begin < 20


@pytest.mark.parametrize("quote", "\"'`")
def test_long_quoted_literals(quote):
    value = "q8Zk3Lm09xPw/" * 2_000
    assert [(ss.KINDS[k], text[s:e]) for text in (f"signing_key = {quote}{value}{quote};",) for s, k, e in ss.spans(text)] == [("literal", value)]
    for text in (f"key = {quote}a" * 40_001, f"a = {quote}\\{quote}" * 40_001, f"k = {quote}" + "x = y " * 40_000, "k = 'v1'\n" + f"a = {quote}b = c" * 20_000 + f"{quote} + k"):
        begin = time.perf_counter()
        ss.spans(text)
        assert time.perf_counter() - begin < 20


def test_query_on_odd_rows(spark):
    rows = [(1, "token: abcdefgh1"), (1, "token: abcdefgh1"), (None, "AKIA0123456789AB"), (2, None), (3, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("found", F.lit(1))
    got = ss.digests(ss.scan(docs)).collect()
    assert len(got) == 5
    by = {r.doc_id: r for r in got}
    assert by[1].spans == "assign:0:16" and by[1].base_sha256 == sha256(b"assign:0:16").hexdigest() and by[1].n_assign == 1
    assert by[2].spans == "" and by[2].base_sha256 == sha256(b"").hexdigest() and by[None].n_access == 1
    assert ss.digests(ss.scan(docs.limit(0))).count() == 0


def test_many_base_spans_stay_linear():
    line = "api_key = abcdefgh1234\n"
    begin = time.perf_counter()
    found = ss.spans(line * 40_000)
    assert time.perf_counter() - begin < 20
    assert [s for s in found if s[1] != 3] == [(len(line) * i, 0, len(line) * (i + 1) - 1) for i in range(40_000)]


def test_query_on_the_given_table(spark):
    from conftest import FOLDER

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    for r in QUERIES["op9_secrets"](spark, FOLDER).collect():
        base = ",".join(f"{ss.KINDS[k]}:{s}:{e}" for s, k, e in slow_base(texts.pop(r.doc_id)))
        assert r.base_sha256 == sha256(base.encode()).hexdigest()
    assert not texts
