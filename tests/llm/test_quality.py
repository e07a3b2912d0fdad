import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from threadlens.llm import quality as q
from threadlens.llm.common import blocks, utf8


def slow(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    hit = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(hit)


def texts(seed):
    rng = random.Random(seed)
    words = ["a", "é", "日本", "#x", "<b>", "$", "plain", "longerthaneight"]
    say = lambda n, gaps: "".join(rng.choice(words) + rng.choice(gaps) for _ in range(n))
    out = [None, "", " ", "\n\n", "\x1c", "a", "a\na\n a\na", "x y z w"]
    for _ in range(30):
        part = say(rng.randrange(30), [" ", "\n", "  ", "\t"])
        out.append(part * rng.randrange(1, 4) + say(rng.randrange(12), [" ", "\r\n"]) + part)
    return out + ["one two three four five six seven eight " * 40]


@pytest.mark.parametrize("seed", range(4))
def test_base_counts(seed):
    column = pa.array(texts(seed))
    found = q.base_counts(*utf8(column))
    assert [tuple(int(c[i]) for c in found) for i in range(len(column))] == [slow(t) for t in column.to_pylist()]


def test_places_stay_in_their_text():
    column = pa.array(["abcdef", "ab", "", None, "xyz1", "ABcdEF", "a\nb  "])
    at, first = q.places(*utf8(column))
    assert np.diff(first).tolist() == [3, 0, 0, 0, 1, 3, 2] and len(at) == first[-1]
    assert at[:3].tolist() == at[4:7].tolist()
    alone = np.concatenate([q.places(*utf8(pa.array([t], pa.string())))[0] for t in column.to_pylist()])
    assert at.tolist() == alone.tolist()


def test_blocks_hold_every_row(monkeypatch):
    monkeypatch.setattr("threadlens.llm.common.BLOCK_BYTES", 10)
    batch = pa.RecordBatch.from_pydict({"text": ["x" * n for n in (0, 3, 30, 4, 4, 4, 0, 11)], "i": list(range(8))})
    parts = list(blocks(iter([batch])))
    assert [i for p in parts for i in p["i"].to_pylist()] == list(range(8)) and len(parts) > 3


def test_quality(spark):
    rng = random.Random(5)
    prose = lambda n: " ".join("".join(rng.choice(["the", "re", "an", "ti", "on"]) for _ in range(3)) for _ in range(n))
    rows = [(i, prose(60)) for i in range(120)]
    rows += [(200 + i, " ".join(w.upper() + "$$$%%%" for w in prose(60).split())) for i in range(20)]
    rows += [(300, None), (301, ""), (302, prose(19)), (303, "one two three four five six seven eight " * 6), (0, rows[0][1]), (None, prose(60))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("quality", F.lit(0)).withColumn("n_words", F.lit("x"))
    labels = spark.createDataFrame([(i, 1, 0) for i in range(60)] + [(3, 1, 1), (None, 1, 0), (200, 0, 0)], "doc_id bigint, quality int, toxic int")
    found = q.quality(docs, labels).collect()
    assert len(found) == len(rows)
    want = {d: slow(t) for d, t in rows}
    for r in found:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want[r.doc_id]
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert r.kept == (not r.base_failed and r.llr >= r.threshold)
    kept = [r.doc_id for r in found if r.kept]
    assert len(kept) > 115 and not any(d and d >= 200 for d in kept)
    assert q.quality(docs.limit(0), labels).count() == 0
    assert {r.kept for r in q.quality(docs, labels.limit(0)).collect() if not r.base_failed} == {True}


def test_threshold_is_exact_and_the_same_for_any_partitions(spark):
    rng = np.random.default_rng(8)
    llr = np.round(rng.normal(size=5000), 9)
    found = {q.exact_threshold(spark.createDataFrame([(float(x),) for x in llr], "llr double").repartition(n)) for n in (1, 7, 50)}
    ordered = np.sort(np.round(llr * q.GRID))
    assert found == {(2 * ordered[int(np.ceil(q.LOW * 5000)) - 1] - ordered[2499]) / q.GRID}
    assert q.exact_threshold(spark.createDataFrame([], "llr double")) == float("-inf")


def test_scores_are_the_mean_log_ratio(spark):
    rows = [(1, "abcdabcd"), (2, "zz"), (3, "wxyz")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    counts = q.place_counts(docs)
    assert counts.sum() == 6
    ratio = q.log_ratio(counts, counts * 2)
    for r in q.score(docs, ratio).collect():
        text = dict(rows)[r.doc_id]
        at = [q.places(*utf8(pa.array([text[i : i + 4]])))[0][0] for i in range(len(text) - 3)]
        assert r.llr == pytest.approx(float(np.mean([ratio[a] for a in at])) if at else 0, abs=1e-6)
