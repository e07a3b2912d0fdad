import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from threadlens.llm import lm
from threadlens.llm.common import held_out
from threadlens.llm.queries import QUERIES


def slow_tokens(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    return [w.encode() for w in low.split(" ") if w] + [b""]


def slow_base(rows):
    """Base scores by the letter; rows: (doc_id, text, held)."""
    trained = Counter(t for _, text, held in rows if not held for t in slow_tokens(text))
    n, v = sum(trained.values()), len(trained)
    out = []
    for d, text, held in rows:
        tokens = slow_tokens(text)
        out.append((d, held, len(tokens), sum(trained[t] > 0 for t in tokens), n, sum(math.log10((trained[t] + 1) / (n + v + 1)) for t in tokens)))
    return out, trained


def slow_score(token, trained, mixer):
    """A token's log10 probability bit by bit, contexts counted over all tokens in dictionaries."""
    said = lambda t: t + b" " if t else b"\n"
    total = 0.0
    for j, byte in enumerate(said(token)):
        for k in range(8):
            value, node, x = byte >> (7 - k) & 1, (1 << k) | byte >> (8 - k), []
            counts = []
            for order in (1, 2, 3, 4, None):
                sums = [0, 0]
                for t, c in trained.items():
                    s = said(t)
                    for i in range(len(s)):
                        if order is None:
                            same = i == j and j >= lm.STEM and s[:i] == said(token)[:j]
                        else:
                            same = (b"\0" * order + s[:i])[-order:] == (b"\0" * order + said(token)[:j])[-order:]
                        if same and (1 << k) | s[i] >> (8 - k) == node:
                            sums[s[i] >> (7 - k) & 1] += c
                counts.append(sum(sums))
                used = j >= lm.STEM if order is None else order < 4 or j < lm.STEM
                x.append(math.log((sums[1] + lm.PRIOR) / (sums[0] + lm.PRIOR)) if used else 0)
            seen = counts[4] if j >= lm.STEM else counts[3]
            gate = min(j, lm.STEM) * lm.SEEN + min(int(math.log2(seen + 1)), lm.SEEN - 1)
            mixed = float(np.clip(np.dot([*x, 1], mixer.weights[gate]), -lm.LIMIT, lm.LIMIT))
            refined = float(np.interp(mixed, np.linspace(-lm.LIMIT, lm.LIMIT, lm.STEPS), mixer.refined[gate]))
            s = (mixed + refined) / 2
            total -= math.log10(1 + math.exp(-s if value else s))
    return total


def corpus(seed=1, n=60):
    rng = random.Random(seed)
    words = ["the", "The", "theory", "theories", "there", "a", "é", "日本", "x" * 40, "on", "once"]
    rows = [(i, "".join(rng.choice(words) + rng.choice([" ", "\n", "\t ", "  "]) for _ in range(rng.randrange(30)))) for i in range(n)]
    return rows + [(n, None), (n + 1, ""), (3, rows[3][1]), (n + 2, "new words here " * 50), (None, "the")]


def counted(trained):
    tokens = sorted(trained)
    (bits,) = lm.bits_of([lm.closed(t) for t in tokens])
    weight = np.repeat(np.array([trained[t] for t in tokens])[bits.token], 8)
    short = np.repeat(bits.depth < lm.STEM, 8)
    counts = np.zeros((2, lm.SLOTS[-1]), np.float32)
    for i in range(4):
        for v in (0, 1):
            at = (bits.bit.ravel() == v) & (short if i == 3 else True)
            np.add.at(counts[v], bits.slots[i].ravel()[at], weight[at])
    return counts


def test_tokens_of_cut_batches(monkeypatch):
    import pyarrow as pa

    from threadlens.llm import common

    monkeypatch.setattr(common, "BLOCK_BYTES", 300)
    texts = [t for _, t in corpus(4, 80)] + ["ÄB Cd\x0bE", "x" * 1000]
    batch = pa.RecordBatch.from_pydict({"text": pa.array(["front", *texts], pa.string())}).slice(1)
    got = []
    for part in common.blocks(iter([batch])):
        words, owner = lm.tokens_of(part)
        got += [[w for w, o in zip(words.to_pylist(), owner, strict=True) if o == i] for i in range(part.num_rows)]
    assert got == [slow_tokens(t) for t in texts]


def test_token_scores_like_brute_force():
    trained = {b"the": 9, b"theory": 2, b"theories": 1, b"": 4, b"a": 5, "é".encode(): 1}
    asked = sorted([*trained, b"theo", b"theorem", b"b"])
    rng = np.random.default_rng(3)
    mixer = lm.Mixer.fresh()
    mixer.weights += rng.normal(size=mixer.weights.shape) / 5
    mixer.refined += rng.normal(size=mixer.refined.shape)
    counts = counted(trained)
    got = lm.token_scores([lm.closed(t) for t in asked], np.array([trained.get(t, 0) for t in asked]), counts, mixer)
    assert got == pytest.approx([slow_score(t, trained, mixer) for t in asked], abs=1e-3)


def test_shared_counts_like_counting_bits(spark):
    trained = {b"the": 9, b"theory": 2, b"theories": 1, b"": 4, b"a": 5, "é".encode(): 1, b"never": 0}
    rows = spark.createDataFrame([(bytearray(lm.closed(t)), n) for t, n in trained.items()], "unit binary, trained bigint").repartition(3)
    assert (lm.shared_counts(rows) == counted({t: n for t, n in trained.items() if n})).all()


def test_probabilities_of_all_bytes_add_up():
    trained = {b"the": 9, b"theory": 2, b"": 4}
    counts, mixer = counted(trained), lm.Mixer.fresh()
    tokens = [lm.closed(b"th" + bytes([b])) for b in range(256)]
    (bits,) = lm.bits_of(tokens)
    each = mixer.log10(*lm.inputs(bits, counts, np.zeros(256, np.int64), False)).reshape(-1, 8).sum(axis=1)
    third = each[np.flatnonzero(np.diff(np.concatenate([[-1], bits.token])) > 0) + 2]
    assert (10**third).sum() == pytest.approx(1, abs=1e-6)


def test_long_tokens_in_windows(monkeypatch):
    rng = random.Random(6)
    tokens = sorted({b"\0" * rng.randrange(200) + bytes(rng.choices(range(33, 60), k=rng.randrange(80))) for _ in range(60)} | {b"", b"ab", b"\xff" * 3000})
    trained = np.array([rng.randrange(5) for _ in tokens])
    counts, mixer = counted(dict(zip(tokens, trained.tolist(), strict=True))), lm.Mixer.fresh()
    tokens = [lm.closed(t) for t in tokens]
    whole = lm.token_scores(tokens, trained, counts, mixer)
    monkeypatch.setattr(lm, "CHUNK_BITS", 2_000)
    parts = list(lm.windows(tokens))
    assert len(parts) > 20 and max(len(w.data) for w in parts) <= max(250, len(tokens))
    assert lm.token_scores(tokens, trained, counts, mixer) == pytest.approx(whole, abs=1e-6)


def test_units(spark):
    tokens = {b"": 1, b"a": 2, b"x" * 32: 3, b"x" * 33: 4, b"x" * 100: 5, b"y" * 64: 6}
    rows = spark.createDataFrame([(bytearray(t), n) for t, n in tokens.items()], "token binary, trained bigint")
    units, parts = lm.units_of(rows)
    x = b"x" * 32
    assert {bytes(r.unit): r.trained for r in units.collect()} == {b"\n": 1, b"a ": 2, x + b" ": 3, x: 4 + 15, b"x ": 4, b"xxxx ": 5, b"y" * 32: 6, b"y" * 32 + b" ": 6}
    assert {(bytes(r.token), bytes(r.unit)): r.times for r in parts.collect()} == {
        (b"x" * 33, x): 1, (b"x" * 33, b"x "): 1, (b"x" * 100, x): 3, (b"x" * 100, b"xxxx "): 1, (b"y" * 64, b"y" * 32): 1, (b"y" * 64, b"y" * 32 + b" "): 1,
    }
    scores = {bytes(r.token): r.lm for r in lm.score_vocabulary(rows.withColumn("seen", F.lit(1))).collect()}
    assert scores.keys() == tokens.keys() and all(s < 0 for s in scores.values())
    by_unit = {bytes(r.unit): r.lm for r in lm.score_units(units).collect()}
    assert scores[b"x" * 100] == pytest.approx(3 * by_unit[x] + by_unit[b"xxxx "], abs=1e-6) and scores[b"a"] == pytest.approx(by_unit[b"a "])


def test_fitting_helps():
    rng = random.Random(2)
    parts = ["ka", "ru", "ti", "mo", "en", "s"]
    trained = Counter("".join(rng.choice(parts) for _ in range(rng.randrange(1, 6))).encode() for _ in range(6000))
    new = [t for t in {"".join(rng.choice(parts) for _ in range(5)).encode() for _ in range(500)} if t not in trained]
    counts = counted(trained)
    tokens = sorted(trained)
    mixer = lm.fit(iter([{"token": [lm.closed(t) for t in tokens], "trained": [trained[t] for t in tokens]}]), counts)
    everything = sorted([*tokens, *new])
    c = np.array([trained[t] for t in everything])
    fitted, plain = (lm.token_scores([lm.closed(t) for t in everything], c, counts, m) for m in (mixer, lm.Mixer.fresh()))
    assert fitted[c == 0].mean() > plain[c == 0].mean() and np.isfinite(fitted).all()


def test_all_units_are_fitted_on(spark, monkeypatch):
    rng = random.Random(8)
    trained = Counter("".join(rng.choice("abcdefg") for _ in range(rng.randrange(1, 9))).encode() for _ in range(4000))
    counts = counted(trained)
    rows = spark.createDataFrame([(bytearray(lm.closed(t)), n) for t, n in [*trained.items(), (b"never", 0)]], "unit binary, trained bigint").repartition(5)
    rows = rows.withColumn("stem", F.substring("unit", 1, lm.STEM))
    monkeypatch.setattr(lm, "GROUP_UNITS", 600)
    number = round(len(trained) / 600)
    groups = {}
    for r in rows.where("trained > 0").withColumn("group", F.pmod(F.xxhash64("stem"), F.lit(number))).orderBy("unit").collect():
        part = groups.setdefault(r.group, {"token": [], "trained": []})
        part["token"].append(bytes(r.unit))
        part["trained"].append(r.trained)
    assert len(groups) == number > 3
    want = lm.averaged(sum(lm.learned(iter([part]), counts) for part in groups.values()))
    whole = sum(lm.outcomes(iter([part]), counts, want) for part in groups.values())
    assert whole.sum() == 8 * sum((len(t) + 1) * n for t, n in trained.items())
    want.refine(whole)
    got = lm.fitted(rows, spark.sparkContext.broadcast(counts))
    assert got.weights == pytest.approx(want.weights, abs=1e-9) and got.refined == pytest.approx(want.refined, abs=1e-6)


def test_steps_like_bits():
    trained = {b"the": 9, b"theory": 2, b"theories": 1, b"": 4, b"a": 5, b"x" * 40: 3}
    tokens = [lm.closed(t) for t in sorted(trained)]
    weight = np.array([trained[t] for t in sorted(trained)])
    counts = counted(trained)
    (bits,), ((steps, back, token),) = lm.bits_of(tokens), lm.steps_of(tokens)
    assert (token == bits.token).all() and len(steps.token) < len(bits.token)
    for leave_out in (False, True):
        plain, merged = lm.inputs(bits, counts, weight, leave_out), lm.inputs(steps, counts, np.bincount(back, weight[token]), leave_out)
        at = (back[:, None] * 8 + np.arange(8)).ravel()
        assert all((p == m[at]).all() for p, m in zip(plain, merged, strict=True))


def test_base_scores_and_counts(spark, monkeypatch):
    rows = corpus()
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("held_out", held_out("doc_id", 7, 2))
    docs = docs.withColumn("token", F.lit("x")).withColumn("known", F.lit(1)).repartition(3)
    want, trained = slow_base([(d, t, held(d)) for d, t in rows])
    monkeypatch.setattr(lm, "HEAD", 3)
    found = lm.score_texts(docs).collect()
    key = lambda r: (str(r[0]), r[2], r[3])
    for r, w in zip(sorted(found, key=key), sorted(want, key=key), strict=True):
        assert (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens) == w[:5]
        assert r.base_score == pytest.approx(w[5], abs=1e-5) and r.score <= 0 and math.isfinite(r.score)
    scores = {}
    for r in lm.score_vocabulary(lm.count_tokens(docs)).collect():
        assert r.trained == trained[bytes(r.token)]
        scores[bytes(r.token)] = r.lm
    for r, (d, text) in zip(sorted(found, key=lambda r: (str(r.doc_id), r.n_tokens)), sorted(rows, key=lambda r: (str(r[0]), len(slow_tokens(r[1])))), strict=True):
        tokens = slow_tokens(text)
        assert r.score == pytest.approx(sum(scores[t] for t in tokens), abs=1e-4)
        assert r.bits_per_byte == pytest.approx(-r.score / math.log10(2) / sum(len(t) + 1 for t in tokens), abs=1e-4)


def test_stems_stay_together(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(lm, "CHUNK_BITS", 400)
    tokens = sorted({f"{a}{b}{c}".encode() for a in ("abcd", "abce", "b", "", "xyzzy") for b in "pqr" for c in "123456"} | {b""})
    batches = [pa.RecordBatch.from_pydict({"token": pa.array(tokens[i : i + 7], pa.binary()), "n": list(range(i, min(i + 7, len(tokens))))}) for i in range(0, len(tokens), 7)]
    parts = list(lm._stems(iter(batches)))
    assert [t for p in parts for t in p["token"]] == tokens and len(parts) > 2
    stems = [{t[: lm.STEM] for t in p["token"]} for p in parts]
    assert not any(a & b for i, a in enumerate(stems) for b in stems[:i])


def test_no_training_rows_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "")], "doc_id bigint, text string").withColumn("held_out", F.lit(True))
    got = {r.doc_id: r for r in lm.score_texts(docs).collect()}
    assert got[1].n_known == 0 and got[1].train_tokens == 0 and got[1].base_score == 0
    assert got[2].score == pytest.approx(8 * math.log10(0.5), abs=1e-5)
    assert lm.score_texts(docs.limit(0)).count() == 0


def slow_stream(text):
    """(bytes before, unit so far, byte) of every byte of a text, units cut by the letter."""
    out, before = [], b"\0\0\0 "
    for token in slow_tokens(text):
        said = lm.closed(token)
        for at, byte in enumerate(said):
            unit = min(at // lm.UNIT, max(0, (len(token) - 1) // lm.UNIT)) * lm.UNIT
            out.append((before, said[unit:at], byte))
            before += bytes([byte])
    return out


def slow_running_score(text, trained, mixer):
    """A text's log10 probability bit by bit; ``trained`` are the bytes of training texts behind their contexts."""
    def contexts(before, unit):
        if len(unit) < lm.STEM:
            return before[-1:], before[-2:], before[-3:], (unit,), before[-4:]
        return unit[-1:], unit[-2:], unit[-3:], None, (unit,)

    seen = Counter((order, c, byte) for before, unit, byte in trained for order, c in enumerate(contexts(before, unit)) if c is not None)
    total = 0.0
    for before, unit, byte in slow_stream(text):
        for k in range(8):
            value, node = byte >> (7 - k) & 1, (1 << k) | byte >> (8 - k)
            x, count = [], 0
            for order, c in enumerate(contexts(before, unit)):
                sums = [sum(seen[order, c, b] for b in range(256) if (1 << k) | b >> (8 - k) == node and b >> (7 - k) & 1 == v) for v in (0, 1)]
                x.append(0 if c is None else math.log((sums[1] + lm.PRIOR) / (sums[0] + lm.PRIOR)))
                count = sum(sums)
            gate = min(len(unit), lm.STEM) * lm.SEEN + min(int(math.log2(count + 1)), lm.SEEN - 1)
            mixed = float(np.clip(np.dot([*x, 1], mixer.weights[gate]), -lm.LIMIT, lm.LIMIT))
            refined = float(np.interp(mixed, np.linspace(-lm.LIMIT, lm.LIMIT, lm.STEPS), mixer.refined[gate]))
            p = (mixed + refined) / 2
            total -= math.log10(1 + math.exp(-p if value else p))
    return total


def test_running_text_like_brute_force(spark, monkeypatch):
    texts = ["the cat sat on the mat", "The theory of cats", "", None, "a  b\tc", "x" * 70 + " y", "é 日本 the cat", "the theories theorem"]
    docs = spark.createDataFrame([(i, t, i % 3 == 2) for i, t in enumerate(texts)], "doc_id bigint, text string, held_out boolean").repartition(3)
    rng = np.random.default_rng(3)
    mixer = lm.Mixer.fresh()
    mixer.weights += rng.normal(size=mixer.weights.shape) / 5
    mixer.refined += rng.normal(size=mixer.refined.shape)
    monkeypatch.setattr(lm, "fitted", lambda units, counts, steps=None: mixer)
    trained = [step for i, t in enumerate(texts) if i % 3 != 2 for step in slow_stream(t)]
    found = {r.doc_id: r.score for r in lm.score_texts(docs, over_blanks=True).collect()}
    assert found == pytest.approx({i: slow_running_score(t, trained, mixer) for i, t in enumerate(texts)}, abs=2e-3)
    steps = {r.step: r.n for r in lm.count_steps(docs).collect()}
    assert sum(steps.values()) == sum(len(unit) < lm.STEM for _, unit, _ in trained)
    some = np.array([5 << 8 | 7 << 24 | 2 << 40], np.uint64) | np.arange(256, dtype=np.uint64) << np.uint64(32)
    counts = lm.shared_counts(spark.createDataFrame([], "unit binary, trained bigint"), lm.count_steps(docs))
    assert (10 ** lm.step_scores(some, counts, mixer)).sum() == pytest.approx(1, abs=1e-5)


def test_order_of_words_counts(spark):
    rng = random.Random(9)
    lines = ["red fish swim in deep water", "old men sit by the fire", "tall trees grow on green hills", "cold wind comes from far north"]
    rows = [(i, " ".join(rng.choice(lines) for _ in range(6)), i % 7 == 2) for i in range(140)]
    shuffled = [(1000 + i, " ".join(rng.sample(t.split(), len(t.split()))), True) for i, t, held in rows if held]
    docs = spark.createDataFrame(rows + shuffled, "doc_id bigint, text string, held_out boolean")
    alone, running = ({r.doc_id: r.score for r in lm.score_texts(docs, over_blanks=o).collect()} for o in (False, True))
    for i, _, _ in shuffled:
        assert alone[i] == pytest.approx(alone[i - 1000], abs=1e-3)
        assert running[i] < running[i - 1000] - 1 and running[i - 1000] > alone[i - 1000]


def test_steps_are_fitted_by_descent(spark, monkeypatch):
    docs = spark.createDataFrame([(i, t, False) for i, t in corpus(5, 200)], "doc_id bigint, text string, held_out boolean")
    steps = lm.staged(lm.count_steps(docs), "steps")
    counts = spark.sparkContext.broadcast(lm.shared_counts(spark.createDataFrame([], "unit binary, trained bigint"), steps))
    losses = []
    for passes in (1, 3, 10):
        monkeypatch.setattr(lm, "PASSES", passes)
        mixer = lm.Mixer.fresh()
        lm.fit_steps(steps, counts, mixer)
        losses.append(lm._over_steps(steps, counts, mixer.bends, (lm.GATES, 43))[:, 0].sum())
    assert losses[0] > 1.01 * losses[1] and losses[1] >= losses[2] * (1 - 1e-3)
    whole = lm._over_steps(steps.repartition(7), counts, mixer.bends, (lm.GATES, 43))
    assert whole[:, 0].sum() == pytest.approx(losses[2])


def test_query_on_the_given_table(spark):
    from conftest import FOLDER

    rows = [(r.doc_id, r.text, zlib.crc32(str(r.doc_id).encode()) % 7 == 2) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    want = {w[0]: w for w in slow_base(rows)[0]}
    for r in QUERIES["op5_lm"](spark, FOLDER).collect():
        w = want.pop(r.doc_id)
        assert (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens) == w[:5] and r.base_score == pytest.approx(w[5], abs=1e-4)
    assert not want
