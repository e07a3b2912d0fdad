import random
import zlib

import pytest
from conftest import FOLDER, SCHEMA
from pyspark.sql import functions as F

from threadlens.llm import sharding as sh


def slow_shards(rows, n_shards, n_dims):
    """Shard of each row (row, size, hash, dims) by sorting whole nodes; nodes are cut where the narrowed key crosses."""
    widths = [max((r[3][i] for r in rows), default=0) - min((r[3][i] for r in rows), default=0) for i in range(n_dims)]
    out = {}

    def split(part, first, owes):
        if owes == 1 or not part:
            out.update({r[0]: first for r in part})
            return
        spans = [(min(r[3][i] for r in part), max(r[3][i] for r in part)) for i in range(n_dims)]
        spread = [(hi - lo) / w if w else 0.0 for (lo, hi), w in zip(spans, widths, strict=True)]
        dim = spread.index(max(spread))
        lo, hi = spans[dim]
        place = lambda v: int((v - lo) / (hi - lo) * ((1 << sh.PLACE_BITS) - 1)) if hi > lo else 0
        keys = {r[0]: (place(r[3][dim]) << sh.HASH_BITS) + (r[2] & ((1 << sh.HASH_BITS) - 1)) for r in part}
        left, goal, reached, cut = owes // 2, sum(r[1] for r in part) * (owes // 2) // owes, 0, None
        for key in sorted(set(keys.values())):
            reached += sum(r[1] for r in part if keys[r[0]] == key)
            if reached > goal:
                cut = key
                break
        split([r for r in part if keys[r[0]] < cut], first, left)
        split([r for r in part if keys[r[0]] >= cut], first + left, owes - left)

    split(rows, 0, n_shards)
    return out


def corpus(seed, n=700):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        hot = rng.random() < 0.4
        text = "copy" if hot else rng.choice(["", None, "ä"]) if rng.random() < 0.1 else "w " * rng.randrange(1, 200)
        rows.append((i, text, "en" if hot else rng.choice(["en", "de", None]), "src1" if hot else rng.choice(["src2", "src10", None, ""]), rng.choice([None, 5, len(text or "")])))
    return rows + [rows[3]] * 40 + [(None, "no id", None, None, None)] * 10


@pytest.mark.parametrize(("seed", "n_shards"), [(1, 24), (2, 7), (3, 1), (4, 2)])
def test_like_brute_force(spark, seed, n_shards):
    docs = spark.createDataFrame(corpus(seed), SCHEMA).withColumn("size", F.lit("x")).withColumn("row", F.lit("y")).withColumn("d0", F.lit(1)).withColumn("shard", F.lit(1))
    rows = sh.numbered(docs)
    plain = [(r.row, r.size, r.h, (r.d0, r.d1, r.d2, r.d3)) for r in rows.withColumn("h", F.xxhash64("row")).collect()]
    got = {r.row: r.shard for r in sh.shards(rows, n_shards, 4).collect()}
    assert got == slow_shards(plain, n_shards, 4)
    sizes = [sum(p[1] for p in plain if got[p[0]] == s) for s in range(n_shards)]
    assert max(sizes) - min(sizes) <= 2 * 5 * max(p[1] for p in plain)


def check(rows, texts, n_shards):
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size, r.text_crc32) for r in rows) == sorted((d is None, d or 0, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in texts)
    for s in range(n_shards):
        own = sorted(r.slot for r in rows if r.shard == s)
        assert own == list(range(len(own)))
    assert {r.law for r in rows} <= {"bytes"} and {r.grown_shard for r in rows} <= {None}
    assert {r.shard for r in rows} <= set(range(n_shards))


def test_assign(spark):
    rows = corpus(5)
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("slot", F.lit("x"))
    got = sh.assign(docs, 24)
    assert got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    assert [t for _, t in got.dtypes] == ["bigint", "bigint", "bigint", "string", "int", "bigint", "int"]
    check(got.collect(), [(r[0], r[1]) for r in rows], 24)
    assert sh.assign(docs.limit(0), 24).count() == 0
    check(sh.assign(docs.limit(3), 24).collect(), [(r.doc_id, r.text) for r in docs.limit(3).collect()], 24)
    with pytest.raises(ValueError, match="one shard"):
        sh.assign(docs, 0)


def test_a_single_repeated_row_is_divided(spark):
    docs = spark.createDataFrame([(1, "same text", "en", "s", 9)] * 1000, SCHEMA)
    sizes = [r["count"] for r in sh.assign(docs, 8).groupBy("shard").count().collect()]
    assert len(sizes) == 8 and min(sizes) >= 120 and max(sizes) <= 130


def test_shards_keep_close_documents_together(spark):
    docs = spark.createDataFrame([(i, "word " * 20, "en", f"src{i % 4}", 100) for i in range(4000)], SCHEMA)
    got = sh.assign(docs, 4, (sh.name_place("source"),)).withColumn("source", F.col("doc_id") % 4)
    kinds = got.groupBy("shard").agg(F.max(F.col("source")).alias("high"), F.min("source").alias("low")).collect()
    assert sum(r.high - r.low for r in kinds) <= 3


def test_write_shards(spark):
    rows = corpus(6, 200)
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("row", F.lit("x")).withColumn("document", F.lit(1)).withColumn("a`b", F.lit(2))
    back = spark.read.parquet(sh.write_shards(docs, 5))
    assert sorted(map(str, back.select("document.*").collect())) == sorted(map(str, docs.collect()))
    assert back.select("document.*").columns == docs.columns and back.groupBy("shard", "slot").count().where("count > 1").count() == 0
    want = {(r.doc_id, r.shard, r.slot) for r in sh.assign(docs, 5).collect()}
    assert len(want) == back.count() and {r.shard for r in back.select("shard").distinct().collect()} == {0, 1, 2, 3, 4}


def test_query_on_the_given_table(spark):
    from threadlens.llm.queries import QUERIES

    got = QUERIES["op12_shards"](spark, FOLDER).collect()
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    check(got, texts, 24)


def test_native(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    plan = sh.assign(docs, 24)._jdf.queryExecution().toString()
    assert not [w for w in ("Python", "Pandas", "Arrow", "ExistingRDD") if w in plan]


def test_plans_do_not_grow_with_the_levels(spark):
    rows = sh.numbered(spark.createDataFrame(corpus(7, 100), SCHEMA))
    plans = [sh.shards(rows, n, 4)._jdf.queryExecution().optimizedPlan().toString() for n in (1, 2, 24)]
    assert [p.count("Join") for p in plans] == [0, 0, 0]
