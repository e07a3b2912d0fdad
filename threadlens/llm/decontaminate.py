"""Benchmark decontamination by winnowed fingerprints.

Texts are lower-cased (A-Z) words.  Of every six neighbouring 5-word sequences the one with the smallest hash is kept;
two texts that share ten words in a row therefore keep a common fingerprint inside them.  Fingerprints of documents and
benchmark items are joined, and each hit is extended word by word, so that hash collisions cost time and never results.
Items of fewer than ten words are looked for as a whole, with every word sequence of their length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import LOWER, blocks, byte_class, grams, hash_words, owners, staged, utf8, without, word_spans

SPAN, GRAM = 10, 5
#: Bits of the filter that documents' fingerprints pass before they leave a task: its size (4 MB) is fixed, whatever the benchmark's.
FILTER_BITS = 25
WORD = byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
CANDIDATE = "struct<fp: bigint, k: int, pos: int, lead: int, words: string>"


def winnow(hashes: np.ndarray, last: np.ndarray, window: int) -> np.ndarray:
    """Places of the rightmost smallest hash of each ``window`` neighbours; ``last``: where the text of each place ends."""
    n = len(hashes) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    least, place = hashes[:n].copy(), np.arange(n)
    for i in range(1, window):
        nearer = hashes[i : i + n] <= least
        least[nearer] = hashes[i : i + n][nearer]
        place[nearer] = np.flatnonzero(nearer) + i
    inside = np.arange(n) + window <= last[:n]
    return np.unique(place[inside])


class _Words:
    """The words of a block of texts, their hashes and what belongs to which text."""

    def __init__(self, batch: pa.RecordBatch):
        data, offsets = utf8(batch["text"])
        self.data = LOWER[data]
        self.starts, self.ends, self.first = word_spans(self.data, offsets, WORD)
        self.hashes = hash_words(self.data, self.starts, self.ends)
        self.text = owners(self.first)
        self.counts = np.diff(self.first)
        self.stop = self.first[1:][self.text]

    def sequences(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all sequences of k words, and whether each lies in one text."""
        hashes = grams(self.hashes, k)
        return hashes, np.arange(len(hashes)) + k <= self.stop[: len(hashes)]

    def kept(self) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes of the winnowed 5-word sequences."""
        hashes, _ = self.sequences(GRAM)
        places = winnow(hashes, self.stop - GRAM + 1, SPAN - GRAM + 1)
        return places, hashes[places]

    def say(self, begin: int, end: int) -> str:
        return " ".join(self.data[s:e].tobytes().decode(errors="replace") for s, e in zip(self.starts[begin:end], self.ends[begin:end], strict=True))

    def candidates(self, places: np.ndarray, hashes: np.ndarray, k: int) -> list[dict]:
        """The found sequences with the words around them, as far as a span of ten words with them can reach."""
        around, out = (SPAN - k) if k == GRAM else 0, []
        for place, h in zip(places.tolist(), hashes.view(np.int64).tolist(), strict=True):
            begin, stop = int(self.first[self.text[place]]), int(self.stop[place])
            low = max(begin, place - around)
            out.append({"fp": h, "k": k, "pos": place - begin, "lead": place - low, "words": self.say(low, min(stop, place + k + around))})
        return out


def _short(k: int) -> int:
    """Sequences of whole short items are told from winnowed ones by a negative k."""
    return -k


def item_fingerprints(items: DataFrame) -> DataFrame:
    """(fp, k, lead, words, item): winnowed sequences of long items, the whole of short ones; wordless items give none."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            w = _Words(batch)
            places, hashes = w.kept()
            found = list(zip(w.text[places].tolist(), w.candidates(places, hashes, GRAM), strict=True))
            for k in range(1, SPAN):
                texts = np.flatnonzero(w.counts == k)
                places = w.first[texts]
                rows = w.candidates(places, w.sequences(k)[0][places], k) if len(places) else []
                found += [(t, row | {"k": _short(k), "lead": 0, "words": w.say(p, p + k)}) for t, p, row in zip(texts.tolist(), places.tolist(), rows, strict=True)]
            names = batch["item"].to_pylist()
            rows = [{"fp": r["fp"], "k": r["k"], "lead": r["lead"], "words": r["words"], "item": names[t]} for t, r in found]
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("fp", pa.int64()), ("k", pa.int32()), ("lead", pa.int32()), ("words", pa.string()), ("item", pa.string())]))

    rows = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
    return rows.mapInArrow(scan, "fp bigint, k int, lead int, words string, item string").distinct()


def fingerprint_filter(prints: DataFrame) -> np.ndarray:
    """Bits at the places of the items' fingerprints: at most 2^19 numbers come to the driver, however many items there are."""
    place = F.shiftrightunsigned("fp", 64 - FILTER_BITS)
    bits = prints.groupBy(F.shiftright(place, 6).alias("at")).agg(F.bit_or(F.expr(f"shiftleft(1L, CAST(shiftrightunsigned(fp, {64 - FILTER_BITS}) & 63 AS INT))")).alias("bits"))
    found = bits.toArrow()
    out = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    out[found["at"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return out


def document_candidates(spark: SparkSession, docs: DataFrame, prints: DataFrame) -> DataFrame:
    """One row per document: row, doc_id, n_words, and the sequences that may also be in an item."""
    known = spark.sparkContext.broadcast(fingerprint_filter(prints))
    short = sorted(-r.k for r in prints.where("k < 0").select("k").distinct().collect())  # nine at most
    kind = docs.schema["doc_id"].dataType.simpleString()

    def may_match(hashes: np.ndarray) -> np.ndarray:
        place = hashes >> np.uint64(64 - FILTER_BITS)
        return (known.value[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        shape = pa.list_(pa.struct([("fp", pa.int64()), ("k", pa.int32()), ("pos", pa.int32()), ("lead", pa.int32()), ("words", pa.string())]))
        for batch in blocks(batches):
            w = _Words(batch)
            found: dict[int, list[dict]] = {}
            places, hashes = w.kept()
            at = may_match(hashes)
            looks = [(places[at], hashes[at], GRAM, GRAM)]
            for k in short:
                hashes, whole = w.sequences(k)
                at = np.flatnonzero(whole)
                at = at[may_match(hashes[at])]
                looks.append((at, hashes[at], k, _short(k)))
            for places, hashes, k, name in looks:
                for t, c in zip(w.text[places].tolist(), w.candidates(places, hashes, k), strict=True):
                    if name < 0:
                        c |= {"words": w.say(w.first[t] + c["pos"], w.first[t] + c["pos"] + k), "lead": 0}
                    found.setdefault(t, []).append(c | {"k": name})
            n = batch.num_rows
            arrays = [pa.array(np.arange(row, row + n)), batch["doc_id"], pa.array(w.counts.astype(np.int64)), pa.array([found.get(i, []) for i in range(n)], shape)]
            row += n
            yield pa.RecordBatch.from_arrays(arrays, ["row", "doc_id", "n_words", "candidates"])

    return docs.select("doc_id", "text").mapInArrow(scan, f"row bigint, doc_id {kind}, n_words bigint, candidates array<{CANDIDATE}>")


def extend(pairs: DataFrame) -> DataFrame:
    """Verified hits (row, item, begin, end) of candidate pairs: the longest run of equal words around the sequence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for p in batch.to_pylist():
                a, b, i, j = p["words"].split(" "), p["item_words"].split(" "), p["lead"], p["item_lead"]
                k = abs(p["k"])
                if a[i : i + k] != b[j : j + k]:
                    continue
                left, right = 0, k
                while left < min(i, j) and a[i - left - 1] == b[j - left - 1]:
                    left += 1
                while right < min(len(a) - i, len(b) - j) and a[i + right] == b[j + right]:
                    right += 1
                if p["k"] < 0 or left + right >= SPAN:
                    rows.append({"row": p["row"], "item": p["item"], "begin": p["pos"] - left, "end": p["pos"] + right})
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("row", pa.int64()), ("item", pa.string()), ("begin", pa.int32()), ("end", pa.int32())]))

    return pairs.mapInArrow(run, "row bigint, item string, begin int, end int").distinct()


def find_hits(docs: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents (row, doc_id, n_words) and hits (row, item, begin, end) in words, ends exclusive.

    ``docs`` needs doc_id and text, ``items`` item_id and text; other columns do not matter.  Null and empty texts have
    no words.  Repeated rows are documents of their own; items of one id count as one, a null id is the empty string.
    """
    spark = docs.sparkSession
    prints = staged(item_fingerprints(items), "items")
    rows = staged(document_candidates(spark, docs, prints), "candidates")
    looks = rows.select("row", F.explode("candidates").alias("c")).select("row", "c.*")
    keep = prints.select("fp", "k", F.col("lead").alias("item_lead"), F.col("words").alias("item_words"), "item")
    return rows.drop("candidates"), staged(extend(looks.join(keep, ["fp", "k"])), "hits")


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_hit (words in spans of an item), n_items, item ids' SHA-256, contaminated."""
    rows, hits = find_hits(docs, items)
    earlier = Window.partitionBy("row").orderBy("begin", "end").rowsBetween(Window.unboundedPreceding, -1)
    spans = hits.select("row", "begin", "end").distinct().withColumn("reached", F.coalesce(F.max("end").over(earlier), F.lit(0)))
    covered = spans.groupBy("row").agg(F.sum(F.greatest(F.lit(0), F.col("end") - F.greatest("begin", "reached"))).alias("n_hit"))
    named = hits.select("row", "item").distinct().groupBy("row").agg(F.count("*").alias("n_items"), F.array_join(F.array_sort(F.collect_list("item")), ",").alias("items"))
    found = rows.join(covered.join(named, "row"), "row", "left")
    return found.select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"),
        F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` without a hit; columns as given.

    Verdicts are by row.  Where rows that share a doc_id (or have none) differ in theirs, these rows alone are written with
    a number of their own and looked through again.
    """
    rows, hits = find_hits(docs, items)
    hit = hits.select(F.col("row").alias("at")).distinct()
    ids = rows.join(hit, F.col("row") == F.col("at"), "left").groupBy("doc_id").agg(F.count("*").alias("rows"), F.count("at").alias("bad"))
    ids = staged(ids.where("bad > 0"), "contaminated")
    kept = without(docs, ids.select("doc_id"))
    mixed = staged(ids.where("bad < rows").select(F.col("doc_id").alias("__id")), "mixed")
    if mixed.isEmpty():
        return kept
    met = docs.join(mixed, docs["doc_id"].eqNullSafe(mixed["__id"]), "left_semi")
    numbered = staged(met.select(F.monotonically_increasing_id().alias("doc_id"), "text", F.struct("*").alias("row")), "numbered")
    rows, hits = find_hits(numbered.select("doc_id", "text"), items)
    bad = staged(rows.join(hits.select("row").distinct(), "row", "left_semi").select("doc_id"), "contaminated")
    return kept.unionByName(without(numbered, bad).select("row.*"))
