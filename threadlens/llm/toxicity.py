"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton over folded text.

Folding lower-cases, strips accents and invisible characters, and maps look-alike letters and digit substitutions to
one letter, in texts and lexicon alike.  Words and word beginnings (``stem*``) that mark toxic documents are learned
from labelled rows with their log odds, phrases in which such a word is harmless are learned as exceptions, and a logistic curve over the summed
weight and the weight per hundred words turns both into a score.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import DARK, LOWER, blocks, grams, hash_words, owners, staged, utf8, word_spans

#: Labelled rows learned from at most (lowest hashes of their ids), candidate words and lexicon words at most.
MAX_LABELLED, MAX_CANDIDATES, MAX_TERMS = 200_000, 50_000, 5_000
#: Toxic documents a word must be in, the likelihood ratio statistic and the log odds it must reach.
MIN_TOXIC, MIN_G2, MIN_ODDS = 3, 25.0, 2.0
#: Lengths of word beginnings that are candidates.
STEMS = range(4, 9)
#: Words of the sequences whose smallest hash tells copies of a text.
SKETCH = 5
#: Clean documents that make a phrase an exception.
MIN_CLEAN = 3

# Look-alikes that have no decomposition to a Latin letter, and what stands for letters among digits and signs.
LOOKALIKES = {"а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ё": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "i", "м": "m", "н": "h", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "т": "t", "ԝ": "w", "х": "x", "у": "y", "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ł": "i", "ø": "o", "đ": "d", "ɡ": "g", "ɑ": "a", "ʟ": "i"}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "l": "i"}
SIGNS = {"@": "a", "$": "s"}
INVISIBLE = (0x00AD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF)
WORD = re.compile(r"[^\W\d_]+")
SIGN_IN_WORD = re.compile(r"[@$](?=[@$]*[^\W\d_])")


def _table() -> dict[int, str | None]:
    """Every character of the first planes whose decomposition is one ASCII letter, look-alikes, digits, combining marks."""
    table: dict[int, str | None] = dict.fromkeys(INVISIBLE)
    for code in [*range(0xA0, 0x3000), *range(0xFF01, 0xFF5F), *range(0x1D400, 0x1D800)]:
        if unicodedata.combining(chr(code)):
            table[code] = None
            continue
        plain = "".join(c for c in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(c)).lower()
        if len(plain) == 1 and plain != chr(code):
            table[code] = DIGITS.get(LOOKALIKES.get(plain, plain), LOOKALIKES.get(plain, plain))
    return table | {ord(k): DIGITS.get(v, v) for k, v in LOOKALIKES.items()} | {ord(k): v for k, v in DIGITS.items()}


FOLD = _table()


def fold(text: str | None) -> str:
    low = (text or "").lower().translate(FOLD)
    return SIGN_IN_WORD.sub(lambda m: SIGNS[m[0]], low) if "$" in low or "@" in low else low


@dataclass
class Lexicon:
    weights: dict[str, float] = field(default_factory=dict)
    exceptions: frozenset[tuple[str, str]] = frozenset()
    curve: tuple[float, float, float] = (-np.inf, 0.0, 0.0)

    def automaton(self) -> ahocorasick.Automaton | None:
        made = ahocorasick.Automaton()
        for term in self.weights:
            made.add_word(term.rstrip("*"), (len(term.rstrip("*")), [t for t in (term.rstrip("*"), term.rstrip("*") + "*") if t in self.weights]))
        if self.weights:
            made.make_automaton()
        return made if self.weights else None


def terms(folded: str) -> set[str]:
    """The words of a text and their beginnings, as candidates for the lexicon."""
    words = {w for w in WORD.findall(folded) if len(w) > 2}
    return words | {w[:n] + "*" for w in words for n in STEMS if len(w) > n}


def matches(folded: str, automaton: ahocorasick.Automaton | None, weights: dict[str, float]) -> list[tuple[str, str, str]]:
    """(word before, lexicon term, word behind) of each word that a term matches; of several the one of most weight."""
    found: dict[int, str] = {}
    for last, (size, names) in automaton.iter(folded) if automaton else ():
        begin, end = last - size + 1, last + 1
        if begin and folded[begin - 1].isalpha():
            continue
        inside = end < len(folded) and folded[end].isalpha()
        for term in names:
            if term.endswith("*") == inside and weights[term] > weights.get(found.get(begin, ""), -np.inf):
                found[begin] = term
    out = []
    for begin, term in sorted(found.items()):
        word = WORD.match(folded, begin)
        before, behind = WORD.findall(folded, max(0, begin - 40), begin), WORD.search(folded, word.end(), word.end() + 40)
        out.append((before[-1] if before else "", term, behind[0] if behind else ""))
    return out


def weigh(text: str | None, lexicon: Lexicon, automaton: ahocorasick.Automaton | None) -> tuple[float, float, int]:
    """Summed weight without exceptions, weight per hundred words, and the number of matches."""
    folded = fold(text)
    found = [w for b, w, a in matches(folded, automaton, lexicon.weights) if (b, w) not in lexicon.exceptions and (w, a) not in lexicon.exceptions]
    total = sum(lexicon.weights[w] for w in found)
    return total, 100 * total / max(len(folded.split()), 1) if found else 0.0, len(found)


def _shape(total: np.ndarray, density: np.ndarray) -> np.ndarray:
    return np.stack([np.ones(len(total)), np.log1p(total), np.log1p(density)], axis=1)


def fit_curve(total: np.ndarray, density: np.ndarray, toxic: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression with a small ridge, by Newton's method; without labels every score is 0."""
    if not len(toxic):
        return (-np.inf, 0.0, 0.0)
    x, beta = _shape(total, density), np.zeros(3)
    ridge = np.diag([1e-6, 1e-2, 1e-2])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + ridge, x.T @ (toxic - p) - ridge @ beta)
        beta = beta + step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(b) for b in beta)


# --- learning -------------------------------------------------------------------------


def _tally(rows: DataFrame, keys, shape: str) -> DataFrame:
    """Documents of each class in which each key occurs; ``keys`` gives the set of keys of one folded text."""
    names = [c.split()[0] for c in shape.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple, list[int]] = {}
        for batch in batches:
            for text, toxic in zip(batch["text"], batch["toxic"].to_pylist(), strict=True):
                for key in keys(fold(text.as_py())):
                    counts.setdefault(key, [0, 0])[toxic] += 1
            if len(counts) > 200_000:
                yield told(counts)
                counts = {}
        yield told(counts)

    def told(counts: dict[tuple, list[int]]) -> pa.RecordBatch:
        columns = [pa.array([k[i] for k in counts], pa.string()) for i in range(len(names))]
        return pa.RecordBatch.from_arrays([*columns, *[pa.array([v[i] for v in counts.values()], pa.int64()) for i in (0, 1)]], [*names, "clean", "toxic"])

    return rows.mapInArrow(run, f"{shape}, clean bigint, toxic bigint").groupBy(*names).agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))


def g2(a: int, n: int, b: int, m: int) -> float:
    """Likelihood ratio statistic of a of n against b of m."""
    total, out = a + b, 0.0
    for seen, size in ((a, n), (b, m)):
        for x, e in ((seen, size * total / (n + m)), (size - seen, size * (n + m - total) / (n + m))):
            out += 2 * x * np.log(x / e) if x else 0.0
    return out


def _one_of_copies(rows: DataFrame) -> DataFrame:
    """(doc_id, toxic) of one row of each group of copies, by the smallest hash of its word sequences.

    Else the words of a text that was copied a thousand times would look like a thousand documents' words.
    """
    kind = rows.schema["doc_id"].dataType.simpleString()

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            data, offsets = utf8(batch["text"])
            starts, ends, first = word_spans(LOWER[data], offsets, DARK)
            hashes = hash_words(LOWER[data], starts, ends)
            text, sequences = owners(first), grams(hashes, SKETCH)
            least = np.full(batch.num_rows, 2**64 - 1, np.uint64)
            np.minimum.at(least, text, hashes)  # for texts of fewer words
            whole = np.arange(len(sequences)) + SKETCH <= first[1:][text[: len(sequences)]]
            least[np.unique(text[: len(sequences)][whole])] = 2**64 - 1
            np.minimum.at(least, text[: len(sequences)][whole], sequences[whole])
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["toxic"], pa.array(least.view(np.int64))], ["doc_id", "toxic", "sketch"])

    sketched = rows.select("doc_id", "text", "toxic").mapInArrow(sketch, f"doc_id {kind}, toxic int, sketch bigint")
    return sketched.groupBy("sketch").agg(F.min("doc_id").alias("doc_id"), F.expr("CAST(avg(toxic) >= 0.5 AS INT)").alias("toxic")).drop("sketch")


def _told(term: str, weights: dict[str, float], odds: float) -> bool:
    """Whether stronger terms make this one needless: a beginning of it of like weight, or an end of it."""
    stem = term.rstrip("*")
    if any(weights.get(stem[:n] + "*", -np.inf) >= odds - 1 for n in STEMS if n <= len(stem)):
        return True
    return term.endswith("*") and any(w.startswith(stem) for w in weights)


def learn(docs: DataFrame, labels: DataFrame) -> Lexicon:
    """Lexicon, exceptions and curve from the rows of ``docs`` that ``labels`` (doc_id, toxic) marks 0 or 1.

    A doc_id with several marks counts as toxic if one of them says so; labels without a doc_id or mark are left out.
    Copies of a text are learned from once.  At most ``MAX_LABELLED`` labelled rows are used.
    """
    marks = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    marks = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELLED)
    marks = staged(_one_of_copies(docs.select("doc_id", "text").join(F.broadcast(marks), "doc_id")), "marks")
    rows = docs.select("doc_id", "text").join(F.broadcast(marks), "doc_id").select("text", "toxic")
    spark = docs.sparkSession
    toxic_words = _tally(rows.where("toxic = 1"), lambda t: {(w,) for w in terms(t)}, "word string")
    candidates = toxic_words.where(f"toxic >= {MIN_TOXIC}").orderBy(F.desc("toxic"), "word").limit(MAX_CANDIDATES)
    asked = spark.sparkContext.broadcast({r.word for r in candidates.select("word").collect()})
    counted = _tally(rows, lambda t: {(w,) for w in terms(t) & asked.value} | {("",)}, "word string")
    counts = {r.word: (r.toxic, r.clean) for r in counted.collect()}
    n, m = counts.pop("", (0, 0))
    odds = lambda a, b: float(np.log((a + 0.5) / (n - a + 0.5) / ((b + 0.5) / (m - b + 0.5))))
    strong = [(g2(a, n, b, m), len(w), w) for w, (a, b) in counts.items() if odds(a, b) >= MIN_ODDS]
    weights: dict[str, float] = {}
    for g, _, term in sorted(strong, reverse=True):
        if g >= MIN_G2 and len(weights) < MAX_TERMS and not _told(term, weights, odds(*counts[term])):
            weights[term] = odds(*counts[term])
    lexicon = Lexicon(weights)
    made: list = []  # the automaton, built once in each task

    def phrases(text: str) -> set[tuple[str, str]]:
        if not made:
            made.append(lexicon.automaton())
        return {p for b, w, a in matches(text, made[0], lexicon.weights) for p in ((b, w), (w, a)) if all(p)}

    harmless = _tally(rows, phrases, "first string, second string").where(f"clean >= {MIN_CLEAN}")
    harmless = harmless.orderBy(F.desc("clean"), "first", "second").limit(MAX_CANDIDATES).collect()
    lexicon.exceptions = frozenset((before, behind) for before, behind, clean, toxic in harmless if odds(toxic, clean) <= 0)
    points = _weighed(rows, lexicon, "toxic int").toArrow()
    lexicon.curve = fit_curve(*[points[c].to_numpy().astype(float) for c in ("total", "density", "toxic")])
    return lexicon


# --- scoring --------------------------------------------------------------------------


def _weighed(rows: DataFrame, lexicon: Lexicon, keep: str) -> DataFrame:
    """``total``, ``density`` and ``n_matches`` of each row beside its column ``keep``."""
    name = keep.split()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for batch in batches:
            found = [weigh(t.as_py(), lexicon, automaton) for t in batch["text"]]
            columns = [pa.array([f[i] for f in found], kind) for i, kind in enumerate((pa.float64(), pa.float64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch[name], *columns], [name, "total", "density", "n_matches"])

    return rows.select(name, "text").mapInArrow(run, f"{keep}, total double, density double, n_matches bigint")


def toxicity(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, score, predicted, n_matches.  Null and empty texts have no matches."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    a, b, c = lexicon.curve
    z = F.lit(b) * F.log1p("total") + F.lit(c) * F.log1p("density") + F.lit(a)
    score = (F.lit(0.0) if np.isinf(a) else 1 / (1 + F.exp(-z))).alias("score")
    found = _weighed(docs, lexicon, f"doc_id {kind}").select("doc_id", score, "n_matches")
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
