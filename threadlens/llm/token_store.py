"""Token ids of documents as binary shards, with a minimal perfect hash index for keyed access.

A store is a folder that all machines share:

- ``shards/part-P-S.ids``: 16 bytes of header (magic, bytes an id) and the raw little-endian ids of documents in
  ascending order of their doc_id, each with an end id; shard S of range P is closed when it reaches its size.
- ``index/bucket-B.mph``: for the keys of one bucket the levels of a minimal perfect hash (one bit for each place that
  exactly one key hits) and, at each key's rank, a 64-bit fingerprint, range, shard, offset, length and start.

A key is (doc_id, nth): nth is 0 for the first row of a doc_id and counts its repeated rows.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import blocks, byte_class, filesystem, hash_words, heads, mix, shared_path, staged, utf8

SHARD_MAGIC, INDEX_MAGIC = b"IDSHARD1", b"MPHINDX1"
#: Size at which a shard is closed, keys of an index bucket (about), and places for each key on a level.
SHARD_BYTES, BUCKET_KEYS, GAMMA = 64 << 20, 1 << 18, 2.0
END_ID = 0
SLOT = np.dtype([("mark", "<u8"), ("part", "<u4"), ("shard", "<u4"), ("offset", "<u8"), ("n", "<u8"), ("start", "<u8")])
TWO_SPACES = re.compile(r"\s\s")
#: Bytes that are white space, and first bytes of characters that may be.
SPACE = byte_class((0x09, 0x0D), (0x1C, 0x20))
ODD = byte_class((0xC2, 0xC2), (0xE1, 0xE3))
#: Letters of one byte, first bytes of U+00C0 to U+023F (letters but for two signs), and punctuation that is told apart from the letters before it (all but the apostrophe, which some tokenizers join).
LETTER = byte_class((0x41, 0x5A), (0x61, 0x7A))
WIDE_LETTERS, SIGNS = range(0xC0, 0x240), (0xD7, 0xF7)
OPENS_LETTER = byte_class((0xC3, 0xC8))
CLOSES = byte_class((0x21, 0x26), (0x28, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E))
#: What leads a piece: the text's start, a line break, a blank, letters; and what tells their keys apart.
TEXT, LINE, WORD, CLOSING = range(4)
SALTS = np.array([0, 0, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)
#: Bytes of text that are cut into pieces at once.
BLOCK_BYTES = 1 << 20
#: Pieces that a worker remembers before it forgets those not met again (about 70 bytes each), and ids of a piece, on the average.
REMEMBERED, PIECE_IDS = 400_000, 16


def _letters(data: np.ndarray) -> np.ndarray:
    """For each place the bytes before it that belong to letters up to U+023F."""
    letter = LETTER[data]
    if len(at := np.flatnonzero(OPENS_LETTER[data])):
        at = at[~np.isin((data[at].astype(np.int64) & 0x1F) << 6 | data[at + 1] & 0x3F, SIGNS)]
        letter[at] = letter[at + 1] = True
    return np.append(np.int32(0), np.cumsum(letter, dtype=np.int32))


def _split(data: np.ndarray, offsets: np.ndarray, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pieces of all texts in their order: start, end, what leads it, and its text; texts are cut at blanks and line breaks."""
    gaps = np.flatnonzero((data == 32) | (data == 10))
    starts = np.append(gaps + 1, offsets[:-1])
    order = np.argsort(starts, kind="stable")
    starts, text = starts[order], np.cumsum(order >= len(gaps)) - 1
    last = np.append(text[1:] != text[:-1], True)
    ends = np.where(last, offsets[1:][text], np.append(starts[1:], 0) - 1)
    before = np.append(data, np.uint8(0))[starts - 1]
    lead = np.where(np.append(True, last[:-1]), TEXT, np.where(before == 32, WORD, LINE))
    stem = np.maximum.accumulate(np.append(np.int32(0), np.where(CLOSES[data], np.int32(0), np.arange(1, len(data) + 1, dtype=np.int32))))[ends].astype(np.int64)
    closed = (stem > starts) & (stem < ends)
    closed[closed] = letters[stem[closed]] - letters[starts[closed]] == stem[closed] - starts[closed]
    place = np.argsort(np.append(2 * np.arange(len(starts)), 2 * np.flatnonzero(closed) + 1), kind="stable")
    ends = np.append(np.where(closed, stem, ends), ends[closed])[place]
    starts, text = np.append(starts, stem[closed])[place], np.append(text, text[closed])[place]
    return starts, ends, np.append(lead, np.full(int(closed.sum()), CLOSING))[place], text


# --- tokenizer ------------------------------------------------------------------------


class Encoder:
    """Ids of whole texts, as the tokenizer gives them, through the ids of their pieces between white space.

    A byte-level pre-tokenizer never joins anything over a blank or line break that stands alone, and takes the blank
    to what is behind it, so each distinct piece of a block of texts is encoded once.  Texts with two white space characters in
    a row or with an added token's string, and all texts of other kinds of tokenizers, are encoded as a whole.
    """

    def __init__(self, config: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import CharDelimiterSplit

        self.tokenizer = Tokenizer.from_str(config)
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.width = 2 if size <= 1 << 16 else 4
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        kind = self.tokenizer.pre_tokenizer
        self.by_piece = self.tokenizer.normalizer is None and type(kind).__name__ == "ByteLevel" and kind.use_regex and not kind.add_prefix_space
        if self.by_piece:
            vocabulary = self.tokenizer.get_vocab()
            marks = {c: self.tokenizer.encode(c, add_special_tokens=False).tokens[:1] for c in " \n"}
            # Tokens that begin with a blank, and those that begin with a line break.
            self.opens = {c: np.zeros(size, bool) for c in " \n"}
            for c, mark in marks.items():
                self.opens[c][[i for t, i in vocabulary.items() if mark and t.startswith(mark[0])]] = True
            self.line_break = self._ids(["\n"])
            # How a blank is written in the model's words; empty if it has none.
            self.blank = marks[" "][0] if type(self.tokenizer.model).__name__ == "BPE" and marks[" "] and len(marks[" "][0]) == 1 else ""
            # The model without the splitting of texts, for words in its own alphabet, and how the bytes of letters are written in that.
            self.model = Tokenizer(self.tokenizer.model)
            self.model.pre_tokenizer = CharDelimiterSplit(" ")
            self.alphabet = np.arange(256, dtype="<u4")
            for letter in map(chr, WIDE_LETTERS):
                for byte, char in zip(letter.encode(), kind.pre_tokenize_str(letter)[0][0], strict=False):
                    self.alphabet[byte] = ord(char)
            self._forget()

    def _ids(self, texts: list[str]) -> np.ndarray:
        """Ids of all texts in a row."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)] if texts else []
        return np.fromiter(chain.from_iterable(found), f"<u{self.width}", sum(map(len, found)))

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False) if texts else []
        return [np.array(e.ids, f"<u{self.width}").tobytes() for e in found]

    def _pieces(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lead: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct pieces that follow ``lead``, each with it, and where each piece's ids begin and end.

        All pieces are one text, cut at the tokens that begin with ``lead``; pieces with white space at an end, and those
        that follow letters (no lead), come alone.
        """
        odd = np.append(np.int32(0), np.cumsum(ODD[data], dtype=np.int32))
        plain = (ends > starts) & (lead != "")
        plain[plain] = ~SPACE[data[starts[plain]]] & ~SPACE[data[ends[plain] - 1]]
        for i in np.flatnonzero(plain & (odd[ends] > odd[starts])):
            piece = data[starts[i] : ends[i]].tobytes().decode()
            plain[i] = not (piece[0].isspace() or piece[-1].isspace())
        at = np.flatnonzero(plain)
        sizes = ends[at] - starts[at] + 1
        stops = np.cumsum(sizes)
        joined = np.full(int(sizes.sum()), ord(lead or " "), np.uint8)
        inner = np.arange(len(joined)) - np.repeat(stops - sizes, sizes)
        joined[inner > 0] = data[(np.repeat(starts[at], sizes) + inner - 1)[inner > 0]]
        ids = self._ids([joined.tobytes().decode()]) if len(at) else np.zeros(0, f"<u{self.width}")
        cuts = np.flatnonzero(self.opens[lead][ids]) if len(ids) else np.zeros(0, np.int64)
        if len(cuts) != len(at):
            at, ids, cuts = at[:0], ids[:0], cuts[:0]
        begin, end = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        begin[at], end[at] = cuts, np.append(cuts[1:], len(ids))
        alone = np.setdiff1d(np.arange(len(starts)), at)
        rest = [data[s:e].tobytes().decode() for s, e in zip(starts[alone], ends[alone], strict=True)]
        found = self._whole([" " + p for p in rest] if lead == " " else rest)
        if lead == "\n":
            found = [self.line_break.tobytes() + f for f in found]
        sizes = np.array([len(f) // self.width for f in found], np.int64)
        end[alone] = len(ids) + np.cumsum(sizes)
        begin[alone] = end[alone] - sizes
        return np.append(ids, np.frombuffer(b"".join(found), ids.dtype)), begin, end

    def _words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        """As ``_pieces`` for words of letters behind a blank, each of which is one word of the model; None if they can't be cut."""
        sizes = ends - starts + 2
        stops = np.cumsum(sizes)
        inner = np.arange(int(stops[-1])) - np.repeat(stops - sizes, sizes)
        joined = self.alphabet[data[np.maximum(np.repeat(starts, sizes) + inner - 2, 0)]]
        joined[inner == 0], joined[inner == 1] = ord(" "), ord(self.blank)
        ids = np.array(self.model.encode_batch_fast([joined.tobytes().decode("utf-32-le")], add_special_tokens=False)[0].ids, f"<u{self.width}")
        cuts = np.flatnonzero(self.opens[" "][ids])
        return (ids, cuts, np.append(cuts[1:], len(ids))) if len(cuts) == len(starts) and cuts[0] == 0 else None

    def _learn(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lead: np.ndarray, letters: np.ndarray, keys: np.ndarray, marks: np.ndarray) -> None:
        """Encode new pieces and remember their ids, in the order given; ``letters`` are those of ``data``."""
        begin, size = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        plain = (lead == WORD) & (ends > starts) & (letters[ends] - letters[starts] == ends - starts) & (self.blank != "")
        if plain.any() and (found := self._words(data, starts[plain], ends[plain])):
            ids, b, e = found
            begin[plain], size[plain] = b + len(self.pool), e - b
            self.pool = np.append(self.pool, ids)
        else:
            plain[:] = False
        for said, kind in ((" ", (lead == WORD) & ~plain), ("\n", (lead == TEXT) | (lead == LINE)), ("", lead == CLOSING)):
            if kind.any():
                ids, b, e = self._pieces(data, starts[kind], ends[kind], said)
                begin[kind], size[kind] = b + len(self.pool), e - b
                self.pool = np.append(self.pool, ids)
        known = len(self.keys)
        self.keys, self.marks = np.append(self.keys, keys), np.append(self.marks, marks, axis=1)
        self.begin, self.size = np.append(self.begin, begin), np.append(self.size, size)
        self.again = np.append(self.again, np.zeros(len(keys), bool))
        if 2 * len(self.keys) > len(self.table):
            self.table, known = np.full(1 << (4 * len(self.keys)).bit_length(), -1, np.int32), 0
        self._enter(known)

    def _enter(self, first: int) -> None:
        """Pieces from ``first`` on take the first free place of the table from where their key points."""
        left, last = np.arange(first, len(self.keys), dtype=np.int32), len(self.table) - 1
        at = (self.keys[first:] & np.uint64(last)).astype(np.int64)
        while len(left):
            free = self.table[at] < 0
            self.table[at[free]] = left[free]
            late = self.table[at] != left
            left, at = left[late], at[late] + 1 & last

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Which remembered piece has each key, -1 for none."""
        last = len(self.table) - 1
        at = (keys & np.uint64(last)).astype(np.int64)
        found = self.table[at]
        left = np.flatnonzero(found >= 0)
        while len(left := left[self.keys[found[left]] != keys[left]]):
            at[left] = at[left] + 1 & last
            found[left] = self.table[at[left]]
            left = left[found[left] >= 0]
        return found

    def _forget(self) -> None:
        self.keys, self.marks, self.pool = np.zeros(0, np.uint64), np.zeros((3, 0), np.uint64), np.zeros(0, f"<u{self.width}")
        self.begin = self.size = np.zeros(0, np.int64)
        self.again = np.zeros(0, bool)
        self.table = np.full(1 << (2 * REMEMBERED).bit_length(), -1, np.int32)

    def _trim(self) -> None:
        """Forget the pieces that were not met again since the last time; all, if that leaves too many."""
        kept, pool = np.flatnonzero(self.again), self.pool
        keys, marks, begin, size = self.keys[kept], self.marks[:, kept], self.begin[kept], self.size[kept]
        self._forget()
        if 2 * len(kept) <= REMEMBERED and 2 * size.sum() <= REMEMBERED * PIECE_IDS:
            stops = np.cumsum(size)
            self.pool = pool[np.arange(int(size.sum())) + np.repeat(begin - stops + size, size)]
            self.keys, self.marks, self.begin, self.size, self.again = keys, marks, stops - size, size, np.zeros(len(kept), bool)
            self._enter(0)

    def _by_piece(self, data: np.ndarray, offsets: np.ndarray) -> list[bytes] | None:
        """Ids of texts whose blanks and line breaks stand alone: each distinct piece between them is encoded once.

        None if two pieces share a hash; beyond it, pieces are compared by length and both ends.
        """
        letters = _letters(data)
        starts, ends, lead, text = _split(data, offsets, letters)
        keys = hash_words(data, starts, ends) ^ SALTS[lead]
        marks = np.stack([(ends - starts).astype(np.uint64), heads(data, starts, ends), heads(data, np.maximum(ends - 8, starts), ends)])
        if len(self.keys) > REMEMBERED or len(self.pool) > REMEMBERED * PIECE_IDS:
            self._trim()
        at = self._find(keys)
        self.again[at[at >= 0]] = True
        new = np.flatnonzero(at < 0)
        distinct, chosen, back = np.unique(keys[new], return_index=True, return_inverse=True)
        if len(new) and (marks[:, new] != marks[:, new[chosen[back]]]).any():
            return None
        at[new] = len(self.keys) + back
        if len(new):
            chosen = new[chosen]
            self._learn(data, starts[chosen], ends[chosen], lead[chosen], letters, distinct, marks[:, chosen])
        if any((mark != seen[at]).any() for mark, seen in zip(marks, self.marks, strict=True)):
            return None
        # A text's first piece has no line break before it.
        skipped = np.where(lead == TEXT, len(self.line_break), 0)
        begin, sizes = self.begin[at] + skipped, self.size[at] - skipped
        stops = np.cumsum(sizes)
        out = self.pool[np.arange(int(stops[-1])) + np.repeat(begin - stops + sizes, sizes)]
        cuts = np.append(0, stops[np.searchsorted(text, np.arange(len(offsets) - 1), "right") - 1]).tolist()
        return [out[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def _apart(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Which texts may be encoded by pieces: those without two white space characters in a row and without an added token."""
        apart = np.full(len(offsets) - 1, self.by_piece)
        if not len(data) or not self.by_piece:
            return apart
        owner = lambda at: np.searchsorted(offsets, at, "right") - 1
        space = SPACE[data]
        twice = np.flatnonzero(space[:-1] & space[1:])
        apart[(of := owner(twice))[of == owner(twice + 1)]] = False
        raw = data.tobytes()
        for i in np.unique(owner(np.flatnonzero(ODD[data]))).tolist():  # may have wide white space
            apart[i] &= not TWO_SPACES.search(raw[offsets[i] : offsets[i + 1]].decode())
        for token in (t.encode() for t in self.added):
            if token in raw:
                apart &= [token not in raw[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        return apart

    def encode(self, texts: Sequence[str] | pa.Array) -> list[bytes]:
        """Little-endian ids of each text, without an end id; null counts as empty."""
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        data, offsets = utf8(column)
        apart = self._apart(data, offsets)
        if not apart.all():
            data, offsets = utf8(column.filter(pa.array(apart)))
        cut = (self._by_piece(data, offsets) or self._whole(column.filter(pa.array(apart)).fill_null("").to_pylist())) if apart.any() else []
        whole = self._whole([] if apart.all() else column.filter(pa.array(~apart)).fill_null("").to_pylist())
        cut, whole = iter(cut), iter(whole)
        return [next(cut if a else whole) for a in apart.tolist()]


@lru_cache(1)
def worker_encoder(config: str) -> Encoder:
    """The encoder of a worker, which goes on with the pieces that its earlier tasks have met."""
    return Encoder(config)


# --- shards ---------------------------------------------------------------------------


class _Shards:
    """Files of one range; each appears under its name when it is whole, so a task that is run again replaces it."""

    def __init__(self, folder: str, part: int, width: int, limit: int):
        self.files, self.root = filesystem(folder)
        self.part, self.width, self.limit, self.number, self.held, self.out = part, width, limit, -1, 0, None

    def add(self, ids: bytes) -> tuple[int, int]:
        """Write the ids of a document; its shard and the ids before it there."""
        if self.out is None or self.held >= self.limit:
            self.close()
            self.number, self.held = self.number + 1, 0
            self.draft = f"{self.root}/drafts/{self.part}-{self.number}-{TaskContext.get().taskAttemptId()}"
            self.out = self.files.open_output_stream(self.draft)
            self.out.write(SHARD_MAGIC + np.array([self.width, 0], "<u4").tobytes())
        place = self.held // self.width
        self.out.write(ids)
        self.held += len(ids)
        return self.number, place

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            replace(self.files, self.draft, f"{self.root}/{shard_name(self.part, self.number)}")
            self.out = None


def shard_name(part: int, shard: int) -> str:
    return f"shards/part-{part:06d}-{shard:05d}.ids"


def replace(files: pafs.FileSystem, draft: str, name: str) -> None:
    if not isinstance(files, pafs.LocalFileSystem) and files.get_file_info(name).type != pafs.FileType.NotFound:
        files.delete_file(name)
    files.move(draft, name)


def write_shards(docs: DataFrame, folder: str, config: str, end_id: int = END_ID, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Encode and write all texts; rows (part, doc_id, again, shard, offset, before, n) tell where each went.

    ``again`` counts the rows of the same doc_id before it in its range, ``before`` the ids of its range before it.
    """
    spark = docs.sparkSession
    files, root = filesystem(folder)
    for name in ("shards", "drafts", "index"):
        files.create_dir(f"{root}/{name}", recursive=True)
    sent = spark.sparkContext.broadcast(config)  # the tokenizer's file, of fixed size
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["part", "doc_id", "again", "shard", "offset", "before", "n"]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = worker_encoder(sent.value), TaskContext.get().partitionId()
        shards, end = _Shards(folder, part, encoder.width, shard_bytes), np.array([end_id], f"<u{encoder.width}").tobytes()
        before, again, last = 0, -1, object()
        for batch in blocks(batches, size=BLOCK_BYTES):
            rows = []
            for key, ids in zip(batch["doc_id"].to_pylist(), encoder.encode(batch["text"]), strict=True):
                again, last = again + 1 if key == last else 0, key
                n = len(ids) // encoder.width + 1
                rows.append((again, *shards.add(ids + end), before, n))
                before += n
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([part] * len(rows), pa.int32()), batch["doc_id"], *columns], names)
        shards.close()

    ranged = docs.select("doc_id", F.xxhash64("text").alias("salt"), "text").repartitionByRange("doc_id", "salt").sortWithinPartitions("doc_id", "salt")
    return ranged.select("doc_id", "text").mapInArrow(write, f"part int, doc_id {kind}, again bigint, shard int, offset bigint, before bigint, n bigint")


# --- index ----------------------------------------------------------------------------


def _level(keys: np.ndarray, marks: np.ndarray, level: int, places: int) -> np.ndarray:
    return (mix(keys ^ mix(marks + np.uint64(level))) % np.uint64(places)).astype(np.int64)


def build_hash(keys: np.ndarray, marks: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Levels of bits and the rank of each key: a number below ``len(keys)`` that no other key has."""
    ranks, left, levels, done = np.zeros(len(keys), np.int64), np.arange(len(keys)), [], 0
    while len(left):
        if len(levels) > 200:
            raise ValueError("two keys have the same hashes")
        places = max(64, int(GAMMA * len(left)))
        at = _level(keys[left], marks[left], len(levels), places)
        bits = np.bincount(at, minlength=places) == 1
        alone = bits[at]
        ranks[left[alone]] = done + (np.cumsum(bits) - 1)[at[alone]]
        done += int(bits.sum())
        left = left[~alone]
        levels.append(bits)
    return levels, ranks


class Index:
    """One bucket: bits of all levels with a count for every 512 of them, and the slots."""

    def __init__(self, raw: bytes):
        if raw[:8] != INDEX_MAGIC:
            raise ValueError("not an index bucket")
        keys, levels = (int(x) for x in np.frombuffer(raw, "<u8", 2, 8))
        self.places = np.frombuffer(raw, "<u8", levels, 24).astype(np.int64)
        at = 24 + 8 * levels
        self.starts = np.concatenate([[0], np.cumsum(self.places)])
        size = -(-int(self.starts[-1]) // 8)
        self.packed = np.frombuffer(raw, np.uint8, size, at)
        padded = np.concatenate([self.packed, np.zeros(-size % 64 + 64, np.uint8)])
        self.words = padded.view("<u8")
        self.counts = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words).reshape(-1, 8).sum(axis=1, dtype=np.int64))])
        self.slots = np.frombuffer(raw, SLOT, keys, at + size)

    @staticmethod
    def pack(keys: np.ndarray, slots: np.ndarray) -> bytes:
        levels, ranks = build_hash(keys, slots["mark"])
        ordered = np.empty_like(slots)
        ordered[ranks] = slots
        bits = np.packbits(np.concatenate(levels) if levels else np.zeros(0, bool), bitorder="little")
        head = np.array([len(keys), len(levels), *map(len, levels)], "<u8").tobytes()
        return INDEX_MAGIC + head + bits.tobytes() + ordered.tobytes()

    def _rank(self, bit: np.ndarray) -> np.ndarray:
        word, block = bit >> 6, bit >> 9
        rank = self.counts[block]
        for i in range(8):  # words of the block before the bit's
            earlier = (block << 3) + i < word
            rank = rank + np.where(earlier, np.bitwise_count(self.words[(block << 3) + i]), 0)
        below = self.words[word] & ((np.uint64(1) << (bit & 63).astype(np.uint64)) - np.uint64(1))
        return rank + np.bitwise_count(below)

    def find(self, keys: np.ndarray, marks: np.ndarray) -> np.ndarray:
        """Slot number of each key, -1 for keys that are not in the store: a bounded number of probes, then one slot."""
        out, left = np.full(len(keys), -1), np.arange(len(keys))
        for level, places in enumerate(self.places):
            bit = self.starts[level] + _level(keys[left], marks[left], level, int(places))
            hit = (self.words[bit >> 6] >> (bit & 63).astype(np.uint64)) & np.uint64(1) == 1
            out[left[hit]] = self._rank(bit[hit])
            left = left[~hit]
        found = out >= 0
        out[found] = np.where(self.slots["mark"][out[found]] == marks[found], out[found], -1)
        return out


def _hashed(keys: DataFrame, buckets: int) -> DataFrame:
    """Keys (doc_id, nth) with their two hashes and their bucket."""
    hashed = keys.withColumn("key", F.xxhash64("nth", "doc_id")).withColumn("mark", F.xxhash64("doc_id", "nth", F.lit("mark")))
    return hashed.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int"))


def by_bucket(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[int, pa.Table]]:
    """Sorted rows as one table for each run of equal values."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        values = batch[column].to_numpy()
        cuts = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if a == b:
                continue
            if held and held[0][column][0].as_py() != values[a]:
                yield held[0][column][0].as_py(), pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield held[0][column][0].as_py(), pa.Table.from_batches(held)


def write_index(entries: DataFrame, folder: str, buckets: int) -> DataFrame:
    """Write all buckets of entries (doc_id, nth, part, shard, offset, n, start); rows (bucket, keys) of what was written."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = filesystem(folder)
        for bucket, rows in by_bucket(batches, "bucket"):
            slots = np.zeros(rows.num_rows, SLOT)
            for name in SLOT.names:
                slots[name] = rows[name].to_numpy().view(np.uint64) if name == "mark" else rows[name].to_numpy()
            draft = f"{root}/drafts/index-{bucket}-{TaskContext.get().taskAttemptId()}"
            with files.open_output_stream(draft) as out:
                out.write(Index.pack(rows["key"].to_numpy().view(np.uint64), slots))
            replace(files, draft, f"{root}/index/bucket-{bucket:07d}.mph")
            yield pa.RecordBatch.from_pydict({"bucket": pa.array([bucket], pa.int32()), "keys": pa.array([rows.num_rows], pa.int64())})

    rows = _hashed(entries, buckets).select("bucket", "key", "mark", "part", "shard", "offset", "n", "start")
    return rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(write, "bucket int, keys bigint")


# --- the store --------------------------------------------------------------------------


class Store:
    """A written store: its folder, number of buckets and of documents."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int, documents: int):
        self.spark, self.folder, self.buckets, self.documents = spark, folder, buckets, documents

    def locate(self, keys: DataFrame) -> DataFrame:
        """(doc_id, nth, part, shard, offset, n, start) of the keys (doc_id, nth) that the store has."""
        folder, kind = self.folder, keys.schema["doc_id"].dataType.simpleString()

        def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            files, root = filesystem(folder)
            for bucket, rows in by_bucket(batches, "bucket"):
                name = f"{root}/index/bucket-{bucket:07d}.mph"
                if files.get_file_info(name).type == pafs.FileType.NotFound:
                    continue
                with files.open_input_stream(name) as source:
                    index = Index(source.read())
                at = index.find(rows["key"].to_numpy().view(np.uint64), rows["mark"].to_numpy().view(np.uint64))
                slots, kept = index.slots[at[at >= 0]], rows.filter(pa.array(at >= 0))
                found = [pa.array(slots[c].astype(np.int64)) for c in ("part", "shard", "offset", "n", "start")]
                names = ["doc_id", "nth", "part", "shard", "offset", "n", "start"]
                yield from pa.table([kept["doc_id"], kept["nth"], *found], names).combine_chunks().to_batches()

        asked = _hashed(keys.select("doc_id", F.col("nth").cast("bigint").alias("nth")), self.buckets)
        shape = f"doc_id {kind}, nth bigint, part bigint, shard bigint, offset bigint, n bigint, start bigint"
        return asked.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(look, shape)

    def _read(self, keys: DataFrame, column: str, kind: pa.DataType, spark_kind: str, make) -> DataFrame:
        """Located keys with ``make`` of each document's ids; each shard is read front to back."""
        folder, id_kind = self.folder, keys.schema["doc_id"].dataType.simpleString()

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            files, root = filesystem(folder)
            name, source, width = None, None, 0
            for batch in batches:
                out = []
                for part, shard, offset, n in zip(*(batch[c].to_pylist() for c in ("part", "shard", "offset", "n")), strict=True):
                    if name != (part, shard):
                        source = files.open_input_file(f"{root}/{shard_name(part, shard)}")
                        name, head = (part, shard), source.read_at(16, 0)
                        if head[:8] != SHARD_MAGIC:
                            raise ValueError(f"not a shard: {name}")
                        width = int(np.frombuffer(head, "<u4", 1, 8)[0])
                    raw = source.read_at(n * width, 16 + offset * width)
                    if len(raw) != n * width:
                        raise ValueError(f"shard {name} is cut short")
                    out.append(make(np.frombuffer(raw, f"<u{width}").astype("<u4")))
                yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["nth"], batch["start"], batch["n"], pa.array(out, kind)], ["doc_id", "nth", "start", "n_tokens", column])

        places = self.locate(keys).repartition("part", "shard").sortWithinPartitions("part", "shard", "offset")
        return places.mapInArrow(read, f"doc_id {id_kind}, nth bigint, start bigint, n_tokens bigint, {column} {spark_kind}")

    def ids(self, keys: DataFrame) -> DataFrame:
        """The ids of the documents of ``keys`` (doc_id, nth), with their end id."""
        return self._read(keys, "ids", pa.list_(pa.int64()), "array<bigint>", lambda ids: ids.astype(np.int64))

    def checksums(self, keys: DataFrame) -> DataFrame:
        """CRC-32 of the ids as little-endian 32-bit numbers."""
        return self._read(keys, "ids_crc32", pa.int64(), "bigint", lambda ids: zlib.crc32(ids.tobytes()))


def keys_of(docs: DataFrame) -> DataFrame:
    """All keys (doc_id, nth) of a table, counted before they are sent anywhere."""
    return docs.groupBy("doc_id").agg(F.count("*").alias("rows")).selectExpr("doc_id", "explode(sequence(0L, rows - 1)) AS nth")


def write_store(docs: DataFrame, tokenizer: str, folder: str | None = None, shard_bytes: int = SHARD_BYTES, bucket_keys: int = BUCKET_KEYS) -> Store:
    """Write the ids of all whole texts of ``docs`` (doc_id, text) and their index.

    ``tokenizer`` is the path of a tokenizers JSON file on the driver, ``folder`` defaults to a fresh one below
    ``spark.checkpoint.dir``.  Null and empty texts have the end id only; rows without a doc_id come first, under a null
    key; repeated rows are kept, the nth under (doc_id, nth).
    """
    spark = docs.sparkSession
    folder = folder or shared_path(spark, "store")
    with open(tokenizer, encoding="utf-8") as source:
        rows = staged(write_shards(docs, folder, source.read(), shard_bytes=shard_bytes), "written")
    # One number for each range: ids before it.
    totals = rows.groupBy("part").agg(F.sum("n").alias("n"), F.count("*").alias("rows")).orderBy("part").collect()
    starts = np.concatenate([[0], np.cumsum([t.n for t in totals])]).astype(int).tolist()
    base = spark.createDataFrame([(t.part, s) for t, s in zip(totals, starts, strict=False)], "part int, base bigint")
    # Rows of a doc_id that go on in another range are counted from where the range before left off.
    counts = rows.groupBy("doc_id", "part").agg(F.count("*").alias("held"))
    over = Window.partitionBy("doc_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    split = counts.where(F.col("held") > 0).withColumn("earlier", F.sum("held").over(over)).where("earlier > 0").drop("held")
    split = staged(split.withColumnRenamed("doc_id", "id"), "split")
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("part") == F.col("in_part"))
    entries = rows.join(split.withColumnRenamed("part", "in_part"), same, "left").join(F.broadcast(base), "part")
    entries = entries.select("doc_id", (F.col("again") + F.coalesce("earlier", F.lit(0))).alias("nth"), "part", "shard", "offset", "n", (F.col("base") + F.col("before")).alias("start"))
    documents = sum(t.rows for t in totals)
    buckets = max(1, -(-documents // bucket_keys))
    written = staged(write_index(entries, folder, buckets), "buckets").agg(F.sum("keys")).first()[0] or 0
    if written != documents:
        raise RuntimeError(f"index holds {written} of {documents} documents")
    return Store(spark, folder, buckets, documents)
