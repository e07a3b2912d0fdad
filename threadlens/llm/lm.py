"""Language-model scores by logistic context mixing over the bits of tokens.

A text is its lower-cased tokens, each closed by a blank byte, and an end byte.  Every bit of every byte is predicted in
several hashed contexts (the last one to four bytes, and the whole token so far), each with counts
of how often it was 0 and 1 in the training texts.  Weights that are gated by how much the contexts have seen mix the
predictions in the logistic domain, and an adaptive table refines the result.

Of running text (``over_blanks``), the last bytes are those of the text: at the first four bytes of a token they reach into the tokens before
it, so each of these bytes is a step (four bytes, the byte after them and its place in the token) that is scored where it stands in its text.
From the fifth byte on no context leaves the token, and its bits are computed once per distinct token of the corpus.  Tokens of over 32 bytes are
units of 32; the token so far begins anew with each, the last bytes run on.  Without ``over_blanks`` all contexts begin anew with each unit, and
a text's score is a sum over its tokens, whatever their order.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import release
from .common import DARK, LOWER, blocks, mix, staged, utf8, word_spans

#: First slot of the contexts of one, two and three bytes, of the whole of a short token and of four bytes of running text, and the end.  Fixed sizes.
SLOTS = np.cumsum([0, 1 << 16, 1 << 18, 1 << 18, 1 << 20, 1 << 21])
#: Bytes from which the whole token so far is counted exactly, among all tokens that begin with these bytes.
STEM = 4
#: Bytes of the units that longer tokens are cut into.
UNIT = 32
#: Distinct training units of a group that weights are learned on, about; all groups are learned on, and their weights are averaged.
GROUP_UNITS = 100_000
#: Most frequent tokens whose scores go to every task (about 10 MB); all others are joined.
HEAD = 1 << 18
#: Distinct keys a task holds before it sends counts, and bits that are worked on at once.
HELD, CHUNK_BITS = 1_000_000, 400_000
#: Slots whose sums leave a task together.
SLOT_BLOCK = 1 << 16
TERMINATOR, END = 0x20, 0x0A
PRIOR, LIMIT = 0.4, 12.0
#: Gates: bytes of the token so far (0 to 4 and more) by the logarithm of how often the longest context was seen.
SEEN = 14
GATES, STEPS = (STEM + 1) * SEEN, 33
#: Passes over all steps in which the weights of their gates are fitted, at most, and how much a weight is held where it began (in bits seen).
PASSES, HOLD = 10, 1.0
#: Gates that learn from single tokens; of running text all do.  Short contexts seen over a hundred times stand for themselves: few tokens of very unequal weight meet them,
#: and online steps do harm there.
LEARNING = np.array([g // SEEN == STEM or g % SEEN < 7 for g in range(GATES)])


# --- tokens -----------------------------------------------------------------------------


def tokens_of(batch: pa.RecordBatch) -> tuple[pa.Array, np.ndarray]:
    """Tokens of all texts of a batch (the end is the empty token) and the row of each."""
    data, offsets = utf8(batch["text"])
    text = pa.LargeStringArray.from_buffers(batch.num_rows, pa.py_buffer(offsets.tobytes()), pa.py_buffer(LOWER[data].tobytes()))
    lists = pc.ascii_split_whitespace(text)
    words, owner = lists.flatten(), pc.list_parent_indices(lists).to_numpy()
    kept = pc.not_equal(words, "")
    words, owner = words.filter(kept), owner[kept.to_numpy(zero_copy_only=False)]
    ends = pa.array([""] * batch.num_rows, words.type)
    return pa.concat_arrays([words, ends]).cast(pa.large_binary()), np.concatenate([owner, np.arange(batch.num_rows)])


def count_tokens(docs: DataFrame, held: str = "held_out") -> DataFrame:
    """(token, trained, seen): occurrences of each distinct token in training texts and in all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, rows = [], 0
        for batch in blocks(batches):
            words, owner = tokens_of(batch)
            coded = words.dictionary_encode()
            code, free = coded.indices.to_numpy(), ~batch[held].to_numpy(zero_copy_only=False)
            sums = [np.bincount(code, w, len(coded.dictionary)).astype(np.int64) for w in (free[owner].astype(float), None)]
            parts.append(pa.table([coded.dictionary.cast(pa.binary()), *map(pa.array, sums)], ["token", "trained", "seen"]))
            rows += parts[-1].num_rows
            if rows > HELD // 2:
                parts = [_summed(parts)]
                rows = parts[0].num_rows
                if rows > HELD // 4:
                    yield from parts[0].to_batches()
                    parts, rows = [], 0
        if parts:
            yield from _summed(parts).to_batches()

    rows = docs.select("text", held).mapInArrow(count, "token binary, trained bigint, seen bigint")
    return rows.groupBy("token").agg(F.sum("trained").alias("trained"), F.sum("seen").alias("seen"))


def _summed(parts: list[pa.Table]) -> pa.Table:
    joined = pa.concat_tables(parts).group_by("token").aggregate([("trained", "sum"), ("seen", "sum")])
    return joined.select(["token", "trained_sum", "seen_sum"]).rename_columns(["token", "trained", "seen"]).combine_chunks()


def beginnings(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The beginnings of all units of all texts of a batch, and the row of each.

    A beginning is a number: the four bytes before the unit and its first four, or fewer if it ends before.  A text begins as if behind zeros and a blank.
    """
    data, offsets = utf8(batch["text"])
    n = batch.num_rows
    starts, ends, first = word_spans(data, offsets, DARK)
    size = np.insert(ends - starts, first[1:], 0)
    owner = np.repeat(np.arange(n), np.diff(first) + 1)
    begin = np.cumsum(size + 1) - size - 1 + STEM * (owner + 1)
    stream = np.full(int((size + 1).sum()) + STEM * n + 8, TERMINATOR, np.uint8)
    word = np.ones(len(stream), bool)
    word[-8:] = False
    word[begin + size] = False
    front = begin[first[:-1] + np.arange(n)][:, None] - STEM + np.arange(STEM)
    word[front] = False
    stream[front[:, :-1]] = 0
    stream[(begin + size)[first[1:] + np.arange(n)]] = END
    stream[word] = LOWER[data[DARK[data]]]
    units = np.maximum(1, -(-size // UNIT))
    if units.max(initial=1) > 1:
        skipped = UNIT * (np.arange(units.sum()) - np.repeat(np.cumsum(units) - units, units))
        begin, size, owner = (np.repeat(a, units) for a in (begin, size, owner))
        begin, size = begin + skipped, size - skipped
    eights = np.lib.stride_tricks.sliding_window_view(stream, 8)
    return np.ascontiguousarray(eights[begin - STEM]).view("<u8")[:, 0] & LONG[np.minimum(size, STEM - 1)], owner


#: What is kept of a beginning whose unit has so many bytes and a closing one.
LONG = np.array([(1 << 8 * (STEM + 1 + n)) - 1 for n in range(STEM)], np.uint64)


def steps_from(beginning: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The steps of beginnings and the place of each one's beginning.

    A step is a number: five bytes, the last of them the one that is predicted, and its place in the unit.
    """
    steps, places, there = [], [], np.arange(len(beginning))
    for depth in range(STEM):
        step = beginning[there] >> np.uint64(8 * depth) & np.uint64((1 << 40) - 1)
        steps.append(step | np.uint64(depth << 40))
        places.append(there)
        # No token holds a closing byte.
        byte = step >> np.uint64(32)
        there = there[(byte != TERMINATOR) & (byte != END)]
    return np.concatenate(steps), np.concatenate(places)


def count_steps(docs: DataFrame, held: str = "held_out") -> DataFrame:
    """(step, n): occurrences of each distinct step in training texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, rows = [], 0
        for batch in blocks(batches):
            beginning, n = np.unique(beginnings(batch)[0], return_counts=True)
            step, place = steps_from(beginning)
            parts.append(_sum_keys([(step, n[place])]))
            rows += len(parts[-1][0])
            if rows > HELD:
                parts = [_sum_keys(parts)]
                rows = len(parts[0][0])
                if rows > HELD // 2:
                    yield told(parts)
                    parts, rows = [], 0
        if parts:
            yield told(parts)

    def told(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        step, n = _sum_keys(parts)
        return pa.RecordBatch.from_arrays([pa.array(step.view(np.int64)), pa.array(n.astype(np.int64))], ["step", "n"])

    rows = docs.where(~F.col(held)).select("text").mapInArrow(count, "step bigint, n bigint")
    return rows.groupBy("step").agg(F.sum("n").alias("n"))


# --- bits and contexts ------------------------------------------------------------------


@dataclass
class Bits:
    """All bits of a list of tokens, eight for each byte with its closing byte."""

    token: np.ndarray  # of each byte
    bit: np.ndarray  # bytes x 8
    slots: np.ndarray  # 4 (of steps 5, from the fifth byte on 3) x bytes x 8: places in the shared tables
    exact: np.ndarray  # bytes x 8: hash of the whole token so far, 0 before STEM bytes
    depth: np.ndarray  # of each byte: bytes of its token before it


STEP = 0x9E3779B97F4A7C15


@dataclass
class Window:
    """Bytes of some tokens, with their closing bytes, at some depths."""

    data: np.ndarray
    token: np.ndarray
    depth: np.ndarray
    before: np.ndarray  # 4 x bytes: the bytes before each, 0 in front of the token
    own: np.ndarray  # hash of the token up to each byte


def closed(token: bytes) -> bytes:
    """The unit of a short token: its bytes and a blank; of the empty token, the end of a text, the end byte."""
    return token + bytes([TERMINATOR]) if token else bytes([END])


def windows(tokens: list[bytes]) -> Iterator[Window]:
    """All bytes of the units, cut by depth so that about ``CHUNK_BITS`` bits are together, however many share a stem."""
    said = tokens
    sizes = np.array([len(s) for s in said], np.int64)
    alive, low, carry = np.arange(len(said)), 0, np.zeros(len(said), np.uint64)
    while len(alive):
        high = int(sizes.max()) if 8 * sizes[alive].sum() <= 2 * CHUNK_BITS and not low else low + max(1, CHUNK_BITS // (8 * len(alive)))
        back = min(low, 4)
        pieces = [said[i][low - back : high] for i in alive.tolist()]
        data = np.frombuffer(b"".join(pieces), np.uint8)
        length = np.array([len(p) for p in pieces], np.int64)
        begin = np.repeat(np.cumsum(length) - length, length)
        token, depth = np.repeat(alive, length), np.arange(len(data)) - begin + low - back
        before = np.zeros((4, len(data)), np.uint64)
        for i in range(4):
            before[i, i + 1 :] = np.where(depth[i + 1 :] > i, data[: max(0, len(data) - i - 1)], 0)
        powers = np.cumprod(np.full(len(data) + 1, STEP, np.uint64))
        inverse = np.cumprod(np.full(len(data) + 1, pow(STEP, -1, 2**64), np.uint64))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:-1])])
        first, shift = begin + back, np.uint64(pow(STEP, low, 2**64))
        own = carry[token] + (sums[:-1] - sums[first]) * inverse[first] * shift
        ends = np.cumsum(length)
        starts = ends - length + back
        carry[alive] += (sums[ends] - sums[starts]) * inverse[starts] * shift
        new = depth >= low
        yield Window(data[new], token[new], depth[new], before[:, new], own[new])
        low = high
        alive = alive[sizes[alive] > low]


def _contexts(before: np.ndarray) -> Iterator[np.ndarray]:
    """The last one to four bytes as one number each."""
    context = np.zeros(before.shape[1], np.uint64)
    for i in range(len(before)):
        context = context | (before[i] << np.uint64(8 * i))
        yield context


def _slots(order: int, context: np.ndarray, node: np.ndarray) -> np.ndarray:
    """Places of (context, bits of the byte so far) in the shared tables."""
    if order == 0:
        return ((context << np.uint64(8)) | node).astype(np.int32)
    at = mix((context * np.uint64(257) + np.uint64(order)) * np.uint64(512) + node)
    return (at % np.uint64(SLOTS[order + 1] - SLOTS[order])).astype(np.int32) + np.int32(SLOTS[order])


SHIFT = np.arange(8)


def _nodes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each byte its eight bits, and for each of them the bits before it behind a leading one."""
    wide = data[:, None].astype(np.int64)
    return ((wide >> (7 - SHIFT)) & 1).astype(np.int8), ((1 << SHIFT) | (wide >> (8 - SHIFT))).astype(np.uint64)


def _bits(w: Window, orders: int = 4) -> Bits:
    bit, node = _nodes(w.data)
    slots = np.stack([_slots(i, context[:, None], node) for i, context in enumerate(_contexts(w.before[:orders]))])
    exact = np.where(w.depth[:, None] >= STEM, mix(w.own[:, None] ^ mix(node + np.uint64(7))) | np.uint64(1), np.uint64(0))
    return Bits(w.token, bit, slots, exact, w.depth)


def _step_contexts(steps: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Of each step the byte, its place in the unit, and the contexts of each order: three, the token so far, and four bytes."""
    data, depth = (steps >> np.uint64(32) & np.uint64(255)).astype(np.uint8), (steps >> np.uint64(40)).astype(np.int64)
    before = np.stack([steps >> np.uint64(24 - 8 * i) & np.uint64(255) for i in range(4)])
    *three, four = _contexts(before)
    *_, begun = _contexts(np.where(np.arange(4)[:, None] < depth, before, np.uint64(0)))
    return data, depth, [*three, begun, four]


def bits_of_steps(steps: np.ndarray) -> Bits:
    data, depth, contexts = _step_contexts(steps)
    bit, node = _nodes(data)
    slots = np.stack([_slots(i, context[:, None], node) for i, context in enumerate(contexts)])
    return Bits(np.arange(len(steps)), bit, slots, np.zeros(bit.shape, np.uint64), depth)


def bits_of(tokens: list[bytes]) -> Iterator[Bits]:
    return map(_bits, windows(tokens))


def steps_of(tokens: list[bytes], deep: bool = False) -> Iterator[tuple[Bits, np.ndarray, np.ndarray]]:
    """Bits of the distinct steps (a beginning and the byte after it), and for each byte of the tokens its step and its token.

    Tokens that begin alike share their steps, so contexts are looked up once for all of them.  If ``deep``, only from the fifth byte on.
    """
    for w in windows([t if len(t) > STEM else b"" for t in tokens] if deep else tokens):
        if deep:
            inner = w.depth >= STEM
            if not inner.any():
                continue
            w = Window(w.data[inner], w.token[inner], w.depth[inner], w.before[:, inner], w.own[inner])
        _, first, back = np.unique(mix(w.own ^ mix(w.data.astype(np.uint64) + np.uint64(7))), return_index=True, return_inverse=True)
        yield _bits(Window(w.data[first], np.arange(len(first)), w.depth[first], w.before[:, first], w.own[first]), 3 if deep else 4), back, w.token


def _sum_keys(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, back = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(back, np.concatenate([n for _, n in parts]), len(keys))


def shared_counts(units: DataFrame, steps: DataFrame | None = None) -> np.ndarray:
    """How often each slot's bit was 0 and 1 in training: 2 x slots.

    Bytes are counted behind their contexts first, over all units; only then are they cut into bits and hashed.  If the ``steps``
    (step, n) of running text are given, the first bytes of the units are counted by these.
    """
    running = steps is not None

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            for part in _chunks(batch.to_pydict()):
                trained = np.array(part["trained"], float)
                for w in windows(part["token"]):
                    weight, short = trained[w.token], w.depth < STEM
                    found = [((np.uint64(i) << np.uint64(40)) | (c << np.uint64(8)) | w.data, weight) for i, c in enumerate(_contexts(w.before))]
                    if not running:
                        parts.append(_sum_keys([*found[:3], (found[3][0][short], weight[short])]))
                    else:
                        parts.append(_sum_keys([(key[~short], n[~short]) for key, n in found[:3]]))
                    held += len(parts[-1][0])
            if held > HELD:
                parts = [_sum_keys(parts)]
                held = len(parts[0][0])
                if held > HELD // 2:
                    yield told(parts)
                    parts, held = [], 0
        if parts:
            yield told(parts)

    def told(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        keys, n = _sum_keys(parts)
        return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], ["key", "n"])

    def of_steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, _, contexts = _step_contexts(batch["step"].to_numpy().view(np.uint64))
            n = batch["n"].to_numpy().astype(float)
            yield told([((np.uint64(i) << np.uint64(40)) | (c << np.uint64(8)) | data, n) for i, c in enumerate(contexts)])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, SLOTS[-1]))
        for batch in batches:
            keys, n = batch["key"].to_numpy().view(np.uint64), np.repeat(batch["n"].to_numpy(), 8)
            order, context = (keys >> np.uint64(40)).astype(np.int64), (keys >> np.uint64(8)) & np.uint64(0xFFFFFFFF)
            bit, node = _nodes((keys & np.uint64(255)).astype(np.uint8))
            at = np.zeros(bit.shape, np.int32)
            for i in range(len(SLOTS) - 1):
                at[order == i] = _slots(i, context[order == i][:, None], node[order == i])
            for value in (0, 1):
                chosen = bit.ravel() == value
                np.add.at(total[value], at.ravel()[chosen], n[chosen])
        # Only slots that were met leave a task, so many small tasks send no more than a few large ones.
        for i in range(0, total.shape[1], SLOT_BLOCK):
            at = np.flatnonzero(total[:, i : i + SLOT_BLOCK].any(axis=0)) + i
            if len(at):
                yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), *map(pa.array, total[:, at])], ["slot", "zeros", "ones"])

    pairs = units.where("trained > 0").select(F.col("unit").alias("token"), "trained").mapInArrow(count, "key bigint, n double")
    if running:
        pairs = pairs.unionByName(steps.mapInArrow(of_steps, "key bigint, n double"))
    pairs = pairs.groupBy("key").agg(F.sum("n").alias("n"))
    rows = pairs.mapInArrow(hashed, "slot int, zeros double, ones double")
    found = rows.groupBy("slot").agg(*[F.sum(c).cast("float").alias(c) for c in ("zeros", "ones")]).toArrow()
    out = np.zeros((2, SLOTS[-1]), np.float32)
    out[:, found["slot"].to_numpy()] = [found["zeros"].to_numpy(), found["ones"].to_numpy()]
    return out


def _chunks(columns: dict[str, list]) -> Iterator[dict[str, list]]:
    """Rows in order, cut so that about ``CHUNK_BITS`` bits are together and tokens of one stem stay together."""
    tokens, begin, size = columns["token"], 0, 0
    for i, t in enumerate(tokens):
        if size > CHUNK_BITS and t[:STEM] != tokens[i - 1][:STEM]:
            yield {k: v[begin:i] for k, v in columns.items()}
            begin, size = i, 0
        size += 8 * len(t)
    if begin < len(tokens):
        yield {k: v[begin:] for k, v in columns.items()}


def _stems(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
    """Chunks of sorted rows in which every stem is whole, also over the borders of batches."""
    release()
    rest: dict[str, list] = {}
    for batch in batches:
        new = batch.to_pydict()
        rest = {k: rest.get(k, []) + v for k, v in new.items()}
        if sum(map(len, rest["token"])) * 8 < CHUNK_BITS:
            continue
        last = rest["token"][-1][:STEM]
        cut = len(rest["token"])
        while cut and rest["token"][cut - 1][:STEM] == last:
            cut -= 1
        yield from _chunks({k: v[:cut] for k, v in rest.items()})
        rest = {k: v[cut:] for k, v in rest.items()}
    if rest:
        yield from _chunks(rest)


# --- mixing -----------------------------------------------------------------------------


def inputs(bits: Bits, counts: np.ndarray, trained: np.ndarray, leave_out: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretched predictions (bits x 6, the last constant), gate and value of every bit.

    With ``leave_out`` each token is predicted without one of its own occurrences, as a new text would meet it.
    """
    value = bits.bit.ravel()
    own = np.repeat((trained[bits.token] > 0).astype(np.float32), 8) if leave_out else 0.0
    stretched = np.ones((len(value), 6), np.float32)
    for i in range(min(4, len(bits.slots))):
        both = [np.maximum(counts[v, bits.slots[i].ravel()] - own * (value == v), 0) for v in (0, 1)]
        stretched[:, i] = np.log((both[1] + PRIOR) / (both[0] + PRIOR))
    exact = bits.exact.ravel()
    known = np.flatnonzero(exact)
    stretched[known, 3] = 0
    stretched[:, 4] = 0
    if len(bits.slots) > 4:
        both = [np.maximum(counts[v, bits.slots[4].ravel()] - own * (value == v), 0) for v in (0, 1)]
        stretched[:, 4] = np.log((both[1] + PRIOR) / (both[0] + PRIOR))
    seen = both[0] + both[1]
    gate = np.minimum(np.log2(seen + 1), SEEN - 1).astype(np.int64) + np.repeat(np.minimum(bits.depth, STEM), 8) * SEEN
    if len(known):
        _, back = np.unique(exact[known], return_inverse=True)
        weight = np.repeat(trained[bits.token].astype(float), 8)[known]
        both = np.stack([np.bincount(back, weight * (value[known] == v))[back] - (own if np.isscalar(own) else own[known]) * (value[known] == v) for v in (0, 1)])
        stretched[known, 4] = np.log((both[1] + PRIOR) / (both[0] + PRIOR))
        gate[known] = STEM * SEEN + np.minimum(np.log2(both.sum(axis=0) + 1), SEEN - 1).astype(np.int64)
    return stretched, gate, value


@dataclass
class Mixer:
    weights: np.ndarray  # gates x 6
    refined: np.ndarray  # gates x steps: stretched probability of a one
    learning: np.ndarray = field(default_factory=LEARNING.copy)

    @classmethod
    def fresh(cls) -> Mixer:
        weights = np.zeros((GATES, 6))
        weights[: STEM * SEEN, STEM - 1] = 1  # the longest context; training moves weight to the others
        weights[STEM * SEEN :, STEM] = 1
        return cls(weights, np.tile(np.linspace(-LIMIT, LIMIT, STEPS), (GATES, 1)))

    def mixed(self, x: np.ndarray, gate: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x), np.float32)
        for i in range(6):
            total += x[:, i] * self.weights[:, i].astype(np.float32)[gate]
        return np.clip(total, -LIMIT, LIMIT)

    def learn(self, x: np.ndarray, gate: np.ndarray, value: np.ndarray, weight: np.ndarray, rate: float) -> None:
        """One online step for the weights of each gate."""
        p = 1 / (1 + np.exp(-self.mixed(x, gate)))
        pull = weight * (value - p)
        total = np.bincount(gate, weight, GATES)
        for i in range(6):
            self.weights[:, i] += rate * np.bincount(gate, pull * x[:, i], GATES) / np.maximum(total, 1e-9) * ((total > 0) & self.learning)

    def bends(self, x: np.ndarray, gate: np.ndarray, value: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """For each gate the loss of the mixed predictions (natural logarithm), how it falls with each weight, and its curvature: gates x 43."""
        s = self.mixed(x, gate)
        p = 1 / (1 + np.exp(-s))
        fall, curve = weight * (value - p), weight * p * (1 - p)
        out = np.zeros((GATES, 43))
        out[:, 0] = np.bincount(gate, weight * np.logaddexp(0, np.where(value == 1, -s, s)), GATES)
        for i in range(6):
            out[:, 1 + i] = np.bincount(gate, fall * x[:, i], GATES)
            for j in range(i + 1):
                out[:, 7 + 6 * i + j] = out[:, 7 + 6 * j + i] = np.bincount(gate, curve * x[:, i] * x[:, j], GATES)
        return out

    def came(self, x: np.ndarray, gate: np.ndarray, value: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """How often a bit was 0 and 1 at each mixed prediction: 2 x (gates x steps)."""
        at = gate * STEPS + np.rint((self.mixed(x, gate) + LIMIT) / (2 * LIMIT) * (STEPS - 1)).astype(np.int64)
        return np.stack([np.bincount(at, weight * (value == v), GATES * STEPS) for v in (0, 1)])

    def refine(self, sums: np.ndarray) -> None:
        """Fill the refining table with what ``came`` of each mixed prediction; a step without bits keeps its value."""
        middle = np.linspace(-LIMIT, LIMIT, STEPS)
        p = np.tile(1 / (1 + np.exp(-middle)), GATES)
        ones, zeros = sums[1] + 20 * p, sums[0] + 20 * (1 - p)
        found = np.clip(np.log(ones / zeros), -LIMIT, LIMIT).reshape(GATES, STEPS)
        self.refined = np.where(self.learning[:, None], found, middle)

    def log10(self, x: np.ndarray, gate: np.ndarray, value: np.ndarray) -> np.ndarray:
        """Log10 probability of every bit: the mean, in the logistic domain, of the mix and of its refinement."""
        s = self.mixed(x, gate)
        at = (s + LIMIT) / (2 * LIMIT) * (STEPS - 1)
        low = np.minimum(at.astype(np.int64), STEPS - 2)
        part = at - low
        flat = self.refined.ravel()
        s = (s + flat[gate * STEPS + low] * (1 - part) + flat[gate * STEPS + low + 1] * part) / 2
        return -np.logaddexp(0, np.where(value == 1, -s, s)) / np.log(10)


def learned(chunks: Iterator[dict[str, list]], counts: np.ndarray, deep: bool = False) -> np.ndarray:
    """Weights after one online pass over all bits of a group of units, times the bits that each gate met, and these: gates x 7."""
    mixer, met, step = Mixer.fresh(), np.zeros(GATES), 0
    for part in chunks:
        trained = np.array(part["trained"], np.int64)
        for bits, back, token in steps_of(part["token"], deep):
            x, gate, value = inputs(bits, counts, np.bincount(back, trained[token]), True)
            said = (back[:, None] * 8 + SHIFT).ravel()
            weight = np.repeat(trained[token], 8).astype(np.float32)
            met += np.bincount(gate[said], weight, GATES)
            order = np.random.default_rng(step).permutation(len(said))
            for i in range(0, len(order), 8192):
                at = order[i : i + 8192]
                step += 1
                mixer.learn(x[said[at]], gate[said[at]], value[said[at]], weight[at], 0.5 / (1 + step / 200) ** 0.5)
    return np.column_stack([mixer.weights * met[:, None], met])


def averaged(sums: np.ndarray) -> Mixer:
    """One mixer from the sum of what the groups ``learned``; a gate that no group met stays fresh."""
    mixer, met = Mixer.fresh(), sums[:, -1] > 0
    mixer.weights[met] = sums[met, :-1] / sums[met, -1:]
    return mixer


def outcomes(chunks: Iterator[dict[str, list]], counts: np.ndarray, mixer: Mixer, deep: bool = False) -> np.ndarray:
    """What ``came`` of the mixed predictions of all bits of training units."""
    total = np.zeros((2, GATES * STEPS))
    for part in chunks:
        trained = np.array(part["trained"], np.int64)
        for bits, back, token in steps_of(part["token"], deep):
            weight = np.bincount(back, trained[token])
            total += mixer.came(*inputs(bits, counts, weight, True), np.repeat(weight, 8))
    return total


def fit(chunks: Iterator[dict[str, list]], counts: np.ndarray) -> Mixer:
    """Weights and refining table of units in memory as one group."""
    parts = list(chunks)
    mixer = averaged(learned(iter(parts), counts))
    mixer.refine(outcomes(iter(parts), counts, mixer))
    return mixer


def token_scores(tokens: list[bytes], trained: np.ndarray, counts: np.ndarray, mixer: Mixer, deep: bool = False) -> np.ndarray:
    """Log10 probability of each token; if ``deep``, of its bytes from the fifth on."""
    out = np.zeros(len(tokens))
    for bits, back, token in steps_of(tokens, deep):
        each = mixer.log10(*inputs(bits, counts, np.bincount(back, trained[token]), False))
        out += np.bincount(token, each.reshape(-1, 8).sum(axis=1)[back], len(tokens))
    return out


def _step_inputs(steps: np.ndarray, n: np.ndarray, counts: np.ndarray, leave_out: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for i in range(0, len(steps), CHUNK_BITS // 8):
        some = slice(i, i + CHUNK_BITS // 8)
        yield inputs(bits_of_steps(steps[some]), counts, n[some], leave_out)


def step_scores(steps: np.ndarray, counts: np.ndarray, mixer: Mixer) -> np.ndarray:
    """Log10 probability of the byte of each step."""
    each = [mixer.log10(*found) for found in _step_inputs(steps, np.zeros(len(steps)), counts, False)]
    return np.concatenate([np.zeros(0), *each]).reshape(-1, 8).sum(axis=1)


class StepScores:
    """Scores of steps; those of met steps are remembered, ``HELD`` of them at most."""

    def __init__(self, counts: np.ndarray, mixer: Mixer):
        self.counts, self.mixer = counts, mixer
        self.known, self.score = np.zeros(0, np.uint64), np.zeros(0)

    def of(self, steps: np.ndarray) -> np.ndarray:
        """Scores of distinct steps in order."""
        new = np.setdiff1d(steps, self.known, assume_unique=True)
        if len(new) + len(self.known) > HELD:
            self.known, self.score, new = np.zeros(0, np.uint64), np.zeros(0), steps
        known = np.concatenate([self.known, new])
        order = np.argsort(known, kind="stable")
        self.known, self.score = known[order], np.concatenate([self.score, step_scores(new, self.counts, self.mixer)])[order]
        return self.score[np.searchsorted(self.known, steps)]

    def of_texts(self, batch: pa.RecordBatch) -> np.ndarray:
        """Log10 probability of the first bytes of all units of each text."""
        beginning, row = beginnings(batch)
        beginning, back = np.unique(beginning, return_inverse=True)
        steps, place = steps_from(beginning)
        distinct, at = np.unique(steps, return_inverse=True)
        each = np.bincount(place, self.of(distinct)[at], len(beginning))
        return np.bincount(row, each[back], batch.num_rows)


# --- the model --------------------------------------------------------------------------


def units_of(vocabulary: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Units (unit, trained) of all tokens, and the units (token, unit, times) of the long tokens.

    A unit ends with the closing byte of its token unless more of the token follows; no token holds such a byte.
    """
    closing = f"unhex(CASE WHEN octet_length(token) = 0 THEN '{END:02x}' ELSE '{TERMINATOR:02x}' END)"
    whole = vocabulary.withColumn("unit", F.expr(f"concat(token, {closing})"))
    long = whole.where(F.octet_length("token") > UNIT)
    cut = f"transform(sequence(0, octet_length(token) - 1, {UNIT}), i -> IF(i + {UNIT} >= octet_length(token), substring(unit, i + 1, {UNIT} + 1), substring(unit, i + 1, {UNIT})))"
    parts = long.select("token", "trained", F.explode(F.expr(cut)).alias("unit"))
    short = whole.where(F.octet_length("token") <= UNIT).select("unit", "trained")
    units = short.unionByName(parts.select("unit", "trained")).groupBy("unit").agg(F.sum("trained").alias("trained"))
    return units, parts.groupBy("token", "unit").agg(F.count("*").alias("times"))


def _summed_over(rows: DataFrame, count: Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]], shape: tuple[int, int]) -> np.ndarray:
    """The sum of all matrices of one shape that ``count`` makes of the rows of each task."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in count(batches):
            at = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(found.ravel()[at])], ["at", "x"])

    found = rows.mapInArrow(sums, "at bigint, x double").groupBy("at").agg(F.sum("x").alias("x")).toArrow()
    out = np.zeros(shape)
    out.ravel()[found["at"].to_numpy()] = found["x"].to_numpy()
    return out


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[Iterator[pa.RecordBatch]]:
    """The rows of each group, for rows sorted by ``group``."""
    def cut() -> Iterator[tuple[int, pa.RecordBatch]]:
        for batch in batches:
            group = batch["group"].to_numpy()
            borders = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(group)]
            for a, b in zip(borders[:-1], borders[1:], strict=True):
                if b > a:
                    yield int(group[a]), batch.slice(a, b - a)

    for _, rows in groupby(cut(), key=lambda pair: pair[0]):
        yield (batch.select(["token", "trained"]) for _, batch in rows)


def _over_steps(steps: DataFrame, counts: Broadcast, add: Callable[..., np.ndarray], shape: tuple[int, int]) -> np.ndarray:
    """The sum over all bits of the training steps of what ``add(inputs, gates, values, weights)`` counts, each predicted without one of its own occurrences."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        release()
        total = np.zeros(shape)
        for batch in batches:
            step, n = batch["step"].to_numpy().view(np.uint64), batch["n"].to_numpy().astype(float)
            done = 0
            for found in _step_inputs(step, n, counts.value, True):
                weight = np.repeat(n[done : done + len(found[0]) // 8], 8)
                total += add(*found, weight)
                done += len(found[0]) // 8
        yield total

    return _summed_over(steps, count, shape)


def fit_steps(steps: DataFrame, counts: Broadcast, mixer: Mixer) -> None:
    """Fit the weights of the gates that the steps (step, n) meet to all of them: Newton's method, gate by gate, half a step back where the loss has grown."""
    began, kept, least = mixer.weights.copy(), mixer.weights.copy(), np.full(GATES, np.inf)
    for _ in range(PASSES):
        found = _over_steps(steps, counts, mixer.bends, (GATES, 43))
        loss = found[:, 0] + HOLD / 2 * ((mixer.weights - began) ** 2).sum(axis=1)
        better, before = loss <= least, least[least < np.inf].sum()
        kept[better], least[better] = mixer.weights[better], loss[better]
        if before and before - least.sum() < 1e-7 * before:
            break
        bend = found[:, 7:].reshape(GATES, 6, 6) + HOLD * np.eye(6)
        turn = np.linalg.solve(bend, (found[:, 1:7] - HOLD * (mixer.weights - began))[..., None])[..., 0]
        mixer.weights = np.where(better[:, None], kept + turn, (kept + mixer.weights) / 2)
    mixer.weights = kept


def fitted(units: DataFrame, counts: Broadcast, steps: DataFrame | None = None) -> Mixer:
    """Weights and refining table from all training units (unit, stem, trained).

    Weights are learned online in groups of whole stems, some ``GROUP_UNITS`` each, whatever the partitions are, and averaged gate by gate
    by the bits that each group met; the refining table counts what came of the averaged predictions in all units.  The gates of the first bytes of
    running text are fitted to its ``steps``.
    """
    deep = steps is not None
    trained = units.where("trained > 0").select(F.col("unit").alias("token"), "trained", "stem")
    groups = max(1, round(trained.count() / GROUP_UNITS))
    grouped = trained.withColumn("group", F.pmod(F.xxhash64("stem"), F.lit(groups))).repartition(groups, "group").sortWithinPartitions("group", "token")
    learn = lambda batches: (learned(_stems(rows), counts.value, deep) for rows in _groups(batches))
    mixer = averaged(_summed_over(grouped.select("token", "trained", "group"), learn, (GATES, 7)))
    whole = trained.repartition("stem").select("token", "trained").sortWithinPartitions("token")
    if steps is not None:
        mixer.learning = np.ones(GATES, bool)
        fit_steps(steps, counts, mixer)
    came = _summed_over(whole, lambda batches: iter([outcomes(_stems(batches), counts.value, mixer, deep)]), (2, GATES * STEPS))
    if steps is not None:
        came += _over_steps(steps, counts, mixer.came, (2, GATES * STEPS))
    mixer.refine(came)
    return mixer


def model_of(units: DataFrame, steps: DataFrame | None = None) -> tuple[Broadcast, Mixer]:
    """Shared counts and mixer, learned from the units (unit, trained) and, for running text, its steps (step, n)."""
    counts = units.sparkSession.sparkContext.broadcast(shared_counts(units, steps))  # 29 MB, whatever the corpus
    return counts, fitted(units.withColumn("stem", F.substring("unit", 1, STEM)), counts, steps)


def score_units(units: DataFrame, model: tuple[Broadcast, Mixer] | None = None, deep: bool = False) -> DataFrame:
    """(unit, lm): every distinct unit (unit, trained) with its log10 probability; if ``deep``, of its bytes from the fifth on."""
    counts, mixer = model or model_of(units)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _stems(batches):
            lm = token_scores(part["token"], np.array(part["trained"], np.int64), counts.value, mixer, deep)
            yield pa.RecordBatch.from_arrays([pa.array(part["token"], pa.binary()), pa.array(lm)], ["unit", "lm"])

    grouped = units.withColumn("stem", F.substring("unit", 1, STEM)).repartition("stem").select(F.col("unit").alias("token"), "trained").sortWithinPartitions("token")
    return grouped.mapInArrow(score, "unit binary, lm double")


def score_vocabulary(vocabulary: DataFrame) -> DataFrame:
    """(token, trained, seen, lm): every distinct token of the corpus with the log10 probability that it has alone."""
    return _scored_tokens(vocabulary)[0]


def _scored_tokens(vocabulary: DataFrame, steps: DataFrame | None = None) -> tuple[DataFrame, tuple[Broadcast, Mixer]]:
    """The vocabulary with ``lm``, and the model; of running text, ``lm`` is what does not depend on the tokens before: the bytes from the fifth on."""
    units, parts = units_of(vocabulary)
    units = staged(units, "units")
    model = model_of(units, steps)
    scored = staged(score_units(units, model, steps is not None), "unit_scores")
    long = parts.join(scored, "unit").groupBy("token").agg(F.sum(F.col("lm") * F.col("times")).alias("lm"))
    # The unit of a short token is the token and its closing byte.
    short = scored.withColumn("token", F.expr(f"IF(unit = unhex('{END:02x}'), unhex(''), substring(unit, 1, octet_length(unit) - 1))"))
    short = short.where(f"octet_length(unit) <= {UNIT} + 1 AND (unit = unhex('{END:02x}') OR endswith(unit, unhex('{TERMINATOR:02x}')))")
    found = vocabulary.where(F.octet_length("token") <= UNIT).join(short.select("token", "lm"), "token")
    return found.unionByName(vocabulary.where(F.octet_length("token") > UNIT).join(long, "token")).select("token", "trained", "seen", "lm"), model


def score_texts(docs: DataFrame, held: str = "held_out", over_blanks: bool = False) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, ``held``): counts, base score, model score and bits per byte of the text.

    With ``over_blanks`` the model reads running text: the first bytes of each token are predicted from those of the tokens before it.

    Learned from the rows where ``held`` is false.  Null and empty texts are one end token; repeated rows count as often
    as they come; without training rows every bit has probability one half.
    """
    spark = docs.sparkSession
    vocabulary = staged(count_tokens(docs, held), "vocabulary")
    total, distinct = vocabulary.where("trained > 0").agg(F.coalesce(F.sum("trained"), F.lit(0)), F.count("*")).first()
    base = F.log10((F.col("trained") + 1) / F.lit(float(total + distinct + 1)))
    steps = staged(count_steps(docs, held), "steps") if over_blanks else None
    tokens, (shared, mixer) = _scored_tokens(vocabulary, steps)
    scored = staged(tokens.select("token", (F.col("trained") > 0).cast("bigint").alias("known"), base.alias("base"), "lm", "seen"), "scored")
    top = scored.orderBy(F.desc("seen"), "token").limit(HEAD).drop("seen").toArrow().combine_chunks()
    head = spark.sparkContext.broadcast({c: (top[c].combine_chunks() if c == "token" else top[c].to_numpy()) for c in top.column_names})
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["row", "doc_id", "held_out", "n_tokens", "n_bytes", "known", "base", "lm", "rare"]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, values, first = TaskContext.get().partitionId() << 40, head.value, StepScores(shared.value, mixer)
        for batch in blocks(batches):
            n = batch.num_rows
            words, owner = tokens_of(batch)
            coded = words.dictionary_encode()
            place = pc.index_in(coded.dictionary.cast(pa.binary()), value_set=values["token"]).fill_null(-1).to_numpy()
            at = place[coded.indices.to_numpy()]
            common = at >= 0
            sums = [np.bincount(owner[common], values[c][at[common]], n) for c in ("known", "base", "lm")]
            if over_blanks:
                sums[2] = sums[2] + first.of_texts(batch)
            size = np.bincount(owner, pc.binary_length(words).to_numpy() + 1, n).astype(np.int64)
            # what is not among the frequent tokens leaves as (token, n) of each text
            key = owner[~common] * len(coded.dictionary) + coded.indices.to_numpy()[~common]
            key, times = np.unique(key, return_counts=True)
            text, code = np.divmod(key, max(len(coded.dictionary), 1))
            rare = pa.StructArray.from_arrays([coded.dictionary.take(pa.array(code)).cast(pa.binary()), pa.array(times)], ["token", "n"])
            rare = pa.ListArray.from_arrays(pa.array(np.searchsorted(text, np.arange(n + 1)), pa.int32()), rare)
            counts = np.bincount(owner, minlength=n)
            arrays = [pa.array(np.arange(row, row + n)), batch["doc_id"], batch[held], pa.array(counts), pa.array(size), pa.array(sums[0].astype(np.int64)), pa.array(sums[1]), pa.array(sums[2]), rare]
            row += n
            yield pa.RecordBatch.from_arrays(arrays, names)

    shape = f"row bigint, doc_id {kind}, held_out boolean, n_tokens bigint, n_bytes bigint, known bigint, base double, lm double, rare array<struct<token: binary, n: bigint>>"
    rows = staged(docs.select("doc_id", "text", held).mapInArrow(add, shape), "texts")
    rare = rows.select("row", F.explode("rare").alias("r")).select("row", "r.token", "r.n").join(scored.drop("seen"), "token")
    sums = rare.groupBy("row").agg(*[F.sum(F.col(c) * F.col("n")).alias(f"rare_{c}") for c in ("known", "base", "lm")])
    found = rows.drop("rare").join(sums, "row", "left")
    whole = {c: F.col(c) + F.coalesce(f"rare_{c}", F.lit(0)) for c in ("known", "base", "lm")}
    return found.select(
        "doc_id",
        "held_out",
        "n_tokens",
        whole["known"].alias("n_known"),
        F.lit(int(total)).cast("bigint").alias("train_tokens"),
        F.round(whole["base"], 6).alias("base_score"),
        F.round(whole["lm"], 6).alias("score"),
        F.round(-whole["lm"] / F.lit(float(np.log10(2))) / F.col("n_bytes"), 6).alias("bits_per_byte"),
    )
