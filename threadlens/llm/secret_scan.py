"""Secret scans: fixed patterns, and an assignment-aware lexer that scores literals by the names they are given to.

The lexer walks over the assignment signs of a text (``=``, ``:``, ``:=``, ``=>``), reads the name before and the
expression behind, and keeps a table of constants, so that ``K = "..."; api_secret = K + "..."`` is followed to the
literals.  It understands what programs, JSON, YAML, INI, environment and property files have in common: one name, one
sign, and a quoted or bare literal on one line, parts joined by ``+``.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "literal")
ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
MIN_ASSIGNED = 8

SIGN = re.compile(r"=>|:=|[=!<>]=+|[:=]")
#: A name of any length with its quote, bracket, type and blanks, read backwards from the sign: parts joined by ``.``, ``-``, ``->`` or ``::``.
NAME = re.compile(r"[ \t]*+(?:[\w.\[\]|]++(?<=[A-Za-z_])[ \t]*+:[ \t]*+)?\]?[\"'`]?([\w$]*[A-Za-z_$](?:(?:[.\-]|>-|::)[\w$]*[A-Za-z_$])*)", re.ASCII)
#: Literals that a value lists itself; one of more refers to the values that it is made of, so expressions that grow in a loop stay linear.
LISTED = 64
#: Quoted literals have any length: the next quote of a kind ends the one before, so one scan a kind and line fails at most.
PART = re.compile(
    r"""[ \t]*(?:[rRbBuUfF]{0,2}(?:"((?:[^"\\\n]|\\.)*+)"|'((?:[^'\\\n]|\\.)*+)'|`([^`\n]*+)`)|([^\s"'`,;(){}\[\]<>+]+(?:\+[^\s"'`,;(){}\[\]<>+]+)*))"""
)
PLUS = re.compile(r"[ \t]*\+[ \t]*")
IDENTIFIER = re.compile(r"[A-Za-z_$][\w$]*(?:\.[A-Za-z_$][\w$]*)*\Z", re.ASCII)
PIECES = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")

# Scores of name parts and of pairs of them, and marks of placeholders.
SENSITIVE = {"password": 4, "passwd": 4, "passphrase": 4, "pwd": 4, "pass": 3, "secret": 4, "token": 3, "credential": 4, "credentials": 4, "apikey": 4, "bearer": 3, "signature": 2, "auth": 2, "key": 1, "salt": 1, "cookie": 1, "session": 1, "dsn": 1, "private": 1}
PAIRS = {("api", "key"), ("access", "key"), ("private", "key"), ("secret", "key"), ("signing", "key"), ("encryption", "key"), ("auth", "key"), ("master", "key"), ("service", "key")}
HARMLESS = {"public", "name", "count", "length", "size", "max", "min", "limit", "type", "id", "file", "path", "url", "uri", "policy", "field", "hint", "label", "expiry", "ttl", "column", "index", "foreign", "primary", "sort"}
PLACEHOLDER = re.compile(r"(?i)change_?me|example|placeholder|your[_-]|dummy|redacted|xxx|\*\*\*|\.\.\.")
WHOLE_PLACEHOLDER = re.compile(r"(?i)^(?:none|null|nil|true|false|undefined|todo|test|default|string)$|^[<{$%].*")
#: Characters that no placeholder is longer than.
REACH = 16
MIN_LITERAL, MIN_SCORE = 8, 6


@dataclass(frozen=True)
class Literal:
    """A literal part with its place in code points, end exclusive."""

    value: str
    begin: int
    end: int


def name_score(name: str) -> int:
    """How sensitive the target is: the highest part or pair, less what speaks for something harmless."""
    parts = [p.lower() for p in PIECES.findall(name)]
    best = max((SENSITIVE.get(p, 0) for p in parts), default=0)
    if any(pair in PAIRS for pair in zip(parts, parts[1:], strict=False)):
        best = 4
    return best - 3 * (parts[-1] in HARMLESS if parts else 0)


@dataclass(frozen=True)
class Look:
    """What the score of a text needs to know, also of one that is put together from others."""

    size: int
    counts: Counter
    head: str
    tail: str
    placeholder: bool

    @classmethod
    def of(cls, text: str) -> Look:
        return cls(len(text), Counter(text), text[:REACH], text[-REACH:], bool(PLACEHOLDER.search(text)))

    def __add__(self, other: Look) -> Look:
        counts = self.counts.copy()
        counts.update(other.counts)
        head, tail = (self.head + other.head)[:REACH], (self.tail + other.tail)[-REACH:]
        return Look(self.size + other.size, counts, head, tail, self.placeholder or other.placeholder or bool(PLACEHOLDER.search(self.tail + other.head)))

    def score(self) -> int:
        """How much a value looks made by a machine: its length, classes of characters and entropy."""
        if self.size < MIN_LITERAL or self.placeholder or WHOLE_PLACEHOLDER.search(self.head):
            return -10
        entropy = -sum(n / self.size * math.log2(n / self.size) for n in self.counts.values())
        classes = sum(any(map(f, self.counts)) for f in (str.islower, str.isupper, str.isdigit, lambda c: not c.isalnum()))
        return 1 + (entropy >= 2.5) + (entropy >= 3.2) + (classes >= 2) + any(map(str.isdigit, self.counts)) - 3 * any(map(str.isspace, self.counts))


class Value:
    """What a name is given: literals and earlier values in order; a literal counts once, where it first stands."""

    __slots__ = ("parts", "apart", "_look", "_told")

    def __init__(self, parts: list[Literal | Value], apart: bool):
        self.parts, self.apart = parts, apart  # apart: no two parts share a literal
        self._look, self._told = None, False

    def listed(self) -> bool:
        return len(self.parts) <= LISTED and not any(isinstance(p, Value) for p in self.parts)

    def look(self) -> Look:
        """The look of all literals, joined; along one earlier value after the other, from the last one that is known."""
        path = [self]
        while path[-1]._look is None and path[-1].apart and (below := [p for p in path[-1].parts if isinstance(p, Value)]):
            path.append(below[0])
        found = path[-1]._look or Look.of("".join(p.value for p in flat([path[-1]])))
        path[-1]._look = found
        for value in reversed(path[:-1]):
            at = next(i for i, p in enumerate(value.parts) if isinstance(p, Value))
            before, after = ("".join(p.value for p in side) for side in (value.parts[:at], value.parts[at + 1 :]))
            found = Look.of(before) + found + Look.of(after)
            if value in path[:2]:
                value._look = found
        return found

    def tell(self, places: set[tuple[int, int]]) -> None:
        """Add the places of all literals; what is in ``places`` already is not walked again."""
        waiting = [self]
        while waiting:
            value = waiting.pop()
            if not value._told:
                value._told = True
                places.update((p.begin, p.end) for p in value.parts if isinstance(p, Literal) and p.value)
                waiting += [p for p in value.parts if isinstance(p, Value)]


def flat(parts: list[Literal | Value]) -> list[Literal]:
    """All literals in order, each once."""
    found, met, waiting = {}, set(), [iter(parts)]
    while waiting:
        part = next(waiting[-1], None)
        if part is None:
            waiting.pop()
        elif isinstance(part, Literal):
            found[part] = None
        elif id(part) not in met:
            met.add(id(part))
            waiting.append(iter(part.parts))
    return list(found)


def value_of(parts: list[Literal | Value], new: bool) -> Value:
    """The value of an expression; ``new``: no value has its literals yet."""
    parts = list({id(p) if isinstance(p, Value) else p: p for p in parts}.values())
    known = [p for p in parts if isinstance(p, Value)]
    if len(parts) == len(known) == 1:
        return known[0]
    if all(p.listed() for p in known) and len(listed := flat(parts)) <= LISTED:
        return Value(listed, True)
    return Value(parts, new and len(known) < 2)


def last_own(parts: list[Literal | Value], begin: int, new: bool) -> Literal | None:
    """The last literal, if it stands behind ``begin``; values at the end may repeat what stands before."""
    own = [i for i, p in enumerate(parts) if isinstance(p, Literal)]
    if new and (not own or own[-1] == len(parts) - 1):
        return parts[-1] if own else None
    if new and not any(isinstance(p, Value) for p in parts[: own[-1]]):
        return None
    last = flat(parts)[-1]
    return last if last.begin >= begin else None


def assignments(text: str) -> Iterator[tuple[str, Value]]:
    """Names and what they are given, in order; constants assigned before are followed."""
    constants: dict[str, Value] = {}
    back = text[::-1]
    done = read = 0
    for sign in SIGN.finditer(text):
        if sign.start() < done or sign[0] not in ("=", ":", ":=", "=>"):
            continue
        name = NAME.match(back, len(text) - sign.start())
        if not name or text.startswith("//", sign.end()):
            continue
        parts, at, more = [], sign.end(), True
        while more and (part := PART.match(text, at)):
            group = part.lastindex
            value = part[group]
            bare = group == 4
            if bare and (known := constants.get(value.rpartition(".")[2])) is not None:
                parts.append(known)
            elif not bare or not IDENTIFIER.match(value) or not parts:
                parts.append(Literal(value, part.start(group), part.end(group)))
            at = part.end()
            more = PLUS.match(text, at)
            at = more.end() if more else at
        if parts:
            # After a constant at the end the signs inside the expression are looked at, too, so its literals may be read again.
            new = sign.end() >= read
            given, last = value_of(parts, new), last_own(parts, sign.end(), new)
            said = name[1][::-1]
            yield said, given
            constants[re.split(r"\.|->|::", said)[-1]] = given
            read = max([read, *(p.end for p in parts if isinstance(p, Literal))])
            done = last.end if last else sign.end()


def literals(text: str) -> set[tuple[int, int]]:
    """Places of literals whose name and value together reach the score."""
    found = set()
    if "=" in text or ":" in text:
        for name, value in assignments(text):
            weight = name_score(name)
            if weight > 0 and weight + value.look().score() >= MIN_SCORE:
                value.tell(found)
    return found


def spans(text: str | None) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all spans in order; a literal that lies in a span of a fixed pattern is not told again."""
    text = text or ""
    base = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= MIN_ASSIGNED]
    base += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)] if "AKIA" in text else []
    base += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    # The farthest end of all spans that begin no later tells whether one of them holds a literal.
    base.sort()
    begins, reach = [b for b, _, _ in base], list(accumulate((end for _, _, end in base), max))
    held = lambda s, e: (i := bisect_right(begins, s)) > 0 and reach[i - 1] >= e
    return sorted(base + [(s, 3, e) for s, e in literals(text) if not held(s, e)])


def scan(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id and ``found``, an array of (kind, start, end) in code points.

    Null and empty texts have no spans; repeated rows are scanned each.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    shape = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans(t.as_py())] for t in batch["text"]]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(rows, shape)], ["doc_id", "found"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, found array<struct<kind: string, start: int, end: int>>")


def digests(found: DataFrame) -> DataFrame:
    """Counts of each fixed pattern, the SHA-256 of their spans and all spans as text."""
    say = "array_join(transform({}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"
    return found.select(
        "doc_id",
        *[F.expr(f"CAST(size(filter(found, s -> s.kind = '{k}')) AS BIGINT)").alias(f"n_{k}") for k in KINDS],
        F.sha2(F.expr(say.format("filter(found, s -> s.kind <> 'literal')")), 256).alias("base_sha256"),
        F.expr(say.format("found")).alias("spans"),
    )
