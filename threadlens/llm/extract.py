"""Main text of web pages: boosted trees judge every node of a page's tree, one decoding makes the verdicts agree.

Nodes are elements and runs of text.  Their features are attribute words, depth, text and link density of the subtree,
statistics of the siblings and what speaks for or against main text above them.  A node that is judged noise takes its
whole subtree with it, and the labels chosen are those of the highest joint probability under that rule.

There are no labelled pages: the trees learn from the pages themselves, where a tag or attribute word says what a part
is, and from variants of them that are built otherwise: other signs, other wrappers, parts moved, lists and headings for
paragraphs, noise inside the main text.  In every third page the signs are hidden from the features (not from the
labels), so that the trees also learn what main text looks like without them.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import boosting, dom
from .common import blocks

#: Pages learned from at most (lowest hashes of their ids), and nodes of them.
MAX_PAGES, MAX_NODES = 300, 60_000
#: Variants of each page that are learned from.
VARIANTS = 3
PART = re.compile(r"<(nav|footer|aside|header|form)\b[^>]*>.*?</\1>|<(div|section)\b[^>]*(?:class|id)=[^>]*>[^<]*</\2>", re.S | re.I)
PARAGRAPH = re.compile(r"<p>([^<]*)</p>")
MAIN = re.compile(r"<(article|main)\b[^>]*>(.*?)</\1>", re.S | re.I)
FEATURES = 22


class Nodes:
    """The nodes of several pages in arrays."""

    def __init__(self, pages: list[dom.Page]):
        sizes = np.array([len(p.tags) for p in pages], np.int64)
        self.first = np.concatenate([[0], np.cumsum(sizes)])
        shift = np.repeat(self.first[:-1], sizes)
        flat = lambda name: [v for p in pages for v in getattr(p, name)]
        self.page = np.repeat(np.arange(len(pages)), sizes)
        self.tags = flat("tags")
        parents = np.array(flat("parents"), np.int64)
        self.root = parents < 0
        self.parent = np.where(self.root, np.arange(len(parents)), parents + shift)
        self.end = np.array(flat("ends"), np.int64) + shift
        self.depth = np.array(flat("depths"), np.int64)
        words = np.array(flat("words"), float).reshape(-1, 2)
        self.silent = np.concatenate([np.zeros(0, bool), *map(dom.silent, pages)])
        self.texts = flat("texts")
        tag = np.array(self.tags, object) if self.tags else np.zeros(0, object)
        one = lambda names: np.array([t in names for t in tag], float)
        self.is_text = one((dom.TEXT,))
        self.good, self.bad = words[:, 0] + 2 * one(dom.CONTENT_TAGS), words[:, 1] + 2 * one(dom.NOISE_TAGS)
        self.link = one(("a",))
        self.size = np.array([0 if s else len(t.split()) for t, s in zip(self.texts, self.silent, strict=True)], float)
        self.marks = np.array([0 if s else t.count(".") + t.count(",") + t.count(";") for t, s in zip(self.texts, self.silent, strict=True)], float)
        self.order = np.argsort(self.depth, kind="stable")
        self.levels = np.searchsorted(self.depth[self.order], np.arange(self.depth.max(initial=0) + 2))

    def below(self, values: np.ndarray) -> np.ndarray:
        """Sum over each node's subtree, itself included."""
        sums = np.concatenate([[0.0], np.cumsum(values)])
        return sums[self.end] - sums[np.arange(len(values))]

    def down(self, own: np.ndarray, carry) -> np.ndarray:
        """Values handed from parents to children: ``carry(parent's value, own value)``."""
        out = own.copy()
        for d in range(1, len(self.levels) - 1):
            at = self.order[self.levels[d] : self.levels[d + 1]]
            out[at] = carry(out[self.parent[at]], own[at])
        return out

    def features(self, hidden: np.ndarray | None = None) -> np.ndarray:
        """One row per node; in pages that are ``hidden``, signs of tags and attributes are left out."""
        n = len(self.tags)
        shown = 1.0 if hidden is None else 1.0 - hidden[self.page]
        good, bad = self.good * shown, self.bad * shown
        above_good = self.down(np.minimum(good, 4), lambda p, o: p * 0.9 + o)
        above_bad = self.down(np.minimum(bad, 4), lambda p, o: p * 0.9 + o)
        in_link = self.down(self.link, np.maximum)
        size, linked, marks = self.below(self.size), self.below(self.size * in_link), self.below(self.marks)
        elements, runs = self.below(1 - self.is_text), self.below((self.size > 0).astype(float))
        total = size[self.first[:-1]][self.page] if n else size
        before = np.concatenate([[0.0], np.cumsum(self.size)])
        place = (before[:-1] - before[self.first[:-1]][self.page]) / np.maximum(total, 1) if n else size
        children = np.bincount(self.parent[~self.root], minlength=n).astype(float)
        siblings, near = children[self.parent], np.bincount(self.parent[~self.root], size[~self.root], n)
        rank = np.zeros(n)
        by_parent = np.lexsort((np.arange(n), self.parent))
        fresh = np.concatenate([[True], self.parent[by_parent][1:] != self.parent[by_parent][:-1]]) if n else np.zeros(0, bool)
        runs_at = np.flatnonzero(fresh)
        rank[by_parent] = np.arange(n) - np.repeat(runs_at, np.diff(np.concatenate([runs_at, [n]])))
        columns = [
            good, bad, above_good, above_bad, above_good - above_bad, above_good[self.parent], above_bad[self.parent],
            self.depth, np.log1p(size), linked / np.maximum(size, 1), marks / np.maximum(size, 1), size / np.maximum(elements, 1),
            np.log1p(elements), size / np.maximum(runs, 1), size / np.maximum(total, 1), place, np.log1p(children), np.log1p(siblings),
            rank / np.maximum(siblings, 1), near[self.parent] / np.maximum(siblings, 1), self.is_text, in_link,
        ]
        return np.stack(columns, axis=1) if n else np.zeros((0, FEATURES))

    def signs(self) -> tuple[np.ndarray, np.ndarray]:
        """Which nodes tags and attributes tell about, and whether they hold main text: the nearest sign above a run decides."""
        own = np.where(self.bad > 0, -1.0, np.where(self.good > 0, 1.0, 0.0))
        # Noise inside main text is noise; main text inside noise stays noise.
        said = self.down(own, lambda p, o: np.where(p < 0, p, np.where(o != 0, o, p)))
        text = (self.size > 0) & ~self.silent
        main, noise = self.below(text * (said > 0)), self.below(text * (said < 0))
        known = ((main + noise) > 0) & ((main + noise) == self.below(text.astype(float))) & ~self.silent
        return known | (main > 0), main > 0

    def decode(self, logit: np.ndarray) -> np.ndarray:
        """Labels of the highest joint probability in which no node is main text under one that is noise."""
        logit = np.where(self.silent, -50.0, np.clip(logit, -30, 30))
        yes, no = -np.logaddexp(0, -logit), -np.logaddexp(0, logit)
        yes[self.root], no[self.root] = 0, -1e9
        for d in range(len(self.levels) - 2, 0, -1):
            at = self.order[self.levels[d] : self.levels[d + 1]]
            np.add.at(yes, self.parent[at], np.maximum(yes[at], no[at]))
            np.add.at(no, self.parent[at], no[at])
        return self.down((yes >= no).astype(float), np.minimum) > 0


def variant(html: str, seed: int) -> str:
    """The page as another site might build it; what its signs say about its parts stays true."""
    rng = random.Random(seed)
    noise, content = sorted(dom.NOISE_WORDS), sorted(dom.CONTENT_WORDS)

    def part(m: re.Match) -> str:
        inner = re.sub(r"^<[^>]*>|</[^>]*>$", "", m[0])
        if rng.random() < 0.3:
            inner = f"<h3>{rng.choice(['News', 'More', 'About'])}</h3><p>{inner}</p>"
        tag = rng.choice(["div", "div", "section", "nav", "aside", "footer", "header", "form"])
        said = "" if tag in dom.NOISE_TAGS else f' {rng.choice(["class", "id"])}="{rng.choice(noise)}{rng.choice(["", "-box", " wide"])}"'
        return f"<{tag}{said}>{inner}</{tag}>"

    def paragraph(m: re.Match) -> str:
        kind = rng.random()
        if kind < 0.75:
            return m[0]
        words = m[1].split(" ")
        short = " ".join(words[: rng.randrange(1, 8)])
        return rng.choice([f"<ul><li>{short}<li>{m[1]}</ul>", f"<h2>{short}</h2><p>{m[1]}</p>", f"<blockquote>{m[1]}</blockquote>", f"<div>{m[1]}</div>", f"<p><a href=x>{short}</a> {m[1]}</p>"])

    parts = [part(m) for m in PART.finditer(html)]
    html = PARAGRAPH.sub(paragraph, PART.sub("", html))
    rng.shuffle(parts)
    inside = [parts.pop() for _ in range(rng.randrange(2)) if parts]
    cut = rng.randrange(len(parts) + 1)

    def main(m: re.Match) -> str:
        tag = rng.choice(["article", "main", "div", "section"])
        said = "" if tag in dom.CONTENT_TAGS else f' {rng.choice(["class", "id"])}="{rng.choice(content)}{rng.choice(["", "-inner", " wide"])}"'
        text = m[2]
        if inside:
            at = text.find("<p>", rng.randrange(max(1, len(text))))
            text = text[:at] + inside[0] + text[at:] if at >= 0 else text + inside[0]
        deep = rng.randrange(4)
        return "".join(parts[:cut]) + "<div>" * deep + f"<{tag}{said}>{text}</{tag}>" + "</div>" * deep + "".join(parts[cut:])

    return MAIN.sub(main, html, count=1)


def learn(pages: DataFrame) -> boosting.Trees:
    """Trees fitted on the nodes of at most ``MAX_PAGES`` of the ``pages`` (page_id, html)."""
    ids = pages.where("html IS NOT NULL").select("page_id").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(MAX_PAGES)
    sample = pages.select("page_id", "html").join(F.broadcast(ids), "page_id", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "html"):
            rows = [(str(i), v, h) for i, h in zip(batch["page_id"].to_pylist(), batch["html"].to_pylist(), strict=True) for v in range(VARIANTS + 1)]
            nodes = Nodes([dom.read(variant(h, sum(i.encode()) * 31 + v) if v else h) for i, v, h in rows])
            hidden = np.array([(sum(i.encode()) + v) % 3 == 0 for i, v, _ in rows], float)
            x, (known, main) = nodes.features(hidden), nodes.signs()
            lists = pa.FixedSizeListArray.from_arrays(pa.array(x[known].ravel()), FEATURES).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([lists, pa.array(main[known].astype(np.int32))], ["x", "y"])

    found = sample.mapInArrow(run, "x array<double>, y int").orderBy(F.xxhash64("x")).limit(MAX_NODES).toArrow()
    x = found["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, FEATURES) if found.num_rows else np.zeros((0, FEATURES))
    return boosting.fit(x, found["y"].to_numpy().astype(float)) if len(x) else boosting.Trees(0.0, np.zeros((0, 1), np.int64), np.zeros((0, 1)), np.zeros((0, 2)))


def main_texts(pages: list[dom.Page], trees: boosting.Trees) -> list[str]:
    nodes = Nodes(pages)
    kept = nodes.decode(trees.logit(nodes.features()))
    return [dom.joined(p, kept[a:b]) for p, a, b in zip(pages, nodes.first[:-1], nodes.first[1:], strict=True)]


def extract(pages: DataFrame, trees: boosting.Trees) -> DataFrame:
    """Per row of ``pages`` (page_id, url, html): page_id, url, text and n_chars.

    Null and empty html has the empty text; repeated rows are read each; trees that learned from no pages keep all
    text outside of scripts, styles and forms' fields.
    """
    kinds = [f"{c} {pages.schema[c].dataType.simpleString()}" for c in ("page_id", "url")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "html"):
            texts = main_texts([dom.read(h) for h in batch["html"].to_pylist()], trees)
            columns = [batch["page_id"], batch["url"], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, f"{', '.join(kinds)}, text string, n_chars bigint")
