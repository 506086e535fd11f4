"""How much each text filter removes, under every order of the filters.

A document's failures are a mask, one bit per filter. Per part the masks are counted, and the
counts become a decision diagram: one level per filter, a document passes or fails on the way
down, and every node holds the counts below it. Equal sub-diagrams are one node. Orders are
visited by swaps of two adjacent levels, which rebuild those two levels only. In any order the
path on which everything passes gives all steps: the failing branch at a level is what that
filter removes, the passing one what is kept.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.common import documents, stored

FILTERS = "ABCDE"
#: Filter E, decided over the whole table; the others look at one text.
DUPLICATE = FILTERS.index("E")

SHORT_WORDS = 200
DISTINCT_PERCENT = 50
CAPITAL_PERCENT = 2
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_SIGNS = b"#$%&*|"
_CONTINUATION = bytes(range(0x80, 0xC0))
_BLANK = re.compile(rb"[\x20\x09-\x0D]")

Counts = tuple[int, ...]


class Diagram:
    """A count-weighted decision diagram of failure masks.

    ``masks`` maps a mask (bit i: filter i fails) to its counts. Nodes are numbers; 0 is the
    empty diagram. A node's key is its pair of children, so equal ones are shared, and no level
    is left out, so that a swap touches two levels only.
    """

    EMPTY = 0

    def __init__(self, masks: dict[int, Counts], variables: int):
        self.order = list(range(variables))
        width = len(next(iter(masks.values()), ()))
        self.weight: list[np.ndarray] = [np.zeros(width, np.int64)]
        self.passing, self.failing = [self.EMPTY], [self.EMPTY]
        self._levels: list[dict[tuple, int]] = [{} for _ in range(variables + 1)]
        self.root = self._built(0, {m: c for m, c in masks.items() if any(c)})

    def _built(self, level: int, masks: dict[int, Counts]) -> int:
        if not masks:
            return self.EMPTY
        if level == len(self.order):
            (counts,) = masks.values()
            return self._node(level, tuple(counts), np.array(counts, np.int64))
        bit = 1 << self.order[level]
        return self._joined(level, self._built(level + 1, {m: c for m, c in masks.items() if not m & bit}),
                            self._built(level + 1, {m: c for m, c in masks.items() if m & bit}))

    def _node(self, level: int, key: tuple, weight: np.ndarray) -> int:
        at = self._levels[level].get(key)
        if at is None:
            at = self._levels[level][key] = len(self.weight)
            self.weight.append(weight)
            self.passing.append(self.EMPTY)
            self.failing.append(self.EMPTY)
        return at

    def _joined(self, level: int, passing: int, failing: int) -> int:
        if passing == failing == self.EMPTY:
            return self.EMPTY
        at = self._node(level, (passing, failing), self.weight[passing] + self.weight[failing])
        self.passing[at], self.failing[at] = passing, failing
        return at

    def swap(self, level: int) -> None:
        """Exchange the filters of ``level`` and the one below it, in place.

        Nodes of ``level`` keep their numbers and counts, so nothing above changes; the level
        below is made anew from the four grandchildren of each.
        """
        upper, self._levels[level + 1] = self._levels[level], {}
        changed: dict[tuple, int] = {}
        for (passing, failing), at in upper.items():
            ok = self._joined(level + 1, self.passing[passing], self.passing[failing])
            bad = self._joined(level + 1, self.failing[passing], self.failing[failing])
            self.passing[at], self.failing[at] = ok, bad
            changed[ok, bad] = at
        self._levels[level] = changed
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def steps(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Counts (kept, removed) of every level on the path where all filters pass."""
        at = self.root
        for _ in self.order:
            yield self.weight[self.passing[at]], self.weight[self.failing[at]]
            at = self.passing[at]


def plain_changes(n: int) -> Iterator[int]:
    """Positions whose swap with the next one leads through all n! orders, each once."""
    if n < 2:
        return
    inner = plain_changes(n - 1)
    while True:
        yield from range(n - 2, -1, -1)
        moved = next(inner, None)
        if moved is None:
            return
        yield moved + 1
        yield from range(n - 1)
        moved = next(inner, None)
        if moved is None:
            return
        yield moved


def audit_part(masks: dict[int, Counts], variables: int) -> Iterator[tuple]:
    """(order, step, kept, removed, redundant, unique, shapley) of every order and step.

    ``kept`` and ``removed`` are counts; the others refer to their first entry. What a filter
    removes as the first one is all that fails it, and as the last one what fails it alone.
    """
    diagram = Diagram(masks, variables)
    found = {tuple(diagram.order): list(diagram.steps())}
    for level in plain_changes(variables):
        diagram.swap(level)
        found[tuple(diagram.order)] = list(diagram.steps())
    fails, alone, total = [0] * variables, [0] * variables, [0] * variables
    for order, steps in found.items():
        fails[order[0]] = int(steps[0][1][0])
        alone[order[-1]] = int(steps[-1][1][0])
        for variable, (_, removed) in zip(order, steps):
            total[variable] += int(removed[0])
    for order, steps in found.items():
        for step, (variable, (kept, removed)) in enumerate(zip(order, steps), 1):
            yield (order, step, kept, removed, fails[variable] - int(removed[0]), alone[variable],
                   total[variable])


def word_counts(text: bytes, piece: int = 1 << 20) -> tuple[int, int]:
    """Words and distinct words of UTF-8 ``text``; a long text is split piece by piece."""
    if len(text) <= piece:
        words = text.split()        # of bytes: at exactly the white space meant here
        return len(words), len(set(words))
    seen: set[bytes] = set()
    total = at = 0
    while at < len(text):
        border = _BLANK.search(text, min(len(text), at + piece))
        end = border.start() if border else len(text)
        words = text[at:end].split()
        total += len(words)
        seen.update(words)
        at = end
    return total, len(seen)


def text_failures(text: bytes) -> int:
    """Mask of the filters A to D that the UTF-8 ``text`` fails."""
    words, distinct = word_counts(text)
    chars = len(text.translate(None, _CONTINUATION))
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    failed = (words < SHORT_WORDS, 100 * distinct < DISTINCT_PERCENT * words,
              100 * capitals > CAPITAL_PERCENT * chars,
              len(text) != len(text.translate(None, _SIGNS)))
    return sum(1 << bit for bit, fails in enumerate(failed) if fails)


_FOUND = pa.schema([("doc_id", pa.int64()), ("part", pa.string()), ("digest", pa.binary()), ("mask", pa.int32())])


def _looked_at(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in stream:
        texts = batch.column(2).cast(pa.binary())
        masks, digests = [], []
        for text in texts:
            text = text.as_py()
            masks.append(text_failures(text))
            digests.append(hashlib.sha256(text).digest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1).cast(pa.string()), pa.array(digests, pa.binary()),
             pa.array(masks, pa.int32())], schema=_FOUND)


def mask_counts(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """(part, mask, docs, good, toxic): documents of every part by the filters they fail.

    Texts are read once; only ids, parts and digests are shuffled. Copies are compared by
    SHA-256. A document of NULL id has no smaller id beside it and is none for others, and no
    label. Of several labels of an id any 1 counts. Rows repeated with their id pass E together.
    """
    given = documents(docs, F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"))
    found = stored(given.select("doc_id", "part", "text").mapInArrow(
        _looked_at, "doc_id long, part string, digest binary, mask int"), "filter-masks")
    marks = (labels.filter(F.col("doc_id").isNotNull())
             .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"),
                  F.max((F.col("toxic") == 1).cast("int")).alias("toxic")))
    # One row per text, found with partial sums, so a text that many share is no hot key;
    # the join below is on (digest, id).
    firsts = (found.filter(F.col("doc_id").isNotNull()).groupBy("digest")
              .agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True)))
    fails = F.col("doc_id").isNotNull() & F.col("first").isNull()
    return (found.groupBy("doc_id", "part", "digest", "mask").agg(F.count(F.lit(1)).alias("rows"))
            .join(firsts, ["digest", "doc_id"], "left").join(marks, "doc_id", "left")
            .withColumn("mask", F.col("mask") + F.when(fails, 1 << DUPLICATE).otherwise(0))
            .groupBy("part", "mask")
            .agg(F.sum("rows").alias("docs"),
                 F.sum(F.col("rows") * F.coalesce("good", F.lit(0))).alias("good"),
                 F.sum(F.col("rows") * F.coalesce("toxic", F.lit(0))).alias("toxic")))


_AUDIT = ("part string, filter_order string, step int, kept long, removed long, redundant long, "
          "unique_fails long, good_lost long, toxic_lost long, shapley long")
_COLUMNS = [piece.split()[0] for piece in _AUDIT.split(", ")]


def interaction_audit(counts: DataFrame, filters: Sequence[str] = FILTERS) -> DataFrame:
    """Every part, order and step of ``filters``, from (part, mask, docs, good, toxic) rows.

    A part has at most 2**len(filters) masks, whatever its documents; rows of one mask are
    added up first. No rows give no parts.
    """
    letters = list(filters)

    def audited(masks: pa.Table) -> pa.Table:
        own = {mask: (docs, good, toxic) for mask, docs, good, toxic in zip(
            *(masks[name].to_pylist() for name in ("mask", "docs", "good", "toxic")))}
        part = masks["part"][0].as_py()
        rows = [(part, "".join(letters[v] for v in order), step, int(kept[0]), int(removed[0]),
                 redundant, alone, int(removed[1]), int(removed[2]), total)
                for order, step, kept, removed, redundant, alone, total in audit_part(own, len(letters))]
        kinds = [pa.string(), pa.string(), pa.int32(), *[pa.int64()] * 7]
        return pa.table([pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)], names=_COLUMNS)

    added = counts.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("docs", "good", "toxic")])
    return added.groupBy("part").applyInArrow(audited, _AUDIT)


def filter_audit(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """The audit of filters A to E over whole ``docs``; see ``mask_counts`` for odd rows."""
    return interaction_audit(mask_counts(docs, labels, part))
