"""Document fingerprints as invertible Bloom lookup sketches of paragraph digests.

A paragraph is a line; long lines are parted further at content-defined places, so an edit
changes only the parts it touches. Every part's digest goes into three cells; a cell keeps a
count, the XOR of digests and the XOR of their checks. Subtracting the sketches of two
versions leaves the parts that differ, and peeling cells that hold a single one recovers
their digests. Where peeling gets stuck, both sketches are built again with twice the cells.

A fingerprint is the smallest sketch with the number of parts. The likeness of two is the
share of common parts, 2-sided: common / all.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.common import batches, documents

HASHES = 3
#: Cells of the stored sketch, and of the first try of a comparison.
CELLS = 24
# A line is parted behind a mark, or behind a word that ends in one of a few letters; a short
# text behind every word. What is still long, as in scripts without spaces, is parted where a
# hash of the last three characters says so. Where a part ends depends on the text right before
# it only.
_LINES = re.compile(r"\n|(?<=[.,;:!?|%*#&$dgmuzê])\s")
_WORDS = re.compile(r"\s")
SHORT_CHARS = 300
LONGEST_PART = 256
#: Longer parts of a text, or of a short text, are parted by hash, one in so many characters.
UNBROKEN, UNBROKEN_SHORT = (64, 16), (16, 4)
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))
_CHECK = np.uint64(0xD6E8FEB86659FD93)


def _by_hash(long: list[str], one_in: int) -> list[list[str]]:
    """Every one of these parts cut where the hash of three characters of it says so."""
    codes = np.frombuffer("".join(long).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    mixed = (codes[:-2] * _MIX[0] + codes[1:-1]) * _MIX[1] + codes[2:]
    mixed = (mixed ^ (mixed >> np.uint64(29))) * _MIX[2]
    ends = np.flatnonzero((mixed >> np.uint64(40)) % np.uint64(one_in) == 0) + 3
    borders = np.cumsum([0, *map(len, long)])
    # Characters on both sides of a border are not next to each other in the text.
    own = np.searchsorted(borders, ends, side="left") - 1
    inside = ends - borders[own] >= 3
    ends, own = (ends - borders[own])[inside], own[inside]
    first = np.searchsorted(own, np.arange(len(long) + 1)).tolist()
    ends = ends.tolist()
    return [[part[a:b] for a, b in pairwise([0, *ends[first[n]:first[n + 1]], len(part)]) if a < b]
            for n, part in enumerate(long)]


def parts(text: str) -> list[str]:
    """Paragraph parts in order; together they are the whole text, but for blank ones."""
    short = len(text) <= SHORT_CHARS
    found = list(filter(None, (_WORDS if short else _LINES).split(text)))
    longest, one_in = UNBROKEN_SHORT if short else UNBROKEN
    if max(map(len, found), default=0) <= longest:
        return found
    cut = iter(_by_hash([part for part in found if len(part) > longest], one_in))
    out: list[str] = []
    for part in found:
        if len(part) <= longest:
            out.append(part)
            continue
        for piece in next(cut):
            # A text of one character has no such places: slices from where its part begins.
            if len(piece) <= LONGEST_PART:
                out.append(piece)
            else:
                out.extend(piece[at:at + LONGEST_PART] for at in range(0, len(piece), LONGEST_PART))
    return out


def digests(text: str) -> np.ndarray:
    """Digest of every part; the n-th repeat of a part has a digest of its own."""
    own = parts(text)
    once = dict.fromkeys(own)
    found = np.fromiter(map(xxhash.xxh3_64_intdigest, once), np.uint64, len(once))
    if len(once) == len(own):
        return found
    repeats = [xxhash.xxh3_64_intdigest(f"{n}\0{part}")
               for part, copies in Counter(own).items() if copies > 1 for n in range(1, copies)]
    # A digest may stand in a sketch once only, or it would cancel itself out.
    return np.unique(np.concatenate([found, np.array(repeats, np.uint64)]))


def _spread(keys: np.ndarray, salt: np.uint64) -> np.ndarray:
    mixed = (keys ^ (keys >> np.uint64(31))) * salt
    return mixed ^ (mixed >> np.uint64(29))


class Sketches:
    """The sketches of many documents side by side, each with its own number of cells."""

    def __init__(self, sizes: np.ndarray):
        self.sizes = sizes
        self.first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        total = int(self.first[-1])
        self.count = np.zeros(total, np.int64)
        self.keys = np.zeros(total, np.uint64)
        self.checks = np.zeros(total, np.uint64)

    def cells(self, owner: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """(HASHES, n) cell numbers; each hash has a third of a sketch for itself."""
        third = self.sizes[owner] // HASHES
        return np.stack([self.first[owner] + n * third
                         + (_spread(keys, salt) % third.astype(np.uint64)).astype(np.int64)
                         for n, salt in enumerate(_MIX)])

    def add(self, owner: np.ndarray, keys: np.ndarray, sign: np.ndarray | int) -> None:
        checks = _spread(keys, _CHECK)
        for cells in self.cells(owner, keys):
            np.add.at(self.count, cells, sign)
            np.bitwise_xor.at(self.keys, cells, keys)
            np.bitwise_xor.at(self.checks, cells, checks)

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(owner, key, sign) of every recovered digest, and which sketches came out empty."""
        owner_of = np.repeat(np.arange(len(self.sizes)), self.sizes)
        owners, keys, signs = [], [], []
        live = np.arange(len(self.count))
        while True:
            pure = live[(np.abs(self.count[live]) == 1)
                        & (self.checks[live] == _spread(self.keys[live], _CHECK))]
            if not len(pure):
                break
            # The same digest may be alone in several of its cells. One that shares this number
            # with another sketch's is left for the next round.
            number = self.keys[pure] ^ (owner_of[pure].astype(np.uint64) * _MIX[1])
            _, once = np.unique(number, return_index=True)
            pure = pure[once]
            owner, key, sign = owner_of[pure], self.keys[pure].copy(), self.count[pure].copy()
            self.add(owner, key, -sign)
            owners.append(owner), keys.append(key), signs.append(sign)
            live = live[(self.count[live] != 0) | (self.keys[live] != 0)]
        stuck = np.zeros(len(self.sizes), bool)
        stuck[owner_of[(self.count != 0) | (self.keys != 0)]] = True
        join = lambda arrays, kind: np.concatenate(arrays) if arrays else np.zeros(0, kind)
        return join(owners, np.int64), join(keys, np.uint64), join(signs, np.int64), ~stuck


def sketched(version: list[np.ndarray], cells: int = CELLS) -> Sketches:
    """Sketches of whole documents, all with the same number of cells."""
    sketches = Sketches(np.full(len(version), cells, np.int64))
    owner = np.repeat(np.arange(len(version)), [len(x) for x in version])
    sketches.add(owner, np.concatenate([np.zeros(0, np.uint64), *version]), 1)
    return sketches


def subtracted(sketches: Sketches, old: np.ndarray, new: np.ndarray) -> Sketches:
    """What is left of the sketches numbered ``old`` less those numbered ``new``, pair by pair."""
    cells = int(sketches.sizes[0]) if len(sketches.sizes) else CELLS
    left = Sketches(np.full(len(old), cells, np.int64))
    take = lambda values, which: values.reshape(-1, cells)[which].ravel()
    left.count = take(sketches.count, old) - take(sketches.count, new)
    left.keys = take(sketches.keys, old) ^ take(sketches.keys, new)
    left.checks = take(sketches.checks, old) ^ take(sketches.checks, new)
    return left


def _size(counts: np.ndarray) -> int:
    """Cells for the digests that differ, estimated from the counts of a subtracted sketch.

    In a third of m cells d digests with signs that sum to s give squares that sum to
    d (1 - 1 / m) + s^2 / m on average.
    """
    thirds = counts.reshape(HASHES, -1).astype(np.float64)
    m = thirds.shape[1]
    differ = ((thirds ** 2).sum() / HASHES - thirds[0].sum() ** 2 / m) / (1 - 1 / m) if m > 1 else 0
    wanted = max(2 * counts.size, 2 * differ, 2 * abs(int(thirds[0].sum())))
    return -(-int(wanted) // HASHES) * HASHES


def differences(old: list[np.ndarray], new: list[np.ndarray], cells: int = CELLS,
                left: Sketches | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per pair of versions the digests only the old and only the new one has.

    The first try takes what is ``left`` of the stored sketches. All pairs are peeled together;
    those that get stuck are tried again, with as many cells as the counts let expect and from
    then on with twice the cells. A sketch never needs to be larger than a few cells per digest,
    so this ends.
    """
    found: list = [None] * len(old)
    todo = list(range(len(old)))
    sketches = left or subtracted(sketched([*old, *new], cells), np.arange(len(old)),
                                  np.arange(len(old), 2 * len(old)))
    first = sketches.count.reshape(len(old), -1).copy() if todo else sketches.count
    sizes: dict[int, int] = {}
    while todo:
        owner, keys, signs, done = sketches.peel()
        order = np.argsort(owner, kind="stable")
        owner, keys, signs = owner[order], keys[order], signs[order]
        bounds = np.searchsorted(owner, np.arange(len(todo) + 1))
        for at, n in enumerate(todo):
            if done[at]:
                own, sign = keys[bounds[at]:bounds[at + 1]], signs[bounds[at]:bounds[at + 1]]
                found[n] = (own[sign > 0], own[sign < 0])
        todo = [n for at, n in enumerate(todo) if not done[at]]
        if todo:
            for n in todo:
                sizes[n] = 2 * sizes[n] if n in sizes else _size(first[n])
            sketches = Sketches(np.array([sizes[n] for n in todo], np.int64))
            for side, sign in ((old, 1), (new, -1)):
                owner = np.repeat(np.arange(len(todo)), [len(side[n]) for n in todo])
                sketches.add(owner, np.concatenate([side[n] for n in todo]), sign)
    return found


def encoded(version: list[np.ndarray], cells: int = CELLS, sketches: Sketches | None = None) -> list[str]:
    """The stored form: number of parts and cells, base64."""
    sketches = sketches or sketched(version, cells)
    # A count is that of a plain sum; XORs fold to 32 bits of check each.
    count, checks = sketches.count.astype("<u4"), (sketches.checks >> np.uint64(32)).astype("<u4")
    out = []
    for n, own in enumerate(version):
        at = slice(n * cells, (n + 1) * cells)
        packed = (len(own).to_bytes(4, "little") + count[at].tobytes()
                  + sketches.keys[at].astype("<u8").tobytes() + checks[at].tobytes())
        out.append(base64.b64encode(packed).decode())
    return out


def likeness(old: list[np.ndarray], new: list[np.ndarray], left: Sketches | None = None) -> np.ndarray:
    """Common parts over all parts of each pair, from the recovered differences; empty is like empty."""
    out = np.ones(len(old))
    for n, (gone, come) in enumerate(differences(old, new, left=left)):
        common = len(old[n]) - len(gone)
        total = common + len(gone) + len(come)
        out[n] = common / total if total else 1.0
    return out


# --- neighbours -----------------------------------------------------------------------------

#: Ranges of ids at most; their bounds are all that the driver and the map tasks hold.
MAX_RANGES = 16_384
RANGE_BYTES = 4 << 20
_LOWEST = -(1 << 63)


def in_order(docs: DataFrame) -> DataFrame:
    """(range, donor, doc_id, text) so that each range, sorted, also ends with its successor.

    Ids are cut into ranges at approximate quantiles. Documents move once, to their range; the
    document with the highest id of each range moves a second time, to the end of the range
    above, because it follows that range's lowest document. The highest of all follows the
    lowest of all. NULL ids sort last; documents of one id stand in the order of their texts.
    """
    rows = documents(docs).withColumn("doc_id", F.coalesce("doc_id", F.lit(_LOWEST)))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text") + F.lit(64)), F.lit(0))).first()[0]
    wanted = int(min(MAX_RANGES, max(4, -(-total // RANGE_BYTES))))
    cuts = rows.agg(F.percentile_approx("doc_id", [n / wanted for n in range(1, wanted)], 100_000)).first()[0]
    bounds = np.unique(np.array(cuts or [], np.int64))
    highest = {r["range"]: r["top"] for r in
               (_ranged(rows.select("doc_id"), bounds, {}).groupBy("range").agg(F.max("doc_id").alias("top"))
                .collect())}
    present = sorted(highest)
    # Which range also gets the top document of which: the next one above, around the end.
    target = {highest[low]: present[(at + 1) % len(present)] for at, low in enumerate(present)}
    return _ranged(rows, bounds, target)


_MOVED = "range int, donor int, doc_id long"


def _ranged(rows: DataFrame, bounds: np.ndarray, target: dict[int, int]) -> DataFrame:
    tops = np.array(sorted(target), np.int64)

    def place(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            ids = batch.column(0).to_numpy()
            own = np.searchsorted(bounds, ids, side="left").astype(np.int32)
            yield _with(batch, own, 0)
            if len(tops) and (again := np.flatnonzero(np.isin(ids, tops))).size:
                other = np.array([target[x] for x in ids[again].tolist()], np.int32)
                yield _with(batch.take(pa.array(again)), other, 1)

    names = rows.columns
    schema = _MOVED + (", text string" if "text" in names else "")

    def _with(batch: pa.RecordBatch, ranges: np.ndarray, donor: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(ranges), pa.array(np.full(len(ranges), donor, np.int32)), *batch.columns],
            names=["range", "donor", *names])

    return rows.mapInArrow(place, schema)


def edited(text: str, following: str) -> str:
    """The last half of the text replaced by as much of the beginning of the following one."""
    cut = len(text) // 2
    return text[:len(text) - cut] + following[:cut]


_RESULT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                     ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                     ("near_edited", pa.float64()), ("near_next", pa.float64())])
#: Documents compared together, and their characters together at most.
BLOCK_ROWS, BLOCK_CHARS = 512, 4 << 20


def fingerprints(docs: DataFrame, partitions: int | None = None) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how alike they are.

    near_edited compares a document with its edited text, near_next with the next document
    by descending id (around the end). NULL texts are empty; an empty text is like an empty
    one only. One document is its own successor. Extra columns are dropped.
    """
    spark = docs.sparkSession
    ordered = in_order(docs)
    number = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def compare(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: list[tuple[int, str, str]] = []
        size = 0
        for row in _pairs(stream):
            block.append(row)
            size += len(row[1]) + len(row[2])
            if len(block) >= BLOCK_ROWS or size >= BLOCK_CHARS:
                yield from batches(_compared(block), _RESULT)
                block, size = [], 0
        if block:
            yield from batches(_compared(block), _RESULT)

    return (ordered.repartition(number, "range")
            .sortWithinPartitions("range", "donor", F.col("doc_id").desc(), "text")
            .select("range", "donor", "doc_id", "text")
            .mapInArrow(compare, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                 "edited_fingerprint string, near_edited double, near_next double"))


def _pairs(stream: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, str, str]]:
    """Every document of a range with its successor; only the first donor of a range counts."""
    held: tuple[int, int, str] | None = None
    for batch in stream:
        for number, donor, doc_id, text in zip(*batch.columns):
            number, donor, doc_id, text = number.as_py(), donor.as_py(), doc_id.as_py(), text.as_py()
            if held and held[0] == number:
                yield held[1], held[2], text
            held = (number, doc_id, text) if not donor else None


def _compared(block: list[tuple[int, str, str]]) -> Iterator[tuple]:
    changed = [edited(text, following) for _, text, following in block]
    own = [digests(text) for _, text, _ in block]
    new = [digests(text) for text in changed]
    # Neighbours in a block follow each other, so most successors are known already.
    every, following = [*own, *new], []
    for n, row in enumerate(block):
        known = n + 1 < len(block) and block[n + 1][1] == row[2]
        following.append(n + 1 if known else len(every))
        if not known:
            every.append(digests(row[2]))
    sketches, at = sketched(every), np.arange(len(block))
    prints = encoded(every[:2 * len(block)], sketches=sketches)
    mine, theirs = prints[:len(block)], prints[len(block):]
    near_edited = likeness(own, new, subtracted(sketches, at, at + len(block)))
    near_next = likeness(own, [every[n] for n in following], subtracted(sketches, at, np.array(following)))
    for n, (doc_id, text, _) in enumerate(block):
        yield (None if doc_id == _LOWEST else doc_id, len(text),
               hashlib.sha256(changed[n].encode()).hexdigest(), mine[n], theirs[n],
               float(near_edited[n]), float(near_next[n]))
