"""Jaccard self-join of documents on word shingles by parity sketches.

Documents with equal shingle sets form one class; everything below is done once per class.

Two sets of a high similarity differ in few shingles: for 0.9 in at most a ninth of the
smaller one, for 0.8 in a quarter. Each set is hashed into blocks of bits by XOR (a bit is the parity of the
shingles that fall on it), a few blocks more than sets of its size band may differ in
shingles. A differing shingle flips one bit, so the Hamming distance of two sketches bounds
their difference from below, and some block of a similar pair is untouched. Classes
that agree in a block are candidates; sizes, sketches and at last the sets decide.

Blocks shared by many classes are not expanded into all pairs. First every class is
compared with one class of its group (a star). Groups whose classes then belong to one
component need nothing more. In the others the remaining pairs from different components
are screened by their sketches, in square cells of bounded side, and verified.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.common import batches, documents, stored
from tickerloom.llm.components import components

SCALE = 100


@dataclass(frozen=True)
class Rule:
    """Linked when SCALE * intersection >= share * union, on shingles of so many words."""

    words: int = 3
    share: int = 90

    def sizes_fit(self, small, large):
        return SCALE * small >= self.share * large

    def similar(self, a: np.ndarray, b: np.ndarray) -> bool:
        if not self.sizes_fit(min(len(a), len(b)), max(len(a), len(b))):
            return False
        common = len(np.intersect1d(a, b, assume_unique=True))
        return SCALE * common >= self.share * (len(a) + len(b) - common)

    def most_differing(self, size):
        """Shingles in which a set of this size may differ from one that is not smaller."""
        return size * (SCALE - self.share) // self.share

    def size_bands(self, largest: int = 1 << 40) -> list[int]:
        """Upper ends of bands such that a similar set lies in the same band or in the next one."""
        ends = [self.share // (SCALE - self.share) - 1]     # smaller sets link with equal ones only
        while ends[-1] < largest:
            ends.append(max(ends[-1] + 1, ends[-1] * SCALE // self.share))
        return ends


@functools.lru_cache
def _bands(rule: Rule) -> np.ndarray:
    return np.array(rule.size_bands(), np.int64)


#: One block more for so many shingles in which sets may differ.
SURPLUS = 4
SCREEN_BITS = 512
#: Classes along the side of a cell in which pairs are screened together.
CELL_SIDE = 256
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(x: np.ndarray, salt: int) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * (_A + np.uint64(2 * salt))
    return x ^ (x >> np.uint64(29))


def shingles(text: str, words: int) -> np.ndarray:
    """Sorted distinct hashes of the word shingles; all words as one where there are fewer.

    Words are parted by ASCII white space and A-Z are lower-cased, nothing else.
    """
    own = text.encode("utf-8", "surrogatepass").lower().split()
    if not own:
        return np.zeros(0, np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, own), np.uint64, len(own))
    size = min(words, len(own))
    total = np.full(len(own) - size + 1, size, np.uint64)
    for n in range(size):
        total = _mixed(total * _B + hashed[n:len(own) - size + 1 + n], n + 1)
    return np.unique(total)


def signatures(own: np.ndarray, rule: Rule) -> np.ndarray:
    """One number per block: of the own band, and of the band below as the larger set.

    The blocks are wide parity sketches, known by the XOR of the hashes of their odd positions.
    Blocks on which no shingle falls look alike in all sets, so they are left out where that
    loses nothing: there are more blocks than shingles in which similar sets may differ, and of
    the untouched ones at least one has shingles if fewer than the surplus are empty. That holds
    for a pair as soon as it holds for one of them.
    """
    bands = _bands(rule)
    band = int(np.searchsorted(bands, len(own)))
    out = []
    for level in (band, band - 1):
        if level < 1:
            continue
        differing = rule.most_differing(int(bands[level]))
        surplus = differing // SURPLUS + 2
        blocks = differing + surplus
        mixed = _mixed(own, 11 + level)
        place = ((mixed >> np.uint64(32)) % np.uint64(blocks)).astype(np.int64)
        parity = np.zeros(blocks, np.uint64)
        np.bitwise_xor.at(parity, place, _mixed(mixed, 13))
        name = np.arange(blocks, dtype=np.uint64) * _B + np.uint64(level)
        sigs = _mixed(_mixed(parity, 3) ^ _mixed(name, 5), 7)
        filled = np.zeros(blocks, bool)
        filled[place] = True
        out.append(sigs[filled] if blocks - filled.sum() < surplus else sigs)
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def screen(own: np.ndarray) -> bytes:
    """A parity sketch with about a bit per shingle, a power of two of bytes.

    Its Hamming distance bounds the difference from below, also after the longer of two has been
    folded to the width of the shorter one.
    """
    words = max(SCREEN_BITS // 64, 1 << max(0, (len(own) - 1) // 64).bit_length())
    parity = np.zeros(words, np.uint64)
    mixed = _mixed(own, 101)
    np.bitwise_xor.at(parity, ((mixed >> np.uint64(6)) % np.uint64(words)).astype(np.int64),
                      np.uint64(1) << (mixed & np.uint64(63)))
    return parity.tobytes()


def folded(sketch: bytes, width: int) -> np.ndarray:
    return np.bitwise_xor.reduce(np.frombuffer(sketch, np.uint64).reshape(-1, width // 8), axis=0)


def least_difference(a: bytes, b: bytes) -> int:
    width = min(len(a), len(b))
    return int(np.bitwise_count(folded(a, width) ^ folded(b, width)).sum())


_SKETCHED = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("cls", pa.int64()),
                       ("check", pa.int64()), ("screen", pa.binary())])


@dataclass(frozen=True)
class Names:
    """Numbers of equal shingle sets, from a hash of 128 bits.

    A set is known by one half (its lowest ``bits``). Among 10^10 sets a few pairs share it; those
    numbers are ``shared``, and their sets are known by the other half.
    """

    shared: frozenset[int] = frozenset()
    bits: int = 64

    def halves(self, own: np.ndarray) -> tuple[int, int]:
        both = np.frombuffer(xxhash.xxh3_128_digest(own.tobytes()), ">i8").tolist()
        return both[1] >> (64 - self.bits), both[0]

    def of(self, own: np.ndarray) -> int:
        first, other = self.halves(own)
        return other if first in self.shared else first


def _sketched(docs: DataFrame, rule: Rule, names: Names) -> DataFrame:
    def sketch(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in stream:
                for doc_id, text in zip(*batch.columns):
                    own = shingles(text.as_py(), rule.words)
                    yield doc_id.as_py(), len(own), *names.halves(own), screen(own)

        yield from batches(rows(), _SKETCHED)

    return docs.mapInArrow(sketch, "doc_id long, n long, cls long, check long, screen binary")


def _classes(sketched: DataFrame, label: str) -> DataFrame:
    """The distinct sets; where ``check`` and ``last`` differ, several have one number."""
    return stored(sketched.filter("n > 0").groupBy("cls").agg(
        F.min("doc_id").alias("doc_id"), F.min("n").alias("n"), F.first("screen").alias("screen"),
        F.min("check").alias("check"), F.max("check").alias("last")), label)


def _told_apart(sketched: DataFrame, names: Names) -> tuple[DataFrame, DataFrame, Names]:
    """(sketches, classes, names) in which every set has a number of its own."""
    classes = _classes(sketched, "classes")
    # About n * n / 2^65 numbers: three for 10^10 sets.
    shared = sorted(row["cls"] for row in classes.filter("check <> last").select("cls").collect())
    if not shared:
        return sketched, classes, names
    own = F.when(F.col("cls").isin(shared), F.col("check")).otherwise(F.col("cls"))
    apart = sketched.withColumn("cls", own)
    return apart, _classes(apart, "classes-apart"), Names(frozenset(shared), names.bits)


_PACKED = pa.schema([("bucket", pa.int32()), ("sigs", pa.list_(pa.int64())), ("classes", pa.list_(pa.int64()))])
#: Classes whose blocks a task remembers to have given, and pairs that it packs together.
GIVEN_CLASSES = 1_000_000
PACKED_PAIRS = 400_000


def _blocks(docs: DataFrame, rule: Rule, names: Names, buckets: int) -> DataFrame:
    """(bucket, sigs, classes): the blocks of every class, once per task that reads copies of it.

    Pairs (signature, class) are packed by the bucket of their signature: as single rows they
    would take three times as much in the shuffle. Blocks are made from the texts again rather
    than kept with the sketches, which are far smaller.
    """

    def block(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: set[int] = set()
        held: list[tuple[np.ndarray, int]] = []
        size = 0
        for batch in stream:
            for text in batch.column(0):
                own = shingles(text.as_py(), rule.words)
                cls = names.of(own)
                if not len(own) or cls in given:
                    continue
                if len(given) >= GIVEN_CLASSES:
                    given.clear()
                given.add(cls)
                held.append((signatures(own, rule), cls))
                size += len(held[-1][0])
                if size >= PACKED_PAIRS:
                    yield _packed(held, buckets)
                    held, size = [], 0
        if size:
            yield _packed(held, buckets)

    return docs.select("text").mapInArrow(block, "bucket int, sigs array<long>, classes array<long>")


def _packed(held: list[tuple[np.ndarray, int]], buckets: int) -> pa.RecordBatch:
    sigs = np.concatenate([own for own, _ in held])
    classes = np.repeat(np.array([cls for _, cls in held], np.int64), [len(own) for own, _ in held])
    bucket = ((sigs >> np.uint64(48)) % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    names, first = np.unique(bucket[order], return_index=True)
    ends = pa.array(np.append(first, len(sigs)).astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [pa.array(names), pa.ListArray.from_arrays(ends, pa.array(sigs[order].astype(np.int64))),
         pa.ListArray.from_arrays(ends, pa.array(classes[order]))], schema=_PACKED)


def _unpacked(packed: DataFrame) -> DataFrame:
    """(sig, cls), without another Python worker beside the one that reads them."""
    return (packed.select(F.posexplode("sigs").alias("at", "sig"), "classes")
            .select("sig", F.get("classes", F.col("at")).alias("cls")))


_PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


_SHARED = pa.schema([("sig", pa.int64()), ("cls", pa.int64()), ("pivot", pa.int64())])
#: Buckets that the signatures are dealt to, per shuffle partition.
BUCKETS_PER_PARTITION = 2
MAX_BUCKETS = 1 << 14


def _shared_blocks(docs: DataFrame, rule: Rule, names: Names = Names()) -> DataFrame:
    """(sig, cls, pivot): the classes of every signature that several classes have.

    The pivot is the signature's first class. Most signatures have one class; they leave no
    row, and the rest of the work never sees them. A task sorts its buckets, on disk where
    they are large, and streams through them.
    """

    def tie(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current = pivot = None      # the open signature and its first class
        alone = True                # whether that class was the only one so far
        last = None
        for batch in stream:
            sig, cls = (column.to_numpy() for column in batch.columns)
            # Rows are only looked at one by one where a neighbour has the same signature.
            again = np.flatnonzero(sig[1:] == sig[:-1]) + 1
            if len(sig) and sig[0] == current:
                again = np.concatenate([[0], again])
            out = []
            for at in again.tolist():
                own, number = int(sig[at]), int(cls[at])
                if own != current:
                    current, pivot, alone, last = own, int(cls[at - 1]), True, int(cls[at - 1])
                if number == last:
                    continue        # another task's copy
                if alone:
                    out.append((own, pivot, pivot))
                    alone = False
                out.append((own, number, pivot))
                last = number
            if len(sig) and int(sig[-1]) != current:
                current = int(sig[-1])
                pivot = last = int(cls[-1])
                alone = True
            yield from batches(out, _SHARED)

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packed = _blocks(docs, rule, names, min(MAX_BUCKETS, parts * BUCKETS_PER_PARTITION))
    return (_unpacked(packed.repartition(parts, "bucket")).sortWithinPartitions("sig", "cls")
            .mapInArrow(tie, "sig long, cls long, pivot long"))


_SETS = pa.schema([("cls", pa.int64()), ("own", pa.binary())])


def _sets(docs: DataFrame, rule: Rule, names: Names) -> DataFrame:
    def hashed(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches(((names.of(own), own.tobytes()) for batch in stream
                            for text in batch.column(0) for own in [shingles(text.as_py(), rule.words)]), _SETS, 256)

    return docs.select("text").mapInArrow(hashed, "cls long, own binary")


def _verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, rule: Rule, names: Names) -> DataFrame:
    """The pairs whose sets are similar. Only documents that stand for a candidate are moved."""
    wanted = (pairs.select(F.col("a").alias("cls")).unionAll(pairs.select("b")).distinct()
              .join(classes.select("cls", "doc_id"), "cls"))
    ids = wanted.select(F.col("doc_id").alias("wanted")).distinct()
    sets = (_sets(docs.join(ids, docs["doc_id"].eqNullSafe(ids["wanted"]), "left_semi"), rule, names)
            .join(wanted.select("cls"), "cls", "left_semi"))
    sets = stored(sets.groupBy("cls").agg(F.first("own").alias("own")), "shingle-sets")
    left = sets.select(F.col("cls").alias("a"), F.col("own").alias("own_a"))
    right = sets.select(F.col("cls").alias("b"), F.col("own").alias("own_b"))

    def verify(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches(
            ((a.as_py(), b.as_py()) for batch in stream for a, b, x, y in zip(*batch.columns)
             if rule.similar(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64))),
            _PAIRS)

    return (pairs.join(left, "a").join(right, "b").select("a", "b", "own_a", "own_b")
            .mapInArrow(verify, "a long, b long"))


def _screened(pairs: DataFrame, classes: DataFrame, rule: Rule) -> DataFrame:
    """The pairs whose sizes and sketches leave open that they are similar."""
    sketch = classes.select("cls", "n", "screen")
    a = sketch.select(*[F.col(x).alias(y) for x, y in (("cls", "a"), ("n", "n_a"), ("screen", "s_a"))])
    b = sketch.select(*[F.col(x).alias(y) for x, y in (("cls", "b"), ("n", "n_b"), ("screen", "s_b"))])

    def screened(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            if not batch.num_rows:
                continue
            keep = [_open(*(x.as_py() for x in row), rule) for row in zip(*batch.columns[2:])]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return (pairs.join(a, "a").join(b, "b").select("a", "b", "n_a", "n_b", "s_a", "s_b")
            .mapInArrow(screened, "a long, b long"))


def _open(n_a: int, n_b: int, a: bytes, b: bytes, rule: Rule) -> bool:
    small, large = min(n_a, n_b), max(n_a, n_b)
    return rule.sizes_fit(small, large) and least_difference(a, b) <= rule.most_differing(small)


def _rest_pairs(shared: DataFrame, roots: DataFrame, classes: DataFrame, rule: Rule) -> DataFrame:
    """Pairs that may be similar, are in different components and share an open signature.

    The open signatures with the same least component form a family, whose classes are
    compared with each other in square cells: every pair of one signature is among them, and
    a class is in a family once, however many of its signatures are.
    """
    rooted = (shared.join(roots, shared["cls"] == roots["node"], "left")
              .select("sig", "cls", F.coalesce("root", "cls").alias("root")))
    open_groups = (rooted.groupBy("sig")
                   .agg(F.count(F.lit(1)).alias("g"), F.min("root").alias("family"),
                        F.max("root").alias("last"))
                   # Of two classes the star has compared the only pair.
                   .filter((F.col("g") > 2) & (F.col("family") < F.col("last")))
                   .select("sig", "family"))
    members = stored(rooted.join(open_groups, "sig").select("family", "cls", "root").distinct(), "families")
    sides = members.groupBy("family").agg(
        F.ceil(F.count(F.lit(1)) / CELL_SIDE).cast("int").alias("side"))
    placed = (members.join(sides, "family").join(classes.select("cls", "n", "screen"), "cls")
              .withColumn("own", F.pmod(F.xxhash64("cls"), F.col("side")).cast("int")))
    cells = (placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("side") - 1)))
             .select("family", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                     "own", "cls", "n", "root", "screen"))

    def screened(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches((pair for cell in _cells(stream) for pair in _screened_cell(cell, rule)), _PAIRS)

    return (cells.repartition("family", "i", "j").sortWithinPartitions("family", "i", "j")
            .mapInArrow(screened, "a long, b long").distinct())


def _cells(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one cell after the other; a cell has a bounded number of rows."""
    held: list[pa.RecordBatch] = []
    key = None
    for batch in stream:
        if not batch.num_rows:
            continue
        names = np.stack([batch.column(x).to_numpy().astype(np.int64) for x in ("family", "i", "j")])
        edges = (np.flatnonzero((names[:, 1:] != names[:, :-1]).any(axis=0)) + 1).tolist()
        for first, last in zip([0, *edges], [*edges, batch.num_rows]):
            own = tuple(names[:, first].tolist())
            if own != key and held:
                yield pa.Table.from_batches(held)
                held = []
            key = own
            held.append(batch.slice(first, last - first))
    if held:
        yield pa.Table.from_batches(held)


def _screened_cell(cell: pa.Table, rule: Rule) -> Iterator[tuple[int, int]]:
    i, j = cell["i"][0].as_py(), cell["j"][0].as_py()
    own, cls, n, root = (cell[x].to_numpy().astype(np.int64) for x in ("own", "cls", "n", "root"))
    sketches = cell["screen"].to_pylist()
    width = min(map(len, sketches))
    bits = np.stack([folded(x, width) for x in sketches])
    columns = np.flatnonzero(own == j)
    for at in np.flatnonzero(own == i):
        small, large = np.minimum(n[at], n[columns]), np.maximum(n[at], n[columns])
        distance = np.bitwise_count(bits[at] ^ bits[columns]).sum(axis=1)
        keep = ((root[at] != root[columns]) & rule.sizes_fit(small, large)
                & (distance <= rule.most_differing(small)))
        for other in columns[keep].tolist():
            if i == j and cls[at] >= cls[other]:
                continue
            # What passes at the width of the cell is looked at in full.
            if _open(int(n[at]), int(n[other]), sketches[at], sketches[other], rule):
                yield min(int(cls[at]), int(cls[other])), max(int(cls[at]), int(cls[other]))


def linked_documents(docs: DataFrame, rule: Rule = Rule(), names: Names = Names()) -> DataFrame:
    """(doc_id, n_shingles, component_id): components of all documents under the rule.

    ``component_id`` is the smallest doc_id reachable, the own one included. A document
    without words has no shingles and is linked with nothing. Repeated rows are copies of each
    other. A NULL doc_id takes part and never names a component that has another id.
    """
    rows = documents(docs)
    sketched, classes, names = _told_apart(stored(_sketched(rows, rule, names), "sketches"), names)
    shared = stored(_shared_blocks(rows, rule, names), "shared-blocks")
    stars = stored(shared.filter("cls != pivot").select(
        F.least("cls", "pivot").alias("a"), F.greatest("cls", "pivot").alias("b")).distinct(), "star-pairs")
    candidates = stored(_screened(stars, classes, rule), "star-candidates")
    linked = stored(_verified(candidates, rows, classes, rule, names), "star-links")
    roots = components(linked, "star-components")
    rest = stored(_rest_pairs(shared, roots, classes, rule).join(stars, ["a", "b"], "left_anti"), "rest-pairs")
    if not rest.isEmpty():
        more = stored(_verified(rest, rows, classes, rule, names), "rest-links")
        roots = components(linked.unionAll(more), "all-components")
    rooted = (classes.join(roots, classes["cls"] == roots["node"], "left")
              .select("cls", "doc_id", F.coalesce("root", "cls").alias("root")))
    smallest = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = rooted.join(smallest, "root").select("cls", "component_id")
    return (sketched.filter("n > 0").select("doc_id", "n", "cls").join(named, "cls")
            .select("doc_id", "n", "component_id")
            .unionAll(sketched.filter("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id")))
            .select("doc_id", F.col("n").alias("n_shingles"), "component_id"))
