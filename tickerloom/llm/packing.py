"""Shortest-pack-first packing of tokenized documents into fixed-length sequences.

A document is cut every ``length`` tokens; what remains at its end is one shorter piece.
Placement never looks at documents, only at how many pieces have each length: lengths are
placed longest first, each into the pack with the most room left, and packs with the same
contents are one *pattern* with a count. Patterns say which ranks of a length they take,
so a join on (length, rank) gives every piece its sequence and offset.

The histogram has at most ``length`` rows. Placing one length costs at most one step per
open pattern, and a step adds at most one pattern, so patterns number at most a few per
length; a pattern holds at most sqrt(2 * length) different lengths. This bounds what the
driver and the broadcast hold, whatever the number of documents.
"""

from __future__ import annotations

import sys
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.common import batches, documents, ordinals, stored
from tickerloom.llm.tokens import encoder, public_files

SEQUENCE_TOKENS = 2048
END_OF_DOCUMENT = 1

_PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                     ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())])
_PIECE_COLUMNS = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def token_pieces(docs: DataFrame, length: int = SEQUENCE_TOKENS,
                 files: tuple[str, str] | None = None) -> DataFrame:
    """One row per piece: each document's ids with the end id, cut every ``length`` ids.

    A NULL or empty text is the end id alone. Repeated rows give repeated pieces.
    """
    vocabulary, ranks = files or public_files()
    end = array("I", [END_OF_DOCUMENT]).tobytes()
    if sys.byteorder != "little":
        raise RuntimeError("ids are checksummed as little-endian numbers")

    def cut(doc_id: int | None, text: str) -> Iterator[tuple]:
        ids = encoder(vocabulary, ranks).ids_bytes(text) + end
        total, step = len(ids) // 4, length * 4
        for at in range(0, len(ids), step):
            piece = ids[at:at + step]
            yield doc_id, at // 4, len(piece) // 4, zlib.crc32(piece), total

    def pieces(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches(
            (piece for batch in stream
             for doc_id, text in zip(batch.column(0), batch.column(1))
             for piece in cut(doc_id.as_py(), text.as_py())), _PIECES)

    return documents(docs).mapInArrow(pieces, _PIECE_COLUMNS)


@dataclass
class Pattern:
    """``count`` sequences that hold the same multiset of lengths."""

    slots: tuple[tuple[int, int], ...]      # (length, how many), longest first
    count: int


def shortest_pack_first(histogram: dict[int, int], length: int) -> list[Pattern]:
    """Patterns that place every counted piece: longest first, into the emptiest pack."""
    by_room: dict[int, list[Pattern]] = {}
    for size in sorted(histogram, reverse=True):
        left = histogram[size]
        while left:
            room = max(by_room, default=0)
            if room < size:
                # No open pack takes this length: open packs, one piece each.
                by_room.setdefault(length - size, []).append(Pattern(((size, 1),), left))
                break
            same = by_room[room]
            pattern = same.pop()
            if not same:
                del by_room[room]
            # Equal packs fill evenly, so a pack may take several pieces of this length
            # only once all packs with as much room have taken one.
            taken = min(left, pattern.count)
            slots = pattern.slots
            if slots[-1][0] == size:
                slots = (*slots[:-1], (size, slots[-1][1] + 1))
            else:
                slots = (*slots, (size, 1))
            by_room.setdefault(room - size, []).append(Pattern(slots, taken))
            if pattern.count > taken:
                by_room.setdefault(room, []).append(Pattern(pattern.slots, pattern.count - taken))
            left -= taken
    return [p for room in sorted(by_room) for p in by_room[room]]


def pattern_slots(patterns: list[Pattern]) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(length, first rank, ranks, pieces per sequence, first sequence, offset) per slot."""
    next_rank: dict[int, int] = {}
    first_sequence = 0
    for pattern in patterns:
        offset = 0
        for size, each in pattern.slots:
            rank = next_rank.get(size, 0)
            ranks = each * pattern.count
            next_rank[size] = rank + ranks
            yield size, rank, ranks, each, first_sequence, offset
            offset += size * each
        first_sequence += pattern.count


def pack(docs: DataFrame, length: int = SEQUENCE_TOKENS,
         files: tuple[str, str] | None = None) -> DataFrame:
    """Every piece of every document with its sequence and its offset there.

    Columns: those of ``token_pieces`` plus ``sequence_id`` and ``offset``; further columns
    of ``docs`` are not carried. Repeated and NULL ``doc_id`` are packed like any other row.
    An empty table gives an empty result.
    """
    spark = docs.sparkSession
    pieces = stored(token_pieces(docs, length, files), "token-pieces")
    # At most ``length`` rows.
    histogram = {r["length"]: r["n"]
                 for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    slots = spark.createDataFrame(
        list(pattern_slots(shortest_pack_first(histogram, length))),
        "length long, _rank long, _ranks long, _each long, _sequence long, _offset long")
    ranked = ordinals(pieces, "length", ["doc_id", "start", "ids_crc32"], "_piece",
                      sum(histogram.values()))
    inside = ((ranked["length"] == slots["length"])
              & ranked["_piece"].between(slots["_rank"], slots["_rank"] + slots["_ranks"] - 1))
    nth = F.col("_piece") - F.col("_rank")
    # The slots are bounded by the sequence length alone (see above), so they may be sent out.
    return (ranked.join(F.broadcast(slots), inside)
            .select("doc_id", "start", ranked["length"], "ids_crc32", "doc_tokens",
                    (F.col("_sequence") + F.expr("(_piece - _rank) div _each")).alias("sequence_id"),
                    (F.col("_offset") + ranked["length"] * (nth % F.col("_each"))).alias("offset")))
