"""Fill-in-the-middle transformation of documents, cut between tokens or lines.

Every text gets a wavelet matrix over the classes of its characters. The number of unit
borders up to a character is the sum of the ranks of those classes that end a unit; a cut
after so many units is found by bisection on these sums. Cuts and forms come from a hash of
the id, so a repeated task gives the same rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.common import documents

SEED = 42
PLAIN, PSM, SPM = "plain", "psm", "spm"
MARKS = PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of 100 documents so many are transformed, and of 100 of those so many have the suffix first.
TRANSFORMED_PERCENT, SUFFIX_FIRST_PERCENT = 50, 80

# Classes of characters; the lowest bit says that the text ends there.
BLANK, BREAK, INNER, WORD_END = 0, 2, 4, 6
LAST = 1
#: The classes that end a unit. A token is a word with the white space before it, or white
#: space at the end of the text; a line ends with each line break, or with the text.
UNITS = {
    "token": (WORD_END, WORD_END | LAST, BLANK | LAST, BREAK | LAST),
    "line": (BREAK, BREAK | LAST, BLANK | LAST, WORD_END | LAST),
}


def character_classes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    breaks = (points >= 0x0A) & (points <= 0x0D)
    white = breaks | (points == 0x20) | (points == 0x09)
    classes = np.where(white, np.uint8(BLANK), np.uint8(INNER))
    classes[breaks] = BREAK
    ends = ~white
    ends[:-1] &= white[1:]
    classes[ends] = WORD_END
    if len(classes):
        classes[-1] |= LAST
    return classes


class _Bits:
    """A bit vector with the ones before every word of 64 counted."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        words = np.zeros(len(bits) // 64 + 1, np.uint64)
        words.view(np.uint8)[:len(packed)] = packed
        self._words = words
        before = np.zeros(len(words) + 1, np.int64)
        np.cumsum(np.bitwise_count(words), out=before[1:])
        self._before = before
        self.zeros = len(bits) - int(before[-1])

    def ones(self, end: int) -> int:
        """Ones among the first ``end`` bits."""
        word = end >> 6
        return int(self._before[word]) + (int(self._words[word]) & ((1 << (end & 63)) - 1)).bit_count()


class WaveletMatrix:
    """Rank over a sequence of small numbers, one bit vector per binary digit."""

    def __init__(self, symbols: np.ndarray, digits: int):
        self.length = len(symbols)
        self._levels = []
        for digit in range(digits - 1, -1, -1):
            bits = (symbols >> digit) & 1
            self._levels.append((digit, _Bits(bits)))
            ones = bits.astype(bool)
            symbols = np.concatenate([symbols[~ones], symbols[ones]])

    def rank(self, symbol: int, end: int) -> int:
        """How often ``symbol`` occurs among the first ``end``."""
        start = 0
        for digit, bits in self._levels:
            if symbol >> digit & 1:
                start, end = bits.zeros + bits.ones(start), bits.zeros + bits.ones(end)
            else:
                start, end = start - bits.ones(start), end - bits.ones(end)
            if start == end:
                return 0
        return end - start


class Cutter:
    """Units of a text and where they end."""

    def __init__(self, text: str, unit: str = "token"):
        self._matrix = WaveletMatrix(character_classes(text), 3)
        present = [c for c in UNITS[unit] if self._matrix.rank(c, self._matrix.length)]
        self._ending = present
        self.units = self.borders(self._matrix.length)

    def borders(self, end: int) -> int:
        """Units that end among the first ``end`` characters."""
        return sum(self._matrix.rank(c, end) for c in self._ending)

    def after(self, units: int) -> int:
        """Characters of the first ``units`` units: the least position with so many borders."""
        low, high = 0, self._matrix.length
        while low < high:
            middle = (low + high) // 2
            if self.borders(middle) < units:
                low = middle + 1
            else:
                high = middle
        return low


def draws(doc_id: int | None, seed: int = SEED) -> list[int]:
    """Four numbers below 2**32 from the id; a NULL id counts as an empty one."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[at:at + 4], "big") for at in (0, 4, 8, 12)]


def transformed(doc_id: int | None, text: str, unit: str = "token", seed: int = SEED,
                percent: int = TRANSFORMED_PERCENT, suffix_first: int = SUFFIX_FIRST_PERCENT) -> tuple:
    """(units, form, prefix_chars, middle_chars, output) of one text."""
    cutter = Cutter(text, unit)
    first, second, chosen, order = draws(doc_id, seed)
    if not text or chosen % 100 >= percent or any(mark in text for mark in MARKS):
        return cutter.units, PLAIN, None, None, text
    lower, upper = sorted((first % (cutter.units + 1), second % (cutter.units + 1)))
    one, two = cutter.after(lower), cutter.after(upper)
    prefix, middle, suffix = text[:one], text[one:two], text[two:]
    if order % 100 < suffix_first:
        return cutter.units, SPM, one, two - one, "".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))
    return cutter.units, PSM, one, two - one, "".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made of.

    A transformed text holds no mark, and a mark can overlap neither another nor the text
    around it, so an output has exactly the three that were put in.
    """
    parts = F.split(output, "<[PSM]>", -1)
    return (F.when(form == PLAIN, output)
            .when(form == PSM, F.concat(parts[1], parts[3], parts[2]))
            .otherwise(F.concat(parts[2], parts[3], parts[1])))


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()),
                     ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())])
#: Characters of one Arrow batch that leaves a task.
BATCH_CHARS = 8 << 20


def fill_in_middle(docs: DataFrame, unit: str = "token", seed: int = SEED,
                   percent: int = TRANSFORMED_PERCENT,
                   suffix_first: int = SUFFIX_FIRST_PERCENT) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row of ``docs``.

    ``n`` counts the units of the whole text. NULL and empty texts stay as they are, with no
    units, as do texts that hold a mark. Repeated rows give repeated rows; other columns are not
    read. One text at a time is held with its matrix, about eight bytes a character.
    """
    def moved(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in stream:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                number = doc_id.as_py()
                held.append((number, *transformed(number, text.as_py(), unit, seed, percent, suffix_first)))
                size += len(held[-1][-1])
                if size >= BATCH_CHARS or len(held) >= 4096:
                    yield _batch(held)
                    held, size = [], 0
        if held:
            yield _batch(held)

    return documents(docs).mapInArrow(
        moved, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(column, field.type) for column, field in zip(zip(*rows), _SCHEMA)], schema=_SCHEMA)
