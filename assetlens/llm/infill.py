"""Fill-in-the-middle: a text is cut twice and its parts are written in another order, so that a model learns to infill.

Cuts fall between units (code points, words or lines). The bytes of all texts of a slice are labelled with character
classes, and a wavelet matrix over the classes answers how many bytes of a class stand before a place. The ranks of the
classes that begin a unit add up to the number of units before a place; bisection on that number finds both
cuts, for all texts of the slice at once. The matrix holds a quarter of a byte per byte of text and bit of the class.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from .common import slices

# The markers of the output.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

# Classes of a byte. The first byte of a code point has the class of what begins there.
CONTINUED, INNER, SPACE, WORD, LINE, LINE_WORD = range(6)
BITS = 3
UNITS = {"code_points": (INNER, SPACE, WORD, LINE, LINE_WORD), "words": (WORD, LINE_WORD), "lines": (LINE, LINE_WORD)}


class WaveletMatrix:
    """Rank queries over a sequence of small numbers: one bit vector per bit, each stably sorted by the bit above it."""

    def __init__(self, symbols: np.ndarray, bits: int = BITS):
        self.size, self.bits, self.levels = len(symbols), bits, []
        for level in range(bits):
            bit = (symbols >> (bits - 1 - level)) & 1
            packed = np.zeros((self.size >> 6) + 1, np.uint64)
            packed.view(np.uint8)[:-(-self.size // 8)] = np.packbits(bit.astype(np.uint8), bitorder="little")
            before = np.zeros(len(packed), np.int64)
            np.cumsum(np.bitwise_count(packed[:-1]), out=before[1:])
            ones = bit.astype(bool)
            symbols = np.concatenate((symbols[~ones], symbols[ones]))
            self.levels.append((packed, before, self.size - int(ones.sum())))

    def _ones(self, level: int, at: np.ndarray) -> np.ndarray:
        """Set bits of a level before each place."""
        packed, before, _ = self.levels[level]
        word, low = at >> 6, (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return before[word] + np.bitwise_count(packed[word] & low)

    def rank(self, symbol: int, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands before each place."""
        ends = np.append(np.asarray(at, np.int64), 0)  # the last one is where the symbol's run begins
        for level in range(self.bits):
            ones = self._ones(level, ends)
            ends = self.levels[level][2] + ones if symbol >> (self.bits - 1 - level) & 1 else ends - ones
        return ends[:-1] - ends[-1]

    def count(self, symbols: Sequence[int], at: np.ndarray) -> np.ndarray:
        """How often any of ``symbols`` stands before each place."""
        return sum((self.rank(s, at) for s in symbols), np.zeros(len(at), np.int64))

    def locate(self, symbols: Sequence[int], nth: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The place of the ``nth`` (from 1) of ``symbols``, known to lie in [low, high), by bisection."""
        low, high = low.copy(), high.copy()  # count(low) < nth <= count(high)
        while np.any(high - low > 1):
            mid = (low + high) >> 1
            enough = self.count(symbols, mid) >= nth
            low, high = np.where(enough, low, mid), np.where(enough, mid, high)
        return low


def byte_classes(raw: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The class of every byte of UTF-8 texts that begin at ``starts`` (none of them empty)."""
    continued = raw & 0xC0 == 0x80
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    begins = np.zeros(len(raw), bool)
    begins[starts] = True
    after_space, after_line = begins.copy(), begins
    after_space[1:] |= space[:-1]
    after_line = begins.copy()
    after_line[1:] |= raw[:-1] == 10
    word = ~space & after_space
    out = np.full(len(raw), INNER, np.uint8)
    out[space], out[word], out[after_line], out[word & after_line] = SPACE, WORD, LINE, LINE_WORD
    out[continued] = CONTINUED
    return out


def cut_places(raw: np.ndarray, offsets: np.ndarray, first: np.ndarray, second: np.ndarray,
               unit: str) -> tuple[np.ndarray, ...]:
    """Per text: its units ``n``, the byte places after ``min`` and ``max`` of ``first % (n + 1)`` and
    ``second % (n + 1)`` units, and the code points before each place and in the text. Text before the first unit
    belongs to it."""
    low, high = offsets[:-1], offsets[1:]
    matrix = WaveletMatrix(byte_classes(raw, low[low < high]))
    marks, before = UNITS[unit], matrix.count(UNITS[unit], low)
    n = matrix.count(marks, high) - before
    a, b = first % (n + 1), second % (n + 1)

    def place(units: np.ndarray) -> np.ndarray:
        inside = (units > 0) & (units < n)
        at = np.where(units >= n, high, low)
        at[inside] = matrix.locate(marks, (before + units + 1)[inside], low[inside], high[inside])
        return np.where(units == 0, low, at)

    cuts = place(np.minimum(a, b)), place(np.maximum(a, b))
    points = matrix.count(UNITS["code_points"], low)
    chars = [matrix.count(UNITS["code_points"], c) - points for c in cuts]
    return n, *cuts, *chars


def draws(doc_id: Column, seed: int, n: int = 4) -> list[Column]:
    """Unsigned 32-bit numbers from SHA-256 of ``seed:id``; a null id counts as empty text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(n)]


def fill_in_middle(docs: DataFrame, unit: str = "code_points", seed: int = 1, plain_from: int = 90, spm_under: int = 20,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n, form, prefix_chars, middle_chars, output`` per input row.

    A row's four draws come from its id: two cuts between units, and two percentages that pick ``plain`` (from
    ``plain_from``), else ``spm`` (under ``spm_under``), else ``psm``. Texts that are empty or hold a marker stay plain.
    ``n`` counts units; the lengths count code points and are null where the form is plain. A null text counts as
    empty. Repeated rows get the same result each, rows of one id the same draws; other columns are not read, and an
    empty table gives an empty table. A text is held whole by one task; texts are taken in slices of some MB.
    """
    if unit not in UNITS:
        raise ValueError(f"unknown unit {unit}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                texts = part.column("text").fill_null("").cast(pa.large_binary())
                offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
                data = texts.buffers()[2]
                raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
                offsets = offsets - offsets[0]
                h1, h2, h3, h4 = (part.column(f"h{k}").to_numpy(zero_copy_only=False) for k in range(1, 5))
                n, one, two, prefix, until = cut_places(raw, offsets, h1, h2, unit)
                plain = (offsets[1:] == offsets[:-1]) | (h3 % 100 >= plain_from)
                for mark in (PREFIX, SUFFIX, MIDDLE):
                    plain |= pc.match_substring(texts, mark).to_numpy(zero_copy_only=False)
                form = np.where(plain, "plain", np.where(h4 % 100 < spm_under, "spm", "psm"))
                text, p, s, m = raw.tobytes(), PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
                out = []
                for k, at, x, y, end in zip(form, offsets[:-1].tolist(), one.tolist(), two.tolist(), offsets[1:].tolist()):
                    if k == "plain":
                        out.append(text[at:end])
                    elif k == "psm":
                        out.append(b"".join((p, text[at:x], s, text[y:end], m, text[x:y])))
                    else:
                        out.append(b"".join((s, text[y:end], p, text[at:x], m, text[x:y])))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(n), pa.array(form.tolist(), pa.string()), pa.array(prefix, mask=plain),
                     pa.array(until - prefix, mask=plain), pa.array(out, pa.string())],
                    ["id", "n", "form", "prefix_chars", "middle_chars", "output"])

    numbers = [d.alias(f"h{k}") for k, d in enumerate(draws(F.col(id_col), seed), 1)]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *numbers)
    return rows.mapInArrow(run, f"id {dict(docs.dtypes)[id_col]}, n long, form string, prefix_chars long, "
                                "middle_chars long, output string")


def restore(output: Column, form: Column) -> Column:
    """The text that an output was made from. No part holds a marker, so the first one found is the one written."""
    def parts(inner: str) -> Column:
        head = F.split(F.substr(output, F.lit(4)), inner, 2)
        tail = F.split(F.get(head, F.lit(1)), MIDDLE, 2)
        first, second = F.get(head, F.lit(0)), F.get(tail, F.lit(0))
        before, after = (first, second) if inner == SUFFIX else (second, first)
        return F.concat(before, F.get(tail, F.lit(1)), after)

    return F.when(form == "plain", output).when(form == "psm", parts(SUFFIX)).otherwise(parts(PREFIX))
