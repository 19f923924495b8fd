"""Winnowing: document fingerprints from rolling hashes of runs of k units.

Units are up to four letters, marks or digits, counted from where a word begins (single characters in scripts that put no
spaces between words), and every other sign by itself; the text's first two code points stand before them as a unit of
their own. Each run of ``k`` units is hashed by a cyclic polynomial (rotate and exclusive-or of unit hashes). The hash of
every run is rolled up from those of its two halves, so all runs of a text cost log2(k) passes over its array. In
every window of ``window`` consecutive runs the smallest hash is chosen, the rightmost one on ties, again in
log2(window) passes; a run chosen by several windows is kept once, with its position. Two texts that share
``k + window - 1`` consecutive units share at least one whole window, and so at least one kept hash.

Runs and windows also reach back over the beginning of a text, where they hold what there is. So the first run is always
kept, there is no other rule for short texts, and a text keeps its likeness, whatever its length, when its end changes.

It is native array work on one row: no shuffle and no user function.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import let

K, WINDOW = 3, 3

# Blocks of scripts that put no spaces between words (Thai, Lao, Burmese, Khmer, kana, CJK ideographs).
UNSPACED = (r"\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u3040-\u30FF\u3400-\u4DBF\u4E00-\u9FFF\uF900-\uFAFF"
            r"\x{20000}-\x{323AF}")
#: Pieces of words, and other signs; in texts that hold an unspaced script, its characters stand alone. Both cut what is
#: outside these scripts alike.
UNIT_RE = r"[\p{L}\p{M}\p{N}]{1,4}|[^\p{L}\p{M}\p{N}\s]"
MIXED_RE = rf"[{UNSPACED}]|[\p{{L}}\p{{M}}\p{{N}}&&[^{UNSPACED}]]{{1,4}}|[^\p{{L}}\p{{M}}\p{{N}}\s]"
POSITION = 0x7FFFFFFF  # the low bits of a packed choice hold the position, counted down


def unit_hashes(text: Column) -> Column:
    """Hashes of the first two code points and the units of the lower-cased text; an empty text has none."""
    # the mixed pattern costs several times the plain one, so only texts that need it pay for it
    def hashed(lower: Column) -> Column:
        units = F.when(F.rlike(lower, F.lit(f"[{UNSPACED}]")), F.regexp_extract_all(lower, F.lit(MIXED_RE), F.lit(0))).otherwise(
            F.regexp_extract_all(lower, F.lit(UNIT_RE), F.lit(0)))
        first = F.substring(lower, 1, 2)
        return F.transform(F.when(first == "", units).otherwise(F.concat(F.array(first), units)), lambda t: F.xxhash64(t))
    return let(F.lower(text), hashed)


def _rotate(h: Column, by: int) -> Column:
    by %= 64
    return F.shiftleft(h, by).bitwiseOR(F.shiftrightunsigned(h, 64 - by)) if by else h


def _paired(a: Column, b: Column, step: int, join) -> Column:
    """``join(a[i], b[i + step])`` wherever both exist."""
    return F.slice(F.zip_with(a, F.slice(b, F.lit(1 + step), F.size(b)), join),
                   F.lit(1), F.greatest(F.size(b) - step, F.lit(0)))


def run_hashes(units: Column, k: int = K) -> Column:
    """The cyclic polynomial of the run that ends at each unit; the first ``k - 1`` begin before the text."""
    def rolled(t: Column, k: int) -> Column:
        if k == 1:
            return t
        half = k // 2
        if k % 2 == 0:
            return let(rolled(t, half), lambda h: _paired(h, h, half, lambda x, y: _rotate(x, half).bitwiseXOR(y)))
        return let(rolled(t, k - 1), lambda h: _paired(h, t, k - 1, lambda x, y: _rotate(x, 1).bitwiseXOR(y)))

    before = F.array_repeat(F.lit(0).cast("long"), k - 1)
    return let(F.concat(before, units), lambda t: rolled(t, k))


def winnow(hashes: Column, window: int = WINDOW) -> Column:
    """The rightmost smallest hash of every window, each position once, in order, as packed numbers: the upper bits
    of the hash (mixed once more, as the polynomial of equal units is not uniform) above the counted-down position, so that the
    smallest number is the smallest hash and, among equal ones, the rightmost."""
    packed = F.transform(hashes, lambda h, i: F.xxhash64(h).bitwiseAND(F.lit(~POSITION)).bitwiseOR(F.lit(POSITION) - i.cast("long")))

    def halved(values: Column, step: int) -> Column:
        return let(values, lambda m: _paired(m, m, step, lambda x, y: F.least(x, y)))

    nothing = F.array_repeat(F.lit(0x7FFFFFFFFFFFFFFF), window - 1)
    least, reach = F.concat(nothing, packed), 1
    while reach < window:
        step = min(reach, window - reach)
        least, reach = halved(least, step), reach + step
    return F.array_distinct(least)


def print_hash(packed: Column) -> Column:
    """The hash of a packed choice (its low bits are zero)."""
    return packed.bitwiseAND(F.lit(~POSITION))


def print_position(packed: Column) -> Column:
    """The unit that a chosen run ends with, from 0 (the first two code points)."""
    return (F.lit(POSITION) - packed.bitwiseAND(F.lit(POSITION))).cast("int")


def fingerprint(text: Column, k: int = K, window: int = WINDOW) -> Column:
    """Packed choices of a text, null counting as empty; an empty text has an empty fingerprint."""
    return let(F.coalesce(text, F.lit("")), lambda x: let(unit_hashes(x), lambda t: F.when(F.size(t) > 0, let(
        run_hashes(t, k), lambda h: winnow(h, window))).otherwise(F.array().cast("array<bigint>"))))


def fingerprint_id(prints: Column) -> Column:
    """A short name of a fingerprint: equal exactly if hashes and positions are (SHA-256)."""
    return F.sha2(F.array_join(F.transform(prints, lambda p: F.hex(p)), ",").cast("binary"), 256)


def likeness(a: Column, b: Column) -> Column:
    """Shared hashes against all (Dice): 1 for equal sets, two empty ones included, 0 for disjoint ones."""
    return let(F.struct(F.array_distinct(F.transform(a, print_hash)).alias("a"), F.array_distinct(F.transform(b, print_hash)).alias("b")),
               lambda s: F.when(F.size(s["a"]) + F.size(s["b"]) == 0, 1.0).otherwise(
                   2.0 * F.size(F.array_intersect(s["a"], s["b"])) / (F.size(s["a"]) + F.size(s["b"]))))


def fingerprint_documents(docs: DataFrame, k: int = K, window: int = WINDOW, id_col: str = "doc_id",
                          text_col: str = "text") -> DataFrame:
    """``id, fingerprint`` (array of hash and position) per input row. Null texts count as empty, repeated rows each get
    their row, other columns are not read, and an empty table gives an empty table."""
    prints = fingerprint(F.col(text_col), k, window)
    return docs.select(F.col(id_col).alias("id"), F.transform(prints, lambda p: F.struct(
        print_hash(p).alias("hash"), print_position(p).alias("position"))).alias("fingerprint"))
