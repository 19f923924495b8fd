"""Best-fit packing of token sequences by hierarchical residuals.

Round one runs where the documents are read: each task encodes its documents, cuts those longer than a sequence, and
packs its pieces best-fit, longest first, a bounded number at a time. Bins that are nearly full are done. The
underfull ones become items of the next round, dealt anew to as few groups as hold them and packed best-fit again, until
one group is left or a round gains next to nothing. A group has about ``group`` items, whatever the size of the
corpus and however little a round gains, and no document text or token is shuffled.

Each round is a table in the shared scratch folder, so a lost executor costs at most the tasks that were running.
"""

from __future__ import annotations

import functools
import math
import unicodedata
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from .common import slices, stored

CAPACITY = 4096
FULL = 0.995  # share of a sequence from which on a bin is done
GROUP = 16384  # most items that are packed together
FIELDS = ("doc_id", "piece", "start", "length", "crc", "offset")
WORDS = 200_000  # recurring words whose ids a task keeps at hand

ITEMS = "length int, done boolean, bin long, members array<struct<doc_id:{id},piece:int,start:long,length:int,crc:long,offset:int>>"


class WordEncoder:
    """Token ids (unsigned 32-bit) of whole texts, word by word.

    For a tokenizer that drops white space, so that no token reaches over it: a text's ids are those of its words
    in turn. Texts are cut at ASCII white space only; any other is left to the tokenizer. Each distinct word of a batch
    is encoded once, and words that recur in a batch are kept for later ones: an Arrow array of words beside their ids
    (``flat``, cut by ``ends``). A word of lower-case letters that need no normalising goes to
    the tokenizer's model directly, which gives the same ids at a third of the cost (``direct`` tells if it does).
    """

    def __init__(self, path: str, keep: int = WORDS):
        from tokenizers import Tokenizer

        self.tokenizer, self.keep = Tokenizer.from_file(path), keep
        self.model = self.tokenizer.model
        self._reset()
        probes = ["the", "straße", "élève", "xqzzk"]
        whole = [e.ids for e in self.tokenizer.encode_batch(probes, add_special_tokens=False)]
        self.direct = [self._by_model(w) for w in probes] == whole
        self.marks = {m: self.tokenizer.encode(m, add_special_tokens=False).ids for m in ",."} if self.direct else {}

    def _reset(self) -> None:
        self.words, self.flat, self.ends = pa.array([], pa.string()), np.zeros(0, "<u4"), np.zeros(0, np.int64)

    def _by_model(self, word: str) -> list[int]:
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(BYTE_CHARS)
        return [t.id for t in self.model.tokenize(word)]

    def _plain(self, word: str) -> bool:
        if word.isascii():
            return word.isalpha() and word.islower()
        return word.isalpha() and word.islower() and max(word) < "\u0180" and unicodedata.is_normalized("NFC", word)

    def _learn(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct words in turn, and how many each has."""
        slow = {}
        for word in words:
            if not self.direct or not self._plain(word[:-1] if word[-1:] in self.marks else word):
                slow[word] = None
        for at in range(0, len(slow), 20_000):
            part = list(slow)[at:at + 20_000]
            slow.update(zip(part, [e.ids for e in self.tokenizer.encode_batch(part, add_special_tokens=False)]))
        flat, sizes = array("I"), np.empty(len(words), np.int64)
        for n, word in enumerate(words):
            ids = slow.get(word)
            if ids is None:
                mark = self.marks.get(word[-1:])
                ids = self._by_model(word[:-1]) + mark if mark else self._by_model(word)
            flat.extend(ids)
            sizes[n] = len(ids)
        return np.frombuffer(flat, "<u4") if flat else np.zeros(0, "<u4"), sizes

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text (null: none) of a column: cut into words, number the distinct ones, encode those,
        and join their ids back by position."""
        texts = texts.fill_null("")
        if self.direct:
            # the tokenizer lower-cases; only its special tokens, which begin so, are told apart by case
            texts = pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))
        cut = pc.ascii_split_whitespace(texts)
        table = cut.flatten().dictionary_encode()
        at, bounds = table.indices.to_numpy(), cut.offsets.to_numpy() - cut.offsets[0].as_py()
        words = table.dictionary
        if len(self.words) > self.keep:
            self._reset()
        kept = pc.index_in(words, self.words)
        new = np.flatnonzero(kept.is_null().to_numpy(False))
        row_of = kept.fill_null(0).to_numpy(False).astype(np.int64)
        row_of[new] = len(self.words) + np.arange(len(new))
        found, counts = self._learn(words.take(pa.array(new)).to_pylist())
        flat = np.concatenate([self.flat, found])
        ends = np.concatenate([self.ends, np.cumsum(counts) + len(self.flat)])
        sizes = np.diff(ends, prepend=0)
        begins = (ends - sizes)[row_of]
        often = np.bincount(at, minlength=len(words))[new] > 1
        self.words = pa.concat_arrays([self.words, words.take(pa.array(new[often]))])
        self.flat = np.concatenate([self.flat, found[np.repeat(often, counts)]])
        self.ends = np.concatenate([self.ends, np.cumsum(counts[often]) + (self.ends[-1] if len(self.ends) else 0)])
        sizes = sizes[row_of]
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            w = at[a:b]
            n = sizes[w]
            last = np.cumsum(n)
            yield flat[np.repeat(begins[w] - last + n, n) + np.arange(last[-1] if len(last) else 0)]


# The characters that byte-level vocabularies write bytes 0-255 with: printable Latin-1 as it is, the rest from U+0100.
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_CHARS = {b: 0x100 + i for i, b in enumerate(sorted(set(range(256)) - set(_PRINTABLE)))}


@functools.lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins as lists of item indexes: items longest first, each into the fullest bin that has room for it.

    Open bins are kept by their room; a bit mask of the rooms in use finds the smallest that fits.
    """
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, bins = 0, []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        need = lengths[i]
        fits = mask >> need
        if fits:
            room = need + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                mask ^= 1 << room
            bins[b].append(i)
        else:
            room, b = capacity, len(bins)
            bins.append([i])
        if left := room - need:
            by_room[left].append(b)
            mask |= 1 << left
    return bins


def pieces_of(ids: np.ndarray, end_id: int, capacity: int) -> Iterator[tuple[int, int, int, int]]:
    """(piece, start, length, crc32) of a document's ids and its end id, cut to the capacity."""
    ids = np.append(ids, np.uint32(end_id)).astype("<u4")
    for piece, at in enumerate(range(0, len(ids), capacity)):
        part = ids[at:at + capacity]
        yield piece, at, len(part), zlib.crc32(part.tobytes())


def group_name(level: int, task: int, run: int = 0) -> int:
    """The first bin number of a packed group: 5 bits of level, 24 of task, 14 of run and 20 of bin."""
    for part, value, bits in (("rounds", level, 5), ("tasks", task, 24), ("groups of a task", run, 14)):
        if not 0 <= value < 1 << bits:
            raise ValueError(f"too many {part} to number the sequences: {value} does not fit {bits} bits")
    return (level << 58) + (task << 34) + (run << 20)


def _bins(items: list[tuple[int, list[dict]]], capacity: int, full: float, name: int) -> Iterator[tuple]:
    """Output rows of one packed group; ``name`` sets the group's bin numbers apart."""
    for n, chosen in enumerate(best_fit([length for length, _ in items], capacity)):
        if n >> 20:
            raise ValueError("too many sequences in a group to number them: more than 2**20")
        members, used = [], 0
        for i in chosen:
            length, inside = items[i]
            members += [m | {"offset": m["offset"] + used} for m in inside] if used else inside
            used += length
        yield used, used >= full * capacity, name + n, members


def pack(docs: DataFrame, encoder: Callable[[], WordEncoder], end_id: int = 1, capacity: int = CAPACITY,
         full: float = FULL, group: int = GROUP, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset``: one row per piece of a document.

    A null or empty text is a document of its end id alone. Documents of more than ``capacity`` ids are cut into
    pieces of that size, the last one shorter; no others are cut. Repeated rows and null ids are packed as
    documents of their own. Other columns are not read. An empty table gives an empty table.
    """
    schema = ITEMS.format(id=dict(docs.dtypes)[id_col])
    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def out(bins: Iterator[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([dict(zip(arrow.names, b)) for b in bins], arrow)

    def first_round(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # level, task and run number tell groups apart
        encode, task, runs = encoder().encode, TaskContext.get().partitionId(), 0
        items: list[tuple[int, list[dict]]] = []
        for batch in batches:
            for part in slices(batch, "text"):
                for doc_id, ids in zip(part.column("id").to_pylist(), encode(part.column("text"))):
                    for piece, start, length, crc in pieces_of(ids, end_id, capacity):
                        items.append((length, [dict(zip(FIELDS, (doc_id, piece, start, length, crc, 0)))]))
                    if len(items) >= group:
                        yield out(_bins(items, capacity, full, group_name(0, task, runs)))
                        items, runs = [], runs + 1
        if items:
            yield out(_bins(items, capacity, full, group_name(0, task, runs)))

    def next_round(batches: Iterator[pa.RecordBatch], level: int) -> Iterator[pa.RecordBatch]:
        items = [(r["length"], r["members"]) for batch in batches for r in batch.to_pylist()]
        yield out(_bins(items, capacity, full, group_name(level, TaskContext.get().partitionId())))

    rounds = [stored(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(first_round, schema), "pack")]
    left = rounds[0].where(~F.col("done"))
    count = left.count()
    while count > 1:
        groups = math.ceil(count / group)
        level = len(rounds)
        merged = stored(left.select("length", "members").repartition(groups).mapInArrow(
            functools.partial(next_round, level=level), schema), "pack")
        rounds.append(merged)
        left = merged.where(~F.col("done"))
        before, count = count, left.count()
        if groups == 1 or count > 0.98 * before:
            break
    done = [r.where("done") for r in rounds[:-1]] + [rounds[-1]]
    return functools.reduce(DataFrame.unionAll, done).select("bin", F.inline("members")).select(
        "doc_id", "piece", "start", F.col("length").cast("long").alias("length"), F.col("crc").alias("ids_crc32"),
        F.col("bin").alias("sequence_id"), F.col("offset").cast("long").alias("offset"))

