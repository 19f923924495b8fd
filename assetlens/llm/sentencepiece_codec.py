"""SentencePiece encoding and decoding through a table of distinct chunks.

A chunk is a run of white space markers and what follows it up to the next marker. In a model of which no piece
holds a marker after another character, no piece can reach over the start of a chunk, so a text's ids are those of
its chunks in turn. Each Arrow batch is one table: its texts are cut into chunks, the distinct ones are encoded
and decoded once by the library, and ids are joined back by position. A task keeps the chunks it has met, up to
a bound. The work is a map over the documents: nothing is shuffled.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import slices

MARK = "▁"
LONG = 1 << 28  # bytes of a text from which on its ids might not fit one Arrow value
CHUNKS = 200_000  # recurring chunks a task keeps at hand
CHUNK_RE = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


class ChunkCodec:
    """Encoding and decoding of whole texts with one SentencePiece model; ``exact`` says if chunks may be used.

    A chunk is named by what follows its first marker; ``kept_ids`` has the ids of the ``kept`` chunks, as text.
    """

    def __init__(self, path: str, keep: int = CHUNKS):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.keep = keep
        self._reset()
        pieces = (self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size()))
        # pieces must not cross markers, spaces must be kept one by one, and a text must get one marker in front
        self.exact = (not any(MARK in p.lstrip(MARK) for p in pieces)
                      and self.sp.decode(self.sp.encode(" a  b ")) == " a  b "
                      and self.sp.normalize("  Å ﬁ") == f"{MARK}{MARK}{MARK}Å{MARK}ﬁ")

    def _reset(self) -> None:
        self.kept, self.kept_ids = pa.array([], pa.string()), pa.array([], pa.string())

    def chunks(self, text: str) -> list[str]:
        """The chunks of a text, each without its first marker."""
        if not text:
            return []
        words = text.split(" ")
        if MARK not in text and "" not in words[:-1]:  # single spaces: each word is a chunk
            return words
        return [c[1:] for c in CHUNK_RE.findall(MARK + text.replace(" ", MARK))]

    def encode_chunks(self, chunks: list[str]) -> list[tuple[str, str]]:
        """(ids as text, decoded text) of distinct chunks. The library puts a marker in front of what it encodes and
        takes it away where it decodes, so a chunk stands for itself."""
        ids = self.sp.encode(chunks, num_threads=1)
        texts = self.sp.decode(ids, num_threads=1) if chunks else []
        lone = [self.sp.piece_to_id(MARK)]  # the library encodes an empty text as nothing
        return [(" ".join(map(str, i if c else lone)), t) for c, i, t in zip(chunks, ids, texts)]

    def encode_decode(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """(number of ids, ids as text, decoded text) of each text, with the end id."""
        out, eos = [], self.sp.eos_id()
        for text in texts:
            if self.exact:
                chunks = self.chunks(text)
                distinct = list(set(chunks))
                known = dict(zip(distinct, self.encode_chunks(distinct)))
                ids = " ".join([*(known[c][0] for c in chunks), str(eos)])
                out.append((ids.count(" ") + 1, ids, " ".join([known[c][1] for c in chunks])))
            else:
                ids = self.sp.encode(text, add_eos=True)
                out.append((len(ids), " ".join(map(str, ids)), self.sp.decode(ids)))
        return out

    def encode_decode_column(self, texts: pa.Array) -> tuple[np.ndarray, pa.Array, pa.Array]:
        """The same for a column of texts with single spaces only, so that their words are their chunks: cut, number
        the distinct chunks, encode and decode those, and join the results back by position.

        Chunks that recur in a column and decode to themselves are kept for later ones.
        """
        cut = pc.split_pattern(texts, " ")
        table = cut.flatten().dictionary_encode()
        chunks, at = table.dictionary, table.indices.to_numpy()
        if len(self.kept) > self.keep:
            self._reset()
        kept = pc.index_in(chunks, self.kept)
        new = np.flatnonzero(kept.is_null().to_numpy(False))
        new_chunks = chunks.take(pa.array(new))
        found = self.encode_chunks(new_chunks.to_pylist())
        rows = kept.fill_null(0).to_numpy(False).astype(np.int64)
        rows[new] = len(self.kept) + np.arange(len(new))
        ids = pa.concat_arrays([self.kept_ids, pa.array([i for i, _ in found], pa.string())])
        decoded = pa.array([t for _, t in found], pa.string())
        same = pc.equal(decoded, new_chunks).to_numpy(False)
        keep = pa.array((np.bincount(at, minlength=len(chunks))[new] > 1) & same)
        n_ids = pc.add(pc.count_substring(ids, " "), 1).to_numpy(False)[rows[at]]
        starts = cut.offsets.to_numpy()[:-1] - cut.offsets[0].as_py()
        counts = np.add.reduceat(n_ids, starts) + 1 if len(at) else np.zeros(0, np.int64)
        offsets = pa.array(np.append(starts, len(at)), pa.int32())
        join = lambda values, where: pc.binary_join(pa.ListArray.from_arrays(offsets, values.take(pa.array(where))), " ")
        joined = pc.binary_join_element_wise(join(ids, rows[at]), pa.scalar(str(self.sp.eos_id()), pa.string()), " ")
        if not same.all():
            texts = join(pa.concat_arrays([self.kept, decoded]), rows[at])
        self.kept = pa.concat_arrays([self.kept, new_chunks.filter(keep)])
        self.kept_ids = pa.concat_arrays([self.kept_ids, ids.slice(len(self.kept_ids)).filter(keep)])
        return counts, joined, texts


@functools.lru_cache(maxsize=2)
def chunk_codec(path: str) -> ChunkCodec:
    return ChunkCodec(path)


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """``id, n_tokens, ids, decoded`` per input row: ids in decimal joined by one space (with the end id), and the
    text decoded from them. With ``digest`` the last two are SHA-256 in lower-case hex, and no text leaves the task.

    A null text counts as empty: its only id is the end id. Repeated rows get a row each, other columns are not
    read, and an empty table gives an empty table.
    """
    def rows_of(codec: ChunkCodec, texts: pa.Array) -> tuple[np.ndarray, list[str], list[str]]:
        n, ids, decoded = np.zeros(len(texts), np.int64), [None] * len(texts), [None] * len(texts)
        size = pc.binary_length(texts).to_numpy(False)
        odd = pc.match_substring_regex(texts, f"{MARK}|  |^ ").to_numpy(False) | (size == 0) | (size > LONG) | (not codec.exact)
        even = np.flatnonzero(~odd)
        if len(even):
            counts, i, d = codec.encode_decode_column(texts.take(pa.array(even)))
            n[even] = counts
            for k, x, y in zip(even.tolist(), i.to_pylist(), d.to_pylist()):
                ids[k], decoded[k] = x, y
        for k in np.flatnonzero(odd).tolist():
            ((n[k], ids[k], decoded[k]),) = codec.encode_decode([texts[k].as_py()])
        return n, ids, decoded

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = chunk_codec(path)
        sha = (lambda s: hashlib.sha256(s.encode()).hexdigest()) if digest else (lambda s: s)
        for batch in batches:
            for part in slices(batch, "text"):
                n, ids, decoded = rows_of(codec, part.column("text").fill_null(""))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(n), pa.array(map(sha, ids), pa.string()), pa.array(map(sha, decoded), pa.string())],
                    ["id", "n_tokens", "ids", "decoded"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {dict(docs.dtypes)[id_col]}, n_tokens long, ids string, decoded string")
