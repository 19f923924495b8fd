import functools
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from assetlens.llm import packing
from assetlens.llm.queries import tokenizer_path

PATH = tokenizer_path("word_bpe_49k.json")
PIECES = ["a", "Word", "word.", "été,", " ", "\n", "\t", "\xa0", "it's", "'", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "Σ", "İ", "ﬁ",
          "é", "中文", "\U0001F600", "!!", "12", "ß", "ŉ", "ª"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=10).map("".join), min_size=1, max_size=4))
def test_encoder_gives_the_tokenizers_ids(texts):
    enc = packing.word_encoder(PATH)
    assert enc.direct
    got = [x.tolist() for x in enc.encode(pa.array(texts, pa.string()))]
    assert got == [enc.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_kept_words_are_used_and_refilled():
    enc = packing.WordEncoder(PATH, keep=3)
    for texts in (["a b a b", "c"], ["a d d e e", ""], ["f f, f,", "a"], ["a b"]):
        got = [x.tolist() for x in enc.encode(pa.array(texts, pa.string()))]
        assert got == [enc.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60))
def test_best_fit_is_a_packing_and_never_leaves_two_bins_that_fit(lengths):
    bins = packing.best_fit(lengths, 64)
    assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
    used = sorted(sum(lengths[i] for i in b) for b in bins)
    assert all(u <= 64 for u in used)
    assert len(used) < 2 or used[0] + used[1] > 64


def check(rows, texts, capacity=packing.CAPACITY):
    enc = packing.word_encoder(PATH)
    want = []
    for doc_id, text in texts:
        ids = enc.tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        want += [(doc_id, n, at, len(ids[at:at + capacity]), zlib.crc32(np.array(ids[at:at + capacity], "<u4").tobytes()))
                 for n, at in enumerate(range(0, len(ids), capacity))]
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted([tuple(r[:5]) for r in rows], key=key) == sorted(want, key=key)
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for members in bins.values():
        members.sort()
        assert [o for o, _ in members] == [sum(n for _, n in members[:i]) for i in range(len(members))]
        assert sum(n for _, n in members) <= capacity
    return bins


def test_rounds_merge_underfull_bins(spark):
    """Small groups and many tasks, so that bins must meet in later rounds."""
    texts = [(i, " ".join(["the"] * (1 + i * 37 % 90))) for i in range(1500)]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(12)
    bins = check(packing.pack(df, functools.partial(packing.word_encoder, PATH), capacity=100, group=40).collect(), texts, 100)
    total = sum(n for m in bins.values() for _, n in m)
    assert len(bins) <= 1.1 * total / 100  # groups of 40 items are far smaller than the default


def test_edges(spark, edge_docs, no_docs):
    rows = packing.pack(edge_docs, functools.partial(packing.word_encoder, PATH)).collect()
    check(rows, [(r["doc_id"], r["text"]) for r in edge_docs.collect()])
    assert packing.pack(no_docs, functools.partial(packing.word_encoder, PATH)).count() == 0


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_query_against_plain_version(spark, sf):
    from assetlens.llm.queries import op2_packing

    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows = op2_packing(spark, sf).collect()
    bins = check(rows, texts)
    assert len(bins) <= 1.02 * sum(r["length"] for r in rows) / packing.CAPACITY + 1


def test_sequence_numbers_of_groups_never_meet():
    """Each group has 2**20 numbers of its own, also past 262,144 tasks, and a part that does not fit is an error."""
    places = [(level, task, run) for level in (0, 1, 2, 31) for task in (0, 1, 262143, 262144, 262145, (1 << 24) - 1)
              for run in (0, 1, (1 << 14) - 1)]
    starts = sorted(packing.group_name(*p) for p in places)
    assert all(b - a >= 1 << 20 for a, b in zip(starts, starts[1:])) and starts[0] == 0 and starts[-1] + (1 << 20) <= 1 << 63
    for level, task, run in ((32, 0, 0), (0, 1 << 24, 0), (0, 0, 1 << 14)):
        with pytest.raises(ValueError):
            packing.group_name(level, task, run)
