import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from assetlens.llm import infill

SF = "/root/testdata/sf0.001"


def unit_cuts(text, unit):
    """Places where the text may be cut: cuts[k] lies after k units."""
    if unit == "code_points":
        starts = list(range(len(text)))
    elif unit == "words":
        starts = [m.start() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
    else:
        starts = [i for i in range(len(text)) if i == 0 or text[i - 1] == "\n"]
    return [0, *starts[1:], len(text)] if starts else [0]


def plain(doc_id, text, unit="code_points"):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
    cuts = unit_cuts(text, unit)
    n = len(cuts) - 1
    x, y = sorted((cuts[h1 % (n + 1)], cuts[h2 % (n + 1)]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = text[:x], text[x:y], text[y:]
    if h4 % 100 < 20:
        return n, "spm", x, y - x, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", x, y - x, f"<P>{p}<S>{s}<M>{m}"


@given(st.lists(st.integers(0, 5), max_size=300))
@settings(max_examples=60, deadline=None)
def test_ranks_count_symbols(symbols):
    s = np.array(symbols, np.uint8)
    matrix = infill.WaveletMatrix(s)
    at = np.arange(len(s) + 1)
    for symbol in range(6):
        assert matrix.rank(symbol, at).tolist() == [int((s[:i] == symbol).sum()) for i in at]


@given(st.lists(st.text(alphabet="ab \n\té日😀<PSM>", max_size=40), min_size=1, max_size=6), st.sampled_from(sorted(infill.UNITS)),
       st.integers(0, 1 << 32), st.integers(0, 1 << 32))
@settings(max_examples=150, deadline=None)
def test_cuts_of_all_units(texts, unit, a, b):
    raw = [t.encode() for t in texts]
    offsets = np.concatenate(([0], np.cumsum([len(r) for r in raw])))
    first, second = np.full(len(texts), a), np.full(len(texts), b)
    n, one, two, prefix, until = infill.cut_places(np.frombuffer(b"".join(raw), np.uint8), offsets, first, second, unit)
    for k, t in enumerate(texts):
        cuts = unit_cuts(t, unit)
        assert n[k] == len(cuts) - 1
        x, y = sorted((cuts[a % (n[k] + 1)], cuts[b % (n[k] + 1)]))
        assert (prefix[k], until[k]) == (x, y)
        assert (one[k] - offsets[k], two[k] - offsets[k]) == (len(t[:x].encode()), len(t[:y].encode()))


@pytest.mark.parametrize("unit", sorted(infill.UNITS))
def test_every_document_against_plain_python(spark, unit):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r["id"]: r for r in infill.fill_in_middle(docs, unit=unit).withColumn(
        "back", infill.restore(F.col("output"), F.col("form"))).collect()}
    forms = set()
    for d in docs.collect():
        r = got[d["doc_id"]]
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == plain(d["doc_id"], d["text"], unit)
        assert r["back"] == (d["text"] or "")
        forms.add(r["form"])
    assert forms == {"plain", "psm", "spm"}


def test_markers_half_markers_and_long_runs(spark):
    texts = ["<P>", "a <S> b", "x<M>", "<", "<S", "S>", "<P<S<M", "M>S>P>", "<<<>>>", "é" * 70_000, "\n\n\n", " lead", "日本語<"] * 8
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = infill.fill_in_middle(docs).withColumn("back", infill.restore(F.col("output"), F.col("form"))).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == plain(r["id"], texts[r["id"]])
        assert r["back"] == texts[r["id"]]


def test_edges(edge_docs, no_docs):
    want = sorted((repr(r["doc_id"]), repr(plain(r["doc_id"], r["text"]))) for r in edge_docs.collect())
    got = sorted((repr(r["id"]), repr(tuple(r)[1:])) for r in infill.fill_in_middle(edge_docs).collect())
    assert got == want
    assert infill.fill_in_middle(no_docs).count() == 0
    with pytest.raises(ValueError):
        infill.fill_in_middle(edge_docs, unit="pages")
