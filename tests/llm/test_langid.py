import os
import subprocess
import sys

import numpy as np
from hypothesis import given, settings, strategies as st

from assetlens.llm import langid

SF = "/root/testdata/sf0.01"


def plain_bundle(text, dim=langid.DIM):
    """Each n-gram bound by hand, added one by one."""
    spelled = langid.spelled(text)
    if not spelled.any():
        return np.zeros(dim)
    spelled = [int(c) for c in spelled] + [0] * max(0, langid.GRAM - len(spelled))
    out = np.zeros(dim)
    for i in range(len(spelled) - langid.GRAM + 1):
        a, b, c = (langid.letter_vector(x).astype(int) for x in spelled[i:i + 3])
        out += np.roll(np.roll(a, 1) * b, 1) * c
    return out


@settings(max_examples=40, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=30)), min_size=1, max_size=6))
def test_bundles_match_a_plain_version(texts):
    got, lettered = langid.bundles(texts)
    assert np.allclose(got, np.stack([plain_bundle(t) for t in texts]))
    assert lettered.tolist() == [any(c.isalpha() for c in t or "") for t in texts]


def test_long_text_in_parts(monkeypatch):
    text = "Der schnelle braune Fuchs springt über den faulen Hund. " * 30
    whole, _ = langid.bundles([text, "x"])
    monkeypatch.setattr(langid, "BLOCK", 101)
    parts, _ = langid.bundles([text, "x"])
    assert np.array_equal(whole, parts)


def test_both_ways_of_adding_agree(monkeypatch):
    texts = ["日本語のテキストを書く", "Der schnelle braune Fuchs", "", None, "aaa " * 700, "x", "日本" * 400]
    want = np.stack([plain_bundle(t or "") for t in texts])
    for dense in (0, 1 << 30):
        monkeypatch.setattr(langid, "DENSE", dense)
        for step in (7, 1 << 13):
            monkeypatch.setattr(langid, "STEP", step)
            assert np.array_equal(langid.bundles(texts)[0], want)


def test_many_letters_take_little_memory():
    """300 texts of random ideographs, 1.8 MB, most n-grams once."""
    code = """
import random, resource, time
from assetlens.llm import langid
rnd = random.Random(1)
texts = ["".join(chr(rnd.randrange(0x4E00, 0x9FA5)) for _ in range(2040)) for _ in range(300)]
langid.bundles(["warm"])
before, began = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss, time.process_time()
langid.bundles(texts)
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before, time.process_time() - began)
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True,
                         cwd=os.path.join(os.path.dirname(__file__), "..", ".."))
    grown, seconds = map(float, out.stdout.split())
    assert grown < 200_000 and seconds < 5


def test_spelling():
    assert "".join(chr(c) if c else "_" for c in langid.spelled("Ab, c1É")) == "_ab_c_é_"
    assert langid.spelled(None).size == 0 and not langid.spelled("12 !").any()


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = langid.identify(docs, langid.train(docs)).join(docs.selectExpr("doc_id as id", "lang"), "id").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 100 and np.mean([r["lang_pred"] == r["lang"] for r in held]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_edges(spark, edge_docs, no_docs):
    model = langid.train(edge_docs)
    assert set(model.names) <= {"en", "de"}
    rows = langid.identify(edge_docs, model).collect()
    assert len(rows) == 10
    assert all(r["lang_pred"] == "und" and r["score"] == 0 for r in rows if r["id"] in (2, 3, 4))
    assert langid.identify(no_docs, model).count() == 0
    assert {r["lang_pred"] for r in langid.identify(edge_docs, langid.train(no_docs)).collect()} == {"und"}
