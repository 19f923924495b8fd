import hashlib
import re
import time
from collections import defaultdict

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from assetlens.llm import personal_data as pd_
from assetlens.llm.queries import op11_personal_data

SF = "/root/testdata/sf0.001"

# The patterns of the contract as they stand there.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, s):
    digits = [int(c) for c in s if c in "0123456789"]
    if kind == "ip":
        return all(int(x) <= 255 for x in s.split("."))
    if kind == "card":
        total = sum(d if k % 2 == 0 else (d * 2 if d < 5 else d * 2 - 9) for k, d in enumerate(reversed(digits)))
        return 16 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def plain_spans(text):
    return [(k, m.start(), m.end()) for k in PLAIN for m in re.finditer(PLAIN[k], text) if valid(k, m[0])]


@given(st.text(alphabet="ab1234567890@.+- ()_%\né", max_size=120))
@settings(max_examples=400, deadline=None)
def test_fixed_patterns_equal_the_plain_ones(text):
    assert pd_.fixed_spans(text) == plain_spans(text)


@given(st.lists(st.sampled_from(["a@b.c", "_d@e.f", "x", "@", "1.2.3.4", ".5", "300.1.1.1", "4111 1111 1111 1111", "-", " ", "+1 (743) 555-3824", "+",
                                 "0000001.2.3.4", "378282246310005", "4222222222222222222", "é"]), max_size=12))
@settings(max_examples=300, deadline=None)
def test_fixed_patterns_equal_the_plain_ones_on_near_matches(parts):
    text = "".join(parts)
    assert pd_.fixed_spans(text) == plain_spans(text)


def test_long_runs_take_time_in_proportion():
    for run in ("a" * 400_000, "1" * 400_000, "a1" * 200_000, "1." * 200_000, "+1 " * 130_000, "a@" * 200_000, "(" * 400_000, "1 " * 200_000,
                "@" * 400_000, "1 " * 200_000 + "x", "a" * 400_000 + "@"):
        began = time.time()
        list(pd_.other_runs(run, pd_.fixed_spans(run)))
        assert time.time() - began < 5, run[:6]


def corpus():
    """Numbers that no fixed pattern knows, beside words that seeds stand beside; and the same shapes beside common words."""
    names = ["ada", "bob", "cyd", "dan", "eve", "fay", "gus", "hal", "ida", "jon", "kay", "lou"]
    rows = [f"Hello there. Please call me on +49 30 {5550000 + 137 * i} or stay home." for i in range(9)]
    rows += [f"Please call me on 0171 {4440000 + 91 * i} or write soon." for i in range(2)]
    rows += [f"My address is mailto {n}@mail{i}.example.com for now." for i, n in enumerate(names)]
    rows += ["My address is mailto zoe@localhost for now."]
    rows += [f"the order of {7000 + i} pieces of wood and the order of things" for i in range(12)]
    rows += ["the order of +49 30 1234567 and the order of +49 30 7654321 and the order of +49 30 2222222"]
    rows += ["Nothing to see here at all"] * 5
    return rows


def test_context_finds_what_the_patterns_do_not_know(spark):
    texts = corpus()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["id"]: r for r in pd_.find_personal_data(docs).collect()}
    learned = {i: [(s["kind"], texts[i][s["start"]:s["end"]]) for s in r["learned"]] for i, r in found.items() if r["learned"]}
    assert learned == {9: [("phone", "0171 4440000")], 10: [("phone", "0171 4440091")], 23: [("email", "zoe@localhost")]}
    for i, t in enumerate(texts):
        assert [tuple(s) for s in found[i]["base"]] == plain_spans(t)


def plain_learned(texts, min_seeds, min_confidence, rounds):
    """The whole method with dictionaries."""
    edges, at = defaultdict(int), defaultdict(list)
    places = defaultdict(int)
    for d, text in enumerate(texts):
        words = re.findall(r"[^\W\d_]+", text.lower())
        for a, b in zip(words, words[1:]):
            places[a, b] += 1
        base = pd_.fixed_spans(text)
        for kind, a, b in [*base, *((None, a, b) for a, b in pd_.other_runs(text, base))]:
            left = tuple(re.findall(r"[^\W\d_]+", text[max(0, a - 64):a].lower())[-2:])
            right = tuple(re.findall(r"[^\W\d_]+", text[b:b + 64].lower())[:2])
            for side, pair in enumerate((left, right)):
                if len(pair) == 2:
                    edges[(side, pair), text[a:b].lower(), kind] += 1
                    if kind is None:
                        at[d, a, b].append((side, pair))
    seeds = defaultdict(int)
    for p, _, kind in edges:
        if kind:
            seeds[p, kind] += 1
    confidence = {}
    for r in range(rounds):
        doubt = defaultdict(lambda: 1.0)
        for (p, i, kind) in edges:
            for k in pd_.KINDS:
                if kind is None and (p, k) in confidence:
                    doubt[i, k] *= 1 - min(confidence[p, k], 1 - 1e-9)
        new = {}
        for (p, k), n in seeds.items():
            if n >= min_seeds:
                mine = [(i, kind, c) for (q, i, kind), c in edges.items() if q == p]
                weight = sum(c * ((kind == k) if kind else (1 - doubt[i, k] if r else 0)) for i, kind, c in mine)
                new[p, k] = weight / max(places[p[1]], sum(c for *_, c in mine))
        confidence = new
    out = defaultdict(list)
    for (d, a, b), ps in at.items():
        sure = [(confidence[p, k], -n, k) for p in ps for n, k in enumerate(pd_.KINDS) if confidence.get((p, k), 0) >= min_confidence]
        if sure:
            out[d].append((max(sure)[2], a, b))
    return {d: sorted(v, key=lambda s: (pd_.KINDS.index(s[0]), s[1])) for d, v in out.items()}


def test_graph_against_dictionaries(spark):
    texts = corpus() * 2
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    for min_seeds, min_confidence, rounds, bits in ((3, 0.8, 3, 1 << 16), (2, 0.5, 1, 1 << 15), (1, 0.05, 4, 1 << 18)):
        got = pd_.find_personal_data(docs, min_seeds, min_confidence, rounds, bits=bits).where(F.size("learned") > 0).collect()
        want = plain_learned(texts, min_seeds, min_confidence, rounds)
        assert want and {r["id"]: [tuple(s) for s in r["learned"]] for r in got} == want


def test_query_against_plain_patterns(spark):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op11_personal_data(spark, SF).collect()
    learned = plain_learned([docs[i] for i in range(len(docs))], pd_.MIN_SEEDS, pd_.MIN_CONFIDENCE, pd_.ROUNDS)
    assert len(rows) == len(docs)
    for r in rows:
        spans = plain_spans(docs[r["doc_id"]])
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in PLAIN] == [sum(s[0] == k for s in spans) for k in PLAIN]
        more = [f"learned_{k}:{a}:{b}" for k, a, b in learned.get(r["doc_id"], [])]
        assert r["spans"] == ",".join([text] * bool(text) + more)


def test_edges(edge_docs, no_docs):
    rows = pd_.find_personal_data(edge_docs).collect()
    assert sorted(repr(r["id"]) for r in rows) == sorted(repr(r["doc_id"]) for r in edge_docs.collect())
    assert all(r["base"] == [] and r["learned"] == [] for r in rows)
    assert pd_.find_personal_data(no_docs).collect() == []
