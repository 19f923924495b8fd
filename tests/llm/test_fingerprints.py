import hashlib
import random

import pytest
import regex
import xxhash
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from assetlens.llm import fingerprints as fp
from assetlens.llm.neighbours import with_next

MASK = (1 << 64) - 1
UNSPACED = (r"\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u3040-\u30FF\u3400-\u4DBF\u4E00-\u9FFF\uF900-\uFAFF"
            r"\U00020000-\U000323AF")


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def rot(x, n):
    n %= 64
    return ((x << n) | (x >> (64 - n))) & MASK if n else x


def spark_hash(value, seed=42):
    return xxhash.xxh64_intdigest(value if isinstance(value, bytes) else (value & MASK).to_bytes(8, "little"), seed)


LETTERS = r"[\p{L}\p{M}\p{N}]"


def plain_units(text):
    text = text.lower()
    if regex.search(f"[{UNSPACED}]", text):
        units = regex.findall(rf"(?V1)[{UNSPACED}]|[[\p{{L}}\p{{M}}\p{{N}}]--[{UNSPACED}]]{{1,4}}|[^\p{{L}}\p{{M}}\p{{N}} \t\n\x0b\f\r]", text)
    else:
        units = regex.findall(rf"{LETTERS}{{1,4}}|[^\p{{L}}\p{{M}}\p{{N}} \t\n\x0b\f\r]", text)
    return [text[:2], *units] if text else []


def plain_winnow(units, k=fp.K, window=fp.WINDOW):
    """Winnowing as it is told: hash the run that ends at each unit, choose the rightmost smallest of each window."""
    h = [spark_hash(t.encode()) for t in units]
    runs = []
    for i in range(len(h)):
        x = 0
        for t in h[max(0, i - k + 1):i + 1]:
            x = rot(x, 1) ^ t
        runs.append(signed(spark_hash(x)) >> 31 << 31)
    picked = []
    for i in range(len(runs)):
        span = range(max(0, i - window + 1), i + 1)
        at = max(j for j in span if runs[j] == min(runs[j] for j in span))
        if at not in picked:
            picked.append(at)
    return [(runs[i], i) for i in picked]


def plain_likeness(a, b):
    a, b = {h for h, _ in a}, {h for h, _ in b}
    return 2 * len(a & b) / (len(a) + len(b)) if a or b else 1.0


def test_matches_plain_winnowing(spark):
    rnd = random.Random(5)
    texts = [" ".join(rnd.choice(["a", "b", "Cc", "dd,", "e1-longer", "日本", "ß"]) for _ in range(n)) for n in (*range(0, 25), 60, 200)]
    for k, window in ((3, 3), (1, 1), (3, 7), (4, 8), (6, 5), (2, 1)):
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
        got = {r["id"]: [(p["hash"], p["position"]) for p in r["fingerprint"]]
               for r in fp.fingerprint_documents(df, k, window).collect()}
        assert got == {i: plain_winnow(plain_units(t), k, window) for i, t in enumerate(texts)}


def descending(rows):
    """Rows of (id, text) as the operator orders them: null ids last, equal ids by a hash of the text."""
    return sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), -signed(spark_hash(r[1].encode()))))


def plain_query(rows):
    """All columns of op1 for rows of (id, text)."""
    rows, out = descending([(i, t or "") for i, t in rows]), []
    for (i, t), (_, after) in zip(rows, rows[1:] + rows[:1]):
        third = len(t) // 3
        edited = t[:len(t) - third] + after[:third]
        mine, other, following = (plain_winnow(plain_units(x)) for x in (t, edited, after))
        name = lambda prints: hashlib.sha256(",".join(
            f"{((h + (0x7FFFFFFF - p)) & MASK):X}" for h, p in prints).encode()).hexdigest()
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), name(mine), name(other),
                    round(plain_likeness(mine, other), 9), round(plain_likeness(mine, following), 9)))
    return sorted(out, key=repr)


def queried(spark, df, folder):
    from assetlens.llm.queries import op1_fingerprints

    df.write.parquet(f"{folder}/documents.parquet")
    return sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"],
                    round(r["near_edited"], 9), round(r["near_next"], 9)) for r in op1_fingerprints(spark, folder).collect()), key=repr)


def test_whole_query_against_plain_python(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert queried(spark, docs, str(tmp_path)) == plain_query(rows)


def test_whole_query_on_edge_cases(spark, edge_docs, no_docs, tmp_path):
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    assert queried(spark, edge_docs, f"{tmp_path}/edges") == plain_query(rows)
    assert queried(spark, no_docs, f"{tmp_path}/none") == []


def test_one_more_character_changes_little(spark):
    rnd = random.Random(4)
    rows = [(n, "".join(rnd.choice(of) for _ in range(n)), rnd.choice(of.strip())) for n in range(8, 201)
            for of in ("abcdefghijklmnopqrstuvwxyz    ", "abcdefghij0123456789", "日本語テキスト", "#*$%&|")]
    df = spark.createDataFrame(rows, "n int, text string, more string")
    near = df.select("n", fp.likeness(fp.fingerprint(F.col("text")), fp.fingerprint(F.concat("text", "more"))).alias("near")).collect()
    for r in near:  # a new unit adds a run or changes the last one, and with it at most the last two choices
        assert r["near"] >= max(0.3, 1 - 16 / r["n"]), r


def test_shared_passage_is_always_found(spark):
    """Any common run of k + window - 1 tokens leaves a common hash."""
    rnd = random.Random(9)
    rows = []
    for i in range(200):
        shared = [f"s{rnd.randrange(50)}" for _ in range(fp.K + fp.WINDOW - 1)]
        around = lambda tag: [f"{tag}{rnd.randrange(10**6)}" for _ in range(rnd.randrange(40))]
        rows.append((i, " ".join(around("a") + shared + around("b")), " ".join(around("c") + shared + around("d"))))
    df = spark.createDataFrame(rows, "i int, x string, y string")
    common = F.arrays_overlap(*[F.transform(fp.fingerprint(F.col(c)), fp.print_hash) for c in "xy"])
    assert df.where(~common).count() == 0


def test_tokens_of_unspaced_scripts_and_symbols(spark):
    rows = spark.createDataFrame([("日本語のテキスト",), ("*** $$$",), ("",), (None,), ("Ab, aB",)], "text string")
    sizes = [r[0] for r in rows.select(F.size(fp.unit_hashes(F.coalesce("text", F.lit(""))))).collect()]
    assert sizes == [9, 7, 0, 0, 4]


def test_likeness(spark):
    texts = ["one two three four five six seven eight nine ten", "", "other words entirely here now"]
    df = spark.createDataFrame([(a, b) for a in texts for b in texts], "a string, b string")
    got = [r[0] for r in df.select(fp.likeness(fp.fingerprint(F.col("a")), fp.fingerprint(F.col("b")))).collect()]
    assert got == [1.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 1.0]


def test_edges(spark, edge_docs, no_docs):
    rows = fp.fingerprint_documents(edge_docs).collect()
    assert len(rows) == 10
    assert [len(r["fingerprint"]) for r in rows if r["id"] in (2, 3)] == [0, 0]
    assert rows[0] == rows[1]
    assert fp.fingerprint_documents(no_docs).count() == 0


@settings(max_examples=8, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-2**63, 2**63 - 1), st.integers(-5, 5)), min_size=0, max_size=40))
def test_next_row_in_descending_order(spark, ids):
    rows = [(i, f"t{n}") for n, i in enumerate(ids)]
    got = with_next(spark.createDataFrame(rows, "doc_id long, text string"), F.length).collect()
    assert sorted(r["text"] for r in got) == sorted(t for _, t in rows)
    after = {r["text"]: r["next_text"] for r in got}
    assert len(set(after.values())) == len(rows)
    ids_of = dict((t, i) for i, t in rows)
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    if rows:  # following the links visits every row in descending order, then comes back
        ends = [t for t in after if (ids_of[t] is None, -(ids_of[t] or 0)) > (ids_of[after[t]] is None, -(ids_of[after[t]] or 0))]
        distinct = len({i for i, _ in order})
        assert len(ends) <= 1 and (distinct == 1 or len(ends) == 1)
        at, seen = order[0][1], set()
        while at not in seen:
            seen.add(at)
            at = after[at]
        assert len(seen) == len(rows)


def test_next_row_over_many_buckets(spark):
    ids = [*range(0, 5000, 7), *range(10**12, 10**12 + 300), -4]
    df = spark.createDataFrame([(i, str(i)) for i in ids], "doc_id long, text string").repartition(5)
    got = {int(r["text"]): int(r["next_text"]) for r in with_next(df, F.length).collect()}
    ids = sorted(ids, reverse=True)
    assert got == dict(zip(ids, ids[1:] + ids[:1]))


def test_no_row_is_lost_between_buckets(spark):
    ids = sorted({n * n * 13 for n in range(2000)} | set(range(10**9, 10**9 + 1000, 3)), reverse=True)
    df = spark.createDataFrame([(i, str(i)) for i in ids], "doc_id long, text string").repartition(5)
    got = {int(r["text"]): int(r["next_text"]) for r in with_next(df, F.length).collect()}
    assert got == dict(zip(ids, ids[1:] + ids[:1]))


@pytest.mark.parametrize("ids", [
    [*range(20000), 10**15],  # one far away
    [(d << 40) + n for d in range(20) for n in range(1000)],  # ranges
    [None] * 9000 + list(range(9000)),  # no id
    [7] * 9000 + list(range(9000)),  # one id
])
def test_buckets_stay_small_however_ids_lie(spark, ids):
    from assetlens.llm.neighbours import BUCKET_ROWS, _bucketing

    rows = spark.createDataFrame([(i, f"t{n}") for n, i in enumerate(ids)], "id long, text string").repartition(5)
    buckets, repeated, bucketed = _bucketing(rows)
    sizes = [r["count"] for r in bucketed(rows).groupBy("bucket").count().collect()]
    assert max(sizes) == BUCKET_ROWS and len(sizes) == buckets and repeated is None


def test_copies_of_one_row_are_dealt_to_many_buckets(spark):
    from assetlens.llm.neighbours import _bucketing

    rows = [(None, None)] * 3000 + [(5, "copy")] * 3000 + [(i, f"t{i}") for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    plain = df.selectExpr("doc_id as id", "coalesce(text, '') as text")
    _, repeated, bucketed = _bucketing(plain)
    assert repeated.count() == 2
    assert max(r["count"] for r in bucketed(plain).groupBy("bucket").count().collect()) < 300
    got = with_next(df, F.length).collect()
    want = descending([(i, t or "") for i, t in rows])
    pairs = lambda xs: sorted(xs, key=repr)
    assert pairs((r["id"], r["text"], r["next_text"]) for r in got) == pairs(
        (i, t, n) for (i, t), (_, n) in zip(want, want[1:] + want[:1]))


def test_edited_texts_of_any_length_stay_alike(spark, tmp_path):
    """Two thirds of each text are kept: texts of a few characters, of a few words, and of one unbroken run."""
    from assetlens.llm.queries import op1_fingerprints

    rnd = random.Random(6)
    letters = lambda n, of: "".join(rnd.choice(of) for _ in range(n))
    texts = [letters(n, of) for n in (*range(3, 100), 1000) for of in ("abcdefghijklmnopqrstuvwxyz    ", "abcdefghij0123456789", "日本語テキスト", "#*$%&|")]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in op1_fingerprints(spark, str(tmp_path)).collect()}
    assert len(got) == len(texts)
    assert [texts[i] for i in got if not got[i]["near_edited"] > 0] == []
