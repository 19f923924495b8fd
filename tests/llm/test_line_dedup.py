import random
from collections import Counter

from assetlens.llm import line_dedup as ld

SPACE = " \t\n\x0b\f\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, min_docs, min_chars=1):
    key = lambda x: x.strip(SPACE).translate(LOWER)
    seen = {}
    for i, t in rows:
        for x in (t or "").split("\n"):
            seen.setdefault(key(x), set()).add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(key(x)) >= max(1, min_chars) and len(seen[key(x)]) >= min_docs)]
        out.append((i, None if t is None else "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def run(df, **kw):
    return sorted(((r["row"]["doc_id"], r["row"]["text"], r["n_lines"], r["n_dropped"])
                   for r in ld.drop_shared_lines(df, **kw).collect()), key=repr)


def test_matches_a_plain_version(spark):
    rnd = random.Random(2)
    parts = ["Shared one", " shared ONE\t", "É x", "é x", "", "  ", "unique", "\xa0pad", "two", "TWO "]
    rows = [(rnd.randrange(40), "\n".join(rnd.choice(parts + [f"own {i}"]) for _ in range(rnd.randrange(0, 12)))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for min_docs, min_chars in ((3, 1), (10, 1), (1, 4), (2, 0)):
        assert run(df, min_docs=min_docs, min_chars=min_chars) == plain(rows, min_docs, min_chars)


def test_edges(spark, edge_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    assert run(edge_docs, min_docs=2) == plain(rows, 2)
    kept = ld.drop_shared_lines(edge_docs, min_docs=2).select("row.*")
    assert kept.columns == edge_docs.columns and dict(kept.dtypes) == dict(edge_docs.dtypes)
    assert Counter(r["fp"] for r in kept.collect()) == Counter(r["fp"] for r in edge_docs.collect())
    assert ld.drop_shared_lines(no_docs).count() == 0


def test_all_lines_lost(spark):
    df = spark.createDataFrame([(i, "x\nX ") for i in range(3)], "doc_id long, text string")
    assert run(df, min_docs=3) == [(0, "", 2, 2), (1, "", 2, 2), (2, "", 2, 2)]
