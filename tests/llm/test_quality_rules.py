import random
from collections import Counter

from assetlens.llm import quality_rules as qr


def plain(text):
    words = [w for w in "".join(" " if c in " \t\n\x0b\f\r" else c for c in text or "").split(" ") if w]
    n = len(words)
    grams = Counter(tuple(words[i:i + 8]) for i in range(n - 7))
    covered = {j for i in range(n - 7) if grams[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\f\r")]
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


def test_measures_match_a_plain_version(spark, edge_docs):
    rnd = random.Random(4)
    texts = ["".join(rnd.choice(["a ", "b ", "c\n", "é\t", "#x ", " ", "\xa0", "|", "a b\n"]) for _ in range(rnd.randrange(120))) for _ in range(300)]
    texts += [None, "", "x " * 7, "x " * 8, "x " * 9, ("one two three four five six seven eight nine ten " * 2)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = qr.quality_rules(df).orderBy("doc_id").collect()
    assert [(r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in rows] == [plain(t) for t in texts]
    for r in rows:
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])


def test_edges(spark, edge_docs, no_docs):
    rows = qr.quality_rules(edge_docs).collect()
    assert len(rows) == 10
    assert [r["n_repeat_words"] for r in rows if r["n_words"] == 40000] == [40000]
    assert all(r["base_failed"] for r in rows if r["doc_id"] in (2, 3, 4))
    assert qr.quality_rules(no_docs).count() == 0


def test_one_projection(spark, edge_docs):
    plan = qr.quality_rules(edge_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_labelled_documents(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = qr.quality_rules(spark.read.parquet(f"{sf}/documents.parquet")).join(labels, "doc_id").where("not base_failed").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1]
    bad = [r["kept"] for r in rows if r["quality"] == 0]
    assert sum(good) / len(good) > 0.99 and sum(bad) / max(1, len(bad)) < 0.3
