import random
import tempfile

import numpy as np

import corpus_pipeline as cp
from assetlens.llm import langid, quality_model, simhash
from test_line_dedup import plain as plain_lines
from test_simhash import plain_groups, plain_print

SF = "/root/testdata/sf0.001"


def test_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, texts, kept = docs.columns, {r["doc_id"]: r["text"] for r in docs.collect()}, {}
    for name, stage in cp.STAGES:
        out = stage(spark, docs, SF)
        path = tempfile.mkdtemp(prefix="stage-") + "/t"
        out.write.parquet(path)
        out = spark.read.parquet(path)
        if name != "packing":
            assert out.columns == columns
            kept[name] = {r["doc_id"]: r["text"] for r in out.collect()}
        if name == "quality":
            model = quality_model.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
            score = model.score(np.array([quality_model.features(t) for t in texts.values()]))
            assert kept[name] == {k: t for (k, t), s in zip(texts.items(), score) if s >= 0.3}
        elif name == "language":
            found = langid.train(docs).predict(list(texts.values()))
            ok = (found["lang"] != "und") & (found["score"] >= np.minimum(langid.MOST_CUT, langid.CUT_PER_ROOT * np.sqrt(found["grams"])))
            assert kept[name] == {k: t for (k, t), s in zip(texts.items(), ok) if s}
        elif name == "lines":
            assert kept[name] == {k: t for k, t, *_ in plain_lines(list(texts.items()), 10)}
            assert all(r["n_chars"] == len(r["text"]) for r in out.collect())
        elif name == "near_duplicates":
            fp = {k: plain_print(t) for k, t in texts.items()}
            group = plain_groups(list(fp), [(a, b) for a in fp for b in fp if a < b and (fp[a] ^ fp[b]).bit_count() <= simhash.RADIUS])
            assert kept[name] == {k: texts[k] for k in set(group.values())}
        else:
            assert {r["doc_id"] for r in out.collect()} == set(texts)
        docs, texts = out, kept.get(name)


def test_clean_labelled_documents_stay(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for stage in (cp.quality, cp.language):
        docs = stage(spark, docs, SF)
    left = {r["doc_id"] for r in docs.collect()}
    good = [k in left for k, q in labels.items() if q == 1]
    assert sum(good) / len(good) > 0.97


def test_language_rejects_noise_and_other_scripts_and_keeps_short_texts(spark):
    rnd = random.Random(3)
    of = {"latin": "abcdefghijklmnopqrstuvwxyz     ", "cyrillic": "абвгдежзийклмнопрстуфхцчшщъыьэюя      ",
          "cjk": "".join(map(chr, range(0x4E00, 0x5A00)))}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = [(f"{k}{n}", "".join(rnd.choice(a) for _ in range(n)), k) for k, a in of.items() for n in [400, 1500] * 60]
    words = [w for r in docs.where("lang = 'en'").limit(40).collect() for w in (r["text"] or "").split()[:8]]
    short = [(f"s{i}", " ".join(words[i:i + n]), "short") for n in (2, 4, 6) for i in range(0, 150, 3)]
    noise = spark.createDataFrame([(None, t, None, k, len(t)) for i, t, k in odd + short], docs.schema)
    left = cp.language(spark, docs.unionByName(noise), SF).where("doc_id is null").groupBy("source").count().collect()
    left = {r["source"]: r["count"] for r in left}
    assert all(left.get(k, 0) <= 0.05 * 120 for k in of), left
    assert left["short"] >= 0.97 * 150


def test_run(spark):
    assert cp.run(spark, SF).columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def test_edges(spark, edge_docs, no_docs):
    """Every stage takes nulls, repeated rows, empty and long texts, clashing columns and no rows at all."""
    for docs in (edge_docs, no_docs):
        for _, stage in cp.STAGES:
            out = stage(spark, docs, SF)
            assert out.count() <= 60 and (stage is cp.packed or out.columns == docs.columns)
