import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from assetlens.llm import merkle
from assetlens.llm.queries import FIELDS, op12_merkle

SF = "/root/testdata/sf0.001"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if row[f] is None else f"{len(str(row[f]).encode())}:{row[f]}" for f in FIELDS])


def tree(digests, k=3):
    """The root and each leaf's [(left, right)] up to it."""
    proofs, at = [[] for _ in digests], list(range(len(digests)))
    level = list(digests)
    while len(level) > 1:
        for p, i in zip(proofs, at):
            run = level[i - i % k:i - i % k + k]
            p.append(("".join(run[:i % k]), "".join(run[i % k + 1:])))
        level = [h(*level[i:i + k]) for i in range(0, len(level), k)]
        at = [i // k for i in at]
    return level[0], proofs


def plain(rows, k=3):
    """leaf -> [(subroot, root, proof)] of every row."""
    groups = defaultdict(list)
    for r in rows:
        groups[b"" if r["source"] is None else b"=" + r["source"].encode()].append(r)
    order = sorted(groups)
    for g in order:
        groups[g].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
    trees = {g: tree([leaf(r) for r in groups[g]], k) for g in order}
    root, above = tree([trees[g][0] for g in order], k)
    return [(r["doc_id"], leaf(r), trees[g][0], root, proof + over)
            for g, over in zip(order, above) for r, proof in zip(groups[g], trees[g][1])]


def fold(d, proof):
    for left, right in proof:
        d = h(left, d, right)
    return d


def rows_of(df):
    return sorted((repr(r["id"]), r["leaf"], r["subroot"], r["root"], [tuple(p) for p in r["proof"]]) for r in df.collect())


def test_query_against_plain_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r["doc_id"]: r for r in op12_merkle(spark, SF).collect()}
    by_id = {d["doc_id"]: d for d in docs}
    assert len(got) == len(docs)
    for doc_id, digest, subroot, root, proof in plain(docs):
        d, r = by_id[doc_id].asDict(), got[doc_id]
        if zlib.crc32(str(doc_id).encode()) % 2 == 0 and d["text"] is not None:
            d["text"] = d["text"].replace("\n", "")
        folded = fold(leaf(d), proof)
        assert (r["leaf"], r["subroot"], r["root"]) == (digest, subroot, root)
        assert r["proof_sha256"] == h(*[x for p in proof for x in p])
        assert (r["folded_root"], r["verified"]) == (folded, folded == root)
    assert {r["verified"] for r in got.values()} == {True, False}


@pytest.mark.parametrize("sizes", [(1,), (2,), (3,), (4,), (1, 1), (9, 1, 28), (10, 3, 1, 1, 1), (82, 27, 4, 2)])
def test_trees_of_all_shapes(spark, sizes):
    rows = [(100 * g + i, "x\ny", "en", None if g == 1 else f"s{g}", i) for g, n in enumerate(sizes) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = rows_of(merkle.manifest(docs, FIELDS))
    assert got == sorted((repr(i), *rest) for i, *rest in plain(docs.collect()))
    assert all(fold(d, proof) == root for _, d, _, root, proof in got)


def test_two_way_runs_meet_by_exclusive_or(spark):
    nodes = spark.createDataFrame([("t", i, 7, h(str(i))) for i in range(7)], "tree string, i long, n long, d string")
    levels, tops = merkle.grow(nodes, fanout=2)
    first = {r["i"]: r for r in levels[0].collect()}
    for i in range(7):
        other = h(str(i ^ 1)) if (i ^ 1) < 7 else ""
        assert (first[i]["left"], first[i]["right"]) == ((other, "") if i % 2 else ("", other))
    assert tops.collect()[0]["d"] == tree([h(str(i)) for i in range(7)], 2)[0]


def test_a_hot_source_is_numbered_over_many_partitions(spark):
    docs = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, F.concat(F.lit("s"), F.col("id") % 5)).otherwise("hot").alias("tree"))
    got = merkle.numbered(docs.repartition(11), "tree", ["id"]).collect()
    seen = defaultdict(list)
    for r in got:
        seen[r["tree"]].append((r["i"], r["id"], r["n"]))
    for rows in seen.values():
        rows.sort()
        assert [i for i, _, _ in rows] == list(range(len(rows))) and {n for _, _, n in rows} == {len(rows)}
        assert [d for _, d, _ in rows] == sorted(d for _, d, _ in rows)


def test_edges(spark, edge_docs, no_docs):
    # columns of the fields, beside others whose names the operator uses itself
    for name in ("tree", "i", "n", "d", "source", "n_chars"):
        edge_docs = edge_docs.withColumn(name, F.col("lang"))
    rows = edge_docs.collect()
    assert rows_of(merkle.manifest(edge_docs, FIELDS)) == sorted((repr(i), *rest) for i, *rest in plain(rows))
    assert merkle.manifest(no_docs.withColumn("source", F.lit("x")).withColumn("n_chars", F.lit(1)), FIELDS,
                           carry={"more": F.lit("x")}).collect() == []
