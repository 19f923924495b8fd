import hashlib

import pyarrow as pa
from hypothesis import given, settings, strategies as st

from assetlens.llm import sentencepiece_codec as sc
from assetlens.llm.queries import op9_sentencepiece, tokenizer_path

PATH = tokenizer_path("piece_bpe_32k.model")
PIECES = ["a", "the", " ", "  ", "▁", "\n", "\t", "é", "中文", "\U0001F600", "\x00", "<s>", "</s>", "<0x0A>", "<unk>", "́", "​", "ﬁ", "\xa0", "　"]
TEXTS = st.one_of(st.lists(st.sampled_from(PIECES), max_size=10).map("".join), st.text(max_size=20).filter(lambda t: t.isprintable()))


def plain(text):
    sp = sc.chunk_codec(PATH).sp
    ids = sp.encode(text, add_eos=True)
    return len(ids), " ".join(map(str, ids)), sp.decode(ids)


@settings(max_examples=400, deadline=None)
@given(TEXTS)
def test_chunks_give_the_librarys_ids_and_text(text):
    codec = sc.chunk_codec(PATH)
    assert codec.exact
    assert codec.encode_decode([text]) == [plain(text)]
    if text and "▁" not in text and "  " not in text and text[0] != " ":
        n, ids, decoded = codec.encode_decode_column(pa.array(["first", text, text]))
        assert (n[1], ids[1].as_py(), decoded[1].as_py()) == plain(text) == (n[2], ids[2].as_py(), decoded[2].as_py())


def test_kept_chunks_are_used_and_refilled():
    codec = sc.ChunkCodec(PATH, keep=3)
    for text in ("a b a b c d", "a a b e e", "f f g g\x00 g\x00 h", "a b"):
        n, ids, decoded = codec.encode_decode_column(pa.array([text, "x y"]))
        assert (n[0], ids[0].as_py(), decoded[0].as_py()) == plain(text)


def test_edges(spark, edge_docs, no_docs):
    rows = sc.encode_decode(edge_docs, PATH).collect()
    texts = [r["text"] for r in edge_docs.collect()]
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted([tuple(r) for r in rows], key=key) == sorted([(r["doc_id"], *plain(r["text"] or "")) for r in edge_docs.collect()], key=key)
    assert len(texts) == 10 and sc.encode_decode(no_docs, PATH).count() == 0


def test_query_against_the_library(spark):
    sf = "/root/testdata/sf0.001"
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        n, ids, text = plain(r["text"] or "")
        want[r["doc_id"]] = (n, sha(ids), sha(text))
    assert {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in op9_sentencepiece(spark, sf).collect()} == want
