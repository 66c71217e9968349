"""Byte-pair encoding held against the library over Unicode's code points, and the query's three columns over whole documents."""

import hashlib
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from tidelog.llm import bpe, queries

PATH = queries.vocabulary("word_bpe_49k.json")
SMALL = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def test_every_assigned_plane_equals_the_library(library):
    b = bpe.load(PATH)
    points = [c for c in [*range(0xD800), *range(0xE000, 0x32400), *range(0xE0000, 0xE0200)] if c]
    for at in range(0, len(points), 500):
        said = [f"a{chr(c)}b 1{chr(c)}2 ,{chr(c)}. {chr(c)}" for c in points[at : at + 500]]
        text = "\n\n".join(said)
        if b.encode(text) != library.encode(text, add_special_tokens=False).ids:
            wrong = [x for x in said if b.encode(x) != library.encode(x, add_special_tokens=False).ids]
            pytest.fail(f"{wrong[:5]}")


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.skipif(not SMALL.exists(), reason="no tables")
def test_the_query_on_whole_documents(spark, library):
    got = {r.doc_id: tuple(r)[1:4] for r in queries.op1_bpe_encode_decode(spark, str(SMALL)).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()}
    rows = pq.read_table(SMALL / "documents.parquet", columns=["doc_id", "text"]).to_pylist()
    assert len(rows) == len(got)
    for r in rows:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert got[r["doc_id"]] == (len(ids), digest(" ".join(map(str, ids))), digest(library.decode(ids, skip_special_tokens=False)))


def test_odd_texts_in_the_query(spark, library):
    texts = ["ᲉAꟋ b\U000105c0", "͸x İΣς ﬁ Å 가", "x‍🙂 <|endoftext|>Ᲊ", "é" * 3000, "word " * 30_000, "k" * 20_000]
    got = {r.doc_id: r.ids_sha256 for r in bpe.encode(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), PATH).collect()}
    assert got == {i: digest(" ".join(map(str, library.encode(x, add_special_tokens=False).ids))) for i, x in enumerate(texts)}
