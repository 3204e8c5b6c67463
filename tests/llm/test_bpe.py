import base64
import hashlib

import numpy as np
import public_tokenizers as P
import pytest
from tapeline.llm import bpe, queries
from tapeline.llm.bpe import Codec, decode_documents, encode_documents

SF = "/root/testdata/sf0.01"
FILE = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def encoding():
    import tiktoken

    with open(FILE, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_random_texts(encoding):
    rng = np.random.default_rng(5)
    planes = [(97, 123)] * 6 + [(32, 127), (160, 0x600), (0x3000, 0xD000), (0x1F300, 0x1F6FF), (9, 14)]
    texts = ["".join(chr(rng.integers(*planes[k])) for k in rng.integers(0, len(planes), n)) for n in rng.integers(0, 80, 2000)]
    codec = Codec(FILE)
    got = codec.encode(texts)
    assert [np.frombuffer(x, "<i4").tolist() for x in got] == [encoding.encode_ordinary(t) for t in texts]
    assert codec.decode(got) == [t.encode() for t in texts]


def test_every_character_beside_letters_and_spaces(encoding):
    codec = Codec(FILE)
    chars = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    split = encoding._pat_str
    import regex

    want = regex.compile(split).findall
    bad = [c for c in chars if codec.split(f"a{c}b1 {c}{c} {c}2  {c}") != want(f"a{c}b1 {c}{c} {c}2  {c}")]
    assert not bad, bad[:20]


def test_long_words_in_several_queries(encoding, monkeypatch):
    rng = np.random.default_rng(6)
    blob = base64.b64encode(rng.bytes(6000)).decode()
    texts = ["x" * 3000, "ab" * 700 + "zqj" * 300, blob, "é" * 900, " " * 2000 + "a", "=" * 1500]
    monkeypatch.setattr(bpe, "STEP_ROWS", 100_000)
    codec = Codec(FILE)
    assert [np.frombuffer(x, "<i4").tolist() for x in codec.encode(texts)] == [encoding.encode_ordinary(t) for t in texts]
    parts, ends = codec.cut([blob.encode(), b"gate"])
    assert b"".join(parts) == blob.encode() + b"gate" and len(parts) > 100 and ends[-1] == len(parts)


def test_many_long_documents_of_distinct_words(encoding):
    """A batch of words that were never seen goes through the queries by bytes, within the memory of the database."""
    rng = np.random.default_rng(7)
    texts = [" ".join("".join(map(chr, w)) for w in rng.integers(97, 123, (20_000, 10))) for _ in range(10)]
    codec = Codec(FILE)
    got = codec.encode(texts)
    assert [np.frombuffer(x, "<i4").tolist() for x in got] == [encoding.encode_ordinary(t) for t in texts]
    assert codec.decode(got) == [t.encode() for t in texts]
    assert len(codec.words.young) <= bpe.KNOWN_WORDS + 200_000


def test_every_document_against_the_library(spark, encoding):
    rows = queries.QUERIES["op6_recursive_query_bpe"](spark, SF).collect()
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(rows) == len(text)
    for r in rows:
        ids = encoding.encode_ordinary(text[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()


def test_edge_rows(frame):
    rows = [(1, None), (2, ""), (None, "a gate"), (4, "gate\n\n step's"), (4, "gate\n\n step's"), (5, "<|endoftext|> \u0000")]
    got = encode_documents(frame(rows), FILE)
    back = decode_documents(got, FILE).collect()
    assert [(r.path, bytes(r.decoded).decode()) for r in back] == [(k, t or "") for k, t in rows]
    assert [r.ids for r in got.collect()][:2] == [[], []]
    assert encode_documents(frame([]), FILE).collect() == []


def test_unknown_ids_have_no_bytes(spark):
    ids = spark.createDataFrame([(1, [999_999, 5]), (2, None)], "path long, ids array<int>")
    got = {r.path: bytes(r.decoded) for r in decode_documents(ids, FILE).collect()}
    assert len(got[1]) == 1 and got[2] == b""
