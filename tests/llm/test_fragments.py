import base64
import hashlib

import numpy as np
import public_tokenizers as P
import pytest
from tapeline.llm import fragments, queries
from tapeline.llm.fragments import Codec, Memory, decode_ids, encode_by_fragments

SF = "/root/testdata/sf0.01"
FILE = P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(FILE)


@pytest.fixture(scope="module")
def codec():
    return Codec(FILE)


def same(codec, library, texts):
    got = [np.frombuffer(x, "<i4").tolist() for x in codec.encode(texts)]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    bad = [t for t, a, b in zip(texts, want, got) if a != b]
    assert not bad, bad[:5]
    assert codec.decode([np.array(x, "<i4").tobytes() for x in want]) == library.decode_batch(want, skip_special_tokens=False)


def test_random_texts(codec, library):
    rng = np.random.default_rng(12)
    planes = [(97, 123)] * 6 + [(32, 127), (160, 0x600), (0x3000, 0xD000), (0x1F300, 0x1F6FF), (9, 14), (0x1C, 0x20)]
    same(codec, library, ["".join(chr(rng.integers(*planes[k])) for k in rng.integers(0, len(planes), n)) for n in rng.integers(0, 80, 3000)])


def test_every_character_beside_letters_marks_and_numbers(codec, library):
    chars = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    for start in range(0, len(chars), 40_000):
        same(codec, library, [f"a{c}b1 E{c}́ {c}" for c in chars[start : start + 40_000]])


def test_words_that_are_special(codec, library):
    same(codec, library, [
        "<|endoftext|>", "a<|endoftext|>B<|startoftext|>", "<|ENDOFTEXT|>", "<|endoftext|", "ΑΣ ΣΑΣ İi ẞ", "éÉ ẛ̣",
        "it's I'LL can't 'tis 12345 ½Ⅷ²", "</w> x</w> </w>", "\x00 \x1c\x1f a\u0085b c d​e", "",
    ])


def test_long_words(codec, library):
    rng = np.random.default_rng(6)
    blob = base64.b64encode(rng.bytes(6000)).decode()
    letters = "".join(map(chr, rng.integers(97, 123, 20_000)))
    same(codec, library, ["x" * 3000, "ab" * 700 + "zqj" * 300, blob, "é" * 900, "=" * 20_001, "!?" * 5000, letters, "ab" * 30_000])
    assert not any(len(w) > fragments.LONG_WORD for w in codec.words.young)


def test_fragments_are_encoded_alone(codec):
    """Words are really cut, at places that no token of the vocabulary holds, and nothing is lost."""
    words = [b"gatezq9xkcd", b"a", "wörld".encode(), b"manifest"]
    parts, ending, counts = codec.cut(words)
    assert b"".join(parts) == b"".join(words) and counts.sum() == len(parts) and ending.sum() == len(words)
    assert counts[0] > 1 and counts[1] == counts[3] == 1
    for token in codec.text:
        token = token.removesuffix(codec.suffix)
        if token and not token.startswith("<|"):
            raw = fragments.byte_text(token)
            assert len(codec.cut([raw])[0]) == 1 or len(codec.cut([raw + b"a"])[0]) <= 2


def test_the_memory_stays_bounded(library, monkeypatch):
    monkeypatch.setattr(fragments, "KNOWN", 50)
    small = Codec(FILE)
    rng = np.random.default_rng(1)
    for _ in range(5):
        same(small, library, ["gate " + "".join(map(chr, rng.integers(97, 123, 9))) + f" w{i} gate" for i in range(40)])
    assert len(small.words.young) <= 50 + 90 and len(small.words.old) <= 50 + 90
    memory = Memory(1)
    memory.young.update(a=1, b=2)
    memory.age([])
    assert memory.missing({"a", "c"}) == ["c"] and memory.young == {"a": 1}


def test_every_document_against_the_library(spark, library):
    rows = queries.QUERIES["op12_forced_boundary_bpe"](spark, SF).collect()
    text = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(text)
    for r in rows:
        ids = library.encode(text[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_edge_rows(frame, library):
    rows = [(1, None), (2, ""), (None, "U1_SUBSET gate"), (4, "BUST_CIRC_M\n\n 0.92"), (4, "BUST_CIRC_M\n\n 0.92"), (5, " \t\n"), (6, "<|endoftext|>")]
    got = encode_by_fragments(frame(rows), FILE, decode=True).collect()
    assert [r.path for r in got] == [k for k, _ in rows]
    assert [r.ids for r in got] == [library.encode(t or "", add_special_tokens=False).ids for _, t in rows]
    assert got[0].decoded == got[1].decoded == got[5].decoded == "" and got[6].decoded == "<|endoftext|>"
    assert encode_by_fragments(frame([]), FILE).collect() == []


def test_decoding(spark, frame, library):
    back = decode_ids(encode_by_fragments(frame([(1, "Gate 7 blocked"), (2, None)]), FILE), FILE).collect()
    assert [r.decoded for r in back] == ["gate</w> 7</w> blocked</w>", ""]
    odd = spark.createDataFrame([(1, [999_999, -1, None, 320]), (2, None)], "path long, ids array<int>")
    assert [r.decoded for r in decode_ids(odd, FILE).collect()] == [library.id_to_token(320), ""]
