import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tapeline.llm.packing import Vocabulary, cut, pack_documents, place

FILE = P.path("byte_bpe_50k.json")
DOCS = [(1, "one manifest"), (2, None), (3, ""), (None, "no path"), (5, "x " * 9000), (1, "one manifest"), (6, "é\n\n  1'll <|endoftext|>")]


def expected_ids(text):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(FILE)
    t.encode_special_tokens = True
    return t.encode(text or "", add_special_tokens=False).ids + [0]


def test_pieces_and_places(frame):
    rows = pack_documents(frame(DOCS), FILE).collect()
    assert sum(r.length for r in rows) == sum(len(expected_ids(t)) for _, t in DOCS)
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.path, []).append(r)
    for key, text in [DOCS[0], DOCS[3], DOCS[4], DOCS[6]]:
        ids = np.array(expected_ids(text), dtype="<u4")
        for r in by_doc[key]:
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 2048
    assert len(sequences) == -(-sum(r.length for r in rows) // 2048)


def test_vocabulary_is_the_tokenizer_of_the_file():
    """On random letters, bytes, symbols of many planes and white space."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(FILE)
    t.encode_special_tokens = True
    rng = np.random.default_rng(11)
    planes = [(97, 123)] * 6 + [(32, 127), (160, 0x600), (0x3000, 0xD000), (0x1F300, 0x1F6FF), (9, 14)]
    odd = ["".join(chr(rng.integers(*planes[k])) for k in rng.integers(0, len(planes), n)) for n in rng.integers(0, 60, 3000)]
    want = [np.array(e.ids, dtype="<u4").tobytes() for e in t.encode_batch(odd, add_special_tokens=False)]
    assert list(Vocabulary(FILE).ids(odd)) == want


def test_empty_table(frame):
    assert pack_documents(frame([]), FILE).collect() == []


@pytest.mark.parametrize("n,want", [(1, [(0, 1)]), (8, [(0, 8)]), (16, [(0, 8), (8, 8)]), (19, [(0, 3), (3, 8), (11, 8)])])
def test_cut(n, want):
    assert cut(n, 8) == want


def test_place_takes_the_smallest_sum_of_squares():
    """Against the sum counted anew for every open bin."""
    rng = np.random.default_rng(7)
    sizes = sorted(rng.integers(1, 17, 400).tolist(), reverse=True)
    bins, offsets = place(sizes, 32)
    gaps = {}
    for size, b, at in zip(sizes, bins, offsets):
        def squares(chosen):
            counts = {}
            for k, g in gaps.items():
                g = g - size if k == chosen else g
                counts[g] = counts.get(g, 0) + (g > 0)
            return sum(v * v for v in counts.values())

        fits = [k for k, g in gaps.items() if g >= size]
        assert (b in gaps) == bool(fits)
        if fits:
            assert squares(b) == min(squares(k) for k in fits)
        assert at == 32 - gaps.get(b, 32)
        gaps[b] = gaps.get(b, 32) - size
    assert len(gaps) <= -(-sum(sizes) // 32) + 1


def test_whole_table_against_the_tokenizer(spark):
    from tapeline.llm import queries

    rows = queries.QUERIES["op1_sum_of_squares_packing"](spark, "/root/testdata/sf0.01").collect()
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    text = {d.doc_id: expected_ids(d.text) for d in docs[:150]}
    for r in rows:
        if r.doc_id in text:
            ids = np.array(text[r.doc_id], dtype="<u4")
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
    assert len({r.doc_id for r in rows}) == len(docs)
    assert len({r.sequence_id for r in rows}) <= -(-sum(r.length for r in rows) // 2048) + 2
