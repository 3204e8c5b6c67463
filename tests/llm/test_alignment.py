import base64
import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from tapeline.llm import alignment, queries
from tapeline.llm.alignment import Aligned, Rows, align_tokenizers, product, product_parts

SF = "/root/testdata/sf0.001"
FILES = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
NUMBERS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "n_shared", "groups"]


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(FILES[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=FILES[1])


def tokens(libraries, text):
    """(id, bytes) of both tokenizers, or nothing where they cannot be aligned."""
    from tapeline.llm.packing import byte_text

    a, b = libraries
    if not text:
        return [], []
    encoded = a.encode(" " + text, add_special_tokens=False)
    left = [(i, byte_text(t)) for i, t in zip(encoded.ids, encoded.tokens)]
    ids = b.encode(text)
    right = []
    for i in ids:
        piece = b.id_to_piece(i)
        right.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
    want = (" " + text).encode()
    same = b"".join(x for _, x in left) == want == b"".join(x for _, x in right)
    return (left, right) if same else ([], [])


def brute(libraries, texts):
    """Links by comparing byte ranges token by token."""
    found, counts = [], Counter()
    for text in texts:
        left, right = tokens(libraries, text)
        spans = []
        for side in (left, right):
            at, own = 0, []
            for i, raw in side:
                own.append((i, at, at + len(raw)))
                at += len(raw)
            spans.append(own)
        links, j0 = [], 0
        for a, s, e in spans[0]:
            while j0 < len(spans[1]) and spans[1][j0][2] <= s:
                j0 += 1
            j = j0
            while j < len(spans[1]) and spans[1][j][1] < e:
                links.append((a, spans[1][j][0]))
                j += 1
        cuts = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        groups, s = [], 0
        for e in cuts:
            groups.append(tuple([i for i, x, y in side if s < y <= e] for side in spans) if len(text) < 3000 else None)
            s = e
        if groups and groups[0] is None:  # the same in one pass
            groups = [([], []) for _ in cuts]
            for k, side in enumerate(spans):
                g = 0
                for i, _, e in side:
                    while cuts[g] < e:
                        g += 1
                    groups[g][k].append(i)
        counts.update(set(links))
        found.append((left, right, links, groups))
    best = defaultdict(int)
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    return [
        (len(left), len(right), len(groups), len(links), sum(counts[x] == best[x[0]] for x in links), sum(counts[x] for x in links),
         sum(len(x) * len(y) for x, y in groups), ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups))
        for left, right, links, groups in found
    ]


def test_product_of_random_matrices(monkeypatch):
    rng = np.random.default_rng(2)
    for _ in range(50):
        a, b = (rng.integers(0, 2, (rng.integers(1, 9), 7)), rng.integers(0, 2, (7, rng.integers(1, 9))))
        rows = [Rows(np.concatenate([[0], np.cumsum(m.sum(1))]), np.nonzero(m)[1]) for m in (a, b)]
        r, c, v = product(*rows)
        dense = np.zeros((a.shape[0], b.shape[1]), dtype=int)
        dense[r, c] = v
        assert (dense == a @ b).all() and (v > 0).all() and len(set(zip(r.tolist(), c.tolist()))) == len(r)
        monkeypatch.setattr(alignment, "PRODUCT_ENTRIES", 5)
        parts = list(product_parts(*rows))
        assert [np.concatenate(x).tolist() for x in zip(*parts)] == [x.tolist() for x in (r, c, v)]


def test_links_and_groups_of_one_document():
    found = Aligned(np.array([3, 2, 1]), np.array([1, 2, 1, 2]))  # ends 3 5 6 and 1 3 4 6
    a, b = found.overlap_links()
    assert list(zip(a.tolist(), b.tolist())) == [(0, 0), (0, 1), (1, 2), (1, 3), (2, 3)]
    assert found.n_groups == 2 and found.group_a.tolist() == [0, 1, 1] and found.group_b.tolist() == [0, 0, 1, 1]
    shared = [(x, y) for r, c in found.shared_group_links() for x, y in zip(r.tolist(), c.tolist())]
    assert shared == [(0, 0), (0, 1), (1, 2), (1, 3), (2, 2), (2, 3)]


def test_random_texts_against_the_libraries(libraries, frame, monkeypatch):
    rng = np.random.default_rng(13)
    planes = [(97, 123)] * 6 + [(32, 127), (160, 0x600), (0x3000, 0xD000), (0x1F300, 0x1F6FF), (9, 14), (32, 33)]
    texts = ["".join(chr(rng.integers(*planes[k])) for k in rng.integers(0, len(planes), n)) for n in rng.integers(0, 60, 400)]
    texts += ["a", "a ", " ", "   ", "a    b  ", "x▁y", "<s></s><unk><0x41> <|endoftext|>", "\x00\x7f", "ﬁ é é", "﻿​", "gate\r\n\tpass"]
    monkeypatch.setattr(alignment, "PAGE_CHARS", 700)
    rows = align_tokenizers(frame(list(enumerate(texts))), *FILES).collect()
    got = {r.path: tuple(r[c] for c in NUMBERS) for r in rows}
    want = brute(libraries, texts)
    assert [got[i] for i in range(len(texts))] == want
    assert want[texts.index("x▁y")] == (0,) * 7 + ("",)
    assert sum(w[0] > 0 for w in want) > 300


def test_long_documents(libraries, frame):
    rng = np.random.default_rng(4)
    texts = ["=" * 30_000, base64.b64encode(rng.bytes(60_000)).decode(), "a " * 40_000, "é" * 20_000, "BUST_CIRC_M 0.92\n" * 5000]
    rows = align_tokenizers(frame(list(enumerate(texts))), *FILES).collect()
    assert {r.path: tuple(r[c] for c in NUMBERS) for r in rows} == dict(enumerate(brute(libraries, texts)))


def test_query_against_brute_force(spark, libraries):
    documents = spark.read.parquet(f"{SF}/documents.parquet").collect()
    rows = {r.doc_id: r for r in queries.QUERIES["op13_incidence_alignment"](spark, SF).collect()}
    assert len(rows) == len(documents)
    for d, want in zip(documents, brute(libraries, [d.text or "" for d in documents])):
        r = rows[d.doc_id]
        assert tuple(r[c] for c in NUMBERS[:-1]) == want[:-1]
        assert r.groups_sha256 == (hashlib.sha256(want[-1].encode()).hexdigest() if want[-1] else "")


def test_edge_rows(libraries, frame):
    rows = [(1, None), (2, ""), (None, "U1 gate"), (4, "gate blocked"), (4, "gate blocked"), (5, "▁")]
    got = align_tokenizers(frame(rows), *FILES).collect()
    assert sorted(((r.path or 0, *(r[c] for c in NUMBERS)) for r in got)) == sorted(
        (k or 0, *w) for (k, _), w in zip(rows, brute(libraries, [t or "" for _, t in rows]))
    )
    assert align_tokenizers(frame([]), *FILES).collect() == []
    alone = align_tokenizers(frame([(1, None), (2, "▁ x")]), *FILES).collect()
    assert [tuple(r[c] for c in NUMBERS) for r in alone] == [(0,) * 7 + ("",)] * 2
