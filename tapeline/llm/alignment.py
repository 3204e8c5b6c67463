"""Alignment of two tokenizers over run documents: token-byte incidence matrices in compressed rows and their products."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeline.llm import shared
from tapeline.llm.fragments import Memory
from tapeline.llm.packing import vocabulary

KNOWN = 100_000  # fragments in the younger half of what a worker remembers
LONG_FRAGMENT = 64  # characters from which a fragment is not remembered
PAGE_CHARS = 250_000  # text of one row of the encoded table, or one longer document
BLOCK_PAGES = 16  # pages whose pairs are counted together before they are shuffled
PRODUCT_ENTRIES = 400_000  # entries a product expands at a time
BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")
_codecs: dict[tuple[str, str], "Codecs"] = {}


class Rows(NamedTuple):
    """A 0/1 matrix in compressed sparse rows: row r holds columns ``col[ptr[r]:ptr[r + 1]]``, ascending."""

    ptr: np.ndarray
    col: np.ndarray


def product(a: Rows, b: Rows, first: int = 0, last: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, value) of rows ``first`` to ``last`` of the product A B, by Gustavson: each row of A gathers the
    rows of B that its entries name, and equal columns are added up."""
    last = len(a.ptr) - 1 if last is None else last
    inner = a.col[a.ptr[first] : a.ptr[last]]
    row = np.repeat(np.arange(first, last), np.diff(a.ptr[first : last + 1]))
    width = b.ptr[inner + 1] - b.ptr[inner]
    row = np.repeat(row, width)
    col = b.col[np.arange(len(row)) + np.repeat(b.ptr[inner] - (np.cumsum(width) - width), width)]
    falls = (np.diff(row) == 0) & (np.diff(col) < 0)
    if falls.any():
        order = np.lexsort((col, row))
        row, col = row[order], col[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (np.diff(row) != 0) | (np.diff(col) != 0)
    at = np.flatnonzero(new)
    return row[at], col[at], np.diff(np.append(at, len(row)))


def product_parts(a: Rows, b: Rows) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The product some rows at a time, so that what it expands stays small; a row is never cut."""
    width = np.concatenate([[0], np.cumsum(b.ptr[a.col + 1] - b.ptr[a.col])])[a.ptr]  # entries before each row
    first, rows = 0, len(a.ptr) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(width, width[first] + PRODUCT_ENTRIES, side="right")) - 1)
        yield product(a, b, first, last)
        first = last


class Aligned:
    """Links and groups of documents whose tokens of both kinds cover the same bytes, one document behind the other."""

    def __init__(self, length_a: np.ndarray, length_b: np.ndarray):
        ends_a, ends_b = np.cumsum(length_a), np.cumsum(length_b)
        self.n_a, self.n_b = len(ends_a), len(ends_b)
        n_bytes = int(ends_a[-1]) if self.n_a else 0
        self.a = Rows(np.concatenate([[0], ends_a]), np.arange(n_bytes))  # token by byte
        self.b_t = Rows(np.arange(n_bytes + 1), np.repeat(np.arange(self.n_b), length_b))  # byte by token
        cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)  # tokens have at least one byte
        self.n_groups = len(cuts)
        self.group_a, self.group_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)

    def overlap_links(self) -> tuple[np.ndarray, np.ndarray]:
        """(A token, B token) of each pair that shares a byte: the entries of A Bᵀ."""
        parts = [(row, col) for row, col, _ in product_parts(self.a, self.b_t)]
        return tuple(np.concatenate(c) for c in zip(*parts)) if parts else (np.empty(0, np.int64), np.empty(0, np.int64))

    def shared_group_links(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(A token, B token) of each pair in one group: the entries of the product of both group incidences, in parts."""
        by_group = Rows(np.searchsorted(self.group_b, np.arange(self.n_groups + 1)), np.arange(self.n_b))
        for row, col, _ in product_parts(Rows(np.arange(self.n_a + 1), self.group_a), by_group):
            yield row, col


class Codecs:
    """Ids by a byte-level tokenizer file (A) and by a piece model (B), and the bytes of their tokens."""

    def __init__(self, byte_level_file: str, piece_file: str):
        import sentencepiece

        self.a = vocabulary(byte_level_file).encoding
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_file)
        self.size_a, self.size_b = self.a.n_vocab, self.b.get_piece_size()
        self.length_a = np.zeros(self.size_a, dtype=np.int64)
        for token in self.a.token_byte_values():
            self.length_a[self.a.encode_single_token(token)] = len(token)
        pieces = [self.b.id_to_piece(i) for i in range(self.size_b)]
        self.bytes_b = [
            bytes([int(BYTE_PIECE.fullmatch(p)[1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.length_b = np.array([len(x) for x in self.bytes_b], dtype=np.int64)
        self.space = self.b.piece_to_id("▁")
        # No piece has a space behind another character and no match of A's pattern crosses from a character to the space after
        # it, but for white space before it: there a fragment starts that both encode alone.
        apart = not any("▁" in p.lstrip("▁") for p in pieces)
        self.fragments = re.compile(r" +(?:[^ ]*[^\S ] +)*[^ ]*" if apart else r"(?s).+").findall
        self.known = Memory(KNOWN)
        self.kind_a, self.kind_b = ("<u2" if n <= 1 << 16 else "<u4" for n in (self.size_a, self.size_b))
        names = [[f"{i}{mark}" for mark in marks for i in range(n)] for n, marks in ((self.size_a, ",|"), (self.size_b, ",;"))]
        self.names = np.array(names[0] + names[1], dtype=object)

    def encode(self, texts: list[str]) -> tuple[list[bytes], list[bytes]]:
        """Ids of space + text by A and of text by B, both empty where B's bytes are not those of space + text."""
        split = [self.fragments(" " + t) if t else [] for t in texts]
        known = self.known
        new = known.missing(set().union(*split))
        if new:
            known.young.update(zip(new, self.encode_fragments(new)))
        ids_a, ids_b = [], []
        for fragments in split:
            parts = [known.young[f] for f in fragments]
            right = None not in parts
            ids_a.append(b"".join([a for a, _ in parts]) if right else b"")
            ids_b.append(b"".join([b for _, b in parts]) if right else b"")
        known.age([f for f in new if len(f) > LONG_FRAGMENT])
        return ids_a, ids_b

    def encode_fragments(self, fragments: list[str]) -> list[tuple[bytes, bytes] | None]:
        """Ids of each fragment by A and B, None where B's bytes are others."""
        b = self.b.encode([f[1:] for f in fragments], num_threads=1)
        b = [[self.space] if f == " " else ids for f, ids in zip(fragments, b)]
        a = [self.a.encode_ordinary(f) for f in fragments]
        # a character that B changes makes its bytes fewer, so equal sums of bytes are equal bytes
        if b"".join([self.bytes_b[i] for ids in b for i in ids]) == "".join(fragments).encode():
            right = [True] * len(fragments)
        else:
            right = [b"".join([self.bytes_b[i] for i in ids]) == f.encode() for f, ids in zip(fragments, b)]
        raw = []
        for side, kind in ((a, self.kind_a), (b, self.kind_b)):
            flat = np.fromiter(chain.from_iterable(side), dtype=kind).tobytes()
            ends = (np.cumsum([len(ids) for ids in side]) * np.dtype(kind).itemsize).tolist()
            raw.append([flat[i:j] for i, j in zip([0, *ends], ends)])
        return [x if ok else None for ok, *x in zip(right, *raw)]

    def packed(self, ids: list[bytes]) -> bytes:
        return pa.compress(b"".join(ids), codec="zstd", asbytes=True)

    def unpacked(self, page: dict) -> tuple[np.ndarray, np.ndarray]:
        """Ids of both kinds of all documents of a page."""
        return tuple(
            np.frombuffer(pa.decompress(page[f"ids_{x}"], n * np.dtype(kind).itemsize, codec="zstd", asbytes=True), kind).astype(np.int64)
            for x, kind, n in (("a", self.kind_a, sum(page["sizes_a"])), ("b", self.kind_b, sum(page["sizes_b"])))
        )

    def group_texts(self, aligned: Aligned, ids_a: np.ndarray, ids_b: np.ndarray, starts: np.ndarray) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` of each document; ``starts`` are the first groups of the documents and the end."""
        at_a = np.arange(aligned.n_a) + np.searchsorted(aligned.group_b, aligned.group_a, side="left")
        at_b = np.arange(aligned.n_b) + np.searchsorted(aligned.group_a, aligned.group_b, side="right")
        ends_a, ends_b = (np.diff(g, append=aligned.n_groups) != 0 for g in (aligned.group_a, aligned.group_b))
        name = np.empty(aligned.n_a + aligned.n_b, dtype=np.int64)
        name[at_a] = ids_a + self.size_a * ends_a
        name[at_b] = 2 * self.size_a + ids_b + self.size_b * ends_b
        words = self.names[name].tolist()
        stops = (np.searchsorted(aligned.group_a, starts) + np.searchsorted(aligned.group_b, starts)).tolist()
        return ["".join(words[i:j])[:-1] for i, j in zip(stops, stops[1:])]


def codecs(byte_level_file: str, piece_file: str) -> Codecs:
    key = (byte_level_file, piece_file)
    if key not in _codecs:
        _codecs[key] = Codecs(*key)
    return _codecs[key]


def _starts(sizes: list[int]) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(np.array(sizes, dtype=np.int64))])


def align_tokenizers(documents: DataFrame, byte_level_file: str, piece_file: str, path: str = "path", doc: str = "doc") -> DataFrame:
    """How the tokens of two tokenizers lie on each run document (``path``, ``doc``) and which of their tokens belong together.

    A encodes space + text by a byte-level tokenizer file, B the text by a piece model that adds the space itself, both
    without special tokens. Byte offsets at which tokens of both kinds end cut the document into groups. A link is a
    pair of tokens that overlap in bytes (an entry of A Bᵀ over bytes); tokens of one group are linked as a group (an
    entry of the product of the group incidences). The count of a pair of ids is the number of rows whose document
    holds it as a link. One row per document: ``path``, n_a, n_b, n_groups, n_links, n_best (links whose count is the
    highest of their A id, ties included), count_sum (of the counts of all links), n_shared (pairs within groups) and
    groups (``a1,a2|b1;a3|b2,b3``: ids of A and B by group).

    The ids are written once, in pages; pages make blocks, whose distinct pairs are counted before anything is
    shuffled, by pair to add them up and by block to bring the counts back. No text is shuffled; a task holds one block,
    and what a product expands is bounded.

    NULL and empty documents, and those whose B bytes are not those of space + text, have no tokens: all numbers 0, an empty
    groups text. A NULL path and repeated rows are kept and counted each. An empty table gives no rows. Other columns
    are ignored, so their names cannot clash.
    """
    import sentencepiece

    source = documents.select(F.col(path).alias("path"), F.col(doc).alias("doc"))
    kind = source.schema["path"].dataType
    pages = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("paths", T.ArrayType(kind)),
        *[T.StructField(f"sizes_{x}", T.ArrayType(T.IntegerType())) for x in "ab"],
        *[T.StructField(f"ids_{x}", T.BinaryType()) for x in "ab"],
    ])
    counts = T.StructType([T.StructField("block", T.LongType()), T.StructField("pair", T.LongType()), T.StructField("n", T.LongType())])
    numbers = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "n_shared"]
    result = T.StructType([source.schema["path"], *[T.StructField(c, T.LongType()) for c in numbers], T.StructField("groups", T.StringType())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own, out = codecs(byte_level_file, piece_file), shared.arrow_schema(pages)
        base = TaskContext.get().partitionId() << 32
        for i, batch in enumerate(shared.sized_chunks(batches, 1, PAGE_CHARS)):
            ids = own.encode(shared.texts(batch.column(1)))
            sizes = [[len(x) // np.dtype(k).itemsize for x in of] for of, k in zip(ids, (own.kind_a, own.kind_b))]
            row = [base + i // BLOCK_PAGES, batch.column(0).to_pylist(), *sizes, *map(own.packed, ids)]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, out.types)], schema=out)

    def linked(own: Codecs, page: dict):
        ids_a, ids_b = own.unpacked(page)
        aligned = Aligned(own.length_a[ids_a], own.length_b[ids_b])
        a, b = aligned.overlap_links()
        return ids_a, ids_b, aligned, a, ids_a[a] * own.size_b + ids_b[b]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, out = codecs(byte_level_file, piece_file), shared.arrow_schema(counts)
        block, seen = None, []

        def flush() -> Iterator[pa.RecordBatch]:
            pairs, n = np.unique(np.concatenate(seen), return_counts=True) if seen else (np.empty(0, np.int64), np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pairs), block, dtype=np.int64)), pa.array(pairs), pa.array(n)], schema=out)

        for batch in shared.chunks(batches, 1):
            page = batch.to_pylist()[0]
            if block is not None and page["block"] != block:
                yield from flush()
                seen = []
            block = page["block"]
            _, _, _, a, pairs = linked(own, page)
            document = np.searchsorted(_starts(page["sizes_a"]), a, side="right")
            seen.append(np.unique(document * (own.size_a * own.size_b) + pairs) % (own.size_a * own.size_b))
        if block is not None:
            yield from flush()

    def measure(encoded: pa.Table, totals: pa.Table) -> pa.Table:
        own, out = codecs(byte_level_file, piece_file), shared.arrow_schema(result)
        pair = totals.column("pair").to_numpy()
        order = np.argsort(pair)
        pair, total, top = pair[order], totals.column("total").to_numpy()[order], totals.column("top").to_numpy()[order]
        parts = []
        for i in range(encoded.num_rows):
            page = encoded.slice(i, 1).to_pylist()[0]
            ids_a, ids_b, aligned, a, links = linked(own, page)
            at = np.searchsorted(pair, links)
            starts_a, starts_b = _starts(page["sizes_a"]), _starts(page["sizes_b"])
            link_starts = np.searchsorted(a, starts_a)
            groups = np.append(aligned.group_a, aligned.n_groups)[starts_a]
            within = np.zeros(aligned.n_a + 1, dtype=np.int64)
            for rows, _ in aligned.shared_group_links():
                within[1:] += np.bincount(rows, minlength=aligned.n_a)

            def per_document(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
                return np.diff(np.concatenate([[0], np.cumsum(values)])[starts])

            columns = [
                page["paths"], np.diff(starts_a), np.diff(starts_b), np.diff(groups), np.diff(link_starts),
                per_document(total[at] == top[at], link_starts), per_document(total[at], link_starts),
                np.diff(np.cumsum(within)[starts_a]), own.group_texts(aligned, ids_a, ids_b, groups),
            ]
            parts.append(pa.table([pa.array(c, t) for c, t in zip(columns, out.types)], schema=out))
        shared.give_back()
        return pa.concat_tables(parts) if parts else out.empty_table()

    encoded = shared.written(source.mapInArrow(encode, pages), "tokens")
    pairs = shared.written(encoded.mapInArrow(count, counts), "pairs")
    # of one A id there are at most as many pairs as B has ids
    totals = pairs.groupBy("pair").agg(F.sum("n").alias("total"))
    b_ids = sentencepiece.SentencePieceProcessor(model_file=piece_file).get_piece_size()
    totals = totals.withColumn("top", F.max("total").over(Window.partitionBy(F.expr(f"pair DIV {b_ids}"))))
    known = pairs.select("block", "pair").join(totals, "pair")
    found = encoded.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(measure, result)
    return found.withColumnRenamed("path", path)
