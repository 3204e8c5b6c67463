"""Sum-of-squares packing of tokenized run documents into sequences of a fixed length."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeline.llm import shared

_vocabularies: dict[str, "Vocabulary"] = {}


class Vocabulary:
    """Ids of a text, by the vocabulary of a byte-level tokenizer file, as little-endian unsigned 32-bit bytes.

    The ids are those the tokenizer of the file gives with special tokens taken as ordinary text. Its vocabulary is
    numbered in merge order, so the numbers serve as the ranks of tiktoken's loop, which is several times faster.
    """

    def __init__(self, file: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(file)
        special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
        ranks = {byte_text(token): i for token, i in tokenizer.get_vocab().items() if token not in special}
        self.encoding = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, documents: list[str]) -> Iterator[bytes]:
        for text in documents:
            yield self.encoding.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()


def byte_text(token: str) -> bytes:
    """Byte-level files write each byte as one printable character: itself, or in order from U+0100."""
    return bytes(_BYTES[c] for c in token)


_PRINTED = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
_BYTES = {chr(b): b for b in _PRINTED}
_BYTES |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in _PRINTED)}


def vocabulary(file: str) -> Vocabulary:
    if file not in _vocabularies:
        _vocabularies[file] = Vocabulary(file)
    return _vocabularies[file]


def cut(n: int, length: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: the first piece takes what full pieces leave over."""
    first = n if n <= length else n % length or length
    return [(0, first)] + [(s, length) for s in range(first, n, length)]


def place(lengths: list[int], length: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each piece, in the given order.

    A piece goes into the open bin that leaves the smallest sum over gaps of (number of open bins with that
    gap) squared; among equal sums into the smallest gap. A bin is opened only when the piece fits into none.
    """
    open_bins = np.zeros(length + 1, dtype=np.int64)  # by gap; 0 (full) never counts
    stacks: list[list[int]] = [[] for _ in range(length + 1)]
    bins, offsets, opened = [], [], 0
    for size in lengths:
        here = open_bins[size:length]
        # what moving one bin from gap g to gap g - size adds to the sum of squares, halved
        gain = np.where(here > 0, open_bins[: length - size] - here, np.iinfo(np.int64).max)
        best = int(gain.argmin()) if len(gain) else 0
        if len(gain) and here[best] > 0:
            gap = best + size
            chosen = stacks[gap].pop()
            open_bins[gap] -= 1
        else:
            gap, chosen = length, opened
            opened += 1
        bins.append(chosen)
        offsets.append(length - gap)
        if gap > size:
            stacks[gap - size].append(chosen)
            open_bins[gap - size] += 1
    return bins, offsets


def pack_documents(
    documents: DataFrame,
    vocabulary_file: str,
    path: str = "path",
    doc: str = "doc",
    length: int = 2048,
    end_id: int = 0,
    group_documents: int = 65536,
) -> DataFrame:
    """Pack run documents (``path``, ``doc``) into as few sequences of at most ``length`` ids as it can.

    Each document becomes its ids followed by ``end_id``; only one longer than ``length`` is cut, into pieces of
    ``length`` whose first one may be shorter. One row per piece: ``path``, piece, start, length, ids_crc32,
    sequence_id, offset. Documents are dealt evenly, whatever their path, to groups of about
    ``group_documents``; a group places its pieces from the longest to the shortest by the sum-of-squares rule and
    leaves one or two sequences partly filled, so the loss does not grow with the table. Only the piece
    descriptors are shuffled, never a text.

    NULL and empty documents are the single ``end_id``. A NULL path is kept. Repeated rows are packed each.
    An empty table gives no rows. Other columns are ignored, so their names cannot clash.
    """
    source = documents.select(F.col(path).alias("path"), F.col(doc).alias("doc"))
    kind = source.schema["path"].dataType
    pieces = T.StructType([
        T.StructField("path", kind), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
    ])
    placed = T.StructType([*pieces.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    end = np.array([end_id], dtype="<u4").tobytes()

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(vocabulary_file)
        out = shared.arrow_schema(pieces)
        for batch in shared.chunks(batches):
            rows = []
            for key, ids in zip(batch.column(0).to_pylist(), words.ids(shared.texts(batch.column(1)))):
                ids += end
                for i, (start, n) in enumerate(cut(len(ids) // 4, length)):
                    rows.append((key, i, start, n, zlib.crc32(ids[4 * start : 4 * (start + n)])))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), out.types)], schema=out)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        out = shared.arrow_schema(placed)
        table = pa.Table.from_batches(list(batches), schema=shared.arrow_schema(pieces))
        if not table.num_rows:
            return
        order = [("length", "descending"), *[(c, "ascending") for c in ("path", "piece", "start", "ids_crc32")]]
        table = table.sort_by(order)
        bins, offsets = place(table.column("length").to_pylist(), length)
        base = TaskContext.get().partitionId() << 32
        table = table.append_column("sequence_id", pa.array(np.array(bins, dtype=np.int64) + base))
        table = table.append_column("offset", pa.array(offsets, pa.int64()))
        yield from table.cast(out).to_batches(max_chunksize=10_000)

    groups = max(1, -(-source.count() // group_documents))
    return source.mapInArrow(tokenize, pieces).repartition(groups).mapInArrow(pack, placed).withColumnRenamed("path", path)
