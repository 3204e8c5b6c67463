"""Byte-level BPE of run documents in DuckDB: a recursive query per task encodes, an ordered aggregation decodes."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeline.llm import shared
from tapeline.llm.fragments import CONTRACTIONS, SPACES, Memory, character_classes, unsettled

KNOWN_WORDS = 250_000  # words, and parts of words, in the younger half of what a worker remembers
LONG_WORD = 64  # bytes from which a word or part is not remembered
STEP_ROWS = 3_000_000  # rows one recursive query may add before its state is taken over by the next
STATE_BYTES = 1_000_000  # bytes of words that go into one query
BATCH_BYTES = 4_000_000  # text encoded at a time, or one longer document

# Each step contracts, in every word that still has a mergeable pair, the leftmost pair of smallest rank. A row knows the
# row behind it and the rank of the pair they form. Of the pair the second row stays, as the new token, for it already knows
# what is behind it; the row before the pair learns of it, and only these two look up their rank. Words without a pair drop
# out; the last state of a word is its encoding, unless the steps ran out.
ENCODE = """
WITH RECURSIVE step(word, place, token, behind, next_token, rank, n) AS (
    SELECT word, place, token, behind, next_token, rank, 0
    FROM state LEFT JOIN merges ON merges.a = token AND merges.b = next_token
    UNION ALL
    (WITH best AS (
        SELECT word, min(rank::BIGINT << 32 | place) AS pair, arg_min(behind, rank::BIGINT << 32 | place) AS kept,
               (pair & 4294967295)::INTEGER AS gone, (pair >> 32)::INTEGER AS made
        FROM step WHERE n < $steps AND rank IS NOT NULL GROUP BY word
    ), moved AS (
        SELECT s.word, place, kept = place AS here, gone IS NOT DISTINCT FROM behind AS before, rank, n,
               CASE WHEN here THEN made ELSE token END AS token, CASE WHEN before THEN kept ELSE behind END AS behind,
               CASE WHEN before THEN made ELSE next_token END AS next_token
        FROM step s JOIN best ON s.word = best.word WHERE place <> gone
    )
    SELECT word, place, token, behind, next_token, CASE WHEN here OR before THEN merges.rank ELSE moved.rank END, n + 1
    FROM moved LEFT JOIN merges ON (here OR before) AND merges.a = token AND merges.b = next_token)
), last AS (SELECT word, max(n) AS n FROM step GROUP BY word)
SELECT word, place, token, behind, next_token, n = $steps AS open FROM step JOIN last USING (word, n) ORDER BY word, place
"""
# The aggregate takes its rows in the order of the subquery; one sort of all rows costs half of one per document.
DECODE = """
SELECT document, string_agg(text, '') AS decoded
FROM (SELECT document, place, text FROM ids JOIN vocabulary USING (token) ORDER BY document, place) GROUP BY document
"""
_codecs: dict[str, "Codec"] = {}
ZERO = "\u0100"  # stands for the byte 0 in texts of a character per byte


@cache
def patterns() -> list[tuple[str, re.Pattern]]:
    """(last character, the tokenizer's pattern with its classes written out) for texts of characters up to that one."""
    return [
        (end, re.compile(f"{CONTRACTIONS}| ?[{letters}]+| ?[{numbers}]+| ?[^{SPACES}{letters}{numbers}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+"))
        for end, letters, numbers in character_classes()
    ]


@cache
def whole_pattern():
    import public_tokenizers
    import regex

    return regex.compile(public_tokenizers.PATTERN)


def _is_text(token: bytes) -> bool:
    try:
        token.decode()
    except UnicodeDecodeError:
        return False
    return True


class Codec:
    """A vocabulary of ranks with its merge table, in a DuckDB of the task's own."""

    def __init__(self, file: str):
        import duckdb

        with open(file, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.settled: set[str] = set()
        self.of_byte = np.array([ranks[bytes([i])] for i in range(256)], dtype=np.int32)
        self.crossed = np.zeros((256, 256), dtype=bool)  # pairs of bytes that stand inside some token
        merges = []
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                self.crossed[token[i - 1], token[i]] = True
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    merges.append((a, b, rank))
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "300MB", "temp_directory": ""})
        a, b, rank = (pa.array(c, pa.int32()) for c in zip(*merges))
        self._store("merges", pa.table({"a": a, "b": b, "rank": rank}))
        text = [t.decode("latin-1").replace("\0", ZERO) for t in ranks]  # a character for each byte
        self._store("vocabulary", pa.table({"token": pa.array(ranks.values(), pa.int32()), "text": text}))
        # a word that is a token is that token
        self.whole = {t.decode(): np.int32(r).tobytes() for t, r in ranks.items() if _is_text(t)}
        self.words, self.parts = Memory(KNOWN_WORDS), Memory(KNOWN_WORDS)

    def _store(self, name: str, rows: pa.Table) -> None:
        self.db.register("given", rows)
        self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self.db.unregister("given")

    def _run(self, name: str, rows: pa.Table, sql: str, **values) -> pa.Table:
        self.db.register(name, rows)
        found = self.db.sql(sql, params=values or None).to_arrow_table()
        self.db.unregister(name)
        return found

    def split(self, text: str) -> list[str]:
        """The matches of the tokenizer's pattern; by the regex library where Unicode versions may disagree."""
        if text.isascii():
            return patterns()[0][1].findall(text)
        chars = set(text)
        self.settled.update(c for c in chars - self.settled if not unsettled(c))
        if chars <= self.settled:
            last = max(chars)
            return next(p for end, p in patterns() if last <= end).findall(text)
        return whole_pattern().findall(text)

    def cut(self, words: list[bytes]) -> tuple[list[bytes], list[int]]:
        """The words cut where no token of the vocabulary could cross, as merges on either side are independent; and where
        the parts of each word end."""
        joined = b"".join(words)
        b = np.frombuffer(joined, dtype=np.uint8)
        ends = np.cumsum([len(w) for w in words])
        last = np.ones(len(b), dtype=bool)
        last[:-1] = ~self.crossed[b[:-1], b[1:]]
        last[ends - 1] = True
        stops = np.flatnonzero(last) + 1
        bounds = stops.tolist()
        return [joined[i:j] for i, j in zip([0, *bounds], bounds)], np.searchsorted(stops, ends, side="right").tolist()

    def encode_words(self, words: list[str]) -> list[bytes]:
        """The ids of each word as little-endian 32-bit bytes."""
        parts, ends = self.cut([w.encode() for w in words])
        known = self.parts
        new = known.missing(set(parts))
        filled, start = 0, 0
        for i, part in enumerate(new):
            filled += len(part)
            if filled >= STATE_BYTES or i + 1 == len(new):
                known.young.update(zip(new[start : i + 1], self.encode_parts(new[start : i + 1])))
                filled, start = 0, i + 1
        raw = [known.young[p] for p in parts]
        known.age([p for p in new if len(p) > LONG_WORD])
        return [b"".join(raw[i:j]) if j - i > 1 else raw[i] for i, j in zip([0, *ends], ends)]

    def encode_parts(self, parts: list[bytes]) -> list[bytes]:
        """The same of parts of words, by the recursive query."""
        sizes = np.array([len(p) for p in parts], dtype=np.int64)
        begin = np.cumsum(sizes) - sizes
        token = self.of_byte[np.frombuffer(b"".join(parts), dtype=np.uint8)]
        place = (np.arange(sizes.sum()) - np.repeat(begin, sizes)).astype(np.int32)
        inside = place + 1 < np.repeat(sizes, sizes)  # the last of a part has none behind it
        columns = ["word", "place", "token", "behind", "next_token"]
        state = pa.table({
            "word": np.repeat(np.arange(len(parts), dtype=np.int32), sizes), "place": place, "token": token,
            "behind": pa.array(place + 1, mask=~inside), "next_token": pa.array(np.append(token[1:], 0), pa.int32(), mask=~inside),
        })
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while state.num_rows:
            steps = max(16, STEP_ROWS // state.num_rows)
            found = self._run("state", state, ENCODE, steps=steps)
            still = found.column("open").to_numpy()
            closed = found.filter(pa.array(~still))
            done.append((closed.column("word").to_numpy(), closed.column("token").to_numpy()))
            state = found.filter(pa.array(still)).select(columns)
        word, token = (np.concatenate(c) for c in zip(*done)) if done else (np.empty(0, int), np.empty(0, np.int32))
        order = np.argsort(word, kind="stable")
        ends = np.cumsum(np.bincount(word, minlength=len(parts)))
        raw = token[order].astype("<i4").tobytes()
        return [raw[4 * s : 4 * e] for s, e in zip(np.append(0, ends[:-1]).tolist(), ends.tolist())]

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [self.split(t) for t in texts]
        known = self.words
        new = known.missing(set().union(*split))
        whole = {w: self.whole[w] for w in new if w in self.whole}
        rest = [w for w in new if w not in whole]
        known.young.update(whole)
        if rest:
            known.young.update(zip(rest, self.encode_words(rest)))
        out = [b"".join(map(known.young.__getitem__, words)) for words in split]
        known.age([w for w in new if len(w) > LONG_WORD])
        return out

    def decode(self, ids: list[bytes]) -> list[bytes]:
        """The bytes of each id sequence; ids outside the vocabulary have none."""
        sizes = np.array([len(x) // 4 for x in ids], dtype=np.int64)
        token = np.frombuffer(b"".join(ids), dtype="<i4")
        rows = pa.table({"document": np.repeat(np.arange(len(ids), dtype=np.int32), sizes),
                         "place": np.arange(len(token), dtype=np.int32), "token": token})
        out = [b""] * len(ids)
        found = self._run("ids", rows, DECODE)
        for i, raw in zip(found.column(0).to_pylist(), found.column(1).to_pylist()):
            out[i] = raw.encode("latin-1") if ZERO not in raw else raw.replace(ZERO, "\0").encode("latin-1")
        return out


def codec(file: str) -> Codec:
    if file not in _codecs:
        _codecs[file] = Codec(file)
    return _codecs[file]


def encode_documents(documents: DataFrame, vocabulary_file: str, path: str = "path", doc: str = "doc", decode: bool = False) -> DataFrame:
    """(``path``, ids) of every run document, and with ``decode`` the bytes those ids stand for.

    The words of the tokenizer pattern are encoded apart, without special tokens, by ranks; a task encodes the distinct
    parts of words of a few hundred documents at a time in a recursive query, bounded by their bytes, and remembers a
    bounded number of words.
    NULL and empty documents have no ids; a NULL path and repeated rows are kept; words are cut where no
    token could cross, and what is very long takes its steps in several queries. An empty table gives no rows. Other columns
    are ignored.
    """
    source = documents.select(F.col(path).alias("path"), F.col(doc).alias("doc"))
    fields = [source.schema["path"], T.StructField("ids", T.ArrayType(T.IntegerType()))]
    schema = T.StructType(fields + [T.StructField("decoded", T.BinaryType())] * decode)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(vocabulary_file)
        out = shared.arrow_schema(schema)
        for batch in shared.sized_chunks(batches, 1, BATCH_BYTES, 500):
            ids = own.encode(shared.texts(batch.column(1)))
            ends = np.cumsum([0] + [len(x) // 4 for x in ids]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), dtype="<i4")))
            columns = [batch.column(0).cast(out.types[0]), lists.cast(out.types[1])]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(own.decode(ids), pa.binary())] * decode, schema=out)

    return source.mapInArrow(each, schema).withColumnRenamed("path", path)


def decode_documents(encoded: DataFrame, vocabulary_file: str, path: str = "path", ids: str = "ids") -> DataFrame:
    """(``path``, decoded bytes) of id sequences; NULL and empty sequences give no bytes."""
    source = encoded.select(F.col(path).alias("path"), F.col(ids).cast("array<int>").alias("ids"))
    schema = T.StructType([source.schema["path"], T.StructField("decoded", T.BinaryType())])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(vocabulary_file)
        out = shared.arrow_schema(schema)
        for batch in shared.chunks(batches, 500):
            raw = [np.array(x or [], dtype="<i4").tobytes() for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(out.types[0]), pa.array(own.decode(raw), pa.binary())], schema=out)

    return source.mapInArrow(each, schema).withColumnRenamed("path", path)
