"""BPE of run documents by fragments: words are cut where no token of the vocabulary could cross, fragments encoded alone."""

from __future__ import annotations

import heapq
import json
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeline.llm import shared
from tapeline.llm.packing import byte_text

KNOWN = 300_000  # words, and fragments, in the younger half of what a worker remembers
LONG_WORD = 64  # bytes from which a word or fragment is not remembered
SHORT = 48  # symbols up to which all pairs are looked at in each step
BATCH_CHARS = 4_000_000
#: The characters that count as white space, and the contractions of the tokenizer's pattern.
SPACES = r"\t-\r \x85\xa0  -     　"
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
_codecs: dict[str, "Codec"] = {}


def ranges(points: list[int]) -> str:
    """Code points in ascending order as the inside of a character class."""
    at = np.array(points)
    first = np.flatnonzero(np.diff(at, prepend=-2) > 1)
    last = np.append(first[1:], len(at)) - 1
    return "".join(f"{chr(a)}-{chr(b)}" for a, b in zip(at[first].tolist(), at[last].tolist()))


@cache
def character_classes() -> list[tuple[str, str, str]]:
    """(last character, letters, numbers): insides of character classes up to that character, from the smallest. The fewer
    ranges a class has, the faster a pattern is."""
    kinds = [unicodedata.category(chr(point))[0] for point in range(sys.maxunicode + 1)]
    return [(chr(end), *(ranges([p for p in range(end + 1) if kinds[p] == kind]) for kind in "LN")) for end in (0x7F, 0xFFFF, sys.maxunicode)]


@cache
def word_patterns() -> list[tuple[str, re.Pattern]]:
    """(last character, pattern) for texts of characters up to that one. Words are contractions, runs of letters, single
    numbers, and runs of anything else but white space."""
    return [
        (end, re.compile(f"{CONTRACTIONS}|[{letters}]+|[{numbers}]|[^{SPACES}{letters}{numbers}]+"))
        for end, letters, numbers in character_classes()
    ]


def unsettled(char: str) -> bool:
    """Whether tables of other Unicode versions may disagree: unassigned characters, marks and composed ones after version 3.2."""
    kind = unicodedata.category(char)
    later = unicodedata.ucd_3_2_0.category(char) == "Cn"
    return kind == "Cn" or (later and (kind[0] == "M" or unicodedata.decomposition(char) != ""))


def lowered(text: str) -> str:
    """Composed (NFC), each character in lower case by itself: a capital sigma at a word's end is no exception."""
    if text.isascii():
        return text.lower()
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


class Memory:
    """Values by key in two generations: when the younger is full it becomes the older, and what is used again comes back."""

    def __init__(self, limit: int):
        self.limit, self.young, self.old = limit, {}, {}

    def missing(self, keys: set) -> list:
        """The keys without a value; all others are in ``young`` afterwards."""
        new = keys.difference(self.young)
        back = {k for k in new if k in self.old}
        self.young.update((k, self.old[k]) for k in back)
        return list(new - back)

    def age(self, passing: list) -> None:
        for key in passing:
            del self.young[key]
        if len(self.young) > self.limit:
            self.old, self.young = self.young, {}


class Codec:
    """Vocabulary, merges and special tokens of a tokenizer file whose words end in a suffix."""

    def __init__(self, file: str):
        with open(file, encoding="utf-8") as opened:
            given = json.load(opened)
        model, self.suffix = given["model"], given["model"]["end_of_word_suffix"]
        vocab = model["vocab"]
        special = {t["content"]: t["id"] for t in given["added_tokens"]}
        self.special = {content: np.int32(i).tobytes() for content, i in special.items()}
        self.parts = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")").split
        self.patterns, self.file, self.library = word_patterns(), file, None
        self.settled: set[str] = set()
        self.text = [""] * (1 + max([*vocab.values(), *special.values()]))
        for token, i in [*vocab.items(), *special.items()]:
            self.text[i] = token
        printed = {byte_text(token)[0]: token for token in vocab if len(token) == 1}
        # symbols 0 to 255 are bytes inside a word, 256 to 511 the same bytes as the last of a word
        self.symbol_id = [vocab[printed[b]] for b in range(256)] + [vocab[printed[b] + self.suffix] for b in range(256)]
        self.crossed = np.zeros((512, 512), dtype=bool)
        for token in vocab:
            ended = token.endswith(self.suffix) and len(token) > len(self.suffix)
            symbols = list(byte_text(token.removesuffix(self.suffix) if ended else token))
            symbols[-1] += 256 * ended
            self.crossed[symbols[:-1], symbols[1:]] = True
        self.merges = {
            vocab[a] << 32 | vocab[b]: rank << 32 | vocab[a + b] for rank, (a, b) in enumerate(map(tuple, model["merges"]))
        }
        self.words, self.fragments = Memory(KNOWN), Memory(KNOWN)

    def split(self, text: str) -> list[str]:
        """The words of a text; where Unicode versions may disagree, as the tokenizers library normalizes and splits."""
        if text.isascii():
            return self.patterns[0][1].findall(text.lower())
        chars = set(text)
        self.settled.update(c for c in chars - self.settled if not unsettled(c))
        if chars <= self.settled:
            text = lowered(text)
            last = max(text)
            return next(p for end, p in self.patterns if last <= end).findall(text)
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.file)
        words = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return [byte_text(w).decode() for w, _ in words]

    def merged(self, ids: list[int]) -> list[int]:
        """The leftmost pair of smallest rank is contracted until none is left."""
        if len(ids) > SHORT:
            return self._merged_long(ids)
        merge_of, none = self.merges.get, 1 << 62
        pairs = [merge_of(a << 32 | b, none) for a, b in zip(ids, ids[1:])]
        while pairs and (best := min(pairs)) != none:
            at = pairs.index(best)
            token = best & 0xFFFFFFFF
            ids[at : at + 2] = [token]
            del pairs[at]
            if at:
                pairs[at - 1] = merge_of(ids[at - 1] << 32 | token, none)
            if at < len(pairs):
                pairs[at] = merge_of(token << 32 | ids[at + 1], none)
        return ids

    def _merged_long(self, ids: list[int]) -> list[int]:
        """The same with a queue of pairs, for fragments of any length."""
        merges, n = self.merges, len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [(m >> 32, i, m & 0xFFFFFFFF, ids[i], ids[i + 1]) for i in range(n - 1) if (m := merges.get(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(queue)
        while queue:
            _, i, token, a, b = heapq.heappop(queue)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue  # one of the two has been contracted meanwhile
            ids[i], ids[j], after[i] = token, -1, after[j]
            if after[i] < n:
                before[after[i]] = i
            for x in (before[i], i):
                y = after[x] if x >= 0 else n
                if y < n and (m := merges.get(ids[x] << 32 | ids[y])) is not None:
                    heapq.heappush(queue, (m >> 32, x, m & 0xFFFFFFFF, ids[x], ids[y]))
        return [i for i in ids if i >= 0]

    def cut(self, words: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """Fragments of the words in order, whether each ends its word, and each word's number of fragments."""
        joined = b"".join(words)
        symbols = np.frombuffer(joined, dtype=np.uint8).astype(np.int64)
        ends = np.cumsum([len(w) for w in words])
        symbols[ends - 1] += 256
        last = ~self.crossed[symbols, np.append(symbols[1:], 0)]
        last[ends - 1] = True
        stops = np.flatnonzero(last) + 1
        bounds = stops.tolist()
        return [joined[a:b] for a, b in zip([0, *bounds], bounds)], np.isin(stops, ends), np.diff(np.searchsorted(stops, ends, side="right"), prepend=0)

    def encode_words(self, words: list[str]) -> list[bytes]:
        """The ids of each word as little-endian 32-bit bytes."""
        fragments, ending, counts = self.cut([w.encode() for w in words])
        keys = list(zip(fragments, ending.tolist()))
        known = self.fragments
        fresh = known.missing(set(keys))
        for key in fresh:
            symbols = list(key[0])
            symbols[-1] += 256 * key[1]
            known.young[key] = array("i", self.merged([self.symbol_id[s] for s in symbols])).tobytes()
        raw = [known.young[k] for k in keys]
        known.age([k for k in fresh if len(k[0]) > LONG_WORD])
        stops = np.cumsum(counts).tolist()
        return [b"".join(raw[a:b]) if b - a > 1 else raw[a] for a, b in zip([0, *stops], stops)]

    def encode(self, texts: list[str]) -> list[bytes]:
        special, known, split = self.special, self.words, []
        for text in texts:
            words: list[str] = []
            for part in self.parts(text):  # special tokens are found in the text as it is
                words += [part] if part in special else self.split(part)
            split.append(words)
        new = known.missing(set().union(*split).difference(special))
        if new:
            known.young.update(zip(new, self.encode_words(new)))
        of = (known.young | special).__getitem__ if any(s in t for t in texts for s in special) else known.young.__getitem__
        out = [b"".join(map(of, words)) for words in split]
        known.age([w for w in new if len(w) > LONG_WORD])
        return out

    def decode(self, ids: list[bytes]) -> list[str]:
        """Tokens as the file spells them, special ones too, joined by one space: the file names no decoder."""
        of = self.text.__getitem__
        return [" ".join(map(of, np.frombuffer(x, dtype="<i4").tolist())) for x in ids]


def codec(file: str) -> Codec:
    if file not in _codecs:
        _codecs[file] = Codec(file)
    return _codecs[file]


def encode_by_fragments(documents: DataFrame, vocabulary_file: str, path: str = "path", doc: str = "doc", decode: bool = False) -> DataFrame:
    """(``path``, ids) of every run document (``path``, ``doc``), and with ``decode`` the text those ids decode to.

    The ids are those of the tokenizer file without added special tokens; strings of special tokens in a text
    become their ids. Texts are composed, lower-cased and split by the tokenizer's pattern. A word is cut between two bytes
    that stand next to each other in no token of the vocabulary (bytes that end a word count as symbols of
    their own): no merge can cross such a place, so the fragments are encoded independently and joined. A worker
    remembers a bounded number of words and fragments. Nothing is shuffled.

    NULL, empty and blank documents have no ids and decode to an empty text. A NULL path and repeated rows are kept; long
    fragments are merged by a queue. An empty table gives no rows. Other columns are ignored, so their names cannot clash.
    """
    source = documents.select(F.col(path).alias("path"), F.col(doc).alias("doc"))
    fields = [source.schema["path"], T.StructField("ids", T.ArrayType(T.IntegerType()))]
    schema = T.StructType(fields + [T.StructField("decoded", T.StringType())] * decode)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(vocabulary_file)
        out = shared.arrow_schema(schema)
        for batch in shared.sized_chunks(batches, 1, BATCH_CHARS):
            ids = own.encode(shared.texts(batch.column(1)))
            ends = np.cumsum([0] + [len(x) // 4 for x in ids]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), dtype="<i4")))
            columns = [batch.column(0).cast(out.types[0]), lists.cast(out.types[1])]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(own.decode(ids), pa.string())] * decode, schema=out)

    return source.mapInArrow(each, schema).withColumnRenamed("path", path)


def decode_ids(encoded: DataFrame, vocabulary_file: str, path: str = "path", ids: str = "ids") -> DataFrame:
    """(``path``, decoded text) of id sequences. NULL and empty sequences give an empty text; ids outside the vocabulary are left out."""
    source = encoded.select(F.col(path).alias("path"), F.col(ids).cast("array<int>").alias("ids"))
    schema = T.StructType([source.schema["path"], T.StructField("decoded", T.StringType())])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(vocabulary_file)
        out = shared.arrow_schema(schema)
        for batch in shared.chunks(batches, 500):
            known = [[i for i in x or [] if i is not None and 0 <= i < len(own.text) and own.text[i]] for x in batch.column(1).to_pylist()]
            texts = own.decode([np.array(x, dtype="<i4").tobytes() for x in known])
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(out.types[0]), pa.array(texts, pa.string())], schema=out)

    return source.mapInArrow(each, schema).withColumnRenamed("path", path)
