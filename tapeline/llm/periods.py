"""Periodic stretches of words in run documents, found by seeds on diagonals that are extended once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeline.llm import shared

LEAST_WORDS, LEAST_PERIODS = 6, 4  # a run of period q has at least max(6, 4 q) words
BATCH_CHARS = 8_000_000
RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])


def least_length(period: int) -> int:
    return max(LEAST_WORDS, LEAST_PERIODS * period)


def gram_levels(longest: int) -> Iterator[tuple[int, int]]:
    """(first, last) period of each level, for documents of up to ``longest`` words; grams of a level have ``last`` words.

    A run of period q repeats at lag q over at least ``least_length(q) - q`` words, so every gram of that many words
    at the start of the run occurs again q words later: the smallest such overlap of a level is its gram. As a gram of a
    level is no shorter than the level's periods, and the root of a run is no power of a shorter word, the gram
    cannot occur in between. Neighbouring occurrences are therefore all the pairs there are to look at.
    """
    first = 1
    while least_length(first) <= longest:
        last = least_length(first) - first
        yield first, last
        first = last + 1


def word_numbers(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """All words of some texts, their numbers with a mark of its own before and behind each text, and the place of the
    first word and of the end of each text among the numbers."""
    import pandas as pd

    split = [t.split() for t in texts]  # bytes split at exactly 0x20 and 0x09-0x0D
    words = [w for s in split for w in s]
    sizes = np.array([len(s) for s in split], dtype=np.int64)
    codes = pd.factorize(np.array(words, dtype=object))[0].astype(np.int64) if words else np.empty(0, np.int64)
    begin = np.cumsum(sizes) - sizes + np.arange(1, len(sizes) + 1)
    numbers = -1 - np.arange(len(words) + len(sizes) + 1, dtype=np.int64)  # marks are all different
    inside = np.ones(len(numbers), dtype=bool)
    inside[0] = False
    inside[begin + sizes] = False
    numbers[inside] = codes
    return words, numbers, begin, begin + sizes


class Grams:
    """Names of the grams of a growing length that occur at least twice in their document, by place."""

    def __init__(self, numbers: np.ndarray, document: np.ndarray):
        self.length = 1
        self.name = np.full(len(numbers), -1, dtype=np.int64)
        at = np.flatnonzero(numbers >= 0)
        self._keep(at, numbers[at] * (document[-1] + 1 if len(document) else 1) + document[at])

    def _keep(self, at: np.ndarray, key: np.ndarray) -> None:
        import pandas as pd

        code = pd.factorize(key)[0]
        twice = np.bincount(code)[code] >= 2 if len(code) else np.empty(0, dtype=bool)
        self.name[self.at if hasattr(self, "at") else at] = -1
        self.at = at[twice]
        self.name[self.at] = code[twice]

    def grow(self, length: int) -> None:
        """Longer grams are pairs of shorter ones, whose places overlap where the length is not doubled."""
        while self.length < length and len(self.at):
            step = min(self.length, length - self.length)
            at = self.at[self.at + step < len(self.name)]
            at = at[self.name[at + step] >= 0]
            self._keep(at, self.name[at] * (self.name.max() + 1) + self.name[at + step])
            self.length += step

    def neighbours(self) -> tuple[np.ndarray, np.ndarray]:
        """(place, lag) of each gram and its next occurrence in the document."""
        order = self.at[np.argsort(self.name[self.at], kind="stable")]
        same = self.name[order[1:]] == self.name[order[:-1]]
        return order[:-1][same], (order[1:] - order[:-1])[same]


def reach(left: np.ndarray, right: np.ndarray) -> int:
    """For how many places two stretches agree from their start on; looks at ever longer pieces."""
    done, step = 0, 32
    while done < len(left):
        differ = np.flatnonzero(left[done : done + step] != right[done : done + step])
        if len(differ):
            return done + int(differ[0])
        done, step = done + step, step * 2
    return len(left)


def runs_of(numbers: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place, length and period of every run among the numbers of ``word_numbers``, ordered by place, then period."""
    document = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(numbers))))
    document = np.concatenate([np.zeros(len(numbers) - len(document), dtype=np.int64), document])
    grams = Grams(numbers, document)
    found: list[tuple[int, int, int]] = []
    for first, last in gram_levels(int((end - begin).max(initial=0))):
        grams.grow(last)
        if not len(grams.at):
            break
        at, lag = grams.neighbours()
        near = (first <= lag) & (lag <= last)
        at, lag = at[near], lag[near]
        order = np.lexsort((at, lag))
        covered: dict[int, int] = {}  # how far each lag is already extended: a seed before that lies in a known run
        for i, q in zip(at[order].tolist(), lag[order].tolist()):
            if i < covered.get(q, 0):
                continue
            left = i - reach(numbers[:i][::-1], numbers[q : i + q][::-1])
            right = i + reach(numbers[i : len(numbers) - q], numbers[i + q :])
            covered[q] = right
            if right - left + q >= least_length(q):
                found.append((left, right - left + q, q))
    found.sort(key=lambda r: (r[0], r[2]))
    place, length, period = (np.array(c, dtype=np.int64) for c in zip(*found)) if found else [np.empty(0, np.int64)] * 3
    return place, length, period


def periodic_runs(documents: DataFrame, path: str = "path", doc: str = "doc") -> DataFrame:
    """Periodic runs of every run document or log text (``path``, ``doc``), and the text with each run cut to one period.

    A progress log or evidence text that a retrying step wrote over and over holds the same few words in turn. A run
    is a stretch of consecutive words whose smallest period is q, at least ``max(6, 4 q)`` words long, that no
    neighbouring word extends with that period. Words are separated by U+0020 and U+0009 to U+000D and compared byte by
    byte. One row per document: ``path``, n_words, runs (array of start, length, period in words from 0, ordered by start,
    then period) and collapsed: the words that stand in the first period of every run that holds them, joined by
    one space.

    Seeds are grams of the smallest overlap that a run guarantees, found per document by naming ever longer grams; pairs
    of neighbouring occurrences are extended along their diagonal unless the table of that lag already
    reaches beyond them. Nothing is shuffled; a task holds a few million characters or one document.

    NULL, empty and blank documents have no words, no runs and an empty text. A NULL path and repeated rows are kept,
    each with its own row. An empty table gives no rows. Other columns are ignored, so their names cannot clash.
    """
    source = documents.select(F.col(path).alias("path"), F.col(doc).alias("doc"))
    schema = T.StructType([
        source.schema["path"], T.StructField("n_words", T.LongType()),
        T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType()),
    ])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = shared.arrow_schema(schema)
        for batch in shared.sized_chunks(batches, 1, BATCH_CHARS):
            words, numbers, begin, end = word_numbers([t.encode() for t in shared.texts(batch.column(1))])
            place, length, period = runs_of(numbers, begin, end)
            of = np.searchsorted(begin, place, side="right") - 1
            dropped = np.zeros(len(numbers) + 1, dtype=np.int64)
            np.add.at(dropped, place + period, 1)
            np.add.at(dropped, place + length, -1)
            stays = np.cumsum(dropped[:-1]) == 0
            texts = []
            for i, (a, b) in enumerate(zip(begin.tolist(), end.tolist())):
                own = words[a - 1 - i : b - 1 - i]
                keep = stays[a:b]
                texts.append(b" ".join(own if keep.all() else [w for w, k in zip(own, keep.tolist()) if k]))
            offsets = np.searchsorted(of, np.arange(len(begin) + 1)).astype(np.int32)
            runs = pa.StructArray.from_arrays([pa.array(place - begin[of]), pa.array(length), pa.array(period)], fields=list(out.types[2].value_type))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).cast(out.types[0]), pa.array(end - begin),
                pa.ListArray.from_arrays(pa.array(offsets), runs).cast(out.types[2]), pa.array(texts, pa.binary()).cast(pa.string()),
            ], schema=out)

    return source.mapInArrow(each, schema).withColumnRenamed("path", path)
