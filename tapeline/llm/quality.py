"""Quality of run documents: random Fourier features over document statistics, ridge scores, isotonic rates."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeline.llm import fitting, shared

STATISTICS = (
    "chars", "words", "word_length", "word_length_spread", "distinct_words", "repeats_last", "top_word", "short_words",
    "repeated_pairs", "repeated_triples", "lines", "distinct_lines", "line_words", "lower", "upper", "digits", "space",
    "sentence_marks", "symbols", "beyond_latin", "upper_words", "symbol_words", "long_words", "entropy", "packed",
)
_CLASSES = np.full(256, 6, dtype=np.uint8)  # 0 lower, 1 upper, 2 digit, 3 space, 4 sentence mark, 5 replaced, 6 symbol
for _i in range(256):
    _c = chr(_i)
    _CLASSES[_i] = 0 if _c.islower() else 1 if _c.isupper() else 2 if _c.isdigit() else 3 if _c.isspace() else 4 if _c in ".,;:'\"()-" else 6
_CLASSES[0] = 5
_SYMBOLS = frozenset("!#$%&*+/<=>@[]\\^_`{|}~?")


def statistics(text: str) -> list[float]:
    """The entries of ``STATISTICS`` for one whole text; all zero for an empty one."""
    if not text:
        return [0.0] * len(STATISTICS)
    raw = text.replace("\0", " ").encode("latin-1", "replace") if text.isascii() else text.replace("\0", " ").encode("latin-1", "ignore")
    n = len(text)
    counts = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    kinds = np.bincount(_CLASSES, weights=counts, minlength=7) / n
    share = counts[counts > 0] / max(1, len(raw))
    words = text.split()
    w = max(1, len(words))
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) if words else np.zeros(1)
    often = Counter(words)
    pairs = list(zip(words, words[1:]))
    lines = [x for x in text.split("\n") if x]
    triples = len(set(zip(words, words[1:], words[2:])))
    return [
        np.log1p(n), np.log1p(len(words)), lengths.mean(), lengths.std(), np.log1p(len(often)) / np.log1p(w),
        sum(a == b for a, b in pairs) / w, max(often.values(), default=0) / w, float((lengths <= 3).mean()),
        1 - len(set(pairs)) / max(1, len(pairs)), 1 - triples / max(1, len(words) - 2), np.log1p(len(lines)),
        len(set(lines)) / max(1, len(lines)), np.log1p(w / max(1, len(lines))), *kinds[:5], kinds[6],
        1 - len(raw) / n, sum(map(str.isupper, words)) / w, sum(x[-1] in _SYMBOLS for x in words) / w,
        float((lengths > 12).mean()), float(-(share * np.log(share)).sum()), np.log(len(zlib.compress(raw, 1)) / max(1, len(raw)) + 1e-3),
    ]


def document_statistics(documents: DataFrame, doc: str = "doc") -> DataFrame:
    """``documents`` with an array ``statistics`` in place of ``doc``; NULL counts as empty."""
    names = documents.columns
    at = names.index(doc)
    others = [f for f in documents.schema.fields if f.name != doc]
    schema = T.StructType([*others, T.StructField("statistics", T.ArrayType(T.DoubleType()))])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = shared.arrow_schema(schema)
        for batch in shared.chunks(batches):
            rows = pa.array([statistics(t) for t in shared.texts(batch.column(at))], out.types[-1])
            kept = [batch.column(i) for i in range(len(names)) if i != at]
            yield pa.RecordBatch.from_arrays([*[c.cast(t) for c, t in zip(kept, out.types)], rows], schema=out)

    return documents.mapInArrow(measure, schema)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


class QualityModel:
    """Scores in 0..1 from statistics. Its size depends on the parameters only."""

    def __init__(self, mean, spread, directions, shifts, weights, edges, rates):
        self.mean, self.spread, self.directions, self.shifts = mean, spread, directions, shifts
        self.weights, self.edges, self.rates = weights, edges, rates

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -6, 6)
        waves = np.cos(z @ self.directions + self.shifts) * np.sqrt(2 / len(self.shifts))
        return np.hstack([waves, z / np.sqrt(z.shape[1]), np.ones((len(z), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.searchsorted(self.edges, self.raw(x)), 0, len(self.rates) - 1)

    def score(self, x: np.ndarray) -> np.ndarray:
        """The isotonic rate, with a trace of the ridge score so that equal rates stay ordered."""
        raw = self.raw(x)
        rates = self.rates[np.clip(np.searchsorted(self.edges, raw), 0, len(self.rates) - 1)]
        return np.clip(0.999 * rates + 0.001 * np.clip(raw, 0, 1), 0, 1)


def fit_quality(examples: DataFrame, waves: int = 256, width: float = 4.0, ridge: float = 1e-3, bins: int = 400,
                seed: int = 7) -> QualityModel:
    """Fit on (path, statistics, accepted 0/1). NULL labels do not take part; without labels the score is 0.5.

    Three passes of partition sums over the labelled statistics: mean and spread; normal equations of the random
    Fourier features (of a Gaussian kernel of the given width) on four fifths of the rows; counts by score bin on
    the other fifth for the isotonic rates. The split is by the hash of the path.
    """
    d = len(STATISTICS)
    rows = examples.where("accepted IS NOT NULL AND path IS NOT NULL").select(
        "statistics", F.col("accepted").cast("double").alias("accepted"),
        (F.pmod(F.xxhash64(F.col("path").cast("string")), F.lit(5)) == 0).alias("kept_back"),
    )

    def moments(total, batch):
        x = _matrix(batch.column(0))
        total[0] += len(x)
        total[1 : d + 1] += x.sum(0)
        total[d + 1 :] += (x * x).sum(0)

    sums = fitting.partition_sums(rows, 2 * d + 1, moments)
    n = max(1.0, sums[0])
    mean = sums[1 : d + 1] / n
    spread = np.sqrt(np.maximum(sums[d + 1 :] / n - mean**2, 1e-8))
    rng = np.random.default_rng(seed)
    size = waves + d + 1
    model = QualityModel(mean, spread, rng.normal(0, 1 / width, (d, waves)), rng.uniform(0, 2 * np.pi, waves),
                         np.zeros(size), np.linspace(-0.25, 1.25, bins - 1), np.full(bins, 0.5))

    def normal(total, batch):
        use = ~batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
        phi = model.features(_matrix(batch.column(0))[use])
        y = batch.column(1).to_numpy(zero_copy_only=False)[use]
        total[: size * size] += (phi.T @ phi).ravel()
        total[size * size :] += phi.T @ y

    sums = fitting.partition_sums(rows, size * (size + 1), normal)
    gram, moment = sums[: size * size].reshape(size, size), sums[size * size :]
    model.weights = np.linalg.solve(gram + ridge * max(1.0, n) / size * np.eye(size), moment)

    def by_bin(total, batch):
        use = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
        at = model.bins(_matrix(batch.column(0))[use])
        y = batch.column(1).to_numpy(zero_copy_only=False)[use]
        total[:bins] += np.bincount(at, weights=y, minlength=bins)
        total[bins:] += np.bincount(at, minlength=bins)

    sums = fitting.partition_sums(rows, 2 * bins, by_bin)
    model.rates = fitting.isotonic(sums[:bins], sums[bins:])
    return model


def quality_model(documents: DataFrame, labels: DataFrame, learn: Column | None = None, path: str = "path", doc: str = "doc",
                  accepted: str = "accepted", fit_rows: int = 60_000) -> QualityModel:
    """The model of :func:`quality_scores`, fitted on the statistics of the labelled documents."""
    known = labels.select(F.col(path).alias("path"), F.col(accepted).cast("double").alias("accepted"))
    known = fitting.known_labels(known if learn is None else known.where(learn), "accepted", fit_rows)
    source = documents.select(F.col(path).alias("path"), F.col(doc).alias("doc"))
    labelled = source.join(F.broadcast(known), "path")  # about fit_rows short rows at most
    return fit_quality(shared.written(document_statistics(labelled), "statistics"))


def quality_scores(documents: DataFrame, labels: DataFrame, learn: Column | None = None, path: str = "path", doc: str = "doc",
                   accepted: str = "accepted", fit_rows: int = 60_000) -> DataFrame:
    """(``path``, score) of every run document: how likely reviewers accept it, from its text alone.

    ``labels`` has ``path`` and ``accepted`` (0/1) for some documents; only labels where ``learn`` (a condition on the
    path, default all) holds are learned from, and of those about ``fit_rows`` by the hash of the path. Labels that
    name a path twice count once, by their mean. Every document is scored in one pass over its whole text.
    NULL and empty documents are scored by the model like any other; a repeated row is scored each time; a NULL
    path is scored and never learned from; without usable labels every score is about 0.5. An empty table gives no
    rows. Other columns are ignored.
    """
    model = quality_model(documents, labels, learn, path, doc, accepted, fit_rows)
    source = documents.select(F.col(path).alias("path"), F.col(doc).alias("doc"))
    schema = T.StructType([source.schema["path"], T.StructField("score", T.DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = shared.arrow_schema(schema)
        for batch in shared.chunks(batches):
            found = model.score(np.array([statistics(t) for t in shared.texts(batch.column(1))]))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(out.types[0]), pa.array(found)], schema=out)

    return source.mapInArrow(score, schema).withColumnRenamed("path", path)


def accepted_documents(documents: DataFrame, labels: DataFrame, learn: Column | None = None, path: str = "path", doc: str = "doc",
                       accepted: str = "accepted", least: float = 0.7) -> DataFrame:
    """The rows of ``documents`` with a score of ``least`` or more in :func:`quality_scores`, all columns kept."""
    model = quality_model(documents, labels, learn, path, doc, accepted)
    return shared.kept_rows(documents, doc, lambda texts: model.score(np.array([statistics(t) for t in texts])) >= least)
