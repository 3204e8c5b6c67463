"""Toxicity of texts behind obfuscation: a noisy channel undoes leetspeak, spacing and repetition, then words count."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeline.llm import fitting, shared

# What a character may stand for.
LEET = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "+": "t",
        "|": "il", "€": "e"}
SEPARATORS = " .-_*"
MARKS = "!|+"  # may also stand behind a word as themselves
LETTERS = 27  # a to z without accents; 0 is any boundary
ORDER = 4
_BASE = str.maketrans("àáâãäåçèéêëìíîïñòóôõöøùúûüýÿ", "aaaaaaceeeeiiiinoooooouuuuyy")
_LATIN = [chr(i).lower().translate(_BASE) for i in range(256)]
_CODES = np.array([ord(c) - 96 if "a" <= c <= "z" else 0 for c in _LATIN], dtype=np.int64)
_LETTER = np.array([chr(i).isalpha() for i in range(256)])
_EURO = 0x80  # takes the place of the one leet symbol outside Latin-1
_LEET = np.array([chr(i) in LEET or i == _EURO for i in range(256)])
_LEET_DIGIT = np.array([chr(i) in LEET and chr(i).isdigit() for i in range(256)])
_DIGIT = np.array([chr(i).isdigit() for i in range(256)])
_SYMBOL = _LEET & ~_DIGIT
_SEPARATOR = np.array([chr(i) in SEPARATORS + "\n\t" for i in range(256)])
_SYMBOLS = re.escape("".join(c for c in LEET if not c.isdigit()))
_SINGLE = rf"(?:[^\W\d_]|[{re.escape(''.join(LEET))}])"
_SPACED = re.compile(rf"(?<![^\W_])(?:{_SINGLE}[{re.escape(SEPARATORS)}]{{1,2}}){{2,}}{_SINGLE}(?![^\W_])")
_MIXED = re.compile(rf"(?:[^\W_]|[{_SYMBOLS}])+")
_SHOUTED = re.compile(r"[^\W\d_](?=!!)")
_TAIL = re.compile("|".join(rf"[{re.escape(SEPARATORS)}]*{re.escape(c)}+$" for c in MARKS))
_GAP = re.compile(r"\s")
_WORD = re.compile(r"[^\W\d_]+")
_RUN = re.compile(r"([^\W\d_])\1\1")
CACHED = 100_000


def _bytes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("latin-1", "replace"), dtype=np.uint8)


def suspicious(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Places that could be obfuscated: inside or at the end of a word with leetspeak or a letter three times, and
    where three or more letters or leet characters, at least one of them a letter, stand alone. Places are characters
    of the text; plain texts have none and need no lattice. Words behind which two or more '!' stand are
    left to ``restore``, and runs without any letter are numbers or marks."""
    b = _bytes(text.replace("€", chr(_EURO)))
    none = np.empty(0, dtype=np.int64)
    if len(b) < 3:
        return none, none
    letter, leet, symbol = _LETTER[b], _LEET[b], _SYMBOL[b]
    mixed = leet[:-1] & letter[1:] | letter[:-1] & leet[1:]
    same = b[1:] == b[:-1]
    shout = same & (b[1:] == ord("!"))
    mixed[:-1] &= ~(letter[:-2] & shout[1:])
    mixed[1:] |= letter[2:] & same[1:] & same[:-1]
    word = letter | _DIGIT[b]
    alone = letter | leet  # without a letter or digit beside them, symbols also without another symbol
    alone[1:] &= ~(word[:-1] | symbol[1:] & symbol[:-1])
    alone[:-1] &= ~(word[1:] | symbol[:-1] & symbol[1:])
    at = np.flatnonzero(alone)
    if len(at) < 3:
        return np.flatnonzero(mixed), none
    near = at[1:] - at[:-1] <= 3
    run = np.concatenate([[0], np.cumsum(~near)])
    held = np.bincount(run, weights=letter[at]) > 0
    return np.flatnonzero(mixed), at[:-2][near[1:] & near[:-1] & held[run[:-2]]]


class LanguageModel:
    """Character four-grams of words, interpolated down to single characters. Of fixed size: 27 to the fourth."""

    def __init__(self, log: np.ndarray):
        self.log = log
        self.known: dict[str, str] = {}

    def restore(self, text: str) -> str:
        """The text with every obfuscated place in its likeliest reading; other places stay as they are."""
        mixed, alone = suspicious(text)
        if "!!" in text:
            mixed = np.union1d(mixed, [m.start() for m in _SHOUTED.finditer(text)]).astype(np.int64)
        if not len(mixed) and not len(alone):
            return text
        found: dict[int, str] = {}
        done = 0
        for at in alone.tolist():
            if at >= done and (m := _SPACED.match(text, at)):
                done = m.end()
                if any(c.isalpha() for c in m.group(0)):
                    found[at] = m.group(0)
        spans = [(a, a + len(t)) for a, t in found.items()]
        done = 0
        for at in mixed.tolist():
            if at < done:
                continue
            start = max(text.rfind(" ", 0, at), text.rfind("\n", 0, at), text.rfind("\t", 0, at)) + 1
            gap = _GAP.search(text, at + 1)
            done = gap.start() if gap else len(text)
            for m in _MIXED.finditer(text, start, done):
                t = m.group(0)
                odd = any(c in LEET for c in t) and any(c.isalpha() for c in t) or _RUN.search(t)
                if odd and not any(m.start() < e and s < m.end() for s, e in spans):
                    found[m.start()] = t
        out, last = [], 0
        for at in sorted(found):
            out += [text[last:at], self.reading(found[at])]
            last = at + len(found[at])
        return "".join([*out, text[last:]])

    def reading(self, found: str) -> str:
        if found not in self.known:
            if len(self.known) > CACHED:
                self.known.clear()
            tail = _TAIL.search(found)
            self.known[found] = self.decode(found, len(tail.group(0)) if tail else 0)
        return self.known[found]

    def decode(self, found: str, tail: int = 0) -> str:
        """Viterbi over the lattice of readings: a state is the last three characters, each character of the text
        is kept, replaced by what it may stand for, or left out (a separator, a repeated letter). Of the last ``tail``
        characters any number may stand behind the word as they are."""
        keep, swap, literal, drop = 0.0, math.log(0.3), math.log(0.2), math.log(0.5)
        low = found.lower()
        log, size = self.log, LETTERS ** (ORDER - 1)
        best: dict[int, tuple[float, tuple | None]] = {0: (0.0, None)}
        ends: list[tuple[float, tuple | None, str]] = []
        finish = lambda left: ends.append((*max(((s + float(log[state * LETTERS]) + literal * left, t) for state, (s, t) in best.items()),
                                                key=lambda x: x[0]), found[len(found) - left :]))
        for i, (c, shown) in enumerate(zip(low, found)):
            if i and len(found) - i <= tail:
                finish(len(found) - i)
            code = _code(c)
            moves: list[tuple[int, str, float]] = []
            if c in LEET:
                moves = [(ord(x) - 96, x, swap) for x in LEET[c]] + [(0, shown, literal)]
            elif code or c.isalpha():
                moves = [(code, shown, keep)]
            else:
                moves = [(0, shown, literal)]
            skip = i > 0 and (c == low[i - 1] and c.isalpha() or c in SEPARATORS)
            after: dict[int, tuple[float, tuple | None]] = {}
            for state, (score, trail) in best.items():
                for to, text, cost in moves:
                    # at the start and behind a boundary there is nothing to expect
                    s = score + cost + float(log[state * LETTERS + to])
                    key = 0 if to == 0 else (state * LETTERS + to) % size
                    if key not in after or s > after[key][0]:
                        after[key] = (s, (trail, text))
                if skip and (state not in after or score + drop > after[state][0]):
                    after[state] = (score + drop, trail)
            best = after
        finish(0)
        _, trail, rest = max(ends, key=lambda x: x[0])
        out = [rest]
        while trail:
            trail, text = trail
            out.append(text)
        return "".join(reversed(out))


def _code(c: str) -> int:
    c = c.translate(_BASE)
    return ord(c) - 96 if "a" <= c <= "z" and len(c) == 1 else 0


def count_grams(text: str, total: np.ndarray) -> None:
    """Adds the four-grams of the words of a text. A boundary hides what stands before it."""
    code = np.concatenate([[0, 0, 0], _CODES[_bytes(text)], [0]])
    a, b, c, d = code[:-3], code[1:-2], code[2:-1], code[3:]
    b = np.where(c == 0, 0, b)
    a = np.where(b == 0, 0, a)
    use = (c > 0) | (d > 0)
    gram = (((a * LETTERS + b) * LETTERS + c) * LETTERS + d)[use]
    total += np.bincount(gram, minlength=len(total))


def log_probabilities(counts: np.ndarray, weight: float = 4.0) -> np.ndarray:
    """Of each last character given the three before it, each order drawn towards the next shorter one."""
    grams = counts.reshape((LETTERS,) * ORDER)
    p = np.full(LETTERS, 1.0 / LETTERS)
    for left in range(ORDER - 1, -1, -1):
        n = grams.sum(axis=tuple(range(left)))
        p = (n + weight * p) / (n.sum(axis=-1, keepdims=True) + weight)
    return np.log(p).ravel().astype(np.float32)


def language_model(texts: DataFrame) -> LanguageModel:
    """From all texts of a one-column table; NULL counts as empty."""

    def add(total, batch):
        for part in shared.chunks([batch], 200):
            count_grams("\n".join(shared.texts(part.column(0))), total)

    return LanguageModel(fitting.partition_sums(texts, LETTERS**ORDER, add, log_probabilities))


def features(text: str) -> set[str]:
    """The distinct words of a restored text and their beginnings of three to six letters."""
    words = set(_WORD.findall(text.lower()))
    found = {w + "." for w in words}
    for n in (3, 4, 5, 6):
        found.update(w[:n] for w in words if len(w) >= n)
    return found


class ToxicityModel:
    def __init__(self, language: LanguageModel, weights: dict[str, float], bins: int = 400):
        self.language, self.weights = language, weights
        self.starts = {k[:3] for k in weights}
        self.edges, self.rates = np.linspace(-1, 12, bins - 1), np.full(bins, 0.5)

    def raw(self, text: str) -> float:
        """Strongest evidence, and a little for further evidence."""
        words = set(_WORD.findall(self.language.restore(text).lower()))
        found = []
        for w in words:
            if w[:3] in self.starts or (w + ".")[:3] in self.starts:
                here = [self.weights.get(k, 0.0) for k in (w + ".", w[:3], w[:4], w[:5], w[:6])]
                found.append(max(here))
        best = max(found, default=0.0)
        return best + 0.25 * math.log1p(max(0.0, sum(found) - best))

    def bins(self, raw: np.ndarray) -> np.ndarray:
        return np.clip(np.searchsorted(self.edges, raw), 0, len(self.rates) - 1)

    def score(self, raw: np.ndarray) -> np.ndarray:
        return np.clip(0.999 * self.rates[self.bins(raw)] + 0.001 / (1 + np.exp(-raw)), 0, 1)


def fit_toxicity(examples: DataFrame, language: LanguageModel, dictionary: int = 100_000, least: int = 3) -> ToxicityModel:
    """Fit on (path, doc, toxic 0/1).

    Evidence is a word or word beginning of the restored text: the ``dictionary`` commonest ones that at least
    ``least`` toxic texts have. Its weight is the lower end of its log-odds of being in a toxic text, so rare evidence
    weighs little. Four fifths of the rows give the weights, the others the rate by score.
    """
    rows = examples.select("doc", "toxic", (F.pmod(F.xxhash64(F.col("path").cast("string")), F.lit(5)) == 0).alias("kept_back"))
    fit = rows.where("NOT kept_back")

    def evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in shared.chunks(batches, 200):
            found = [k for t in shared.texts(batch.column(0)) for k in features(language.restore(t))]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], names=["k"])

    counted = fit.where("toxic = 1").select("doc").mapInArrow(evidence, "k string").groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    common = fitting.commonest(shared.written(counted.where(F.col("n") >= least), "evidence"), "k", "n", dictionary)
    place = {k: i for i, k in enumerate(sorted(common))}
    starts = {k[:3] for k in place}
    n = len(place)

    def tally(total, batch):
        toxic = batch.column(1).to_pylist()
        for text, label in zip(shared.texts(batch.column(0)), toxic):
            words = set(_WORD.findall(language.restore(text).lower()))
            kept = {k for w in words if w[:3] in starts or (w + ".")[:3] in starts for k in (w + ".", w[:3], w[:4], w[:5], w[:6])}
            at = 0 if label else n + 1
            total[at] += 1
            for k in kept:
                if k in place:
                    total[at + 1 + place[k]] += 1

    sums = fitting.partition_sums(fit, 2 * (n + 1), tally)
    bad, good = sums[: n + 1] + 0.5, sums[n + 1 :] + 0.5
    odds = np.log(bad[1:] / (bad[0] + 0.5)) - np.log(good[1:] / (good[0] + 0.5)) - 2 * np.sqrt(1 / bad[1:] + 1 / good[1:])
    model = ToxicityModel(language, {k: float(odds[i]) for k, i in place.items() if odds[i] > 0.25})
    bins = len(model.rates)

    def by_bin(total, batch):
        raw = np.array([model.raw(t) for t in shared.texts(batch.column(0))])
        at = model.bins(raw)
        y = batch.column(1).to_numpy(zero_copy_only=False).astype(float)
        total[:bins] += np.bincount(at, weights=y, minlength=bins)
        total[bins:] += np.bincount(at, minlength=bins)

    sums = fitting.partition_sums(rows.where("kept_back"), 2 * bins, by_bin)
    model.rates = fitting.isotonic(sums[:bins], sums[bins:])
    return model


def toxicity_model(documents: DataFrame, labels: DataFrame, learn: Column | None = None, path: str = "path", doc: str = "doc",
                   toxic: str = "toxic", fit_rows: int = 60_000) -> ToxicityModel:
    """The model of :func:`toxicity_scores`: a language model of all texts, weights from the labelled ones."""
    source = documents.select(F.col(path).alias("path"), F.col(doc).alias("doc"))
    known = labels.select(F.col(path).alias("path"), F.col(toxic).cast("double").alias("toxic"))
    known = fitting.known_labels(known if learn is None else known.where(learn), "toxic", fit_rows)
    language = language_model(source.select("doc"))
    learned = source.join(F.broadcast(known), "path")  # about fit_rows short rows at most
    return fit_toxicity(shared.written(learned, "examples"), language)


def toxicity_scores(documents: DataFrame, labels: DataFrame, learn: Column | None = None, path: str = "path", doc: str = "doc",
                    toxic: str = "toxic", fit_rows: int = 60_000) -> DataFrame:
    """(``path``, score) of every text, such as run documents or event notes: how likely it is toxic.

    The character language model comes from all texts. ``labels`` has ``path`` and ``toxic`` (0/1) for some of them; only
    labels where ``learn`` (a condition on the path, default all) holds are learned from, and of those about
    ``fit_rows`` by the hash of the path, which bounds the work of fitting. Every text is scored whole.
    NULL and empty texts score like texts without evidence; a repeated row is scored each time; labels that name a path
    twice count once, by their mean; NULL paths and labels are not learned from; without usable labels every
    score is about 0.5. An empty table gives no rows. Other columns are ignored.
    """
    model = toxicity_model(documents, labels, learn, path, doc, toxic, fit_rows)
    source = documents.select(F.col(path).alias("path"), F.col(doc).alias("doc"))
    schema = T.StructType([source.schema["path"], T.StructField("score", T.DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = shared.arrow_schema(schema)
        for batch in shared.chunks(batches):
            found = model.score(np.array([model.raw(t) for t in shared.texts(batch.column(1))]))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(out.types[0]), pa.array(found)], schema=out)

    return source.mapInArrow(score, schema).withColumnRenamed("path", path)


def clean_documents(documents: DataFrame, labels: DataFrame, learn: Column | None = None, path: str = "path", doc: str = "doc",
                    toxic: str = "toxic", below: float = 0.5) -> DataFrame:
    """The rows of ``documents`` with a score under ``below`` in :func:`toxicity_scores`, all columns kept."""
    model = toxicity_model(documents, labels, learn, path, doc, toxic)
    return shared.kept_rows(documents, doc, lambda texts: model.score(np.array([model.raw(t) for t in texts])) < below)
