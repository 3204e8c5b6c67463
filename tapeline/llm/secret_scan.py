"""Secrets in run documents: candidates by form, a random forest on their features removes false positives."""

from __future__ import annotations

import hashlib
import math
import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeline.llm import fitting, shared

# Names of credentials, words of made-up values, forms that name their provider.
CREDENTIAL_WORDS = ("key", "token", "secret", "password", "passwd", "pwd", "credential", "auth", "bearer", "aws", "api")
PLACEHOLDER_WORDS = ("example", "sample", "dummy", "fake", "changeme", "placeholder", "test", "xxxx", "your", "demo", "fixture")
PROVIDER_FORMS = {
    "access_key": re.compile(r"A(?:KIA|SIA)[0-9A-Z]{16}"),
    "forge_token": re.compile(r"gh[pousr]_[A-Za-z0-9]{36}"),
    "chat_token": re.compile(r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    "signed_token": re.compile(r"eyJ[A-Za-z0-9_-]{8,}"),
    "live_key": re.compile(r"[sr]k_live_[A-Za-z0-9]{16,}"),
}
HINT = re.compile(r"[0-9:=]|-----BEGIN")  # what every form below needs
# A block of key material: ended, it holds nothing but lines of its alphabet and header lines; without an end it stops at
# the first line that is none, where only one shorter line, the last, may follow long ones.
_HEADER = r"(?:Proc-Type|DEK-Info|Comment|Version|Hash|Charset): [^\r\n\\]*"
_GAP = r"(?:[\s\"'`>#*|,+]|\\[nrt])+"
_BREAK = r"(?:[ \t]*(?:\r?\n|\\r\\n|\\n)[ \t>#*|]*)+"
_LINE_END = r"(?=[\"'`\\<]|[ \t]*(?:[\r\n]|\Z))"
KEY_HEAD = re.compile(r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----")
_ENDED = re.compile(rf"{_GAP}(?:(?:{_HEADER}|[A-Za-z0-9+/=]++){_GAP})*+-----END [A-Z ]{{0,30}}PRIVATE KEY-----")
_UNENDED = re.compile(
    rf"(?:{_BREAK}{_HEADER})*(?:{_BREAK}[A-Za-z0-9+/]{{16,}}={{0,2}}{_LINE_END})*(?:{_BREAK}[A-Za-z0-9+/]+={{0,2}}{_LINE_END})?"
    rf"|[ \t]+[A-Za-z0-9+/]{{16,}}={{0,2}}(?:[ \t]+[A-Za-z0-9+/]{{16,}}={{0,2}})*"
)
CANDIDATE = re.compile(
    r"(?P<assignment>(?<![A-Za-z0-9])(?i:[a-z_.-]*(?:key|token|secret|password|passwd|pwd|credential|auth)[a-z0-9_.-]*)"
    r"[\"']?\s{0,3}(?:=>|[:=])\s{0,3}[\"']?(?P<value>(?!-----BEGIN )[^\s\"',;]{6,}))"
    r"|(?P<token>[A-Za-z0-9+/_-]{12,}={0,2})"
)
_PLACEHOLDER = re.compile(rf"(?<![a-z0-9+/])(?:{'|'.join(PLACEHOLDER_WORDS)})")
NEIGHBOURS = 16
FEATURES = (
    "length", "digits", "upper", "lower", "marks", "turns", "entropy", "hexadecimal", "only_digits", "likelihood", "coverage",
    "assigned", "block", "mail", "checksum", "credential_near", "placeholder", "path_depth", "path_config", "path_example",
    *(f"near_{i}" for i in range(NEIGHBOURS)),
)
FINDING = "start long, length long, kind string, value string, features array<double>"


def key_blocks(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of every private key block of a text, and of the head alone where no key material follows."""
    for m in KEY_HEAD.finditer(text):
        end = _ENDED.match(text, m.end()) or _UNENDED.match(text, m.end())
        yield m.start(), end.end() if end else m.end()


def candidates(text: str) -> Iterator[tuple[int, int, str, str, bool]]:
    """(start, end, kind, value, assigned) of every place of a text that has the form of a secret, in the order of
    their starts. Key blocks hide nothing: places inside them are candidates of their own."""
    if not HINT.search(text):
        return
    blocks = list(key_blocks(text))[::-1]
    for m in CANDIDATE.finditer(text):
        value = m.group("value") or m.group(0)
        start = m.start("value") if m.group("value") else m.start()
        while blocks and blocks[-1][0] <= start:
            s, e = blocks.pop()
            yield s, e, "private_key", text[s:e], False
        assigned = m.group("value") is not None
        value = value.rstrip(".)]}>!?:")
        if not assigned and not any(c.isdigit() for c in value):
            continue
        if len(value) >= 6:
            kind = "assignment" if assigned else "token"
            named = next((k for k, form in PROVIDER_FORMS.items() if form.fullmatch(value)), kind)
            yield start, start + len(value), named, value, assigned
    for s, e in reversed(blocks):
        yield s, e, "private_key", text[s:e], False


def passes_checksum(digits: str) -> bool:
    """Whether a digit string ends in the check digit of payment cards."""
    total = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(map(int, reversed(digits))))
    return len(digits) >= 12 and total % 10 == 0


class Lexicon:
    """The commonest words of the corpus: their letters' transitions and how much of a value they cover."""

    def __init__(self, counts: dict[str, int]):
        self.words = set(counts)
        pairs = np.ones((27, 27))
        for word, n in counts.items():
            codes = [0, *(ord(c) - 96 if "a" <= c <= "z" else 0 for c in word), 0]
            for a, b in zip(codes, codes[1:]):
                pairs[a, b] += n
        self.log = np.log(pairs / pairs.sum(1, keepdims=True))

    def likelihood(self, value: str) -> float:
        codes = [ord(c) - 96 if "a" <= c <= "z" else 0 for c in value.lower()]
        return float(np.mean([self.log[a, b] for a, b in zip([0, *codes], [*codes, 0])]))

    def coverage(self, value: str) -> float:
        """Share of the characters inside words of four letters or more, taking the longest word at each place."""
        low, at, covered = value.lower(), 0, 0
        while at < len(low):
            n = next((n for n in range(min(20, len(low) - at), 3, -1) if low[at : at + n] in self.words), 0)
            covered += n
            at += n or 1
        return covered / max(1, len(low))


def describe(text: str, start: int, end: int, kind: str, value: str, assigned: bool, path: str, lexicon: Lexicon) -> list[float]:
    """The entries of ``FEATURES`` for one candidate."""
    n = len(value)
    groups = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "m" for c in value]
    share = Counter(groups)
    spread = -sum(k / n * math.log2(k / n) for k in Counter(value).values())
    around = text[max(0, start - 60) : start].lower()
    words = re.findall(r"[^\W\d_]+", around)[-3:] + re.findall(r"[^\W\d_]+", text[end : end + 40].lower())[:2]
    near = [0.0] * NEIGHBOURS
    for w in words:
        near[hashlib.md5(w.encode()).digest()[0] % NEIGHBOURS] += 1
    low, place = value.lower(), path.lower()
    # long key material has any four letters somewhere inside a line
    made_up = _PLACEHOLDER.search(low) is not None if kind == "private_key" else any(w in low for w in PLACEHOLDER_WORDS)
    return [
        math.log1p(len(value)), share["d"] / n, share["u"] / n, share["l"] / n, share["m"] / n,
        sum(a != b for a, b in zip(groups, groups[1:])) / n, spread, float(all(c in "0123456789abcdef" for c in low)),
        float(value.isdigit()), lexicon.likelihood(value), lexicon.coverage(value), float(assigned), float(kind == "private_key"),
        float("@" in text[start : end + 1] or text[max(0, start - 1) : start] == "@"), float(value.isdigit() and passes_checksum(value)),
        float(any(w in around[-25:] for w in CREDENTIAL_WORDS)), float(made_up),
        float(place.count("/")), float(place.endswith((".env", ".ini", ".cfg", ".yml", ".yaml", ".json", ".toml"))),
        float(any(w in place for w in PLACEHOLDER_WORDS)), *near,
    ]


def lexicon_of(documents: DataFrame, words: int = 50_000) -> Lexicon:
    """The words of 4 to 20 letters that most documents have, up to ``words`` of them; all texts are counted."""
    pattern = re.compile(r"(?<![^\W\d_])[^\W\d_]{4,20}(?![^\W\d_])")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        def drained():
            return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])
        for batch in shared.chunks(batches):
            for text in shared.texts(batch.column(0)):
                counts.update(set(pattern.findall(text.lower())))
            if len(counts) > 1_000_000:
                yield drained()
                counts.clear()
        if counts:
            yield drained()

    counted = documents.select("doc").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return Lexicon(fitting.commonest(shared.written(counted.where("n > 1"), "words"), "word", "n", words))


def _found(path, text: str, lexicon: Lexicon) -> list[tuple]:
    name = "" if path is None else str(path)
    return [(s, e - s, kind, value, describe(text, s, e, kind, value, assigned, name, lexicon))
            for s, e, kind, value, assigned in candidates(text)]


def find_candidates(documents: DataFrame, lexicon: Lexicon) -> DataFrame:
    """(path, start, length, kind, value, features) of every candidate; places are characters of the text."""
    schema = T.StructType([documents.schema["path"], *T._parse_datatype_string(FINDING).fields])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = shared.arrow_schema(schema)
        for batch in shared.chunks(batches):
            rows = [(p, *f) for p, t in zip(batch.column(0).to_pylist(), shared.texts(batch.column(1))) for f in _found(p, t, lexicon)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), out.types)], schema=out)

    return documents.mapInArrow(each, schema)


def settled_labels(found: DataFrame) -> DataFrame:
    """Labels for the findings whose form settles them, where reviewers left none: provider forms and assigned
    values without words are secrets; mail addresses, plain numbers, placeholders and words are not."""
    x = lambda name: F.col("features")[FEATURES.index(name)]
    provider = F.col("kind").isin("private_key", *PROVIDER_FORMS)
    wrong = (x("mail") > 0) | (x("only_digits") > 0) | (x("placeholder") > 0) | (x("coverage") >= 0.6)
    right = (x("assigned") > 0) & (x("digits") > 0) & (x("turns") >= 0.2) & (x("coverage") < 0.3)
    bare = (F.col("kind") == "private_key") & F.col("value").rlike(rf"^{KEY_HEAD.pattern}$")  # a head without key material
    label = F.when(wrong | bare, 0).when(provider | right, 1)
    return found.select("path", "start", "length", label.alias("secret")).where("secret IS NOT NULL")


class Forest:
    """A fitted random forest as arrays, small enough to travel with a task."""

    def __init__(self, nodes: list):
        self.trees: list[tuple] = []
        by_tree: dict[int, dict] = {}
        for tree, node in nodes:
            by_tree.setdefault(tree, {})[node.id] = node
        for tree in by_tree.values():
            size = max(tree) + 1
            feature, threshold = np.full(size, -1), np.zeros(size)
            left, right, share = np.zeros(size, dtype=int), np.zeros(size, dtype=int), np.zeros(size)
            for i, node in tree.items():
                stats = np.array(node.impurityStats, dtype=float)
                share[i] = stats[1] / stats.sum() if len(stats) > 1 and stats.sum() else 0.0
                if node.leftChild >= 0:
                    feature[i], threshold[i] = node.split.featureIndex, node.split.leftCategoriesOrThreshold[0]
                    left[i], right[i] = node.leftChild, node.rightChild
            self.trees.append((feature, threshold, left, right, share))

    def score(self, x: np.ndarray) -> np.ndarray:
        """Mean share of secrets in the leaves; 1 without trees, so that nothing is removed."""
        if not self.trees:
            return np.ones(len(x))
        total = np.zeros(len(x))
        for feature, threshold, left, right, share in self.trees:
            at = np.zeros(len(x), dtype=int)
            while (feature[at] >= 0).any():
                f = feature[at]
                here = np.where(x[np.arange(len(x)), np.maximum(f, 0)] <= threshold[at], left[at], right[at])
                at = np.where(f >= 0, here, at)
            total += share[at]
        return total / len(self.trees)


def fit_forest(found: DataFrame, labels: DataFrame, trees: int = 20, depth: int = 6, fit_rows: int = 50_000, seed: int = 7) -> Forest:
    """A Spark ML forest on the labelled findings (path, start, length, secret 0/1), about ``fit_rows`` of them by
    hash. Labels of one kind only, or none, give a forest without trees."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.functions import array_to_vector

    spark = found.sparkSession
    known = labels.where("secret IS NOT NULL").groupBy("path", "start", "length").agg((F.avg("secret") >= 0.5).cast("double").alias("label"))
    rows = found.join(known, ["path", "start", "length"])
    rows = rows.select("label", array_to_vector("features").alias("features"), F.xxhash64(F.col("path").cast("string"), "start").alias("h"))
    counts = rows.groupBy("label").count().collect()
    if len(counts) < 2:
        return Forest([])
    share = min(1.0, fit_rows / sum(r["count"] for r in counts))
    rows = shared.written(rows.where(F.pmod("h", F.lit(1 << 20)) < share * (1 << 20)).select("label", "features"), "findings")
    model = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="sqrt").fit(rows)
    place = f"{shared.shared_folder(spark)}/forest-{uuid.uuid4().hex}"
    model.save(place)
    nodes = spark.read.parquet(f"{place}/data").select("treeID", "nodeData").collect()  # at most trees x 2^(depth+1)
    return Forest(sorted(((r.treeID, r.nodeData) for r in nodes), key=lambda x: (x[0], x[1].id)))


def _source(documents: DataFrame, path: str, doc: str) -> DataFrame:
    return documents.select(F.col(path).alias("path"), F.col(doc).alias("doc"))


def scan_secrets(documents: DataFrame, labels: DataFrame | None = None, path: str = "path", doc: str = "doc", least: float = 0.5) -> DataFrame:
    """One row per candidate secret of the run documents: ``path``, start, length, kind, value, score, secret.

    ``labels`` are reviewed findings (path, start, length, secret 0/1); where there are none, findings whose form
    settles them serve (:func:`settled_labels`). A candidate is a secret when the forest gives it ``least`` or
    more; all candidates are returned. NULL and empty documents have none; repeated rows report each; a NULL path
    is scanned, and never learned from. An empty table gives no rows. Other columns are ignored.
    """
    found, forest = _fitted(_source(documents, path, doc), labels)[1:]
    schema = T.StructType([*[f for f in found.schema.fields if f.name != "features"], T.StructField("score", T.DoubleType())])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = shared.arrow_schema(schema)
        for batch in batches:
            if batch.num_rows:
                score = forest.score(np.array(batch.column(5).to_pylist()))
                yield pa.RecordBatch.from_arrays([*[batch.column(i).cast(t) for i, t in enumerate(out.types[:-1])], pa.array(score)], schema=out)

    return found.mapInArrow(each, schema).withColumn("secret", F.col("score") >= least).withColumnRenamed("path", path)


def _fitted(source: DataFrame, labels: DataFrame | None) -> tuple[Lexicon, DataFrame, Forest]:
    lexicon = lexicon_of(source)
    found = shared.written(find_candidates(source, lexicon), "candidates")
    return lexicon, found, fit_forest(found, settled_labels(found) if labels is None else labels)


def redacted(documents: DataFrame, labels: DataFrame | None = None, path: str = "path", doc: str = "doc", least: float = 0.5,
             mark: str = "[SECRET]") -> DataFrame:
    """The documents with every secret of :func:`scan_secrets` replaced by ``mark`` in ``doc``; all columns and
    rows stay. The forest is small, so texts are scanned again where they are and never shuffled."""
    lexicon, _, forest = _fitted(_source(documents, path, doc), labels)
    schema = documents.schema
    names = documents.columns
    at_path, at_doc = names.index(path), names.index(doc)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = shared.arrow_schema(schema)
        for batch in shared.chunks(batches):
            texts = batch.column(at_doc).to_pylist()
            for row, (key, text) in enumerate(zip(batch.column(at_path).to_pylist(), texts)):
                found = _found(key, text or "", lexicon)
                if found:
                    keep = forest.score(np.array([f[4] for f in found])) >= least
                    parts, last = [], 0
                    for (start, n, *_), secret in zip(found, keep):
                        if secret and start + n > last:
                            if start >= last:
                                parts += [text[last:start], mark]
                            last = start + n  # one mark for places that overlap
                    texts[row] = "".join([*parts, text[last:]])
            columns = [pa.array(texts, out.types[i]) if i == at_doc else batch.column(i).cast(t) for i, t in enumerate(out.types)]
            yield pa.RecordBatch.from_arrays(columns, schema=out)

    return documents.mapInArrow(each, schema)


def digest(value: str | Column) -> Column:
    return F.sha2(F.col(value) if isinstance(value, str) else value, 256)
