"""Exact BM25 top-k over run documents: an inverted index per shard, block-max WAND pruning, one exact merge."""

from __future__ import annotations

from collections import Counter
from collections.abc import Collection, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeline.llm import shared

K1, B = 1.2, 0.75
BLOCK = 512  # documents of a block
FIRST_BLOCKS = 8  # blocks scored before anything is pruned
DENSE = 12  # a term that one document in so many of a block has is kept as a row over that block
DIGITS = 6  # scores are rounded, so that equal texts tie whatever the order of additions
QUERIES = 2048  # queries that share a dictionary
CELLS = 4_194_304  # scores of queries and documents held at a time
KNOWN = 16_000_000  # best scores that a task keeps from shard to shard
_WORDS = bytes(i + 32 if 65 <= i <= 90 else i if 48 <= i <= 57 or 97 <= i <= 122 or i >= 128 else 32 for i in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Words of a text: runs of ASCII letters and digits and of all other characters beyond ASCII; A-Z are lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORDS).split()


def hashes_of(words: Collection[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def terms_of(text: str | None) -> np.ndarray:
    """Hashes of the words of a text."""
    return hashes_of(words_of(text))


def bag_of(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct words of a text, in order, and how often each occurs."""
    counts = Counter(words_of(text))
    terms = hashes_of(counts)
    by = np.argsort(terms)
    return terms[by], np.fromiter(counts.values(), dtype=np.int32, count=len(counts))[by]


class Shard:
    """Inverted index of some documents. Documents are numbered by commonest word and length, so that a block holds
    documents that score alike and its maxima are sharp.

    An entry is a term in a block, with its largest weight. Terms that many documents of a block have are rows over
    that block, which queries meet by matrix products; the others are postings. Both are single precision and only tell
    which documents can be among the best; those are scored from their own terms in double precision."""

    def __init__(self, texts: list[np.ndarray], average: float):
        self._index([np.unique(t, return_counts=True) for t in texts], average)

    @classmethod
    def of_bags(cls, bags: list[tuple[np.ndarray, np.ndarray]], average: float) -> Shard:
        """The shard of documents given by ``bag_of``; the list is emptied."""
        shard = cls.__new__(cls)
        shard._index(bags, average)
        return shard

    def _index(self, found: list[tuple[np.ndarray, np.ndarray]], average: float) -> None:
        rows = len(found)
        lengths = np.array([n.sum() for _, n in found], dtype=np.int64)
        often = [int(t[n.argmax()] >> np.uint64(1)) if len(t) else 0 for t, n in found]
        self.order = np.lexsort((lengths, often))  # number to row
        lengths = lengths[self.order]
        found[:] = [found[i] for i in self.order]
        sizes = np.array([len(t) for t, _ in found], dtype=np.int64)
        flat = np.concatenate([t for t, _ in found]) if found else np.empty(0, np.uint64)
        tf = np.concatenate([n for _, n in found]) if found else np.empty(0, np.int32)
        found.clear()
        self.own_start = np.append(0, np.cumsum(sizes))  # by number
        self.own_weights = np.repeat(K1 * (1 - B + B * lengths / max(average, 1e-9)), sizes)
        self.own_weights += tf
        np.divide(tf * (K1 + 1), self.own_weights, out=self.own_weights)
        del tf
        by = np.argsort(flat, kind="stable")
        flat = flat[by]
        new = np.append(True, flat[1:] != flat[:-1])[: len(flat)]
        self.terms = flat[new]
        term = np.cumsum(new, dtype=np.int32) - 1
        self.own_terms = np.empty(len(flat), dtype=np.int32)
        self.own_terms[by] = term
        del flat, new
        self.docs = np.repeat(np.arange(rows, dtype=np.int32), sizes)[by]
        weights = self.own_weights[by].astype(np.float32)
        del by
        self.blocks = -(-rows // BLOCK)
        block = self.docs // BLOCK
        new = np.append(True, (term[1:] != term[:-1]) | (block[1:] != block[:-1]))[: len(term)]
        start = np.flatnonzero(new)
        size = np.diff(np.append(start, len(term)))
        entry_term = term[start]
        self.entry_block = block[start]
        self.entry_max = np.maximum.reduceat(weights, start) if len(term) else np.empty(0, np.float32)
        self.term_start = np.searchsorted(entry_term, np.arange(len(self.terms) + 1))
        dense = size * DENSE >= BLOCK
        rowed = np.flatnonzero(dense)
        rowed = rowed[np.argsort(self.entry_block[rowed], kind="stable")]
        self.dense_start = np.searchsorted(self.entry_block[rowed], np.arange(self.blocks + 1))
        self.dense_terms, self.dense_column = np.unique(entry_term[rowed], return_inverse=True)
        self.dense = np.zeros((len(rowed), BLOCK), dtype=np.float32)
        place = np.full(len(start), -1, dtype=np.int32)
        place[rowed] = np.arange(len(rowed))
        place = np.repeat(place, size)
        often = place >= 0
        self.dense[place[often], self.docs[often] % BLOCK] = weights[often]
        sparse, self.sparse_weights = self.docs[~often], weights[~often]
        self.sparse_start = np.searchsorted(term[~often], np.arange(len(self.terms) + 1))
        self.tile = max(8, min(256, CELLS // max(1, self.blocks * BLOCK)))
        self.scores = np.empty((self.blocks, self.tile, BLOCK), dtype=np.float32)
        self.spots = sparse // BLOCK * (self.tile * BLOCK) + sparse % BLOCK  # in the scores of a tile's first query

    def top(self, terms: np.ndarray, idf: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows, scores) of documents that contain a query term and reach the k-th best score of this shard."""
        _, rows, scores = self.best(terms, idf, np.arange(len(terms)), np.array([len(terms)]), np.zeros((1, k)))
        return rows, scores

    def best(self, terms: np.ndarray, idf: np.ndarray, at: np.ndarray, sizes: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, row, score) for queries whose terms are ``terms[at]``, ``sizes`` of them each; ``terms`` are distinct.
        ``known`` has the best scores of each query in other shards, or 0, and takes up what is found.

        A block's bound for a query is the sum of the maxima of its terms. Queries with the same best block go
        together, short ones first, a tile at a time. The blocks with the largest bounds are scored first; after that only blocks whose
        bound reaches the k-th best score so far are.
        """
        here = np.searchsorted(self.terms, terms)
        here[here == len(self.terms)] = 0
        found = self.terms[here] == terms if len(self.terms) else np.zeros(len(terms), bool)
        local = here[found]  # of the terms found
        weight = np.zeros(len(self.terms))
        weight[local] = idf[found]
        compact = np.full(len(terms), -1)
        compact[found] = np.arange(len(local))
        own = compact[at]
        query = np.repeat(np.arange(len(sizes)), sizes)[own >= 0]
        own = own[own >= 0]
        if not len(own):
            return np.empty(0, int), np.empty(0, int), np.empty(0)
        size = self.term_start[local + 1] - self.term_start[local]
        entries = _ranges(self.term_start[local], size)
        most = np.zeros((len(local), self.blocks), dtype=np.float32)
        term = np.repeat(np.arange(len(local)), size)
        most[term, self.entry_block[entries]] = self.entry_max[entries] * idf[found][term]
        del entries, term
        names, start = np.unique(query, return_index=True)
        ends = np.append(start[1:], len(own))
        bounds = np.array([most[own[lo:hi]].sum(axis=0) for lo, hi in zip(start, ends)])
        del most
        added = np.repeat(weight.astype(np.float32), np.diff(self.sparse_start))
        added *= self.sparse_weights
        alike = np.lexsort((ends - start, bounds.argmax(axis=1)))
        out = []
        for lo in range(0, len(alike), self.tile):
            tile = alike[lo : lo + self.tile]
            out += self._tile([local[own[start[i] : ends[i]]] for i in tile], weight, added, bounds[tile], names[tile], known)
        return tuple(np.concatenate(c) for c in zip(*out))

    def _tile(self, terms: list[np.ndarray], weight: np.ndarray, added: np.ndarray, bounds: np.ndarray, names: np.ndarray, known: np.ndarray):
        count, k = len(terms), known.shape[1]
        before = known[names].min(axis=1)
        sizes = np.array([len(t) for t in terms])
        slack = 2.4e-7 * (sizes + 16)  # more than single precision can lose in so many additions
        flat = np.concatenate(terms)
        query = np.repeat(np.arange(count), sizes)
        scores = self.scores[:, :count]
        scores[:] = 0
        every = self.scores.reshape(-1)
        for i, t in enumerate(terms):
            part = _ranges(self.sparse_start[t], self.sparse_start[t + 1] - self.sparse_start[t])
            np.add.at(every[i * BLOCK :], self.spots.take(part, mode="clip"), added.take(part, mode="clip"))
        column = np.searchsorted(self.dense_terms, flat)
        column[column == len(self.dense_terms)] = 0
        often = self.dense_terms[column] == flat if len(self.dense_terms) else np.zeros(len(flat), bool)
        asked = np.zeros((len(self.dense_terms), count), dtype=np.float32)
        asked[column[often], query[often]] = weight[flat[often]]
        used = asked.any(axis=1)
        asked_here = np.empty((np.diff(self.dense_start).max(), count), dtype=np.float32)
        product = np.empty((count, BLOCK), dtype=np.float32)
        spread = BLOCK // 16 if BLOCK % 16 == 0 else 1
        peaks = np.zeros((self.blocks, count, BLOCK // spread), dtype=np.float32)

        def finish(block: int, who: np.ndarray) -> None:
            own = slice(self.dense_start[block], self.dense_start[block + 1])
            column, rows = self.dense_column[own], self.dense[own]
            use = used[column]
            if use.sum() * 4 < len(use) * 3:
                column, rows = column[use], rows[use]
            part = np.take(asked, column, axis=0, out=asked_here[: len(column)], mode="clip")
            if len(who) * 8 < count:
                scores[block, who] += part[:, who].T @ rows
            else:
                scores[block] += np.dot(part.T, rows, out=product)
            scores[block].reshape(count, spread, BLOCK // spread).max(axis=1, out=peaks[block])

        def least(blocks: np.ndarray) -> np.ndarray:
            """What the k-th best score of each query is at least, by the best of some groups of documents."""
            of = peaks[blocks].transpose(1, 0, 2).reshape(count, -1)
            kth = np.partition(of, -k, axis=1)[:, -k].astype(float) if of.shape[1] >= k else np.zeros(count)
            return np.maximum(np.maximum(kth, before) * (1 - slack) - 2 * 10.0**-DIGITS, 1e-30)

        done = np.argsort(-bounds.sum(axis=0), kind="stable")
        everyone = np.arange(count)
        for block in done[:FIRST_BLOCKS].tolist():
            finish(block, everyone)
        reach = bounds * (1 + slack)[:, None] >= least(done[:FIRST_BLOCKS])[:, None]
        reach[:, done[:FIRST_BLOCKS]] = True
        done = done[reach[:, done].any(axis=0)]
        for block in done[FIRST_BLOCKS:].tolist():
            finish(block, np.flatnonzero(reach[:, block]))
        enough = least(done)
        block, asking = np.nonzero(peaks[done].max(axis=2) >= enough)
        hit, at = np.nonzero(scores[done[block], asking] >= enough[asking][:, None])
        asking, found = asking[hit], done[block[hit]] * BLOCK + at
        by = np.argsort(asking, kind="stable")
        asking, found = asking[by], found[by]
        mine = np.zeros(len(self.terms), dtype=bool)
        out = []
        for i, (lo, hi) in enumerate(zip(*(np.searchsorted(asking, everyone, side=s).tolist() for s in ("left", "right")))):
            if lo == hi:
                continue
            mine[terms[i]] = True
            exact = np.empty(hi - lo)
            for j, number in enumerate(found[lo:hi].tolist()):
                start, stop = self.own_start[number : number + 2].tolist()
                both = self.own_terms[start:stop]
                at = np.flatnonzero(mine.take(both))
                exact[j] = weight[both[at]] @ self.own_weights[start:stop][at]
            mine[terms[i]] = False
            exact = exact.round(DIGITS)
            most = np.append(known[names[i]], exact)
            known[names[i]] = most = np.partition(most, -k)[-k:]
            good = exact >= most[0]
            out.append((np.full(good.sum(), names[i]), self.order[found[lo:hi][good]], exact[good]))
        return out


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one after the other."""
    ends = np.cumsum(size)
    out = np.repeat(start - ends + size, size)
    out += np.arange(len(out))
    return out


def _ready_queries(source: DataFrame, queries: DataFrame) -> tuple[DataFrame, float]:
    """(query, terms, idf) with document counts over the whole corpus, and the mean document length."""
    counts = "term long, n long, words long"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = pa.schema([(c, pa.int64()) for c in ("term", "n", "words")])
        documents = words = 0
        held: Counter[bytes] = Counter()

        def drained():
            columns = [pa.array(hashes_of(held).view(np.int64)), pa.array(list(held.values()), pa.int64()), pa.nulls(len(held), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, schema=out)

        for batch in shared.chunks(batches):
            for text in batch.column(0).to_pylist():
                found = words_of(text)
                documents, words = documents + 1, words + len(found)
                held.update(set(found))
            if len(held) > 400_000:
                yield drained()
                held.clear()
        if held:
            yield drained()
        if documents:
            yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([documents]), pa.array([words])], schema=out)

    kind = T.StructType([queries.schema["query"], T.StructField("term", T.LongType())])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = shared.arrow_schema(kind)
        for batch in shared.chunks(batches, 200):
            found = [np.unique(terms_of(t)).view(np.int64) for t in batch.column(1).to_pylist()]
            keys = batch.column(0).take(pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found])))
            yield pa.RecordBatch.from_arrays([keys.cast(out.types[0]), pa.array(np.concatenate(found))], schema=out)

    counted = source.select("doc").mapInArrow(count, counts).groupBy("term").agg(F.sum("n").alias("n"), F.sum("words").alias("words"))
    counted = shared.written(counted, "terms")
    total = counted.where("term IS NULL").first()
    n, words = (total.n, total.words) if total else (0, 0)
    wanted = queries.mapInArrow(split, kind).join(counted.where("term IS NOT NULL").select("term", "n"), "term")
    idf = F.ln(1 + (F.lit(float(n)) - F.col("n") + 0.5) / (F.col("n") + 0.5))
    ready = wanted.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("term", idf.alias("idf")))).alias("t"))  # one text's words
    return ready.select("query", F.col("t.term").alias("terms"), F.col("t.idf").alias("idf")), words / max(1, n)


def _query_blocks(ready: DataFrame) -> DataFrame:
    """Queries with the dictionary of their terms: a row for ``QUERIES`` of them."""
    name = ready.schema["query"].dataType
    kind = T.StructType([T.StructField(c, T.ArrayType(t)) for c, t in (
        ("names", name), ("terms", T.LongType()), ("idf", T.DoubleType()), ("at", T.IntegerType()), ("sizes", T.IntegerType()))])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = shared.arrow_schema(kind)
        held: list[pa.RecordBatch] = []

        def drained():
            table = pa.Table.from_batches(held)
            lists = table.column("terms").combine_chunks()
            terms, first, at = np.unique(lists.flatten().to_numpy().view(np.uint64), return_index=True, return_inverse=True)
            idf = table.column("idf").combine_chunks().flatten().to_numpy()[first]
            values = (table.column("query").combine_chunks(), terms.view(np.int64), idf, at.astype(np.int32), lists.value_lengths())
            columns = [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), pa.array(v).cast(t.type.value_type)) for v, t in zip(values, out)]
            return pa.RecordBatch.from_arrays([c.cast(t.type) for c, t in zip(columns, out)], schema=out)

        for batch in shared.chunks(batches, 256):
            held.append(batch)
            if sum(b.num_rows for b in held) >= QUERIES:
                yield drained()
                held.clear()
        if held:
            yield drained()

    return ready.coalesce(max(1, -(-ready.count() // QUERIES))).mapInArrow(blocks, kind)


def search_documents(documents: DataFrame, queries: DataFrame, k: int = 10, path: str = "path", doc: str = "doc", query: str = "query",
                     query_doc: str = "doc", shard_documents: int = 6144) -> DataFrame:
    """(``query``, rank, ``path``, score) of the ``k`` best run documents for each query text, exactly.

    BM25 over the distinct words of the query, with document counts and mean length of the whole corpus; scores are
    rounded to six decimals and ties go to the smaller path. A task indexes about ``shard_documents`` documents at a
    time and goes through the queries block by block from the shared folder, so neither side is broadcast or shuffled
    whole; what reaches the k-th best score that the task has seen is merged. Documents without a common word have no
    row, so a query may have fewer than ``k``; it finds itself when it is in the corpus.

    NULL and empty documents and queries find nothing. Repeated rows are ranked each. A NULL path ranks last among
    equals. Repeated query names are an error of the caller: their words count as one query. Empty tables give no
    rows. Other columns are ignored.
    """
    source = documents.select(F.col(path).alias("path"), F.col(doc).alias("doc"))
    asked = queries.select(F.col(query).alias("query"), F.col(query_doc).alias("doc"))
    ready, average = _ready_queries(source, asked)
    ready = shared.written(_query_blocks(shared.written(ready, "queries")), "queries")
    place = ready.inputFiles()
    schema = T.StructType([asked.schema["query"], source.schema["path"], T.StructField("score", T.DoubleType())])
    sortable = isinstance(source.schema["path"].dataType, T.IntegralType) or source.schema["path"].dataType == T.StringType()

    def searched(paths: list, bags: list[tuple[np.ndarray, np.ndarray]], known: dict, out: pa.Schema) -> Iterator[pa.RecordBatch]:
        from pyarrow import compute, fs, parquet

        index = Shard.of_bags(bags, average)
        shared.give_back()
        keys = pa.array(paths, out.types[1])
        paths.clear()
        rank = np.zeros(len(keys), dtype=np.int64)
        if sortable:  # as the merge orders equals, so that no more than k of them leave the shard
            rank[compute.array_sort_indices(keys, order="ascending").to_numpy()] = np.arange(len(keys))  # NULL last
        for uri in place:
            store, name = fs.FileSystem.from_uri(uri)
            with store.open_input_file(name) as file:
                for row, batch in enumerate(parquet.ParquetFile(file).iter_batches(batch_size=1)):
                    names, terms, idf, at, sizes = (c[0].values for c in batch.columns)
                    terms, idf, at, sizes = (c.to_numpy() for c in (terms, idf, at, sizes))
                    best = known.get((uri, row), np.zeros((len(sizes), k)))
                    query, rows, scores = index.best(terms.view(np.uint64), idf, at, sizes, best)
                    if sum(map(np.size, known.values())) < KNOWN:
                        known[uri, row] = best
                    if sortable:
                        by = np.lexsort((rank[rows], -scores, query))
                        by = by[np.arange(len(by)) - np.searchsorted(query[by], query[by]) < k]
                        query, rows, scores = query[by], rows[by], scores[by]
                    columns = [names.take(pa.array(query)).cast(out.types[0]), keys.take(pa.array(rows)), pa.array(scores)]
                    yield pa.RecordBatch.from_arrays(columns, schema=out)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = shared.arrow_schema(schema)
        paths, bags, known = [], [], {}
        for batch in shared.chunks(batches):
            paths += batch.column(0).to_pylist()
            bags += [bag_of(t) for t in batch.column(1).to_pylist()]
            if len(paths) >= 1.25 * shard_documents:
                yield from searched(paths, bags, known, out)
                shared.give_back()
        if paths:
            yield from searched(paths, bags, known, out)
            shared.give_back()

    shards = max(1, -(-source.count() // shard_documents))
    tasks = min(shards, max(4 * documents.sparkSession.sparkContext.defaultParallelism, -(-shards // 16)))
    found = source.coalesce(tasks).mapInArrow(each, schema)
    best = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("path"))
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select(F.col("query").alias(query), "rank", F.col("path").alias(path), "score")
