"""Jaccard join of run documents on word shingles: rare-first prefixes, filters, exact verification, components."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeline.llm import fitting, graph, shared

SKETCH = 1 << 19  # counters of the frequency sketch; a fixed size whatever the input
PARTS = 1024  # parts of the hash space for the suffix filter
SMALL = 8  # members up to which a bucket is paired directly
BLOCK = 1024  # members of a block of a large bucket
SEEN = 50_000  # pairs a task remembers to leave out repeats; later steps leave out the rest
MANY_ROWS = 1_000_000  # longest list of paths that is broadcast


def shingles(text: str | None, width: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``width``-word shingles. Only A-Z are lower-cased and only the six
    ASCII white-space characters part words; a shorter text is one shingle, one without words is none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    k = min(width, len(words))
    out = np.full(len(h) - k + 1, k, dtype=np.uint64)
    for i in range(k):
        out = (out ^ h[i : len(h) - k + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    out.sort()
    return out[np.append(True, out[1:] != out[:-1])]


def parities(tokens: np.ndarray) -> bytes:
    """One bit per part of the hash space: whether the set has an odd number of tokens there."""
    odd = np.bincount((tokens >> np.uint64(40)).astype(np.int64) % PARTS, minlength=PARTS) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def may_link(na, nb, percent: int):
    """Length filter."""
    return 100 * np.minimum(na, nb) >= percent * np.maximum(na, nb)


def needed(na, nb, percent: int):
    """Smallest intersection that links sets of these sizes."""
    return -(-(percent * (na + nb)) // (100 + percent))


def apart(sa: np.ndarray, sb: np.ndarray) -> np.ndarray:
    """Lower bound of the symmetric difference of sets from their parities (rows of 64-bit words)."""
    return np.bitwise_count(sa ^ sb).sum(axis=1, dtype=np.int64)


def _batch(schema: T.StructType, *columns) -> pa.RecordBatch:
    out = shared.arrow_schema(schema)
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, out.types)], schema=out)


def _signatures(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint64).reshape(-1, PARTS // 64)


def survey(documents: DataFrame, width: int) -> DataFrame:
    """One row per document (path, n, digest of its set, parities), and one sketch row per task."""
    schema = T.StructType([T.StructField("path", documents.schema["path"].dataType), *[T.StructField(n, t) for n, t in (
        ("n", T.LongType()), ("digest", T.BinaryType()), ("parity", T.BinaryType()), ("sketch", T.BinaryType()))]])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = np.zeros(SKETCH, dtype=np.int64), False
        for batch in shared.chunks(batches):
            n, digest, parity, all_tokens = [], [], [], []
            for text in batch.column(1).to_pylist():
                tokens = shingles(text, width)
                n.append(len(tokens))
                digest.append(hashlib.blake2b(tokens.tobytes(), digest_size=16).digest() if len(tokens) else None)
                parity.append(parities(tokens) if len(tokens) else None)
                all_tokens.append(tokens)
            at = (np.concatenate(all_tokens) % np.uint64(SKETCH)).astype(np.int64) if all_tokens else []
            counts += np.bincount(at, minlength=SKETCH)
            seen = True
            yield _batch(schema, batch.column(0), n, digest, parity, [None] * len(n))
        if seen:
            blob = np.minimum(counts, 65535).astype(np.uint16).tobytes()
            yield _batch(schema, [None], [None], [None], [None], [blob])

    return documents.mapInArrow(each, schema)


def frequency_levels(sketches: DataFrame) -> tuple[np.ndarray, float]:
    """Counts of the sketch on a logarithmic scale of one byte, and the mean count."""

    def add(total, batch):
        for blob in batch.column(0):
            total += np.frombuffer(blob.as_py(), dtype=np.uint16)

    def finish(counts):
        levels = np.minimum(255, 8 * np.log2(1 + counts)).astype(np.uint8)
        return np.append(levels, np.frombuffer(np.float64(counts.mean()).tobytes(), dtype=np.uint8))

    found = fitting.partition_sums(sketches, SKETCH, add, finish)
    return found[:SKETCH], float(np.frombuffer(found[SKETCH:].tobytes())[0])


def prefixes(documents: DataFrame, levels: np.ndarray, mean: float, width: int, percent: int, hot: int) -> DataFrame:
    """Postings (token, salt, path, n, at) of the rare-first prefix of each set. A token the sketch holds for
    hot gets a salt by path, so that its bucket is spread; sets below three tokens link only with equal ones."""
    path = documents.schema["path"]
    schema = T.StructType([T.StructField("token", T.LongType()), T.StructField("salt", T.IntegerType()), path,
                           T.StructField("n", T.IntegerType()), T.StructField("at", T.IntegerType())])
    limit = 16 * mean + hot
    shared_levels = documents.sparkSession.sparkContext.broadcast(levels)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = shared_levels.value
        estimate = np.exp2(level / 8.0)
        salts = np.where(estimate > limit, np.ceil(estimate / limit), 1).astype(np.int64)
        for batch in shared.chunks(batches):
            paths, parts = [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                tokens = shingles(text, width)
                n = len(tokens)
                if n < 3:
                    continue
                slot = (tokens % np.uint64(SKETCH)).astype(np.int64)
                order = np.argsort(level[slot], kind="stable")[: prefix_length(n, percent)]
                own = int.from_bytes(hashlib.blake2b(str(key).encode(), digest_size=4).digest(), "big")
                k = len(order)
                parts.append((tokens[order].view(np.int64), (own % salts[slot[order]]), np.full(k, n), np.arange(k)))
                paths.append((key, k))
            if parts:
                token, salt, n, at = (np.concatenate(c) for c in zip(*parts))
                where = np.repeat(np.arange(len(paths)), [k for _, k in paths])
                keys = pa.array([p for p, _ in paths], shared.arrow_schema(schema).types[2]).take(pa.array(where))
                yield _batch(schema, token, salt.astype(np.int32), keys, n.astype(np.int32), at.astype(np.int32))

    return documents.mapInArrow(each, schema)


def bucket_rows(postings: DataFrame, percent: int, hot: np.ndarray) -> DataFrame:
    """Buckets of equal tokens, streamed in order: candidate pairs (a, b) of small buckets and of each bucket's
    smallest path with the others; members of larger or salted buckets (token, a, n) for the second look."""
    path = postings.schema["path"].dataType
    schema = T.StructType([T.StructField("token", T.LongType()), T.StructField("a", path), T.StructField("b", path),
                           T.StructField("n", T.IntegerType()), T.StructField("first", T.BooleanType())])
    kind = shared.arrow_schema(schema).types[1]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        emitted: set = set()
        center = None  # (token, salt, path, n, at) of a bucket that goes on in the next batch

        def work(table: pa.Table, closed: bool) -> tuple[list[pa.RecordBatch], pa.Table | None]:
            nonlocal center
            token = table.column("token").to_numpy()
            salt = table.column("salt").to_numpy()
            n = table.column("n").to_numpy().astype(np.int64)
            at = table.column("at").to_numpy().astype(np.int64)
            keys = table.column("path").combine_chunks()
            new = np.flatnonzero(np.concatenate([[True], (token[1:] != token[:-1]) | (salt[1:] != salt[:-1])]))
            ends = np.append(new[1:], len(token))
            size = np.repeat(ends - new, ends - new)
            begin = np.repeat(new, ends - new)
            rows, left = [], None
            open_from = len(token)
            goes_on = center is not None and center[0] == token[0] and center[1] == salt[0]
            # the last bucket may go on: keep it whole while small, else only its center
            if not closed and ends[-1] - new[-1] <= SMALL and not (goes_on and new[-1] == 0):
                open_from = new[-1]
                left = table.slice(open_from)
            ia, ib = [], []
            use = np.arange(len(token)) < open_from
            big = (size > SMALL) | ((begin == 0) & goes_on)
            for lag in range(1, SMALL):
                i = np.flatnonzero(use[lag:] & ~big[lag:] & (begin[lag:] == begin[:-lag]) & use[:-lag])
                if not len(i):
                    break
                ia.append(i)
                ib.append(i + lag)
            star = np.flatnonzero(use & big & (begin != np.arange(len(token))) & ~((begin == 0) & goes_on))
            ia.append(begin[star])
            ib.append(star)
            ia, ib = np.concatenate(ia), np.concatenate(ib)
            ok = _possible(n[ia], at[ia], n[ib], at[ib], percent)
            pairs = set(zip(keys.take(pa.array(ia[ok])).to_pylist(), keys.take(pa.array(ib[ok])).to_pylist()))
            if goes_on:
                i = np.flatnonzero(use & (begin == 0))
                ok = _possible(center[3], center[4], n[i], at[i], percent)
                pairs.update((center[2], k) for k in keys.take(pa.array(i[ok])).to_pylist())
            pairs = [p for p in pairs if p not in emitted and p[0] != p[1]]
            if len(emitted) > SEEN:
                emitted.clear()
            emitted.update(pairs)
            if pairs:
                a, b = (pa.array(c, kind) for c in zip(*pairs))
                none = [None] * len(a)
                rows.append(_batch(schema, none, a, b, none, none))
            members = np.flatnonzero(use & (big | _hot(token, hot_slots.value)))
            if len(members):
                first = (begin[members] == members) & ~((begin[members] == 0) & goes_on)
                rows.append(_batch(schema, token[members], keys.take(pa.array(members)), [None] * len(members), n[members].astype(np.int32), first))
            if not closed and left is None:
                b = new[-1]
                if not (goes_on and b == 0):
                    center = (token[b], salt[b], keys[int(b)].as_py(), n[b], at[b])
            elif left is not None:
                center = None
            return rows, left

        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([held, table]) if held is not None else table
            rows, held = work(table, False)
            yield from rows
        if held is not None:
            rows, _ = work(held, True)
            yield from rows
        shared.give_back()

    hot_slots = postings.sparkSession.sparkContext.broadcast(hot)
    return postings.mapInArrow(each, schema)


def _hot(token: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return slots[(token.view(np.uint64) % np.uint64(SKETCH)).astype(np.int64)]


def _possible(na, ia, nb, ib, percent: int) -> np.ndarray:
    """Length and positional filter of two sets that share the token at places ``ia`` and ``ib``."""
    na, nb = np.asarray(na), np.asarray(nb)
    most = np.minimum(ia, ib) + 1 + np.minimum(na - ia, nb - ib) - 1
    return may_link(na, nb, percent) & (most >= needed(na, nb, percent))


def suffix_filter(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose parities allow a link: sizes that differ in parity in too many parts cannot."""
    for side in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("path").alias(side), F.col("n").alias(f"n{side}"), F.col("parity").alias(f"p{side}")), side)

    schema = T.StructType([pairs.schema["a"], pairs.schema["b"]])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                na, nb = (batch.column(i).to_numpy() for i in (2, 3))
                gap = apart(_signatures(batch.column(4)), _signatures(batch.column(5)))
                ok = na + nb - gap >= 2 * needed(na, nb, percent)
                keep = pa.array(np.flatnonzero(ok))
                yield _batch(schema, batch.column(0).take(keep), batch.column(1).take(keep))

    return pairs.select("a", "b", "na", "nb", "pa", "pb").mapInArrow(each, schema)


def verified(pairs: DataFrame, documents: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs that link, by their whole shingle sets; each pair is compared once. ``pairs`` is a written table."""
    paths = pairs.select(F.explode(F.array("a", "b")).alias("path")).distinct()
    paths = shared.written(paths, "candidates")
    if paths.count() <= MANY_ROWS:
        documents = documents.join(F.broadcast(paths), "path", "left_semi")
    schema = T.StructType([pairs.schema["a"], pairs.schema["b"]])
    side = lambda s: documents.select(F.col("path").alias(s), F.col("doc").alias(f"d{s}"))
    texts = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "da", "db")  # equal a, the hubs, come together

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recent: dict[str, np.ndarray] = {}

        def tokens(text: str) -> np.ndarray:
            if text not in recent:
                if len(recent) >= 64:
                    recent.pop(next(iter(recent)))
                recent[text] = shingles(text, width)
            return recent[text]

        for batch in shared.chunks(batches, 200):
            keep = []
            for i, (a, b) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
                mine, other = tokens(a), tokens(b)
                merged = np.concatenate([mine, other])
                merged.sort()
                both = int((merged[1:] == merged[:-1]).sum())
                if 100 * both >= percent * (len(mine) + len(other) - both):
                    keep.append(i)
            at = pa.array(keep, pa.int64())
            yield _batch(schema, batch.column(0).take(at), batch.column(1).take(at))

    return texts.mapInArrow(each, schema)


def second_look(members: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of a large bucket that are not yet in one component, past the length and suffix filters.

    Buckets that one component fills are done. The others are dealt to blocks of about ``BLOCK`` members, and each
    pair of blocks is a task's work of bounded size; only pairs that pass the filters leave it.
    """
    named = members.join(labels.select(F.col("node").alias("a"), "component"), "a", "left").withColumn("component", F.coalesce("component", "a"))
    named = shared.written(named.select("token", "a", "n", "component"), "members")
    mixed = named.groupBy("token").agg(F.count(F.lit(1)).alias("m"), F.min("component").alias("c0"), F.max("component").alias("c1")).where("c0 <> c1")
    blocks = F.ceil(F.col("m") / F.lit(BLOCK)).cast("int")
    own = F.pmod(F.xxhash64("a"), F.col("blocks")).cast("int")
    open_rows = named.join(mixed.select("token", blocks.alias("blocks")), "token").withColumn("own", own)
    dealt = (
        open_rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("token", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "a", "component")
        .join(sets.select(F.col("path").alias("a"), "n", "parity"), "a")
    )
    path = members.schema["a"].dataType
    schema = T.StructType([T.StructField("a", path), T.StructField("b", path)])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, seen = [], set()

        def pairs(table: pa.Table):
            n, own = table.column("n").to_numpy(), table.column("own").to_numpy()
            i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
            label = table.column("component").combine_chunks().dictionary_encode().indices.to_numpy()
            keys, sig = table.column("a").combine_chunks(), _signatures(table.column("parity"))
            for x in range(table.num_rows):
                ys = np.arange(x + 1, table.num_rows)
                ys = ys[(label[ys] != label[x]) & may_link(n[x], n[ys], percent)]
                if i != j:
                    ys = ys[own[ys] != own[x]]
                if len(ys):
                    ok = n[x] + n[ys] - apart(sig[x][None], sig[ys]) >= 2 * needed(n[x], n[ys], percent)
                    for y in ys[ok]:
                        a, b = sorted((keys[x].as_py(), keys[int(y)].as_py()))
                        if a != b and (a, b) not in seen:
                            seen.add((a, b))
                            yield a, b
            if len(seen) > SEEN:
                seen.clear()

        def flush(table: pa.Table):
            found = list(pairs(table))
            if found:
                yield _batch(schema, *(list(c) for c in zip(*found)))

        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([*held, batch])
            t, i, j = (table.column(c).to_numpy() for c in ("token", "i", "j"))
            cuts = [0, *(np.flatnonzero((t[1:] != t[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1), len(t)]
            for s, e in zip(cuts[:-2], cuts[1:-1]):
                yield from flush(table.slice(s, e - s))
            held = table.slice(cuts[-2]).to_batches()
        if held:
            yield from flush(pa.Table.from_batches(held))
        shared.give_back()

    ready = dealt.select("token", "i", "j", "own", "a", "component", "n", "parity")
    return ready.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j", "a").mapInArrow(each, schema).distinct()


def jaccard_components(documents: DataFrame, path: str = "path", doc: str = "doc", width: int = 5, percent: int = 75,
                       hot: int = 4096) -> DataFrame:
    """(``path``, n_shingles, component) of every run document: documents link when their sets of ``width``-word
    shingles have a Jaccard similarity of ``percent`` per cent or more; the component is the smallest path that
    links reach. Exact (shingles are told apart by 64-bit hashes).

    Equal sets are joined by their digest, and only one of each goes on. A sketch of all shingles orders them rare
    first; prefix postings meet by token; length, positional and suffix filters thin the candidates, and each
    remaining pair is compared once by whole texts. A bucket of up to ``SMALL`` sets gives its pairs; a larger
    one first the pairs with its smallest path, and then, block by block, those of its pairs that are not in one
    component by then. ``hot`` sets how far above the mean a token's count must be for its bucket to be salted.

    NULL, empty and blank documents have 0 shingles and are alone. A repeated row is a copy; rows that share a path
    but not the text keep their own counts and may be linked through each other. A NULL path has a NULL component and links
    nothing. An empty table gives no rows. Other columns are ignored.
    """
    source = documents.select(F.col(path).alias("path"), F.col(doc).alias("doc"))
    rows = shared.written(survey(source, width), "sets")
    sets = rows.where("n IS NOT NULL").select("path", "n", "digest", "parity")
    levels, mean = frequency_levels(rows.where("sketch IS NOT NULL").select("sketch"))
    named = sets.where("path IS NOT NULL AND n > 0")
    by_set = named.groupBy("digest").agg(F.min("path").alias("path"), F.first("n").alias("n"), F.first("parity").alias("parity"), F.count(F.lit(1)).alias("copies"))
    classes = shared.written(by_set, "classes")
    more = classes.where("copies > 1").select("digest", F.col("path").alias("kept"))
    copies = named.select("path", "digest").join(more, "digest").where("path <> kept").select("path").distinct()
    copies = shared.written(copies.join(classes.select("path"), "path", "left_anti"), "copies")
    kept = source.where("path IS NOT NULL")
    kept = kept.join(F.broadcast(copies) if copies.count() <= MANY_ROWS else copies, "path", "left_anti")

    is_hot = np.exp2(levels / 8.0) > 16 * mean + hot
    postings = prefixes(kept, levels, mean, width, percent, hot).repartition("token", "salt").sortWithinPartitions("token", "salt", "path")
    found = shared.written(bucket_rows(postings, percent, is_hot), "buckets")
    members = found.where("token IS NOT NULL")
    pairs = found.where("token IS NULL").select("a", "b")
    # parts of a salted bucket: their smallest paths with the smallest of all
    heads = members.where("first").select("token", "a")
    lowest = heads.groupBy("token").agg(F.min("a").alias("b"), F.count(F.lit(1)).alias("parts")).where("parts > 1").drop("parts")
    across = heads.join(lowest, "token").where("a <> b").select("a", "b")
    pairs = pairs.union(across).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    sized = classes.select("path", "n", "parity").dropDuplicates(["path"])
    first = shared.written(suffix_filter(pairs, sized, percent), "pairs")
    links = shared.written(verified(first, kept, width, percent), "links")
    labels = shared.written(graph.components(links), "labels")
    open_pairs = shared.written(second_look(members, labels, sized, percent).join(first, ["a", "b"], "left_anti"), "pairs")
    if open_pairs.limit(1).count():
        more_links = verified(open_pairs, kept, width, percent)
        labels = shared.written(graph.components(labels.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more_links)), "labels")
    of_class = classes.join(labels, classes["path"] == labels["node"], "left").where("copies > 1 OR component IS NOT NULL")
    of_class = shared.written(of_class.select("digest", F.coalesce("component", "path").alias("component")), "components")
    out = sets.join(of_class, "digest", "left")
    return out.select(F.col("path").alias(path), F.col("n").alias("n_shingles"),
                      F.when(F.col("path").isNotNull(), F.coalesce("component", "path")).alias("component"))


def one_of_each(documents: DataFrame, path: str = "path", doc: str = "doc", width: int = 5, percent: int = 75) -> DataFrame:
    """The rows of ``documents`` without those that :func:`jaccard_components` puts in the component of a smaller
    path; of rows that repeat a path one stays. All columns are kept, and rows with a NULL path stay. Texts are
    not shuffled while the list of paths to leave out can be broadcast."""
    found = shared.written(jaccard_components(documents, path, doc, width, percent), "found")
    by_path = found.where(F.col(path).isNotNull()).groupBy(path)
    odd = by_path.agg(F.max(F.col("component") < F.col(path)).alias("leave"), (F.count(F.lit(1)) > 1).alias("twice"))
    odd = shared.written(odd.where("leave OR twice"), "odd")
    count = odd.agg(F.count_if("leave").alias("leave"), F.count_if(F.col("twice") & ~F.col("leave")).alias("twice")).first()
    leave, twice = odd.where("leave").select(path), odd.where("twice AND NOT leave").select(path)
    rows = documents.join(F.broadcast(leave) if count["leave"] <= MANY_ROWS else leave, path, "left_anti")
    if not count["twice"]:
        return rows
    some = F.broadcast(twice) if count["twice"] <= MANY_ROWS else twice
    return rows.join(some, path, "left_anti").unionByName(rows.join(some, path, "left_semi").dropDuplicates([path]))
