"""Set operations over columns, sources and states, and first-match joins over names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeline.functions import paths as P
from tapeline.operators.scale import first_k, join_keys

GRAM = 3


def presence_matrix(names: DataFrame, sources: Sequence[str], name: str = "name", source: str = "source") -> DataFrame:
    """One row per name with a flag per source and the number of sources that have it."""
    flags = [F.bool_or(F.col(source) == s).alias(s) for s in sources]
    return names.groupBy(name).agg(*flags, F.count_distinct(source).alias("n_sources"))


def in_every(names: DataFrame, group: str, item: str) -> DataFrame:
    """Items present in every group."""
    total = names.agg(F.count_distinct(group).alias("_all"))
    return (
        names.groupBy(item).agg(F.count_distinct(group).alias("_n"))
        .crossJoin(F.broadcast(total)).where(F.col("_n") == F.col("_all")).select(item)
    )


def beyond_common(names: DataFrame, group: str, item: str) -> DataFrame:
    """Per group the items that are not common to all groups."""
    return names.select(group, item).distinct().join(in_every(names, group, item), item, "left_anti")


def newly_true(now: DataFrame, before: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """Keys whose flag is true now and was not true before."""
    return now.where(flag).select(*keys).exceptAll(before.where(flag).select(*keys).distinct())


def containing(long: DataFrame, whole: str, short: DataFrame, part: str) -> DataFrame:
    """Pairs of rows where the text ``whole`` contains the text ``part``, without comparing all pairs.

    A text that contains another holds its first ``GRAM`` characters, so the pairs meet on those: an equi-join of
    the grams of the one with the start of the other, checked afterwards. An empty ``part`` is in every text.
    """
    size = F.least(F.length(part), F.lit(GRAM))
    text = F.col(whole)
    at = lambda n: F.transform(F.sequence(F.lit(1), F.length(text) - n + 1), lambda i: F.substring(text, i, F.lit(n)))
    grams = F.concat(F.array(F.lit("")), *[F.when(F.length(text) >= n, at(n)).otherwise(F.array().cast("array<string>")) for n in range(1, GRAM + 1)])
    held = long.where(text.isNotNull()).withColumn("_gram", F.explode(F.array_distinct(grams)))
    keyed = short.where(F.col(part).isNotNull()).withColumn("_gram", F.substring(F.col(part), F.lit(1), size))
    return held.join(keyed, "_gram").where(text.contains(F.col(part))).drop("_gram")


def first_match(terms: DataFrame, columns: DataFrame) -> DataFrame:
    """For each term the column named exactly so, else the first one that contains it or is contained.

    ``columns`` has (name, position); at most one row per term leaves.
    """
    exact = terms.join(columns, F.col("term") == F.col("name")).withColumn("kind", F.lit(0))
    inside = containing(columns, "name", terms, "term").unionByName(containing(terms, "term", columns, "name"))
    part = inside.where("term <> name").withColumn("kind", F.lit(1))
    hits = exact.unionByName(part)
    best = hits.groupBy("term").agg(F.min_by(F.struct("name", "kind"), F.struct("kind", "position")).alias("b"))
    return terms.join(best, "term", "left").select(
        "term", "b.name", F.when(F.col("b.kind") == 0, "exact").when(F.col("b.kind") == 1, "partial").otherwise("none").alias("match")
    )


def _grams(text: str) -> Column:
    """The pairs of neighbouring characters of a padded text, each numbered among equal ones."""
    padded = F.concat(F.lit("\1"), F.col(text), F.lit("\2"))
    pair = lambda i: F.substring(padded, i, F.lit(2))
    every = F.transform(F.sequence(F.lit(1), F.length(text) + 1), pair)
    return F.transform(every, lambda g, i: F.concat(g, F.size(F.filter(F.slice(every, 1, i + 1), lambda x: x == g)).cast("string")))


def _within(terms: DataFrame, names: DataFrame, held: DataFrame, radius: int) -> DataFrame:
    """All (term, name, distance) of at most ``radius`` edits, by an index of character pairs.

    An edit changes at most two pairs, so of any ``2 radius + 1`` pairs of a term one is left in a name that near: the
    pairs that the fewest names hold are looked up. Terms of fewer pairs meet the names of a fitting length.
    """
    size = 2 * radius + 1
    pairs = terms.where(F.length("term") >= 2 * radius).select("term", F.explode(_grams("term")).alias("gram"))
    rare = pairs.join(held.groupBy("gram").agg(F.count(F.lit(1)).alias("_n")), "gram", "left")
    probes = first_k(rare, ["term"], [F.coalesce("_n", F.lit(0)), F.col("gram")], size).select("term", "gram")
    met = probes.join(held, "gram").where(F.abs(F.length("term") - F.length("name")) <= radius).select("term", "name")
    short = terms.where(F.length("term") < 2 * radius).withColumn(
        "_size", F.explode(F.sequence(F.greatest(F.length("term") - radius, F.lit(0)), F.length("term") + radius))
    )
    met = met.unionByName(short.join(names.withColumn("_size", F.length("name")), "_size").select("term", "name")).distinct()
    return met.withColumn("distance", F.levenshtein("term", "name", radius)).where("distance >= 0")


def nearest_names(terms: DataFrame, columns: DataFrame, n: int = 3, radii: Sequence[int] = (2, 5)) -> DataFrame:
    """The ``n`` column names closest in spelling to each term (term, name, distance, rank), ties by name, among names of at
    most three times its length and eight characters more.

    The names within a small radius are looked up by their rarest character pairs; terms with fewer than ``n`` of them
    go on with the next radius, and those that are left meet the names of each fitting length. The result is that
    of comparing all pairs. NULL terms and names are left out, repeated ones count once.
    """
    names = columns.select("name").where("name IS NOT NULL").distinct()
    held = names.select("name", F.explode(_grams("name")).alias("gram"))
    left = terms.select("term").where("term IS NOT NULL").distinct()
    found = []
    for radius in radii:
        near = _within(left, names, held, radius)
        enough = near.groupBy("term").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= n).select("term")
        found.append(near.join(enough, "term", "left_semi"))
        left = left.join(enough, "term", "left_anti")
    sized = left.withColumn("_size", F.explode(F.sequence(F.lit(0), F.length("term") * 3 + 8)))
    rest = sized.join(names.withColumn("_size", F.length("name")), "_size").select("term", "name")
    found.append(rest.withColumn("distance", F.levenshtein("term", "name")))
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return first_k(every, ["term"], [F.asc("distance"), F.asc("name")], n)


def resolve_aliases(pairs: DataFrame, keymap: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Source keys to canonical ones: the first source key in sorted order wins, later ones lose the tie.

    ``keymap`` (alias, canonical) is a small dictionary; its aliases are normalised the same way.
    """
    known = keymap.select(P.normal_key(F.col("alias")).alias("_norm"), "canonical").distinct()
    hit = pairs.withColumn("_norm", P.normal_key(F.col("key"))).join(known, "_norm", "left")
    winner = hit.where(F.col("canonical").isNotNull()).groupBy(*ids, "canonical").agg(F.min("key").alias("_win"))
    out = join_keys(hit, winner, [*ids, "canonical"], "left")
    status = F.when(F.col("canonical").isNull(), "unmapped").when(F.col("key") == F.col("_win"), "mapped").otherwise("tie_broken")
    return out.select(*ids, "key", "canonical", status.alias("status"), "value")


def refresh_mapping(mapping: DataFrame, reference: DataFrame, overrides: DataFrame) -> DataFrame:
    """New column per (standard_key, source): explicit override, else the reference table, else kept."""
    k = ["standard_key", "source"]
    return (
        mapping.join(reference.select(*k, F.col("column").alias("_ref")), k, "left")
        .join(overrides.select(*k, F.col("column").alias("_over")), k, "left")
        .withColumn("column", F.coalesce("_over", "_ref", "column")).drop("_ref", "_over")
    )
