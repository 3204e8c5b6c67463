"""The corpus queries: thin steps that map the given tables to the operators and their results back."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeline.llm import alignment, bpe, digests, fragments, jaccard, licenses, packing, periods, quality, search, secret_scan, shared, toxicity, warc
from tapeline.llm.tables import crc_of, run_documents, vocabulary_file

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_sum_of_squares_packing(spark: SparkSession, sf: str) -> DataFrame:
    packed = packing.pack_documents(run_documents(spark, sf), vocabulary_file("byte_bpe_50k.json"))
    return packed.withColumnRenamed("path", "doc_id")


@query
def op2_sharded_warc_writer(spark: SparkSession, sf: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    folder = f"{shared.shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    warc.write_archives(pages, folder, "page_id", "html", "url")
    return warc.read_archives(spark, folder, "page_id", pages.schema["page_id"].dataType)


ORACLE["op2_sharded_warc_writer"] = """
WITH rows AS (
    SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages
), led AS (
    SELECT *, max(page_id) OVER (PARTITION BY payload) AS leader FROM rows
)
SELECT page_id, CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda i:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                  1 + ((CAST('0x' || substr(hex, 1 + 5 * (i // 4), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31)::BIGINT, 1)),
           'string_agg', '') AS payload_digest,
       CASE WHEN page_id < leader THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < leader THEN leader END AS refers_to
FROM led
"""


@query
def op3_quality_kernel_ridge(spark: SparkSession, sf: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf}/labels.parquet").select(
        F.col("doc_id").alias("path"), F.col("quality").alias("accepted")
    )
    scores = quality.quality_scores(run_documents(spark, sf), labels, F.pmod(crc_of("path"), F.lit(4)) != 2)
    return scores.select(
        F.col("path").alias("doc_id"), (F.pmod(crc_of("path"), F.lit(4)) == 2).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


@query
def op4_quartile_bucket_digest(spark: SparkSession, sf: str) -> DataFrame:
    return digests.document_digests(run_documents(spark, sf)).withColumnRenamed("path", "doc_id")


@query
def op5_block_max_wand(spark: SparkSession, sf: str) -> DataFrame:
    """Every document whose id is divisible by 100 is a query against all documents."""
    documents = run_documents(spark, sf)
    asked = documents.where("path % 100 = 0").withColumnRenamed("path", "query")
    return search.search_documents(documents, asked).withColumnsRenamed({"query": "query_id", "path": "doc_id"})


ORACLE["op5_block_max_wand"] = r"""
WITH words AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
    FROM documents
), tf AS (
    SELECT doc_id, word, count(*) AS tf FROM words GROUP BY doc_id, word
), lengths AS (
    SELECT doc_id, sum(tf) AS len FROM tf GROUP BY doc_id
), corpus AS (
    SELECT (SELECT count(*) FROM documents) AS n, (SELECT sum(len) FROM lengths) / (SELECT count(*) FROM documents) AS average
), idf AS (
    SELECT word, ln(1 + (any_value(n) - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM tf, corpus GROUP BY word
), scored AS (
    SELECT q.doc_id AS query_id, d.doc_id,
           round(sum(idf * d.tf * 2.2 / (d.tf + 1.2 * (0.25 + 0.75 * len / average))), 6) AS score
    FROM tf q JOIN tf d USING (word) JOIN idf USING (word) JOIN lengths ON lengths.doc_id = d.doc_id, corpus
    WHERE q.doc_id % 100 = 0
    GROUP BY q.doc_id, d.doc_id
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) <= 10
"""


@query
def op6_recursive_query_bpe(spark: SparkSession, sf: str) -> DataFrame:
    found = bpe.encode_documents(run_documents(spark, sf), vocabulary_file("byte_bpe_multi_50k.tiktoken"), decode=True)
    return found.select(
        F.col("path").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op7_forest_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    """The tables hold no reviewed findings, so those whose form settles them are the labelled ones."""
    found = secret_scan.scan_secrets(run_documents(spark, sf))
    return found.select(
        F.col("path").alias("doc_id"), "start", "length", "kind", secret_scan.digest("value").alias("value_sha256"), "score", "secret"
    )


@query
def op8_patience_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.scan_licenses(run_documents(spark, sf)).withColumnRenamed("path", "doc_id")


@query
def op9_noisy_channel_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf}/labels.parquet").select(F.col("doc_id").alias("path"), "toxic")
    scores = toxicity.toxicity_scores(run_documents(spark, sf), labels, F.pmod(crc_of("path"), F.lit(5)) != 0)
    return scores.select(
        F.col("path").alias("doc_id"), (F.pmod(crc_of("path"), F.lit(5)) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query
def op10_ngram_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    found = jaccard.jaccard_components(run_documents(spark, sf))
    return found.select(F.col("path").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))


ORACLE["op10_ngram_jaccard_join"] = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS w
    FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [w]
                        ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: w[i:i + 4])) END AS s
    FROM words
), items AS (
    SELECT doc_id, len(s) AS n, unnest(s) AS item FROM sets
), shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common_n, any_value(a.n) AS na, any_value(b.n) AS nb
    FROM items a JOIN items b ON a.item = b.item AND a.doc_id < b.doc_id
    GROUP BY a.doc_id, b.doc_id
), links AS (
    SELECT a, b FROM shared WHERE 100 * common_n >= 75 * (na + nb - common_n)
), both_ways AS (
    SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
    SELECT doc_id AS a, doc_id AS c FROM sets
    UNION
    SELECT e.b, r.c FROM reach r JOIN both_ways e ON e.a = r.a WHERE r.c < e.b
)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, r.c AS component_id
FROM sets s JOIN (SELECT a, min(c) AS c FROM reach GROUP BY a) r ON r.a = s.doc_id
"""


@query
def op11_seeded_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Each tenth document by the CRC of its id gets its words from some place on repeated in turn before the search."""
    h = crc_of("path")
    words = F.filter(F.split("doc", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    cycled = """transform(sequence(0L, n - 1), i -> element_at(words, CAST(1 + if(i >= a, a + (i - a) % p, i) AS INT)))"""
    planted = (
        run_documents(spark, sf)
        .withColumn("words", F.when(h % 10 == 0, words))
        .withColumn("n", F.size("words").cast("long")).withColumn("g", F.floor(h / 10))
        .withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n"))).withColumn("p", F.expr("1 + (n - a) DIV (3 + g % 8)"))
        .withColumn("doc", F.when(F.col("n") > 0, F.concat_ws(" ", F.expr(cycled))).otherwise(F.col("doc")))
    )
    found = periods.periodic_runs(planted.select("path", "doc"))
    longest = F.array_max(F.expr("transform(runs, r -> struct(r.length AS length, -r.start AS start, -r.period AS period))"))
    lines = F.expr("concat_ws('', transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')))")
    return found.select("path", "runs", "collapsed", longest.alias("longest")).select(
        F.col("path").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), (-F.col("longest.start")).alias("start"),
        F.col("longest.length").alias("length"), (-F.col("longest.period")).alias("period"),
        F.expr("1000 * longest.length DIV -longest.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op12_forced_boundary_bpe(spark: SparkSession, sf: str) -> DataFrame:
    found = fragments.encode_by_fragments(run_documents(spark, sf), vocabulary_file("word_bpe_49k.json"), decode=True)
    return found.select(
        F.col("path").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op13_incidence_alignment(spark: SparkSession, sf: str) -> DataFrame:
    files = vocabulary_file("byte_bpe_50k.json"), vocabulary_file("piece_bpe_32k.model")
    found = alignment.align_tokenizers(run_documents(spark, sf), *files)
    return found.withColumnRenamed("path", "doc_id").withColumn(
        "groups_sha256", F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    ).drop("groups")
