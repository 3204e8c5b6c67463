"""Queries that read survey sheets and a mapping document: both are written from the tables first, with headers of their
own, in two encodings. The comparison SQL skips the files."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import functions as F

from tapeline.functions import numbers as N
from tapeline.operators import curate as C
from tapeline.plans.registry import query, table
from tapeline.sources import survey as V
from tapeline.sources.shared import scratch

RAW_IDS = """ids AS (SELECT o_orderkey, o_custkey, o_orderstatus, CASE o_orderpriority WHEN '1-URGENT' THEN CAST(o_custkey AS VARCHAR) || '.0'
    WHEN '2-HIGH' THEN CAST(o_custkey AS VARCHAR) || 'E3' WHEN '3-MEDIUM' THEN '  ' || lpad(CAST(o_custkey AS VARCHAR), 8, '0') || ' '
    WHEN '4-NOT SPECIFIED' THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS raw FROM orders)"""
CLEAN = """coalesce(CASE WHEN regexp_matches(trim(raw), '^[+-]?\\d+(\\.\\d+)?[eE][+-]?\\d+$')
  THEN CAST(TRY_CAST(trim(raw) AS DECIMAL(38,0)) AS VARCHAR) ELSE regexp_replace(trim(raw), '\\.0$', '') END, '')"""
MAPPING = """{"version": "2", "keys": [
  {"standard_key": "HUMAN_ID", "ko_term": "id", "sources": {"7th": {"column": "HUMAN_ID", "present": true}}},
  {"standard_key": "HEIGHT_M", "ko_term": "키", "sources": {"7th": {"column": "키", "present": true}, "8th_3d": {"column": "stature", "present": true}}},
  {"standard_key": "WAIST_CIRC_M", "ko_term": "허리둘레", "sources": {"7th": {"column": "허리둘레", "present": true}}},
  {"standard_key": "CHEST_DEPTH_M", "ko_term": "가슴두께", "sources": {"7th": {"column": "가슴두께__dup1", "present": true}}},
  {"standard_key": "NECK_CIRC_M", "ko_term": "목둘레", "sources": {"7th": {"column": null, "present": false}}},
  {"standard_key": "ARM_LEN_M", "ko_term": "팔길이", "sources": {"7th": {"column": "팔길이", "present": true}}}]}"""


def _encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of odd sheets in the older encoding, of even ones in UTF-8 with a byte order mark."""
    for batch in batches:
        sheet, place, text = (c.to_pylist() for c in batch.columns)
        raw = [t.encode("cp949") if s % 2 else (("\ufeff" if p == -5 else "") + t).encode() for s, p, t in zip(sheet, place, text)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(raw, pa.binary())], names=["sheet", "place", "value"])


def written_sheets(spark, sf) -> str:
    """``orders`` as twelve sheets: a title, a blank line, the header with its anchor, codes and a row of meta names. Sheets
    of every third number have no waist; one name stands twice."""
    o = table(spark, sf, "orders").withColumn("sheet", F.col("o_orderkey") % 12)
    k, p = F.col("o_custkey").cast("string"), F.col("o_orderpriority")
    raw = (
        F.when(p == "1-URGENT", F.concat(k, F.lit(".0"))).when(p == "2-HIGH", F.concat(k, F.lit("E3")))
        .when(p == "3-MEDIUM", F.concat(F.lit("  "), F.lpad(k, 8, "0"), F.lit(" "))).when(p == "4-NOT SPECIFIED", "").otherwise(k)
    )
    own = lambda yes, no: F.when(F.col("sheet") % 3 > 0, yes).otherwise(no)  # with a waist or without
    height = F.when(F.col("o_orderstatus") == "P", '"1,7"').otherwise(F.floor("o_totalprice").cast("string"))
    data = o.select(
        "sheet", F.col("o_orderkey").alias("place"),
        F.concat_ws(",", raw, height, own(F.date_format("o_orderdate", "DDD"), F.lit("x")), F.lit("a"), F.when(F.col("o_orderstatus") == "O", "b").otherwise("")).alias("text"),
    )
    head = [(-5, "조사 결과,2024", "조사,x"), (-4, "", " "), (-3, "표준 측정항목 명,키,허리둘레,가슴두께,가슴두께", "표준 측정항목 명,키,가슴,가슴두께,가슴두께"),
            (-2, "표준 측정항목 코드,A1,A2,A3,A4", "표준 측정항목 코드,A1,A2,A3,A4"), (-1, "HUMAN_ID,,,,", "HUMAN_ID,성별,,,")]
    lines = F.array(*[F.struct(F.lit(i).cast("long").alias("place"), own(F.lit(a), F.lit(b)).alias("text")) for i, a, b in head])
    heads = data.select("sheet").distinct().select("sheet", F.inline(lines))
    where = scratch(spark)
    (
        data.unionByName(heads).repartition("sheet").sortWithinPartitions("sheet", "place")
        .mapInArrow(_encoded, "sheet long, place long, value binary").select("sheet", F.col("value").cast("string"))
        .write.partitionBy("sheet").text(f"{where}/sheets")
    )
    spark.createDataFrame([(MAPPING,)], "value string").coalesce(1).write.text(f"{where}/mapping")
    return where


@query("clean_id", "P6 S1", f"WITH {RAW_IDS} SELECT {CLEAN} AS id, count(*) AS n FROM ids GROUP BY 1")
def clean_id(spark, sf):
    sheets = V.read_survey(spark, f"{written_sheets(spark, sf)}/sheets", source="7th")
    return sheets.rows.select(N.clean_id(F.col("fields")["HUMAN_ID"]).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("n"))


@query(
    "standardize", "P1 S1 S4",
    f"""WITH {RAW_IDS}, c AS (SELECT count(*) AS n, count(raw) AS n_id, count(*) FILTER (WHERE o_orderkey % 12 % 3 > 0) AS n_waist, count(*) FILTER (WHERE o_orderstatus = 'O') AS n_chest FROM ids)
SELECT 'HUMAN_ID' AS key, n_id AS n_values, '' AS reason, '' AS wanted FROM c UNION ALL SELECT 'HEIGHT_M', n, '', '' FROM c UNION ALL SELECT 'WAIST_CIRC_M', n_waist, '', '' FROM c
UNION ALL SELECT 'CHEST_DEPTH_M', n_chest, '', '' FROM c UNION ALL SELECT 'NECK_CIRC_M', 0, 'column_not_present', '' FROM c UNION ALL SELECT 'ARM_LEN_M', 0, 'column_not_found', '팔길이' FROM c""",
)
def standardize(spark, sf):
    where = written_sheets(spark, sf)
    sheets = V.read_survey(spark, f"{where}/sheets", source="7th")
    frame, notes = C.standardize(sheets.rows, sheets.names, V.read_mapping(spark, f"{where}/mapping"), "7th")
    counts = frame.unpivot([], frame.columns, "key", "v").groupBy("key").agg(F.count("v").alias("n_values"))
    text = lambda c: F.coalesce(c, F.lit("")).alias(c)
    return counts.join(notes.withColumnRenamed("column", "key"), "key", "left").select(
        "key", "n_values", text("reason"), F.coalesce("original_value", F.lit("")).alias("wanted")
    )
