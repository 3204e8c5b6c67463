"""Event logs, document trees and mesh text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeline.functions import times
from tapeline.operators.scale import first_k
from tapeline.sources.lines import number_rows, placed, read_lines
from tapeline.sources.shared import written

TEXTS = T.ArrayType(T.StringType())
EVENT_SCHEMA = T.StructType(
    [
        *[
            T.StructField(n, T.StringType())
            for n in ("ts", "module", "event_type", "event", "step_id", "round_id", "lane", "run_id", "note", "status",
                      "m_level", "gate_codes", "gate_code")
        ],
        *[T.StructField(n, TEXTS) for n in ("evidence_paths", "observed_paths", "evidence", "artifacts_touched", "warnings")],
        T.StructField("dod_done_delta", T.LongType()),
        T.StructField("dod_total", T.LongType()),
    ]
)


def as_object(text: str) -> Column:
    """Variant of a JSON object text, NULL for anything else."""
    return F.try_parse_json(F.when(F.ltrim(F.col(text)).startswith("{"), F.col(text)))


def read_events(spark: SparkSession, path: str, mode: str = "skip") -> DataFrame:
    """JSON-lines log with ``ordinal`` = line number. ``mode``: ``skip`` drops unreadable lines,
    ``report`` keeps them with ``bad_line`` true. Codes given as a string or a list stay JSON text."""
    lines = read_lines(spark, path).where(F.trim("value") != "")
    parsed = lines.withColumn("_v", as_object("value"))
    get = lambda f: F.try_variant_get("_v", f"$.{f.name}", f.dataType.simpleString()).alias(f.name)
    out = parsed.select(
        "file", F.col("line_no").alias("ordinal"), F.col("_v").isNull().alias("bad_line"),
        *[get(f) for f in EVENT_SCHEMA.fields if f.name not in ("event", "gate_code")],
        F.try_variant_get("_v", "$.event", "string").alias("_event"),
        *[F.get_json_object("value", f"$.{n}").alias(f"_{n}") for n in ("gate_codes", "gate_code")],
    )
    out = out.withColumns(
        {"event_type": F.coalesce("event_type", "_event"), "gate_codes": F.coalesce("_gate_codes", "_gate_code")}
    ).drop("_event", "_gate_codes", "_gate_code")
    return out.where(~F.col("bad_line")).drop("bad_line") if mode == "skip" else out


def read_documents(spark: SparkSession, root: str, name: str = "*.json") -> DataFrame:
    """One row per document below ``root``: path, its folder, text and the parsed variant; a file that
    is no JSON object keeps its row with a NULL variant."""
    files = spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter=name).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_modification_time").alias("modified"),
        F.regexp_replace("value", "^﻿", "").alias("doc"),
    )
    return files.select(
        "*", F.regexp_extract("path", "^(.*)/[^/]+$", 1).alias("folder"),
        as_object("doc").alias("v"),
    )


def latest_run(files: DataFrame, by: Sequence[str] = (), exclude: str | None = None, rank: Column | None = None) -> DataFrame:
    """Newest run path per group: by the time in the run id, else by modification time, or by ``rank``
    (such as the largest k). Paths with the ``exclude`` segment do not take part."""
    if exclude:
        files = files.where(~F.col("path").contains(f"/{exclude}/"))
    when = rank if rank is not None else F.coalesce(times.run_time(F.col("path")), F.col("modified"))
    return files.groupBy(*by).agg(F.max_by("path", F.struct(when.alias("w"), "path")).alias("path"))


def obj_tables(lines: DataFrame, min_face: int = 3) -> tuple[DataFrame, DataFrame]:
    """Mesh text lines (file, block, pos, value) to vertices and faces.

    ``v x y z`` lines number the vertices; face tokens ``a/b/c`` keep their first index, 1-based made
    0-based; unreadable tokens are skipped and faces below ``min_face`` indices dropped.
    """
    return _numbered(_parsed(lines), min_face)


def _parsed(lines: DataFrame) -> DataFrame:
    """(file, block, pos, type, x, y, z, idx) of the lines that begin with ``v`` or ``f``."""
    text = F.trim("value")
    at = lambda i: F.try_element_at(F.col("tok"), F.lit(i)).try_cast("double")
    idx = F.transform(
        F.slice("tok", 2, F.greatest(F.size("tok") - 1, F.lit(0))), lambda t: F.substring_index(t, "/", 1).try_cast("bigint") - 1
    )
    typed = lines.where(text.rlike(r"^[vf](\s|$)")).select("file", "block", "pos", F.substring(text, 1, 1).alias("type"), F.split(text, r"\s+").alias("tok"))
    return typed.select(
        "file", "block", "pos", "type", *[F.when(F.col("type") == "v", at(i)).alias(c) for i, c in enumerate("xyz", 2)],
        F.when(F.col("type") == "f", F.filter(idx, lambda i: i.isNotNull() & (i >= 0))).alias("idx"),
    )


def _numbered(parsed: DataFrame, min_face: int) -> tuple[DataFrame, DataFrame]:
    is_v = (F.col("type") == "v") & F.col("x").isNotNull() & F.col("y").isNotNull() & F.col("z").isNotNull()
    verts = number_rows(parsed, "vertex_id", is_v, first=0).select(F.col("file").alias("case_id"), "vertex_id", "x", "y", "z")
    keep = (F.col("type") == "f") & (F.size("idx") >= min_face)
    faces = number_rows(parsed, "face_id", keep, first=0).select(F.col("file").alias("case_id"), "face_id", "idx")
    return verts, faces


def read_obj(spark: SparkSession, path: str, min_face: int = 3) -> tuple[DataFrame, DataFrame]:
    """Vertices and faces of the mesh texts below ``path``, which may be many small files: listed, opened and parsed once, for
    both tables number their lines in two steps from the parsed lines in the shared folder."""
    return _numbered(written(_parsed(placed(spark.read.text(path, recursiveFileLookup=True)))), min_face)


def read_cases(spark: SparkSession, path: str) -> DataFrame:
    """Case manifest to one row per case."""
    schema = "schema_version string, meta_unit string, cases array<struct<case_id:string,mesh_path:string,verts_path:string>>"
    return spark.read.schema(schema).json(path, multiLine=True).select("meta_unit", F.inline("cases"))


def head_events(events: DataFrame, n: int) -> DataFrame:
    return first_k(events, ["file"], [F.asc("ordinal")], n, "_r").drop("_r")
