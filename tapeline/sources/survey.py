"""Survey sheets: encoding, header rows, data rows, header repair, scan sheets, mapping."""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapeline.functions import keys as K
from tapeline.functions import numbers as N
from tapeline.operators.curate import mapping_frame
from tapeline.sources.lines import BOM, number_rows, placed

# Header terms of the surveys, rows to look at, default header row by source and of others, meta line.
ANCHOR = "표준 측정항목 명"
CODE_TERM = "표준 측정항목 코드"
META_TOKENS = ("성별", "SEX", "ID", "HUMAN_ID", "HUMAN ID", "나이")
MAX_HEADER_ROWS = 20
DEFAULT_HEADERS = {"7th": 6, "8th_direct": 6, "8th_3d": 6}
DEFAULT_HEADER = 4
NUMERIC_PREFIX = r"^\d+\.?\d*\s*"
ENCODINGS = ("utf-8", "cp949")
SCAN_META = r"sex\s*:\s*([A-Za-z]+)\s*/\s*age\s*:\s*(\d+)"
SCAN_PRECISION = 3


class Sheets(NamedTuple):
    """Survey sheets as rows: data (file, row_idx, fields: text by column name), names (file, position, name)."""

    rows: DataFrame
    names: DataFrame


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, row_idx, value, utf8): the raw lines of the sheets, blank ones left out, counted from 0, and whether
    every line of the file is UTF-8. Files are read in blocks; only a row per file is matched with the lines."""
    lines = placed(spark.read.text(path))
    valid = lines.groupBy("file").agg(F.bool_and(F.is_valid_utf8("value")).alias("utf8"))
    return number_rows(lines, "row_idx", keep=F.trim("value") != "", first=0).join(valid, "file").select(
        "file", "row_idx", F.col("value").cast("binary").alias("value"), "utf8"
    )


def split_cells(lines: DataFrame, encodings: Sequence[str] = ENCODINGS) -> DataFrame:
    """(file, row_idx, cells): each line decoded in the encoding of its file and cut at commas outside quotes.

    The first of ``encodings`` is that of files that are UTF-8, the last that of all others. Empty cells are NULL.
    """
    first, last = encodings[0], encodings[-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        csv.field_size_limit(1 << 30)
        for batch in batches:
            cells = []
            for raw, utf8, row in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(1).to_pylist()):
                text = raw.decode(first if utf8 else last, errors="replace")
                text = text.removeprefix(BOM) if row == 0 else text
                cells.append([c or None for c in next(csv.reader([text]), [])])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(cells, pa.list_(pa.string()))], names=["file", "row_idx", "cells"]
            )

    return lines.mapInArrow(run, "file string, row_idx long, cells array<string>")


def head_cells(rows: DataFrame, by: Sequence[str] = ("file",)) -> DataFrame:
    """Rows of cells as one row per cell: (by, row_idx, col_idx, cell)."""
    return rows.select(*by, "row_idx", F.posexplode("cells").alias("col_idx", "cell"))


def locate_header_rows(
    cells: DataFrame, by: Sequence[str] = ("file",), anchor: str = ANCHOR, code_term: str = CODE_TERM,
    tokens: Sequence[str] = META_TOKENS, strip_prefix: bool = False, default: Column | None = None,
) -> DataFrame:
    """Primary row (a cell equals the anchor), code row (the next row, when it holds the code term) and
    secondary row (first of the next six rows with a meta token). Where no anchor is found ``default``, an
    expression of the ``by`` columns, is the primary row and ``header_defaulted`` is true."""
    by = list(by)
    cell = F.trim("cell")
    primary = cells.groupBy(*by).agg(F.min(F.when(cell == anchor, F.col("row_idx"))).alias("_p"))
    meta = F.regexp_replace(cell, NUMERIC_PREFIX, "") if strip_prefix else cell
    token = F.lit(False)
    for t in tokens:
        token = token | meta.contains(t)
    near = cells.join(primary, by)
    after = F.col("row_idx") - F.col("_p")
    return near.groupBy(*by).agg(
        F.coalesce(F.max("_p"), F.lit(DEFAULT_HEADER) if default is None else default).alias("primary"),
        F.min(F.when((after == 1) & cell.contains(code_term), F.col("row_idx"))).alias("code"),
        F.min(F.when(after.between(1, 6) & token, F.col("row_idx"))).alias("secondary"),
        F.max("_p").isNull().alias("header_defaulted"),
    )


def default_header(source: Column) -> Column:
    """The header row of a source whose sheet shows none."""
    known = F.create_map(*[F.lit(x) for kv in DEFAULT_HEADERS.items() for x in kv])
    return F.coalesce(F.try_element_at(known, source), F.lit(DEFAULT_HEADER))


def cut_header(rows: DataFrame, header: DataFrame, by: Sequence[str] = ("file",)) -> DataFrame:
    """Data rows only: those after the last header row of their file."""
    last = F.greatest("primary", F.coalesce("code", F.lit(-1)), F.coalesce("secondary", F.lit(-1)))
    return rows.join(header.select(*by, last.alias("_last")), list(by)).where(F.col("row_idx") > F.col("_last")).drop("_last")


def _unique(names: Column) -> Column:
    """Names of one header with an ordinal suffix behind repeated ones."""
    count = lambda x, i: F.size(F.filter(F.slice(names, 1, i), lambda y: y == x))
    return F.transform(names, lambda x, i: F.when(count(x, i) == 0, x).otherwise(F.concat(x, F.lit("__dup"), count(x, i).cast("string"))))


def read_survey(
    spark: SparkSession, path: str, strip_prefix: bool = False, source: str | None = None, max_check: int = MAX_HEADER_ROWS,
    encodings: Sequence[str] = ENCODINGS,
) -> Sheets:
    """The sheets at ``path``, each in its own encoding and under the names of its own header.

    A name is the cell of the primary header row or, where that is blank or the anchor, of the secondary row;
    columns without one are ``_c`` and their position, repeated names get a suffix. A sheet without the anchor in its
    first ``max_check`` rows has the header row of its source. Headers are found by plans over the first rows of all
    files; nothing is collected, and a row carries its texts by name, so sheets with different columns are one
    table. Blocks of a file are decoded where they are read.
    """
    lines = numbered_lines(spark, path)
    first = split_cells(lines.where(F.col("row_idx") < max_check), encodings)
    header = locate_header_rows(head_cells(first), strip_prefix=strip_prefix, default=default_header(F.lit(source)))
    near = first.join(header, "file")
    at = lambda row: F.first(F.when(F.col("row_idx") == F.col(row), F.col("cells")), ignorenulls=True)
    pair = near.groupBy("file").agg(at("primary").alias("top"), at("secondary").alias("low"), F.max(F.size("cells")).alias("width"))

    def name(i):
        top, low = (F.coalesce(F.trim(F.get(c, i)), F.lit("")) for c in ("top", "low"))
        blank = F.concat(F.lit("_c"), i.cast("string"))
        return F.when((low != "") & top.isin("", ANCHOR), low).when(top != "", top).otherwise(blank)

    size = F.greatest(F.coalesce(F.size("top"), F.lit(0)), F.coalesce(F.size("low"), F.lit(0)))
    every = pair.withColumn("names", F.when(size > 0, F.transform(F.sequence(F.lit(0), size - 1), name)).otherwise(F.array().cast("array<string>")))
    every = every.withColumn("names", _unique(F.col("names"))).select("file", "names")
    data = split_cells(cut_header(lines, header), encodings).join(every, "file")
    late = lambda i: F.concat(F.lit("_c"), i.cast("string"), F.when(F.array_contains("names", F.concat(F.lit("_c"), i.cast("string"))), "__late").otherwise(""))
    keys = F.transform("cells", lambda c, i: F.coalesce(F.get("names", i), late(i)))
    fields = F.map_from_arrays(keys, F.transform("cells", lambda c: F.trim(c)))
    return Sheets(data.select("file", "row_idx", fields.alias("fields")), every.select("file", F.posexplode("names").alias("position", "name")))


def dedupe_names(names: Sequence[str]) -> list[str]:
    """Ordinal suffix for repeated names of one header (a few hundred at most)."""
    seen: dict[str, int] = {}
    out = []
    for n in names:
        seen[n] = seen.get(n, -1) + 1
        out.append(n if seen[n] == 0 else f"{n}__dup{seen[n]}")
    return out


def dedupe_name_rows(names: DataFrame, by: Sequence[str], name: str = "name", position: str = "position") -> DataFrame:
    """The same over header rows as data: suffix from the rank within equal names."""
    w = Window.partitionBy(*by, name).orderBy(position)
    n = F.row_number().over(w) - 1
    return names.where(F.trim(name) != "").withColumn(
        "unique_name", F.when(n == 0, F.col(name)).otherwise(F.concat(F.col(name), F.lit("__dup"), n.cast("string")))
    )


def score_header_rows(cells: DataFrame, by: Sequence[str] = ("file", "row_idx"), cell: str = "cell") -> DataFrame:
    """Header score of each row: 40 x filled + 30 x distinct + 20 x Hangul + 10 x (1 - duplicated)."""
    v = F.trim(cell)
    filled = F.when(F.coalesce(v, F.lit("")) != "", v)
    per = cells.groupBy(*by, filled.alias("_v")).agg(
        F.count("*").alias("_n"),
        F.count_if(F.col(cell).startswith("Unnamed:")).alias("_u"),
    )
    named = F.col("_v").isNotNull()
    g = per.groupBy(*by).agg(
        F.sum("_n").alias("n_cells"),
        F.sum(F.when(named, F.col("_n"))).alias("n_filled"),
        F.sum(F.when(~named, F.col("_n")).otherwise(F.col("_u"))).alias("n_blank"),
        F.count_if(named).alias("n_unique"),
        F.sum(F.when(named & K.has_hangul(F.col("_v")), F.col("_n")).otherwise(0)).alias("n_hangul"),
        F.count_if(named & (F.col("_n") > 1)).alias("n_repeated"),
    )
    score = (
        (1 - N.ratio(F.col("n_blank"), F.col("n_cells"))) * 40
        + N.ratio(F.col("n_unique"), F.col("n_cells")) * 30
        + N.ratio(F.col("n_hangul"), F.col("n_filled")) * 20
        + F.when(F.col("n_filled") > 1, (1 - N.ratio(F.col("n_repeated"), F.col("n_unique"))) * 10).otherwise(0.0)
    )
    return g.withColumn("score", F.when(F.coalesce("n_filled", F.lit(0)) == 0, 0.0).otherwise(score))


def best_header_row(scores: DataFrame, by: Sequence[str] = ("file",)) -> DataFrame:
    return scores.groupBy(*by).agg(
        F.max_by(F.struct("row_idx", "score"), F.struct(F.round("score", 9), (-F.col("row_idx")).alias("r"))).alias("b")
    ).select(*by, "b.row_idx", "b.score")


def merge_headers(cells: DataFrame, by: Sequence[str], upper: int, lower: int) -> DataFrame:
    """Two header rows as one: ``upper_lower``, or only the lower one when the upper row looks like codes
    (more than half of its filled cells are plain ASCII codes)."""
    by = list(by)
    pick = lambda r: F.max(F.when(F.col("row_idx") == r, F.trim("cell")))
    pair = cells.groupBy(*by, "col_idx").agg(pick(upper).alias("u"), pick(lower).alias("l")).na.fill("", ["u", "l"])
    plain = F.col("u").rlike(r"(?i)^[A-Z0-9\-_\[\]]+$")
    codes = pair.where("u <> ''").groupBy(*by).agg((F.count_if(plain) > F.count("*") * 0.5).alias("codes"))
    joined = pair.join(codes, by, "left")
    both = F.concat("u", F.lit("_"), "l")
    name = F.when((F.col("l") != "") & ((F.col("u") == "") | F.coalesce("codes", F.lit(False))), F.col("l")).when(
        (F.col("u") != "") & (F.col("l") != ""), both
    ).otherwise(F.col("u"))
    return joined.select(*by, "col_idx", name.alias("name"))


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    """Mapping document as rows; see :func:`tapeline.operators.curate.mapping_frame`."""
    schema = (
        "keys array<struct<standard_key:string,ko_term:string,"
        "sources:map<string,struct<`column`:string,present:boolean>>>>"
    )
    return mapping_frame(spark.read.schema(schema).json(path, multiLine=True))


def scan_to_long(df: DataFrame, meta: str, raw_unit: str = "mm", major: Sequence[str] | None = None) -> DataFrame:
    """Scan sheet rows (no, code, name, value text, meta line) to long rows in metres.

    The value is rounded half to even, as the scan tables are; all-empty rows are dropped.
    """
    m = F.col(meta)
    blank = lambda c: F.nullif(F.trim(c), F.lit(""))
    rows = df.where(F.coalesce(*[blank(c) for c in ("no", "code", "name", "value")]).isNotNull())
    if major is not None:
        rows = rows.where(F.col("name").isin(*major))
    return rows.select(
        *[c for c in df.columns if c not in ("no", "code", "name", "value", meta)],
        F.upper(F.regexp_extract(m, SCAN_META, 1)).alias("sex"),
        F.regexp_extract(m, SCAN_META, 2).try_cast("int").alias("age"),
        *[F.trim(F.coalesce(c, F.lit(""))).alias(c) for c in ("no", "code", "name")],
        F.bround(N.finite(N.to_double(F.col("value"))) / N.UNIT_DIVISOR[raw_unit], SCAN_PRECISION).alias("value_m"),
    )


def limit_rows(df: DataFrame, n: int, order: str = "row_idx") -> DataFrame:
    """Row cap of a test run (a feature of the job, never a guard of this library)."""
    return df.orderBy(order).limit(n)
