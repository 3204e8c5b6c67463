"""Path and event-text expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Run path, code mark, change regions and allow list.
RUN_PATH = r"exports/runs/([^/]+)/([^/]+)(?:/|$)"
CODE_MARK = r"^\[([^\]]+)\]"
REGIONS = {
    "body": ("core/", "verification/", "modules/body/"),
    "fitting": ("modules/fitting/",),
    "garment": ("modules/garment/",),
}
ALLOWED = ("specs/", "docs/ops/rounds/", "tools/ops/")
LOCAL_ONLY = ("ops/local/", "exports/logs/")


def posix(path: Column) -> Column:
    return F.translate(path, "\\", "/")


def lane_of(path: Column) -> Column:
    return F.nullif(F.regexp_extract(posix(path), RUN_PATH, 1), F.lit(""))


def run_id_of(path: Column) -> Column:
    return F.nullif(F.regexp_extract(posix(path), RUN_PATH, 2), F.lit(""))


def module_lane(path: Column) -> Column:
    """Path part after ``facts``, else the parent folder."""
    p = posix(path)
    after = F.nullif(F.regexp_extract(p, r"(?:^|/)facts/([^/]+)", 1), F.lit(""))
    return F.coalesce(after, F.regexp_extract(p, r"([^/]+)/[^/]+/?$", 1))


def path_class(path: Column) -> Column:
    p = posix(path)
    return (
        F.when(p.contains("exports/runs"), "RUN_EVIDENCE")
        .when(p.contains("/samples/"), "SAMPLE")
        .when(F.lower(F.substring_index(p, "/", -1)).contains("manifest"), "MANIFEST")
        .otherwise("OTHER")
    )


def _starts(path: Column, prefixes: Sequence[str]) -> Column:
    out = F.lit(False)
    for p in prefixes:
        out = out | path.startswith(p)
    return out


def change_region(path: Column, allowed: Sequence[str] = ALLOWED) -> Column:
    """allowlisted, a module region, or other; the allow list (folders or single files) comes first."""
    p = posix(path)
    out = F.when(_starts(p, allowed), "allowlisted")
    for name, prefixes in REGIONS.items():
        out = out.when(_starts(p, prefixes), name)
    return out.otherwise("other")


def is_local_only(path: Column, entries: Sequence[str] = LOCAL_ONLY) -> Column:
    """The path is one of the entries or lies below one: never to be committed."""
    p = posix(path)
    out = F.lit(False)
    for entry in entries:
        folder = entry.rstrip("/")
        out = out | (p == folder) | p.startswith(folder + "/")
    return out


def mixes_regions(region: Column) -> Column:
    """Aggregate: the change touches the body region together with another module."""
    return F.bool_or(region == "body") & F.bool_or(region.isin("fitting", "garment"))


def is_safe_relative(path: Column) -> Column:
    """Relative, no drive letter, no step up."""
    return path.rlike(r"^(?!/)(?!\\)(?![A-Za-z]:)(?!.*\.\.).+$")


def glob_match(path: Column, pattern: str) -> Column:
    """``**`` stands for any middle; a single ``*`` or ``?`` as in a shell pattern over the whole path."""
    p = posix(path)
    pattern = pattern.replace("\\", "/")
    if "**" in pattern:
        head, tail = pattern.split("**", 1)
        head, tail = head.rstrip("/"), tail.lstrip("/")
        return p.startswith(head) & p.endswith(tail) & (F.length(p) >= len(head) + len(tail))
    special = {"*": ".*", "?": "."}
    body = "".join(special.get(ch) or ("\\" + ch if not ch.isalnum() and ch not in "/_-" else ch) for ch in pattern)
    return p.rlike(f"^{body}$")


def event_paths(*fields: Column) -> Column:
    """Paths of several array fields: cut at the first ``:``, forward slashes, no blanks, first kept."""
    every = F.flatten(F.array(*[F.coalesce(f, F.array().cast("array<string>")) for f in fields]))
    clean = F.transform(every, lambda p: F.trim(posix(F.trim(F.substring_index(p, ":", 1)))))
    return F.array_distinct(F.filter(clean, lambda p: p != ""))


def gate_codes(text: Column) -> Column:
    """Codes from a field that holds one JSON string or a JSON array of strings."""
    t = F.trim(text)
    listed = F.from_json(F.when(t.startswith("["), t), "array<string>")
    single = F.array(F.regexp_replace(t, '^"|"$', ""))
    codes = F.coalesce(F.when(t.startswith("["), listed).otherwise(single), F.array().cast("array<string>"))
    return F.filter(codes, lambda c: c.isNotNull() & (c != ""))


def warning_codes(warnings: Column) -> Column:
    """Leading ``[CODE]`` marks of warning texts."""
    return F.filter(F.transform(warnings, lambda w: F.regexp_extract(w, CODE_MARK, 1)), lambda c: c != "")


def log_facts(text: Column) -> Column:
    """Counts and warning names out of a log head: ``Rows: n``, ``Columns: n``, ``warnings: A, B``."""
    num = lambda p: F.regexp_extract(text, p, 1).try_cast("bigint")
    names = F.transform(F.split(F.regexp_extract(text, r"(?m)^warnings: *(.*)$", 1), ","), lambda s: F.trim(s))
    return F.struct(
        num(r"Rows: *(\d+)").alias("n_rows"), num(r"Columns: *(\d+)").alias("n_columns"),
        F.filter(names, lambda s: s != "").alias("warnings"),
    )


def normal_key(key: Column) -> Column:
    """Key for alias lookup: trimmed, lower case, runs of space, dash and underscore as one underscore."""
    k = F.regexp_replace(F.regexp_replace(F.lower(F.trim(key)), r"[\s\-]+", "_"), "_+", "_")
    k = F.regexp_replace(k, "^_+|_+$", "")
    return F.when(k != "", k).otherwise(key)


def fingerprint(*cols: str) -> Column:
    """sha256 of the JSON of the named columns in name order; leave creation times out of ``cols``."""
    return F.sha2(F.to_json(F.struct(*[F.col(c) for c in sorted(cols)])), 256)
