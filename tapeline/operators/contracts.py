"""Checks of run documents: each rule gives (label, severity) rows, which roll up per document.

A document is one row: its text and the parsed variant ``v`` (NULL when the text is no valid JSON).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeline.functions import paths as P
from tapeline.functions import times as T
from tapeline.operators.scale import first_k, sample_text

PASS, WARN, FAIL = "PASS", "WARN", "FAIL"

# The document contracts.
MANIFEST_VERSION = "geometry_manifest.v1"
MODULES = ("body", "fitting", "garment")
REQUIRED = (
    "schema_version", "module_name", "contract_version", "created_at", "inputs_fingerprint", "version_keys", "artifacts",
)
OPTIONAL = ("warnings", "warnings_path", "provenance_path")
VERSION_KEYS = ("snapshot_version", "semantic_version", "geometry_impl_version", "dataset_version")
U1_KEYS = ("BUST_CIRC_M", "WAIST_CIRC_M", "HIP_CIRC_M")
POSE = "PZ1"
INPUT_KINDS = ("npz", "glb_fallback")
DEGRADED = ("none", "high_warning_degraded")
GATE_FLAGS = ("negative_face_area_flag", "self_intersection_flag", "invalid_face_flag")
LIMITS = {"max_retry": 2, "iter_max_per_attempt": 100}
FINGERPRINT = r"^([0-9a-fA-F]{64}$|sha256:[0-9a-fA-F]+)"
ABSOLUTE = r"^(/|\\\\|[A-Za-z]:)"
NON_FINITE = r"[:\[,]\s*-?(NaN|Infinity)\s*[,\]}]"
SAMPLES_MAX = 5


def has_non_finite(text: Column) -> Column:
    """NaN or Infinity as a bare JSON value, looked for in the raw text."""
    return text.rlike(NON_FINITE)


def parse(df: DataFrame, text: str = "doc") -> DataFrame:
    """Adds ``v``; a document with NaN or Infinity, or one that is no object, does not parse."""
    whole = F.ltrim(F.col(text)).startswith("{") & ~has_non_finite(F.col(text))
    return df.withColumn("v", F.try_parse_json(F.when(whole, F.col(text))))


def _schema(v: Column, path: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(v, path, "variant"))


def _kind_of(s: Column) -> Column:
    return (
        F.when(s == "BOOLEAN", "boolean").when(s == "STRING", "string").when(s == "VOID", "null")
        .when(s.startswith("ARRAY"), "array").when(s.startswith("OBJECT"), "object").when(s.isNotNull(), "number")
    )


class Fields:
    """The parsed document as checks ask for it: ``read`` adds a column per field, so that each is looked up once however
    many checks use it. Spelled out in every check the lookups grow past the size of code that the JVM compiles."""

    def __init__(self, v: str = "v"):
        self.v, self.texts, self.kinds = F.col(v), [], []

    def isNotNull(self) -> Column:
        return self.v.isNotNull()

    def text(self, path: str) -> Column:
        self.texts += [path] if path not in self.texts else []
        return F.col(f"_text{self.texts.index(path)}")

    def kind(self, path: str) -> Column:
        self.kinds += [path] if path not in self.kinds else []
        return F.col("_kinds")[self.kinds.index(path)]

    def read(self, df: DataFrame) -> DataFrame:
        texts = [F.try_variant_get(self.v, p, "string").alias(f"_text{i}") for i, p in enumerate(self.texts)]
        schemas = F.array(*[_schema(self.v, p) for p in self.kinds]).cast("array<string>")
        return df.select("*", *texts, F.transform(schemas, _kind_of).alias("_kinds"))


def kind(v: Column | Fields, path: str) -> Column:
    """boolean, string, number, array, object or null; NULL when the path is absent."""
    return v.kind(path) if isinstance(v, Fields) else _kind_of(_schema(v, path))


def value(v: Column | Fields, path: str, type_: str) -> Column:
    return F.try_variant_get(v.v if isinstance(v, Fields) else v, path, type_)


def text(v: Column | Fields, path: str) -> Column:
    return v.text(path) if isinstance(v, Fields) else value(v, path, "string")


def flag(v: Column | Fields, path: str) -> Column:
    return F.when(kind(v, path) == "boolean", value(v, path, "boolean"))


def strings(v: Column | Fields, path: str) -> Column:
    return F.when(kind(v, path) == "array", value(v, path, "array<string>"))


def passes(cond: Column, otherwise: str = FAIL) -> Column:
    return F.when(F.coalesce(cond, F.lit(False)), PASS).otherwise(otherwise)


def check_rows(df: DataFrame, ids: Sequence[str], checks: dict[str, Column]) -> DataFrame:
    """One row per document and check; a NULL severity means the check does not apply."""
    items = F.array(*[F.struct(F.lit(k).alias("label"), c.alias("severity")) for k, c in checks.items()])
    return df.select(*ids, F.inline(items)).where(F.col("severity").isNotNull())


def checked(df: DataFrame, ids: Sequence[str], checks: Callable[..., dict[str, Column]], *beside: Column) -> DataFrame:
    """:func:`check_rows` of the documents ``v``: every field the checks ask for is read once."""
    fields = Fields()
    named = checks(fields, *beside)
    return check_rows(fields.read(df), ids, named)


def roll_up(rows: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Worst severity per document and how many checks reached it."""
    n = {s: F.count_if(F.col("severity") == s) for s in (FAIL, WARN, PASS)}
    worst = F.when(n[FAIL] > 0, FAIL).when(n[WARN] > 0, WARN).otherwise(PASS)
    count = F.when(n[FAIL] > 0, n[FAIL]).when(n[WARN] > 0, n[WARN]).otherwise(n[PASS])
    return rows.groupBy(*ids).agg(worst.alias("worst"), count.alias("n_worst"), F.count("*").alias("n_checks"))


def manifest_checks(v: Column | Fields) -> dict[str, Column]:
    version = text(v, "$.schema_version")
    created = F.when(kind(v, "$.created_at") == "string", text(v, "$.created_at"))
    fp = F.when(kind(v, "$.inputs_fingerprint") == "string", text(v, "$.inputs_fingerprint"))
    arts = strings(v, "$.artifacts")
    out = {
        "parse": passes(v.isNotNull()),
        "schema_version": passes(version == MANIFEST_VERSION),
        "module_name": passes(text(v, "$.module_name").isin(*MODULES)),
        "contract_version": passes((kind(v, "$.contract_version") == "string") & (text(v, "$.contract_version") != "")),
        "created_at": passes(T.created_at_code(created) == "OK"),
        "inputs_fingerprint": F.when(F.coalesce(fp, F.lit("")) == "", FAIL).when(fp.rlike(FINGERPRINT), PASS).otherwise(WARN),
        "artifacts": passes(arts.isNotNull() & ~F.exists(arts, lambda a: a.rlike(ABSOLUTE))),
    }
    for k in VERSION_KEYS:
        val = text(v, f"$.version_keys.{k}")
        out[f"version_keys:{k}"] = (
            F.when(F.coalesce(val, F.lit("")) == "", FAIL).when(val == "UNSPECIFIED", WARN).otherwise(PASS)
        )
    return {k: c if k == "parse" else F.when(v.isNotNull(), c) for k, c in out.items()}


def body_checks(v: Column | Fields) -> dict[str, Column]:
    meas = kind(v, "$.measurements") == "object"
    kinds = {k: kind(v, f"$.measurements.{k}") for k in U1_KEYS}
    nulls = sum((F.when(c == "null", 1).otherwise(0) for c in kinds.values()), F.lit(0))
    out = {
        "unit": passes(text(v, "$.unit") == "m"),
        "pose_id": passes(text(v, "$.pose_id") == POSE),
        "measurements": F.when(~F.coalesce(meas, F.lit(False)), FAIL),
        "missingness": F.when(meas, F.when(nulls == 0, PASS).otherwise(WARN)),
        "warnings": F.when(meas, passes(kind(v, "$.warnings") == "array", FAIL)),
    }
    for k, c in kinds.items():
        out[k] = F.when(meas, F.when(c == "null", WARN).when(c == "number", PASS).otherwise(FAIL))
    return out


def body_null_count(v: Column) -> Column:
    return sum(
        (F.when(F.coalesce(kind(v, f"$.measurements.{k}"), F.lit("null")) == "null", 1).otherwise(0) for k in U1_KEYS), F.lit(0)
    )


def fitting_checks(v: Column | Fields, has_npz: Column, has_glb: Column) -> dict[str, Column]:
    used = text(v, "$.garment_input_path_used")
    early, reason = kind(v, "$.early_exit"), kind(v, "$.early_exit_reason")
    no_reason = F.coalesce(reason, F.lit("null")) == "null"
    claimed = F.coalesce(used.isin(*INPUT_KINDS), F.lit(False))
    return {
        "input_priority": F.when(has_npz, passes(used == "npz")).when(has_glb, passes(used == "glb_fallback"))
        .when(claimed, WARN).otherwise(FAIL),
        "garment_input_path_used": passes(claimed),
        "early_exit": passes(early == "boolean"),
        "early_exit_reason": F.when(no_reason, F.when(flag(v, "$.early_exit"), WARN).otherwise(PASS)).otherwise(
            passes(reason == "string")
        ),
        "warnings_summary": passes(kind(v, "$.warnings_summary") == "array"),
        "degraded_state": passes(text(v, "$.degraded_state").isin(*DEGRADED)),
    }


def garment_checks(v: Column | Fields, has_mesh: Column) -> dict[str, Column]:
    flags = {f: flag(v, f"$.{f}") for f in GATE_FLAGS}
    gate = F.lit(False)
    for c in flags.values():
        gate = gate | F.coalesce(c, F.lit(False))
    out = {f: F.when(c.isNull(), FAIL).when(c, WARN).otherwise(PASS) for f, c in flags.items()}
    out["hard_gate"] = F.when(gate, WARN).otherwise(PASS)
    out["mesh"] = F.when(has_mesh, PASS).when(gate, WARN).otherwise(FAIL)
    return out


def chain_checks(v: Column | Fields) -> dict[str, Column]:
    """Limits keep their constants, a fingerprint names its algorithm, inputs are an npz or a mesh with
    measurements, all as relative paths, the signal time is strict."""
    rel = {p: F.coalesce(P.is_safe_relative(text(v, f"$.artifacts.{p}")), F.lit(False)) for p in ("npz_path", "mesh_path", "measurements_path")}
    out = {
        f"limits:{k}": F.when(kind(v, f"$.limits.{k}").isNotNull(), passes(value(v, f"$.limits.{k}", "double") == n))
        for k, n in LIMITS.items()
    }
    fp = F.coalesce(text(v, "$.inputs_fingerprint"), F.lit("")) != ""
    out["fingerprint_algo"] = F.when(fp, passes(F.coalesce(text(v, "$.fingerprint_algo"), F.lit("")) != ""))
    out["inputs"] = passes(rel["npz_path"] | (rel["mesh_path"] & rel["measurements_path"]))
    out["created_at"] = passes(T.created_at_code(text(v, "$.created_at")) == "OK")
    return out


WARNING_MAP = "map<string, struct<count: double, samples: array<string>, truncated: boolean>>"


def warning_summary_findings(df: DataFrame, ids: Sequence[str], doc: str) -> DataFrame:
    """Codes of a warning summary whose count is negative or absent, whose samples are absent or more
    than five, or whose ``truncated`` is no boolean."""
    w = df.select(*ids, F.explode(F.map_entries(F.from_json(doc, WARNING_MAP))).alias("e"))
    s = F.col("e.value")
    bad = F.array_compact(
        F.array(
            F.when(~F.coalesce(s["count"] >= 0, F.lit(False)), "count"),
            F.when(~F.coalesce(F.size(s["samples"]) <= SAMPLES_MAX, F.lit(False)), "samples"),
            F.when(s["truncated"].isNull(), "truncated"),
        )
    )
    return w.select(*ids, F.col("e.key").alias("code"), F.explode(bad).alias("problem"))


def warning_summary(warnings: DataFrame, by: Sequence[str], code: str, sample: str, order: Sequence[str]) -> DataFrame:
    """The producing side: per code the count, up to five samples, and whether more were left out."""
    counts = warnings.groupBy(*by, code).agg(F.count("*").alias("count"))
    shown = sample_text(warnings, [*by, code], [F.col(c) for c in order], SAMPLES_MAX, sample, "samples", "|")
    return counts.join(shown, [*by, code]).withColumn("truncated", F.col("count") > SAMPLES_MAX)


def required_checks(doc: Column, v: Column, spec: dict) -> dict[str, Column]:
    """Ledger-style checks from a specification: required fields, any-of groups, exact version, any
    key at top level or in one sub-object, unit under any of its names, no NaN."""
    keys = F.json_object_keys(doc)
    has = lambda names, ks=keys: F.arrays_overlap(ks, F.array(*[F.lit(n) for n in names]))
    out = {f"field:{f}": passes(F.array_contains(keys, f)) for f in spec.get("require_fields", [])}
    for i, group in enumerate(spec.get("require_any_fields", [])):
        out[f"any_of:{i}"] = passes(has(group))
    if spec.get("schema_version_exact"):
        out["schema_version"] = passes(text(v, "$.schema_version") == spec["schema_version_exact"])
    if spec.get("require_keys_any"):
        found = F.coalesce(has(spec["require_keys_any"]), F.lit(False))
        if spec.get("require_keys_any_in"):
            sub = F.json_object_keys(F.get_json_object(doc, "$." + spec["require_keys_any_in"]))
            found = found | F.coalesce(has(spec["require_keys_any"], sub), F.lit(False))
        out["keys_any"] = passes(found)
    if spec.get("unit_exact"):
        unit = F.coalesce(*[F.nullif(text(v, p), F.lit("")) for p in ("$.unit", "$.unit_of_measure", "$.units")])
        out["unit"] = passes(unit == spec["unit_exact"])
    if spec.get("no_nan"):
        out["no_nan"] = passes(~has_non_finite(doc))
    return out


def conformance(df: DataFrame, ids: Sequence[str], doc: str = "doc") -> DataFrame:
    """Audit of a manifest: missing, unknown, bad paths, schema errors; valid when none of the three."""
    v, keys = F.col("v"), F.json_object_keys(doc)
    missing = F.array_except(F.array(*[F.lit(k) for k in REQUIRED]), keys)
    vk = F.json_object_keys(F.get_json_object(doc, "$.version_keys"))
    sub = F.transform(
        F.array_except(F.array(*[F.lit(k) for k in VERSION_KEYS]), vk), lambda k: F.concat(F.lit("version_keys."), k)
    )
    extra = F.array_except(keys, F.array(*[F.lit(k) for k in (*REQUIRED, *OPTIONAL)]))
    paths = F.concat(
        F.coalesce(strings(v, "$.artifacts"), F.array().cast("array<string>")),
        F.array_compact(F.array(*[F.nullif(text(v, f"$.{p}"), F.lit("")) for p in OPTIONAL[1:]])),
    )
    bad = F.filter(paths, lambda p: ~P.is_safe_relative(p))
    errors = F.array_compact(
        F.array(
            F.when(~F.coalesce(text(v, "$.schema_version") == MANIFEST_VERSION, F.lit(False)), "schema_version"),
            F.when(~F.coalesce(text(v, "$.module_name").isin(*MODULES), F.lit(False)), "module_name"),
        )
    )
    out = df.select(
        *ids,
        F.concat(F.coalesce(missing, F.array(*[F.lit(k) for k in REQUIRED])), F.coalesce(sub, F.array().cast("array<string>"))).alias("missing"),
        F.coalesce(extra, F.array().cast("array<string>")).alias("extra"), bad.alias("bad_paths"), errors.alias("errors"),
    )
    return out.withColumn("valid", (F.size("missing") == 0) & (F.size("bad_paths") == 0) & (F.size("errors") == 0))


def common_mismatches(audit: DataFrame, group: str, k: int = 5) -> DataFrame:
    """Missing fields shared by invalid documents: in how many groups and documents, top ``k``."""
    m = audit.where(~F.col("valid")).select(group, F.explode("missing").alias("field"))
    agg = m.groupBy("field").agg(F.count_distinct(group).alias("n_groups"), F.count("*").alias("n"))
    return agg.orderBy(F.desc("n_groups"), F.desc("n"), "field").limit(k)


def run_minimum_set(files: DataFrame, minimum: int = 2) -> DataFrame:
    """Runs with fewer than ``minimum`` of the three document kinds, and a manifest that is not at root."""
    name = F.substring_index("path", "/", -1)
    has = {
        "has_manifest": name == "geometry_manifest.json",
        "has_facts": name.contains("facts_summary") & name.endswith(".json"),
        "has_readme": name.isin("RUN_README.md", "README.txt"),
    }
    agg = files.groupBy("run_id").agg(
        *[F.bool_or(c).alias(n) for n, c in has.items()],
        F.bool_or(has["has_manifest"] & (F.col("depth") == 0)).alias("root_manifest"),
        F.count("*").alias("n_files"),
    )
    n = sum((F.col(c).cast("int") for c in has), F.lit(0))
    return agg.withColumn("complete", n >= minimum).withColumn("root_missing", F.col("has_manifest") & ~F.col("root_manifest"))


def presence(files: DataFrame, kinds: dict[str, Column], by: Sequence[str]) -> DataFrame:
    return files.groupBy(*by).agg(
        *[F.bool_or(c).alias(f"has_{n}") for n, c in kinds.items()], F.count("*").alias("n_files")
    )


def distinct_warnings(documents: DataFrame, by: Sequence[str], place: str, texts: Sequence[str] = ("gate_codes", "warnings")) -> DataFrame:
    """(by, warning, n): every non-empty warning and gate code of the manifests of a group once, with its count and the
    ``first_place`` it stands at; a row each, so a group may have any number."""
    every = F.concat(*[F.coalesce(F.col(c), F.array().cast("array<string>")) for c in texts])
    long = documents.select(*by, place, F.explode(every).alias("warning")).where(F.col("warning") != "")
    return long.groupBy(*by, "warning").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first_place"))


def artifact_flags(paths: DataFrame, artifacts: dict[str, Sequence[str]], by: Sequence[str] = ()) -> DataFrame:
    """Per group one flag per artifact: does any path match one of its patterns."""
    aggs = []
    for name, patterns in artifacts.items():
        hit = F.lit(False)
        for p in patterns:
            hit = hit | P.glob_match(F.col("path"), p)
        aggs.append(F.bool_or(hit).alias(name))
    return paths.groupBy(*by).agg(*aggs)


def rule(tree: dict, observed: dict[str, Column]) -> Column:
    """An and / or / not / artifact_observed rule document as one Column over the flags."""
    t = tree.get("type")
    if t == "artifact_observed":
        return F.coalesce(observed.get(tree.get("artifact_id"), F.lit(False)), F.lit(False))
    if t == "not":
        return ~rule(tree.get("item") or {}, observed)
    if t in ("and", "or"):
        parts = [rule(i, observed) for i in tree.get("items") or []]
        out = F.lit(t == "and")
        for p in parts:
            out = (out & p) if t == "and" else (out | p)
        return out
    return F.lit(False)


def missing_artifacts(names: Sequence[str]) -> Column:
    return F.array_join(F.array_compact(F.array(*[F.when(~F.col(n), F.lit(n)) for n in names])), ",")


def unmet_dependencies(paths: DataFrame, ledger: Sequence[dict], by: Sequence[str] = ()) -> DataFrame:
    """Ledger rows of which no observed path matches any pattern: gate code per consumer.

    The ledger is a short document; its patterns become flags of one aggregation over the paths.
    """
    rows = [r for r in ledger if (r.get("enforcement_u1") or "").lower() == "warn" and r.get("required_paths_any")]
    flags = artifact_flags(paths, {f"d{i}": r["required_paths_any"] for i, r in enumerate(rows)}, by)
    items = F.array(
        *[
            F.when(
                ~F.col(f"d{i}"),
                F.struct(F.lit(r["consumer_module"]).alias("consumer"), F.lit(r["gate_code"]).alias("gate_code")),
            )
            for i, r in enumerate(rows)
        ]
    )
    return flags.select(*by, F.inline(F.array_compact(items)))


def scenario_checks(body: Column, fitting: Column, garment: Column, scenario: Column) -> dict[str, Column]:
    """Checks over the three joined documents of a scenario: ok, hardgate or degraded."""
    early, state, reason = flag(fitting, "$.early_exit"), text(fitting, "$.degraded_state"), text(fitting, "$.early_exit_reason")
    any_gate = F.lit(False)
    for f in GATE_FLAGS:
        any_gate = any_gate | F.coalesce(flag(garment, f"$.{f}"), F.lit(False))
    only = lambda name, c: F.when(scenario == name, c)
    return {
        "ok:early_exit": only("ok", passes(early == F.lit(False))),
        "ok:degraded_state": only("ok", passes(state == "none")),
        "hardgate:detected": only("hardgate", passes(any_gate)),
        "hardgate:early_exit": only("hardgate", passes(early)),
        "hardgate:reason": only("hardgate", passes(F.coalesce(reason, F.lit("")) != "", WARN)),
        "degraded:null_count": only("degraded", passes(body_null_count(body) >= 2)),
        "degraded:state": only("degraded", passes(state == DEGRADED[1])),
    }


def top_issues(rows: DataFrame, by: Sequence[str], k: int = 5) -> DataFrame:
    bad = rows.where(F.col("severity") != PASS).groupBy(*by, "label").agg(F.count("*").alias("n"))
    return first_k(bad, list(by), [F.desc("n"), F.asc("label")], k)


def ordered_warnings(warnings: DataFrame, column: str = "warning") -> DataFrame:
    """All warnings ordered by code, then by path, expected or id, then by themselves; ``code`` and ``place`` are added.

    Without such a field a warning's place is its whole text, without a code the text is the code. It is a range sort
    over all tasks; no warning is dropped, NULL comes first.
    """
    w = F.col(column)
    full = r"(?d)^\[([^\]]+)\].*\| (?:path|expected|id)=([^;]*)(?:;|$)"
    code, plain = F.regexp_extract(w, full, 1), F.regexp_extract(w, r"^\[([^\]]+)\]", 1)
    place = F.regexp_replace(F.regexp_extract(w, full, 2), r"(?U)^\s+|\s+$", "")
    return warnings.withColumns({
        "code": F.when(code != "", code).when(plain != "", plain).otherwise(w),
        "place": F.when(code != "", place).when(plain != "", w).when(w.isNotNull(), ""),
    }).orderBy("code", "place", column)
