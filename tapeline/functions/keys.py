"""Predicates and names over standard measurement keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Meta keys, physical ranges in metres by key pattern, key words.
META_KEYS = ("HUMAN_ID", "SEX", "AGE")
HEIGHT_RANGE = (0.8, 2.5)
RANGE_BY_PART = (
    (("_CIRC_", "_ELLIPSIS_"), (0.2, 2.5)),
    (("_WIDTH_", "_DEPTH_"), (0.05, 1.0)),
    (("_LEN_", "_HEIGHT_"), (0.1, 1.5)),
)
MUST_TERMS = ("키", "몸무게", "가슴둘레", "허리둘레", "엉덩이둘레")
DIMENSION_WORDS = (
    ("circ", "둘레", ("circumference",)),
    ("width", "너비", ("width",)),
    ("depth", "두께", ("depth", "thickness")),
    ("length", "길이", ("length",)),
    ("height", "높이", ("height",)),
)
DIMENSION_SUFFIX = {"circ": "_CIRC_M", "width": "_WIDTH_M", "depth": "_DEPTH_M", "height": "_HEIGHT_M"}
HANGUL = "[가-힣]"


def is_meta(key: Column) -> Column:
    return key.isin(*META_KEYS)


def expects_meter(key: Column) -> Column:
    """True for length keys: ``_M`` anywhere, but neither a meta key nor a weight."""
    return ~is_meta(key) & ~key.endswith("_KG") & key.contains("_M")


def expected_unit(key: Column) -> Column:
    return F.when(key == "WEIGHT_KG", "kg").when(expects_meter(key), "m")


def _range_side(key: Column, side: int) -> Column:
    out = F.when(key == "HEIGHT_M", F.lit(HEIGHT_RANGE[side]))
    for parts, bounds in RANGE_BY_PART:
        hit = F.lit(False)
        for part in parts:
            hit = hit | key.contains(part)
        out = out.when(hit, F.lit(bounds[side]))
    return out


def physical_range(key: Column) -> tuple[Column, Column]:
    """Lower and upper plausible bound in metres, NULL when the key has none."""
    return _range_side(key, 0), _range_side(key, 1)


def has_hangul(c: Column) -> Column:
    return c.rlike(HANGUL)


def ko_term(name: Column) -> Column:
    """Last ``_`` part holding Hangul, else the last part."""
    parts = F.split(name, "_")
    with_hangul = F.filter(parts, lambda p: p.rlike(HANGUL))
    return F.trim(F.coalesce(F.try_element_at(with_hangul, F.lit(-1)), F.element_at(parts, -1)))


def dimension_type(term: Column, english: Column) -> Column:
    low = F.lower(F.coalesce(english, F.lit("")))
    out = None
    for name, korean, words in DIMENSION_WORDS:
        hit = term.contains(korean)
        for w in words:
            hit = hit | low.contains(w)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise("length")


def standard_key(term: Column, english: Column) -> Column:
    """Key name from the English term and the dimension suffix, or an unmatched marker."""
    dim = dimension_type(term, english)
    suffix = None
    for name, text in DIMENSION_SUFFIX.items():
        suffix = F.when(dim == name, text) if suffix is None else suffix.when(dim == name, text)
    stem = F.regexp_replace(F.upper(english), "[ -]", "_")
    known = english.isNotNull() & (english != "")
    return F.when(known, F.concat(stem, suffix.otherwise("_LENGTH_M"))).otherwise(
        F.concat(F.lit("UNMATCHED_"), F.regexp_replace(F.upper(term), " ", "_"))
    )


def priority(term: Column) -> Column:
    return F.when(term.isin(*MUST_TERMS), "must").otherwise("optional")
