"""Scalar column expressions: text codes, dates, geometry, seeded draws."""

from __future__ import annotations

import itertools
import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

def draw(purpose: str, *keys: Column | int) -> Column:
    """Reproducible draw in [0, 1), independent for every purpose and every key.

    48 bits of md5(purpose|key|...): SQL engines have the same function.
    """
    parts = [F.lit(purpose), *[(k if isinstance(k, Column) else F.lit(k)).cast("string") for k in keys]]
    digits = F.substring(F.md5(F.concat_ws("|", *parts)), 1, 12)
    return F.conv(digits, 16, 10).cast("bigint") / F.lit(float(1 << 48))


def prefix_code(name: Column, legacy: bool = True) -> Column:
    """Number from the first letters; the third term repeats the second letter when legacy."""
    head = F.lower(F.replace(F.substring(name, 1, 3), F.lit("'"), F.lit("z")))
    at = lambda i: F.ascii(F.substring(head, i, 1)) - F.lit(97)
    code = at(1) * 900 + at(2) * 30 + (at(2) if legacy else at(3))
    return F.when(head.rlike("^[a-z]{3}$"), code)


def strip_cast(text: Column, tokens: Sequence[str], to: str = "bigint") -> Column:
    for token in tokens:
        text = F.replace(text, F.lit(token), F.lit(""))
    return text.try_cast(to)


def first_digits(text: Column) -> Column:
    return F.regexp_extract(text, r"(\d+)", 1)


def zero_pad(x: Column, width: int = 4) -> Column:
    return F.lpad(x.cast("string"), width, "0")


def try_dates(text: Column, formats: Sequence[str]) -> Column:
    """First format that fits wins; text that fits none is null."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats]).cast("timestamp_ntz")


def polar_to_xy(r: Column, angle: Column) -> tuple[Column, Column]:
    return r * F.cos(angle), r * F.sin(angle)


def bearing(dx: Column, dy: Column) -> Column:
    """Clockwise from the top."""
    return F.atan2(dx, dy)


def recode(c: Column, codes: Mapping[str, str], keep_unmapped: bool = True) -> Column:
    pairs = F.create_map(*[F.lit(v) for kv in codes.items() for v in kv])
    mapped = F.try_element_at(pairs, c)
    return F.coalesce(mapped, c) if keep_unmapped else mapped


def ordered_overwrite(start: Column, rules: Sequence[tuple[Column, object]]) -> Column:
    """Later rules overwrite earlier ones; a null condition counts as false."""
    out = start
    for cond, value in rules:
        out = F.when(F.coalesce(cond, F.lit(False)), F.lit(value)).otherwise(out)
    return out


def clip(x: Column, lo: float, hi: float, missing: float | None = None) -> Column:
    bounded = F.when(x.isNotNull(), F.greatest(F.lit(lo), F.least(F.lit(hi), x)))
    return bounded if missing is None else F.coalesce(bounded, F.lit(missing))


def json_field(text: Column, field: str, default: str = "empty") -> Column:
    return F.coalesce(F.get_json_object(text, f"$.{field}"), F.lit(default))


def crosses(cols: Sequence[str], degree: int, hashed: bool = True) -> list[Column]:
    """One combined key per ``degree``-subset of columns, named a*b*c."""
    out = []
    for subset in itertools.combinations(cols, degree):
        parts = [F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in subset]
        key = F.xxhash64(*parts) if hashed else F.concat_ws("|", *parts)
        out.append(key.alias("_x_".join(subset)))
    return out


def equal_width_bin(x: Column, lo: float, hi: float, bins: int) -> Column:
    """0-based bin, right edge closed in the last one, null outside the range."""
    width = (hi - lo) / bins
    k = F.least(F.floor((x - lo) / width), F.lit(bins - 1))
    return F.when((x >= lo) & (x <= hi), k.cast("int"))


def direction_bin(dx: Column, dy: Column, step_deg: float) -> Column:
    """Half-circle direction bin, centred on 0, step, 2*step, ..."""
    step = math.radians(step_deg)
    raw = bearing(dx, dy)
    half = F.when(raw < 0, raw + math.pi).otherwise(raw)
    folded = F.when(half >= math.pi - step / 2, F.lit(0.0)).otherwise(half)
    last = int(180 / step_deg) - 1
    return F.least(F.floor((folded + step / 2) / step), F.lit(last)).cast("int")
