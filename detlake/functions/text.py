"""String, date and JSON column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: run identifier and checkpoint file name formats
RUN_ID = r"^(\d{4})_(\d{2})_(\d{2})_(\d{3})$"
CHECKPOINT_NAME = r"^(best|latest|last_epoch|last_mosaic_epoch|epoch_(\d+))_ckpt\.pth$"


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def file_stem(path: Column) -> Column:
    """Last path part without its final extension; a leading dot is part of the stem."""
    name = file_name(path)
    return F.regexp_replace(name, r"(?<=.)\.[^.]+$", "")


def uid(*parts) -> Column:
    return F.concat_ws(":", *[p if isinstance(p, Column) else F.lit(p) for p in parts])


def is_run_id(c: Column) -> Column:
    return c.rlike(RUN_ID)


def run_id_date(c: Column) -> Column:
    part = [F.regexp_extract(c, RUN_ID, i) for i in (1, 2, 3)]
    return F.when(is_run_id(c), F.try_to_date(F.concat_ws("-", *part)))


def run_id_number(c: Column) -> Column:
    return F.when(is_run_id(c), F.regexp_extract(c, RUN_ID, 4).try_cast("int"))


def name_tokens(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), r"[_\-]+", " ")


def checkpoint_kind(name: Column) -> Column:
    kind = F.regexp_extract(name, CHECKPOINT_NAME, 1)
    return (F.when(kind == "", F.lit("unknown")).when(kind.rlike(r"^epoch_\d+$"), F.lit("every_n")).otherwise(kind))


def checkpoint_epoch(name: Column) -> Column:
    return F.regexp_extract(name, CHECKPOINT_NAME, 2).try_cast("int")


def parse_iso(c: Column) -> Column:
    """UTC timestamp from ISO text, NULL when it cannot be read."""
    return F.coalesce(F.try_to_timestamp(c, F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'")), c.try_cast("timestamp"))


def format_iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def bbox_to_json(x: Column, y: Column, w: Column, h: Column) -> Column:
    return F.to_json(F.array(x, y, w, h))


def bbox_from_json(text: Column) -> Column:
    """ARRAY<DOUBLE> of length four, NULL otherwise."""
    arr = F.from_json(text, "array<double>")
    return F.when(F.size(arr) == 4, arr)


def canonical_double(c: Column) -> Column:
    """Six decimals, no negative zero, so equal settings hash equally."""
    r = F.bround(c.cast("double"), 6)
    return F.when(r == 0, F.lit(0.0)).otherwise(r)


def eta_clock(seconds: Column) -> Column:
    s = F.greatest(F.lit(0), F.bround(seconds.cast("double"), 0).cast("bigint"))
    text = F.format_string("%02d:%02d:%02d", F.floor(s / 3600).cast("bigint"), F.floor(s % 3600 / 60).cast("bigint"),
                           (s % 60).cast("bigint"))
    return F.when(seconds.isNull(), F.lit("?")).otherwise(text)


def under_protected_root(path: Column) -> Column:
    parts = F.split(path, "/")
    return F.array_contains(parts, "raw") & F.array_contains(parts, "datasets")


def safe_div(num: Column, den: Column) -> Column:
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def f1_score(p: Column, r: Column) -> Column:
    return F.when(p + r > 0, F.lit(2.0) * p * r / (p + r)).otherwise(F.lit(0.0))


def fixed_six(v: Column) -> Column:
    """Six decimals of a double, rounded by its exact binary value and to even on true ties, as `%.6f` does in C.

    `v * 1e6` is split into a double and its exact rounding error (26-bit halves; 1e6 has 14 significant bits), so a
    value that only looks like a tie in its shortest decimal form still rounds to its own side.
    """
    a = F.abs(v)
    spread = a * F.lit(134217729.0)
    high = spread - (spread - a)
    low = a - high
    scaled = a * F.lit(1e6)
    error = (high * F.lit(1e6) - scaled) + low * F.lit(1e6)
    whole = F.floor(scaled)
    part = scaled - whole
    tie = part == 0.5
    up = (part > 0.5) | (tie & (error > 0)) | (tie & (error == 0) & (whole % 2 == 1))
    n = whole + F.when(up, 1).otherwise(0)
    digits = F.concat(F.floor(n / 1_000_000).cast("string"), F.lit("."), F.lpad((n % 1_000_000).cast("string"), 6, "0"))
    return F.when(v < 0, F.concat(F.lit("-"), digits)).otherwise(digits)
