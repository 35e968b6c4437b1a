"""Scalar Column functions: fps parsing, frame-count estimates, names, KPIs,
scale sweep, box clipping, frame timestamps.

Everything here builds native Catalyst expressions, so it stays inside
whole-stage codegen; nothing calls back into Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "parse_fps", "fps_is_valid", "fps_error", "frame_count_round", "frame_count_floor",
    "duration_from_count", "bytes_to_mb", "bytes_to_kb", "chunk_name", "frame_name",
    "frame_name_underscore", "basename", "strip_extension", "strip_quotes",
    "safe_ratio", "scale_at", "scaled_size", "clip_extent", "frame_pts_us", "idiv", "two_decimals",
    "N_SCALES", "SCALE_MIN", "SCALE_MAX",
]

# Fixed values of the multi-scale search: 25 evenly spaced scales from 0.8 to 2.0.
SCALE_MIN, SCALE_MAX, N_SCALES = 0.8, 2.0, 25

_RATIONAL = r"^(\d+)/(\d+)"
_STRICT_RATIONAL = r"^\s*[+-]?\d+\s*/\s*\d+\s*$"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_fps(text: Column | str, mode: str = "lenient") -> Column:
    """Frame rate from an ``avg_frame_rate`` text such as ``30000/1001``.

    ``lenient``: leading ``num/den`` -> num/den, 0 when den is 0; otherwise the
    text as a plain number; anything else 0.0.
    ``strict``: like a rational-number parser: a zero denominator or text that
    is neither a rational nor a number raises at runtime.
    """
    t = _c(text)
    num = F.regexp_extract(t, _RATIONAL, 1).try_cast("double")
    den = F.regexp_extract(t, _RATIONAL, 2).try_cast("double")
    plain = t.try_cast("double")
    if mode == "lenient":
        ratio = F.when(den == 0, F.lit(0.0)).otherwise(num / den)
        return F.when(t.rlike(_RATIONAL), ratio).otherwise(F.coalesce(plain, F.lit(0.0)))
    if mode == "strict":
        s_num = F.regexp_extract(t, r"^\s*([+-]?\d+)\s*/", 1).try_cast("double")
        s_den = F.regexp_extract(t, r"/\s*(\d+)\s*$", 1).try_cast("double")
        err = F.raise_error(F.concat(F.lit("invalid frame rate: "), F.coalesce(t, F.lit("NULL"))))
        return (F.when(t.rlike(_STRICT_RATIONAL) & (s_den != 0), s_num / s_den)
                 .when(~t.rlike(_STRICT_RATIONAL) & plain.isNotNull(), plain)
                 .otherwise(err.cast("double")))
    raise ValueError(f"unknown fps parse mode {mode!r}")


def fps_error(text: Column | str) -> Column:
    """Reason a strict parse would fail, or NULL when it succeeds."""
    t = _c(text)
    s_den = F.regexp_extract(t, r"/\s*(\d+)\s*$", 1).try_cast("double")
    return (F.when(t.isNull(), F.lit("missing"))
             .when(t.rlike(_STRICT_RATIONAL) & (s_den == 0), F.lit("zero denominator"))
             .when(~t.rlike(_STRICT_RATIONAL) & t.try_cast("double").isNull(), F.lit("not a number")))


def fps_is_valid(text: Column | str) -> Column:
    return fps_error(text).isNull()


def frame_count_round(duration_s: Column, fps: Column) -> Column:
    """``int(round(duration * fps))``: Python rounds half to even."""
    return F.bround(duration_s * fps, 0).cast("bigint")


def frame_count_floor(duration_s: Column, fps: Column) -> Column:
    """``int(fps * duration)`` (truncation; inputs are non-negative)."""
    return F.floor(fps * duration_s).cast("bigint")


def duration_from_count(frame_count: Column, fps: Column) -> Column:
    """Seconds = frames / fps; NULL when fps is 0."""
    return F.try_divide(frame_count.cast("double"), fps)


def bytes_to_mb(b: Column) -> Column:
    return b / F.lit(1024.0 * 1024.0)


def bytes_to_kb(b: Column) -> Column:
    return b / F.lit(1024.0)


def chunk_name(chunk_id: Column) -> Column:
    return F.format_string("chunk_%03d.mp4", chunk_id)


def frame_name(frame_no: Column) -> Column:
    return F.format_string("frame%06d.png", frame_no)


def frame_name_underscore(frame_no: Column) -> Column:
    return F.format_string("frame_%06d.png", frame_no)


def basename(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def strip_extension(name: Column) -> Column:
    return F.regexp_replace(name, r"\.[^./]*$", "")


def strip_quotes(s: Column) -> Column:
    """Remove surrounding double/single quotes and backticks."""
    return F.regexp_replace(s, "^[\"'`]+|[\"'`]+$", "")


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den with 0 for a zero or missing denominator."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def scale_at(ix: Column) -> Column:
    """Scale ``ix`` of the sweep, bit-identical to an evenly spaced float grid."""
    step = (F.lit(SCALE_MAX) - F.lit(SCALE_MIN)) / F.lit(float(N_SCALES - 1))
    return F.when(ix == N_SCALES - 1, F.lit(SCALE_MAX)).otherwise(F.lit(SCALE_MIN) + ix.cast("double") * step)


def scaled_size(dim: Column, scale: Column) -> Column:
    """``int(dim * scale)``."""
    return F.floor(dim.cast("double") * scale).cast("int")


def clip_extent(start: Column, extent: Column, limit: Column) -> Column:
    """Clip a box side to the frame: ``min(extent, limit - start)``."""
    return F.least(extent, limit - start)


def two_decimals(units: Column, per_one: int | Column) -> Column:
    """Text of ``units / per_one`` with two decimals, rounded half to even in
    exact integer arithmetic (non-negative integers; ``per_one`` a multiple
    of 100) — the same digits on every engine, unlike float formatting."""
    step = per_one // 100 if isinstance(per_one, int) else idiv(per_one, F.lit(100))
    step = F.lit(step) if isinstance(step, int) else step
    q, r = idiv(units, step), units % step
    up = (r * 2 > step) | ((r * 2 == step) & (q % 2 == 1))
    c = q + F.when(up, F.lit(1)).otherwise(F.lit(0))
    return F.concat(idiv(c, F.lit(100)).cast("string"), F.lit("."), F.lpad((c % 100).cast("string"), 2, "0"))


def idiv(a: Column, b: Column) -> Column:
    """Integer division truncating toward zero (SQL ``a div b``)."""
    return F.call_function("div", a, b)


def frame_pts_us(frame_no: Column, fps_num: Column, fps_den: Column) -> Column:
    """Presentation time of 1-based ``frame_no`` on a constant-rate grid,
    ``(frame_no - 1) / fps`` in microseconds, in exact integer arithmetic."""
    n = (frame_no.cast("bigint") - F.lit(1)) * F.lit(1000000) * fps_den.cast("bigint")
    return F.when(fps_num > 0, idiv(n, fps_num.cast("bigint")))
