"""Names, identifiers and tolerant parsing of metadata."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def episode_name(i: Column) -> Column:
    return F.format_string("episode_%06d", i)


def chunk_name(i: Column, size: int = 1000) -> Column:
    return F.format_string("chunk-%03d", F.floor(i / F.lit(size)).cast("long"))


def number_of(path: Column) -> Column:
    """The number that is the file's stem; null if the stem is no number."""
    stem = F.regexp_extract(path, r"([^/]*?)(?:\.[^./]*)?$", 1)
    return F.when(stem.rlike("^[0-9]{1,18}$"), stem.try_cast("long"))


def natural_order(path: Column) -> list[Column]:
    """Sort keys: folder, then numbered stems by number, then the others by name."""
    return [F.regexp_extract(path, r"^(.*)/[^/]*$", 1), F.coalesce(number_of(path), F.lit(2**62)), path]


def safe_name(text: Column) -> Column:
    """Letters, digits, dot, dash and underscore; everything else becomes one underscore."""
    return F.regexp_replace(text, r"[^A-Za-z0-9._-]+", "_")


def decoded(data: Column) -> Column:
    """Bytes as UTF-8 text, NUL bytes at the end taken off."""
    return F.regexp_replace(F.decode(data, "UTF-8"), "\\x00+$", "")


def present(text: Column) -> Column:
    """Null for empty text, which counts as missing."""
    return F.nullif(text, F.lit(""))


def first_present(*texts: Column) -> Column:
    return F.coalesce(*[present(t) for t in texts])


def task_description(kind: Column, direction: Column, description: Column, description2: Column, fallback: Column) -> Column:
    """Reversible tasks have a second description for direction 2; missing ones fall back."""
    second = (F.lower(kind) == "reversible") & (direction == "2")
    return first_present(F.when(second, description2), description, fallback)


def reason_name(reason: Column) -> Column:
    return F.split(reason, "=")[0]


def annotation(text: Column) -> Column:
    """struct(text, start, end): a JSON object's fields, or the whole string as text where it is no JSON object."""
    parsed = F.from_json(text, "text string, label string, start double, `end` double", {"mode": "PERMISSIVE"})
    body = first_present(parsed["text"], parsed["label"], F.when(~F.ltrim(text).startswith("{"), text))
    return F.struct(body.alias("text"), parsed["start"].alias("start"), parsed["end"].alias("end"))


def intrinsics9(v: Column) -> Column:
    """fx, fy, cx, cy, width, height and three NaN from 4, 6, 9 (3 x 3) or 10 numbers; null for any other length.  For 4
    numbers and 3 x 3 the size is NaN."""
    nan = F.lit(float("nan"))
    at = lambda i: F.get(v, F.lit(i)).cast("double")
    tail = [nan, nan, nan]
    square = (F.size(v) == 9) & (at(8) == 1.0) & (at(1) == 0.0)
    return (
        F.when(F.size(v) == 4, F.array(*[at(i) for i in range(4)], nan, nan, *tail)).when(square, F.array(at(0), at(4), at(2), at(5), nan, nan, *tail))
        .when(F.size(v).isin(6, 9, 10), F.array(*[at(i) for i in range(6)], *tail))
    )


def scaled_intrinsics(v: Column, width: Column, height: Column) -> Column:
    """Intrinsics (fx, fy, cx, cy, w, h, ...) scaled to an image of ``width`` x ``height``; unchanged where their size is unknown."""
    at = lambda i: F.get(v, F.lit(i))
    known = ~F.isnan(at(4)) & ~F.isnan(at(5)) & (at(4) > 0) & (at(5) > 0)
    sx, sy = F.when(known, width / at(4)).otherwise(1.0), F.when(known, height / at(5)).otherwise(1.0)
    return F.concat(F.array(at(0) * sx, at(1) * sy, at(2) * sx, at(3) * sy, F.when(known, width.cast("double")).otherwise(at(4)), F.when(known, height.cast("double")).otherwise(at(5))), F.slice(v, 7, 3))
