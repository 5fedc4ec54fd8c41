"""Column functions that take recognised text apart: fixed-width records, numbers, points, paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: (field, first character from 1, length) of the 15-character records of each satellite family
LAYOUTS = {
    "v1": (("prefix", 1, 2), ("station_number", 3, 2), ("year", 5, 2), ("day_of_year", 7, 3), ("hour", 10, 2), ("minute", 12, 2), ("second", 14, 2)),
    "v2": (("satellite", 1, 1), ("frequency", 2, 1), ("station_number", 3, 2), ("year", 5, 2), ("day_of_year", 7, 3), ("hour", 10, 2), ("minute", 12, 2), ("second", 14, 2)),
    "v3": (("satellite", 1, 2), ("station_number", 3, 2), ("year", 5, 2), ("day_of_year", 7, 3), ("hour", 10, 2), ("minute", 12, 2), ("second", 14, 2)),
}
RECORD_LENGTH = 15


def as_int(text: Column) -> Column:
    """Integer of a text of digits, else null."""
    return F.when(F.rlike(text, F.lit("^[0-9]+$")), text.try_cast("int"))


def fixed_width(text: Column, layout: str) -> dict[str, Column]:
    """Integer fields of a record, all null unless it has 15 characters (and, for v1, begins with 10)."""
    whole = F.length(text) == RECORD_LENGTH
    if layout == "v1":
        whole = whole & F.startswith(text, F.lit("10"))
    return {name: F.when(whole, as_int(F.substring(text, start, n))) for name, start, n in LAYOUTS[layout] if name != "prefix"}


def has_letters(text: Column) -> Column:
    return F.coalesce(F.rlike(text, F.lit("[a-zA-Z]")), F.lit(False))


def sanitised(text: Column) -> Column:
    return F.regexp_replace(text, "[^a-zA-Z0-9]", "")


def rejection_reason(text: Column) -> Column:
    """Why a recognised record cannot be read, or null; the length is that of the text as detected if nothing had to be removed."""
    clean = sanitised(text)
    size = F.length(clean).cast("string")
    wrong = F.when(clean == text, F.concat(F.lit("invalid_detected_length_"), size)).otherwise(F.concat(F.lit("invalid_sanitized_length_"), size))
    return F.when(has_letters(text), F.lit("ocr_contains_letters")).when(F.length(clean) != RECORD_LENGTH, wrong)


def assembled(words: Column) -> Column:
    """Text of array<struct<text, x>> read from left to right, with the letter o read as zero."""
    ordered = F.array_sort(F.transform(words, lambda w: F.struct(w["x"].alias("x"), w["text"].alias("text"))))
    return F.replace(F.array_join(F.transform(ordered, lambda w: w["text"]), ""), F.lit("o"), F.lit("0"))


def digits_in_strip(words: Column, height: Column, share: float = 0.2) -> Column:
    """Digits of the words whose box array<struct<x, y>> lies wholly in the bottom share of the image."""
    low = F.filter(words, lambda w: F.forall(w["box"], lambda p: p["y"] > (1 - share) * height))
    return F.aggregate(low, F.lit(0), lambda n, w: n + F.length(F.regexp_replace(w["text"], "[^0-9]", "")))


def says(words: Column, what: str) -> Column:
    return F.exists(words, lambda w: F.contains(F.lower(w["text"]), F.lit(what.lower())))


def joined_digits(*digits: Column) -> Column:
    """1, 2, 3 to 123; null if a digit is null."""
    text = F.lit("")
    for d in digits:
        text = F.concat(text, d.cast("int").cast("string"))
    return as_int(text)


def weighted_bits(marks: Column, label: Column) -> Column:
    """Sum of the weights marked under a label, 0 if there are none."""
    return F.aggregate(F.coalesce(F.try_element_at(marks, label), F.array().cast("array<int>")), F.lit(0), lambda a, b: a + b)


def degrees(text: Column, integer_only: bool = False) -> Column:
    """45.2N to 45.2; S and W are negative; unreadable text is null.  integer_only drops the decimals."""
    number = F.regexp_extract(text, r"^\s*(\d+)" if integer_only else r"^\s*(\d+\.?\d*)", 1).try_cast("double")
    side = F.upper(F.regexp_extract(text, r"([NSEWnsew])\s*$", 1))
    return F.when(side.isin("N", "E"), number).when(side.isin("S", "W"), -number)


def point(text: Column) -> Column:
    """"(x, y)" to a struct, null if it is no point."""
    x = F.regexp_extract(text, r"^\(\s*(-?[\d.]+)\s*,", 1).try_cast("double")
    y = F.regexp_extract(text, r",\s*(-?[\d.]+)\s*\)$", 1).try_cast("double")
    return F.when(x.isNotNull() & y.isNotNull(), F.struct(x.alias("x"), y.alias("y")))


def loose_json(text: Column, schema: str) -> Column:
    """A dictionary written with single quotes."""
    return F.from_json(F.translate(text, "'", '"'), schema)


def zero_filled(number: Column, width: int) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def digit_columns(number: Column, width: int) -> list[Column]:
    """The digits of a number, most significant first."""
    return [as_int(F.substring(zero_filled(number, width), i + 1, 1)) for i in range(width)]


def issue_list(flags: dict[str, Column]) -> Column:
    """Names of the flags that hold, as a list in text; the text None if there are none."""
    names = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in flags.items()]))
    return F.when(F.size(names) == 0, "None").otherwise(F.array_join(names, ", "))


def normal_path(path: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(path, r"\\", "/"), "/+", "/")


def unsafe_path(path: Column) -> Column:
    return F.coalesce(F.rlike(normal_path(path), F.lit(r"(^/)|(^|/)\.\.(/|$)|^[A-Za-z]:")), F.lit(True))


def path_part(path: Column, from_end: int) -> Column:
    """1 for the last part, 2 for the folder around it; null if there are fewer."""
    return F.try_element_at(F.split(normal_path(path), "/"), F.lit(-from_end))


def stem(path: Column) -> Column:
    return F.regexp_replace(path_part(path, 1), r"\.[^.]*$", "")


def rotated_label(text: Column) -> Column:
    """The last two characters moved to the front; shorter labels stay."""
    return F.when(F.length(text) > 2, F.concat(F.right(text, F.lit(2)), F.substring(text, F.lit(1), F.length(text) - 2))).otherwise(text)


def only_digits(text: Column) -> Column:
    return F.coalesce(F.rlike(text, F.lit("^[0-9]+$")), F.lit(False))
