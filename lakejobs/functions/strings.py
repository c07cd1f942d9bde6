"""String rules as column expressions: masks, name maps, keyword classes, log tokens."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def part(text: Column | str, separator: str, index: int) -> Column:
    """Element of a split, NULL past the end."""
    return F.get(F.split(text, separator), index)


def mask_id(text: Column | str) -> Column:
    """Hide all but the last four characters."""
    return F.concat(F.lit("***-**-"), F.right(text, F.lit(4)))


def mask_email(text: Column | str) -> Column:
    """Keep three characters and the domain."""
    column = F.col(text) if isinstance(text, str) else text
    return F.concat(F.left(column, F.lit(3)), F.lit("***@"), F.split_part(column, F.lit("@"), F.lit(2)))


def keyword_class(text: Column | str, rules: Sequence[tuple[Sequence[str], object]], default: object) -> Column:
    """First rule with a keyword in the text wins; each rule is (keywords, result)."""
    lowered = F.lower(text)
    result: Column | None = None
    for keywords, value in rules:
        hit = F.lit(False)
        for word in keywords:
            hit = hit | lowered.contains(word)
        result = F.when(hit, F.lit(value)) if result is None else result.when(hit, F.lit(value))
    return result.otherwise(F.lit(default)) if result is not None else F.lit(default)


def lookup(text: Column | str, names: dict[str, str]) -> Column:
    """Replace names found in a small mapping, keep the others."""
    column = F.col(text) if isinstance(text, str) else text
    if not names:
        return column
    pairs = [F.lit(x) for item in names.items() for x in item]
    return F.coalesce(F.create_map(*pairs)[column], column)


def token_uuid(text: Column | str) -> Column:
    """UUID text from the url-safe base64 ``r=`` token of a log field; NULL when there is none."""
    token = F.regexp_extract(text, r"r=([^,]+)", 1)
    padded = F.rpad(F.translate(token, "@-_", "+//"), 24, "=")
    digits = F.lower(F.hex(F.try_to_binary(padded, F.lit("base64"))))
    pieces = [F.substring(digits, at, size) for at, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.when((token != "") & (F.length(digits) == 32), F.concat_ws("-", *pieces))
