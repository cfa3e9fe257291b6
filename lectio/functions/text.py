"""Column functions on text."""

from __future__ import annotations

import json
from functools import reduce
from operator import or_

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: What a reader takes for white space in any script; Spark's trim() knows the space alone.
SPACE = r"[\s\x{85}\p{Z}]"
#: The characters of SPACE.
SPACES = " \t\n\x0b\f\r\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip(x: Column) -> Column:
    return F.regexp_replace(x, f"^{SPACE}+|{SPACE}+$", "")


def collapse(x: Column) -> Column:
    """Runs of white space to one space, none at the ends. Most texts are so already, which is seen without an expression."""
    has = lambda some: reduce(or_, (x.contains(c) for c in some))
    other = [c for c in SPACES if c != " "]
    uneven = x.startswith(" ") | x.endswith(" ") | has(["  ", *(c for c in other if c < "\x80")])
    uneven = uneven | ((F.octet_length(x) > F.length(x)) & has(c for c in other if c >= "\x80"))
    return F.when(uneven, F.trim(F.regexp_replace(x, f"{SPACE}+", " "))).otherwise(x)


def quote_form(x: Column) -> Column:
    """What is left of a quote when case, punctuation and spacing do not count: lower case, no dots on the Cyrillic e."""
    low = F.replace(F.lower(x), F.lit("ё"), F.lit("е"))
    return F.trim(F.regexp_replace(low, r"[^\p{L}\p{N}\p{M}_]+", " "))


def tokens(x: Column, pattern: str = "[а-яёa-z0-9]+") -> Column:
    return F.regexp_extract_all(F.lower(x), F.lit(pattern), F.lit(0))


def strip_thinking(x: Column) -> Column:
    """Without closed reasoning blocks; an open one cuts off the rest."""
    closed = F.regexp_replace(x, r"(?s)<think>.*?</think>", "")
    return strip(F.substring_index(closed, "<think>", 1))


def json_of(x: Column) -> Column:
    """The JSON object inside a reply with prose or a fence around it; without braces the cleaned reply."""
    clean = strip_thinking(x)
    bare = F.regexp_replace(clean, "^`+|`+$", "")
    rest = F.when(F.instr(bare, "\n") > 0, F.regexp_replace(bare, r"^[^\n]*\n", "")).otherwise(bare)
    body = F.when(clean.startswith("```"), rest).otherwise(clean)
    found = F.regexp_extract(body, r"(?s)\{.*\}", 0)
    return F.when(found != "", found).otherwise(body)


def minutes(seconds: Column) -> Column:
    """mm:ss, minutes running past 59."""
    whole = F.floor(seconds).cast("long")
    return F.format_string("%02d:%02d", F.floor(whole / 60).cast("long"), whole % 60)


def clock(seconds: Column) -> Column:
    """h:mm:ss, or mm:ss under an hour."""
    whole = F.floor(seconds).cast("long")
    h, m, s = F.floor(whole / 3600).cast("long"), F.floor(whole % 3600 / 60).cast("long"), whole % 60
    return F.when(h > 0, F.format_string("%d:%02d:%02d", h, m, s)).otherwise(F.format_string("%02d:%02d", m, s))


def deep_link(video_id: Column, seconds: Column) -> Column:
    return F.format_string("https://youtu.be/%s?t=%d", video_id, F.floor(seconds).cast("long"))


def _plain(value: object, kind: pa.DataType) -> object:
    """An Arrow value as what JSON has for it; maps come as lists of pairs."""
    if value is None:
        return None
    if pa.types.is_map(kind):
        return {str(k): _plain(v, kind.item_type) for k, v in value}
    if pa.types.is_list(kind) or pa.types.is_large_list(kind):
        return [_plain(x, kind.value_type) for x in value]
    if pa.types.is_struct(kind):
        return {f.name: _plain(value[f.name], f.type) for f in kind}
    return value


def indented_json(x: Column) -> Column:
    """A value that is no string as JSON over several lines, two spaces a level, letters of any script as they are. Spark's own
    writer has neither this layout nor this form of numbers; decimals and times are written as strings."""

    @F.arrow_udf("string")
    def shown(values: pa.Array) -> pa.Array:
        return pa.array([json.dumps(_plain(v, values.type), ensure_ascii=False, indent=2, default=str) for v in values.to_pylist()], pa.string())

    return shown(x)


def fill(template: Column, values: dict[str, Column]) -> Column:
    """{key} replaced by each value (a string) one after another."""
    for key, value in values.items():
        template = F.replace(template, F.lit("{" + key + "}"), value)
    return template
