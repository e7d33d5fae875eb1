"""Text as columns: keys, wrapped payloads, labels and delimited sets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What the trimming of keys takes off: control characters and the space.
_TRIMMED = "".join(map(chr, range(33)))


def image_key(value: Column) -> Column:
    """Trimmed and lower-cased; null for null or blank."""
    key = F.lower(F.btrim(value, F.lit(_TRIMMED)))
    return F.when(key != "", key)


def key_part(value: Column) -> Column:
    """A part of a match key: no white space, lower case, ``null`` where missing."""
    return F.lower(F.coalesce(F.regexp_replace(value, r"\s+", ""), F.lit("null")))


def composite_key(*parts: Column) -> Column:
    return F.concat_ws("-", *[key_part(p) for p in parts])


def last_part(key: Column) -> Column:
    return F.substring_index(key, "-", -1)


def same_text(a: Column, b: Column) -> Column:
    """Equal but for case; two nulls are equal, a null and a value are not."""
    return F.coalesce(F.lower(a) == F.lower(b), a.isNull() & b.isNull())


def request_id(payload: Column) -> Column:
    quoted = F.regexp_extract(payload, r'(?s)id\s*=\s*"([^"]*)"\s*,\s*request\s*=', 1)
    bare = F.btrim(F.regexp_extract(payload, r"(?s)id\s*=\s*([^,\"]*),\s*request\s*=", 1))
    return F.when(quoted != "", quoted).when(bare != "", bare)


def request_body(payload: Column) -> Column:
    """The request of ``id=…,request=…``: quoted with escaped quotes, or bare; null where there is none."""
    quoted = F.regexp_extract(payload, r'(?s)request\s*=\s*"(.*)"\s*$', 1)
    bare = F.regexp_extract(payload, r"(?s)request\s*=\s*([^\"].*)$", 1)
    return F.when(quoted != "", F.replace(quoted, F.lit('\\"'), F.lit('"'))).when(bare != "", bare)


def under(path: Column, root: str | Column) -> Column:
    """Whether a dotted path is ``root`` or below it."""
    root = F.lit(root) if isinstance(root, str) else root
    return (path == root) | F.startswith(path, F.concat(root, F.lit(".")))


def renamed(path: Column, mappings: Sequence[tuple[str, str]]) -> Column:
    """The path under its new prefix by the first (new, old) pair that fits."""
    out = path
    for new, old in reversed(list(mappings)):
        out = F.when(under(path, old), F.concat(F.lit(new), F.substring(path, len(old) + 1, 1 << 20))).otherwise(out)
    return out


def first_label(columns: Sequence[Column], labels: Mapping[str, Sequence[str]], default: str | None = None) -> Column:
    """The first label one of whose LIKE patterns fits one of the columns, in lower case."""
    out = F.lit(default)
    for label, patterns in reversed(list(labels.items())):
        fits = reduce(lambda a, b: a | b, [F.coalesce(F.lower(c).like(p), F.lit(False)) for c in columns for p in patterns])
        out = F.when(fits, label).otherwise(out)
    return out


def set_of(text: Column) -> Column:
    """The members of a ``;``-joined set, sorted, without empty ones."""
    return F.array_sort(F.array_distinct(F.filter(F.split(F.coalesce(text, F.lit("")), ";"), lambda x: x != "")))


def joined_set(members: Column) -> Column:
    """Sorted and joined by ``;``; null for no members."""
    text = F.array_join(F.array_sort(F.array_distinct(members)), ";")
    return F.when(text != "", text)


def whole_number(text: Column) -> Column:
    """A lenient count: 0 where the text is no whole number."""
    return F.coalesce(text.try_cast("bigint"), F.lit(0))
