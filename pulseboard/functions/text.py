"""Strings, digests and row keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def head(value: Column | str, length: int) -> Column:
    """First ``length`` characters. Start 0 and start 1 mean the same here."""
    return F.substring(_col(value), 1, length)


def tail(value: Column | str, start: int) -> Column:
    """From character ``start`` (counted from 1) to the end."""
    return F.substring(_col(value), F.lit(start), F.length(_col(value)))


def md5_key(value: Column | str) -> Column:
    """Upper-case hexadecimal digest, the form used in geographic row keys."""
    return F.upper(F.md5(_col(value).cast("string")))


def md5_head(value: Column | str, length: int = 6) -> Column:
    return head(F.md5(_col(value).cast("string")), length)


def profile_row_key(uid: Column | str, created: Column | str, sex: Column | str) -> Column:
    """Salted key of a user profile: the leading digest spreads keys over regions.

    Null in any part gives a null key.
    """
    text = _col(created).cast("string")
    return F.concat(md5_head(uid), head(text, 10), _col(sex), md5_head(tail(text, 12)))


def pair_row_key(left: Column | str, right: Column | str) -> Column:
    """Salted key of a two-column group."""
    return F.concat(md5_head(left), md5_head(right))


def hash_field(*parts: Column | str) -> Column:
    """Field name inside a key-value hash: the parts joined by underscores."""
    return F.concat_ws("_", *[_col(p).cast("string") for p in parts])


def hash_bucket(value: Column | str, buckets: int = 128) -> Column:
    return F.pmod(F.hash(_col(value).cast("string")), F.lit(buckets))
