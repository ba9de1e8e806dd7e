"""Geographic row keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulseboard.functions.text import head, md5_key

# The public geohash alphabet.
GEOHASH_ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"

_AXIS_BITS = 30


def _cell(value: Column, low: float, span: float) -> Column:
    """Index of the cell on one axis, 30 bits; the upper border belongs to the last cell."""
    scaled = F.floor((value - F.lit(low)) / F.lit(span) * F.lit(float(1 << _AXIS_BITS)))
    return F.least(scaled, F.lit((1 << _AXIS_BITS) - 1)).cast("bigint")


def _letter(lat: Column, lon: Column, position: int) -> Column:
    """Letter ``position`` of the code: five bits, taken from both axes in turn, longitude first."""
    value = F.lit(0).cast("bigint")
    for place in range(5):
        bit = 5 * position + place
        axis = lon if bit % 2 == 0 else lat
        one = F.shiftright(axis, _AXIS_BITS - 1 - bit // 2).bitwiseAND(F.lit(1))
        value = value.bitwiseOR(F.shiftleft(one, 4 - place))
    return F.substring(F.lit(GEOHASH_ALPHABET), (value + 1).cast("int"), F.lit(1))


def geohash(latitude: Column | str, longitude: Column | str, precision: int = 12) -> Column:
    """Base-32 geohash of up to 12 characters, by bit arithmetic on columns.

    The cell numbers repeat in every letter; generated code evaluates them once.
    """
    if not 1 <= precision <= 12:
        raise ValueError("precision must be between 1 and 12")
    lat = _cell(F.col(latitude) if isinstance(latitude, str) else latitude, -90.0, 180.0)
    lon = _cell(F.col(longitude) if isinstance(longitude, str) else longitude, -180.0, 360.0)
    return F.concat(*[_letter(lat, lon, i) for i in range(precision)])


def location_row_key(uid: Column | str, latitude: Column | str, longitude: Column | str) -> Column:
    """Geohash followed by six characters of the digest of the user id."""
    return F.concat(geohash(latitude, longitude, 12), head(md5_key(uid), 6))
