"""Geohash and point texts as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the geohash alphabet.
ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"


def _cell(value: Column, low: float, high: float, bits: int) -> Column:
    """Index of the half-open cell of ``value`` among ``2**bits`` equal ones."""
    scaled = F.floor((value - low) / (high - low) * (1 << bits)).cast("long")
    return F.greatest(F.lit(0), F.least(scaled, F.lit((1 << bits) - 1)))


def encode(latitude: Column, longitude: Column, length: int = 12) -> Column:
    """Geohash text of ``length`` characters; longitude owns the even bits."""
    total = 5 * length
    lon_bits, lat_bits = (total + 1) // 2, total // 2
    lon = _cell(longitude, -180.0, 180.0, lon_bits)
    lat = _cell(latitude, -90.0, 90.0, lat_bits)

    def bit(i: int) -> Column:
        if i % 2 == 0:
            return F.shiftright(lon, lon_bits - 1 - i // 2).bitwiseAND(F.lit(1))
        return F.shiftright(lat, lat_bits - 1 - i // 2).bitwiseAND(F.lit(1))

    letters = []
    for char in range(length):
        number = F.lit(0)
        for i in range(5):
            number = number * 2 + bit(5 * char + i)
        letters.append(F.substring(F.lit(ALPHABET), (number + 1).cast("int"), F.lit(1)))
    return F.when(latitude.isNotNull() & longitude.isNotNull(), F.concat(*letters))


def decode(geohash: Column, strict: bool = True) -> Column:
    """Struct ``(latitude, longitude)``: the centre of the cell.

    Invalid text raises in strict mode and gives null otherwise.
    """
    text = F.lower(geohash)
    start = F.struct(
        F.lit(-90.0).alias("la"),
        F.lit(90.0).alias("lb"),
        F.lit(-180.0).alias("oa"),
        F.lit(180.0).alias("ob"),
        F.lit(True).alias("even"),
    )
    digits = F.transform(
        F.filter(F.split(text, ""), lambda c: c != ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1
    )
    bits = F.flatten(
        F.transform(digits, lambda d: F.array(*[F.shiftright(d, 4 - i).bitwiseAND(F.lit(1)) for i in range(5)]))
    )

    def halve(s: Column, b: Column) -> Column:
        lat_mid, lon_mid = (s["la"] + s["lb"]) / 2, (s["oa"] + s["ob"]) / 2
        up = b == 1
        return F.struct(
            F.when(~s["even"] & up, lat_mid).otherwise(s["la"]).alias("la"),
            F.when(~s["even"] & ~up, lat_mid).otherwise(s["lb"]).alias("lb"),
            F.when(s["even"] & up, lon_mid).otherwise(s["oa"]).alias("oa"),
            F.when(s["even"] & ~up, lon_mid).otherwise(s["ob"]).alias("ob"),
            (~s["even"]).alias("even"),
        )

    def centre(s: Column) -> Column:
        return F.struct(
            ((s["la"] + s["lb"]) / 2).alias("latitude"), ((s["oa"] + s["ob"]) / 2).alias("longitude")
        )

    point = F.aggregate(bits, start, halve, centre)
    valid = text.rlike(f"^[{ALPHABET}]+$")
    if not strict:
        return F.when(valid, point)
    problem = F.raise_error(F.concat(F.lit("not a geohash: "), geohash)).cast(
        "struct<latitude:double,longitude:double>"
    )
    return F.when(geohash.isNull(), F.lit(None)).when(valid, point).otherwise(problem)


def parse_point(text: Column) -> Column:
    """Struct ``(latitude, longitude, altitude)`` of ``"lat, lon[, alt km|m]"``; altitude in km."""
    number = r"([-+]?\d+(?:\.\d+)?)"
    shape = rf"^\s*{number}\s*[,;\s]\s*{number}(?:\s*[,;\s]\s*{number}\s*(km|m)?)?\s*$"

    def part(i: int) -> Column:
        return F.nullif(F.regexp_extract(text, shape, i), F.lit(""))

    altitude = part(3).cast("double")
    altitude = F.when(part(4) == "m", altitude / 1000).otherwise(altitude)
    return F.when(
        text.rlike(shape),
        F.struct(
            part(1).cast("double").alias("latitude"),
            part(2).cast("double").alias("longitude"),
            altitude.alias("altitude"),
        ),
    )
