"""Reading and writing of scene, product and tile names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from groundloom.functions.indices import as_col

# Name formats of the products that the jobs read.
ACQUISITION_TIME = r"(?<=_)\d{8}T\d{6}Z(?=_\d{8}T\d{6})"
PROCESSING_TIME = r"(?<=\d{8}T\d{6}Z_)\d{8}T\d{6}Z(?=_S1)"
TILE_ID = r"h(\d+)_v(\d+)"
GEO_TILE = r"^([NS])(\d{2,})([EW])(\d{3,})"
PRODUCT_PATTERNS = {
    "rtc_zip": r"^\w{3}_\w{2}_\d{8}T\d{6}_\w{3}_RTC\d{2}_\w{1}_\w{6}_\w{4}.zip$",
    "alos_zip": r"^[N|S]{1}\w{2}[E|W]{1}\w{3}_\w{2}_MOS.zip$",
    "alos2_zip": r"^[N|S]{1}\w{2}[E|W]{1}\w{3}_\w{2}_MOS_F02DAR.zip$",
}
OUTPUT_NAMES = {
    "tile": ("s1_tile_%s_%s_%s_h%s_v%s_%s.tif", ["site", "start", "end", "h", "v", "pol"]),
    "stack": ("%s_h%sv%s.tif", ["name", "h", "v"]),
    "temporal_mean": ("%s_tmean_%s_%s_%s.tif", ["burst", "start", "end", "pol"]),
    "frame_mean": ("%s/%s_mean.tif", ["frame", "layer"]),
}


def _stamp(name: Column, pattern: str, what: str) -> Column:
    text = F.regexp_extract(name, pattern, 0)
    checked = F.when(text != "", text).otherwise(
        F.raise_error(F.concat(F.lit(f"no {what} time in name: "), name)))
    return F.to_timestamp_ntz(F.substring(checked, 1, 15), F.lit("yyyyMMdd'T'HHmmss"))


def acquisition_time(name: Column | str) -> Column:
    """First of the two time stamps (UTC) in a scene name; a name without it is an error."""
    return _stamp(as_col(name), ACQUISITION_TIME, "acquisition")


def processing_time(name: Column | str) -> Column:
    """Second of the two time stamps (UTC) in a scene name; a name without it is an error."""
    return _stamp(as_col(name), PROCESSING_TIME, "processing")


def tile_id(name: Column | str) -> Column:
    """``h<n>_v<n>`` found in a name, else NULL."""
    return F.nullif(F.regexp_extract(as_col(name), TILE_ID, 0), F.lit(""))


def tile_part(name: Column | str, part: str) -> Column:
    """Tile column (``h``) or row (``v``) number found in a name, else NULL."""
    digits = F.regexp_extract(as_col(name), TILE_ID, {"h": 1, "v": 2}[part])
    return F.nullif(digits, F.lit("")).cast("int")


def matches_product(name: Column | str, kind: str) -> Column:
    return as_col(name).rlike(PRODUCT_PATTERNS[kind])


def _digits(number: Column, least: int) -> Column:
    """The whole number with leading zeros; a longer one keeps all its digits."""
    text = F.abs(number).cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(least)), F.lit("0"))


def _corner_parts(tile: Column) -> list[Column]:
    """Letter and number of the latitude and of the longitude in a tile name."""
    ns, lat, ew, lon = (F.regexp_extract(tile, GEO_TILE, i) for i in range(1, 5))
    return [ns, lat.cast("int"), ew, lon.cast("int")]


def geo_tile_name(lat: Column | str, lon: Column | str) -> Column:
    """Name such as N06W075 from the integer latitude and longitude of the upper-left corner.

    Tiles of a grid that goes on beyond 99 or 999 have longer numbers, so no two tiles share a name.
    """
    lat, lon = as_col(lat).cast("int"), as_col(lon).cast("int")
    return F.concat(F.when(lat >= 0, "N").otherwise("S"), _digits(lat, 2), F.when(lon >= 0, "E").otherwise("W"), _digits(lon, 3))


def tile_corner(tile: Column | str) -> tuple[Column, Column]:
    """Latitude and longitude of the upper-left corner of a tile named like N06W075."""
    ns, lat, ew, lon = _corner_parts(as_col(tile))
    return F.when(ns == "S", -lat).otherwise(lat), F.when(ew == "W", -lon).otherwise(lon)


def parent_grid_name(tile: Column | str) -> Column:
    """Name of the 5-degree grid that holds a 1-degree tile; 0 is always written N and E."""
    ns, lat, ew, lon = _corner_parts(as_col(tile))
    lat5, lon5 = lat / F.lit(5.0), lon / F.lit(5.0)
    lat = (F.when(ns == "N", F.ceil(lat5)).otherwise(F.floor(lat5)) * 5).cast("int")
    lon = (F.when(ew == "E", F.floor(lon5)).otherwise(F.ceil(lon5)) * 5).cast("int")
    return F.concat(F.when(lat == 0, "N").otherwise(ns), _digits(lat, 2), F.when(lon == 0, "E").otherwise(ew), _digits(lon, 3))


def output_name(kind: str, **parts: Column | str) -> Column:
    """Name of an output product from its key columns; see ``OUTPUT_NAMES`` for the parts."""
    pattern, order = OUTPUT_NAMES[kind]
    return F.format_string(pattern, *[as_col(parts[p]).cast("string") for p in order])


def frame_id(path: Column | str, frame: Column | str) -> Column:
    return F.concat_ws("_", as_col(path).cast("string"), as_col(frame).cast("string"))


def join_list(items: Column | str) -> Column:
    """List cell to comma text."""
    return F.array_join(as_col(items), ",")


def split_list(text: Column | str) -> Column:
    """Comma text to list cell."""
    return F.split(as_col(text), ",")
