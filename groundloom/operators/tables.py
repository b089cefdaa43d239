"""Column choice, row filters, set operations and table comparison."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundloom.functions.cells import bits_clear
from groundloom.functions.names import tile_id

# Image source by the leading number of a stacked band name.
BAND_SOURCES = {"0": "S1", "1": "ALOS2", "2": "LS8", "3": "MODIS"}


def subset_cols(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols)


def rename_cols(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns; an old name that does not exist is an error."""
    absent = [c for c in mapping if c not in df.columns]
    if absent:
        raise ValueError(f"columns do not exist: {absent}")
    return df.withColumnsRenamed(dict(mapping))


def normalise_names(df: DataFrame, prefix: str = "properties.",
                    sources: Mapping[str, str] = BAND_SOURCES) -> DataFrame:
    """Strip the prefix, turn a leading source number (``0_``) into a source name, dots into hyphens."""

    def clean(name: str) -> str:
        if name.startswith(prefix):
            band = name[len(prefix):].split(".")[0]
            lead = re.match(r"(\d).", band)
            name = f"{sources[lead[1]]}-{band[2:]}" if lead else band
        return name.replace(".", "-")

    return df.toDF(*[clean(c) for c in df.columns])


def pick_columns(df: DataFrame, alternatives: Mapping[str, Sequence[str]]) -> dict[str, str]:
    """Old-to-new name map with, for each new name, the first alternative that exists."""
    found = {}
    for new, options in alternatives.items():
        old = next((o for o in options if o in df.columns), None)
        if old is None:
            raise ValueError(f"none of {list(options)} exists")
        found[old] = new
    return found


def cast_catalog(df: DataFrame, level: str | None = None) -> DataFrame:
    """Keep one processing level; path and frame to INT, start and stop to times."""
    if level is not None:
        df = df.where(F.col("processingLevel") == level)
    casts = {c: F.col(c).cast("int") for c in ("pathNumber", "frameNumber") if c in df.columns}
    casts |= {c: F.to_timestamp_ntz(F.col(c).cast("string")) for c in ("startTime", "stopTime") if c in df.columns}
    return df.withColumns(casts)


def filter_products(df: DataFrame, platform: str, start: str, end: str,
                    name: str = "filename", time: str = "startTime") -> DataFrame:
    """Products of a platform acquired strictly between two midnights."""
    return df.where(F.col(name).startswith(platform)
                    & (F.col(time) > F.lit(start).cast("timestamp_ntz"))
                    & (F.col(time) < F.lit(end).cast("timestamp_ntz")))


def filter_months(df: DataFrame, pattern: str, m1: int = 1, m2: int = 12,
                  name: str = "filename", time: str = "startTime") -> DataFrame:
    """Products whose name matches and whose month lies in [m1, m2]."""
    return df.where(F.col(name).rlike(pattern) & F.month(time).between(m1, m2))


def filter_scene_meta(df: DataFrame, equals: Mapping[str, object], start: str, end: str,
                      time: str = "startTime", box: tuple[float, float, float, float] | None = None) -> DataFrame:
    """Scenes with the given metadata, acquired in [start, end), optionally meeting a box."""
    cond = (F.col(time) >= F.lit(start).cast("timestamp_ntz")) & (F.col(time) < F.lit(end).cast("timestamp_ntz"))
    for c, v in equals.items():
        cond = cond & (F.col(c) == v)
    if box is not None:
        xmin, ymin, xmax, ymax = box
        cond = (cond & (F.col("xmin") <= xmax) & (F.col("xmax") >= xmin)
                & (F.col("ymin") <= ymax) & (F.col("ymax") >= ymin))
    return df.where(cond)


def qa_mask(df: DataFrame, qa: str, bands: Sequence[str], bits: Sequence[int] = (3, 5)) -> DataFrame:
    """Band values become NULL unless all the given quality bits are 0."""
    return df.withColumns({b: F.when(bits_clear(qa, bits), F.col(b)) for b in bands})


def active_tiles(tiles: DataFrame) -> DataFrame:
    return tiles.where(F.col("mask") != 0)


def filter_prefix(df: DataFrame, col: str, prefix: str) -> DataFrame:
    return df.where(F.col(col).startswith(prefix)).orderBy(col)


def drop_incomplete(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return df.dropna("any", subset=list(cols) if cols else None)


def invalid_values(df: DataFrame, cols: Sequence[str], allowed: Sequence[object] = (0, 100)) -> DataFrame:
    """Distinct values outside the allowed set, with the column that holds them."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("col_name"), F.col(c).alias("value"))
                                         for c in cols])).alias("cell")).select("cell.*")
    return long.where(~F.col("value").isin(list(allowed))).distinct()


def union_beams(*dfs: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, dfs)


def upsert_products(old: DataFrame, new: DataFrame,
                    order: Sequence[str] = ("pathNumber", "frameNumber", "startTime")) -> DataFrame:
    """Old and new rows without exact duplicates, sorted."""
    return old.unionByName(new).distinct().orderBy(*order)


def insert_absent(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Old rows and the new rows whose key is not present yet."""
    return old.unionByName(new.join(old.select(key), key, "left_anti"))


def distinct_tiles(files: DataFrame, name: str = "name") -> DataFrame:
    """Sorted tile ids found in file names."""
    return (files.select(tile_id(name).alias("tile_id")).where(F.col("tile_id").isNotNull())
            .distinct().orderBy("tile_id"))


def key_intersection(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    return a.select(*keys).intersect(b.select(*keys))


def remainder(df: DataFrame, drawn: DataFrame, key: str) -> DataFrame:
    """Rows not drawn yet."""
    return df.join(drawn.select(key), key, "left_anti")


def same_columns(a: DataFrame, b: DataFrame) -> bool:
    return set(a.columns) == set(b.columns)


def compare_tables(a: DataFrame, b: DataFrame, cols: Sequence[str], position: str,
                   digits: int = 7) -> DataFrame:
    """Rows that differ at the same position after rounding, with both values as text.

    ``position`` holds the row number of the file each table was read from.
    """
    if not same_columns(a, b):
        raise ValueError("the tables have different columns")

    def side(df: DataFrame, tag: str) -> DataFrame:
        types = dict(df.dtypes)
        vals = [F.bround(c, digits).alias(c) if types[c] in ("double", "float") else F.col(c) for c in cols]
        return df.select(F.col(position), F.struct(*vals).alias(tag))

    both = side(a, "first").join(side(b, "second"), position, "full_outer")
    return (both.where(~F.col("first").eqNullSafe(F.col("second")))
            .select(position, *[F.col(f"{tag}.{c}").alias(f"{tag}_{c}") for tag in ("first", "second") for c in cols]))


def tables_match(a: DataFrame, b: DataFrame, cols: Sequence[str], position: str, digits: int = 7) -> bool:
    return same_columns(a, b) and compare_tables(a, b, cols, position, digits).isEmpty()
