"""Flat binary multi-band rasters with a text header, as a Spark data source."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from groundloom.operators.grids import Grid

# Data type codes of the header.
DTYPES = {1: "u1", 2: "i2", 3: "i4", 4: "f4", 5: "f8", 12: "u2", 13: "u4", 14: "i8"}
BATCH_CELLS = 65_536
SPARK_TYPES = {"u1": "smallint", "i2": "smallint", "i4": "int", "f4": "float", "f8": "double", "u2": "int",
               "u4": "bigint", "i8": "bigint"}


def parse_header(text: str) -> dict:
    """Sizes, type, layout, upper-left corner and band names from header text."""
    pairs = dict(re.findall(r"^\s*([\w ]+?)\s*=\s*(\{.*?\}|[^\n]*)", text, flags=re.M | re.S))
    info = [p.strip() for p in pairs["map info"].strip("{} \n").split(",")]
    # the reference pixel (1-based) and its coordinates give the upper-left corner
    res = float(info[5])
    bands = int(pairs["bands"])
    names = [n.strip() for n in pairs.get("band names", "{}").strip("{} \n").split(",") if n.strip()]
    return {"samples": int(pairs["samples"]), "lines": int(pairs["lines"]), "bands": bands,
            "offset": int(pairs.get("header offset", 0)), "dtype": DTYPES[int(pairs["data type"])],
            "interleave": pairs.get("interleave", "bsq").strip().lower(),
            "order": ">" if pairs.get("byte order", "0").strip() == "1" else "<",
            "x0": float(info[3]) - (float(info[1]) - 1) * res, "y0": float(info[4]) + (float(info[2]) - 1) * res,
            "res": res, "names": names if len(names) == bands else [f"Band {i + 1}" for i in range(bands)]}


def _column_names(names: Sequence[str]) -> list[str]:
    return [re.sub(r"\W+", "_", n).strip("_").lower() for n in names]


class RowBlock(InputPartition):
    def __init__(self, path: str, head: dict, first: int, count: int, row0: int, col0: int):
        self.path, self.head, self.first, self.count, self.row0, self.col0 = path, head, first, count, row0, col0


class FlatStackReader(DataSourceReader):
    def __init__(self, files: list[tuple[str, dict]], rows: int, nodata: float | None):
        self.files, self.rows, self.nodata = files, rows, nodata

    def partitions(self) -> list[RowBlock]:
        left, top = min(h["x0"] for _, h in self.files), max(h["y0"] for _, h in self.files)
        blocks = []
        for path, h in self.files:
            row0, col0 = round((top - h["y0"]) / h["res"]), round((h["x0"] - left) / h["res"])
            blocks += [RowBlock(path, h, r, min(self.rows, h["lines"] - r), row0, col0)
                       for r in range(0, h["lines"], self.rows)]
        return blocks

    def read(self, part: RowBlock) -> Iterator[pa.RecordBatch]:
        h = part.head
        shape = {"bsq": (h["bands"], h["lines"], h["samples"]), "bil": (h["lines"], h["bands"], h["samples"]),
                 "bip": (h["lines"], h["samples"], h["bands"])}[h["interleave"]]
        data = np.memmap(part.path, dtype=h["order"] + h["dtype"], mode="r", offset=h["offset"], shape=shape)
        cols = np.arange(h["samples"], dtype=np.int32) + part.col0
        lines = max(BATCH_CELLS // max(h["samples"], 1), 1)
        for r in range(part.first, part.first + part.count, lines):
            end = min(r + lines, part.first + part.count)
            block = {"bsq": lambda: data[:, r:end], "bil": lambda: data[r:end].transpose(1, 0, 2),
                     "bip": lambda: data[r:end].transpose(2, 0, 1)}[h["interleave"]]()
            arrays = [pa.array(np.repeat(np.arange(r, end, dtype=np.int32) + np.int32(part.row0), h["samples"])),
                      pa.array(np.tile(cols, end - r))]
            for band in block:
                values = band.ravel().astype(band.dtype.newbyteorder("="))
                if values.dtype.kind == "u":
                    values = values.astype({1: np.int16, 2: np.int32, 4: np.int64}[values.dtype.itemsize])
                empty = np.isnan(values) if values.dtype.kind == "f" else np.zeros(values.shape, bool)
                if self.nodata is not None:
                    empty = empty | (values == self.nodata)
                arrays.append(pa.array(values, mask=empty))
            yield pa.RecordBatch.from_arrays(arrays, names=["pr", "pc", *_column_names(h["names"])])


class FlatStackSource(DataSource):
    """``spark.read.format("flatstack").load(header file or folder of them)``.

    Options: ``rows_per_part`` and ``nodata``. The files must lie in a folder all executors
    reach. No data and NaN become NULL; rows and columns count from the corner common to all
    files.
    """

    @classmethod
    def name(cls) -> str:
        return "flatstack"

    def _files(self) -> list[tuple[str, dict]]:
        path = re.sub(r"^file:(//)?", "", self.options["path"])
        heads = ([os.path.join(path, f) for f in sorted(os.listdir(path)) if f.endswith(".hdr")]
                 if os.path.isdir(path) else [path])
        found = []
        for head in heads:
            with open(head) as f:
                found.append((head[:-len(".hdr")], parse_header(f.read())))
        return found

    def schema(self) -> str:
        files = self._files()
        _, h = files[0]
        for name, other in files[1:]:
            if (other["dtype"], other["names"]) != (h["dtype"], h["names"]):
                raise ValueError(f"{name} has other bands or another data type than {files[0][0]}")
        kind = SPARK_TYPES[h["dtype"]]
        return ", ".join(["pr int", "pc int", *[f"`{n}` {kind}" for n in _column_names(h["names"])]])

    def reader(self, schema) -> FlatStackReader:
        nodata = self.options.get("nodata")
        return FlatStackReader(self._files(), int(self.options.get("rows_per_part", 256)),
                               None if nodata is None else float(nodata))


def read_flat_stack(spark: SparkSession, path: str, rows_per_part: int = 256,
                    nodata: float | None = -9999) -> DataFrame:
    spark.dataSource.register(FlatStackSource)
    reader = spark.read.format("flatstack").option("rows_per_part", rows_per_part)
    if nodata is not None:
        reader = reader.option("nodata", nodata)
    return reader.load(path)


def _header_text(grid: Grid, lines: int, first: int, bands: Sequence[str]) -> str:
    corner = f"{grid.x0!r}, {grid.y0 - first * grid.res!r}"
    return "\n".join(["ENVI", f"samples = {grid.n_cols}", f"lines   = {lines}", f"bands   = {len(bands)}",
                      "header offset = 0", "file type = ENVI Standard", "data type = 4", "interleave = bsq",
                      "byte order = 0", f"map info = {{Grid, 1, 1, {corner}, {grid.res!r}, {grid.res!r}}}",
                      "band names = {" + ", ".join(bands) + "}", ""])


def write_flat_stack(df: DataFrame, path: str, grid: Grid, bands: Sequence[str], nodata: float = -9999.0,
                     rows_per_file: int = 256) -> DataFrame:
    """Write FLOAT bands as flat files of ``rows_per_file`` image rows each; returns the list of files.

    Every file is one bounded group, written under a temporary name first, so a repeated task
    does no harm.
    """
    os.makedirs(path, exist_ok=True)
    names, n_cols, n_rows = list(bands), grid.n_cols, grid.n_rows

    def write_block(pdf: pd.DataFrame) -> pd.DataFrame:
        block = int(pdf["block"].iloc[0])
        first = block * rows_per_file
        lines = min(rows_per_file, n_rows - first)
        cube = np.full((len(names), lines, n_cols), nodata, dtype="<f4")
        rows, cols = pdf["pr"].to_numpy() - first, pdf["pc"].to_numpy()
        for i, name in enumerate(names):
            cube[i, rows, cols] = pdf[name].fillna(nodata).to_numpy()
        target = os.path.join(path, f"rows_{block:06d}")
        for suffix, content in (("", cube.tobytes()), (".hdr", _header_text(grid, lines, first, names).encode())):
            temporary = f"{target}{suffix}.{uuid.uuid4().hex}.part"      # tasks on two machines may write the same block
            with open(temporary, "wb") as f:
                f.write(content)
            os.replace(temporary, target + suffix)
        return pd.DataFrame({"block": [block], "file": [target], "pixels": [len(pdf)]})

    block = F.floor(F.col("pr") / F.lit(float(rows_per_file))).cast("int").alias("block")
    return (df.select(block, "pr", "pc", *names).groupBy("block")
            .applyInPandas(write_block, "block int, file string, pixels long"))
