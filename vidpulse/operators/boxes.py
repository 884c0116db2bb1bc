"""Bounding-box queries over a layout sorted by Z-order cell.

A place gets the number of its cell on the Z-order curve (the bits of its
longitude and latitude cells, interleaved), and the table is range-partitioned
and sorted by it, so near places share files and row groups.  A box is cut
into at most ``most`` ranges of cell numbers that cover it; the scan keeps the
row groups whose statistics meet a range, and the exact comparison of the
coordinates does the rest.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Cells per axis are 2 ** BITS (about 600 m at the equator).
BITS = 16
#: Ranges that one box is cut into at most.
MOST_RANGES = 64

#: Steps that spread 16 bits to the even places of 32.
_SPREAD = ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555))


class Box(NamedTuple):
    """Both ends belong to the box.  ``west > east`` goes over the date line."""

    south: float
    west: float
    north: float
    east: float


def _axis(value: Column, least: float, span: float) -> Column:
    """Cell along one axis; values beyond the ends go to the last cells."""
    cells = 1 << BITS
    return F.least(F.lit(cells - 1), F.greatest(F.lit(0), F.floor((value - least) / span * cells))).cast("bigint")


def _axis_of(value: float, least: float, span: float) -> int:
    cells = 1 << BITS
    return min(cells - 1, max(0, math.floor((value - least) / span * cells)))


def _spread(cell: Column) -> Column:
    for shift, mask in _SPREAD:
        cell = cell.bitwiseOR(F.shiftleft(cell, shift)).bitwiseAND(F.lit(mask).cast("bigint"))
    return cell


def cell_number(latitude: Column, longitude: Column) -> Column:
    """Z-order number of the cell of a place; null where a coordinate is null."""
    row, col = _spread(_axis(latitude, -90, 180)), _spread(_axis(longitude, -180, 360))
    return F.when(latitude.isNotNull() & longitude.isNotNull(), F.shiftleft(row, 1).bitwiseOR(col))


def cell_ranges(box: Box, most: int = MOST_RANGES) -> list[tuple[int, int]]:
    """At most ``most`` ranges of cell numbers that cover the box.  Squares of
    cells that are partly outside are cut in four, largest first, while the
    number of ranges allows it."""
    if box.south > box.north:
        return []
    if box.west > box.east:  # two boxes, on both sides of the date line
        return _joined(cell_ranges(box._replace(east=180.0), most // 2) + cell_ranges(box._replace(west=-180.0), most // 2))
    low = (_axis_of(box.south, -90, 180), _axis_of(box.west, -180, 360))
    high = (_axis_of(box.north, -90, 180), _axis_of(box.east, -180, 360))
    todo, done = [(-BITS, 0, 0)], []  # squares: (-level, first row, first column)
    while todo:
        level, row, col = heapq.heappop(todo)
        size = 1 << -level
        if row + size <= low[0] or row > high[0] or col + size <= low[1] or col > high[1]:
            continue
        inside = low[0] <= row and row + size - 1 <= high[0] and low[1] <= col and col + size - 1 <= high[1]
        if inside or size == 1 or len(todo) + len(done) + 4 > most:
            first = _interleave(row, col)
            done.append((first, first + size * size - 1))
        else:
            half = size // 2
            for r, c in ((0, 0), (0, half), (half, 0), (half, half)):
                heapq.heappush(todo, (level + 1, row + r, col + c))
    return _joined(done)


def _joined(ranges: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, last in sorted(ranges):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(last, out[-1][1]))
        else:
            out.append((first, last))
    return out


def _interleave(row: int, col: int) -> int:
    return sum(((row >> k & 1) << (2 * k + 1)) | ((col >> k & 1) << (2 * k)) for k in range(BITS))


def write_places(df: DataFrame, path: str, files: int | None = None, row_group_bytes: int = 16 << 20) -> None:
    """``df`` with its ``cell``, range-partitioned and sorted by it.  The
    event id spreads one place that holds many rows over files."""
    n = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["cell", *[c for c in ("event_id",) if c in df.columns]]
    placed = df.withColumn("cell", cell_number(F.col("latitude"), F.col("longitude")))
    placed.repartitionByRange(n, *order).sortWithinPartitions(*order).write.option("parquet.block.size", str(row_group_bytes)).parquet(path)


def read_places(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def in_box(box: Box) -> Column:
    """The exact condition on the coordinates."""
    east_west = F.col("longitude").between(box.west, box.east)
    if box.west > box.east:
        east_west = (F.col("longitude") >= box.west) | (F.col("longitude") <= box.east)
    return F.col("latitude").between(box.south, box.north) & east_west


def search(places: DataFrame, box: Box, most: int = MOST_RANGES) -> DataFrame:
    """Rows of ``places`` (with ``cell``) in the box; the ranges reach the scan."""
    near = F.lit(False)
    for first, last in cell_ranges(box, most):
        near = near | F.col("cell").between(first, last)
    return places.where(near & in_box(box))


def box_counts(places: DataFrame, boxes: dict[str, Box], types: Sequence[str] = ("play", "like"), key: str = "video_id") -> DataFrame:
    """Events of ``types`` per box and video: one scan of the ranges per box."""
    out = None
    for name, box in boxes.items():
        found = search(places, box).where(F.col("event_type").isin(list(types))).groupBy(key).agg(
            *[F.count_if(F.col("event_type") == t).alias(f"{t}s") for t in types])
        one = found.select(F.lit(name).alias("box"), key, *[f"{t}s" for t in types])
        out = one if out is None else out.unionAll(one)
    return out
