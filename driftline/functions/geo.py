"""Distances, packed cells, cell areas and cells of the cube-face (S2) grid."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

EARTH_M = 6_371_000.0
#: Average hexagon area in km2 at resolutions 0..13 (published constants of the H3 grid, fixed values).
HEXAGON_KM2 = (
    4357449.416078383, 609788.4417941332, 86801.78039899720, 12393.43465508816, 1770.347654491307, 252.9038581819449, 36.12906216441245,
    5.161293359717191, 0.7373275975944177, 0.1053325134272067, 0.01504750190766435, 0.002149643129451879, 0.0003070918756316060, 0.00004387026794728296,
)


def valid_location(lat: Column, lon: Column) -> Column:
    return lat.isNotNull() & lon.isNotNull() & lat.between(-90, 90) & lon.between(-180, 180)


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle metres; the half-chord is clamped to 0..1."""
    dlat, dlon = F.radians(lat2 - lat1) / 2, F.radians(lon2 - lon1) / 2
    a = F.sin(dlat) * F.sin(dlat) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.sin(dlon) * F.sin(dlon)
    a = F.least(F.lit(1.0), F.greatest(F.lit(0.0), a))
    return 2 * EARTH_M * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def hexagon_km2(res: int) -> float:
    return HEXAGON_KM2[res]


def pack_cell(cell: Column) -> Column:
    """Bits 6 to 51 of a cell index."""
    return F.shiftrightunsigned(cell, 6).bitwiseAND(F.lit((1 << 46) - 1))


def unpack_cell(packed: Column, res: int) -> Column:
    """The cell index of packed bits: mode, resolution and the six bits of filling put back."""
    return F.shiftleft(packed.cast("long"), 6).bitwiseOR(F.lit((1 << 59) | (res << 52) | 0x3F))


def _grid_orders() -> tuple[np.ndarray, np.ndarray]:
    """Position of each (i, j) quadrant along the Hilbert curve in each of four orientations, and how a quadrant turns the next."""
    swap, invert = 1, 2
    turn = [swap, 0, 0, invert | swap]
    place = np.zeros((4, 4), np.int64)
    for o in range(4):
        for pos, ij in enumerate([0, 1, 3, 2]):
            i, j = ij >> 1, ij & 1
            if o & swap:
                i, j = j, i
            if o & invert:
                i, j = 1 - i, 1 - j
            place[o, i * 2 + j] = pos
    return place, np.array(turn)


_PLACE, _TURN = _grid_orders()


def s2_leaf(lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
    """Leaf cell ids (as signed 64-bit numbers) of points on the cube-face grid with quadratic projection."""
    phi, theta = np.radians(lat), np.radians(lon)
    p = np.stack([np.cos(phi) * np.cos(theta), np.cos(phi) * np.sin(theta), np.sin(phi)])
    axis = np.abs(p).argmax(axis=0)
    n = np.arange(p.shape[1])
    face = axis + 3 * (p[axis, n] < 0)
    x, y, z = p
    with np.errstate(divide="ignore", invalid="ignore"):
        u = np.choose(face, [y / x, -x / y, -x / z, z / x, z / y, -y / z])
        v = np.choose(face, [z / x, z / y, -y / z, y / x, -x / y, -x / z])
    st = [np.where(w >= 0, 0.5 * np.sqrt(1 + 3 * np.abs(w)), 1 - 0.5 * np.sqrt(1 + 3 * np.abs(w))) for w in (u, v)]
    i, j = (np.clip(np.floor(s * (1 << 30)), 0, (1 << 30) - 1).astype(np.int64) for s in st)
    turn, pos = face & 1, np.zeros(len(n), np.int64)
    for k in range(29, -1, -1):
        step = _PLACE[turn, ((i >> k) & 1) * 2 + ((j >> k) & 1)]
        pos = pos * 4 + step
        turn = turn ^ _TURN[step]
    return ((face.astype(np.uint64) << np.uint64(61)) | (pos.astype(np.uint64) << np.uint64(1)) | np.uint64(1)).view(np.int64)


@F.pandas_udf(LongType())
def s2_leaf_of(lat: pd.Series, lon: pd.Series) -> pd.Series:
    out = pd.array(np.zeros(len(lat), np.int64), "Int64")
    ok = (lat.notna() & lon.notna()).to_numpy()
    out[ok] = s2_leaf(lat.to_numpy(np.float64)[ok], lon.to_numpy(np.float64)[ok])
    out[~ok] = pd.NA
    return pd.Series(out)


def s2_ancestor(leaf: Column, level: int) -> Column:
    """The cell of that level that holds a leaf: equality of signed numbers is equality of cells."""
    low = 1 << (2 * (30 - level))
    return leaf.bitwiseAND(F.lit(-low)).bitwiseOR(F.lit(low))


def s2_low_bit(cell: Column) -> Column:
    return cell.bitwiseAND(-cell)
