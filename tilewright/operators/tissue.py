"""Tissue masks of planes: thresholds, entropy, their combinations and the routing between them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilewright.functions.text import stain_name
from tilewright.operators import kernels
from tilewright.operators.planes import per_plane

#: Disc of the entropy filter, share of the short side and of the area that counts as small,
#: the saturation above which the adaptive route uses it, and stains that are thresholded on saturation.
ENTROPY_RADIUS, SMALL_SIDE, SMALL_AREA, SATURATED = 5, 0.01, 1e-4, 60.0
SATURATION_STAINS = ("hirano",)

METHODS = ("otsu", "otsu_s", "entropy", "entropy_s", "union", "union_s", "intersection", "adaptive")


def otsu_mask(rgb: np.ndarray, saturation_only: bool = False) -> np.ndarray:
    """Pixels above the saturation's threshold, or not above the gray one; small objects and then small
    holes are taken out."""
    s = kernels.saturation(rgb)
    mask = s > kernels.otsu(s)
    if not saturation_only:
        g = kernels.gray(rgb)
        mask |= g <= kernels.otsu(g)
    small = max(3, int(SMALL_SIDE * min(mask.shape))) ** 2
    return kernels.fill_small(kernels.remove_small(mask, small), small)


def entropy_mask(rgb: np.ndarray, use_saturation: bool = False, keep: str = "all") -> np.ndarray:
    """Pixels whose neighbourhood is as varied as the threshold in the entropy's histogram."""
    e = kernels.entropy(kernels.saturation(rgb) if use_saturation else kernels.gray(rgb), ENTROPY_RADIUS)
    mask = e >= kernels.local_minimum_threshold(e)
    if keep == "largest":
        return kernels.largest(mask)
    return kernels.remove_small(mask, max(1, int(SMALL_AREA * mask.size)))


def saturation_p95(rgb: np.ndarray) -> float:
    return float(np.percentile(kernels.saturation(rgb), 95))


def tissue_mask(rgb: np.ndarray, method: str | None = None, stain: str | None = None) -> tuple[np.ndarray, str]:
    """The mask and the method that made it.  Without a method the stain decides."""
    method = method or route(stain)
    if method == "adaptive":
        method = "union_s" if saturation_p95(rgb) > SATURATED else "union"
    if method in ("otsu", "otsu_s"):
        return otsu_mask(rgb, method == "otsu_s"), method
    if method in ("entropy", "entropy_s"):
        return entropy_mask(rgb, method == "entropy_s"), method
    if method in ("union", "union_s"):
        return otsu_mask(rgb) | entropy_mask(rgb, method == "union_s"), method
    if method == "intersection":
        return otsu_mask(rgb) & entropy_mask(rgb), method
    raise ValueError(f"no tissue method {method!r}; there are {', '.join(METHODS)}")


def route(stain: str | None) -> str:
    return "otsu_s" if (stain or "").strip().lower() in SATURATION_STAINS else "union"


def routed(stain: Column) -> Column:
    return F.when(stain_name(stain).isin(*SATURATION_STAINS), "otsu_s").otherwise("union")


def segment(planes: DataFrame, method: str | None = None) -> DataFrame:
    """(plane, coverage, method, mask, error_type, error): packed tissue mask of each RGB plane and its share
    of the plane.  planes: (plane, h, w, data[, stain])."""
    has_stain = "stain" in planes.columns

    def kernel(rgb: np.ndarray, row) -> dict:
        mask, used = tissue_mask(rgb, method, row["stain"] if has_stain else None)
        return {"coverage": float(mask.mean()), "method": used, "mask": np.packbits(mask).tobytes()}

    return per_plane(planes, kernel, "coverage double, method string, mask binary", extra=["stain"] if has_stain else None)


def unpack(bits: bytes | None, shape: tuple[int, int]) -> np.ndarray:
    """A packed mask as booleans; nothing is an empty mask."""
    if bits is None:
        return np.zeros(shape, bool)
    return np.unpackbits(np.frombuffer(bits, np.uint8), count=shape[0] * shape[1]).reshape(shape).astype(bool)
