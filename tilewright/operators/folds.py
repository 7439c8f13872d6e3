"""Tissue folds: a connectivity sweep with soft thresholds, and a line feature, joined."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from tilewright.operators import kernels
from tilewright.operators.planes import per_plane
from tilewright.operators.tissue import unpack

#: Fixed values.  Stains whose fold feature is saturation minus intensity:
DIFFERENCE_STAINS = ("hirano", "lfb", "lfb/h&e", "lfb-he", "lfb/he")
#: shares of the component curve's maximum, contrast gates; for each feature
SOFT = {"difference": (0.64, 0.34, 0.40), "stain": (0.64, 0.25, 0.10)}
#: areas in square microns: least fold, largest speck, least line; opening radius, bands, speck roundness
LEAST_AREA, SPECK_AREA, LEAST_LINE, OPENING, BAND, ROUND = 3276.8, 13144.0, 44800.0, 3, 3, 0.5
#: line feature: disc of the local median, ridge widths and tensor width in microns, index that is hard
LOCAL, RIDGES, TENSOR, HARD_INDEX = 520.0, (35.0, 70.0, 105.0), 70.0, 200
DENSITY_FLOOR, LEVELS, LEAST_PIXELS = 0.15, 41, 10


def density10(rgb: np.ndarray) -> np.ndarray:
    return -np.log10((rgb.astype(np.float64) + 1) / 256)


def plane_vectors(od: np.ndarray, low: float, high: float, by_sum: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The two leading directions of densities (turned to a positive sum, or first component), and the
    extreme directions in their plane."""
    _, v = np.linalg.eigh(np.cov(od.T))
    v = v[:, [2, 1]]
    v = v * np.where((v.sum(0) if by_sum else v[0]) < 0, -1, 1)  # else angles would wrap around
    phi = np.arctan2(od @ v[:, 1], od @ v[:, 0])
    a, b = np.percentile(phi, [low, high])
    return v, v @ np.array([np.cos(a), np.sin(a)]), v @ np.array([np.cos(b), np.sin(b)])


def stain_feature(rgb: np.ndarray, tissue: np.ndarray) -> np.ndarray:
    """Concentration of the second stain (the one of less blue density)."""
    od = density10(rgb)
    bag = od[tissue]
    bag = bag[np.linalg.norm(bag, axis=1) > DENSITY_FLOOR]
    if len(bag) < 3:
        raise ValueError("too few stained pixels")
    _, a, b = plane_vectors(bag, 1, 99, by_sum=True)
    rows = [x if x.sum() >= 0 else -x for x in (a, b)]
    rows.sort(key=lambda x: -x[2])
    s = np.stack([x / max(np.linalg.norm(x), 1e-12) for x in rows])
    return np.maximum(od.reshape(-1, 3) @ np.linalg.pinv(s), 0)[:, 1].reshape(rgb.shape[:2])


def difference_feature(rgb: np.ndarray) -> np.ndarray:
    i, s = kernels.hsi(rgb)
    return s - i


def component_curve(feature: np.ndarray, tissue: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """Regions (eight neighbours) above each level."""
    return np.array([len(kernels.sizes(kernels.label((feature > t) & tissue))) for t in levels])


def level_at(levels: np.ndarray, counts: np.ndarray, share: float) -> float:
    reach = levels[counts >= share * counts.max()]
    return float(reach.max()) if len(reach) else float(levels.min())


def filtered(fold: np.ndarray, feature: np.ndarray, mpp: float, gate: float) -> np.ndarray:
    """Opening, then without small regions, round specks, and regions without contrast to their surroundings."""
    fold = kernels.opening(fold, OPENING)
    labels, out = kernels.label(fold), np.zeros_like(fold)
    least = max(1, round(LEAST_AREA / mpp**2))
    for (y0, y1, x0, x1), k, area in kernels.boxes(labels):
        if area <= least:
            continue
        # A region is looked at in its box, with room for the bands around it.
        part = np.s_[max(0, y0 - BAND - 1) : y1 + BAND + 1, max(0, x0 - BAND - 1) : x1 + BAND + 1]
        region = labels[part] == k
        if area < SPECK_AREA / mpp**2 and kernels.circularity(area, kernels.perimeter(region)) > ROUND:
            continue
        contrast = kernels.band_contrast(feature[part], region, BAND)
        if contrast is None or contrast >= gate:
            out[part] |= region
    return out


def soft_folds(rgb: np.ndarray, tissue: np.ndarray, mpp: float, stain: str | None = None) -> np.ndarray:
    kind = "difference" if (stain or "").strip().lower() in DIFFERENCE_STAINS else "stain"
    alpha, beta, gate = SOFT[kind]
    if kind == "difference":
        feature, levels = difference_feature(rgb), np.linspace(-1, 1, LEVELS)
    else:
        feature = stain_feature(rgb, tissue)
        levels = np.linspace(*np.percentile(feature[tissue], [0.5, 99.5]), LEVELS)
    counts = component_curve(feature, tissue, levels)
    hard, soft = (level_at(levels, counts, share) for share in (alpha, beta))
    return filtered(kernels.hysteresis((feature > min(soft, hard)) & tissue, (feature > hard) & tissue), feature, mpp, gate)


def line_feature(rgb: np.ndarray, tissue: np.ndarray, mpp: float) -> np.ndarray:
    """Ridges of density that stand out of their surroundings and run in one direction."""
    if tissue.sum() < LEAST_PIXELS:
        raise ValueError("too little tissue for the line feature")
    d = np.linalg.norm(density10(rgb), axis=2)
    low, high = np.percentile(d[tissue], [0.1, 99.9])
    scale = 255 / max(high - low, 1e-12)
    q = np.clip(np.rint((d - low) * scale), 0, 255).astype(np.uint8)
    med, mad = kernels.masked_median_mad(q, tissue, max(1, round(LOCAL / mpp)))
    spread = np.median(np.abs(d[tissue] - np.median(d[tissue]))) * scale
    z = np.nan_to_num((q - med) / np.maximum(mad + 0.01 * spread, 1e-12))
    ridge = kernels.ridges(d, [max(0.5, s / mpp) for s in RIDGES])
    line = ridge * kernels.coherence(d, max(0.5, TENSOR / mpp), where=tissue) * np.maximum(z, 0)
    return np.where(tissue, line, 0)


def line_folds(feature: np.ndarray, tissue: np.ndarray, mpp: float, hard: int = HARD_INDEX) -> np.ndarray:
    """Pixels in the top of the stretched feature, in regions of at least a line's area."""
    values = feature[tissue & np.isfinite(feature)]
    if len(values) < LEAST_PIXELS:
        return np.zeros_like(tissue)
    low, high = np.percentile(values, [1, 99])
    if high <= low:
        return np.zeros_like(tissue)
    idx = np.rint(255 * np.clip((feature - low) / (high - low), 0, 1))
    return kernels.remove_small((idx >= hard) & tissue, max(1, round(LEAST_LINE / mpp**2)) - 1, eight=True)


def detect(planes: DataFrame, lines: bool = True) -> DataFrame:
    """(plane, fold_fraction, soft_fraction, line_fraction, line_error, mask, error...): folds as shares of the
    tissue.  planes: (plane, h, w, data, mpp, tissue[, stain]).  Without tissue there is an error; if only
    the line feature fails, the rest stands."""
    has_stain = "stain" in planes.columns

    def kernel(rgb: np.ndarray, row) -> dict:
        tissue = unpack(row["tissue"], rgb.shape[:2])
        if not tissue.any():
            raise ValueError("no tissue")
        soft = soft_folds(rgb, tissue, float(row["mpp"]), row["stain"] if has_stain else None)
        out, line = {}, None
        if lines:
            try:
                line = line_folds(line_feature(rgb, tissue, float(row["mpp"])), tissue, float(row["mpp"]))
            except Exception as e:
                out["line_error"] = str(e)[:300]
        n = float(tissue.sum())
        fold = soft if line is None else soft | line
        return out | {"soft_fraction": soft.sum() / n, "line_fraction": None if line is None else line.sum() / n, "fold_fraction": fold.sum() / n, "mask": np.packbits(fold).tobytes()}

    schema = "fold_fraction double, soft_fraction double, line_fraction double, line_error string, mask binary"
    return per_plane(planes, kernel, schema, extra=["mpp", "tissue", *(["stain"] if has_stain else [])])
