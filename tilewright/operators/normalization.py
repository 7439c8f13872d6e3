"""Stain normalization with frozen parameters: fit once, apply anywhere."""

from __future__ import annotations

import hashlib
import json

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.operators.folds import plane_vectors
from tilewright.operators.planes import per_plane
from tilewright.operators.tissue import unpack

LEAST_PIXELS, FLOOR = 3, 1e-8

#: sRGB to XYZ over the white point, for Lab.
_XYZ = np.array([[0.412453, 0.357580, 0.180423], [0.212671, 0.715160, 0.072169], [0.019334, 0.119193, 0.950227]]) / np.array([[0.95047], [1.0], [1.08883]])


def densities(bag: np.ndarray) -> np.ndarray:
    return np.maximum(-np.log(np.maximum(bag.astype(np.float64), 1) / 255), 1e-6)


def from_densities(od: np.ndarray) -> np.ndarray:
    return np.clip(255 * np.exp(-od), 0, 255).astype(np.uint8)


def bag(rgb: np.ndarray, mask: np.ndarray | None) -> np.ndarray:
    if mask is not None and mask.shape != rgb.shape[:2]:
        raise ValueError("the mask has another size than the image")
    pixels = rgb.reshape(-1, 3) if mask is None else rgb[mask]
    if len(pixels) < LEAST_PIXELS:
        raise ValueError("too few pixels to fit")
    return pixels


def concentrations(pixels: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """Least-squares amounts of two stains; they may be negative."""
    return np.linalg.lstsq(matrix.T, densities(pixels).T, rcond=None)[0].T


def to_lab(pixels: np.ndarray) -> np.ndarray:
    s = pixels.astype(np.float64) / 255
    t = np.where(s > 0.04045, ((s + 0.055) / 1.055) ** 2.4, s / 12.92) @ _XYZ.T
    f = np.where(t > 0.008856, np.cbrt(t), 7.787 * t + 16 / 116)
    return np.stack([116 * f[:, 1] - 16, 500 * (f[:, 0] - f[:, 1]), 200 * (f[:, 1] - f[:, 2])], 1)


def from_lab(lab: np.ndarray) -> np.ndarray:
    y = (lab[:, 0] + 16) / 116
    f = np.stack([y + lab[:, 1] / 500, y, y - lab[:, 2] / 200], 1)
    t = np.where(f > 0.206893, f**3, (f - 16 / 116) / 7.787)
    s = np.clip(t @ np.linalg.inv(_XYZ).T, 0, 1)
    s = np.where(s > 0.0031308, 1.055 * s ** (1 / 2.4) - 0.055, 12.92 * s)
    return np.clip(np.rint(255 * s), 0, 255).astype(np.uint8)


#: Scale and shift of byte Lab, in single precision so that bytes come back as they were.
_SCALE, _SHIFT = np.array([2.55, 1, 1], np.float32), np.array([0, 128, 128], np.float32)


def to_lab8(pixels: np.ndarray) -> np.ndarray:
    """Lab in bytes: L over 0..255, a and b around 128."""
    return np.clip(np.rint(to_lab(pixels) * (2.55, 1, 1) + (0, 128, 128)), 0, 255)


class Macenko:
    """Two stain vectors in optical density, and the 99th percentile of each stain's amount."""

    @staticmethod
    def fitted(pixels: np.ndarray) -> dict:
        _, a, b = plane_vectors(densities(pixels), 1, 99)
        rows = sorted((x if x[0] >= 0 else -x for x in (a, b)), key=lambda x: -x[0])
        m = np.stack([x / max(np.linalg.norm(x), 1e-12) for x in rows])
        return {"stain_matrix": m.tolist(), "max_c": np.percentile(concentrations(pixels, m), 99, axis=0).tolist()}

    @staticmethod
    def moved(pixels: np.ndarray, source: dict, target: dict) -> np.ndarray:
        amounts = concentrations(pixels, np.array(source["stain_matrix"]))
        amounts *= np.array(target["max_c"]) / np.maximum(source["max_c"], FLOOR)
        return from_densities(amounts @ np.array(target["stain_matrix"]))


class Reinhard:
    """Mean and spread of each Lab channel.  Channels are those of byte Lab (to_lab8), given as L over 0..100 and a
    and b around 0: parameters fitted on continuous Lab would not be comparable."""

    @staticmethod
    def channels(pixels: np.ndarray) -> np.ndarray:
        return (to_lab8(pixels).astype(np.float32) - _SHIFT) / _SCALE

    @staticmethod
    def pixels(channels: np.ndarray) -> np.ndarray:
        whole = np.trunc(np.clip(np.float32(channels) * _SCALE + _SHIFT, 0, 255)).astype(np.float64)
        return from_lab((whole - (0, 128, 128)) / (2.55, 1, 1))

    @classmethod
    def fitted(cls, pixels: np.ndarray) -> dict:
        x = cls.channels(pixels).astype(np.float64)
        return {"means": x.mean(0).tolist(), "stds": x.std(0).tolist(), "swatch": cls.pixels(x.mean(0)[None])[0].tolist(), "lab": "bytes"}

    @classmethod
    def moved(cls, pixels: np.ndarray, source: dict, target: dict) -> np.ndarray:
        scale = np.array(target["stds"]) / np.maximum(source["stds"], FLOOR)
        return cls.pixels((cls.channels(pixels) - source["means"]) * scale + target["means"])


METHODS = {"macenko": Macenko, "reinhard": Reinhard}


def method_of(name: str) -> type:
    if name not in METHODS:
        raise ValueError(f"no method {name!r}; there are {', '.join(METHODS)}")
    return METHODS[name]


def freeze(rgb: np.ndarray, mask: np.ndarray | None = None, method: str = "macenko") -> dict:
    """Parameters of one image, to be applied without being estimated again."""
    pixels = bag(rgb, mask)
    return {"method": method, "n_px": len(pixels)} | method_of(method).fitted(pixels)


def normalize(rgb: np.ndarray, target: dict, source: dict, mask: np.ndarray | None = None) -> np.ndarray:
    """The image with its (masked) pixels moved from the source's parameters to the target's; the others are
    as they were."""
    if source["method"] != target["method"]:
        raise ValueError("source and target were fitted by different methods")
    where = np.ones(rgb.shape[:2], bool) if mask is None else mask
    out = rgb.copy()
    out[where] = method_of(target["method"]).moved(rgb[where], source, target)
    return out


def params_hash(params: dict) -> str:
    """Identity of parameters, whatever the order of their keys."""
    return hashlib.sha256(json.dumps(params, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def fit_planes(planes: DataFrame, method: str = "macenko") -> DataFrame:
    """(plane, params JSON, params_hash, n_px, error...): frozen parameters of each plane."""
    masked = "tissue" in planes.columns

    def kernel(rgb: np.ndarray, row) -> dict:
        p = freeze(rgb, unpack(row["tissue"], rgb.shape[:2]) if masked else None, method)
        return {"params": json.dumps(p, sort_keys=True), "params_hash": params_hash(p), "n_px": p["n_px"]}

    return per_plane(planes, kernel, "params string, params_hash string, n_px long", extra=["tissue"] if masked else None)


def normalize_planes(planes: DataFrame, fitted: DataFrame, target: dict) -> DataFrame:
    """(plane, data, provenance, error...): each plane moved to the target with its own frozen parameters.  A plane
    whose fit failed gets that as its error."""
    masked = "tissue" in planes.columns
    both = planes.join(fitted.select("plane", "params", F.col("error").alias("fit_error")), "plane", "left")

    def kernel(rgb: np.ndarray, row) -> dict:
        if row["params"] is None:
            raise ValueError(f"no parameters: {row['fit_error'] or 'not fitted'}")
        source = json.loads(row["params"])
        out = normalize(rgb, target, source, unpack(row["tissue"], rgb.shape[:2]) if masked else None)
        return {"out": out.tobytes(), "provenance": json.dumps({"target": params_hash(target), "source": params_hash(source)})}

    return per_plane(both, kernel, "out binary, provenance string", extra=["params", "fit_error", *(["tissue"] if masked else [])]).withColumnRenamed("out", "data")
