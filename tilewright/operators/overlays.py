"""Overlays for people to look at: masks, classes and focus heat over a plane."""

from __future__ import annotations

import numpy as np

from tilewright.operators.kernels import resized_nearest

#: Tints of masks and classes, and the strength of a tint.
TINTS = {"tissue": (0, 200, 0), "fold": (255, 0, 0), "pen": (0, 0, 255)}
CLASS_TINTS = {2: (255, 0, 0), 3: (120, 60, 0), 4: (0, 0, 255), 5: (0, 200, 200), 6: (255, 0, 255)}
ALPHA = 0.4


def tinted(rgb: np.ndarray, mask: np.ndarray, colour: tuple[int, int, int], alpha: float = ALPHA) -> np.ndarray:
    """The image with the mask's pixels blended with a colour, truncated; others as they are."""
    out = rgb.copy()
    out[mask] = (rgb[mask] * (1 - alpha) + np.array(colour) * alpha).astype(np.uint8)
    return out


def class_overlay(rgb: np.ndarray, classes: np.ndarray, shown: dict = CLASS_TINTS, alpha: float = ALPHA) -> np.ndarray:
    c = resized_nearest(classes, *rgb.shape[:2])
    for k, colour in shown.items():
        rgb = tinted(rgb, c == k, colour, alpha)
    return rgb


def heat(t: float) -> tuple[float, float, float]:
    """Red over yellow to green."""
    t = min(1.0, max(0.0, t))
    return (255.0, 510 * t, 0.0) if t <= 0.5 else (510 * (1 - t), 255.0, 0.0)


def focus_overlay(rgb: np.ndarray, tiles: list[dict], plane: tuple[int, int], low: float | None = None, high: float | None = None, alpha: float = ALPHA) -> np.ndarray:
    """Tiles (x, y, w, h, focus) coloured between the 5th and 95th percentile of focus (or given ends); with fewer
    than two values or no spread the image is returned as it is.  plane: (w, h) of the tile plane."""
    values = [t["focus"] for t in tiles if t.get("focus") is not None and np.isfinite(t["focus"])]
    if len(values) < 2:
        return rgb
    low = float(np.percentile(values, 5)) if low is None else low
    high = float(np.percentile(values, 95)) if high is None else high
    if high <= low:
        return rgb
    sy, sx = rgb.shape[0] / plane[1], rgb.shape[1] / plane[0]
    for t in tiles:
        if t.get("focus") is None:
            continue
        mask = np.zeros(rgb.shape[:2], bool)
        mask[int(t["y"] * sy) : int(np.ceil((t["y"] + t["h"]) * sy)), int(t["x"] * sx) : int(np.ceil((t["x"] + t["w"]) * sx))] = True
        rgb = tinted(rgb, mask, tuple(int(v) for v in heat((t["focus"] - low) / (high - low))), alpha)
    return rgb
