"""Synthetic slides: glass, an ellipse of tissue from two dyes, a fold band and a hole."""

import numpy as np

DYES = np.array([[0.65, 0.70, 0.29], [0.07, 0.99, 0.11]])


def slide(h=96, w=128, seed=7):
    """(rgb, tissue, band)"""
    rng = np.random.default_rng(seed)
    y, x = np.mgrid[0:h, 0:w]
    tissue = ((y - h / 2) / (0.34 * h)) ** 2 + ((x - w / 2) / (0.36 * w)) ** 2 < 1
    amounts = [np.where(tissue, a + b * rng.random((h, w)), 0) for a, b in ((0.5, 0.3), (0.4, 0.2))]
    band = tissue & (np.abs(y - h / 2) < max(2, 0.05 * h))
    for c in amounts:
        c[band] *= 2.5
    rgb = 255 * np.exp(-(amounts[0][..., None] * DYES[0] + amounts[1][..., None] * DYES[1]))
    rgb[~tissue] = 233
    return np.clip(rgb, 0, 255).astype(np.uint8), tissue, band
