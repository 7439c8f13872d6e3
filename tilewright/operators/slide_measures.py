"""Focus, staining, pen and tile measures of planes, over tissue without what is excluded."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.operators import kernels
from tilewright.operators.normalization import to_lab
from tilewright.operators.planes import per_plane
from tilewright.operators.tissue import tissue_mask, unpack

#: Fixed value: chunks of a mask with more tissue than this and less than all are segmented again.
REFINE_FROM = 0.10


def support(row, shape: tuple[int, int]) -> np.ndarray:
    out = unpack(row["tissue"], shape)
    for other in ("fold", "pen"):
        if row.get(other) is not None:
            out &= ~unpack(row[other], shape)
    return out


def _with_masks(planes: DataFrame) -> list[str]:
    return [c for c in ("tissue", "fold", "pen") if c in planes.columns]


def measure(planes: DataFrame) -> DataFrame:
    """(plane, focus, staining, support_px, error...) of each RGB plane with its masks; without support both are
    null and there is an error."""

    def kernel(rgb: np.ndarray, row) -> dict:
        where = support(row, rgb.shape[:2])
        if not where.any():
            raise ValueError("empty support")
        lab = to_lab(rgb[where])
        return {"focus": kernels.laplacian_variance(kernels.gray(rgb), where), "staining": float(np.sqrt(lab[:, 1] ** 2 + lab[:, 2] ** 2).mean()), "support_px": int(where.sum())}

    return per_plane(planes, kernel, "focus double, staining double, support_px long", extra=_with_masks(planes))


def pen(planes: DataFrame, model: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """(plane, pen_fraction, mask, error...): pen marks by a model that maps an image (float, -0.5..0.5, sides
    padded to 32) to a boolean mask; as a share of the whole plane; folds, if given, are left out."""

    def kernel(rgb: np.ndarray, row) -> dict:
        h, w = rgb.shape[:2]
        padded = np.pad(rgb, ((64, 64 + -h % 32), (64, 64 + -w % 32), (0, 0)), mode="reflect" if min(h, w) > 96 else "edge")
        mask = np.asarray(model(padded / 255.0 - 0.5), bool)[64 : 64 + h, 64 : 64 + w]
        if row.get("fold") is not None:
            mask &= ~unpack(row["fold"], (h, w))
        return {"pen_fraction": float(mask.mean()), "mask": np.packbits(mask).tobytes()}

    return per_plane(planes, kernel, "pen_fraction double, mask binary", extra=[c for c in ("fold",) if c in planes.columns])


def refined_chunks(chunks: DataFrame, refine_from: float = REFINE_FROM) -> DataFrame:
    """(plane, state, coarse, refined, mask, reseg_error, error...) of the chunks that make up a plane (plane as
    key of the chunk, h, w, data, coarse, support[, stain]).  A chunk of more than `refine_from` and less than all
    tissue is segmented again (`refined`); where that fails (`failed`), and in `interior` and `sparse` chunks, the
    coarse mask stays.  Chunks do not depend on each other, so a plane's go to as many tasks as there are."""

    def kernel(rgb: np.ndarray, row) -> dict:
        where, coarse, error = unpack(row["support"], rgb.shape[:2]), float(row["coarse"]), None
        state = "interior" if coarse >= 1 else "refined" if coarse > refine_from else "sparse"
        if state == "refined":
            try:
                where, _ = tissue_mask(rgb, None, row.get("stain"))
            except Exception as e:
                state, error = "failed", str(e)[:300]
        return {"state": state, "refined": float(where.mean()), "mask": np.packbits(where).tobytes(), "reseg_error": error}

    extra = ["coarse", "support", *(["stain"] if "stain" in chunks.columns else [])]
    return per_plane(chunks, kernel, "state string, refined double, mask binary, reseg_error string", extra=extra)


def chunk_counts(refined: DataFrame, key: str = "slide") -> DataFrame:
    """(key, n_chunks, n_resegmented, n_carried_sparse, n_carried_interior, n_reseg_failed) of refined chunks."""
    states = {"n_resegmented": "refined", "n_carried_sparse": "sparse", "n_carried_interior": "interior", "n_reseg_failed": "failed"}
    return refined.groupBy(key).agg(F.count(F.lit(1)).alias("n_chunks"), *[F.count_if(F.col("state") == s).alias(n) for n, s in states.items()])


def tile_measures(tiles: DataFrame, drop_below: float | None = None) -> DataFrame:
    """Measures of tile rows (plane as key of the tile, h, w, data, coarse, support[, stain]): refined fraction,
    whether it was segmented again (as all are that are not all tissue), focus and the error of either step.

    A tile that the coarse fraction drops must be filtered out before its pixels are read; see
    grid.two_pass_drop."""

    def kernel(rgb: np.ndarray, row) -> dict:
        shape = rgb.shape[:2]
        where, coarse, out = unpack(row["support"], shape), float(row["coarse"]), {"resegmented": False, "reseg_error": None}
        if coarse < 1:
            try:
                where, _ = tissue_mask(rgb, None, row.get("stain"))
                out["resegmented"] = True
            except Exception as e:
                out["reseg_error"] = str(e)[:300]
        refined = float(where.mean())
        return out | {"refined": refined, "focus": kernels.laplacian_variance(kernels.gray(rgb), where), "dropped_pass2": drop_below is not None and refined < drop_below}

    extra = ["coarse", "support", *(["stain"] if "stain" in tiles.columns else [])]
    return per_plane(tiles, kernel, "refined double, resegmented boolean, reseg_error string, focus double, dropped_pass2 boolean", extra=extra)
