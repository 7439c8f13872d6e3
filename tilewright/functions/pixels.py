"""Colour arithmetic on 8-bit channels as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed-point luminosity weights (15 bits), sRGB to XYZ (D65), and the D65 white point.
GRAY_WEIGHTS = (9798, 19235, 3735)
SRGB_TO_XYZ = (
    (0.412453, 0.357580, 0.180423),
    (0.212671, 0.715160, 0.072169),
    (0.019334, 0.119193, 0.950227),
)
WHITE = (0.95047, 1.0, 1.08883)


def gray(r: Column, g: Column, b: Column) -> Column:
    """8-bit luminosity, rounded in fixed point."""
    wr, wg, wb = GRAY_WEIGHTS
    return F.shiftright((r * wr + g * wg + b * wb + 16384).cast("int"), 15)


def saturation(r: Column, g: Column, b: Column) -> Column:
    """8-bit HSV saturation in 12-bit fixed point: (max - min) * round(255 * 4096 / max), rounded."""
    top, low = F.greatest(r, g, b), F.least(r, g, b)
    scale = F.when(top > 0, F.rint(F.lit(255 * 4096.0) / top)).otherwise(F.lit(0.0)).cast("int")
    return F.shiftright(((top - low) * scale + 2048).cast("int"), 12)


def hsi(r: Column, g: Column, b: Column) -> tuple[Column, Column]:
    """Intensity in 0..1 and saturation 1 - min / mean (0 where the mean is 0)."""
    i = (r + g + b) / F.lit(765.0)
    low = F.least(r, g, b) / F.lit(255.0)
    return i, F.when(i > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - low / i))).otherwise(F.lit(0.0))


def density10(v: Column) -> Column:
    """Optical density to base 10 of (v + 1) / 256."""
    return -F.log10((v + 1) / F.lit(256.0))


def density(v: Column) -> Column:
    """Natural optical density of max(v, 1) / 255, at least 1e-6."""
    return F.greatest(-F.log(F.greatest(v, F.lit(1)) / F.lit(255.0)), F.lit(1e-6))


def from_density(d: Column) -> Column:
    """255 e^-d, clipped to 0..255 and truncated."""
    return F.floor(F.greatest(F.lit(0.0), F.least(F.lit(255.0), 255 * F.exp(-d)))).cast("int")


def _linear(v: Column) -> Column:
    s = v / F.lit(255.0)
    return F.when(s > 0.04045, F.pow((s + 0.055) / 1.055, F.lit(2.4))).otherwise(s / 12.92)


def lab(r: Column, g: Column, b: Column) -> tuple[Column, Column, Column]:
    """CIE L*a*b* (D65, 2 degrees) of sRGB."""
    rgb = [_linear(c) for c in (r, g, b)]
    f = []
    for row, white in zip(SRGB_TO_XYZ, WHITE):
        t = sum((c * k for c, k in zip(rgb[1:], row[1:])), rgb[0] * row[0]) / white
        f.append(F.when(t > 0.008856, F.cbrt(t)).otherwise(7.787 * t + 16.0 / 116.0))
    return 116 * f[1] - 16, 500 * (f[0] - f[1]), 200 * (f[1] - f[2])


def chroma(r: Column, g: Column, b: Column) -> Column:
    _, a, bb = lab(r, g, b)
    return F.sqrt(a * a + bb * bb)


def blend(base: Column, tint: int, alpha: float, where: Column) -> Column:
    """base tinted where the condition holds, truncated to an integer."""
    return F.when(where, F.floor(base * (1 - alpha) + tint * alpha).cast("int")).otherwise(base)


def heat(t: Column) -> tuple[Column, Column, Column]:
    """Red over yellow to green as t goes from 0 to 1 (clipped), each channel 0..255."""
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), t))
    red = F.when(t <= 0.5, F.lit(255.0)).otherwise(255 * (2 - 2 * t))
    green = F.when(t <= 0.5, 255 * 2 * t).otherwise(F.lit(255.0))
    return red, green, F.lit(0.0)
