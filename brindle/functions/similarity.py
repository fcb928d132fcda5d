"""Vector and signature expressions, and the quality presets."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def l2_normalize(c: Column) -> Column:
    by = F.array(F.sqrt(dot(c, c)))  # bound once, not for each component
    return F.element_at(F.transform(by, lambda norm: F.transform(c, lambda x: F.when(norm > 0, x.cast("double") / norm).otherwise(0.0))), 1)


def median_signature(c: Column) -> Column:
    """64 bits of a vector with 64 components: whether each is above their median."""
    ordered = F.array_sort(F.transform(c, lambda x: x.cast("double")))
    n = F.size(c)
    half = F.floor(n / 2).cast("int")
    by = F.transform(F.array(ordered), lambda s: (F.element_at(s, half) + F.element_at(s, half + 1)) / 2)  # sorted once
    bits = F.element_at(F.transform(by, lambda median: F.transform(c, lambda x, i: F.when(x.cast("double") > median, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long")))), 1)
    return F.aggregate(bits, F.lit(0).cast("long"), lambda s, x: s.bitwiseOR(x))


def ordinal_signature(c: Column, bits: int, seed: int) -> Column:
    """Bits of a vector in 64-bit numbers: whether one component is above another, for pairs that the seed chooses.

    Like the median signature it depends on the order of the components only; unused bits of the last number are 0.
    """

    def bit(k: Column) -> Column:
        n = F.size(c)
        a = F.pmod(F.xxhash64(F.lit(seed), k * 2), n)
        b = F.pmod(a + 1 + F.pmod(F.xxhash64(F.lit(seed), k * 2 + 1), F.greatest(n - 1, F.lit(1))), n)
        set_ = F.call_function("shiftleft", F.lit(1).cast("long"), k % 64)
        return F.when(F.get(c, a.cast("int")) > F.get(c, b.cast("int")), set_).otherwise(F.lit(0).cast("long"))

    all_bits = F.transform(F.sequence(F.lit(0), F.lit(bits - 1)), bit)
    words = [F.aggregate(F.slice(all_bits, at + 1, 64), F.lit(0).cast("long"), Column.bitwiseOR) for at in range(0, bits, 64)]
    return F.when(F.size(c) > 0, F.array(*words))


def hamming(a: Column, b: Column) -> Column:
    """Differing bits of two arrays of 64-bit numbers."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)


def mixed_distance(cosine: Column, bits_apart: Column, a: float, b: float, bits: int = 64) -> Column:
    return (1.0 - cosine) * a + bits_apart / float(bits) * b


@dataclass(frozen=True)
class Preset:
    """Limits and weights of one curation job."""

    min_size: tuple[int, int]
    aspect: tuple[float, float] | None
    brightness: tuple[float, float]
    contrast: float
    sharpness: float
    extreme_share: float
    duplicate: tuple[tuple[int, float], ...]  # Hamming limit and least cosine; any of them makes a duplicate
    distance: tuple[float, float]
    pick: tuple[float, float]
    score: dict[str, float]
    bonus: float = 0.0  # of favoured rows, for each pick after the first


# The four presets of the surveyed jobs.
PRESETS = {
    "game": Preset((800, 430), (1.30, 2.40), (10, 247), 15, 12, 0.62, ((16, -2.0), (25, 0.965)), (0.36, 0.64), (0.82, 0.18), {"log_area": 1.0, "log_sharpness": 0.7, "contrast": 0.012}, 0.015),
    "crawl": Preset((320, 180), None, (10, 247), 14, 10, 0.68, ((9, 0.91),), (0.55, 0.45), (0.74, 0.26), {"log_sharpness": 1.8, "contrast": 0.03, "saturation": 0.009, "center_activity": 9, "menu_penalty": -16}),
    "site": Preset((960, 540), (0.72, 2.45), (12, 245), 17, 20, 0.62, ((10, 0.90),), (0.55, 0.45), (0.72, 0.28), {"log_sharpness": 1.9, "contrast": 0.03, "saturation": 0.01, "center_activity": 10, "menu_penalty": -20}),
    "hd": Preset((960, 540), None, (12, 245), 18, 22, 0.58, ((10, 0.90),), (0.55, 0.45), (0.76, 0.24), {"log_sharpness": 1.7, "contrast": 0.025, "saturation": 0.008, "colorfulness": 0.012, "entropy": 2.2, "center_activity": 8, "menu_penalty": -18, "brightness_off": -2}),
}


def quality_score(preset: str) -> Column:
    """The preset's weighted sum over feature columns (width, height, sharpness, contrast and so on)."""
    terms = {
        "log_area": F.log1p(F.col("width") * F.col("height")) if preset == "game" else None,
        "log_sharpness": F.log1p("sharpness"),
        "brightness_off": F.abs(F.col("brightness") - 125) / 125 if preset == "hd" else None,
    }
    total = F.lit(0.0)
    for name, weight in PRESETS[preset].score.items():
        term = terms.get(name)
        total = total + (F.col(name) if term is None else term) * weight
    return total


def quality_gate(preset: str) -> Column:
    """Whether a row's size, aspect, brightness, contrast, sharpness and dark and bright shares are in the limits."""
    p = PRESETS[preset]
    ok = (F.col("width") >= p.min_size[0]) & (F.col("height") >= p.min_size[1]) & F.col("brightness").between(*p.brightness)
    ok = ok & (F.col("contrast") >= p.contrast) & (F.col("sharpness") >= p.sharpness) & (F.col("dark_share") <= p.extreme_share) & (F.col("bright_share") <= p.extreme_share)
    if p.aspect:
        ok = ok & (F.col("width") / F.greatest(F.col("height"), F.lit(1))).between(*p.aspect)
    return ok
