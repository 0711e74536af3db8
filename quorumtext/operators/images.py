"""Page images and their variants, in numpy: grey, denoised, contrast, sharpened, binary, adaptive, morphology.

Images are rows (page_id, width, height, rgb binary); variants are made in mapInPandas, only those that an engine is tried on.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

VARIANTS = ("original", "grayscale", "denoise", "autocontrast", "contrast", "sharpen", "binary", "adaptive", "morphology")
IMAGE = "page_id bigint, angle int, variant string, width int, height int, rgb binary"


def grayscale(rgb: np.ndarray) -> np.ndarray:
    """Luma in 16-bit fixed point, as image libraries round it."""
    r, g, b = (rgb[..., k].astype("int64") for k in range(3))
    return ((19595 * r + 38470 * g + 7471 * b + 0x8000) >> 16).astype("uint8")


def _windows(grey: np.ndarray, size: int = 3) -> np.ndarray:
    pad = size // 2
    return np.lib.stride_tricks.sliding_window_view(np.pad(grey, pad, mode="edge"), (size, size))


def median3(grey: np.ndarray) -> np.ndarray:
    return np.median(_windows(grey), axis=(2, 3)).astype("uint8")


def autocontrast(grey: np.ndarray) -> np.ndarray:
    """The range of grey stretched to 0..255."""
    low, high = int(grey.min()), int(grey.max())
    if high <= low:
        return grey.copy()
    scale = 255.0 / (high - low)
    return np.clip((np.arange(256) * scale - low * scale).astype("int64"), 0, 255).astype("uint8")[grey]


def contrast(grey: np.ndarray, factor: float = 1.8) -> np.ndarray:
    """Away from the mean grey."""
    mean = int(grey.mean() + 0.5)
    return np.clip(mean + (grey.astype("float64") - mean) * factor, 0, 255).astype("uint8")


def _blur(grey: np.ndarray, radius: float) -> np.ndarray:
    reach = int(np.ceil(3 * radius))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / radius) ** 2)
    kernel /= kernel.sum()
    out = np.pad(grey.astype("float64"), reach, mode="edge")
    out = np.apply_along_axis(np.convolve, 0, out, kernel, "valid")
    return np.apply_along_axis(np.convolve, 1, out, kernel, "valid")


def sharpen(grey: np.ndarray, radius: float = 1.5, percent: int = 180, threshold: int = 3) -> np.ndarray:
    """Unsharp mask: differences from the blurred page that reach the threshold are amplified."""
    grey = grey.astype("float64")
    apart = grey - _blur(grey, radius)
    return np.clip(np.where(np.abs(apart) >= threshold, grey + apart * percent / 100.0, grey), 0, 255).astype("uint8")


def binary(grey: np.ndarray) -> np.ndarray:
    return np.where(grey >= int(grey.mean()), 255, 0).astype("uint8")


def closing(grey: np.ndarray) -> np.ndarray:
    """Widest, then narrowest, of 3 by 3."""
    return _windows(_windows(grey).max(axis=(2, 3))).min(axis=(2, 3)).astype("uint8")


#: How each variant comes from another; "grayscale" comes from the page.
CHAIN = {
    "denoise": ("grayscale", median3), "autocontrast": ("denoise", autocontrast), "contrast": ("autocontrast", contrast), "sharpen": ("contrast", sharpen),
    "binary": ("sharpen", binary), "adaptive": ("binary", autocontrast), "morphology": ("adaptive", closing),
}


def made(rgb: np.ndarray, names: Iterable[str], contrast_factor: float = 1.8) -> dict[str, np.ndarray]:
    """The named variants of a page, as RGB; steps they share run once, others not at all."""
    steps: dict[str, np.ndarray] = {}

    def step(name: str) -> np.ndarray:
        if name not in steps:
            if name == "grayscale":
                steps[name] = grayscale(rgb)
            else:
                source, f = CHAIN[name]
                steps[name] = f(step(source), contrast_factor) if name == "contrast" else f(step(source))
        return steps[name]

    return {n: rgb if n == "original" else np.repeat(step(n)[..., None], 3, axis=2) for n in names}


def rotated(rgb: np.ndarray, angle: int) -> np.ndarray:
    """Counter-clockwise by a multiple of 90 degrees; 0 is the image itself."""
    return rgb if angle % 360 == 0 else np.rot90(rgb, angle % 360 // 90)


def without_alpha(pixels: np.ndarray) -> np.ndarray:
    return pixels[..., :3]


def variants(pages: DataFrame, names: Iterable[str] = ("adaptive", "morphology", "contrast", "sharpen", "original", "binary"), angles: Iterable[int] = (0, 90, 180, 270)) -> DataFrame:
    """pages (page_id, width, height, rgb) -> one row per angle and variant."""
    names, angles = tuple(names), tuple(angles)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for page in batch.itertuples():
                rgb = np.frombuffer(page.rgb, "uint8").reshape(page.height, page.width, -1)
                for angle in angles:
                    turned = rotated(without_alpha(rgb), angle)
                    h, w = turned.shape[:2]
                    yield pd.DataFrame([(page.page_id, angle, n, w, h, np.ascontiguousarray(x).tobytes()) for n, x in made(turned, names).items()], columns=[f.split()[0] for f in IMAGE.split(", ")])

    return pages.select("page_id", "width", "height", "rgb").mapInPandas(run, IMAGE)


def rendered(pages: DataFrame, render, dpi: int = 300) -> DataFrame:
    """(pdf_path, page, page_id) -> page_id, width, height, rgb, by a plug-in render(path, page from 1, scale) -> array or None for a page
    that isn't there; those pages have no row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                image = render(row.pdf_path, row.page, dpi / 72.0)
                if image is not None:
                    yield pd.DataFrame([(row.page_id, image.shape[1], image.shape[0], np.ascontiguousarray(image[..., :3]).tobytes())], columns=["page_id", "width", "height", "rgb"])

    return pages.select("pdf_path", "page", "page_id").mapInPandas(run, "page_id bigint, width int, height int, rgb binary")
