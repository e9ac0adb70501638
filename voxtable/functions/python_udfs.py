"""The two scalar functions that need Python; they take Arrow batches."""

from __future__ import annotations

import difflib

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def text_ratio(a: str | None, b: str | None) -> float:
    """Share of matching blocks, b against a; not symmetric."""
    return difflib.SequenceMatcher(None, a or "", b or "").ratio()


def byte_edits(a: bytes, b: bytes) -> int:
    """Levenshtein distance, by columns whose steps up and down are the bits of two long integers."""
    if len(a) < len(b):
        a, b = b, a
    if not b:
        return len(a)
    n = len(a)
    full, places = (1 << n) - 1, {c: int.from_bytes(np.packbits(np.frombuffer(a, np.uint8) == c, bitorder="little").tobytes(), "little") for c in set(a) & set(b)}
    up, down, edits, last = full, 0, n, n - 1
    for c in b:
        same = places.get(c, 0)
        flat = (((same & up) + up) ^ up) | same | down  # where the diagonal does not rise
        rise, fall = down | (full & ~(flat | up)), flat & up
        edits += (rise >> last) - (fall >> last)
        rise, fall = rise << 1 | 1, fall << 1
        up, down = (fall | ~((flat & full) | rise)) & full, rise & flat & full
    return edits


def text_similarity(previous: Column, current: Column) -> Column:
    @F.pandas_udf("double")
    def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([text_ratio(x, y) for x, y in zip(a, b, strict=True)])

    return ratio(previous, current)


def glyph_components(mask: np.ndarray, heights: tuple[int, int] = (4, 22), area: int = 250) -> tuple[int, int]:
    """(those of glyph size, all) 8-connected components of a 0/1 picture, by spreading the least label."""
    mask = np.asarray(mask, bool)
    labels = np.where(mask, np.arange(1, mask.size + 1).reshape(mask.shape), 0)
    far = mask.size + 1
    while True:
        grown = np.pad(np.where(mask, labels, far), 1, constant_values=far)
        least = np.min([grown[1 + dy : grown.shape[0] - 1 + dy, 1 + dx : grown.shape[1] - 1 + dx] for dy in (-1, 0, 1) for dx in (-1, 0, 1)], axis=0)
        new = np.where(mask, least, 0)
        if (new == labels).all():
            break
        labels = new
    like = 0
    kinds = np.unique(labels[mask])
    for k in kinds:
        ys, _ = np.nonzero(labels == k)
        like += heights[0] <= ys.max() - ys.min() + 1 <= heights[1] and len(ys) <= area
    return int(like), len(kinds)


def glyphs_udf(width: int, heights: tuple[int, int] = (4, 22), area: int = 250):
    """A function of a flat mask column: struct(n_like, n_total); zeros where there is no mask."""

    @F.pandas_udf("n_like int, n_total int")
    def count(mask: pd.Series) -> pd.DataFrame:
        found = [glyph_components(np.asarray(m).reshape(-1, width), heights, area) if m is not None else (0, 0) for m in mask]
        return pd.DataFrame(found, columns=["n_like", "n_total"])

    return count
