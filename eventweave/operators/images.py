"""Image quality from Spark's image source: one row in, one row out, Arrow batch by batch."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventweave.functions.textfuncs import quality_flags

MEASURES = ("focus_score", "motion_blur_score", "brightness_mean", "brightness_p05", "brightness_p95", "contrast_score", "highlight_clip_ratio", "shadow_clip_ratio")


def measure(gray: np.ndarray) -> tuple[float, ...]:
    """Of a gray image in [0, 1]: variance of the Laplacian (edges repeated outwards), smaller to larger mean gradient of both directions
    (0 without any), brightness, contrast, shares at or over 0.98 and at or under 0.02."""
    wide = np.pad(gray, 1, mode="edge")
    beside = sum(np.roll(wide, step, axis)[1:-1, 1:-1] for axis in (0, 1) for step in (-1, 1))
    lap = beside - 4 * gray
    dx, dy = np.abs(np.diff(gray, axis=1)).mean() if gray.shape[1] > 1 else 0.0, np.abs(np.diff(gray, axis=0)).mean() if gray.shape[0] > 1 else 0.0
    ratio = min(dx, dy) / max(dx, dy) if max(dx, dy) > 0 else 0.0
    return float(lap.var()), float(ratio), float(gray.mean()), float(np.quantile(gray, 0.05)), float(np.quantile(gray, 0.95)), float(gray.std()), float((gray >= 0.98).mean()), float((gray <= 0.02).mean())


def image_quality(images: DataFrame, kernel=measure) -> DataFrame:
    """images: key and Spark's image struct (flattened: height, width, nChannels, data)."""

    def run(batches):
        for pdf in batches:
            rows = []
            for r in pdf.itertuples():
                px = np.frombuffer(r.data, np.uint8).reshape(r.height, r.width, r.nChannels).astype(float) / 255
                gray = px[:, :, :3] @ np.array([0.114, 0.587, 0.299]) if r.nChannels >= 3 else px[:, :, 0]  # stored as BGR
                rows.append((r.key, *kernel(gray)))
            yield pd.DataFrame(rows, columns=["key", *MEASURES])

    flat = images.select("key", "image.height", "image.width", "image.nChannels", "image.data")
    out = flat.mapInPandas(run, "key string, " + ", ".join(f"{m} double" for m in MEASURES))
    return out.withColumns(quality_flags(F.col("focus_score"), F.col("brightness_mean"), F.col("brightness_p95"), F.col("highlight_clip_ratio"), F.col("contrast_score")))
