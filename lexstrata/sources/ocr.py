"""OCR words of pictures; needs pytesseract and PIL at run time."""

from __future__ import annotations

import importlib.util
from collections.abc import Iterator

from pyspark.sql import DataFrame

SCHEMA = "img_id long, i int, text string, conf double, left int, top int, width int, height int"


def available() -> bool:
    return all(importlib.util.find_spec(m) for m in ("pytesseract", "PIL"))


def words(images: DataFrame, languages: str = "spa+eng", layout: str = "--psm 6") -> DataFrame:
    """Pictures (img_id, content) at 300 dpi to words with places; an unreadable one gives none."""
    if not available():
        raise ImportError("pytesseract and PIL are not installed")

    def read(batches: Iterator) -> Iterator:
        import io

        import pandas as pd
        import pytesseract
        from PIL import Image

        for batch in batches:
            for img_id, content in zip(batch.img_id, batch.content, strict=True):
                try:
                    found = pytesseract.image_to_data(Image.open(io.BytesIO(content)), lang=languages, config=layout, output_type=pytesseract.Output.DICT)
                except (OSError, pytesseract.TesseractError):
                    continue
                frame = pd.DataFrame({c: found[c] for c in ("text", "conf", "left", "top", "width", "height")})
                frame.insert(0, "i", range(len(frame)))
                frame.insert(0, "img_id", img_id)
                yield frame

    return images.select("img_id", "content").mapInPandas(read, SCHEMA)
