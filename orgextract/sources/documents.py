"""PDF files and their texts (S11-S15) behind optional parsers; responses table filter."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orgextract.functions import urls as u

MAX_BYTES = 4 * 1024 * 1024
MAX_CHARS = 400_000
OCR_BELOW = 256


def read_pdfs(spark: SparkSession, path: str, max_bytes: int = MAX_BYTES) -> DataFrame:
    """Path, content of .pdf files up to the size; the size test is pushed to the listing."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.[pP][dD][fF]").load(path).filter(F.col("length") <= max_bytes).select("path", "content")


def pdf_responses(responses: DataFrame, max_bytes: int | None = MAX_BYTES, max_seconds: float | None = 25) -> DataFrame:
    """S11, S12 over fetched responses (url, status, content_type, content_length, seconds, content): PDFs by content
    type or suffix, answered with 200 in time and within the size by header and by content. None lifts a limit."""
    pdf = F.contains(F.lower(F.coalesce("content_type", F.lit(""))), F.lit("application/pdf")) | u.is_pdf(F.col("url"))
    ok = pdf & (F.col("status") == 200) & F.col("content").isNotNull()
    if max_bytes is not None:
        ok = ok & (F.coalesce("content_length", F.lit(0)) <= max_bytes) & (F.length("content") <= max_bytes)
    if max_seconds is not None:
        ok = ok & (F.coalesce("seconds", F.lit(0.0)) <= max_seconds)
    return responses.filter(ok).select(F.col("url").alias("path"), "content")


def fetched_pages(wanted: DataFrame, fetched: DataFrame) -> DataFrame:
    """Wanted (url) with the page fetched under that URL or, where that failed or is missing, under the other scheme.

    fetched: (url unique, status, html); `source_url` is the URL that answered, null where neither did.
    """
    good = fetched.filter("status = 'ok'").select(F.col("url").alias("_u"), "html")
    first = wanted.join(good.withColumnRenamed("html", "_first"), F.col("url") == F.col("_u"), "left").withColumnRenamed("_u", "_own")
    both = first.withColumn("_other", u.flip_scheme(F.col("url"))).join(good, F.col("_other") == F.col("_u"), "left")
    source = F.coalesce("_own", "_u")
    return both.select("url", source.alias("source_url"), F.when(F.col("_own").isNotNull(), F.col("_first")).otherwise(F.col("html")).alias("html"))


def native_texts(content: bytes, pages: int | None, max_chars: int | None = MAX_CHARS) -> list[str]:
    """The first pages' texts (None: all), each cut at max_chars (None: whole); [] for a broken file or without the parser."""
    try:
        import io

        import pypdf
    except ImportError:  # optional parser
        return []
    try:
        found = pypdf.PdfReader(io.BytesIO(content)).pages
        return [(x.extract_text() or "")[:max_chars] for x in (found if pages is None else found[:pages])]
    except Exception:  # noqa: BLE001 - a broken file has no text
        return []


def pdf_texts(df: DataFrame, pages: int | None = 3, parser: Callable[[bytes, int | None], list[str]] = native_texts, ocr: Callable[[bytes], list[str]] | None = None) -> DataFrame:
    """Path, texts (one per page), ocr_texts. Recognition runs only where the native texts are shorter than
    OCR_BELOW; its texts stand beside the native ones and in their place where there are none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out, seen = [], []
            for c in b["content"]:
                texts = parser(bytes(c), pages)
                found = (ocr(bytes(c)) or []) if ocr and sum(map(len, texts)) < OCR_BELOW else []
                out.append(texts or found)
                seen.append(found)
            yield pd.DataFrame({"path": b["path"], "texts": out, "ocr_texts": seen})

    return df.select("path", "content").mapInPandas(run, "path string, texts array<string>, ocr_texts array<string>")


#: The largest picture handed to recognition.
OCR_MAX_PIXELS = 12_000_000


def prepared_image(pixels: np.ndarray, max_pixels: int = OCR_MAX_PIXELS) -> np.ndarray:
    """A picture made ready for recognition: grey, stretched to the full range, sharpened, scaled down to max_pixels.

    pixels: (height, width) or (height, width, 3), 0 to 255. An empty picture comes back as it is.
    """
    grey = pixels.astype(np.float64)
    if grey.ndim == 3:
        grey = grey[..., :3] @ np.array([0.299, 0.587, 0.114])
    if not grey.size:
        return grey.astype(np.uint8)
    low, high = grey.min(), grey.max()
    if high > low:
        grey = (grey - low) * 255 / (high - low)
    blur = _blurred(_blurred(grey).T).T
    edge = grey - blur
    grey = np.clip(np.where(np.abs(edge) > 3, grey + 1.5 * edge, grey), 0, 255)
    if grey.size > max_pixels:
        scale = (max_pixels / grey.size) ** 0.5
        h, w = (max(1, int(n * scale)) for n in grey.shape)
        rows, cols = np.arange(h) * grey.shape[0] // h, np.arange(w) * grey.shape[1] // w
        grey = grey[np.ix_(rows, cols)]
    return grey.round().astype(np.uint8)


def _blurred(x: np.ndarray, sigma: float = 1.5) -> np.ndarray:
    reach = 4
    k = np.exp(-(np.arange(-reach, reach + 1) ** 2) / (2 * sigma**2))
    padded = np.pad(x, ((0, 0), (reach, reach)), mode="edge")
    return sum(w * padded[:, i : i + x.shape[1]] for i, w in enumerate(k / k.sum()))


def text_responses(df: DataFrame, base: str) -> DataFrame:
    """Responses (url, content_type, body) of the base's host with a text type."""
    return df.filter(u.same_domain(F.col(base), F.col("url")) & u.is_text_type(F.col("content_type")) & ~u.is_blocked(F.col("url")))
