"""PDF and OCR sources (S-32, S-33): external programs run where the files are read, one file or page a row.

A missing program or a broken file is a row with an error, never a missing row. OCR results are keyed by the SHA-256 of the file and the
page, so a table of earlier results can be anti-joined before the pages are read again.
"""

from __future__ import annotations

import subprocess
import tempfile
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def files(spark: SparkSession, folder: str, pattern: str = "*.pdf") -> DataFrame:
    """(path, sha, content, is_pdf) of the files of a folder."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return raw.select("path", F.sha2("content", 256).alias("sha"), "content", (F.substring("content", 1, 4) == F.lit(b"%PDF")).alias("is_pdf"))


def _call(command: list[str], content: bytes) -> tuple[bytes | None, str | None]:
    try:
        done = subprocess.run(command, input=content, capture_output=True, timeout=300, check=False)
    except (OSError, subprocess.TimeoutExpired) as e:
        return None, f"{command[0]}: {type(e).__name__}"
    return (done.stdout, None) if done.returncode == 0 else (None, done.stderr.decode("utf-8", "replace")[:300] or f"exit {done.returncode}")


def page_texts(pdfs: DataFrame, program: str = "pdftotext") -> DataFrame:
    """(sha, page, text, error): the layout text of each page; page 0 with an error where there is none."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for sha, content in zip(frame["sha"], frame["content"], strict=True):
                text, error = _call([program, "-layout", "-", "-"], bytes(content))
                pages = [] if text is None else text.decode("utf-8", "replace").rstrip("\f").split("\f")
                out += [(sha, i, p, None) for i, p in enumerate(pages, 1)] or [(sha, 0, None, error)]
            yield pd.DataFrame(out, columns=["sha", "page", "text", "error"])

    return pdfs.select("sha", "content").mapInPandas(run, "sha string, page int, text string, error string")


def ocr_texts(pages: DataFrame, language: str = "pol", render: str = "pdftoppm", read: str = "tesseract") -> DataFrame:
    """pages: (sha, content, page). Returns (sha, page, text, error) by rendering and reading each page; pages spread over tasks."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for sha, content, page in zip(frame["sha"], frame["content"], frame["page"], strict=True):
                with tempfile.TemporaryDirectory() as folder:  # a task's own working files; nothing reads them after it
                    source = Path(folder, "in.pdf")
                    source.write_bytes(bytes(content))
                    image, error = _call([render, "-r", "300", "-f", str(page), "-l", str(page), "-png", str(source)], b"")
                    text, error = _call([read, "-", "-", "-l", language, "--psm", "1"], image) if image is not None else (None, error)
                out.append((sha, int(page), text.decode("utf-8", "replace") if text is not None else None, error))
            yield pd.DataFrame(out, columns=["sha", "page", "text", "error"])

    return pages.select("sha", "content", "page").mapInPandas(run, "sha string, page int, text string, error string")
