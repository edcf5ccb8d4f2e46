"""Ingest of objects named by a manifest of locations: one row a location, whatever becomes of it.

The manifest is cut into tasks of ``objects_per_task`` locations, whose rows are narrow; content is held for ``rows_per_output``
objects at a time. The loader (location -> bytes) is injected, one client a task; it raises ``FileNotFoundError`` for what
is not there, which is not asked for again. Any other failure is, ``tries`` times in all.

Status: ``Success``; ``empty`` (no bytes); ``missing`` (no location, or nothing there); ``failed`` (every try failed; ``error`` says how).
A task that is run again loads its locations again, so loaders must only read.
"""

from __future__ import annotations

import base64
import time
from urllib.parse import unquote_to_bytes, urlparse

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asrprep.functions.urls import file_name
from asrprep.session import pin

SUCCESS, EMPTY, MISSING, FAILED = "Success", "empty", "missing", "failed"


def open_location(location: str) -> bytes:
    """The default loader: ``data:`` URLs, ``file:`` URLs and paths of a file system that all executors mount."""
    if location.startswith("data:"):
        head, comma, body = location[5:].partition(",")
        if not comma:
            raise ValueError("a data: URL without a comma")
        return base64.b64decode(unquote_to_bytes(body), validate=True) if head.endswith(";base64") else unquote_to_bytes(body)
    url = urlparse(location)
    if url.scheme not in ("", "file"):
        raise ValueError(f"no loader for {url.scheme}: locations")
    with open(url.path if url.scheme else location, "rb") as f:
        return f.read()


def fetch(loader, location: str | None, tries: int, delay: float) -> tuple[bytes | None, str, int, str | None]:
    """(content, status, calls made, error) of one location."""
    if location is None or not location.strip():
        return None, MISSING, 0, None
    error = None
    for n in range(1, tries + 1):
        try:
            data = loader(location)
            return data, SUCCESS if data else EMPTY, n, None
        except FileNotFoundError as e:
            return None, MISSING, n, f"{type(e).__name__}: {e}"
        except Exception as e:  # noqa: BLE001 - whatever a client raises is tried again, then recorded
            error = f"{type(e).__name__}: {e}"
            if n < tries and delay:
                time.sleep(delay * n)
    return None, FAILED, tries, error


def read_locations(manifest: DataFrame, location_col: str, loader=open_location, key_cols: tuple[str, ...] = (), tries: int = 3,
                   delay: float = 5.0, objects_per_task: int = 1000, rows_per_output: int = 8, with_content: bool = True) -> DataFrame:
    """``(key_cols..., location, file_name, length, content, status, attempts, error)`` for every row of ``manifest``; length is
    null unless something was read. ``loader`` may be a class, which each task then makes its client of."""
    rows = pin(manifest.select(*key_cols, F.col(location_col).cast("string").alias("location")))
    tasks = max(1, -(-rows.count() // objects_per_task), manifest.sparkSession.sparkContext.defaultParallelism)
    keys = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name in key_cols]
    out = [*keys, "location string", "length long", *["content binary"] * with_content, "status string", "attempts int", "error string"]

    def run(batches):
        client = loader() if isinstance(loader, type) else loader
        for pdf in batches:
            for at in range(0, len(pdf), rows_per_output):
                part = pdf.iloc[at:at + rows_per_output]
                got = [fetch(client, x, tries, delay) for x in part["location"]]
                made = {c: part[c] for c in key_cols} | {
                    "location": part["location"], "length": pd.array([None if d is None else len(d) for d, *_ in got], dtype="Int64")}
                if with_content:
                    made["content"] = [d for d, *_ in got]
                yield pd.DataFrame(made | {"status": [s for _, s, _, _ in got], "attempts": pd.array([n for *_, n, _ in got], dtype="Int32"),
                                           "error": [e for *_, e in got]})

    read = rows.repartition(tasks).mapInPandas(run, ", ".join(out))
    return read.select(*key_cols, "location", file_name("location").alias("file_name"), *[c for c in read.columns if c not in (*key_cols, "location")])

