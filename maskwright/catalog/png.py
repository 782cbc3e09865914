"""Test fixture, no operator: embeddings written as small PNG files, so that the image scan has files to read."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F


def png_bytes(pixels: np.ndarray) -> bytes:
    """An 8-bit grey (H x W) or colour (H x W x 3) PNG."""
    height, width = pixels.shape[:2]
    lines = b"".join(b"\0" + row.tobytes() for row in pixels.astype(np.uint8))

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    header = struct.pack(">IIBBBBB", width, height, 8, 2 if pixels.ndim == 3 else 0, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", header) + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b"")


def as_png(values: Column, *shape: int) -> Column:
    @F.arrow_udf("binary")
    def encode(rows: pa.Array) -> pa.Array:
        return pa.array([png_bytes(np.array(r, np.uint8).reshape(shape)) for r in rows.to_pylist()], pa.binary())

    return encode(values)
