"""Path, shard-name and version-name expressions."""

from __future__ import annotations

import mimetypes

from pyspark.sql import Column, functions as F

SHARD_PATTERN = r"([^/]*?)-(\d+)-(\d+)\.tfrec$"


def join_path(*parts: Column) -> Column:
    return F.concat_ws("/", *parts)


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def stem(path: Column) -> Column:
    """File name without folder and without its last extension; a leading dot is kept."""
    return F.regexp_extract(path, r"(\.*[^/]*?)(\.[^./]*)?$", 1)


def top_level(path: Column) -> Column:
    return F.split_part(path, F.lit("/"), F.lit(1))


def shard_name(split: Column, shard: Column, size: Column) -> Column:
    """``train-00-32.tfrec``. Two digits are a minimum, so shard 100 stays ``-100-``."""
    return F.format_string("%s-%02d-%d.tfrec", split, shard.cast("bigint"), size.cast("bigint"))


def shard_parts(path: Column) -> list[Column]:
    """The split, shard number and record count written in a shard file name."""
    return [
        F.regexp_extract(path, SHARD_PATTERN, 1).alias("split"),
        F.regexp_extract(path, SHARD_PATTERN, 2).try_cast("int").alias("shard"),
        F.regexp_extract(path, SHARD_PATTERN, 3).try_cast("int").alias("shard_size"),
    ]


def dotted_to_path(name: Column) -> Column:
    """``apps.demo`` to ``apps/demo``: every dot is replaced, also one before an extension."""
    return F.replace(name, F.lit("."), F.lit("/"))


def version_name(epoch_seconds: Column) -> Column:
    return F.concat(F.lit("v"), epoch_seconds.cast("bigint").cast("string"))


def repo_id(owner: Column, name: Column) -> Column:
    return F.concat_ws("/", owner, name)


def repo_url(prefix: Column, owner: Column, name: Column) -> Column:
    return F.concat_ws("/", prefix, owner, name)


def _text_extensions() -> list[str]:
    table = mimetypes.MimeTypes(filenames=()).types_map[True]
    return sorted(ext for ext, kind in table.items() if "text" in kind)


def is_text_file(path: Column) -> Column:
    """True when the extension maps to a MIME type that contains ``text``.

    A compression suffix is looked through first (``notes.txt.gz`` counts as text), and a
    name that starts with a dot and has no other dot has no extension.
    """
    name = F.regexp_replace(base_name(path), r"^\.+", "")
    inner = F.regexp_replace(name, r"(?<=.)\.(gz|Z|bz2|xz|br)$", "")
    extension = F.lower(F.regexp_extract(inner, r".(\.[^.]*)$", 1))
    return extension.isin(_text_extensions())
