"""Files on shared storage, opened from tasks through Arrow file systems."""

from __future__ import annotations

import os
import uuid
from contextlib import contextmanager
from fnmatch import fnmatchcase

from pyarrow import fs

_SCHEMES = {"s3a": "s3", "s3n": "s3"}


def open_path(path: str) -> tuple[fs.FileSystem, str]:
    """The file system and the path in it, from a plain path or a URI as Spark writes it."""
    scheme, colon, rest = path.partition(":")
    if colon and scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    if colon and "/" not in scheme:
        return fs.FileSystem.from_uri(f"{_SCHEMES.get(scheme, scheme)}:{rest}")
    return fs.LocalFileSystem(), path


def list_files(path: str) -> list[tuple[str, int]]:
    """Files of a folder, or those matching a pattern in the last path part: (path, bytes), sorted.

    Names that start with a dot or an underscore are skipped.
    """
    system, inner = open_path(path)
    folder, _, pattern = inner.rpartition("/")
    if not any(c in pattern for c in "*?["):
        info = system.get_file_info(inner)
        if info.type == fs.FileType.File:
            return [(path, info.size)]
        folder, pattern = inner, "*"
    found = system.get_file_info(fs.FileSelector(folder or "/"))
    prefix = path[: len(path) - len(inner)]
    return sorted((prefix + f.path, f.size) for f in found
                  if f.type == fs.FileType.File and fnmatchcase(f.base_name, pattern)
                  and not f.base_name.startswith((".", "_")))


def folder_size(folder: str, suffix: str) -> tuple[int, int] | None:
    """Number and bytes of the files with a suffix, not recursive; None if it is no folder (a pattern of folders)."""
    system, inner = open_path(folder)
    if system.get_file_info(inner).type != fs.FileType.Directory:
        return None
    sizes = [f.size for f in system.get_file_info(fs.FileSelector(inner))
             if f.type == fs.FileType.File and f.base_name.endswith(suffix)]
    return len(sizes), sum(sizes)


def walk(root: str) -> list[tuple[str, int]]:
    """Every file below ``root``, hidden and empty ones too: (path relative to it, bytes), sorted."""
    system, inner = open_path(root)
    inner = inner.rstrip("/")
    found = system.get_file_info(fs.FileSelector(inner, recursive=True))
    return sorted((f.path[len(inner) + 1:], f.size) for f in found if f.type == fs.FileType.File)


def pack(sizes: list[tuple[str, int]], target: int) -> list[list[str]]:
    """Neighbouring files put together up to ``target`` bytes, so that small files share a task."""
    groups, held = [], 0
    for path, size in sizes:
        if not groups or held + size > target:
            groups.append([])
            held = 0
        groups[-1].append(path)
        held += size
    return groups


@contextmanager
def replacing(folder: str, name: str):
    """Write ``folder/name`` whole or not at all: a hidden file is moved in place at the end.

    A task that is run again writes the same name again, so a lost executor leaves no half file.
    """
    system, inner = open_path(folder)
    final = f"{inner.rstrip('/')}/{name}"
    parent, _, base = final.rpartition("/")
    system.create_dir(parent, recursive=True)
    hidden = f"{parent}/.{base}.{uuid.uuid4().hex}"
    try:
        with system.open_output_stream(hidden) as stream:
            yield stream
    except BaseException:
        system.delete_file(hidden)
        raise
    try:
        system.move(hidden, final)
    except OSError:
        # Some stores refuse to move onto a file; an earlier attempt has written the same bytes.
        if system.get_file_info(final).type != fs.FileType.File:
            raise
        system.delete_file(hidden)


def claimed(folder: str) -> list[str]:
    """The claims in a folder, first to last; none if there is no such folder."""
    system, inner = open_path(folder)
    if system.get_file_info(inner).type != fs.FileType.Directory:
        return []
    return [path for path, _ in list_files(folder) if path.rpartition("/")[2].isdigit()]


def claim(spark, folder: str, content: bytes = b"") -> int:
    """Take the next number, from 1, by creating the file ``folder/<number>`` with ``content``; returns the number.

    Of several that try for a number at once one gets it, and the others go on to the next: numbers are without gaps and
    in the order in which they were taken, whatever the clocks say. It rests on a file system that creates a link, or
    renames, only where no file is yet: local ones and HDFS do; an object store without that may hand out a number twice.
    """
    system, inner = open_path(folder)
    inner = inner.rstrip("/")
    system.create_dir(inner, recursive=True)
    hidden = f"{inner}/.claim-{uuid.uuid4().hex}"
    with system.open_output_stream(hidden) as stream:
        stream.write(content)
    number = max((int(path.rpartition("/")[2]) for path in claimed(folder)), default=0) + 1
    prefix = folder.rstrip("/")[: len(folder.rstrip("/")) - len(inner)]
    while not _placed(spark, system, prefix, hidden, f"{inner}/{number:012d}"):
        number += 1
    return number


def _placed(spark, system: fs.FileSystem, prefix: str, hidden: str, final: str) -> bool:
    """Move ``hidden`` to ``final`` unless there is such a file already."""
    if isinstance(system, fs.LocalFileSystem):
        try:
            os.link(hidden, final)
        except FileExistsError:
            return False
        os.unlink(hidden)
        return True
    hadoop = spark._jvm.org.apache.hadoop
    source, target = (hadoop.fs.Path(prefix + x) for x in (hidden, final))
    files = hadoop.fs.FileContext.getFileContext(source.toUri(), spark._jsc.hadoopConfiguration())
    if files.util().exists(target):
        return False
    try:
        files.rename(source, target, spark._sc._gateway.new_array(hadoop.fs.Options.Rename, 0))
    except Exception:
        if files.util().exists(target):  # another one was faster
            return False
        raise
    return True
