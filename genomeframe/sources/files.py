"""Files by path on any file system that Arrow reaches (local, HDFS, S3, GCS), for the sources that read bytes themselves."""

from __future__ import annotations

import io
import re

import pyarrow.fs as pafs


def _system(path: str) -> tuple[pafs.FileSystem, str]:
    local = re.sub(r"^file:/+", "/", path)
    return pafs.FileSystem.from_uri(local) if "://" in local else (pafs.LocalFileSystem(), local)


def _full(path: str, inner: str) -> str:
    """The path of a listed file in the manner of the path that was listed."""
    head = re.match(r"[a-z0-9+]+://[^/]*", path) if not path.startswith("file:") else None
    if head is None:
        return inner
    own = _system(path)[1].rstrip("/")
    return path.rstrip("/") + inner[len(own) :]


def listing(path: str, suffix: str) -> list[tuple[str, int]]:
    """(path, size) of a file, or of a folder's files with this suffix, in the order of their names."""
    system, inner = _system(path)
    info = system.get_file_info(inner)
    if info.type == pafs.FileType.Directory:
        found = [f for f in system.get_file_info(pafs.FileSelector(inner)) if f.is_file and f.base_name.endswith(suffix) and f.base_name[0] not in "._"]
        return sorted((_full(path, f.path), f.size) for f in found)
    return [(path, info.size)] if info.type == pafs.FileType.File else []


def exists(path: str) -> bool:
    system, inner = _system(path)
    return system.get_file_info(inner).type == pafs.FileType.File


def open_input(path: str) -> io.BufferedReader:
    system, inner = _system(path)
    return io.BufferedReader(system.open_input_file(inner), 1 << 17)


def open_output(path: str):
    """A stream; missing folders are made."""
    system, inner = _system(path)
    system.create_dir(inner.rpartition("/")[0], recursive=True)
    return system.open_output_stream(inner, compression=None)


def move(source: str, target: str) -> None:
    system, inner = _system(source)
    system.move(inner, _system(target)[1])


def remove(path: str) -> None:
    system, inner = _system(path)
    if system.get_file_info(inner).type == pafs.FileType.File:
        system.delete_file(inner)
