"""Files by path or address, on any file system that driver and executors share."""

from __future__ import annotations

import os

from pyarrow import fs


def located(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path (an address, file:/..., or a local path on a shared mount) and the path there."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), os.path.abspath(path)


def opened(path: str):
    """A file for reading at any place."""
    system, at = located(path)
    return system.open_input_file(at)


def listed(path: str, suffixes: tuple[str, ...]) -> list[tuple[str, int]]:
    """Paths and sizes of a file, or of those of a folder that end so, in order."""
    system, at = located(path)
    info = system.get_file_info(at)
    if info.type == fs.FileType.File:
        return [(path, info.size)]
    found = system.get_file_info(fs.FileSelector(at, recursive=True))
    base = path.rstrip("/")
    return sorted((base + f.path[len(at.rstrip("/")) :], f.size) for f in found if f.type == fs.FileType.File and f.path.endswith(suffixes) and "/_" not in f.path[len(at) :])


def stem(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1].split(".", 1)[0]
