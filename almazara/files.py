"""Files by path or URI, on local disks and on the file systems Arrow knows."""

from __future__ import annotations

import io
import json
from collections.abc import Iterator
from typing import BinaryIO

from pyarrow import fs


def located(path: str) -> tuple[fs.FileSystem, str]:
    """(file system, path in it); a path without a scheme is local."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def opened(path: str) -> BinaryIO:
    """A file for reading from any place."""
    system, at = located(path)
    return io.BufferedReader(system.open_input_file(at))


def size_of(path: str) -> int | None:
    """Bytes of a file; None where there is none."""
    system, at = located(path)
    info = system.get_file_info(at)
    return info.size if info.type == fs.FileType.File else None


def files_under(path: str) -> Iterator[tuple[str, int]]:
    """(path relative to the folder, bytes) of every file below a folder, in order; nothing where there is none."""
    system, at = located(path.rstrip("/"))
    found = system.get_file_info(fs.FileSelector(at, recursive=True, allow_not_found=True))
    for info in sorted(found, key=lambda i: i.path):
        if info.type == fs.FileType.File:
            yield info.path[len(at) + 1 :], info.size


def put_text(path: str, text: str) -> None:
    """A text file put in place at once: written beside it, then moved."""
    system, at = located(path)
    if "/" in at:
        system.create_dir(at.rsplit("/", 1)[0], recursive=True)
    with system.open_output_stream(f"{at}.part") as out:
        out.write(text.encode("utf-8"))
    system.move(f"{at}.part", at)


def copied(source: str, target: str) -> None:
    """One file copied, block by block."""
    system, at = located(target)
    if "/" in at:
        system.create_dir(at.rsplit("/", 1)[0], recursive=True)
    with opened(source) as data, system.open_output_stream(at) as out:
        while block := data.read(1 << 22):
            out.write(block)


def removed(path: str) -> None:
    """A folder and all below it, if it is there."""
    system, at = located(path.rstrip("/"))
    if system.get_file_info(at).type == fs.FileType.Directory:
        system.delete_dir(at)


def read_json(path: str):
    """Value of a JSON file."""
    with opened(path) as f:
        return json.load(f)
