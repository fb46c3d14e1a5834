"""Files of a shared folder, opened from the driver or a task where Spark has no reader or writer of its own."""

from __future__ import annotations

import re

from pyarrow import fs

_URI = re.compile(r"(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(.*)", re.S)


def shared_fs(uri: str) -> tuple[fs.FileSystem, str]:
    """(file system, path) of a URI.

    ``s3a`` and ``s3n`` are the names that Hadoop has for ``s3``; ``dbfs:/`` is mounted under ``/dbfs``.  A scheme that
    is not known is an error and never a folder of the machine.
    """
    scheme, rest = _URI.match(uri).groups()
    if scheme is None:
        return fs.LocalFileSystem(), uri
    if scheme == "dbfs":
        return fs.LocalFileSystem(), "/dbfs/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(f"s3:{rest}" if scheme in ("s3a", "s3n") else uri)


def files_in(uri: str) -> list[str]:
    """Paths of all files under a folder (none if it is missing), in the file system's own form."""
    system, path = shared_fs(uri)
    found = system.get_file_info(fs.FileSelector(path, recursive=True, allow_not_found=True))
    return [f.path for f in found if f.type == fs.FileType.File]


def put(uri: str, data: bytes) -> None:
    """A small file that is there whole or not at all: written aside, then moved."""
    system, path = shared_fs(uri)
    folder, name = path.rsplit("/", 1)
    system.create_dir(folder)
    aside = f"{folder}/.{name}.tmp"
    with system.open_output_stream(aside) as out:
        out.write(data)
    system.move(aside, path)


def get(uri: str) -> bytes | None:
    """The bytes of a small file; None if there is none."""
    system, path = shared_fs(uri)
    if system.get_file_info(path).type != fs.FileType.File:
        return None
    with system.open_input_stream(path) as source:
        return source.read()
