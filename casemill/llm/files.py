"""Files that tasks write to and read from shared storage, by any address that pyarrow knows."""

from __future__ import annotations

import uuid

from pyarrow import fs


def _place(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("/") else path.replace("file:", "file://", 1))


def open_at(path: str, mode: str):
    """A binary file for "r" (random access) or "w" (its folder is made)."""
    where, name = _place(path)
    if mode == "r":
        return where.open_input_file(name)
    where.create_dir(name.rpartition("/")[0], recursive=True)
    return where.open_output_stream(name, compression=None)


def fresh(folder: str, suffix: str) -> str:
    """A name that no other attempt of a task uses: only what a finished task reports is ever read."""
    return f"{folder}/{uuid.uuid4().hex}{suffix}"


def remove(path: str) -> None:
    """Deletes a folder, if it is there."""
    where, name = _place(path)
    if where.get_file_info(name).type == fs.FileType.Directory:
        where.delete_dir(name)
