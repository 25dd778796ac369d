"""Files that tasks write to the shared folder, by any address that Arrow's file systems open."""

from __future__ import annotations

import uuid

from pyarrow import fs


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder's address (a plain path is local or mounted) and the path inside it."""
    if "://" not in folder and not folder.startswith("file:"):
        return fs.LocalFileSystem(), folder
    if folder.startswith("file:"):
        return fs.LocalFileSystem(), "/" + folder[5:].lstrip("/")
    return fs.FileSystem.from_uri(folder)


def attempt_name(name: str) -> str:
    """A name that no other attempt of the task uses; the manifest that the task returns says which one counts."""
    stem, dot, end = name.partition(".")
    return f"{stem}-{uuid.uuid4().hex}{dot}{end}"
