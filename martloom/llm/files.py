"""Files in the shared folder, read and written by tasks through one interface for local and remote stores."""

from __future__ import annotations

from pyarrow import fs as pafs


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path[len("file:") :]
    return pafs.FileSystem.from_uri(path)


def join(folder: str, *names: str) -> str:
    return "/".join([folder.rstrip("/"), *names])
