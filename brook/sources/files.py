"""Plain file access by path or URI, for Python sources and sinks."""

from __future__ import annotations


def filesystem(path: str):
    """(pyarrow file system, path on it); imported late, since it runs in tasks."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
