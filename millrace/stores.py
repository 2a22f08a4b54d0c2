"""Files that a task opens itself: any address pyarrow knows, or a plain path."""

from __future__ import annotations

from pyarrow import fs


def store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path, and the path inside it."""
    files, inner = fs.FileSystem.from_uri(path) if ":" in path.split("/")[0] else (fs.LocalFileSystem(), path)
    return files, inner.rstrip("/")
