"""Access to files inside tasks, through Arrow's file systems."""

from __future__ import annotations

import re

from pyarrow import fs

# Hadoop's names for stores that Arrow knows under another one.
SCHEMES = {"s3a": "s3", "s3n": "s3"}


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The store that ``path`` names and the path within it.

    A path without scheme, or with ``file:``, is local to every node or mounted
    on all of them. Credentials of other stores come from the environment.
    """
    scheme = re.match(r"([A-Za-z][A-Za-z0-9+.-]*):/+", path)
    if scheme is None:
        return fs.LocalFileSystem(), path
    if scheme[1] == "file":
        return fs.LocalFileSystem(), "/" + path[scheme.end() :]
    return fs.FileSystem.from_uri(f"{SCHEMES.get(scheme[1], scheme[1])}://{path[scheme.end():]}")


def named(path: str, inside: str) -> str:
    """``inside`` (a path within the store of ``path``) as Spark names it."""
    scheme = re.match(r"([A-Za-z][A-Za-z0-9+.-]*):/+", path)
    if scheme is None or scheme[1] == "file":
        return f"file:{inside}"
    return f"{scheme[1]}://{inside}"
