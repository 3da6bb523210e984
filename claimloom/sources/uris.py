"""Opening files on executors, where only a range of a file is wanted."""

from __future__ import annotations

import re

import pyarrow.fs


def opened(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a URI or path as Spark writes it, and the path in it. ``s3a`` is read as ``s3``."""
    if re.match("file:|/", uri):
        return pyarrow.fs.LocalFileSystem(), re.sub("^file:/*", "/", uri)
    return pyarrow.fs.FileSystem.from_uri(re.sub("^s3a:", "s3:", uri))
