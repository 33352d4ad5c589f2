"""Files that executors write below a shared folder, whatever store it is in."""

from __future__ import annotations

import os
import re


def _store(uri: str):
    """File system and path of a full URI (``common.qualified``). ``file:`` is a shared mount, its path taken as it
    stands, whatever signs it holds; other schemes go through Arrow's file systems (hdfs, s3, gs).
    A path without scheme is an error: which file system it belongs to is the driver's to say."""
    from pyarrow import fs

    scheme, colon, path = uri.partition(":")
    if not colon or not re.fullmatch("[A-Za-z][A-Za-z0-9+.-]*", scheme):
        raise ValueError(f"no file system named in {uri!r}")
    if scheme == "file":
        return fs.LocalFileSystem(), re.sub("^/+", "/", path)
    return fs.FileSystem.from_uri(uri)


def open_output(uri: str):
    store, path = _store(uri)
    store.create_dir(os.path.dirname(path), recursive=True)
    return store.open_output_stream(path, compression=None, buffer_size=1 << 20)  # the bytes as given, whatever the name ends in


def open_input(uri: str):
    store, path = _store(uri)
    return store.open_input_stream(path, compression=None, buffer_size=1 << 20)
