"""Whole files in shared storage, written by tasks."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyarrow import fs


@contextlib.contextmanager
def written(uri: str) -> Iterator:
    """A stream whose content becomes the file only when all of it is there.

    A task that runs twice writes the same file twice and leaves one of them.
    """
    system, path = fs.FileSystem.from_uri(uri)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    part = f"{path}.{uuid.uuid4().hex}.part"
    with system.open_output_stream(part, compression=None) as stream:
        yield stream
    system.move(part, path)


def opened(uri: str):
    """A file to read from any place."""
    system, path = fs.FileSystem.from_uri(uri)
    return system.open_input_file(path)
