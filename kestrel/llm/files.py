"""Binary files in the shared folder, opened from tasks through pyarrow's
filesystems (local or mounted paths, hdfs, s3, gs). A task writes under a name of
its attempt and moves the finished file into place, so a retried or doubled task
leaves one whole file."""

from __future__ import annotations

import contextlib
import uuid

from pyarrow import fs


def locate(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path)


@contextlib.contextmanager
def writing(path: str):
    """An output stream whose file appears at ``path`` once the block ends well."""
    system, place = locate(path)
    folder, _, name = place.rpartition("/")
    system.create_dir(folder, recursive=True)
    part = f"{folder}/.{name}.{uuid.uuid4().hex[:12]}"
    try:
        with system.open_output_stream(part, compression=None) as out:
            yield out
    except BaseException:
        with contextlib.suppress(OSError):
            system.delete_file(part)
        raise
    system.move(part, place)


def reading(path: str):
    system, place = locate(path)
    return system.open_input_file(place)


def streaming(path: str):
    """Sequential stream of the raw bytes (no decompression by file name)."""
    system, place = locate(path)
    return system.open_input_stream(place, compression=None)
