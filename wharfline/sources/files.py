"""Byte-level file work done inside tasks.

Plain paths and ``file:`` URIs must name a folder all executors share. Other
URIs go through ``pyarrow.fs``.
"""

from __future__ import annotations

import gzip
import hashlib
import os
from urllib.parse import unquote, urlparse

from pyarrow import fs as pafs

# Fixed value: bytes moved per read.
CHUNK_BYTES = 16 * 1024 * 1024


def posix_path(uri: str) -> str | None:
    """Path of a plain or ``file:`` name, None for any other scheme."""
    if uri.startswith("file:"):
        return unquote(urlparse(uri).path)
    return None if "://" in uri else uri


def _filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    path = posix_path(uri)
    if path is not None:
        return pafs.LocalFileSystem(), os.path.abspath(path)
    if uri.startswith("s3a://"):
        uri = "s3://" + uri.removeprefix("s3a://")
    return pafs.FileSystem.from_uri(uri)


def remote_filesystem(root: str) -> tuple[pafs.FileSystem, str, str]:
    """Filesystem, path inside it, and what stands before paths in URIs."""
    filesystem, path = _filesystem(root)
    return filesystem, path, root[: len(root) - len(path)]


def open_file(uri: str):
    """A file open for reading at any place."""
    filesystem, path = _filesystem(uri)
    return filesystem.open_input_file(path)


def staging_name(path: str, token: str) -> str:
    """A hidden name beside ``path``, so that inventories pass over it. Its
    length does not grow with the name, which may be as long as names can be."""
    folder, name = os.path.split(path)
    digest = hashlib.sha256(name.encode()).hexdigest()[:16]
    return os.path.join(folder, f".{digest}.{token}.part")


def stream_to(src: str, dst: str, token: str, unpack: bool, size: int | None = None) -> int:
    """Copy or gunzip ``src`` to ``dst`` chunk by chunk; returns the bytes written.

    The target appears only when it is complete: a failure leaves nothing
    under the target's name, and a second attempt replaces it by the same
    bytes.
    """
    source_fs, source = _filesystem(src)
    target_fs, target = _filesystem(dst)
    staged = staging_name(target, token)
    target_fs.create_dir(os.path.dirname(target), recursive=True)
    done = 0
    try:
        with source_fs.open_input_stream(source, compression=None) as raw:
            body = gzip.GzipFile(fileobj=raw) if unpack else raw
            with target_fs.open_output_stream(staged, compression=None) as out:
                while chunk := body.read(CHUNK_BYTES):
                    out.write(chunk)
                    done += len(chunk)
        if size is not None and done != size:
            raise OSError(f"size mismatch: source {size}, copied {done}")
        target_fs.move(staged, target)
        there = target_fs.get_file_info(target).size
        if there != done:
            raise OSError(f"size mismatch: copied {done}, destination {there}")
    except BaseException:
        if target_fs.get_file_info(staged).type != pafs.FileType.NotFound:
            target_fs.delete_file(staged)
        raise
    return done


def copy_range(src: str, staged: str, offset: int, length: int) -> int:
    """Copy one byte range into the same place of a staged file.

    Repeating it writes the same bytes to the same place, so retried and
    speculative tasks do no harm.
    """
    os.makedirs(os.path.dirname(staged), exist_ok=True)
    done = 0
    with open(src, "rb") as body:
        body.seek(offset)
        fd = os.open(staged, os.O_WRONLY | os.O_CREAT, 0o644)
        try:
            while done < length:
                chunk = body.read(min(CHUNK_BYTES, length - done))
                if not chunk:
                    break
                view = memoryview(chunk)
                while view:
                    n = os.pwrite(fd, view, offset + done)
                    view = view[n:]
                    done += n
        finally:
            os.close(fd)
    return done


def write_at(staged: str, offset: int, data: bytes) -> int:
    """Put bytes at a place of a staged file, which is made where it is missing; returns how many."""
    fd = os.open(staged, os.O_WRONLY | os.O_CREAT, 0o644)
    try:
        view = memoryview(data)
        while view:
            n = os.pwrite(fd, view, offset)
            view, offset = view[n:], offset + n
    finally:
        os.close(fd)
    return len(data)


MOVED = ".moved"  # behind the name of a staged file: it was complete and got, or is about to get, its target's name


def commit_staged(staged: str, dst: str, size: int) -> int:
    """Move a complete staged file to its target; returns the target's size.

    A second call finds the mark of the first and the file moved already. Without
    the mark a missing staged file is an error, whatever lies at the target.
    """
    if os.path.exists(staged):
        found = os.path.getsize(staged)
        if found != size:
            raise OSError(f"size mismatch: source {size}, copied {found}")
        with open(staged + MOVED, "wb"):
            pass
        os.replace(staged, dst)
    elif not os.path.exists(staged + MOVED):
        raise FileNotFoundError(f"staged file for {dst} is gone")
    found = os.path.getsize(dst)
    if found != size:
        raise OSError(f"size mismatch: source {size}, destination {found}")
    return found


def sweep_staged(folder: str, run: str) -> int:
    """Remove what a run has left of staged files and marks in a folder; returns how many."""
    n = 0
    try:
        with os.scandir(folder) as entries:
            for e in entries:
                if e.name.startswith(".") and f".{run}" in e.name and e.name.endswith((".part", MOVED)):
                    os.remove(e.path)
                    n += 1
    except FileNotFoundError:
        pass
    return n


def discard_staged(staged: str) -> None:
    """Remove a staged file and its mark, if they are there."""
    for path in (staged, staged + MOVED):
        if os.path.exists(path):
            os.remove(path)
