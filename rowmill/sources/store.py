"""Files of a folder and byte ranges of a file, in any store that pyarrow opens.

Paths are taken as they are: names that begin with a dot or an underscore and names with
pattern characters are files like any other.
"""

from __future__ import annotations

import os
import re

from pyarrow import fs


def opened(path: str) -> tuple[fs.FileSystem, str, str]:
    """The file system of a path, the path in it, and what stands before such paths."""
    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme or scheme == "file":
        plain = rest if scheme == "file" and colon else path
        plain = "/" + plain.lstrip("/") if plain.startswith("//") else os.path.abspath(plain)
        return fs.LocalFileSystem(), plain, "file://"
    authority, _, tail = rest.removeprefix("//").partition("/")
    system, base = fs.FileSystem.from_uri(f"{scheme}://{authority}/")
    base = base.rstrip("/")
    return system, f"{base}/{tail}", f"{scheme}://{authority}"[: -len(base) or None]


def files_below(folder: str) -> list[tuple]:
    """(path, size, time) of all files whose names have a dot, at any depth, by path. The
    checksum files that Hadoop keeps beside local files are no input."""
    system, top, prefix = opened(folder)
    self = system.get_file_info(top)
    found = [self] if self.is_file else system.get_file_info(fs.FileSelector(top, recursive=True))
    out = []
    for f in found:
        if f.is_file and "." in f.base_name and not re.fullmatch(r"\..*\.crc", f.base_name):
            out.append((prefix + f.path, f.size, f.mtime))
    return sorted(out)


class Bytes:
    """Random access to one file."""

    def __init__(self, path: str):
        system, plain, _ = opened(path)
        self.file = system.open_input_file(plain)
        self.size = self.file.size()

    def read(self, start: int, end: int) -> bytes:
        end = min(end, self.size)
        return self.file.read_at(end - start, start) if end > start else b""

    def settle(self, at: int, hold: bytes) -> int:
        """The first place from ``at`` on that does not come after one of the bytes ``hold``."""
        if not hold or at <= 0:
            return max(at, 0)
        while at < self.size:
            run = self.read(at - 1, at - 1 + (1 << 16))
            same = len(run) - len(run.lstrip(hold))
            at = min(at + same, self.size)
            if same < len(run):
                break
        return at

    def __enter__(self) -> Bytes:
        return self

    def __exit__(self, *_) -> None:
        self.file.close()
