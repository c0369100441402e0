"""Files that tasks open by themselves, for reading a few bytes of each (header lines, archive directories and members)."""

from __future__ import annotations

import bz2
import gzip
import struct
import zipfile
from typing import BinaryIO, Iterator

import pyarrow as pa
import pyarrow.fs

#: Suffixes that Spark decompresses and Python reads as a stream.
PACKED = {".gz": gzip.open, ".bz2": bz2.open}
#: Suffixes that Spark decompresses and nothing here reads.
SPARK_ONLY = (".deflate", ".lz4", ".snappy", ".zst")
LOCAL_HEADER = 30  # bytes of a member's local header before its name and extra field


def opened(path: str) -> BinaryIO:
    """The file under a path as Spark lists it, for reading from any place."""
    if path.startswith("file:"):
        return open("/" + path[len("file:"):].lstrip("/"), "rb")
    if path.startswith("/"):
        return open(path, "rb")
    system, inner = pa.fs.FileSystem.from_uri(path)
    return system.open_input_file(inner)


def first_line(path: str) -> bytes | None:
    """First line that is not blank, without its end (empty: the file has none); None where only Spark can read it."""
    if path.endswith(SPARK_ONLY):
        return None
    unpack = next((f for end, f in PACKED.items() if path.endswith(end)), None)
    try:
        with opened(path) as raw:
            lines = unpack(raw) if unpack else raw
            rest = b""
            while block := lines.read(1 << 14):
                *whole, rest = (rest + block).replace(b"\r", b"\n").split(b"\n")
                for line in whole:
                    if line.strip():
                        return line
            return rest if rest.strip() else b""
    except (OSError, pa.ArrowException):
        return None


def csv_members(archive: BinaryIO) -> Iterator[tuple[str, int, int, int, int, int]]:
    """name, offset, packed and unpacked size, method and checksum of the CSV members, from the archive's directory."""
    with zipfile.ZipFile(archive) as z:
        for m in z.infolist():
            if not m.is_dir() and m.filename.lower().endswith(".csv"):
                yield m.filename, m.header_offset, m.compress_size, m.file_size, m.compress_type, m.CRC


def member(archive: BinaryIO, name: str, offset: int, packed: int, size: int, method: int, checksum: int) -> BinaryIO:
    """One member's content as a stream, from its own bytes alone; a wrong checksum raises at its end."""
    archive.seek(offset)
    name_length, extra_length = struct.unpack("<HH", archive.read(LOCAL_HEADER)[-4:])
    archive.seek(offset + LOCAL_HEADER + name_length + extra_length)
    info = zipfile.ZipInfo(name)
    info.compress_size, info.file_size, info.compress_type, info.CRC = packed, size, method, checksum
    return zipfile.ZipExtFile(archive, "r", info)
