"""What image files tell besides their pixels: orientation and number of frames, and pixels as RGB in that orientation."""

from __future__ import annotations

import hashlib
import struct

import numpy as np

#: The orientation tag of EXIF, and the signatures of containers.
ORIENTATION = 0x0112
PNG, JPEG, WEBP = b"\x89PNG\r\n\x1a\n", b"\xff\xd8", b"WEBP"


def _tiff(data: bytes) -> tuple[int | None, int]:
    """(orientation, number of directories) of a TIFF structure."""
    order = {b"II": "<", b"MM": ">"}.get(data[:2])
    if order is None or len(data) < 8:
        return None, 0
    at, found, frames, seen = struct.unpack_from(f"{order}I", data, 4)[0], None, 0, set()
    while at and at not in seen and at + 2 <= len(data):
        seen.add(at)
        n = struct.unpack_from(f"{order}H", data, at)[0]
        for i in range(n):
            entry = at + 2 + 12 * i
            if entry + 12 > len(data):
                return found, frames
            tag, kind = struct.unpack_from(f"{order}HH", data, entry)
            if tag == ORIENTATION and frames == 0:
                found = struct.unpack_from(f"{order}{'H' if kind == 3 else 'I'}", data, entry + 8)[0]
        frames += 1
        after = at + 2 + 12 * n
        at = struct.unpack_from(f"{order}I", data, after)[0] if after + 4 <= len(data) else 0
    return found, frames


def _chunks(data: bytes, at: int, order: str, length_first: bool, extra: int, even: bool):
    while at + 8 <= len(data):
        size, name = (struct.unpack_from(f"{order}I4s", data, at) if length_first else struct.unpack_from(f"{order}4sI", data, at)[::-1])
        yield name, data[at + 8 : at + 8 + size]
        at += 8 + size + extra + (size & 1 if even else 0)


def told(data: bytes) -> tuple[int, int]:
    """(orientation from 1 to 8, number of frames) of an image file; 1 and 1 where nothing is told."""
    orientation, frames = None, 1
    if data[:8] == PNG:
        for name, body in _chunks(data, 8, ">", True, 4, False):
            if name == b"eXIf":
                orientation = _tiff(body)[0]
            elif name == b"acTL" and len(body) >= 4:
                frames = struct.unpack_from(">I", body)[0]
            elif name == b"IEND":
                break
    elif data[:2] == JPEG:
        at = 2
        while at + 4 <= len(data) and data[at] == 0xFF and data[at + 1] not in (0xD9, 0xDA):
            size = struct.unpack_from(">H", data, at + 2)[0]
            body = data[at + 4 : at + 2 + size]
            if data[at + 1] == 0xE1 and body[:6] == b"Exif\0\0" and orientation is None:
                orientation = _tiff(body[6:])[0]
            at += 2 + size
    elif data[:4] == b"RIFF" and data[8:12] == WEBP:
        moving = 0
        for name, body in _chunks(data, 12, "<", False, 0, True):
            if name == b"EXIF":
                orientation = _tiff(body.removeprefix(b"Exif\0\0"))[0]
            moving += name == b"ANMF"
        frames = max(1, moving)
    elif data[:2] in (b"II", b"MM"):
        orientation, frames = _tiff(data)
    return orientation if orientation in range(1, 9) else 1, max(1, frames)


def upright(frame: np.ndarray, orientation: int) -> np.ndarray:
    """A frame (height, width, channels) as its orientation says it is to be seen."""
    if orientation in (5, 6, 7, 8):
        frame = frame.transpose(1, 0, 2)
    # Rows and columns that run the other way, by orientation.
    rows, columns = orientation in (3, 4, 7, 8), orientation in (2, 3, 6, 7)
    return frame[:: -1 if rows else 1, :: -1 if columns else 1]


def rgb(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    """The decoder's gray, BGR or BGRA bytes as RGB; transparency is dropped."""
    frame = np.frombuffer(data, dtype=np.uint8).reshape(height, width, channels)
    return np.repeat(frame, 3, axis=2) if channels == 1 else frame[:, :, 2::-1]


def pixel_hashes(data: bytes, height: int, width: int, channels: int) -> list[str]:
    """The pixel hash for each orientation from 1 to 8, so that it may be known later than the pixels."""
    frame, out = rgb(data, height, width, channels), []
    for orientation in range(1, 9):
        seen = upright(frame, orientation)
        h = hashlib.sha256(f"RGB:{seen.shape[1]}:{seen.shape[0]}:".encode())
        h.update(np.ascontiguousarray(seen))
        out.append(h.hexdigest())
    return out
