"""Image folders: the same pixels in two formats, other files, one selected file."""

from __future__ import annotations

import hashlib
import json
import struct
import zlib

import numpy as np
import pytest

from sievewright.functions import images
from sievewright.operators import ingest
from sievewright.operators.ingest import keep_first
from sievewright.sources import readers


def png(width: int, height: int, rgb: tuple[int, int, int]) -> bytes:
    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    rows = (b"\0" + bytes(rgb) * width) * height
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")


def bmp(width: int, height: int, rgb: tuple[int, int, int]) -> bytes:
    row = bytes(rgb[::-1]) * width
    row += b"\0" * (-len(row) % 4)
    body = row * height
    return b"BM" + struct.pack("<IHHI", 54 + len(body), 0, 0, 54) + struct.pack("<IiiHHIIiiII", 40, width, height, 1, 24, 0, len(body), 2835, 2835, 0, 0) + body


def test_folder_scan(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.PNG").write_bytes(png(120, 80, (40, 60, 80)))
    (tmp_path / "sub/b.bmp").write_bytes(bmp(120, 80, (40, 60, 80)))
    (tmp_path / "sub/c.png").write_bytes(png(64, 64, (1, 2, 3)))
    (tmp_path / "notes.txt").write_text("no image")
    rows = readers.images(spark, f"file://{tmp_path}")
    got = {r["image_path"]: r for r in rows.collect()}
    assert list(sorted(got)) == ["a.PNG", "sub/b.bmp", "sub/c.png"]
    want = hashlib.sha256(b"RGB:120:80:" + bytes((40, 60, 80)) * 120 * 80).hexdigest()
    assert got["a.PNG"]["pixel_sha256"] == got["sub/b.bmp"]["pixel_sha256"] == want
    assert got["a.PNG"]["source_id"] == "src_" + hashlib.sha256(b'"a.PNG"').hexdigest()[:16]
    assert got["sub/c.png"]["file_sha256"] == hashlib.sha256(png(64, 64, (1, 2, 3))).hexdigest()
    marked = {r["image_path"]: r["kept"] for r in keep_first(rows, "pixel_sha256", "ord", "source_id").collect()}
    assert marked == {"a.PNG": True, "sub/b.bmp": False, "sub/c.png": True}


def test_one_selected_file(spark, tmp_path):
    (tmp_path / "a.png").write_bytes(png(64, 64, (1, 2, 3)))
    (tmp_path / "broken.png").write_bytes(b"broken")
    assert [r["image_path"] for r in readers.images(spark, f"file://{tmp_path}", "a.png").collect()] == ["a.png"]


def pixels(width: int, height: int, kind: int, data: bytes, more: bytes = b"") -> bytes:
    """A PNG of gray (0), RGB (2) or RGBA (6) bytes, with further chunks before its pixels."""
    per = {0: 1, 2: 3, 6: 4}[kind]

    def chunk(name: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))

    rows = b"".join(b"\0" + data[y * width * per : (y + 1) * width * per] for y in range(height))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, kind, 0, 0, 0)) + (chunk(more[:4], more[4:]) if more else b"") + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")


def exif(orientation: int, order: str = ">") -> bytes:
    mark = b"MM\0*" if order == ">" else b"II*\0"
    return mark + struct.pack(f"{order}IHHHIHHI", 8, 1, 0x0112, 3, 1, orientation, 0, 0)


def test_orientation_and_channels(spark, tmp_path):
    rng = np.random.default_rng(1)
    frame = rng.integers(0, 256, (5, 7, 3), dtype=np.uint8)
    turned = {1: frame, 2: frame[:, ::-1], 3: np.rot90(frame, 2), 4: frame[::-1], 5: frame.transpose(1, 0, 2), 6: np.rot90(frame, -1), 7: np.rot90(frame, 2).transpose(1, 0, 2), 8: np.rot90(frame, 1)}
    for k in turned:
        (tmp_path / f"o{k}.png").write_bytes(pixels(7, 5, 2, frame.tobytes(), b"eXIf" + exif(k, ">" if k % 2 else "<")))
    gray, alpha = rng.integers(0, 256, (4, 3), dtype=np.uint8), rng.integers(0, 256, (4, 3, 4), dtype=np.uint8)
    (tmp_path / "gray.png").write_bytes(pixels(3, 4, 0, gray.tobytes()))
    (tmp_path / "alpha.png").write_bytes(pixels(3, 4, 6, alpha.tobytes()))
    want = {f"o{k}.png": v for k, v in turned.items()} | {"gray.png": np.repeat(gray[..., None], 3, axis=2), "alpha.png": alpha[..., :3]}
    got = {r["image_path"]: r for r in readers.images(spark, f"file://{tmp_path}").collect()}
    for name, v in want.items():
        h, w = v.shape[:2]
        assert (got[name]["width"], got[name]["height"]) == (w, h), name
        assert got[name]["pixel_sha256"] == hashlib.sha256(f"RGB:{w}:{h}:".encode() + v.tobytes()).hexdigest(), name
    assert [r["image_path"] for r in sorted(got.values(), key=lambda r: r["ord"])] == sorted(want) and {r["ord"] for r in got.values()} == set(range(len(want)))
    (tmp_path / "moving.png").write_bytes(pixels(3, 4, 0, gray.tobytes(), b"acTL" + struct.pack(">II", 2, 0)))
    with pytest.raises(Exception, match="several frames"):
        readers.images(spark, f"file://{tmp_path}").collect()


def test_what_files_tell():
    jpeg = lambda body: b"\xff\xd8\xff\xe1" + struct.pack(">H", len(body) + 2) + body + b"\xff\xda"
    assert images.told(jpeg(b"Exif\0\0" + exif(6))) == (6, 1) and images.told(jpeg(b"http")) == (1, 1) and images.told(b"") == (1, 1)
    second = exif(3)[:-4] + struct.pack(">I", 26) + struct.pack(">HI", 0, 0)
    assert images.told(second) == (3, 2) and images.told(exif(9)) == (1, 1)
    webp = b"RIFF\0\0\0\0WEBP" + b"".join(n + struct.pack("<I", len(b)) + b + b"\0" * (len(b) % 2) for n, b in ((b"ANMF", b"x"), (b"ANMF", b"yy"), (b"EXIF", exif(8, "<"))))
    assert images.told(webp) == (8, 2)


def test_masks(spark, tmp_path):
    mask = np.zeros((4, 6), dtype=np.uint8)
    mask[1, 2:5] = mask[2, 0:2] = 255
    files = {"good.png": pixels(6, 4, 0, mask.tobytes()), "values.png": pixels(6, 4, 0, (mask // 2).tobytes()), "mode.png": pixels(6, 4, 2, bytes(72)), "size.png": pixels(4, 6, 0, mask.tobytes()), "hash.png": pixels(6, 4, 0, mask.tobytes())}
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    sha = {name: hashlib.sha256(data).hexdigest() for name, data in files.items()} | {"hash.png": "0", "gone.png": "0"}
    want = spark.createDataFrame([(name, s, 6, 4) for name, s in sha.items()], "path string, sha256 string, width int, height int")
    got = {r["path"]: r for r in readers.masks(spark, f"file://{tmp_path}", want).collect()}
    assert {p: r["error"] for p, r in got.items()} == {"good.png": None, "values.png": "values", "mode.png": "mode", "size.png": "size", "hash.png": "hash", "gone.png": "missing"}
    assert [tuple(x) for x in got["good.png"]["runs"]] == [(1, 2, 5), (2, 0, 2)]


def test_manifest_is_guarded(spark, tmp_path, capsys):
    (tmp_path / "data").mkdir()
    (tmp_path / "data/a.png").write_bytes(png(64, 64, (1, 2, 3)))
    (tmp_path / "data/b.png").write_bytes(png(64, 64, (9, 2, 3)))
    (tmp_path / "data/small.png").write_bytes(png(31, 64, (9, 2, 3)))
    found = readers.images(spark, f"file://{tmp_path}/data")

    def run(*rows):
        lines = [json.dumps({"schema_version": "2.0", **r}) for r in rows]
        (tmp_path / "m.jsonl").write_text("\n".join([*lines, ""]))
        return ingest.ingest(ingest.manifest_sources(readers.manifest(spark, f"file://{tmp_path}/m.jsonl"), found))

    kept, dropped = run({"source_id": "x", "image_path": "a.png"}, {"source_id": "y", "image_path": "b.png", "split": "val"}, {"source_id": "z", "image_path": "a.png"})
    assert [r["source_id"] for r in kept.collect()] == ["x"] and [tuple(r) for r in dropped.collect()] == [("z", "x")]
    for bad, why in (
        ([{"source_id": "../x", "image_path": "a.png"}], "unsafe"),
        ([{"source_id": "x", "image_path": "../a.png"}], "unsafe"),
        ([{"source_id": "x", "image_path": "none.png"}], "missing"),
        ([{"source_id": "x", "image_path": "small.png"}], "least side"),
        ([{"source_id": "x", "image_path": "a.png"}, {"source_id": "x", "image_path": "b.png"}], "repeat"),
        ([{"source_id": "x", "image_path": "a.png", "split": "other"}], "unknown splits"),
        ([{"source_id": "x", "image_path": "a.png"}, {"source_id": "y", "image_path": "a.png", "split": "val"}], "several splits"),
        ([{"source_id": "x", "image_path": "a.png", "split": "val"}], "eligible"),
    ):
        with pytest.raises(ingest.ConstraintError, match=why):
            run(*bad)
