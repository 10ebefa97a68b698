"""Audits of landed images."""

import struct
import zlib

import numpy as np

from gablestone.sources import images, tiff
from tests.test_raster_and_header_sources import hand_made


def png(cells):
    """A file of 8-bit cells (rows, columns, 1 or 3 channels)."""
    h, w, n = cells.shape
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    raw = b"".join(b"\0" + row.tobytes() for row in cells)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2 if n == 3 else 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def jpeg(spark, path, w, h):
    jvm = spark.sparkContext._jvm
    image = jvm.java.awt.image.BufferedImage(w, h, jvm.java.awt.image.BufferedImage.TYPE_INT_RGB)
    jvm.javax.imageio.ImageIO.write(image, "jpg", jvm.java.io.File(str(path)))


def test_images_are_audited(spark, tmp_path):
    cells = np.zeros((3, 5, 3), np.uint8)
    cells[..., 0], cells[1, 2, 1], cells[..., 2] = 200, 7, 90
    (tmp_path / "a b+c.png").write_bytes(png(cells))
    (tmp_path / "grey.png").write_bytes(png(np.arange(12, dtype=np.uint8).reshape(3, 4, 1)))
    jpeg(spark, tmp_path / "good.jpg", 64, 48)
    (tmp_path / "padded.jpg").write_bytes((tmp_path / "good.jpg").read_bytes() + b"\0" * 9)
    (tmp_path / "cut.jpg").write_bytes((tmp_path / "good.jpg").read_bytes()[:-40])
    (tmp_path / "text.jpg").write_bytes(b"<html>not found</html>")
    got = {r.file: r for r in images.audit(spark, str(tmp_path)).collect()}
    a = got["a b+c.png"]
    assert (a.format, a.width, a.height, a.channels, a.status, [tuple(x) for x in a.extrema]) == ("PNG", 5, 3, 3, "available", [(200, 200), (0, 7), (90, 90)])
    assert ([tuple(x) for x in got["grey.png"].extrema], got["grey.png"].channels) == ([(0, 11)], 1)
    assert (got["good.jpg"].status, got["good.jpg"].width, got["padded.jpg"].status) == ("available", 64, "available")
    assert (got["cut.jpg"].status, got["cut.jpg"].warning, got["cut.jpg"].extrema, got["cut.jpg"].error) == ("available_with_warning", images.TRUNCATED, None, None)
    assert all((got[f].status, got[f].error, got[f].width) == ("unavailable", images.NO_IMAGE, None) for f in ("text.jpg",))
    rows = spark.createDataFrame([(1, "u", "good.jpg"), (2, " ", "good.jpg"), (3, "u", None), (4, "u", "text.jpg")], "building_id long, document_url string, file string")
    assert {r.building_id: (r.status, r.error) for r in images.advertised(rows, images.audit(spark, str(tmp_path))).collect()} == {1: ("available", None), 2: ("unavailable", "no advertised image"), 3: ("unavailable", "not landed"), 4: ("unavailable", images.NO_IMAGE)}


def test_channels_of_rasters(spark, tmp_path):
    cells = np.random.default_rng(1).integers(0, 255, (6, 5, 3)).astype("u1")
    (tmp_path / "o.tif").write_bytes(hand_made("<", "u1", cells))
    got = {r.band: (r.low, r.high) for r in tiff.channels(tiff.cells(tiff.tiles(spark, str(tmp_path)))).collect()}
    assert got == {k + 1: (cells[..., k].min(), cells[..., k].max()) for k in range(3)}
