import os
import struct
import sys
import tempfile
import zlib

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tablelearn.session import get_spark

    s = get_spark("local[4]", shuffle_partitions=8, extra={"spark.ui.showConsoleProgress": "false"})
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="tl-test-")


def write_png(path, rgb):
    """Minimal 8-bit RGB PNG writer (rows of filter-0 scanlines, zlib)."""
    h, w = len(rgb), len(rgb[0])
    raw = b"".join(b"\x00" + bytes(v for px in row for v in px) for row in rgb)

    def chunk(tag, data):
        return struct.pack(">I", len(data)) + tag + data + struct.pack(">I", zlib.crc32(tag + data) & 0xFFFFFFFF)
    png = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + \
        chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")
    with open(path, "wb") as f:
        f.write(png)


@pytest.fixture()
def house(spark):
    rows = [(1, 1500.0, 800.0, 3, 2, 0, 6, 2000, 2, 210000), (2, 1800.0, 900.0, 4, 2, 1, 7, 2010, 2, 260000),
            (3, 1200.0, None, 2, 1, 0, 5, 1995, 1, 150000), (4, 2200.0, 1100.0, 5, 3, 1, 9, 2018, 3, 340000),
            (5, 1600.0, 700.0, 3, 2, 0, 6, 2005, 2, 225000)]
    return spark.createDataFrame(rows, "Id long, GrLivArea double, TotalBsmtSF double, BedroomAbvGr int, FullBath int, "
                                       "HalfBath int, OverallQual int, YearBuilt int, GarageCars int, SalePrice long")
