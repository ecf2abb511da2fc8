"""Rasters in tagged files: headers, blocks as pixel rows, window files, and copies with another profile.

Readers fetch the header and the blocks that they are asked for, never a whole file; a raster's blocks are dealt to tasks.
Tiles and strips, plain and Deflate blocks, either byte order, files of 4 and of 8 byte offsets, and pixels interleaved by
pixel or by band are read.  A block without data has no bytes in a sparse file; it reads as no_data.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Field types: bytes and struct codes; sample kinds; block codecs; tags by name (fixed values of the format).
TYPES = {1: (1, "B"), 2: (1, "s"), 3: (2, "H"), 4: (4, "I"), 5: (8, "II"), 6: (1, "b"), 8: (2, "h"), 9: (4, "i"), 11: (4, "f"), 12: (8, "d"), 13: (4, "I"), 16: (8, "Q"), 17: (8, "q"), 18: (8, "Q")}
KINDS = {1: "uint", 2: "int", 3: "float"}
CODECS = {1: None, 8: "DEFLATE", 32946: "DEFLATE", 4: "CCITTFAX4", 5: "LZW"}
TAGS = {"width": 256, "height": 257, "bits": 258, "compression": 259, "photometric": 262, "strips": 273, "samples": 277, "strip_rows": 278, "strip_bytes": 279, "planar": 284, "predictor": 317, "tile_width": 322, "tile_height": 323, "tiles": 324, "tile_bytes": 325, "kind": 339, "scale": 33550, "tie": 33922, "keys": 34735, "no_data": 42113}
GEOGRAPHIC, PROJECTED = 2048, 3072
SCHEMA = "path string, width int, height int, count int, dtype string, nbits int, compress string, tiled boolean, blockxsize int, blockysize int, interleave string, crs string, no_data double, transform array<double>, l double, b double, r double, t double"


@dataclass(frozen=True)
class Header:
    width: int
    height: int
    count: int
    dtype: str
    nbits: int
    compress: str | None
    tiled: bool
    blockxsize: int
    blockysize: int
    interleave: str
    crs: str | None
    no_data: float | None
    transform: tuple[float, ...]
    order: str = "<"
    predictor: int = 1
    offsets: tuple[int, ...] = field(default=(), repr=False)
    sizes: tuple[int, ...] = field(default=(), repr=False)

    @property
    def across(self) -> int:
        return -(-self.width // self.blockxsize)

    @property
    def down(self) -> int:
        return -(-self.height // self.blockysize)

    def bounds(self) -> tuple[float, float, float, float]:
        res_x, _, left, _, res_y, top = self.transform
        return left, top + res_y * self.height, left + res_x * self.width, top


def read_header(f) -> Header:
    """The header of an open file; raises ValueError if it is no such file or holds what this reader does not know."""
    order = {b"II": "<", b"MM": ">"}.get(f.read(2))
    if order is None:
        raise ValueError("not a tagged raster file")
    (version,) = struct.unpack(order + "H", f.read(2))
    if version == 42:
        (at,), n_code, e_size, o_code = struct.unpack(order + "I", f.read(4)), "H", 12, "I"
    elif version == 43:
        (_, _, at), n_code, e_size, o_code = struct.unpack(order + "HHQ", f.read(12)), "Q", 20, "Q"
    else:
        raise ValueError("not a tagged raster file")
    f.seek(at)
    (n,) = struct.unpack(order + n_code, f.read(struct.calcsize(n_code)))
    entries = f.read(n * e_size)
    o_size, tags = struct.calcsize(o_code), {}
    for k in range(n):
        tag, kind, count = struct.unpack_from(order + "HH" + o_code, entries, k * e_size)
        if kind not in TYPES:
            continue
        size, code = TYPES[kind]
        at = k * e_size + 4 + o_size
        if size * count <= o_size:
            data = entries[at : at + size * count]
        else:
            f.seek(struct.unpack_from(order + o_code, entries, at)[0])
            data = f.read(size * count)
        tags[tag] = data if code == "s" else struct.unpack(order + code * count, data)
    get = lambda name, default=None: tags.get(TAGS[name], default)
    bits, kind = get("bits", (1,))[0], get("kind", (1,))[0]
    compression = get("compression", (1,))[0]
    if compression not in CODECS or kind not in KINDS:
        raise ValueError(f"compression {compression} or sample kind {kind} is not known")
    width, height, tiled = get("width")[0], get("height")[0], get("tiles") is not None
    keys = get("keys", ())
    code = next((v for k, _, _, v in zip(*(keys[i::4] for i in range(4)), strict=False) if k in (GEOGRAPHIC, PROJECTED)), None)
    scale, tie = get("scale", (1.0, -1.0, 0.0)), get("tie", (0.0,) * 6)
    transform = (scale[0], 0.0, tie[3] - tie[0] * scale[0], 0.0, -scale[1], tie[4] + tie[1] * scale[1]) if get("scale") else (1.0, 0.0, 0.0, 0.0, 1.0, 0.0)
    text = get("no_data", b"").split(b"\0")[0].strip()
    return Header(
        width, height, get("samples", (1,))[0], f"{KINDS[kind]}{max(8, bits)}", bits, CODECS[compression], tiled, get("tile_width", (width,))[0] if tiled else width, get("tile_height")[0] if tiled else min(height, get("strip_rows", (height,))[0]),
        "BAND" if get("planar", (1,))[0] == 2 else "PIXEL", f"EPSG:{code}" if code else None, float(text) if text else None, transform, order, get("predictor", (1,))[0], get("tiles" if tiled else "strips", ()), get("tile_bytes" if tiled else "strip_bytes", ()),
    )


def read_block(f, h: Header, band: int, row: int, col: int) -> np.ndarray:
    """A block of a band, cut to the raster; no_data (or 0) where the file has no bytes for it."""
    shape = min(h.blockysize, h.height - row * h.blockysize), min(h.blockxsize, h.width - col * h.blockxsize)
    k = row * h.across + col + (band * h.across * h.down if h.interleave == "BAND" else 0)
    kind = np.dtype(h.dtype).newbyteorder(h.order)
    if h.nbits not in (8, 16, 32, 64) or h.compress not in (None, "DEFLATE"):
        raise ValueError(f"blocks of {h.nbits} bits and compression {h.compress} are not read")
    if not h.sizes[k]:
        return np.full(shape, h.no_data or 0, kind.newbyteorder("="))
    f.seek(h.offsets[k])
    data = f.read(h.sizes[k])
    data = zlib.decompress(data) if h.compress else data
    samples = 1 if h.interleave == "BAND" else h.count
    block = np.frombuffer(data, kind)[: len(data) // kind.itemsize].reshape(-1, h.blockxsize, samples)
    if h.predictor == 2:
        block = np.cumsum(block, axis=1, dtype=kind.newbyteorder("="))
    elif h.predictor != 1:
        raise ValueError(f"predictor {h.predictor} is not read")
    return block[: shape[0], : shape[1], 0 if h.interleave == "BAND" else band].astype(kind.newbyteorder("="))


def encode(bands: np.ndarray, h: Header) -> bytes:
    """A file of bands (count, height, width): tiles, by band, little-endian; blocks of no_data alone are left out."""
    count, height, width = bands.shape
    kind = np.dtype(h.dtype).newbyteorder("<")
    h = replace(h, count=count, height=height, width=width, interleave="BAND", tiled=True, order="<", predictor=1)
    blocks = []
    for band in bands:
        for row in range(h.down):
            for col in range(h.across):
                part = band[row * h.blockysize : (row + 1) * h.blockysize, col * h.blockxsize : (col + 1) * h.blockxsize]
                if (part == (h.no_data or 0)).all():
                    blocks.append(b"")
                    continue
                full = np.full((h.blockysize, h.blockxsize), h.no_data or 0, kind)
                full[: part.shape[0], : part.shape[1]] = part
                blocks.append(zlib.compress(full.tobytes()) if h.compress == "DEFLATE" else full.tobytes())
    return assembled(h, blocks)


def assembled(h: Header, blocks: list[bytes]) -> bytes:
    """Header, directory and blocks as one file; above 4 GB with 8 byte offsets."""
    big = sum(map(len, blocks)) > 0xFFF00000
    res_x, _, left, _, res_y, top = h.transform
    bits = h.nbits if h.nbits in (8, 16, 32, 64) else np.dtype(h.dtype).itemsize * 8
    sample = next(k for k, v in KINDS.items() if h.dtype.startswith(v))
    code = int(h.crs.removeprefix("EPSG:")) if h.crs else 0
    keys = (1, 1, 0, 2, 1024, 0, 1, 2 if code == 4326 else 1, GEOGRAPHIC if code == 4326 else PROJECTED, 0, 1, code)
    tags = {
        TAGS["width"]: (4, (h.width,)), TAGS["height"]: (4, (h.height,)), TAGS["bits"]: (3, (bits,) * h.count), TAGS["compression"]: (3, (8 if h.compress == "DEFLATE" else 1,)), TAGS["photometric"]: (3, (1,)), TAGS["samples"]: (3, (h.count,)),
        TAGS["planar"]: (3, (2,)), TAGS["tile_width"]: (4, (h.blockxsize,)), TAGS["tile_height"]: (4, (h.blockysize,)), TAGS["tiles"]: (16 if big else 4, (0,) * len(blocks)), TAGS["tile_bytes"]: (16 if big else 4, tuple(map(len, blocks))), TAGS["kind"]: (3, (sample,) * h.count),
        TAGS["scale"]: (12, (res_x, -res_y, 0.0)), TAGS["tie"]: (12, (0.0, 0.0, 0.0, left, top, 0.0)),
    }
    tags |= {TAGS["keys"]: (3, keys)} if code else {}
    tags |= {TAGS["no_data"]: (2, f"{h.no_data:g}".encode() + b"\0")} if h.no_data is not None else {}
    n_code, o_code, head = ("Q", "Q", 16) if big else ("H", "I", 8)
    o_size, e_size = struct.calcsize(o_code), 4 + 2 * struct.calcsize(o_code)
    packed = lambda kind, v: v if kind == 2 else struct.pack("<" + TYPES[kind][1] * len(v), *v)
    at = head + struct.calcsize(n_code) + e_size * len(tags) + o_size
    places = {}
    for tag, (kind, v) in sorted(tags.items()):
        if (size := len(packed(kind, v))) > o_size:
            places[tag], at = at, at + size
    offsets = []
    for b in blocks:
        offsets.append(at if b else 0)
        at += len(b)
    tags[TAGS["tiles"]] = (tags[TAGS["tiles"]][0], tuple(offsets))
    out = [b"II" + (struct.pack("<HHHQ", 43, 8, 0, head) if big else struct.pack("<HI", 42, head)), struct.pack("<" + n_code, len(tags))]
    rest = []
    for tag, (kind, v) in sorted(tags.items()):
        data = packed(kind, v)
        inline = data.ljust(o_size, b"\0") if tag not in places else struct.pack("<" + o_code, places[tag])
        out.append(struct.pack("<HH" + o_code, tag, kind, len(v)) + inline)
        rest += [data] if tag in places else []
    return b"".join([*out, struct.pack("<" + o_code, 0), *rest, *blocks])


def opened(path: str):
    store, at = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    return store.open_input_file(at)


def profiles(files: DataFrame) -> DataFrame:
    """A row for each of files(path): its header and bounds.  A file that is missing or no raster is an error that names it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for path in batch.column("path").to_pylist():
                try:
                    with opened(path) as f:
                        h = read_header(f)
                except (OSError, ValueError) as e:
                    raise type(e)(f"{path}: {e}") from e
                l, b, r, t = h.bounds()  # noqa: E741
                rows.append({"path": path, "width": h.width, "height": h.height, "count": h.count, "dtype": h.dtype, "nbits": h.nbits, "compress": h.compress, "tiled": h.tiled, "blockxsize": h.blockxsize, "blockysize": h.blockysize, "interleave": h.interleave, "crs": h.crs, "no_data": h.no_data, "transform": list(h.transform), "l": l, "b": b, "r": r, "t": t})
            i, s, d = pa.int32(), pa.string(), pa.float64()
            yield pa.RecordBatch.from_pylist(rows, pa.schema(list(zip(("path", "width", "height", "count", "dtype", "nbits", "compress", "tiled", "blockxsize", "blockysize", "interleave", "crs", "no_data", "transform", "l", "b", "r", "t"), (s, i, i, i, s, i, s, pa.bool_(), i, i, s, s, d, pa.list_(d), d, d, d, d), strict=True))))

    return files.select("path").mapInArrow(run, SCHEMA)


def pixels(files: DataFrame, window: tuple[int, int, int, int] | None = None) -> DataFrame:
    """(path, band, r, c, v) of files(path): all pixels, or those of a window (col_off, row_off, width, height); no_data is null.

    Each block is one row of work, dealt out among the tasks; blocks that a window does not meet are not read.
    """
    h = profiles(files)
    col, row, wide, high = window or (0, 0, 1 << 30, 1 << 30)
    span = lambda low, size, end, block: F.sequence(F.floor(F.lit(low) / F.col(block)).cast("int"), F.floor((F.least(F.lit(low + size), F.col(end)) - 1) / F.col(block)).cast("int"))
    some = h.where((F.col("width") > col) & (F.col("height") > row))
    work = some.select("path", F.explode(F.sequence(F.lit(0), F.col("count") - 1)).alias("band"), "width", "height", "blockxsize", "blockysize")
    work = work.withColumn("by", F.explode(span(row, high, "height", "blockysize"))).withColumn("bx", F.explode(span(col, wide, "width", "blockxsize")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, f, h = None, None, None
        for batch in batches:
            for x in batch.to_pylist():
                if x["path"] != path:
                    if f:
                        f.close()
                    path, f = x["path"], opened(x["path"])
                    h = read_header(f)
                block = read_block(f, h, x["band"], x["by"], x["bx"]).astype(np.float64)
                r, c = x["by"] * h.blockysize + np.arange(block.shape[0]), x["bx"] * h.blockxsize + np.arange(block.shape[1])
                inside = ((r >= row) & (r < row + high))[:, None] & ((c >= col) & (c < col + wide))
                r, c, v = np.repeat(r, block.shape[1])[inside.ravel()], np.tile(c, block.shape[0])[inside.ravel()], block[inside]
                valid = np.isfinite(v) if h.no_data is None or np.isnan(h.no_data) else np.isfinite(v) & (v != h.no_data)
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(v)), pa.array(np.full(len(v), x["band"]), pa.int32()), pa.array(r, pa.int32()), pa.array(c, pa.int32()), pa.array(v, mask=~valid)], names=["path", "band", "r", "c", "v"])
        if f:
            f.close()

    return work.repartition("path", "band", "by", "bx").select("path", "band", "by", "bx").sortWithinPartitions("path").mapInArrow(run, "path string, band int, r int, c int, v double")


def write_windows(blocks: DataFrame, folder: str, like: Header, size: int) -> DataFrame:
    """Pixels(tile_id, left, top, r, c, bands array<double>) as a file for each window of size x size; (tile_id, path) of what was written.

    The files are called tile_column_row and carry the window's own transform; a file appears whole or not at all.
    """
    step = lambda c: (F.floor(F.col(c) / size) * size).cast("int")

    def write(rows):
        import pandas as pd

        tile, col, row = rows.tile_id.iloc[0], int(rows._col.iloc[0]), int(rows._row.iloc[0])
        bands = np.full((like.count, min(size, like.height - row), min(size, like.width - col)), like.no_data or 0, like.dtype)
        bands[:, rows.r.to_numpy() - row, rows.c.to_numpy() - col] = np.array(rows.bands.tolist(), np.float64).T
        res_x, _, _, _, res_y, _ = like.transform
        own = replace(like, transform=(res_x, 0.0, rows.left.iloc[0] + col * res_x, 0.0, res_y, rows.top.iloc[0] + row * res_y))
        path = f"{folder}/{tile}_{col}_{row}.tif"
        put(path, encode(bands, own))
        return pd.DataFrame({"tile_id": [tile], "path": [path]})

    dealt = blocks.withColumn("_row", step("r")).withColumn("_col", step("c"))
    return dealt.groupBy("tile_id", "_row", "_col").applyInPandas(write, "tile_id string, path string")


def put(path: str, data: bytes) -> None:
    """Writes a file under a name of its own and renames it, so that no reader sees a part; a file that is there is replaced."""
    store, at = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    folder, own = at.rsplit("/", 1)[0], f"{at}.{uuid.uuid4().hex}"
    store.create_dir(folder)
    with store.open_output_stream(own) as f:
        f.write(data)
    if store.get_file_info(at).type != fs.FileType.NotFound:
        store.delete_file(at)
    store.move(own, at)


def convert(files: DataFrame, folder: str, compress: str | None = "DEFLATE") -> DataFrame:
    """Copies of files(path) below folder, by band and tiled, with another compression; (path, copy).  Blocks are copied one by one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for path in batch.column("path").to_pylist():
                with opened(path) as f:
                    h = read_header(f)
                    new = replace(h, compress=compress, interleave="BAND", tiled=True, order="<", predictor=1)
                    same = h.compress == compress and h.interleave == "BAND" and h.tiled and h.predictor == 1 and h.order == "<"
                    blocks = []
                    for band in range(h.count):
                        for k in range(h.across * h.down):
                            n = k + band * h.across * h.down if h.interleave == "BAND" else k
                            if same or not h.sizes[n]:
                                f.seek(h.offsets[n])
                                blocks.append(f.read(h.sizes[n]) if h.sizes[n] else b"")
                                continue
                            part = read_block(f, h, band, *divmod(k, h.across))
                            full = np.full((h.blockysize, h.blockxsize), h.no_data or 0, np.dtype(h.dtype).newbyteorder("<"))
                            full[: part.shape[0], : part.shape[1]] = part
                            blocks.append(zlib.compress(full.tobytes()) if compress else full.tobytes())
                out.append(f"{folder}/{path.rsplit('/', 1)[1]}")
                put(out[-1], assembled(new, blocks))
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(out, pa.string())], names=["path", "copy"])

    return files.select("path").mapInArrow(run, "path string, copy string")


def listed(spark: SparkSession, paths: list[str]) -> DataFrame:
    """files(path) of a list, a task for each up to 4096."""
    return spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, min(len(paths), 4096)))
