"""TIFF columns: image directories are walked, strips and tiles decoded, predictors undone, one row per page.

Decodes PackBits, LZW, deflate and uncompressed data, both byte orders and fill orders, strips and tiles,
chunky and planar samples of 1, 2, 4, 8, 16, 32 or 64 bits, and the horizontal and floating-point predictors.
Samples below 8 bits come out one to a byte, as stored (whichever of black and white is 0). A small writer
stores rows of 8-bit samples (deflate, horizontal predictor), so that a column can make the round trip.

Defined results: a null medium gives no rows. A medium that is no TIFF, is cut short, uses something not
listed above, or declares more samples than its bytes can unpack to gives one row with ``error`` and null
pixels; an error on a later page ends the medium's pages, and so does a directory that was seen before. A
page is one cell of the result, so it holds 2 GiB at most, as Spark's cells do. Nothing is unpacked beyond
what a page declares. Repeated rows give equal rows. Extra columns are kept, those with the names of the
results are replaced.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .merges import blocks

#: Most bytes that a byte of the medium can unpack to: deflate's bound, the largest of all compressions.
EXPANSION = 1032
#: Bytes of a column that are coded at a time.
BLOCK = 8 << 20
#: Bytes of pixels from which a result is given out, unless a page alone has more; samples of a page that features take at a time.
PIXELS, SLICE = 32 << 20, 1 << 22

# Fixed values of the TIFF 6.0 format: bytes and struct code of each field type, and tag numbers.
FIELD_TYPES = {1: (1, "B"), 2: (1, "B"), 3: (2, "H"), 4: (4, "I"), 6: (1, "b"), 7: (1, "B"), 8: (2, "h"), 9: (4, "i")}
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC = 256, 257, 258, 259, 262
FILL_ORDER, STRIP_OFFSETS, SAMPLES, ROWS_PER_STRIP, STRIP_COUNTS, PLANAR, PREDICTOR = 266, 273, 277, 278, 279, 284, 317
TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_COUNTS, SAMPLE_FORMAT = 322, 323, 324, 325, 339
NONE, LZW, ADOBE_DEFLATE, PACKBITS, OLD_DEFLATE = 1, 5, 8, 32773, 32946


def unpack_bits(data: bytes, need: int | None = None) -> bytes:
    """PackBits: a count of up to 128 literal bytes, or a byte to repeat; ends after ``need`` bytes if given."""
    out, i = bytearray(), 0
    while i < len(data) and (need is None or len(out) < need):
        n = data[i]
        if n < 128:
            out += data[i + 1 : i + 2 + n]
            i += n + 2
        else:
            if n > 128:
                out += data[i + 1 : i + 2] * (257 - n)
            i += 2 if n > 128 else 1
    return bytes(out)


def unpack_lzw(data: bytes, need: int | None = None) -> bytes:
    """LZW with codes of 9 to 12 bits, highest bit first, widened one code early; ends after ``need`` bytes if given."""
    first = [bytes([i]) for i in range(256)] + [b"", b""]
    table, out, bits, held, width, last, size = list(first), [], 0, 0, 9, None, 0
    for byte in data:
        held, bits = held << 8 | byte, bits + 8
        if bits < width:
            continue
        bits -= width
        code = held >> bits
        held &= (1 << bits) - 1
        if code == 257:
            break
        if code == 256:
            table, width, last = list(first), 9, None
            continue
        if last is None:
            entry = table[code]
        else:
            entry = table[code] if code < len(table) else last + last[:1]
            if code > len(table):
                raise ValueError("bad LZW code")
            table.append(last + entry[:1])
        out.append(entry)
        size += len(entry)
        if need is not None and size >= need:
            break
        last = entry
        width = 9 if len(table) < 511 else 10 if len(table) < 1023 else 11 if len(table) < 2047 else 12
    return b"".join(out)


def _unpack(data: bytes, compression: int, need: int) -> bytes:
    """At least ``need`` bytes of a strip or tile, if it holds them, and little more."""
    if compression == NONE:
        return data[:need]
    if compression in (ADOBE_DEFLATE, OLD_DEFLATE):
        return zlib.decompressobj().decompress(data, need)
    if compression == PACKBITS:
        return unpack_bits(data, need)
    if compression == LZW:
        return unpack_lzw(data, need)
    raise ValueError(f"compression {compression} is not supported")


def _directory(data: bytes, order: str, at: int) -> tuple[dict[int, tuple], int]:
    """Tags of the image directory at ``at``, and where the next one lies (0: none)."""
    (count,) = struct.unpack_from(order + "H", data, at)
    tags = {}
    for i in range(count):
        tag, kind, n = struct.unpack_from(order + "HHI", data, at + 2 + 12 * i)
        if kind not in FIELD_TYPES:
            continue
        size, code = FIELD_TYPES[kind]
        place = at + 10 + 12 * i
        if size * n > 4:
            (place,) = struct.unpack_from(order + "I", data, place)
        tags[tag] = struct.unpack_from(f"{order}{n}{code}", data, place)
    return tags, struct.unpack_from(order + "I", data, at + 2 + 12 * count)[0]


def _undo_predictor(block: np.ndarray, predictor: int, order: str) -> np.ndarray:
    """block: rows x columns x samples."""
    if predictor == 1:
        return block
    if predictor == 2:
        return np.cumsum(block, axis=1, dtype=block.dtype)
    if predictor == 3 and block.dtype.kind == "f":
        rows, columns, samples = block.shape
        size = block.dtype.itemsize
        raw = np.frombuffer(block.tobytes(), np.uint8).reshape(rows, columns * samples * size)
        raw = np.cumsum(raw.reshape(rows, columns * size, samples), axis=1, dtype=np.uint8).reshape(rows, size, columns * samples)
        return np.ascontiguousarray(raw.transpose(0, 2, 1)).view(f">f{size}").reshape(rows, columns, samples)
    raise ValueError(f"predictor {predictor} is not supported")


# Fixed values of the format: bits and kind of the samples that are read.
SAMPLE_TYPES = {(1, "u"), (2, "u"), (4, "u"), (8, "u"), (8, "i"), (16, "u"), (16, "i"), (32, "u"), (32, "i"), (32, "f"), (64, "f")}


def _small_samples(raw: bytes, bits: int, rows: int, row_bytes: int) -> np.ndarray:
    """Samples of 1, 2 or 4 bits, highest first, one to a byte; each row begins with a byte of its own."""
    flat = np.unpackbits(np.frombuffer(raw, np.uint8).reshape(rows, row_bytes), axis=1).reshape(rows, -1, bits)
    return flat @ (1 << np.arange(bits - 1, -1, -1)).astype(np.uint8)


def read_page(data: bytes, order: str, tags: dict[int, tuple]) -> tuple[np.ndarray, int]:
    """Pixels (rows x columns x samples) and compression of one page."""
    one = lambda tag, default=None: tags[tag][0] if tags.get(tag) else default
    width, height, samples = one(WIDTH), one(HEIGHT), one(SAMPLES, 1)
    bits, form = tags.get(BITS) or (1,), {1: "u", 2: "i", 3: "f"}.get(one(SAMPLE_FORMAT, 1))
    if not width or not height or not samples or min(width, height, samples) < 0 or len(set(bits)) > 1 or (bits[0], form) not in SAMPLE_TYPES:
        raise ValueError("dimensions or sample type are missing or not supported")
    bits = bits[0]
    kind = np.dtype("u1" if bits < 8 else f"{order}{form}{bits // 8}")
    planes = samples if one(PLANAR, 1) == 2 else 1
    each = samples // planes
    compression, predictor = one(COMPRESSION, NONE), one(PREDICTOR, 1)
    if width * height * samples * bits > 8 * EXPANSION * len(data):
        raise ValueError("the page declares more samples than its bytes can hold")
    if width * height * samples * kind.itemsize >= 1 << 31:
        raise ValueError("the page is larger than a cell can be")
    if bits < 8 and predictor != 1:
        raise ValueError("a predictor needs samples of whole bytes")
    tiled = TILE_OFFSETS in tags
    across, down = (one(TILE_WIDTH), one(TILE_HEIGHT)) if tiled else (width, min(one(ROWS_PER_STRIP) or height, height))
    if not across or not down or across < 0 or down < 0:
        raise ValueError("tiles have no size")
    offsets, counts = (tags[TILE_OFFSETS], tags[TILE_COUNTS]) if tiled else (tags[STRIP_OFFSETS], tags[STRIP_COUNTS])
    columns, rows = -(-width // across), -(-height // down)
    if len(offsets) < columns * rows * planes or len(counts) < columns * rows * planes:
        raise ValueError("strips or tiles are missing")
    row_bytes = -(-across * each * bits // 8)
    if row_bytes * down > EXPANSION * len(data):
        raise ValueError("a tile declares more samples than its bytes can hold")
    page = np.zeros((height, width, samples), kind.newbyteorder("<"))
    for plane in range(planes):
        for i in range(columns * rows):
            k = plane * columns * rows + i
            top, left = i // columns * down, i % columns * across
            high = down if tiled else min(down, height - top)
            part = data[offsets[k] : offsets[k] + counts[k]]
            if one(FILL_ORDER, 1) == 2:
                part = np.packbits(np.unpackbits(np.frombuffer(part, np.uint8), bitorder="little")).tobytes()
            need = high * row_bytes
            raw = _unpack(part, compression, need)
            if len(raw) < need:
                raise ValueError("a strip or tile is cut short")
            if bits < 8:
                block = _small_samples(raw[:need], bits, high, row_bytes)[:, : across * each].reshape(high, across, each)
            else:
                block = _undo_predictor(np.frombuffer(raw[:need], kind).reshape(high, across, each), predictor, order)
            block = block[: height - top, : width - left]
            page[top : top + block.shape[0], left : left + block.shape[1], plane * each : plane * each + each] = block
    return page, compression


def read_tiff(data: bytes):
    """Yields (pixels, compression) of each page; raises ValueError for what can't be read, whatever the bytes."""
    order = {b"II*\0": "<", b"MM\0*": ">"}.get(data[:4])
    if order is None:
        raise ValueError("not a TIFF")
    try:
        (at,) = struct.unpack_from(order + "I", data, 4)
        seen = set()
        while at and at not in seen:
            seen.add(at)
            tags, at = _directory(data, order, at)
            yield read_page(data, order, tags)
    except (struct.error, zlib.error, LookupError, ArithmeticError, TypeError, MemoryError) as e:
        raise ValueError(f"damaged TIFF: {e}") from e


def write_tiff(payload: bytes, width: int = 64, rows_per_strip: int = 1024) -> bytes:
    """A page of 8-bit gray samples ``width`` wide, deflated in strips after horizontal differences."""
    image = np.frombuffer(payload, np.uint8).reshape(-1, width)
    if not len(image):
        raise ValueError("a page needs a row at least")
    change = image.copy()
    change[:, 1:] -= image[:, :-1]
    strips = [zlib.compress(change[i : i + rows_per_strip].tobytes(), 1) for i in range(0, len(image), rows_per_strip)]
    counts = [len(s) for s in strips]
    offsets = [8 + sum(counts[:i]) for i in range(len(strips))] if len(strips) < 64 else (8 + np.cumsum([0, *counts[:-1]])).tolist()
    end = 8 + sum(counts)
    arrays, extra = b"", end
    entries = []
    for tag, kind, values in (
        (WIDTH, 4, [width]), (HEIGHT, 4, [len(image)]), (BITS, 3, [8]), (COMPRESSION, 3, [ADOBE_DEFLATE]), (PHOTOMETRIC, 3, [1]),
        (STRIP_OFFSETS, 4, offsets), (SAMPLES, 3, [1]), (ROWS_PER_STRIP, 4, [rows_per_strip]), (STRIP_COUNTS, 4, counts), (PREDICTOR, 3, [2]),
    ):
        packed = struct.pack(f"<{len(values)}{FIELD_TYPES[kind][1]}", *values)
        if len(packed) > 4:
            entries.append(struct.pack("<HHII", tag, kind, len(values), extra + len(arrays)))
            arrays += packed
        else:
            entries.append(struct.pack("<HHI", tag, kind, len(values)) + packed.ljust(4, b"\0"))
    directory = struct.pack("<H", len(entries)) + b"".join(entries) + struct.pack("<I", 0)
    return struct.pack("<2sHI", b"II", 42, end + len(arrays)) + b"".join(strips) + arrays + directory


def store_texts(df: DataFrame, text: str = "text", media: str = "media") -> DataFrame:
    """Replace each text by n_bytes and a TIFF of its UTF-8 bytes, padded with 0 to a positive multiple of 64."""
    kept = [c for c in df.columns if c not in (text, media, "n_bytes")]

    def run(batches):
        for batch in batches:
            column = pc.fill_null(batch.column(len(kept)), b"")
            for a, b in blocks(pc.binary_length(column).to_pylist(), BLOCK):
                part = batch.slice(a, b - a)
                raw = column.slice(a, b - a).to_pylist()
                stored = [write_tiff(r.ljust(max(64, -(-len(r) // 64) * 64), b"\0")) for r in raw]
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(len(kept))), pa.array(map(len, raw), pa.int64()), pa.array(stored, pa.binary())], [*kept, "n_bytes", media])

    source = df.select(*kept, F.encode(F.col(text), "UTF-8").alias("_raw"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema if f.name != "_raw"), f"n_bytes long, {media} binary"])
    return source.mapInArrow(run, schema)


def _value_counts(flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct samples and how often they occur, by slices."""
    if flat.dtype.itemsize > 1:
        parts = [np.unique(flat[i : i + SLICE], return_counts=True) for i in range(0, len(flat), SLICE)]
        values, place = np.unique(np.concatenate([v for v, _ in parts]), return_inverse=True)
        return values, np.bincount(place, np.concatenate([c for _, c in parts])).astype(np.int64)
    return np.arange(256), sum(np.bincount(flat[i : i + SLICE].view(np.uint8), minlength=256) for i in range(0, len(flat), SLICE))


def page_feature(pixels: np.ndarray) -> str:
    """Mean, deviation, entropy and mean horizontal step of the samples."""
    flat = pixels.reshape(-1)
    values, counts = _value_counts(flat)
    share = counts[counts > 0] / len(flat)
    entropy = float(-(share * np.log2(share)).sum())
    height, width, samples = pixels.shape
    rows, places = max(1, SLICE // (width * samples)), max(1, SLICE // samples)
    total = 0.0
    for y in range(0, height, rows):
        for x in range(0, width - 1, places):  # a slice and the first sample after it
            total += float(np.abs(np.diff(pixels[y : y + rows, x : x + places + 1].astype(np.float64), axis=1)).sum())
    step = total / (height * (width - 1) * samples) if width > 1 else 0.0
    mean = float((values * (counts / len(flat))).sum())
    deviation = float(np.sqrt(max(0.0, (np.square(values - mean) * (counts / len(flat))).sum())))
    return f"mean={mean:.6f};deviation={deviation:.6f};entropy={entropy:.6f};step={step:.6f}"


def tiff_pages(df: DataFrame, media: str = "media") -> DataFrame:
    """One row per page: the columns of df, and page, width, height, samples, compression, pixels, feature, error."""
    results = "page int, width int, height int, samples int, compression int, pixels binary, feature string, error string"
    names = [x.split()[0] for x in results.split(", ")]
    kept = [c for c in df.columns if c not in names]
    source = df.select(*kept)
    at = kept.index(media)

    def result(batch, rows, out):
        kinds = [pa.int32()] * 5 + [pa.binary(), pa.string(), pa.string()]
        made = [pa.array([o[k] for o in out], kind) for k, kind in enumerate(kinds)]
        return pa.RecordBatch.from_arrays([*(batch.column(i).take(pa.array(rows, pa.int64())) for i in range(len(kept))), *made], [*kept, *names])

    def run(batches):
        for batch in batches:
            column = batch.column(at)
            for a, b in blocks(pc.fill_null(pc.binary_length(column), 0).to_pylist(), BLOCK):
                rows, out, held = [], [], 0
                for i in range(a, b):
                    data, page = column[i].as_py(), 0
                    if data is None:
                        continue
                    try:
                        for pixels, compression in read_tiff(data):
                            if held and held + pixels.nbytes > PIXELS:
                                yield result(batch, rows, out)
                                rows, out, held = [], [], 0
                            held += pixels.nbytes
                            out.append((page, pixels.shape[1], pixels.shape[0], pixels.shape[2], compression, pixels.tobytes(), page_feature(pixels), None))
                            rows.append(i)
                            page += 1
                    except ValueError as e:
                        out.append((page, None, None, None, None, None, None, str(e)[:200]))
                        rows.append(i)
                yield result(batch, rows, out)

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema), results])
    return source.mapInArrow(run, schema)
