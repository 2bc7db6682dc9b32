"""TIFF columns: one row per page of each image.

The reader walks the chain of image directories, decodes uncompressed, PackBits,
LZW and deflate data in strips or tiles, undoes the horizontal predictor and
gives the samples row by row.  The writer stores bytes as 8-bit samples, each
page in a form of its own.

Classic TIFF of either byte order, with 8- or 16-bit samples in one plane or in
planes of their own. Defined cases: a null or empty image gives no rows; a page
that is damaged, uses something else, or claims more samples than its bytes can
stand for (or than ``MOST`` bytes) gives one row with ``error`` set and the fields
after it null, and the pages after it are read as long as the chain of
directories can be followed; a directory that can't be read gives such a row and
ends the image; a chain that loops ends there. Other columns of the input are not
read but the id and those to be handed on.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bibweave.scratch import Scratch, small_batches

NONE, LZW, DEFLATE, PACKBITS = 1, 5, 8, 32773
#: Bytes to a row of the query's images, rows to a strip, to a tile and to a page.
WIDTH, STRIP_ROWS, TILE_ROWS, PAGE_ROWS = 192, 1024, 256, 512
#: Bytes of samples that one page may have: what a column of binary values can hold.
MOST = 1 << 30
#: Bytes that one byte of compressed data can stand for, at most.
RATIO = {NONE: 1, PACKBITS: 64, LZW: 4096, DEFLATE: 1040, 32946: 1040}
#: How pages of texts are stored: compression, predictor, and whether in tiles.
FORMS = ((DEFLATE, 2, False), (PACKBITS, 1, False), (LZW, 1, True))
#: Bytes of samples handed on at a time.
_BATCH = 8 << 20
_RUN = re.compile(rb"(.)\1{2,127}", re.DOTALL)
PAGE_SCHEMA = "page int, width int, height int, samples int, bits int, compression int, predictor int, pixels binary, error string"
_SIZE = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8}


class TiffError(ValueError):
    pass


def packbits_decode(data: bytes, expected: int) -> bytes:
    out, at, have = [], 0, 0
    while at < len(data) and have < expected:
        n = data[at]
        at += 1
        if n < 128:
            piece = data[at : at + n + 1]
            at += n + 1
        elif n > 128:
            piece = data[at : at + 1] * (257 - n)
            at += 1
        else:
            continue
        out.append(piece)
        have += len(piece)
    return b"".join(out)[:expected]


def packbits_encode(data: bytes) -> bytes:
    """Runs of three and more as such, what is between them as it is."""
    out, lit = bytearray(), 0

    def flush(a: int, b: int) -> None:
        for i in range(a, b, 128):
            part = data[i : min(i + 128, b)]
            out.append(len(part) - 1)
            out.extend(part)

    for run in _RUN.finditer(data):
        flush(lit, run.start())
        lit = run.end()
        out.extend((257 - (lit - run.start()), data[run.start()]))
    flush(lit, len(data))
    return bytes(out)


def lzw_decode(data: bytes, expected: int) -> bytes:
    """Most significant bit first; code width grows one code early, as TIFF has it."""
    base = [bytes((i,)) for i in range(256)] + [b"", b""]
    table, out, have = list(base), [], 0
    bits = acc = 0
    width, last = 9, None
    for byte in data:
        acc = (acc << 8) | byte
        bits += 8
        if bits < width:
            continue
        bits -= width
        code = acc >> bits
        acc &= (1 << bits) - 1
        if code == 257:
            break
        if code == 256:
            table, width, last = list(base), 9, None
            continue
        if last is None:
            if code >= 256:
                raise TiffError("LZW starts with a code that is not defined")
            entry = table[code]
        else:
            if code < len(table):
                entry = table[code]
            elif code == len(table):
                entry = last + last[:1]
            else:
                raise TiffError("LZW code is not defined")
            table.append(last + entry[:1])
            if len(table) >= (1 << width) - 1 and width < 12:
                width += 1
        out.append(entry)
        have += len(entry)
        last = entry
        if have >= expected:
            break
    return b"".join(out)[:expected]


def lzw_encode(data: bytes) -> bytes:
    out, acc, bits = bytearray(), 0, 0
    table: dict[bytes, int] = {}
    width, size, word = 9, 258, b""

    def put(code: int) -> None:
        nonlocal acc, bits
        acc = (acc << width) | code
        bits += width
        while bits >= 8:
            bits -= 8
            out.append((acc >> bits) & 255)
        acc &= (1 << bits) - 1

    def code_of(w: bytes) -> int:
        return w[0] if len(w) == 1 else table[w]

    put(256)
    for i in range(len(data)):
        longer = word + data[i : i + 1]
        if len(longer) == 1 or longer in table:
            word = longer
            continue
        put(code_of(word))
        table[longer] = size
        size += 1
        if size >= 4094:
            put(256)
            table, size, width = {}, 258, 9
        elif size > (1 << width) - 1:
            width += 1
        word = data[i : i + 1]
    if word:
        put(code_of(word))
        size += 1
        if size > (1 << width) - 1 and width < 12:
            width += 1
    put(257)
    if bits:
        out.append((acc << (8 - bits)) & 255)
    return bytes(out)


def _unpack(data: bytes, compression: int, expected: int) -> bytes:
    if compression == NONE:
        got = data[:expected]
    elif compression == PACKBITS:
        got = packbits_decode(data, expected)
    elif compression == LZW:
        got = lzw_decode(data, expected)
    elif compression in (DEFLATE, 32946):
        try:
            got = zlib.decompressobj().decompress(data, expected)
        except zlib.error as e:
            raise TiffError(f"deflate: {e}") from None
    else:
        raise TiffError(f"compression {compression} is not supported")
    if len(got) < expected:
        raise TiffError(f"{len(got)} bytes where {expected} are due")
    return got


def _pack(data: bytes, row: int, compression: int, level: int) -> bytes:
    if compression == PACKBITS:  # each row on its own
        return b"".join(packbits_encode(data[i : i + row]) for i in range(0, len(data), row))
    return {NONE: bytes, LZW: lzw_encode}.get(compression, lambda d: zlib.compress(d, level))(data)


def _directory(data: bytes, at: int, order: str) -> tuple[dict[int, list[int]], int]:
    """Whole-number tags of one directory, and where the next one is (0: nowhere)."""
    try:
        (n,) = struct.unpack_from(order + "H", data, at)
        tags: dict[int, list[int]] = {}
        for i in range(n):
            tag, kind, count = struct.unpack_from(order + "HHI", data, at + 2 + 12 * i)
            size = _SIZE.get(kind)
            if kind not in (1, 3, 4) or size is None:
                continue
            place = at + 10 + 12 * i
            if size * count > 4:
                (place,) = struct.unpack_from(order + "I", data, place)
            if place + size * count > len(data):
                raise TiffError("a tag points past the end")
            tags[tag] = list(struct.unpack_from(f"{order}{count}{'BHI'[(1, 3, 4).index(kind)]}", data, place))
        (after,) = struct.unpack_from(order + "I", data, at + 2 + 12 * n)
    except struct.error:
        raise TiffError("a directory is cut off") from None
    return tags, after


def _page(data: bytes, tags: dict[int, list[int]], order: str) -> dict:
    def one(tag: int, what: str, default: int | None = None, allowed: tuple[int, ...] | None = None) -> int:
        value = tags[tag][0] if tags.get(tag) else default
        if not value or (allowed and value not in allowed):
            raise TiffError(f"{what} is {value}")
        return value

    width, height, samples = one(256, "width"), one(257, "height"), one(277, "number of samples", 1)
    compression, planar, predictor = one(259, "compression", 1, tuple(RATIO)), one(284, "planar configuration", 1, (1, 2)), one(317, "predictor", 1, (1, 2))
    bits = one(258, "bits to a sample", 1, (8, 16))
    if len(set(tags.get(258, [bits]))) > 1:
        raise TiffError(f"{tags[258]} bits to a sample are not supported")
    size, planes = bits // 8, samples if planar == 2 else 1
    deep = 1 if planar == 2 else samples
    tiled = 322 in tags
    across, down = (one(322, "tile width"), one(323, "tile height")) if tiled else (width, min(one(278, "rows to a strip", height), height))
    starts, counts = tags.get(324 if tiled else 273, []), tags.get(325 if tiled else 279, [])
    columns, rows = -(-width // across), -(-height // down)
    if len(starts) < columns * rows * planes or len(counts) < columns * rows * planes:
        raise TiffError("strips or tiles are missing")
    blocks = list(zip(starts[: columns * rows * planes], counts[: columns * rows * planes], strict=True))
    if any(a + n > len(data) for a, n in blocks):
        raise TiffError("a strip or tile ends past the end")
    # nothing is allocated that the bytes at hand can't fill
    due, most = width * height * samples * size, max(n for _, n in blocks) * RATIO[compression]
    if due > sum(n for _, n in blocks) * RATIO[compression] or across * min(down, height if not tiled else down) * deep * size > most or due > MOST:
        raise TiffError(f"{due} bytes of samples from {sum(n for _, n in blocks)}")
    kind = np.dtype(("<" if order == "<" else ">") + f"u{size}")
    out = np.zeros((planes, height, width, deep), kind)
    for p in range(planes):
        for r in range(rows):
            tall = down if tiled else min(down, height - r * down)
            for c in range(columns):
                at, n = blocks[(p * rows + r) * columns + c]
                block = np.frombuffer(_unpack(data[at : at + n], compression, across * tall * deep * size), kind).reshape(tall, across, deep)
                if predictor == 2:
                    block = np.cumsum(block, axis=1, dtype=kind.newbyteorder("=")).astype(kind)
                h, w = min(tall, height - r * down), min(across, width - c * across)
                out[p, r * down : r * down + h, c * across : c * across + w] = block[:h, :w]
    pixels = np.moveaxis(out, 0, 2).reshape(height, width, samples) if planes > 1 else out[0]
    return {"width": width, "height": height, "samples": samples, "bits": bits, "compression": compression, "predictor": predictor, "pixels": pixels.astype(kind.newbyteorder("<")).tobytes(), "error": None}


def _failed(n: int, why: str) -> dict:
    return {"page": n, "width": None, "height": None, "samples": None, "bits": None, "compression": None, "predictor": None, "pixels": None, "error": why}


def pages(data: bytes | None):
    """Rows of PAGE_SCHEMA, as dicts."""
    if not data:
        return
    n = 0
    try:
        order = {b"II": "<", b"MM": ">"}.get(data[:2])
        if order is None or len(data) < 8 or struct.unpack_from(order + "H", data, 2)[0] != 42:
            raise TiffError("not a TIFF header")
        (at,) = struct.unpack_from(order + "I", data, 4)
        seen: set[int] = set()
        while at and at not in seen:
            seen.add(at)
            tags, at = _directory(data, at, order)
            try:
                yield {"page": n, **_page(data, tags, order)}
            except (ValueError, ArithmeticError, LookupError, MemoryError) as e:  # whatever its tags say, one page can't end the task
                yield _failed(n, str(e) or type(e).__name__)
            n += 1
    except TiffError as e:
        yield _failed(n, str(e))


def encode(images: list[bytes], width: int = WIDTH, samples: int = 1, compression: int = DEFLATE, predictor: int = 1, strip_rows: int = STRIP_ROWS, tile: tuple[int, int] | None = None, level: int = 1, order: str = "<", forms: list[tuple[int, int, tuple[int, int] | None]] | None = None) -> bytes:
    """A TIFF with one page per item; an item's length is a multiple of width * samples. ``forms`` gives compression, predictor and tile page by page."""
    out = bytearray((b"II" if order == "<" else b"MM") + struct.pack(order + "HI", 42, 0))
    link = 4
    for image, (compression, predictor, tile) in zip(images, forms or [(compression, predictor, tile)] * len(images), strict=True):
        height = len(image) // (width * samples)
        x = np.frombuffer(image, np.uint8).reshape(height, width, samples)
        across, down = tile or (width, min(strip_rows, height))
        starts, counts = [], []
        for r in range(0, height, down):
            for c in range(0, width, across):
                block = x[r : r + down, c : c + across]
                if tile and block.shape[:2] != (down, across):
                    block = np.pad(block, ((0, down - block.shape[0]), (0, across - block.shape[1]), (0, 0)))
                if predictor == 2:
                    block = np.diff(block, axis=1, prepend=np.zeros((block.shape[0], 1, samples), np.uint8))
                packed = _pack(block.tobytes(), block.shape[1] * samples, compression, level)
                starts.append(len(out))
                counts.append(len(packed))
                out += packed
        tags = [(256, 4, [width]), (257, 4, [height]), (258, 3, [8] * samples), (259, 3, [compression]), (262, 3, [2 if samples == 3 else 1]), (277, 3, [samples])]
        if tile:
            tags += [(317, 3, [predictor]), (322, 4, [across]), (323, 4, [down]), (324, 4, starts), (325, 4, counts)]
        else:
            tags += [(273, 4, starts), (278, 4, [down]), (279, 4, counts), (317, 3, [predictor])]
        entries = b""
        for tag, kind, values in sorted(tags):
            raw = struct.pack(f"{order}{len(values)}{'H' if kind == 3 else 'I'}", *values)
            if len(raw) > 4:
                place = len(out)
                out += raw + b"\0" * (len(raw) % 2)
                raw = struct.pack(order + "I", place)
            entries += struct.pack(order + "HHI", tag, kind, len(values)) + raw.ljust(4, b"\0")
        out += b"\0" * (len(out) % 2)
        struct.pack_into(order + "I", out, link, len(out))
        link = len(out) + 2 + len(entries)
        out += struct.pack(order + "H", len(tags)) + entries + struct.pack(order + "I", 0)
    return bytes(out)


def read_pages(images: DataFrame, image: str, id_col: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per page: the id, the columns of PAGE_SCHEMA, and those to be carried.

    Rows of one image follow each other, page by page; a page is handed on before the next one is decoded.
    """
    small_batches(images.sparkSession)
    kind = lambda c: images.schema[c].dataType.simpleString()
    own = [x.strip().split(" ")[0] for x in PAGE_SCHEMA.split(",")]
    types = [pa.int32()] * 7 + [pa.binary(), pa.string()]
    names = [id_col, *own, *carry]

    def run(batches):
        for batch in batches:
            at, rows, size = [], [], 0

            def ready(at=at, rows=rows, batch=batch):
                take = pa.array(at, pa.int64())
                return pa.RecordBatch.from_arrays([batch.column(0).take(take), *(pa.array([r[n] for r in rows], t) for n, t in zip(own, types, strict=True)), *(batch.column(i).take(take) for i in range(2, batch.num_columns))], names)

            for i in range(batch.num_rows):
                for row in pages(batch.column(1)[i].as_py()):
                    at.append(i)
                    rows.append(row)
                    size += len(row["pixels"] or b"")
                    if size > _BATCH:
                        yield ready()
                        at.clear()
                        rows.clear()
                        size = 0
            if rows:
                yield ready()

    more = "".join(f", `{c}` {kind(c)}" for c in carry)
    return images.select(*(F.col(f"`{c}`") for c in (id_col, image, *carry))).mapInArrow(run, f"`{id_col}` {kind(id_col)}, {PAGE_SCHEMA}{more}")


def payload(text: str | None) -> tuple[int, bytes]:
    """(bytes of the text, the bytes filled up with blanks to a positive multiple of WIDTH)."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return len(raw), raw.ljust(max(WIDTH, -(-len(raw) // WIDTH) * WIDTH), b" ")


def feature(page: dict) -> str:
    """Size, mean sample and variance in hundredths, blanks and line ends: whole numbers only."""
    x = np.frombuffer(page["pixels"], np.uint8)
    count = np.bincount(x, minlength=256).astype(np.int64)
    level = np.arange(256, dtype=np.int64)
    n, s, q = len(x), int((count * level).sum()), int((count * level * level).sum())
    return f"{page['width']}x{page['height']}:mean={100 * s // n}:var={100 * (n * q - s * s) // (n * n)}:blank={int(count[32])}:nl={int(count[10])}"


def stored(raw: bytes) -> bytes:
    """Pages of PAGE_ROWS rows at most; the form of a page follows from what is in it, so equal texts are stored alike."""
    parts = [raw[i : i + WIDTH * PAGE_ROWS] for i in range(0, len(raw), WIDTH * PAGE_ROWS)]
    forms = []
    for part in parts:
        compression, predictor, tiled = FORMS[zlib.crc32(part) % len(FORMS)]
        rows = -(-len(part) // WIDTH)
        forms.append((compression, predictor, (WIDTH // 3, min(TILE_ROWS, -(-rows // 16) * 16)) if tiled else None))
    return encode(parts, forms=forms)


def store_texts(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, media: each whole text as a TIFF of 192 samples a row."""
    small_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            n, media = [], []
            for t in batch.column(1):
                size, raw = payload(t.as_py())
                n.append(size)
                media.append(stored(raw))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_bytes long, media binary")


def _folded(batches):
    """Pages, those of an image in a row -> one row for each image."""
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    now, done = None, []

    def close():
        head, size, sha, tail, media, features = now
        done.append((*head, size, sha.hexdigest(), zlib.crc32(tail), *media, ";".join(features)))

    def ready():
        out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), types, strict=True)], names)
        done.clear()
        return out

    for batch in batches:
        c = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        for i in range(batch.num_rows):
            row = {n: c[n][i].as_py() for n in ("doc_id", "page", "width", "height", "pixels", "error", "n_bytes", "media_bytes", "media_sha256")}
            if row["error"]:
                raise TiffError(row["error"])
            if row["page"] == 0:
                if now:
                    close()
                now = [(row["doc_id"], row["n_bytes"]), 0, hashlib.sha256(), b"", (row["media_bytes"], row["media_sha256"]), []]
            now[1] += len(row["pixels"])
            now[2].update(row["pixels"])
            now[3] = (now[3] + row["pixels"])[-16:]
            now[5].append(feature(row))
        if done:
            yield ready()
    if now:
        close()
        yield ready()


def text_round_trip(docs: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """Stores all texts as images in a table, reads the stored bytes back page by page and describes them."""
    media = (scratch or Scratch(docs.sparkSession)).save(store_texts(docs))
    media = media.select("doc_id", "media", "n_bytes", F.octet_length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"))
    read = read_pages(media, "media", "doc_id", carry=("n_bytes", "media_bytes", "media_sha256"))
    return read.mapInArrow(_folded, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
