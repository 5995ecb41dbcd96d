"""GIF columns: LZW coding and decoding, frames with disposal, transparency and times, colour histograms.

decode_gif() reads any GIF87a or GIF89a: global and local palettes, interlace, sub-blocks, deferred clear codes,
disposal 0 to 3, transparent colours, delays. encode_gif() writes frames of palette indices. payload_gif() keeps
bytes as the pixels of grey frames, 192 wide, losslessly; payload_of() gets them back.

Nulls: a null text is the empty text. An empty text is one row of 192 spaces. Long texts are frames of at most
FRAME_ROWS rows that follow each other in time, each removed after its time, so that a short last frame shows no rows of
the one before. Equal texts give equal bytes, and rows with one doc_id are rows of their own. Damaged files raise
ValueError; in a table they have no frames and say in column error what is wrong, and null media has neither. An empty
table gives no rows. Columns other than doc_id and text, or media, are left out.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices, utf8, written

WIDTH, FRAME_ROWS, BINS = 192, 256, 16
GREY = bytes(v for i in range(256) for v in (i, i, i))
MAX_CODES = 4096


@dataclass
class Frame:
    left: int
    top: int
    width: int
    height: int
    pixels: bytes
    palette: bytes | None = None
    delay: int = 0
    disposal: int = 0
    transparent: int | None = None
    interlaced: bool = False


# ---- LZW ----


@lru_cache
def _widths(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Bits of the codes that follow a clear code while the table fills and once it is full, and their running sum."""
    entries = np.arange((1 << size) + 1, MAX_CODES)
    entries[0] += 1  # the first code after a clear code adds no entry
    widths = np.concatenate([np.floor(np.log2(entries)).astype(np.int64) + 1, np.full(MAX_CODES, 12)])
    return widths, np.concatenate([[0], np.cumsum(widths)])


def lzw_encode(data: bytes, size: int = 8) -> bytes:
    """The code stream of samples below 2 ** size; the table is cleared when it is full."""
    clear, first = 1 << size, (1 << size) + 2
    runs, codes = [], []
    table: dict[int, int] = {}
    get, put, nxt = table.get, codes.append, first
    it = iter(data)
    w = next(it, None)
    if w is not None:
        for c in it:
            k = w << 8 | c
            code = get(k)
            if code is not None:
                w = code
                continue
            put(w)
            table[k] = nxt
            nxt += 1
            w = c
            if nxt == MAX_CODES:
                runs.append(codes)
                table, codes, nxt = {}, [], first
                get, put = table.get, codes.append
        put(w)
    codes.append(clear + 1)
    runs.append(codes)
    all_codes, widths = [np.array([clear])], [np.array([size + 1])]
    for i, codes in enumerate(runs):
        # a full table's clear code follows its codes at the width then reached
        own = np.array(codes + [clear] if i + 1 < len(runs) else codes)
        all_codes.append(own)
        widths.append(_widths(size)[0][: len(own)])
    codes_, widths_ = np.concatenate(all_codes).astype(np.uint16), np.concatenate(widths)
    bits = np.unpackbits(codes_.astype("<u2").view(np.uint8).reshape(-1, 2), axis=1, bitorder="little")
    return np.packbits(bits[np.arange(16) < widths_[:, None]], bitorder="little").tobytes()


def lzw_decode(stream: bytes, size: int, want: int) -> bytes:
    """The first want samples of a code stream; what is missing is an error."""
    clear = 1 << size
    raw = np.frombuffer(stream + b"\0\0\0", np.uint8).astype(np.uint32)
    three = raw[:-2] | raw[1:-1] << 8 | raw[2:] << 16
    widths, sums = _widths(size)
    total, at, got, out = 8 * len(stream), 0, 0, []
    singles = [bytes([i]) for i in range(clear)] + [b"", b""]
    table, prev, since = list(singles), b"", 0  # since: codes read after the last clear code
    put, add = out.append, table.append
    while got < want:
        # without a clear code among them, the places of the next codes are known: read them at once
        n = int(np.searchsorted(sums[since + 1 :], total - at + sums[since], side="right"))
        if n == 0:
            break
        places = at + sums[since : since + n] - sums[since]
        codes = (three[places >> 3] >> (places & 7).astype(np.uint32)) & ((1 << widths[since : since + n]) - 1).astype(np.uint32)
        ends = np.flatnonzero((codes >> 1) == clear >> 1)  # the clear code and the end code
        stop = int(ends[0]) if len(ends) else None
        known = len(table)
        for c in codes[:stop].tolist():
            if c < known:
                entry = table[c]
            elif c == known and prev:
                entry = prev + prev[:1]
            else:
                raise ValueError("a code without an entry")
            if prev and known < MAX_CODES:
                add(prev + entry[:1])
                known += 1
            put(entry)
            prev = entry
        if stop is None:
            got = sum(map(len, out))
            at += int(sums[since + n] - sums[since])
            since = min(since + n, MAX_CODES - 1)  # from there on all codes have 12 bits
        elif int(codes[stop]) == clear:
            at += int(sums[since + stop + 1] - sums[since])
            table, prev, since = list(singles), b"", 0
            add = table.append
        else:
            break
    data = b"".join(out)
    if len(data) < want:
        raise ValueError("the code stream ends early")
    return data[:want]


# ---- files ----


def _blocks(data: bytes) -> bytes:
    return b"".join(bytes([len(data[i : i + 255])]) + data[i : i + 255] for i in range(0, len(data), 255)) + b"\0"


def encode_gif(width: int, height: int, frames: list[Frame], palette: bytes = GREY) -> bytes:
    """A GIF89a of frames with a global palette of 2 to 256 colours."""
    bits = max(1, (len(palette) // 3 - 1).bit_length())
    full = palette + bytes(3 * (1 << bits) - len(palette))
    out = [b"GIF89a", width.to_bytes(2, "little"), height.to_bytes(2, "little"), bytes([0xF0 | bits - 1, 0, 0]), full]
    for f in frames:
        own, local = 0, b""
        if f.palette is not None:
            own = max(1, (len(f.palette) // 3 - 1).bit_length())
            local = f.palette + bytes(3 * (1 << own) - len(f.palette))
        out.append(b"\x21\xf9\x04" + bytes([f.disposal << 2 | (f.transparent is not None)]) + f.delay.to_bytes(2, "little") + bytes([f.transparent or 0, 0]))
        out.append(b"\x2c" + b"".join(v.to_bytes(2, "little") for v in (f.left, f.top, f.width, f.height)) + bytes([(0x80 | own - 1 if own else 0) | 0x40 * f.interlaced]) + local)
        pixels = f.pixels
        if f.interlaced:
            pixels = b"".join(pixels[r * f.width : (r + 1) * f.width] for r in _interlace(f.height))
        size = max(2, own or bits)
        out.append(bytes([size]) + _blocks(lzw_encode(pixels, size)))
    return b"".join(out) + b"\x3b"


def _interlace(rows: int) -> list[int]:
    return [r for start, step in ((0, 8), (4, 8), (2, 4), (1, 2)) for r in range(start, rows, step)]


def parse_gif(data: bytes) -> tuple[int, int, bytes | None, int, list[Frame]]:
    """(width, height, global palette, background index, frames of palette indices)."""
    if data[:6] not in (b"GIF87a", b"GIF89a"):
        raise ValueError("not a GIF")
    try:
        return _parsed(data)
    except IndexError:
        raise ValueError("the file ends early") from None


def _parsed(data: bytes) -> tuple[int, int, bytes | None, int, list[Frame]]:
    width, height, flags, background = int.from_bytes(data[6:8], "little"), int.from_bytes(data[8:10], "little"), data[10], data[11]
    at, palette = 13, None
    if flags & 0x80:
        n = 3 << (flags & 7) + 1
        palette, at = data[at : at + n], at + n

    def sub_blocks(at: int) -> tuple[bytes, int]:
        parts = []
        while data[at]:
            parts.append(data[at + 1 : at + 1 + data[at]])
            at += 1 + data[at]
        return b"".join(parts), at + 1

    frames, control = [], {}
    while data[at] != 0x3B:
        if data[at] == 0x21:
            body, end = sub_blocks(at + 2)
            if data[at + 1] == 0xF9 and len(body) >= 4:
                control = {"disposal": body[0] >> 2 & 7, "delay": int.from_bytes(body[1:3], "little"), "transparent": body[3] if body[0] & 1 else None}
            at = end
        elif data[at] == 0x2C:
            left, top, w, h = (int.from_bytes(data[at + i : at + i + 2], "little") for i in (1, 3, 5, 7))
            flags, at, local = data[at + 9], at + 10, None
            if flags & 0x80:
                n = 3 << (flags & 7) + 1
                local, at = data[at : at + n], at + n
            size = data[at]
            if not 2 <= size <= 8:
                raise ValueError(f"samples of {size} bits")
            body, end = sub_blocks(at + 1)
            pixels = lzw_decode(body, size, w * h)
            if flags & 0x40:
                rows = [b""] * h
                for i, r in enumerate(_interlace(h)):
                    rows[r] = pixels[i * w : (i + 1) * w]
                pixels = b"".join(rows)
            frames.append(Frame(left, top, w, h, pixels, local, interlaced=bool(flags & 0x40), **control))
            control, at = {}, end
        else:
            raise ValueError(f"unknown block {data[at]}")
    return width, height, palette, background, frames


def shown_frames(width: int, height: int, palette: bytes | None, frames: list[Frame]) -> Iterator[tuple[int, int, np.ndarray]]:
    """(start in hundredths, delay, canvas of height x width x 4) of each frame, as it is shown. The canvas is the same
    array each time."""
    canvas, clock = np.zeros((height, width, 4), np.uint8), 0
    for f in frames:
        colours = np.full((256, 4), 255, np.uint8)
        colours[:, :3] = np.frombuffer((f.palette or palette or GREY).ljust(768, b"\0")[:768], np.uint8).reshape(256, 3)
        before = canvas.copy() if f.disposal == 3 else None
        index = np.frombuffer(f.pixels, np.uint8).reshape(f.height, f.width)[: max(0, height - f.top), : max(0, width - f.left)]
        area = canvas[f.top : f.top + index.shape[0], f.left : f.left + index.shape[1]]
        if f.transparent is None:
            area[:] = colours[index]
        else:
            shown = index != f.transparent
            area[shown] = colours[index[shown]]
        yield clock, f.delay, canvas
        clock += f.delay
        if f.disposal == 2:
            area[:] = 0
        elif f.disposal == 3:
            canvas = before


def decode_gif(data: bytes) -> list[tuple[int, int, np.ndarray]]:
    """shown_frames of a file, each with a canvas of its own."""
    width, height, palette, _, frames = parse_gif(data)
    return [(start, delay, canvas.copy()) for start, delay, canvas in shown_frames(width, height, palette, frames)]


# ---- columns ----


def payload_gif(payload: bytes) -> bytes:
    """Bytes, a multiple of WIDTH, as the samples of grey frames that follow each other."""
    step = WIDTH * FRAME_ROWS
    parts = [payload[i : i + step] for i in range(0, len(payload), step)]
    return encode_gif(WIDTH, min(FRAME_ROWS, len(payload) // WIDTH), [Frame(0, 0, WIDTH, len(p) // WIDTH, p, delay=4, disposal=2) for p in parts])


def payload_of(data: bytes) -> bytes:
    return b"".join(f.pixels for f in parse_gif(data)[4])


def colour_histograms(canvas: np.ndarray) -> list[list[int]]:
    """How many of the pixels shown fall in each of BINS levels of red, of green and of blue."""
    seen = canvas[..., 3] > 0
    levels = canvas[..., :3] if seen.all() else canvas[seen]
    return [np.bincount(levels[..., k].reshape(-1) >> 4, minlength=BINS).tolist() for k in range(3)]


def media_table(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, media): each text, padded with spaces to a positive multiple of WIDTH bytes, as a GIF."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts = utf8(b.column(1))
            media = [payload_gif(t.ljust(max(WIDTH, -(-len(t) // WIDTH) * WIDTH))) for t in texts]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(map(len, texts), pa.int64()), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "media"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_bytes long, media binary")


_FRAME = pa.struct([(n, pa.int32()) for n in ("start", "delay", "width", "height")] + [(n, pa.list_(pa.int32())) for n in ("red", "green", "blue")])
_FRAME_SQL = "struct<start:int,delay:int,width:int,height:int,red:array<int>,green:array<int>,blue:array<int>>"


def _frames(parsed: tuple) -> list[dict]:
    """The timed frames of a parsed file as they are shown, with colour histograms."""
    width, height, palette, _, frames = parsed
    out = []
    for start, delay, canvas in shown_frames(width, height, palette, frames):
        red, green, blue = colour_histograms(canvas)
        out.append({"start": start, "delay": delay, "width": width, "height": height, "red": red, "green": green, "blue": blue})
    return out


def media_features(media: DataFrame) -> DataFrame:
    """Decodes stored payload GIFs: the payload's size and checksums, and the timed frames with colour histograms."""
    schema = f"doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, frames array<{_FRAME_SQL}>"
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "frames"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.list_(_FRAME)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            rows = []
            for d, n, raw in zip(*(c.to_pylist() for c in b.columns), strict=True):
                parsed = parse_gif(raw)
                payload = b"".join(f.pixels for f in parsed[4])
                rows.append((d, n, len(payload), sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(raw), sha256(raw).hexdigest(), _frames(parsed)))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)

    return media.select("doc_id", "n_bytes", "media").mapInArrow(run, schema)


def feature_of(frames) -> Column:
    """A string of the frames: their number, the whole time, and the levels of red, green and blue summed over them."""
    f = F.col(frames)
    total = lambda c: F.aggregate(f[c], F.array_repeat(F.lit(0).cast("long"), BINS), lambda a, x: F.zip_with(a, x, lambda p, q: p + q))
    levels = [F.array_join(total(c), ",") for c in ("red", "green", "blue")]
    return F.concat_ws(";", F.size(f).cast("string"), F.aggregate(f["delay"], F.lit(0).cast("long"), lambda a, x: a + x).cast("string"), *levels)


def media_frames(media: DataFrame) -> DataFrame:
    """Any GIFs (doc_id, media) as timed frames: start and delay in hundredths, size, and histograms of BINS levels of
    red, green and blue over the pixels shown. A damaged file is one row with the reason in error."""
    schema = "doc_id long, frame int, start int, delay int, width int, height int, red array<int>, green array<int>, blue array<int>, error string"
    numbers, levels = ["start", "delay", "width", "height"], ["red", "green", "blue"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 16):
            out: list[tuple] = []
            for d, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                try:
                    out += [(d, i, *(f[c] for c in numbers + levels), None) for i, f in enumerate(_frames(parse_gif(raw)) if raw is not None else ())]
                except ValueError as e:
                    out.append((d, *[None] * 8, str(e)))
            types = [pa.int64(), *[pa.int32()] * 5, *[pa.list_(pa.int32())] * 3, pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(types)], names=["doc_id", "frame", *numbers, *levels, "error"])

    return media.select(F.col("doc_id").cast("long"), "media").mapInArrow(run, schema)


def stored_media(docs: DataFrame) -> DataFrame:
    """Stores the media column in a table of the shared folder and computes features and frames from what is read back."""
    return media_features(written(media_table(docs), "media"))
