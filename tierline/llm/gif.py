"""GIF images as columns: LZW streams, palettes, disposal, transparency and timed frames, with colour histograms.

decode() reads any GIF87a or GIF89a: variable-width LZW codes, global and local palettes, interlaced frames, transparent
indexes, and the four disposal methods; its frames are what a viewer would show, with their delays. encode() writes indexed
frames with real LZW compression. decode_frames applies decode() to a column of images, and store_bytes keeps any bytes as
the samples of an image and reads them back.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import give_back
from tierline.llm.words import blocks

#: Bytes of payload handled at once.
BLOCK = 1 << 20
#: Samples of a stored image's row, rows of a frame at most (an image's sides have 16 bits), and how long a frame shows.
WIDTH, HEIGHT, DELAY_MS = 192, 512, 100
#: Samples of a screen or frame, at most: a damaged image may claim any size, and is refused beyond this one.
LARGEST = 1 << 26
#: Most entries of the code table.
TABLE = 4096


@dataclass
class Frame:
    left: int
    top: int
    delay_ms: int
    disposal: int
    indexes: np.ndarray  # as stored: height x width
    canvas: np.ndarray  # as shown: RGBA of the whole screen


def _widths(count: int, least: int) -> np.ndarray:
    """Bits of the 1st, 2nd, ... code after a clear code: they depend on nothing but the number of codes so far.

    Before its n-th code (from 0) a decoder's table has clear + 2 + max(0, n - 1) entries; codes widen when it is full.
    """
    entries = (1 << least) + 2 + np.maximum(np.arange(count) - 1, 0)
    return np.minimum(np.maximum(np.floor(np.log2(entries)).astype(np.int64) + 1, least + 1), 12)


def lzw_encode(data: bytes, least: int = 8) -> bytes:
    """The LZW code stream of samples below 2 ** least, the first and the last code included.

    The table is a dict from a code and the sample behind it (as code << 8 | sample) to the code of both.
    """
    clear = 1 << least
    codes: list[int] = []
    turns: list[int] = []
    add = codes.append
    rest = iter(data)
    here = next(rest, None)
    while here is not None:  # one turn from clear code to clear code
        begin = len(codes)
        table: dict[int, int] = {}
        free, after = clear + 2, None
        for x in rest:
            key = here << 8 | x
            if key in table:
                here = table[key]
                continue
            add(here)
            if free == TABLE - 1:
                after = x
                break
            table[key] = free
            free += 1
            here = x
        add(here if after is None else clear)
        here = after
        turns.append(len(codes) - begin)
    codes.append(clear + 1)
    turns = [*turns[:-1], turns[-1] + 1] if turns else [1]
    longest = _widths(max(turns), least)
    return _pack(np.array([clear, *codes], np.int64), np.concatenate([[least + 1], *[longest[:n] for n in turns]]))


def _pack(codes: np.ndarray, widths: np.ndarray) -> bytes:
    """Codes as bits, the lowest first."""
    ends = np.cumsum(widths)
    bits = np.zeros(-(-int(ends[-1]) // 8) * 8, np.uint8)
    begins = ends - widths
    for b in range(int(widths.max())):
        has = widths > b
        bits[begins[has] + b] = codes[has] >> b & 1
    return np.packbits(bits, bitorder="little").tobytes()


def lzw_decode(stream: bytes, least: int, size: int) -> bytes:
    """The first size samples of a code stream; a stream that breaks off gives zeros for the rest."""
    clear, stop = 1 << least, (1 << least) + 1
    data = np.concatenate([np.frombuffer(stream, np.uint8), np.zeros(4, np.uint8)]).astype(np.uint32)
    words = data[:-2] | data[1:-1] << 8 | data[2:] << 16
    bits, at, out, got = 8 * len(stream), 0, [], 0
    widths = _widths(TABLE, least)
    ends = np.cumsum(widths)
    while got < size:  # one turn from clear code to clear code; most have no more codes than the table has room for
        room = bits - at
        most = int(np.searchsorted(ends, room, "right")) if room < ends[-1] else TABLE + int(room - ends[-1]) // 12
        for fit in (min(TABLE, most), most):
            own, until = (widths, ends) if fit <= TABLE else (np.r_[widths, np.full(fit - TABLE, 12)], np.r_[ends, ends[-1] + 12 * np.arange(1, fit - TABLE + 1)])
            begins = at + until[:fit] - own[:fit]
            codes = (words[begins >> 3] >> (begins & 7).astype(np.uint32)) & ((1 << own[:fit]) - 1).astype(np.uint32)
            ending = np.flatnonzero((codes == clear) | (codes == stop))
            if len(ending):
                break
        n = int(ending[0]) if len(ending) else fit
        if n:
            out.append(_strings(codes[:n].astype(np.int64), clear))
            got += len(out[-1])
        if not len(ending) or codes[n] == stop:
            break
        at += int(until[n])
    return (b"".join(out) + bytes(max(0, size - got)))[:size]


def _strings(codes: np.ndarray, clear: int) -> bytes:
    """The samples of the codes of one turn, all at once.

    The entry that code i adds is its string and the next sample: the output from its place on, one longer. So a code copies
    from the place of the code that made its entry. Lengths, and then each sample's origin, follow from pointer doubling.
    """
    n = len(codes)
    maker = codes - clear - 2
    literal = codes < clear
    bad = np.flatnonzero(~literal & ((maker < 0) | (maker >= np.arange(n))))
    if len(bad):  # a broken stream: what comes before is whole
        return _strings(codes[: bad[0]], clear) if bad[0] else b""
    itself = np.arange(n)
    parent, length = np.where(literal, itself, maker), np.where(literal, 0, 1)
    while True:
        longer, above = length + length[parent], parent[parent]
        if (above == parent).all():
            break
        length, parent = longer, above
    length = np.where(literal, 1, length + 1)
    place = np.cumsum(length) - length
    total = int(length.sum())
    source = np.arange(total) + np.repeat(np.where(literal, 0, place[np.where(literal, 0, maker)] - place), length)
    while True:
        further = source[source]
        if (further == source).all():
            break
        source = further
    samples = np.zeros(total, np.uint8)
    samples[place[literal]] = codes[literal]
    return samples[source].tobytes()


def _blocks(stream: bytes) -> bytes:
    return b"".join(bytes([len(stream[i : i + 255])]) + stream[i : i + 255] for i in range(0, len(stream), 255)) + b"\0"


def encode(frames: list[tuple[int, int, np.ndarray]], screen: tuple[int, int], palette: np.ndarray, delay_ms: int = 100, disposal: int = 1, transparent: int | None = None) -> bytes:
    """A GIF89a of (left, top, indexes) frames with one palette of 256 RGB colours."""
    out = [b"GIF89a", screen[0].to_bytes(2, "little"), screen[1].to_bytes(2, "little"), b"\xf7\0\0", palette.astype(np.uint8).tobytes()]
    for left, top, indexes in frames:
        flags = disposal << 2 | (transparent is not None)
        out.append(b"\x21\xf9\x04" + bytes([flags]) + (delay_ms // 10).to_bytes(2, "little") + bytes([transparent or 0]) + b"\0")
        out.append(b"\x2c" + b"".join(x.to_bytes(2, "little") for x in (left, top, indexes.shape[1], indexes.shape[0])) + b"\0\x08")
        out.append(_blocks(lzw_encode(indexes.tobytes())))
    return b"".join([*out, b"\x3b"])


def frames_of(image: bytes) -> Iterator[Frame]:
    """The frames of an image, one after the other; ValueError if it is no GIF, or from where it is none any more."""
    if image[:6] not in (b"GIF87a", b"GIF89a") or len(image) < 13:
        raise ValueError("not a GIF")
    two = lambda p: int.from_bytes(image[p : p + 2], "little")
    wide, high, flags = two(6), two(8), image[10]
    if wide * high > LARGEST:
        raise ValueError(f"a screen of {wide} x {high} samples")
    at = 13
    common, at = _palette(image, at, flags)
    canvas = np.zeros((high, wide, 4), np.uint8)
    control = (0, 0, None)
    while at < len(image) and image[at] != 0x3B:
        if image[at] == 0x21:
            label, at = image[at + 1 : at + 2], at + 2
            body, at = _gather(image, at)
            if label == b"\xf9" and len(body) >= 4:
                control = (body[0] >> 2 & 7, int.from_bytes(body[1:3], "little") * 10, body[3] if body[0] & 1 else None)
            continue
        if image[at] != 0x2C or at + 10 >= len(image):
            break
        left, top, w, h, flags = two(at + 1), two(at + 3), two(at + 5), two(at + 7), image[at + 9]
        own, at = _palette(image, at + 10, flags)
        palette = common if own is None else own
        if at >= len(image) or not 1 <= image[at] <= 8 or w * h > LARGEST:
            raise ValueError("a frame without a code size that a GIF may have, or too large")
        least = image[at]
        stream, at = _gather(image, at + 1)
        indexes = np.frombuffer(lzw_decode(stream, least, w * h), np.uint8).reshape(h, w)
        if flags & 0x40:  # interlaced: every 8th row from 0, every 8th from 4, every 4th from 2, every 2nd from 1
            order = np.concatenate([np.arange(a, h, b) for a, b in ((0, 8), (4, 8), (2, 4), (1, 2))])
            straight = np.empty_like(indexes)
            straight[order] = indexes
            indexes = straight
        disposal, delay, clear = control
        before = canvas.copy() if disposal == 3 else None
        room = canvas[top : top + h, left : left + w]
        shown = indexes[: room.shape[0], : room.shape[1]]
        if palette is not None:
            colours = np.full((256, 4), 255, np.uint8)
            colours[: len(palette), :3] = palette
            colours[len(palette) :, :3] = palette[-1]
            flat = colours.view(np.uint32).ravel()[shown].view(np.uint8).reshape(*shown.shape, 4)
            if clear is None:
                room[:] = flat
            else:
                opaque = shown != clear
                room[opaque] = flat[opaque]
        yield Frame(left, top, delay, disposal, indexes, canvas.copy())
        if disposal == 2:
            room[:] = 0
        elif disposal == 3:
            canvas = before
        control = (0, 0, None)


def decode(image: bytes) -> list[Frame]:
    """All frames of an image at once."""
    return list(frames_of(image))


def _palette(image: bytes, at: int, flags: int) -> tuple[np.ndarray | None, int]:
    if not flags & 0x80:
        return None, at
    size = 3 << (flags & 7) + 1
    return np.frombuffer(image[at : at + size].ljust(size, b"\0"), np.uint8).reshape(-1, 3), at + size


def _gather(image: bytes, at: int) -> tuple[bytes, int]:
    parts = []
    while at < len(image) and image[at]:
        parts.append(image[at + 1 : at + 1 + image[at]])
        at += 1 + image[at]
    return b"".join(parts), at + 1


def histogram(rgba: np.ndarray) -> np.ndarray:
    """Opaque samples by the two high bits of red, green and blue: 64 bins."""
    bins = (rgba[..., 0] >> 6 << 4) | (rgba[..., 1] >> 6 << 2) | rgba[..., 2] >> 6
    opaque = rgba[..., 3] > 0
    return np.bincount((bins if opaque.all() else bins[opaque]).ravel(), minlength=64)


def decode_frames(images: DataFrame, key: str, image: str) -> DataFrame:
    """One row a frame: key, frame, delay_ms, at_ms, width, height, rgb binary (as shown), histogram array of 64.

    A null image gives no row; from where an image is no GIF (perhaps its begin), it gives one row whose frame is null; so does a
    screen or frame of more than LARGEST samples, as a damaged image may claim any size. Frames are decoded one at a time. Rows stay where they are: no shuffle. An empty table gives an empty result; other columns are
    not read, whatever their names.
    """
    names = ["frame", "delay_ms", "at_ms", "width", "height", "rgb", "histogram"]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int64())]

    def told(data: bytes) -> Iterator[tuple]:
        at = 0
        try:
            for n, f in enumerate(frames_of(data)):
                yield n, f.delay_ms, at, f.canvas.shape[1], f.canvas.shape[0], f.canvas[:, :, :3].tobytes(), histogram(f.canvas).tolist()
                at += f.delay_ms
        except (ValueError, IndexError):
            yield (None,) * 7

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                data = batch.column(1)[i].as_py()
                for row in told(data) if data is not None else ():
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), *[pa.array([c], t) for c, t in zip(row, kinds, strict=True)]], names=[key, *names])
        give_back()

    kind = images.schema[key].dataType.simpleString()
    return images.select(key, image).mapInArrow(run, f"`{key}` {kind}, frame int, delay_ms long, at_ms long, width int, height int, rgb binary, histogram array<long>")


#: Three high bits of an index are red, the next three green, the last two blue: the indexes spread over all colours.
_SPREAD = np.stack([np.arange(256) & 0xE0, np.arange(256) << 3 & 0xE0, np.arange(256) << 6 & 0xC0], axis=1).astype(np.uint8)


def store(payload: bytes) -> bytes:
    """Bytes, a positive multiple of WIDTH of them, as an image that shows byte i in colour i, HEIGHT rows a frame."""
    rows = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    frames = [(0, 0, rows[i : i + HEIGHT]) for i in range(0, len(rows), HEIGHT)]
    return encode(frames, (WIDTH, min(HEIGHT, len(rows))), _SPREAD, DELAY_MS)


def restore(image: bytes) -> Iterator[tuple[bytes, Frame]]:
    """What store kept, part by part, from the colours that each frame shows; and the frame."""
    for f in frames_of(image):
        own = f.canvas[: f.indexes.shape[0]]
        yield (own[..., 0] | own[..., 1] >> 3 | own[..., 2] >> 6).tobytes(), f


def _read_back(image: bytes) -> tuple[int, str, int, int, int, list[int]]:
    """Bytes, SHA-256 and tail of what an image keeps; its frames, how long they show, and their histogram. A frame at a time."""
    size, whole, tail, frames, shown, bins = 0, hashlib.sha256(), b"", 0, 0, np.zeros(64, np.int64)
    for part, f in restore(image):
        size, tail, frames, shown = size + len(part), (tail + part)[-16:], frames + 1, shown + f.delay_ms
        whole.update(part)
        bins += histogram(f.canvas[: f.indexes.shape[0]])
    return size, whole.hexdigest(), zlib.crc32(tail), frames, shown, bins.tolist()


def store_bytes(df: DataFrame, key: str, payload: str, keep_image: bool = False) -> DataFrame:
    """payload (binary; null: empty) as a GIF, read back: one row each, with key and the columns below, and no shuffle.

    n_bytes; payload_bytes, payload_sha256 and tail_crc32 (last 16 bytes) of the payload as read back from what the frames
    show, which has spaces behind it up to a positive multiple of WIDTH; media_bytes and media_sha256 of the image; frames;
    shown_ms, the time that they show; histogram (64 bins of their colours); and image itself if asked for. Equal payloads give
    equal rows. An empty table gives an empty result; other columns are not read, whatever their names.
    """
    names = [key, "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "frames", "shown_ms", "histogram"] + ["image"] * keep_image
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.list_(pa.int64())] + [pa.binary()] * keep_image

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches, names[0] + "_payload", BLOCK):
            rows = []
            for data in texts:
                image = store(data.ljust(max(1, -(-len(data) // WIDTH)) * WIDTH, b" "))
                size, digest, tail, frames, shown, bins = _read_back(image)
                rows.append((len(data), size, digest, tail, len(image), hashlib.sha256(image).hexdigest(), frames, shown, bins, *([image] * keep_image)))
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]], names=names)

    kind = df.schema[key].dataType.simpleString()
    ddl = f"`{key}` {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, frames int, shown_ms long, histogram array<long>" + ", image binary" * keep_image
    return df.select(F.col(key), F.col(payload).alias(names[0] + "_payload")).mapInArrow(run, ddl)
