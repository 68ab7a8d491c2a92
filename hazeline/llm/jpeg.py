"""Media columns: texts kept as baseline JPEG, and DC-only luminance thumbnails read from them.

``encode`` writes a payload as a greyscale baseline JPEG in which every 8x8 block is
flat: with a DC quantiser of 8 the DC coefficient is the sample less 128, so the
stored samples come back without loss from this reader and from any other that keeps
to the standard. ``decode`` reads baseline JPEG in general: markers, quantiser and
Huffman tables, restart intervals, one to four components with subsampling. It
Huffman-decodes all coefficients of a scan but keeps the DC of component one, whose
blocks make the thumbnail. Segments between restart markers are decoded in step with
each other, one numpy operation for all of them.

Null texts count as empty (64 zero bytes). Repeated rows, null ids and extra columns
have no influence. Payloads beyond one image go into several images, one after another, so
texts may have any length. An empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import session_limits, slices, table

UNIT = 64  #: payloads are filled up to a multiple of this
MOST_BLOCKS = 8191  #: 8x8 blocks a side of a JPEG

# Code lengths of the DC categories 0..11, short for the differences that text has; a full tree less its last code.
_DC_SYMBOLS = [4, 5, 3, 6, 2, 7, 1, 0, 8, 9, 10, 11]
_DC_LENGTHS = [0, 2, 3, 1, 1, 1, 1, 1, 2, 0, 0, 0, 0, 0, 0, 0]
_AC_SYMBOLS = [0x00, 0xF0]
_AC_LENGTHS = [1, 1] + [0] * 14


def _codes(lengths: list[int], symbols: list[int]) -> list[tuple[int, int, int]]:
    """(symbol, code, length) of a Huffman table in its canonical form."""
    out, code, k = [], 0, 0
    for bits, n in enumerate(lengths, 1):
        for _ in range(n):
            out.append((symbols[k], code, bits))
            code += 1
            k += 1
        code <<= 1
    return out


def _lookup(lengths: list[int], symbols: list[int]) -> np.ndarray:
    """For every 16 bits that may follow: code length << 8 | symbol; 0 where no code fits."""
    t = np.zeros(1 << 16, dtype=np.uint16)
    for symbol, code, bits in _codes(lengths, symbols):
        t[code << (16 - bits) : (code + 1) << (16 - bits)] = bits << 8 | symbol
    return t


_CODE = np.zeros(12, dtype=np.uint32)
_BITS = np.zeros(12, dtype=np.int64)
for _s, _c, _n in _codes(_DC_LENGTHS, _DC_SYMBOLS):
    _CODE[_s], _BITS[_s] = _c, _n
_CATEGORY = np.array([int(x).bit_length() for x in range(512)], dtype=np.int64)


def _segment(marker: int, body: bytes) -> bytes:
    return bytes((0xFF, marker)) + (len(body) + 2).to_bytes(2, "big") + body


def _header(wide: int, high: int) -> bytes:
    return b"".join(
        (
            b"\xff\xd8",
            _segment(0xDB, bytes([0, 8]) + bytes([1] * 63)),
            _segment(0xC0, bytes([8]) + (8 * high).to_bytes(2, "big") + (8 * wide).to_bytes(2, "big") + bytes([1, 1, 0x11, 0])),
            _segment(0xC4, bytes([0x00, *_DC_LENGTHS, *_DC_SYMBOLS])),
            _segment(0xC4, bytes([0x10, *_AC_LENGTHS, *_AC_SYMBOLS])),
            _segment(0xDD, wide.to_bytes(2, "big")),
            _segment(0xDA, bytes([1, 1, 0x00, 0, 63, 0])),
        )
    )


def _shapes(n: int) -> list[tuple[int, int]]:
    """Blocks (wide, high) of the images that hold ``n`` bytes, a multiple of 64."""
    rows, wide, left = [], UNIT, n
    while n > wide * MOST_BLOCKS and wide * 2 <= MOST_BLOCKS:
        wide *= 2
    while left:
        w = wide if left >= wide else UNIT
        high = min(left // w, MOST_BLOCKS)
        rows.append((w, high))
        left -= w * high
    return rows


def _rows_coded(samples: np.ndarray, wide: int) -> tuple[np.ndarray, np.ndarray]:
    """Entropy-coded bytes, unstuffed, of rows of ``wide`` flat blocks, and each row's bytes."""
    grid = samples.reshape(-1, wide).astype(np.int32) - 128
    diff = grid.copy()
    diff[:, 1:] -= grid[:, :-1]
    cat = _CATEGORY[np.abs(diff)]
    extra = np.where(diff < 0, diff + (1 << cat) - 1, diff).astype(np.uint32)
    # DC code, its extra bits, and the one-bit end of block, 0
    value = ((_CODE[cat] << cat.astype(np.uint32)) | extra) << np.uint32(1)
    bits = _BITS[cat] + cat + 1
    ends = np.cumsum(bits, axis=1)
    n_bytes = (ends[:, -1] + 7) >> 3
    first = np.concatenate(([0], np.cumsum(n_bytes)[:-1]))
    at = (ends - bits) + (first * 8)[:, None]
    word = (value.astype(np.uint64) << (32 - bits - (at & 7)).astype(np.uint64)).ravel()
    where, total = (at >> 3).ravel(), int(n_bytes.sum())
    out = np.zeros(total + 4)
    for k in range(4):
        out += np.bincount(where + k, weights=((word >> np.uint64(24 - 8 * k)) & np.uint64(255)).astype(np.float64), minlength=total + 4)[: total + 4]
    out = out[:total].astype(np.uint8)
    out[first + n_bytes - 1] |= ((1 << (n_bytes * 8 - ends[:, -1])) - 1).astype(np.uint8)
    return out, n_bytes


def encode(payloads: list[bytes]) -> list[bytes]:
    """The JPEG form of each payload (lengths: positive multiples of 64)."""
    shapes = [_shapes(len(p)) for p in payloads]
    coded: dict[int, list] = {}
    places: list[list[tuple[int, int, int]]] = []
    for p, own in zip(payloads, shapes):
        at, spots = 0, []
        for w, h in own:
            group = coded.setdefault(w, [[], 0])
            group[0].append(p[at : at + w * h])
            spots.append((w, h, group[1]))
            group[1] += h
            at += w * h
        places.append(spots)
    done = {}
    for w, (parts, _) in coded.items():
        raw, n_bytes = _rows_coded(np.frombuffer(b"".join(parts), dtype=np.uint8), w)
        # a zero behind every 0xFF, and room for a restart marker behind every row
        full = raw == 0xFF
        row = np.repeat(np.arange(len(n_bytes)), n_bytes)
        to = np.arange(len(raw)) + np.cumsum(full) - full + 2 * row
        ends = np.cumsum(n_bytes) + np.cumsum(full)[np.cumsum(n_bytes) - 1] + 2 * np.arange(len(n_bytes))
        out = np.zeros(int(ends[-1]) + 2, dtype=np.uint8)
        out[to] = raw
        done[w] = out, np.concatenate(([0], ends + 2))
    media = []
    for spots in places:
        images = []
        for w, h, row in spots:
            out, starts = done[w]
            body = out[starts[row] : starts[row + h]].copy()
            marks = starts[row + 1 : row + h + 1] - starts[row] - 2
            body[marks] = 0xFF
            body[marks + 1] = 0xD0 + np.arange(h) % 8
            body[-1] = 0xD9  # the last row ends the image instead
            images.append(_header(w, h) + body.tobytes())
        media.append(b"".join(images))
    return media


class Bad(ValueError):
    """Bytes that are no baseline JPEG."""


class Image:
    """The parsed markers of one baseline image, and where its scan lies."""

    def __init__(self, data: bytes, start: int = 0):
        if data[start : start + 2] != b"\xff\xd8":
            raise Bad("no start of image")
        self.quant: dict[int, int] = {}
        self.huff: dict[int, tuple[bytes, np.ndarray | None]] = {}
        self.restart, at = 0, start + 2
        while True:
            while data[at : at + 2] == b"\xff\xff":
                at += 1
            if at + 4 > len(data) or data[at] != 0xFF:
                raise Bad("broken marker")
            marker, size = data[at + 1], int.from_bytes(data[at + 2 : at + 4], "big")
            body = data[at + 4 : at + 2 + size]
            at += 2 + size
            if marker == 0xDB:
                while body:
                    wide = body[0] >> 4
                    self.quant[body[0] & 15] = int.from_bytes(body[1 : 2 + wide], "big")
                    body = body[1 + 64 * (1 + wide) :]
            elif marker == 0xC0 or marker == 0xC1:
                if body[0] != 8:
                    raise Bad("not 8 bits")
                self.height, self.width = int.from_bytes(body[1:3], "big"), int.from_bytes(body[3:5], "big")
                self.parts = [(body[6 + 3 * i], body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(body[5])]
            elif marker in (0xC2, 0xC3, *range(0xC5, 0xC8), *range(0xC9, 0xD0)):
                raise Bad("not baseline")
            elif marker == 0xC4:
                while body:
                    n = sum(body[1:17])
                    self.huff[body[0]] = body[1 : 17 + n]
                    body = body[17 + n :]
            elif marker == 0xDD:
                self.restart = int.from_bytes(body[:2], "big")
            elif marker == 0xDA:
                self.scan = {body[1 + 2 * i]: body[2 + 2 * i] for i in range(body[0])}
                break
        if not hasattr(self, "parts") or any(p[0] not in self.scan for p in self.parts):
            raise Bad("not one scan of all components")
        self.data_at = at
        single = len(self.parts) == 1
        most_h, most_v = (1, 1) if single else (max(p[1] for p in self.parts), max(p[2] for p in self.parts))
        self.mcus = -(-self.width // (8 * most_h)), -(-self.height // (8 * most_v))
        #: of each MCU in turn: (component, DC table, AC table) of every block
        self.layout = [(i, self.huff[self.scan[p[0]] >> 4], self.huff[0x10 | self.scan[p[0]] & 15]) for i, p in enumerate(self.parts) for _ in range(1 if single else p[1] * p[2])]
        self.sub = (1, 1) if single else self.parts[0][1:3]

    def key(self) -> tuple:
        return tuple(self.layout), self.restart


_TABLES: dict[bytes, np.ndarray] = {}


def _table(raw: bytes) -> np.ndarray:
    if raw not in _TABLES:
        if len(_TABLES) > 64:
            _TABLES.clear()
        _TABLES[raw] = _lookup(list(raw[:16]), list(raw[16:]))
    return _TABLES[raw]


def _scan_end(data: np.ndarray, marks: np.ndarray, at: int) -> int:
    """Where the scan that begins at ``at`` ends: at the first marker but restarts and stuffing."""
    i = np.searchsorted(marks, at)
    return int(marks[i]) if i < len(marks) else len(data)


def _segments(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The scan without stuffing and markers, padded, and the bit at which each segment starts."""
    full = np.flatnonzero(data[:-1] == 0xFF)
    after = data[full + 1]
    marks = full[(after >= 0xD0) & (after <= 0xD7)]
    drop = np.zeros(len(data), dtype=bool)
    drop[full[after == 0] + 1] = True
    drop[marks] = drop[marks + 1] = True
    starts = np.concatenate(([0], marks + 2))
    starts = starts - np.concatenate(([0], np.cumsum(drop)))[starts]
    return data[~drop], starts * 8


def _lockstep(buf: np.ndarray, pos: np.ndarray, n_mcus: np.ndarray, layout: tuple) -> list[np.ndarray]:
    """DC values of component 0, one array a block of it in step order: [step][segment], undecoded ones 0."""
    buf = np.concatenate((buf, np.full(16, 0xFF, dtype=np.uint8)))
    wide = np.zeros(len(buf) - 7, dtype=np.uint64)
    for k in range(8):
        wide = (wide << np.uint64(8)) | buf[k : len(buf) - 7 + k]
    pos = pos.astype(np.int64).copy()
    order = np.argsort(-n_mcus, kind="stable")
    pos, left = pos[order], n_mcus[order]
    pred = {i: np.zeros(len(pos), dtype=np.int64) for i, _, _ in layout}
    found, last = [], len(wide) - 1
    u = np.uint64
    for step in range(int(left[0]) if len(left) else 0):
        n = int(np.searchsorted(-left, -step, side="left"))  # segments that still have an MCU
        for part, dc, ac in layout:
            dc_table, ac_table = _table(dc), _table(ac)
            p = pos[:n]
            w = wide[np.minimum(p >> 3, last)] << (p & 7).astype(u)
            code = dc_table[(w >> u(48)).astype(np.int64)]
            bits, cat = (code >> 8).astype(np.int64), (code & 255).astype(np.int64)
            if not bits.all():
                raise Bad("no such code")
            rest = w << bits.astype(u)
            value = np.where(cat > 0, (rest >> u(1)) >> (63 - cat).astype(u), u(0)).astype(np.int64)
            value = np.where((value >> np.maximum(cat - 1, 0)) == 0, value - (1 << cat) + 1, value)
            pred[part][:n] += value
            used = bits + cat
            # the first AC symbol lies in the same 57 bits; blocks that go on read further windows
            code = ac_table[((w << used.astype(u)) >> u(48)).astype(np.int64)]
            p = p + used
            if not code.all():
                raise Bad("no such code")
            k = np.ones(n, dtype=np.int64)
            live = None
            while True:
                bits, rs = (code >> 8).astype(np.int64), (code & 255).astype(np.int64)
                size = rs & 15
                if live is None:
                    p = p + bits + size
                    k += np.where(rs == 0, 64, (rs >> 4) + 1)
                    live = np.flatnonzero(k < 64)
                else:
                    p[live] += bits + size
                    k[live] += np.where(rs == 0, 64, (rs >> 4) + 1)
                    live = live[k[live] < 64]
                if not len(live):
                    break
                q = p[live]
                code = ac_table[((wide[np.minimum(q >> 3, last)] << (q & 7).astype(u)) >> u(48)).astype(np.int64)]
                if not code.all():
                    raise Bad("no such code")
            pos[:n] = p
            if part == 0:
                out = np.zeros(len(pos), dtype=np.int64)
                out[order] = np.where(np.arange(len(pos)) < n, pred[0], 0)
                found.append(out)
    return found


def decode(media: list[bytes]) -> list[list[tuple[int, int, np.ndarray]] | None]:
    """(width, height, DC-only luminance thumbnail) of each image in each value; None where no baseline JPEG is read."""
    images: list[tuple[int, Image, int, int, int]] = []
    result: list[list | None] = [[] for _ in media]
    groups: dict[tuple, list[int]] = {}
    raws = [np.frombuffer(m or b"", dtype=np.uint8) for m in media]
    for m, data in enumerate(media):
        raw = raws[m]
        if len(raw) < 4:
            result[m] = None
            continue
        full = np.flatnonzero(raw[:-1] == 0xFF)
        after = raw[full + 1]
        ends = full[(after != 0) & (after != 0xFF) & ((after < 0xD0) | (after > 0xD7))]
        at = 0
        try:
            while at < len(data):
                image = Image(data, at)
                end = _scan_end(raw, ends, image.data_at)
                groups.setdefault(image.key(), []).append(len(images))
                images.append((m, image, image.data_at, end, len(result[m])))
                result[m].append(None)
                while raw[end : end + 2].tobytes() not in (b"\xff\xd9", b""):
                    end += 1
                at = end + 2
        except (Bad, KeyError, IndexError):
            result[m] = None
    for (layout, restart), members in groups.items():
        members = [i for i in members if result[images[i][0]] is not None]
        bufs, starts, counts, spans, base = [], [], [], [], 0
        for i in members:
            m, image, a, b, _ = images[i]
            buf, begin = _segments(raws[m][a:b])
            total = image.mcus[0] * image.mcus[1]
            per = restart or total
            n = -(-total // per)
            if len(begin) < n:
                result[m] = None
                continue
            bufs.append(buf)
            starts.append(begin[:n] + base * 8)
            counts.append(np.minimum(per, total - per * np.arange(n)))
            spans.append((i, sum(map(len, starts[:-1])) if not spans else spans[-1][1] + spans[-1][2], n))
            base += len(buf)
        if not bufs:
            continue
        try:
            steps = _lockstep(np.concatenate(bufs), np.concatenate(starts), np.concatenate(counts), layout)
        except Bad:
            if len(spans) == 1:
                result[images[spans[0][0]][0]] = None
            else:  # one bad image must not take the others with it
                for i, _, _ in spans:
                    one = decode([media[images[i][0]]])[0]
                    result[images[i][0]] = one
            continue
        grid = np.stack(steps, axis=1)  # segment, step of component 0
        for i, first, n in spans:
            m, image, _, _, slot = images[i]
            if result[m] is None:
                continue
            h, v = image.sub
            total = image.mcus[0] * image.mcus[1]
            per = restart or total
            dc = grid[first : first + n, : per * h * v].reshape(-1)[: total * h * v]
            dc = dc.reshape(image.mcus[1], image.mcus[0], v, h).transpose(0, 2, 1, 3).reshape(image.mcus[1] * v, image.mcus[0] * h)
            dc = dc[: -(-image.height // 8), : -(-image.width // 8)] * image.quant[image.parts[0][3]]
            result[m][slot] = (image.width, image.height, np.clip((dc + 4 >> 3) + 128, 0, 255).astype(np.uint8))
    return result


def average_hash(thumb: np.ndarray, side: int = 8) -> str:
    """64 bits: which cells of an 8x8 grid of means over the thumbnail are above their mean."""
    ys = np.linspace(0, thumb.shape[0], side + 1).astype(int)
    xs = np.linspace(0, thumb.shape[1], side + 1).astype(int)
    total = np.zeros((thumb.shape[0] + 1, thumb.shape[1] + 1), dtype=np.int64)
    total[1:, 1:] = thumb.astype(np.int64).cumsum(0).cumsum(1)
    ends_y, ends_x = np.maximum(ys[1:], ys[:-1] + 1).clip(max=thumb.shape[0]), np.maximum(xs[1:], xs[:-1] + 1).clip(max=thumb.shape[1])
    ys, xs = np.minimum(ys[:-1], ends_y - 1), np.minimum(xs[:-1], ends_x - 1)
    cells = total[np.ix_(ends_y, ends_x)] - total[np.ix_(ys, ends_x)] - total[np.ix_(ends_y, xs)] + total[np.ix_(ys, xs)]
    means = cells / ((ends_y - ys)[:, None] * (ends_x - xs)[None, :])
    return f"{int.from_bytes(np.packbits(means > means.mean()).tobytes(), 'big'):016x}"


def describe(images: list[tuple[int, int, np.ndarray]]) -> str:
    """Dimensions, average hash and exact hash of every thumbnail."""
    return ";".join(f"{w}x{h}:{average_hash(t)}:{xxhash.xxh64_hexdigest(t.tobytes())}" for w, h, t in images)


def payload_of(text: str | None) -> tuple[int, bytes]:
    raw = text.encode("utf-8", "surrogatepass") if text else b""
    return len(raw), raw + bytes(max(UNIT, -(-len(raw) // UNIT) * UNIT) - len(raw))


def stored(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes and media, the JPEG form of the text, of every document."""
    session_limits(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 4 << 20):
            rows = [payload_of(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array([r[0] for r in rows], pa.int64()), pa.array(encode([r[1] for r in rows]), pa.binary())], names=["doc_id", "n_bytes", "media"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_bytes long, media binary")


def thumbnails(df: DataFrame, column: str = "media") -> DataFrame:
    """``df`` with width, height, thumbnail (bytes, row by row) and feature of the JPEG in ``column``.

    Width and height are the first image's; the thumbnails of several images follow
    each other. All four are null where the value is no baseline JPEG. Columns of ``df``
    that have one of the four names give way.
    """
    session_limits(df.sparkSession)
    df = df.drop(*(c for c in df.columns if c.lower() in ("width", "height", "thumbnail", "feature")))
    keep = df.columns
    added = {"width": "int", "height": "int", "thumbnail": "binary", "feature": "string"}
    schema = df.withColumns({c: F.lit(None).cast(k) for c, k in added.items()}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, column, 6 << 20):
            found = decode(batch.column(column).to_pylist())
            cols = [pa.array([f and f[0][k] for f in found], pa.int32()) for k in (0, 1)]
            cols.append(pa.array([f and b"".join(t.tobytes() for _, _, t in f) for f in found], pa.binary()))
            cols.append(pa.array([f and describe(f) for f in found], pa.string()))
            yield pa.RecordBatch.from_arrays([*batch.columns, *cols], names=[*keep, *added])

    return df.mapInArrow(run, schema)


def op10_media(spark, sf_dir: str) -> DataFrame:
    """Write, read back and describe in one pass, so that no media bytes leave the worker."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    session_limits(spark)
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 4 << 20):
            own = [payload_of(t) for t in batch.column("text").to_pylist()]
            media = encode([p for _, p in own])
            rows = []
            for doc_id, (n, _), m, images in zip(batch.column("doc_id").to_pylist(), own, media, decode(media)):
                back = b"".join(t.tobytes() for _, _, t in images)
                rows.append((doc_id, n, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-64:]), len(m), hashlib.sha256(m).hexdigest(), describe(images)))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names) if rows else pa.RecordBatch.from_arrays([pa.array([], k) for k in kinds], names=names)

    return docs.mapInArrow(run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
