"""Media columns as progressive JPEG, with coefficients as the unit of storage.

A payload is stored losslessly in quantised DCT coefficients, the unit of the
format: byte b is the coefficient whose category is 8 and whose magnitude bits
are b (128..255 for b >= 128, else b - 255). 64 bytes fill a block in zigzag
order; six blocks are an MCU of a 4:2:0 image (four of Y, one of Cb, one of
Cr). Scans: DC by successive approximation (two interleaved scans); AC by
spectral selection, two bands of Y and one of each chroma part, each by
successive approximation (two scans). Every MCU or block is a restart interval.

Decoding is general for such scans: segments are parsed, the Huffman tables
are read from the file, and runs, zero runs, end-of-band runs and correction
bits are honoured. All restart intervals of all images of a batch are decoded
abreast, one symbol of each at a time, in numpy. Scans accumulate into
coefficient arrays; these are dequantised, inverse-transformed, chroma is
upsampled, and the image becomes an RGB tensor of full resolution.

Edge cases: a null text counts as empty; its payload is 64 zero bytes; blocks
that fill up the last MCU repeat byte 0. Equal payloads give equal files, so repeated
rows give equal rows; an empty table gives none. A payload of more than 6 GB, the most
that the format's sides hold, raises ValueError, and so does a
file that isn't a progressive 4:2:0 JPEG.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import id_text, slices, texts_as_bytes, trimmed

UNIT, PER_MCU, WIDE, MOST = 64, 6, 32, 4095  # bytes a block, blocks an MCU, MCUs a row, and most of them in a row or column
#: Spectral bands of the AC scans of Y, Cb and Cr.
BANDS = (((1, 5), (6, 63)), ((1, 63),), ((1, 63),))
PARTS = ((1, 2, 2), (2, 1, 1), (3, 1, 1))  # component, horizontal and vertical sampling
SAMPLES = 1 << 20  # payload bytes decoded abreast


def zigzag() -> np.ndarray:
    """Natural index of each zigzag position: diagonals, walked up and down by turns."""
    cells = sorted(((x, y) for x in range(8) for y in range(8)), key=lambda c: (sum(c), c[1] if sum(c) % 2 == 0 else c[0]))
    return np.array([8 * y + x for x, y in ((x, y) for x, y in ((a, b) for a, b in cells))])


ZIGZAG = zigzag()
#: Huffman codes in use, by table class: for DC, category 7; for AC, (run 0, category 7), end of band, zero run of 16. Every code length list is one that the format allows.
DC_SYMBOLS, AC_SYMBOLS = (7, 8, *range(7), 9, 10, 11), (0x07, 0x00, 0x08, 0xF0, *range(1, 7))


def table_lengths(n: int) -> list[int]:
    """n codes of growing length, one of each length and the rest of the last; no code is all ones."""
    counts = [0] * 16
    for k in range(n):
        counts[min(k, 10)] += 1
    return counts


def codes(counts: list[int], symbols: tuple[int, ...]) -> dict[int, tuple[int, int]]:
    """Symbol -> (code, length), canonical."""
    out, code, k = {}, 0, 0
    for bits, n in enumerate(counts, 1):
        for _ in range(n):
            out[symbols[k]] = (code, bits)
            code, k = code + 1, k + 1
        code <<= 1
    return out


def lookup(counts: list[int], symbols: list[int]) -> np.ndarray:
    """For each 16 bits ahead: symbol << 8 | code length; 0 where no code fits."""
    out = np.zeros(1 << 16, np.int32)
    for s, (code, bits) in codes(counts, tuple(symbols)).items():
        out[code << (16 - bits) : (code + 1) << (16 - bits)] = s << 8 | bits
    return out


def to_coefficients(payload: np.ndarray) -> np.ndarray:
    v = payload.astype(np.int16)
    return np.where(v >= 128, v, v - 255)


def to_payload(coefficients: np.ndarray) -> np.ndarray:
    return np.where(coefficients > 0, coefficients, coefficients + 255).astype(np.uint8)


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def _bits(values: np.ndarray, n: int) -> np.ndarray:
    return (values[..., None] >> np.arange(n - 1, -1, -1, dtype=values.dtype) & 1).astype(np.uint8)


def _stuffed(data: np.ndarray, used: np.ndarray | None, place: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """Entropy-coded bytes of one scan of each image.

    data: [interval, byte], of which ``used`` count; place: the interval's number in its image; ends: intervals up to
    the end of each image. Bytes 0xFF are stuffed, and a restart marker stands between the intervals.
    """
    n, width = data.shape
    rows = np.empty((n, width + 2), np.uint8)
    rows[:, :width], rows[:, width], rows[:, width + 1] = data, 0xFF, 0xD0 + place % 8
    full = rows == 0xFF
    full[:, width:] = False
    if used is not None:
        keep = np.ones(rows.shape, bool)
        keep[:, :width] = np.arange(width) < used[:, None]
        full &= keep
        lengths, flat, full_flat = keep.sum(axis=1) + full.sum(axis=1), rows[keep], full[keep]
    else:
        lengths, flat, full_flat = width + 2 + full.sum(axis=1), rows.ravel(), full.ravel()
    raw = np.insert(flat, np.flatnonzero(full_flat) + 1, 0).tobytes()
    stops = np.cumsum(lengths)[ends - 1].tolist()
    return [raw[x : y - 2] for x, y in zip([0, *stops], stops, strict=False)]


def _header(components: list[int], first: int, last: int, high: int, low: int) -> bytes:
    return _segment(0xDA, bytes([len(components), *(x for c in components for x in (c, 0)), first, last, high << 4 | low]))


@lru_cache(maxsize=4096)
def _plane_order(wide: int, high: int) -> tuple[np.ndarray, ...]:
    """For each component, the numbers of its blocks in MCU order, row by row of the plane."""
    number = np.arange(wide * high * PER_MCU).reshape(high, wide, PER_MCU)
    return number[:, :, :4].reshape(high, wide, 2, 2).transpose(0, 2, 1, 3).ravel(), number[:, :, 4].ravel(), number[:, :, 5].ravel()


def shape(blocks: int) -> tuple[int, int]:
    """MCUs in a row, and rows, of an image that holds so many blocks."""
    mcus = -(-blocks // PER_MCU)
    wide = min(mcus, max(WIDE, -(-mcus // MOST)))
    if wide > MOST:
        raise ValueError("a payload of more than 6 GB")
    return wide, -(-mcus // wide)


def encode(payloads: list[bytes]) -> list[bytes]:
    """For each payload (a positive multiple of 64 bytes) a progressive JPEG whose coefficients it is."""
    if any(not p or len(p) % UNIT for p in payloads):
        raise ValueError("a payload is a positive multiple of 64 bytes")
    if not payloads:
        return []
    shapes = [shape(len(p) // UNIT) for p in payloads]
    sizes = [w * h * PER_MCU for w, h in shapes]
    starts = np.cumsum([0, *sizes])
    whole = np.zeros((starts[-1], UNIT), np.uint8)
    for p, o in zip(payloads, starts.tolist(), strict=False):
        whole[o : o + len(p) // UNIT] = np.frombuffer(p, np.uint8).reshape(-1, UNIT)
    orders = [_plane_order(*s) for s in shapes]
    planes, places, ends = [], [], []
    for c in range(3):
        planes.append(whole[np.concatenate([o[c] + s for o, s in zip(orders, starts.tolist(), strict=False)])])
        n = np.array([len(o[c]) for o in orders])
        ends.append(np.cumsum(n))
        places.append(np.arange(n.sum()) - np.repeat(ends[c] - n, n))
    dc, ac = codes(table_lengths(len(DC_SYMBOLS)), DC_SYMBOLS), codes(table_lengths(len(AC_SYMBOLS)), AC_SYMBOLS)
    head = b"".join(_segment(0xC4, bytes([kind << 4, *table_lengths(len(s)), *s])) for kind, s in ((0, DC_SYMBOLS), (1, AC_SYMBOLS))) + _segment(0xDD, struct.pack(">H", 1))
    out = []
    for p, (w, h) in zip(payloads, shapes, strict=True):
        frame = struct.pack(">BHHB", 8, h * 16, w * 16, 3) + b"".join(bytes([c, x << 4 | y, 0]) for c, x, y in PARTS)
        out.append([b"\xff\xd8", _segment(0xFE, struct.pack(">Q", len(p))), _segment(0xDB, b"\x00" + b"\x01" * 64), _segment(0xC2, frame), head])

    def add(header: bytes, scans: list[bytes]) -> None:
        for o, x in zip(out, scans, strict=True):
            o += [header, x]

    value = to_coefficients(whole[:, 0]).astype(np.int64).reshape(-1, PER_MCU)
    add(_header([1, 2, 3], 0, 0, 0, 1), _stuffed(*_dc_codes(value >> 1, dc), places[1], ends[1]))
    add(_header([1, 2, 3], 0, 0, 1, 0), _stuffed(np.packbits(np.concatenate([value & 1, np.ones((len(value), 2), int)], axis=1).astype(np.uint8), axis=1), None, places[1], ends[1]))
    (first_code, first_n), (end_code, end_n) = ac[0x07], ac[0x00]
    for c, bands in enumerate(BANDS):
        for a, b in bands:
            byte = planes[c][:, a : b + 1]
            half = np.where(byte >= 128, byte >> 1, 127 - ((255 - byte) >> 1)).astype(np.uint16)
            bits = _bits(half | np.uint16(first_code << 7), first_n + 7).reshape(len(byte), -1)
            add(_header([c + 1], a, b, 0, 1), _stuffed(_filled(bits), None, places[c], ends[c]))
            low = np.where(byte >= 128, byte, 255 - byte) & 1
            head_bits = np.broadcast_to(_bits(np.array(end_code), end_n), (len(byte), end_n))
            add(_header([c + 1], a, b, 1, 0), _stuffed(_filled(np.concatenate([head_bits, low], axis=1)), None, places[c], ends[c]))
    return [b"".join(o) + b"\xff\xd9" for o in out]


def _filled(bits: np.ndarray) -> np.ndarray:
    """Packed into bytes, the last one filled up with ones."""
    n, width = bits.shape
    return np.packbits(np.concatenate([bits, np.ones((n, -width % 8), np.uint8)], axis=1), axis=1)


def _dc_codes(value: np.ndarray, dc: dict[int, tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """First DC scan: each MCU is an interval; Y blocks differ from the one before, the rest from 0. Bytes, and how many count."""
    d = value.copy()
    d[:, 1:4] -= value[:, :3]
    size = np.zeros(d.shape, np.int64)
    for b in range(9):
        size += np.abs(d) >= 1 << b
    code, bits = np.zeros(12, np.int64), np.zeros(12, np.int64)
    for s, (c, n) in dc.items():
        code[s], bits[s] = c, n
    low = np.where(d >= 0, d, d + (1 << size) - 1)
    word, n = code[size] << size | low, bits[size] + size
    ends = np.cumsum(n, axis=1)
    used = -(-ends[:, -1] // 8)
    grid = np.ones((len(d), 8 * int(used.max())), np.uint8)
    for k in range(PER_MCU):  # every code at its place
        for b in range(int(n[:, k].max())):
            has = np.flatnonzero(n[:, k] > b)
            grid[has, ends[has, k] - 1 - b] = word[has, k] >> b & 1
    return np.packbits(grid, axis=1), used


class Lanes:
    """Bit readers over the restart intervals of many scans, all at once."""

    def __init__(self, scans: list[np.ndarray]) -> None:
        raw = np.concatenate([*scans, np.full(8, 0x01, np.uint8)])
        ff = np.flatnonzero(raw[:-1] == 0xFF)
        stuffed, marks = ff[raw[ff + 1] == 0], ff[raw[ff + 1] != 0]
        keep = np.ones(len(raw), bool)
        keep[stuffed + 1] = False
        keep[marks] = keep[marks + 1] = False
        kept = np.cumsum(keep) - keep
        begins = np.cumsum([0, *map(len, scans[:-1])])
        data = raw[keep].astype(np.uint64)
        n = len(data) - 5
        self.ahead = sum(data[k : n + k] << np.uint64(40 - 8 * k) for k in range(6))  # 48 bits from each byte on
        self.at = 8 * np.sort(np.concatenate([kept[marks], kept[begins]]))

    def peek(self, lanes: np.ndarray, n: int) -> np.ndarray:
        at = self.at[lanes]
        return (self.ahead[at >> 3] >> (48 - n - (at & 7)).astype(np.uint64)).astype(np.int64) & ((1 << n) - 1)

    def take(self, lanes: np.ndarray, n: np.ndarray) -> np.ndarray:
        """n bits (up to 16) of each."""
        out = self.peek(lanes, 16) >> (16 - n)
        self.at[lanes] += n
        return out

    def symbol(self, lanes: np.ndarray, table: np.ndarray) -> np.ndarray:
        found = table[self.peek(lanes, 16)]
        if not found.all():
            raise ValueError("no such Huffman code")
        self.at[lanes] += found & 255
        return found >> 8


def _extended(bits: np.ndarray, size: np.ndarray) -> np.ndarray:
    return np.where(bits < (1 << np.maximum(size - 1, 0)), bits - (1 << size) + 1, bits) * (size > 0)


class Image:
    """Parsed segments of one file. Its coefficients are rows of arrays that a batch shares: [block, zigzag position] for each component."""

    def __init__(self, data: bytes) -> None:
        self.comment, self.scans, restart = b"", [], 0
        tables: dict[int, bytes] = {}
        self.quant: dict[int, np.ndarray] = {}
        raw = np.frombuffer(data, np.uint8)
        if data[:2] != b"\xff\xd8":
            raise ValueError("not a JPEG file")
        after = raw[1:]
        markers = np.flatnonzero((raw[:-1] == 0xFF) & (after != 0) & ((after & 0xF8) != 0xD0) & (after != 0xFF)).tolist()
        at, found = 2, 0
        while data[at + 1] != 0xD9:
            marker, size = data[at + 1], int.from_bytes(data[at + 2 : at + 4], "big")
            body, at = data[at + 4 : at + 2 + size], at + 2 + size
            if marker == 0xFE:
                self.comment = body
            elif marker == 0xDB:
                self.quant[body[0] & 15] = np.frombuffer(body[1:65], np.uint8)
            elif marker == 0xC2:
                self.height, self.width = struct.unpack(">HH", body[1:5])
                self.parts = [(body[6 + 3 * k], body[7 + 3 * k] >> 4, body[7 + 3 * k] & 15, body[8 + 3 * k]) for k in range(body[5])]
                if tuple(p[:3] for p in self.parts) != PARTS:
                    raise ValueError("only 4:2:0 is supported")
                self.mcus = (-(-self.width // 16), -(-self.height // 16))
                self.blocks = {c: h * v * self.mcus[0] * self.mcus[1] for c, h, v, _ in self.parts}
            elif marker == 0xC4:
                while body:  # a segment may define several tables
                    n = 17 + sum(body[1:17])
                    tables = tables | {body[0]: body[1:n]}
                    body = body[n:]
            elif marker == 0xDD:
                restart = int.from_bytes(body, "big")
            elif marker == 0xDA:
                while markers[found] < at:
                    found += 1
                n = body[0]
                used = tuple((body[1 + 2 * k], body[2 + 2 * k]) for k in range(n))
                self.scans.append(Scan(used, *body[1 + 2 * n : 3 + 2 * n], body[3 + 2 * n] >> 4, body[3 + 2 * n] & 15, restart, tables, raw[at : markers[found]]))
                at = markers[found]


class Scan(NamedTuple):
    components: tuple[tuple[int, int], ...]  # with the numbers of their tables
    first: int
    last: int
    high: int
    low: int
    restart: int
    tables: dict[int, bytes]
    data: np.ndarray


@lru_cache(maxsize=64)
def _cached_lookup(table: bytes) -> np.ndarray:
    return lookup(list(table[:16]), list(table[16:]))


def _dealt(units: list[int], restarts: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the restart intervals of some scans: the number of their scan, their first unit in it, and their units."""
    step = np.array([r or max(u, 1) for u, r in zip(units, restarts, strict=True)])
    total = np.array(units)
    n = -(-total // step)
    scan = np.repeat(np.arange(len(units)), n)
    first = (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)) * step[scan]
    return scan, first, np.minimum(step[scan], total[scan] - first)


def _mcu_rows(image: Image, base: dict[int, int]) -> np.ndarray:
    """[MCU, block]: rows of the shared arrays, in the order of an interleaved scan."""
    wide, high = image.mcus
    order = _plane_order(wide, high)
    back = np.empty(wide * high * PER_MCU, np.int64)
    for c, o in enumerate(order, 1):
        back[o] = np.arange(len(o)) + base[c]
    return back.reshape(-1, PER_MCU)


def _dc(group: list[tuple[Image, Scan, dict[int, int]]], shared: dict[int, np.ndarray]) -> None:
    _, one, _ = group[0]
    if len(one.components) > 1:
        rows = np.concatenate([_mcu_rows(i, base) for i, _, base in group])
        columns = [c for c, h, v in PARTS for _ in range(h * v)]
    else:
        columns = [one.components[0][0]]
        rows = np.concatenate([np.arange(i.blocks[columns[0]]) + base[columns[0]] for i, _, base in group])[:, None]
    units = [i.mcus[0] * i.mcus[1] if len(columns) > 1 else i.blocks[columns[0]] for i, _, _ in group]
    scan, first, n = _dealt(units, [s.restart for _, s, _ in group])
    start = (np.cumsum(units) - units)[scan] + first
    lanes, tabs = Lanes([s.data for _, s, _ in group]), dict(one.components)
    pred = np.zeros((4, len(n)), np.int64)
    for u in range(int(n.max())):
        live = np.flatnonzero(n > u)
        for j, c in enumerate(columns):
            at = rows[start[live] + u, j]
            if one.high:
                shared[c][at, 0] |= lanes.take(live, np.ones(len(live), np.int64)) << one.low
            else:
                size = lanes.symbol(live, _cached_lookup(one.tables[tabs[c] >> 4])).astype(np.int64)
                pred[c, live] += _extended(lanes.take(live, size), size)
                shared[c][at, 0] = pred[c, live] << one.low


def _ac(group: list[tuple[Image, Scan, dict[int, int]]], shared: dict[int, np.ndarray]) -> None:
    """AC scans of one component with the same band and bits."""
    _, one, _ = group[0]
    ((component, tab),) = one.components
    first, last, low, table = one.first, one.last, one.low, _cached_lookup(one.tables[16 | tab & 15])
    flat = shared[component]
    scan, unit, n = _dealt([i.blocks[component] for i, _, _ in group], [s.restart for _, s, _ in group])
    start = np.array([base[component] for _, _, base in group])[scan] + unit
    lanes = Lanes([s.data for _, s, _ in group])
    block, k, skip = np.zeros(len(n), np.int64), np.full(len(n), first), np.zeros(len(n), np.int64)
    live = np.arange(len(n))
    if one.high == 0:
        while len(live):
            s = lanes.symbol(live, table).astype(np.int64)
            run, size = s >> 4, s & 15
            coded = size > 0
            a = live if coded.all() else live[coded]
            k[a] += run[coded]
            flat[start[a] + block[a], k[a]] = _extended(lanes.take(a, size[coded]), size[coded]) << low
            k[a] += 1
            if len(a) < len(live):
                k[live[~coded & (run == 15)]] += 16
                ends = ~coded & (run < 15)
                e = live[ends]
                block[e] += (1 << run[ends]) + lanes.take(e, run[ends]) - 1
                k[e] = last + 1
            over = live[k[live] > last]
            if len(over):
                block[over] += 1
                k[over] = first
                live = live[block[live] < n[live]]
        return
    run, new = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)  # zeros yet to pass; the value that follows (0: none)
    inside = np.zeros(len(n), bool)
    while len(live):
        need = live[~inside[live] & (skip[live] == 0)]
        if len(need):
            s = lanes.symbol(need, table).astype(np.int64)
            r, size = s >> 4, s & 15
            ends = (size == 0) & (r < 15)
            skip[need[ends]] = (1 << r[ends]) + lanes.take(need[ends], r[ends])
            rest, size = need[~ends], size[~ends]
            sign = lanes.take(rest, size)
            new[rest] = np.where(size > 0, np.where(sign > 0, 1 << low, -1 << low), 0)
            run[rest], inside[rest] = r[~ends], True
        whole = ~inside[live]
        if whole.any():  # the rest of the block's band has correction bits alone
            a = live[whole]
            _correct_rest(flat, lanes, a, start[a] + block[a], k[a], first, last, low)
            skip[a] -= 1
            block[a] += 1
            k[a] = first
        a = live[~whole]
        if len(a):
            at = start[a] + block[a]
            old = flat[at, k[a]]
            some = old != 0
            b = a[some]
            bit = lanes.take(b, np.ones(len(b), np.int64))
            flat[at[some], k[b]] += np.where(bit > 0, np.where(old[some] > 0, 1 << low, -1 << low), 0).astype(flat.dtype)
            zero = a[~some]
            done = zero[run[zero] == 0]
            flat[start[done] + block[done], k[done]] = new[done]
            inside[done] = False
            run[zero] -= 1
            k[a] += 1
            over = a[k[a] > last]
            block[over] += 1
            k[over], inside[over] = first, False
        live = live[block[live] < n[live]]


def _correct_rest(flat: np.ndarray, lanes: Lanes, live: np.ndarray, at: np.ndarray, k: np.ndarray, first: int, last: int, low: int) -> None:
    """Correction bits of the coefficients from position k on that are not zero."""
    band = flat[at, first : last + 1]
    has = band != 0
    if (k > first).any():
        has &= np.arange(first, last + 1) >= k[:, None]
    place = np.cumsum(has, axis=1) - has + lanes.at[live][:, None]
    bit = (lanes.ahead[place >> 3] >> (47 - (place & 7)).astype(np.uint64)).astype(np.int64) & 1
    flat[at, first : last + 1] = band + np.where(has & (bit > 0), np.sign(band) << low, 0).astype(flat.dtype)
    lanes.at[live] += has.sum(axis=1)


def decode(files: list[bytes]) -> list[Image]:
    """The images with their coefficients; like scans of all files are decoded together."""
    images = [Image(f) for f in files]
    bases, total = [], dict.fromkeys((p[0] for p in PARTS), 0)
    for i in images:
        bases.append(dict(total))
        total = {c: n + i.blocks[c] for c, n in total.items()}
    shared = {c: np.zeros((n, 64), np.int32) for c, n in total.items()}
    for k in range(max((len(i.scans) for i in images), default=0)):
        groups: dict[tuple, list] = {}
        for i, base in zip(images, bases, strict=True):
            if k < len(i.scans):
                s = i.scans[k]
                groups.setdefault((*s[:5], *s.tables.items()), []).append((i, s, base))
        for group in groups.values():
            (_dc if group[0][1].first == 0 else _ac)(group, shared)
    for i, base in zip(images, bases, strict=True):
        i.planes = {c: shared[c][o : o + i.blocks[c]] for c, o in base.items()}
    return images


def payload_of(image: Image) -> bytes:
    blocks = np.empty((sum(map(len, image.planes.values())), UNIT), np.uint8)
    for c, order in enumerate(_plane_order(*image.mcus), 1):
        blocks[order] = to_payload(image.planes[c])
    return blocks.tobytes()[: struct.unpack(">Q", image.comment)[0]]


def _basis() -> np.ndarray:
    """[zigzag position, sample]: the inverse transform of 8 x 8 as one matrix."""
    u, x = np.mgrid[0:8, 0:8]
    one = np.where(u == 0, np.sqrt(0.125), 0.5) * np.cos((2 * x + 1) * u * np.pi / 16)
    return np.einsum("vy,ux->vuyx", one, one).reshape(64, 64)[ZIGZAG].astype(np.float32)


BASIS = _basis()


def to_rgb(image: Image) -> np.ndarray:
    """uint8 [height, width, 3] at full resolution."""
    wide, high = image.mcus
    planes = []
    for c, h, v, q in image.parts:
        samples = (image.planes[c] * image.quant[q].astype(np.int32)).astype(np.float32) @ BASIS + np.float32(128)
        plane = samples.reshape(high * v, wide * h, 8, 8).transpose(0, 2, 1, 3).reshape(high * v * 8, wide * h * 8)
        planes.append(np.clip(np.rint(plane), 0, 255).repeat(2 // v, axis=0).repeat(2 // h, axis=1) if (h, v) != (2, 2) else np.clip(np.rint(plane), 0, 255))
    y, cb, cr = planes[0], planes[1] - np.float32(128), planes[2] - np.float32(128)
    rgb = np.stack([y + np.float32(1.402) * cr, y - np.float32(0.344136) * cb - np.float32(0.714136) * cr, y + np.float32(1.772) * cb], axis=-1)
    return np.clip(np.rint(rgb), 0, 255).astype(np.uint8)[: image.height, : image.width]


def payload(text: bytes) -> bytes:
    """The text with zero bytes up to a positive multiple of 64."""
    return text + bytes(-len(text) % UNIT or (0 if text else UNIT))


def _abreast(payloads: list[bytes]) -> Iterator[list[bytes]]:
    held, size = [], 0
    for p in payloads:
        if held and size + len(p) > SAMPLES:
            yield held
            held, size = [], 0
        held.append(p)
        size += len(p)
    if held:
        yield held


def store_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, media: the stored file of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                texts = texts_as_bytes(part)
                files = [f for some in _abreast([payload(t) for t in texts]) for f in encode(some)]
                yield pa.RecordBatch.from_arrays([part.column("_id"), pa.array([len(t) for t in texts], pa.int64()), pa.array(files, pa.binary())], names=["doc_id", "n_bytes", "media"])

    return id_text(docs, id_col, text_col).mapInArrow(trimmed(run), "doc_id long, n_bytes long, media binary")


def read_media(media: DataFrame) -> DataFrame:
    """media with all its columns, and from its files payload, height, width, mean (of R, G and B), rgb (height x width x 3 bytes)."""
    schema = StructType([*media.schema.fields, *StructType.fromDDL("payload binary, height int, width int, mean array<double>, rgb binary")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "media", SAMPLES):
                images = decode(texts_as_bytes(part, "media"))
                tensors = [to_rgb(i) for i in images]
                means = [t.reshape(-1, 3).mean(axis=0, dtype=np.float64).tolist() for t in tensors]
                cols = [pa.array([payload_of(i) for i in images], pa.binary()), *(pa.array([getattr(i, a) for i in images], pa.int32()) for a in ("height", "width"))]
                cols += [pa.array(means, pa.list_(pa.float64())), pa.array([t.tobytes() for t in tensors], pa.binary())]
                yield pa.RecordBatch.from_arrays([*part.columns, *cols], names=schema.names)

    return media.mapInArrow(trimmed(run), schema)


def store_tensors(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes doc_id, media, height, width and the full-resolution tensor rgb as a Parquet table, and returns the table."""
    read_media(store_media(docs, id_col, text_col)).select("doc_id", "media", "height", "width", "rgb").write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def media_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stores each text, reads it back, and gives one row for each document with digests of both forms.

    feature: mean of R, G and B with three digits, and the CRC-32 of the tensor.
    """
    read = read_media(store_media(docs, id_col, text_col))
    mean = F.array_join(F.transform("mean", lambda m: F.format_string("%.3f", m)), "/")
    return read.select(
        "doc_id", "n_bytes", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_sha256"), F.crc32(F.substring("payload", -UNIT, UNIT)).alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"), F.concat_ws("/", mean, F.lower(F.lpad(F.hex(F.crc32("rgb")), 8, "0"))).alias("feature"),
    )
