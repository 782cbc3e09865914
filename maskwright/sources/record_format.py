"""The record file format: framed, checksummed Example messages.

A record is an 8-byte length, a masked CRC-32C of it, the message, and a masked CRC-32C of the
message. An Example maps feature names to a list of floats, 64-bit integers or byte strings.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np

# Fixed values of the public format: reversed CRC-32C polynomial and the mask added to checksums.
POLYNOMIAL = 0x82F63B78
MASK_DELTA = 0xA282EAD8
FLOAT_TYPE = 1  # element type code of a serialized float32 tensor
LANE = 64
CACHED_LANES = 1 << 13  # half a megabyte at a time
GROUP_BYTES = 4 << 20


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(POLYNOMIAL), table >> 1).astype(np.uint32)
    return table


BYTES = _byte_table()
_ADVANCE: dict[int, np.ndarray] = {}  # filled on use; a plain dict travels with the tasks


def _apply(tables: np.ndarray, states: np.ndarray) -> np.ndarray:
    return np.take(tables[0], states & 0xFFFF) ^ np.take(tables[1], states >> 16)


def _advance(doublings: int) -> np.ndarray:
    """Lookup tables, by low and high half, that move a checksum over ``2 ** doublings`` zero bytes."""
    if doublings not in _ADVANCE:
        if doublings == 0:
            halves = np.arange(1 << 16, dtype=np.uint32)
            values = np.stack([halves, halves << 16])
            _ADVANCE[0] = BYTES[values & 0xFF] ^ (values >> 8)
        else:
            half = _advance(doublings - 1)
            _ADVANCE[doublings] = _apply(half, half)
    return _ADVANCE[doublings]


def _checksums(messages: list[bytes], lanes: int) -> np.ndarray:
    """CRC-32C of messages that fit in ``lanes`` lanes."""
    padded = np.zeros((len(messages), lanes * LANE), np.uint8)
    for row, message in zip(padded, messages):
        start = len(row) - len(message)
        row[start:] = np.frombuffer(message, np.uint8)  # leading zeros do not change a sum that starts at 0
        row[start:start + 4] ^= 0xFF  # the same as starting at all ones
    words = np.ascontiguousarray(padded.view("<u4").reshape(-1, LANE // 4).T)
    states = np.zeros(words.shape[1], np.uint32)
    for column in words:
        states = _apply(_advance(2), states ^ column)
    states = states.reshape(len(messages), lanes)
    doublings = LANE.bit_length() - 1
    while states.shape[1] > 1:
        if states.shape[1] % 2:
            states = np.pad(states, ((0, 0), (1, 0)))
        states = _apply(_advance(doublings), states[:, 0::2]) ^ states[:, 1::2]
        doublings += 1
    return states[:, 0] ^ np.uint32(0xFFFFFFFF)


def _lanes(size: int) -> int:
    """Lanes for a message, rounded up to four binary digits so that similar sizes share a group."""
    lanes = -(-size // LANE)
    unit = 1 << max(0, lanes.bit_length() - 4)
    return -(-lanes // unit) * unit


def crc32c(messages: list[bytes]) -> np.ndarray:
    """CRC-32C of each message.

    A message is cut into 64-byte lanes; the lanes of many messages are summed together, four bytes
    a step, and then merged pairwise.
    """
    out = np.empty(len(messages), np.uint32)
    groups: dict[int, list[int]] = {}
    for i, message in enumerate(messages):
        if len(message) < 4:
            state = 0xFFFFFFFF
            for byte in message:
                state = int(BYTES[(state ^ byte) & 0xFF]) ^ (state >> 8)
            out[i] = state ^ 0xFFFFFFFF
        else:
            groups.setdefault(_lanes(len(message)), []).append(i)
    for lanes, members in groups.items():
        some = max(1, CACHED_LANES // lanes)
        for start in range(0, len(members), some):
            part = members[start:start + some]
            out[part] = _checksums([messages[i] for i in part], lanes)
    return out


def masked_crc(messages: list[bytes]) -> np.ndarray:
    crc = crc32c(messages)
    return ((crc >> 15) | (crc << 17)) + np.uint32(MASK_DELTA)


def frame(messages: list[bytes]) -> bytes:
    """The records of a few messages; give many at a time, checksums are computed together."""
    lengths = [struct.pack("<Q", len(m)) for m in messages]
    checks = masked_crc(lengths + messages).astype("<u4")
    heads, tails = checks[:len(messages)], checks[len(messages):]
    return b"".join(part for length, head, message, tail in zip(lengths, heads, messages, tails)
                    for part in (length, head.tobytes(), message, tail.tobytes()))


def _verified(heads: list[bytes], bodies: list[bytes], verify: bool) -> Iterator[bytes]:
    messages = [body[:-4] for body in bodies]
    if verify:
        stored = np.frombuffer(b"".join([h[8:] for h in heads] + [b[-4:] for b in bodies]), "<u4")
        if (masked_crc([h[:8] for h in heads] + messages) != stored).any():
            raise ValueError("record fails its checksum")
    yield from messages


def read_frames(stream, verify: bool = True) -> Iterator[bytes]:
    """Messages of one open file. A few megabytes are read and checked at a time."""
    heads, bodies, held = [], [], 0
    while head := stream.read(12):
        if len(head) < 12:
            raise ValueError("record file ends inside a record")
        size = struct.unpack("<Q", head[:8])[0]
        body = stream.read(size + 4)
        if len(body) < size + 4:
            raise ValueError("record file ends inside a record")
        heads.append(head)
        bodies.append(body)
        held += len(body)
        if held >= GROUP_BYTES:
            yield from _verified(heads, bodies, verify)
            heads, bodies, held = [], [], 0
    yield from _verified(heads, bodies, verify)


def _varint(value: int) -> bytes:
    value &= (1 << 64) - 1
    out = bytearray()
    while value > 0x7F:
        out.append(value & 0x7F | 0x80)
        value >>= 7
    out.append(value)
    return bytes(out)


def _field(number: int, payload: bytes) -> bytes:
    return _varint(number << 3 | 2) + _varint(len(payload)) + payload


def _read_varint(buffer: memoryview, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = buffer[at]
        value |= (byte & 0x7F) << shift
        at, shift = at + 1, shift + 7
        if byte < 0x80:
            return value, at


def _fields(buffer: memoryview) -> Iterator[tuple[int, int | memoryview]]:
    at = 0
    while at < len(buffer):
        tag, at = _read_varint(buffer, at)
        wire = tag & 7
        if wire == 0:
            value, at = _read_varint(buffer, at)
        else:
            size = {1: 8, 5: 4}.get(wire)
            if size is None:
                size, at = _read_varint(buffer, at)
            value, at = buffer[at:at + size], at + size
        yield tag >> 3, value


def _integers(chunks: list[int | memoryview]) -> np.ndarray:
    """64-bit integers, packed or not."""
    out: list[int] = []
    for chunk in chunks:
        if isinstance(chunk, int):
            out.append(chunk)
            continue
        raw = np.frombuffer(chunk, np.uint8)
        if (raw < 0x80).all():
            out.extend(raw.tolist())
            continue
        at = 0
        while at < len(chunk):
            value, at = _read_varint(chunk, at)
            out.append(value)
    return np.array(out, np.uint64).view(np.int64)


def encode_feature(value) -> bytes:
    """A feature from a float array, an integer array, or bytes."""
    if isinstance(value, (bytes, memoryview)):
        return _field(1, _field(1, bytes(value)))
    if value.dtype.kind == "f":
        return _field(2, _field(1, value.astype("<f4").tobytes()))
    return _field(3, _field(1, b"".join(_varint(int(v)) for v in value)))


def encode_example(features: dict[str, object]) -> bytes:
    entries = [_field(1, _field(1, name.encode()) + _field(2, encode_feature(features[name])))
               for name in sorted(features)]
    return _field(1, b"".join(entries))


def _decode_feature(buffer: memoryview):
    for kind, body in _fields(buffer):
        chunks = [value for number, value in _fields(body) if number == 1]
        if kind == 1:
            return [bytes(c) for c in chunks]
        if kind == 2:
            return np.frombuffer(b"".join(chunks), "<f4")
        if kind == 3:
            return _integers(chunks)
    return None


def decode_example(message: bytes, wanted: set[str]) -> dict[str, object]:
    """The wanted features of one Example; the others are skipped without decoding."""
    out: dict[str, object] = {}
    for number, body in _fields(memoryview(message)):
        for inner, entry in _fields(body) if number == 1 else ():
            parts = dict(_fields(entry)) if inner == 1 else {}
            name = bytes(parts.get(1, b"")).decode()
            if name in wanted and 2 in parts:
                out[name] = _decode_feature(parts[2])
    return out


def encode_tensor(values: np.ndarray, shape) -> bytes:
    """A serialized float32 tensor: element type, dimensions, little-endian content."""
    dims = b"".join(_field(2, b"\x08" + _varint(int(d))) for d in shape)
    return b"\x08" + _varint(FLOAT_TYPE) + _field(2, dims) + _field(4, values.astype("<f4").tobytes())


def decode_tensor(data: bytes) -> tuple[np.ndarray, list[int]]:
    """Values and shape of a serialized float32 tensor."""
    kind, shape, content, loose = None, [], None, []
    for number, value in _fields(memoryview(data)):
        if number == 1:
            kind = value
        elif number == 2:
            shape = [dict(_fields(dim)).get(1, 0) for inner, dim in _fields(value) if inner == 2]
        elif number == 4:
            content = value
        elif number == 5:
            loose.append(value)
    if kind != FLOAT_TYPE:
        raise ValueError(f"tensor has element type {kind}, not float32")
    values = np.frombuffer(content if content is not None else b"".join(loose), "<f4")
    if content is None and len(values) == 1:
        values = np.repeat(values, int(np.prod(shape)))
    if len(values) != int(np.prod(shape)):
        raise ValueError(f"tensor of {len(values)} values does not fit shape {shape}")
    return values, shape
