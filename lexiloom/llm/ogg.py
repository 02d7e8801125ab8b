"""Media columns in Ogg: write and read multiplexed logical streams.

A text is stored losslessly as unsigned 8-bit PCM at 8 kHz in an Ogg stream,
beside a second logical stream that holds one cue with the text's own length.
Reading verifies every page's checksum, rebuilds packets from lacing values
(also those that go on over pages), separates the streams by serial number and
derives timestamps from granule positions.

Null and empty texts become one frame of padding. A text of any length is stored
whole; one document's bytes are held in memory at a time. Equal texts give equal
bytes. Media that is null or does not parse raises ``ValueError`` in ``demux``;
``read_column`` returns a null struct for null media.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

FRAME, PAD, RATE = 576, 255, 8000
#: Frames in a packet, so that a full packet is 4,032 bytes.
PACKET_FRAMES = 7
FIRST, LAST, CONTINUED = 2, 4, 1
NO_GRANULE = -1
_REVERSED = bytes(int(f"{i:08b}"[::-1], 2) for i in range(256))


def page_checksum(page: bytes) -> int:
    """CRC-32 with polynomial 0x04C11DB7, unreflected, from zero: zlib's on bit-reversed bytes."""
    reflected = zlib.crc32(page.translate(_REVERSED), 0xFFFFFFFF) ^ 0xFFFFFFFF
    return int(f"{reflected:032b}"[::-1], 2)


def pages_of(serial: int, packets: list[tuple[bytes, int]]) -> list[tuple[int, int, bytes]]:
    """Pages of one logical stream from (packet, granule at its end): (granule, number, page).

    The first packet has a page to itself, as mapping rules ask.
    """
    done: list[tuple[int, int, bytes]] = []
    lacing, body, granule, continued = bytearray(), [], NO_GRANULE, False

    def flush(flags: int, goes_on: bool) -> None:
        nonlocal lacing, body, granule, continued
        flags |= CONTINUED * continued | FIRST * (not done)
        head = struct.pack("<4sBBqIII", b"OggS", 0, flags, granule, serial, len(done), 0) + bytes([len(lacing)]) + bytes(lacing)
        page = head + b"".join(body)
        done.append((granule, len(done), page[:22] + struct.pack("<I", page_checksum(page)) + page[26:]))
        lacing, body, granule, continued = bytearray(), [], NO_GRANULE, goes_on

    for at, (packet, end) in enumerate(packets):
        values = b"\xff" * (len(packet) // 255) + bytes([len(packet) % 255])
        used = start = 0
        while used < len(values):
            take = values[used : used + 255 - len(lacing)]
            lacing += take
            size = sum(take) if len(take) < 9 else 255 * (len(take) - 1) + take[-1]
            body.append(packet[start : start + size])
            start, used = start + size, used + len(take)
            if used == len(values):
                granule = end
            if len(lacing) == 255 and used < len(values):
                flush(0, True)
        last = at + 1 == len(packets)
        if last or at == 0 or len(lacing) == 255:
            flush(LAST * last, False)
    return done


def mux(streams: dict[int, list[tuple[bytes, int]]]) -> bytes:
    """Interleave logical streams: all first pages, then by granule position."""
    laid = [(number > 0, max(granule, 0), order, number, page) for order, (serial, packets) in enumerate(streams.items()) for granule, number, page in pages_of(serial, packets)]
    for i in range(1, len(laid)):  # a page on which no packet ends keeps its stream's place
        if laid[i][1] == 0 and laid[i][2] == laid[i - 1][2] and laid[i][3] > 1:
            laid[i] = (True, laid[i - 1][1], *laid[i][2:])
    return b"".join(x[-1] for x in sorted(laid, key=lambda x: x[:4]))


def demux(media: bytes) -> dict[int, list[tuple[bytes, int]]]:
    """Packets by serial number, each with the granule position of the page it ends on if it ends there last, else -1."""
    streams: dict[int, list[tuple[bytes, int]]] = {}
    open_: dict[int, list[bytes]] = {}
    numbers: dict[int, int] = {}
    at = 0
    while at < len(media):
        if media[at : at + 4] != b"OggS" or len(media) < at + 27:
            raise ValueError(f"no Ogg page at byte {at}")
        flags, granule, serial, number, crc, n = struct.unpack_from("<xBqIIIB", media, at + 4)
        lacing = media[at + 27 : at + 27 + n]
        start, end = at + 27 + n, at + 27 + n + sum(lacing)
        page = media[at:end]
        if len(page) != end - at or page_checksum(page[:22] + b"\0\0\0\0" + page[26:]) != crc:
            raise ValueError(f"bad checksum of the page at byte {at}")
        if number != numbers.get(serial, 0) or bool(flags & FIRST) != (number == 0) or bool(flags & CONTINUED) != bool(open_.get(serial)):
            raise ValueError(f"page {number} of stream {serial} is out of order")
        numbers[serial] = number + 1
        packets, parts = streams.setdefault(serial, []), open_.setdefault(serial, [])
        size, ended = 0, 0
        for value in lacing:
            size += value
            if value < 255:
                packets.append((b"".join([*parts, media[start : start + size]]), NO_GRANULE))
                parts.clear()
                start, size, ended = start + size, 0, ended + 1
        if size or (lacing and lacing[-1] == 255):
            parts.append(media[start : start + size])
        if ended:
            packets[-1] = (packets[-1][0], granule)
        at = end
    if any(open_.values()):
        raise ValueError("a packet is cut off")
    return streams


def payload_of(text: str | None) -> tuple[bytes, int]:
    raw = (text or "").encode()
    return raw + bytes([PAD]) * (-len(raw) % FRAME or FRAME * (not raw)), len(raw)


def write(text: str | None) -> bytes:
    """Ogg bytes for a text. Serials come from the payload, so equal texts are stored alike."""
    payload, n_bytes = payload_of(text)
    serial = zlib.crc32(payload)
    step = FRAME * PACKET_FRAMES
    sound = [(b"PCM     " + struct.pack(">HHIIBBHIB", 0, 0, 1, RATE, 8, 1, step, 0, 0), 0)]
    sound += [(payload[i : i + step], min(i + step, len(payload))) for i in range(0, len(payload), step)]
    cue = [(b"CUE     ", 0), (struct.pack("<Q", n_bytes), len(payload))]
    return mux({serial: sound, serial ^ 0xFFFFFFFF: cue})


def read(media: bytes) -> dict:
    """Payload, unpadded length and features, all from the stored bytes."""
    streams = demux(media)
    sound = next(p for p in streams.values() if p[0][0].startswith(b"PCM     "))
    cue = next(p for p in streams.values() if p[0][0].startswith(b"CUE     "))
    payload, end = b"".join(p for p, _ in sound[1:]), sound[-1][1]
    if end != len(payload):
        raise ValueError(f"the last granule position is {end}, the samples are {len(payload)}")
    rate = struct.unpack_from(">I", sound[0][0], 16)[0]
    counts = np.bincount(np.frombuffer(payload, np.uint8), minlength=256)
    level = np.arange(256) - 128
    mean, square = int(counts @ level) / end, int(counts @ level**2) / end
    loud = int(np.abs(level[counts > 0]).max())
    return {
        "n_bytes": struct.unpack("<Q", cue[1][0])[0], "payload_bytes": len(payload), "payload_sha256": hashlib.sha256(payload).hexdigest(), "tail_crc32": zlib.crc32(payload[-32:]),
        "media_bytes": len(media), "media_sha256": hashlib.sha256(media).hexdigest(),
        "feature": f"seconds={end / rate:.6f};packets={len(sound) - 1};streams={len(streams)};mean={mean:.4f};rms={square**0.5:.4f};peak={loud};levels={int((counts > 0).sum())}",
    }


READ_TYPE = "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def _write(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series([write(t) for t in texts], dtype=object)


def _read(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    names = [x.split()[0] for x in READ_TYPE.split(", ")]
    for stored in batches:
        yield pd.DataFrame([dict.fromkeys(names) if m is None else read(m) for m in stored], columns=names)


def write_column(text: Column) -> Column:
    """Ogg bytes of each text."""
    return F.pandas_udf(_write, "binary")(text)


def read_column(media: Column) -> Column:
    """Struct of ``READ_TYPE`` of each stored media."""
    return F.pandas_udf(_read, READ_TYPE)(media)
