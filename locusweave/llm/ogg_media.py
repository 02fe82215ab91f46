"""Media columns in Ogg: writing, and reading back with all that the container offers to check.

A text's bytes, padded to whole frames, are stored as 8-bit samples in one logical stream; a second stream carries
how many bytes are text. Both are cut into packets, packets into lacing values, lacing values into pages with a
checksum, and the pages of the streams are interleaved. The reader verifies every page's checksum and order,
separates the streams by serial number, joins packets from lacing values across pages, and derives times from the
granule positions, which count samples.

Defined cases: null counts as empty; an empty text is one frame of padding; equal texts give equal bytes; a damaged
checksum, a lost or repeated page, or a packet that does not end raises ValueError. Rows are independent, so repeated
ids, extra columns and empty tables need no care.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from locusweave.llm.common import runs_on_executors, small_batches

runs_on_executors(__name__)
FRAME = 576
PAD = b"\xff"
PACKET_FRAMES = 8
SAMPLES_PER_SECOND = 8000
SOUND, NOTES = 0x534E4431, 0x4E4F5445
CONTINUED, FIRST, LAST = 1, 2, 4
#: magic, version, flags, granule position, serial number, page number, checksum, segments
HEADER = "<4sBBqIIIB"
HEADER_BYTES = struct.calcsize(HEADER)
ROWS_AT_ONCE = 128
_TURNED = bytes(int(f"{b:08b}"[::-1], 2) for b in range(256))


def page_checksum(page: bytes) -> int:
    """Ogg's CRC-32: polynomial 0x04C11DB7 from the highest bit, nothing inverted.

    zlib's CRC has the same polynomial from the lowest bit, so the bits of each byte and of the result are turned.
    """
    turned = zlib.crc32(page.translate(_TURNED), 0xFFFFFFFF) ^ 0xFFFFFFFF
    return int.from_bytes(turned.to_bytes(4, "little").translate(_TURNED), "big")


def _pages(serial: int, packets: list[tuple[bytes, int]]) -> list[bytes]:
    """Pages of a logical stream; packets: (bytes, granule position at its end). The first packet has its own page."""
    out: list[bytes] = []
    lacing, body, ended, flags = bytearray(), bytearray(), -1, FIRST

    def close(more: int) -> None:
        nonlocal ended, flags
        head = struct.pack(HEADER, b"OggS", 0, flags | more, ended, serial, len(out), 0, len(lacing)) + lacing
        page = head + body
        out.append(page[:22] + struct.pack("<I", page_checksum(page)) + page[26:])
        lacing.clear()
        body.clear()
        ended = -1

    for k, (data, granule) in enumerate(packets):
        sizes = [255] * (len(data) // 255) + [len(data) % 255]
        at = 0
        while at < len(sizes):
            take = sizes[at : at + 255 - len(lacing)]
            start = at * 255
            body += data[start : start + sum(take)]
            lacing += bytes(take)
            at += len(take)
            if at == len(sizes):
                ended = granule
            if len(lacing) == 255 and not (at == len(sizes) and k == len(packets) - 1):
                close(0)
                flags = 0 if at == len(sizes) else CONTINUED
        if k == 0 and len(packets) > 1:
            close(0)
            flags = 0
    close(LAST)
    return out


def write(text: bytes) -> bytes:
    """The Ogg file of a text."""
    payload = text + PAD * (max(1, -(-len(text) // FRAME)) * FRAME - len(text))
    size = FRAME * PACKET_FRAMES
    sound = [(struct.pack("<8sIQ", b"\x01samples", SAMPLES_PER_SECOND, len(payload)), 0)]
    sound += [(payload[a : a + size], min(a + size, len(payload))) for a in range(0, len(payload), size)]
    notes = [(b"\x01notes  ", 0), (struct.pack("<Q", len(text)), len(payload))]
    one, two = _pages(SOUND, sound), _pages(NOTES, notes)
    mixed = [one[0], two[0]]
    for k in range(1, max(len(one), len(two))):
        mixed += one[k : k + 1] + two[k : k + 1]
    return b"".join(mixed)


@dataclass
class Stream:
    packets: list[bytes] = field(default_factory=list)
    times: list[tuple[int, int]] = field(default_factory=list)  # (packets ended so far, granule position)
    pages: int = 0
    open: bytearray = field(default_factory=bytearray)
    ended: bool = False
    unfinished: bool = False


def read(data: bytes) -> dict[int, Stream]:
    """The logical streams of an Ogg file by serial number."""
    streams: dict[int, Stream] = {}
    at = 0
    while at < len(data):
        if len(data) - at < HEADER_BYTES:
            raise ValueError("cut short in a page header")
        magic, version, flags, granule, serial, number, checksum, segments = struct.unpack_from(HEADER, data, at)
        if magic != b"OggS" or version:
            raise ValueError(f"no page at byte {at}")
        lacing = data[at + HEADER_BYTES : at + HEADER_BYTES + segments]
        end = at + HEADER_BYTES + segments + sum(lacing)
        page = data[at:end]
        if page_checksum(page[:22] + bytes(4) + page[26:]) != checksum:
            raise ValueError(f"checksum of page {number} of stream {serial:08x} is wrong")
        stream = streams.setdefault(serial, Stream())
        if number != stream.pages or bool(flags & FIRST) != (number == 0) or stream.ended:
            raise ValueError(f"page {number} of stream {serial:08x} is out of order")
        if bool(flags & CONTINUED) != stream.unfinished:
            raise ValueError(f"page {number} of stream {serial:08x} does not go on where the last one stopped")
        stream.pages += 1
        stream.ended = bool(flags & LAST)
        place = HEADER_BYTES + segments
        size, done = 0, 0
        for value in lacing:
            size += value
            if value < 255:
                stream.packets.append(bytes(stream.open) + page[place : place + size])
                stream.open.clear()
                place, size, done = place + size, 0, done + 1
        stream.open += page[place : place + size]
        stream.unfinished = bool(lacing) and lacing[-1] == 255
        if done:
            stream.times.append((len(stream.packets), granule))
        at = end
    for serial, stream in streams.items():
        if stream.open or stream.unfinished or not stream.ended:
            raise ValueError(f"stream {serial:08x} does not end")
    return streams


@dataclass
class Sound:
    payload: bytes
    text_bytes: int
    seconds: float
    marks: list[float]  # seconds at the ends of pages
    pages: int
    packets: int


def decode(data: bytes) -> Sound:
    """Payload, text length and times of a file of this module's layout."""
    streams = read(data)
    sound, notes = streams[SOUND], streams[NOTES]
    _, rate, total = struct.unpack("<8sIQ", sound.packets[0])
    payload = b"".join(sound.packets[1:])
    if len(payload) != total or sound.times[-1][1] != total:
        raise ValueError("samples and granule positions do not agree")
    marks = [g / rate for _, g in sound.times]
    return Sound(payload, struct.unpack("<Q", notes.packets[1])[0], total / rate, marks, sum(s.pages for s in streams.values()), sum(len(s.packets) for s in streams.values()))


def features(sound: Sound) -> str:
    """Times, counts and simple statistics of the samples around the middle value 128."""
    x = np.frombuffer(sound.payload, np.uint8).astype(np.int32) - 128
    crossings = int(np.count_nonzero((x[1:] < 0) != (x[:-1] < 0)))
    return (
        f"seconds={sound.seconds:.3f};pages={sound.pages};packets={sound.packets};mean={x.mean():.4f};"
        f"rms={np.sqrt((x.astype(np.int64) ** 2).mean()):.4f};crossings={crossings};low={int(x.min())};high={int(x.max())}"
    )


def media_table(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text) -> doc_id, n_bytes, media binary, feature; a row per document."""
    return _run(docs, False)


def digests(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text) -> doc_id, n_bytes, payload and media digests and feature; a row per document."""
    return _run(docs, True)


def _run(docs: DataFrame, digest: bool) -> DataFrame:
    id_type = docs.schema["doc_id"].dataType.simpleString()
    kinds = "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    kinds = kinds if digest else "n_bytes long, media binary, feature string"
    types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = [k.split() for k in kinds.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, len(whole), ROWS_AT_ONCE):
                batch = whole.slice(a, ROWS_AT_ONCE)
                rows = []
                for text in batch.column(1).to_pylist():
                    text = (text or "").encode()
                    media = write(text)
                    sound = decode(media)
                    if sound.payload[: sound.text_bytes] != text:
                        raise ValueError("what was read back is not what was written")
                    if digest:
                        sha = hashlib.sha256(sound.payload).hexdigest()
                        tail = zlib.crc32(sound.payload[-32:])
                        rows.append((sound.text_bytes, len(sound.payload), sha, tail, len(media), hashlib.sha256(media).hexdigest(), features(sound)))
                    else:
                        rows.append((sound.text_bytes, media, features(sound)))
                columns = [pa.array([r[k] for r in rows], types[t]) for k, (_, t) in enumerate(fields)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", *[n for n, _ in fields]])

    return small_batches(docs).select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, {kinds}")
