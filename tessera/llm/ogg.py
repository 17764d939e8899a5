"""Ogg: pages with checksums, packets from lacing values, logical streams, granule times.

A physical stream is a run of pages. Each page has a checksum, belongs to one logical stream
by its serial number, and carries segments whose lengths, the lacing values, tell packets
apart: a value under 255 ends a packet, and a packet may go on in the stream's next page.
The granule position of a page is that of the last packet that ends in it; the packets before
it in the page end as many samples earlier as the later ones last, so each packet and page
has a time, by the rate in its stream's header.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import bounded_batches

MAGIC, HEAD = b"OggS", struct.Struct("<4sBBqIIIB")
CONTINUED, FIRST, LAST = 1, 2, 4

#: The stored form: samples a second, bytes of a packet, streams that take packets in turn, bytes of a frame.
RATE, PACKET, STREAMS, FRAME = 8000, 4096, 2, 192
IDENT = struct.Struct("<8sIBBQ")
CODEC = b"pcm-u8\0\0"

REVERSED = bytes(int(f"{b:08b}"[::-1], 2) for b in range(256))


class OggError(ValueError):
    """A page or packet that isn't as it should be."""


def checksum(page: bytes) -> int:
    """CRC-32 of polynomial 04C11DB7, most significant bit first, from zero and without final inversion.

    The bits of each byte are reversed, so that zlib's reflected CRC of the same polynomial
    does the work, and the result is reversed back.
    """
    crc = zlib.crc32(page.translate(REVERSED), 0xFFFFFFFF) ^ 0xFFFFFFFF
    return int.from_bytes(crc.to_bytes(4, "little").translate(REVERSED), "big")


def page(flags: int, granule: int, serial: int, number: int, lacing: bytes, body: bytes) -> bytes:
    head = HEAD.pack(MAGIC, 0, flags, granule, serial, number, 0, len(lacing)) + lacing
    crc = checksum(head + body)
    return head[:22] + struct.pack("<I", crc) + head[26:] + body


def lacing_of(size: int) -> bytes:
    return b"\xff" * (size // 255) + bytes([size % 255])


def pages_of(packets: list[tuple[bytes, int]], serial: int) -> Iterator[bytes]:
    """The pages of one logical stream from packets and their granule positions; the first packet stands alone."""
    number = 0
    lacing, body, granule, flags = bytearray(), bytearray(), -1, FIRST
    for i, (packet, position) in enumerate(packets):
        values, at = lacing_of(len(packet)), 0
        while values:
            if len(lacing) == 255:
                yield page(flags, granule, serial, number, bytes(lacing), bytes(body))
                number, granule, flags = number + 1, -1, CONTINUED * (at > 0)
                lacing, body = bytearray(), bytearray()
            now, values = values[: 255 - len(lacing)], values[255 - len(lacing) :]
            size = sum(now)
            lacing += now
            body += packet[at : at + size]
            at += size
            if not values:
                granule = position
            elif not at:
                raise OggError("an empty step")
        if i == 0 and len(packets) > 1:
            yield page(flags, granule, serial, number, bytes(lacing), bytes(body))
            number, granule, flags, lacing, body = number + 1, -1, 0, bytearray(), bytearray()
    yield page(flags | LAST, granule, serial, number, bytes(lacing), bytes(body))


def multiplexed(streams: dict[int, list[tuple[bytes, int]]]) -> bytes:
    """All streams' first pages, then their other pages in turn."""
    each = [list(pages_of(packets, serial)) for serial, packets in streams.items()]
    out = [p[0] for p in each]
    for i in range(1, max(map(len, each), default=0)):
        out += [p[i] for p in each if i < len(p)]
    return b"".join(out)


@dataclass
class Logical:
    """What has been read of one logical stream."""

    packets: list[bytes] = field(default_factory=list)
    #: Granule position at the end of each packet that is the last to end in its page, else None.
    granules: list[int | None] = field(default_factory=list)
    #: Granule position of each page (-1 where no packet ends), and the number of packets that have ended by its end.
    page_granules: list[int] = field(default_factory=list)
    page_packets: list[int] = field(default_factory=list)
    pages: int = 0
    open: bytearray | None = None
    ended: bool = False


def demultiplexed(data: bytes) -> dict[int, Logical]:
    """The logical streams of a physical stream, by serial number; OggError where it is damaged."""
    out: dict[int, Logical] = {}
    at = 0
    while at < len(data):
        if len(data) - at < HEAD.size or data[at : at + 4] != MAGIC:
            raise OggError(f"no page at byte {at}")
        _, version, flags, granule, serial, number, crc, n = HEAD.unpack_from(data, at)
        lacing = data[at + HEAD.size : at + HEAD.size + n]
        size = HEAD.size + n + sum(lacing)
        whole = data[at : at + size]
        if version or len(lacing) < n or len(whole) < size:
            raise OggError(f"the page at byte {at} is cut or of another version")
        if checksum(whole[:22] + b"\0\0\0\0" + whole[26:]) != crc:
            raise OggError(f"the page at byte {at} has a wrong checksum")
        if bool(flags & FIRST) == (serial in out):
            raise OggError(f"stream {serial} starts twice or not at all")
        s = out.setdefault(serial, Logical())
        if number != s.pages or s.ended:
            raise OggError(f"stream {serial} lacks page {s.pages}")
        if bool(flags & CONTINUED) != (s.open is not None):
            raise OggError(f"a packet of stream {serial} is cut")
        body, ended = at + HEAD.size + n, None
        run = 0
        for value in lacing:
            run += value
            if value < 255:
                packet = data[body : body + run]
                s.packets.append(bytes(s.open) + packet if s.open is not None else packet)
                s.granules.append(None)
                ended, s.open = len(s.packets) - 1, None
                body, run = body + run, 0
        if run or (lacing and lacing[-1] == 255):
            s.open = (s.open or bytearray()) + data[body : body + run]
        if ended is not None:
            s.granules[ended] = granule
        s.pages, s.ended = s.pages + 1, bool(flags & LAST)
        s.page_granules.append(granule)
        s.page_packets.append(len(s.packets))
        at += size
    for serial, s in out.items():
        if s.open is not None or not s.ended:
            raise OggError(f"stream {serial} has no end")
    return out


def rate_of(s: Logical) -> int | None:
    """Samples a second by the stream's header packet; None if it isn't of the codec that store() writes."""
    first = s.packets[0] if s.packets else b""
    return IDENT.unpack(first)[1] or None if len(first) == IDENT.size and first.startswith(CODEC) else None


def granules_of(s: Logical) -> list[int | None]:
    """The granule position at the end of each packet.

    Of the last packet that ends in a page it is the page's; those before it in the page end
    earlier by the samples of what follows, one a byte in this codec. Header packets last
    nothing. Of another codec's packets only the last of each page is known.
    """
    out = [None if g is None or g < 0 else g for g in s.granules]
    if rate_of(s) is not None:
        for i in range(len(out) - 2, -1, -1):
            if out[i] is None and out[i + 1] is not None:
                out[i] = out[i + 1] - (len(s.packets[i + 1]) if i + 1 else 0)
    return out


def store(payload: bytes) -> bytes:
    """Samples of 8 bits as packets that STREAMS logical streams take in turn, each after a header packet.

    Granule positions count the samples of their own stream.
    """
    streams: dict[int, list[tuple[bytes, int]]] = {i + 1: [(IDENT.pack(CODEC, RATE, i, STREAMS, len(payload)), 0)] for i in range(STREAMS)}
    for i, at in enumerate(range(0, len(payload), PACKET)):
        samples, own = payload[at : at + PACKET], streams[i % STREAMS + 1]
        own.append((samples, own[-1][1] + len(samples)))
    return multiplexed(streams)


def restore(data: bytes) -> tuple[bytes, dict]:
    """The samples that store() kept, and what the container tells of them."""
    streams = demultiplexed(data)
    turns: dict[int, Logical] = {}
    total = 0
    for s in streams.values():
        codec, rate, turn, of, total = IDENT.unpack(s.packets[0])
        if codec != CODEC or of != len(streams) or turn in turns:
            raise OggError("the header packets don't fit")
        turns[turn] = s
    out, i = [], 0
    while True:
        s = turns[i % len(turns)]
        if i // len(turns) + 1 >= len(s.packets):
            break
        out.append(s.packets[i // len(turns) + 1])
        i += 1
    payload = b"".join(out)
    if len(payload) != total or i != sum(len(s.packets) - 1 for s in streams.values()):
        raise OggError("packets are missing")
    ends = [granules_of(s) for s in turns.values()]
    for s, granules in zip(turns.values(), ends, strict=True):
        if granules != list(accumulate(map(len, s.packets[1:]), initial=0)):
            raise OggError("the granule positions don't fit the samples")
    longest = max((g / rate_of(s) for s, granules in zip(turns.values(), ends, strict=True) for g in granules[-1:]), default=0.0)
    return payload, {"streams": len(streams), "pages": sum(s.pages for s in streams.values()), "packets": i, "seconds": total / rate, "longest": longest}


def features(payload: bytes, told: dict) -> str:
    """Duration, that of the longest stream by its last packet's time, container counts, and mean, power and sign changes of the samples about 128."""
    samples = np.frombuffer(payload, dtype=np.uint8).astype(np.int64) - 128
    signs = samples >= 0
    return (
        f"seconds={told['seconds']:.6f};longest={told['longest']:.6f};streams={told['streams']};pages={told['pages']};packets={told['packets']}"
        f";mean={samples.mean():.6f};power={(samples * samples).mean():.6f};crossings={int(np.count_nonzero(signs[1:] != signs[:-1]))}"
    )


def padded(text: str) -> tuple[int, bytes]:
    raw = text.encode()
    return len(raw), raw + b" " * (-len(raw) % FRAME or (FRAME if not raw else 0))


def stored_media(docs: DataFrame, key: str = "doc_id", text: str = "text", keep: bool = False) -> DataFrame:
    """Each text stored as an Ogg file and read back.

    Returns key, n_bytes, payload_bytes long, payload_sha256 string, tail_crc32, media_bytes
    long, media_sha256, feature string, and with keep the file as media binary. All but
    n_bytes and the media columns are of the samples as read back. Null texts count as
    empty, which makes one frame of spaces; repeated rows and null keys give a row each; an
    empty table gives an empty one; other columns aren't read.
    """
    bounded_batches(docs.sparkSession)
    kind = "k long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    kind += ", media binary" * keep

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        types = [pa.int64()] * 3 + [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()] + [pa.binary()] * keep
        schema = pa.schema(list(zip([x.split()[0] for x in kind.split(", ")], types, strict=True)))
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                out = []
                for k, t in zip(batch.column(0)[i : i + 256], batch.column(1)[i : i + 256], strict=True):
                    n, payload = padded(t.as_py())
                    media = store(payload)
                    back, told = restore(media)
                    row = (k.as_py(), n, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-16:]), len(media), hashlib.sha256(media).hexdigest(), features(back, told))
                    out.append(row + (media,) * keep)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], schema=schema)

    rows = docs.select(F.col(key).cast("long").alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    return rows.mapInArrow(run, kind).withColumnRenamed("k", key)


def _each_file(files: DataFrame, key: str, media: str, columns: str, rows_of) -> DataFrame:
    """Rows of what rows_of gives for each logical stream of each file; a row with the error for a damaged file."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kinds = {"long": pa.int64(), "double": pa.float64(), "string": pa.string()}
        schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in columns.split(", ")])
        for batch in batches:
            for k, m in zip(batch.column(0), batch.column(1), strict=True):
                try:
                    out = [{"k": k.as_py(), "serial": serial, **row} for serial, s in demultiplexed(m.as_py() or b"").items() for row in rows_of(s)]
                except OggError as e:
                    out = [{"k": k.as_py(), "error": str(e)}]
                yield pa.RecordBatch.from_pylist(out, schema)

    rows = files.select(F.col(key).cast("long").alias("k"), F.col(media).alias("m"))
    return rows.mapInArrow(run, columns).withColumnRenamed("k", key)


def logical_streams(files: DataFrame, key: str = "doc_id", media: str = "media") -> DataFrame:
    """The logical streams of Ogg files: key, serial, pages, packets, bytes long, seconds double, error string.

    seconds is the time of the last granule position by the rate in the stream's header,
    null for another codec. A damaged file gives one row with the error and nulls; an empty
    or null one gives none.
    """

    def rows_of(s: Logical) -> list[dict]:
        rate, last = rate_of(s), max((g for g in s.granules if g is not None and g >= 0), default=0)
        return [{"pages": s.pages, "packets": len(s.packets), "bytes": sum(map(len, s.packets)), "seconds": last / rate if rate else None}]

    return _each_file(files, key, media, "k long, serial long, pages long, packets long, bytes long, seconds double, error string", rows_of)


def packet_times(files: DataFrame, key: str = "doc_id", media: str = "media") -> DataFrame:
    """The packets of Ogg files: key, serial, packet, page (in which it ends), bytes, granule long, seconds double, error string.

    granule and seconds are those of the packet's end, null where the codec doesn't tell.
    Damaged, empty and null files are as in logical_streams().
    """

    def rows_of(s: Logical) -> list[dict]:
        rate, granules = rate_of(s), granules_of(s)
        pages = np.searchsorted(s.page_packets, np.arange(len(s.packets)), side="right").tolist()
        return [
            {"packet": i, "page": page, "bytes": len(p), "granule": g, "seconds": g / rate if rate and g is not None else None}
            for i, (p, page, g) in enumerate(zip(s.packets, pages, granules, strict=True))
        ]

    return _each_file(files, key, media, "k long, serial long, packet long, page long, bytes long, granule long, seconds double, error string", rows_of)
