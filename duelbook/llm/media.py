"""Media columns as MPEG transport streams (ISO/IEC 13818-1).

A payload becomes one private elementary stream in 188-byte packets: program association and program
map tables, PES packets with time stamps, adaptation fields with clock reference and random-access
marks. Reading back parses the tables, checks the continuity counters and the tables' CRC, puts the
PES packets together again and lists every one's time stamp, byte offset and whether it is a
random-access point.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

PACKET, SYNC = 188, 0x47
PMT_PID, ES_PID, PROGRAM = 0x1000, 0x0100, 1
STREAM_TYPE, STREAM_ID = 0x06, 0xBD  # PES with private data, private_stream_1
PES_HEADER = 14
#: Data bytes of a whole PES packet: what is left in its first transport packet, and 88 full ones.
FIRST_DATA, FULL_DATA, FULL_PACKETS = PACKET - 4 - 8 - PES_HEADER, PACKET - 4, 88
PES_DATA = FIRST_DATA + FULL_PACKETS * FULL_DATA
#: Each fourth PES packet is a random-access point and has the tables before it. 90 kHz ticks between packets.
RANDOM_ACCESS_EVERY, TICKS = 4, 3600
UNIT = 64


def _crc_table() -> list[int]:
    table = []
    for i in range(256):
        c = i << 24
        for _ in range(8):
            c = (c << 1) ^ (0x04C11DB7 if c & 0x80000000 else 0)
        table.append(c & 0xFFFFFFFF)
    return table


CRC = _crc_table()


def crc32_mpeg(data: bytes) -> int:
    c = 0xFFFFFFFF
    for b in data:
        c = ((c << 8) & 0xFFFFFFFF) ^ CRC[(c >> 24) ^ b]
    return c


def _section(table_id: int, number: int, body: bytes) -> bytes:
    head = bytes([table_id]) + (0xB000 | (5 + len(body) + 4)).to_bytes(2, "big") + number.to_bytes(2, "big") + b"\xc1\x00\x00" + body
    return head + crc32_mpeg(head).to_bytes(4, "big")


def _table_packet(pid: int, section: bytes) -> np.ndarray:
    head = bytes([SYNC, 0x40 | pid >> 8, pid & 0xFF, 0x10, 0]) + section
    return np.frombuffer(head.ljust(PACKET, b"\xff"), dtype=np.uint8)


PAT = _section(0, 1, PROGRAM.to_bytes(2, "big") + (0xE000 | PMT_PID).to_bytes(2, "big"))
PMT = _section(2, PROGRAM, (0xE000 | ES_PID).to_bytes(2, "big") + b"\xf0\x00" + bytes([STREAM_TYPE]) + (0xE000 | ES_PID).to_bytes(2, "big") + b"\xf0\x00")
TABLES = np.stack([_table_packet(0, PAT), _table_packet(PMT_PID, PMT)])


def _pes_header(size: int, pts: int) -> bytes:
    stamp = [0x21 | (pts >> 29) & 0x0E, pts >> 22 & 0xFF, 0x01 | pts >> 14 & 0xFE, pts >> 7 & 0xFF, 0x01 | pts << 1 & 0xFE]
    return b"\x00\x00\x01" + bytes([STREAM_ID]) + (size + 8).to_bytes(2, "big") + b"\x80\x80\x05" + bytes(stamp)


def _clock(pts: int, random_access: bool) -> bytes:
    """Adaptation field of 8 bytes: flags and clock reference."""
    return bytes([7, 0x10 | 0x40 * random_access, pts >> 25 & 0xFF, pts >> 17 & 0xFF, pts >> 9 & 0xFF, pts >> 1 & 0xFF, (pts & 1) << 7 | 0x7E, 0])


def mux(payload: bytes) -> bytes:
    """One transport stream with the payload as its elementary stream."""
    out, counter, tables = [], 0, 0
    for k, at in enumerate(range(0, max(len(payload), 1), PES_DATA)):
        data = payload[at : at + PES_DATA]
        pts, rap = k * TICKS % (1 << 33), k % RANDOM_ACCESS_EVERY == 0
        if rap:
            psi = TABLES.copy()
            psi[:, 3] |= tables & 15
            tables += 1
            out.append(psi)
        body = _clock(pts, rap) + _pes_header(len(data), pts) + data
        n = -(-len(body) // FULL_DATA)
        block = np.zeros((n, PACKET), dtype=np.uint8)
        block[:, 0], block[:, 1], block[:, 2] = SYNC, ES_PID >> 8, ES_PID & 0xFF
        block[0, 1] |= 0x40
        block[:, 3] = 0x10 | (counter + np.arange(n)) & 15
        block[0, 3] |= 0x20
        counter += n
        whole = len(body) // FULL_DATA
        flat = np.frombuffer(body, dtype=np.uint8)
        block[:whole, 4:] = flat[: whole * FULL_DATA].reshape(whole, FULL_DATA)
        left = flat[whole * FULL_DATA :]
        if whole < n == 1:  # too short for one packet: its own adaptation field is stuffed
            stuffing = FULL_DATA - len(left)
            block[0, 4:12] = left[:8]
            block[0, 4] += stuffing
            block[0, 12 : 12 + stuffing] = 0xFF
            block[0, 12 + stuffing :] = left[8:]
        elif whole < n:
            stuffing = FULL_DATA - len(left)
            block[-1, 3] |= 0x20
            block[-1, 4] = stuffing - 1
            block[-1, 5 : 4 + stuffing] = 0xFF
            if stuffing > 1:
                block[-1, 5] = 0
            block[-1, 4 + stuffing :] = left
        out.append(block)
    return np.concatenate(out).tobytes()


def _sections(packets: np.ndarray, pid: np.ndarray, want: int, table_id: int) -> list[bytes]:
    """Bodies of the sections on a PID whose CRC holds (sections of one packet)."""
    found = []
    for p in packets[(pid == want) & (packets[:, 1] & 0x40 > 0)]:
        at = 4 + (1 + int(p[4]) if p[3] & 0x20 else 0)
        at += 1 + int(p[at])
        size = 3 + ((int(p[at + 1]) & 0x0F) << 8 | int(p[at + 2]))
        section = p[at : at + size].tobytes()
        if section[0] == table_id and crc32_mpeg(section) == 0:
            found.append(section[8:-4])
    return found


def demux(media: bytes) -> dict:
    """Parses a transport stream: payload of its first elementary stream, tables, errors and time stamps."""
    if len(media) % PACKET:
        raise ValueError("not a whole number of transport packets")
    packets = np.frombuffer(media, dtype=np.uint8).reshape(-1, PACKET)
    if (packets[:, 0] != SYNC).any():
        raise ValueError("sync byte is missing")
    pid = (packets[:, 1].astype(np.int32) & 0x1F) << 8 | packets[:, 2]
    pat = _sections(packets, pid, 0, 0)
    pmt_pid = int.from_bytes(pat[0][2:4], "big") & 0x1FFF
    pmt = _sections(packets, pid, pmt_pid, 2)
    info = int.from_bytes(pmt[0][2:4], "big") & 0x0FFF
    stream_type, es_pid = pmt[0][4 + info], int.from_bytes(pmt[0][5 + info : 7 + info], "big") & 0x1FFF
    errors = 0
    for p in np.unique(pid):
        count = packets[(pid == p) & (packets[:, 3] & 0x10 > 0), 3] & 15
        errors += int((np.diff(count.astype(np.int16)) % 16 != 1).sum())
    es = packets[(pid == es_pid) & (packets[:, 3] & 0x10 > 0)]
    field = es[:, 3] & 0x20 > 0
    start = np.where(field, 5 + es[:, 4].astype(np.int32), 4)
    flat = es[np.arange(PACKET)[None, :] >= start[:, None]].tobytes()
    begins = np.concatenate(([0], np.cumsum(PACKET - start)))
    units = np.flatnonzero(es[:, 1] & 0x40)
    ends = np.append(begins[units][1:], begins[-1])
    random_access = (field & (es[:, 4] > 0) & (es[:, 5] & 0x40 > 0))[units]
    parts, stamps, at = [], [], 0
    for b, e, r in zip(begins[units], ends, random_access, strict=True):
        pes = flat[b:e]
        size = int.from_bytes(pes[4:6], "big") + 6
        if pes[:3] != b"\x00\x00\x01" or size != len(pes):
            raise ValueError("broken PES packet")
        s = pes[9:14]
        pts = (s[0] >> 1 & 7) << 30 | s[1] << 22 | (s[2] >> 1) << 15 | s[3] << 7 | s[4] >> 1
        parts.append(pes[9 + pes[8] :])
        stamps.append((pts, at, bool(r)))
        at += len(parts[-1])
    return {"payload": b"".join(parts), "pmt_pid": pmt_pid, "es_pid": es_pid, "stream_type": stream_type, "packets": len(packets), "tables": len(pat) + len(pmt), "continuity_errors": errors, "stamps": stamps}


def padded(data: bytes, unit: int = UNIT) -> bytes:
    """Zeros up to a positive multiple of the unit."""
    return data.ljust(max(unit, -(-len(data) // unit) * unit), b"\x00")


def encoded(text: Column) -> Column:
    """The transport stream (binary) of a text's padded UTF-8 bytes; null is as an empty text."""

    @F.pandas_udf("binary")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([mux(padded(t.encode("utf-8", "replace") if isinstance(t, str) else b"")) for t in texts], dtype=object)

    return run(text)


def sample_feature(payload: bytes) -> str:
    """Statistics of the samples (bytes, unsigned): mean, deviation, entropy in bits, shares of zeros, of blanks and of samples over 127, mean step between neighbours."""
    x = np.frombuffer(payload, dtype=np.uint8)
    share = np.bincount(x, minlength=256) / len(x)
    entropy = -(share[share > 0] * np.log2(share[share > 0])).sum() + 0.0
    level = np.arange(256)
    mean = (share * level).sum()
    step = np.abs(np.diff(x.astype(np.int16))).mean()
    return f"mean={mean:.4f};deviation={np.sqrt((share * (level - mean) ** 2).sum()):.4f};entropy={entropy:.4f};zeros={share[0]:.4f};blanks={share[32]:.4f};high={share[128:].sum():.4f};step={step:.4f}"


READ = "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, timestamps array<struct<pts:long,byte_offset:long,random_access:boolean>>"


def decoded(media: Column) -> Column:
    """What a stored transport stream holds: digests of payload and stream, a feature text and the time stamps."""

    @F.pandas_udf(READ)
    def run(streams: pd.Series) -> pd.DataFrame:
        rows = []
        for m in streams:
            got = demux(m)
            p, stamps = got["payload"], got["stamps"]
            feature = (
                f"program={PROGRAM};pmt_pid={got['pmt_pid']};es_pid={got['es_pid']};stream_type={got['stream_type']};packets={got['packets']};tables={got['tables']};"
                f"pes={len(stamps)};random_access={sum(s[2] for s in stamps)};continuity_errors={got['continuity_errors']};last_pts={stamps[-1][0]};{sample_feature(p)}"
            )
            times = [{"pts": s[0], "byte_offset": s[1], "random_access": s[2]} for s in stamps]
            rows.append((len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-UNIT:]), len(m), hashlib.sha256(m).hexdigest(), feature, times))
        return pd.DataFrame(rows, columns=["payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "timestamps"])

    return run(media)


def media_table(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes and the media column, written to the shared folder."""
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return stored(docs.select("doc_id", n_bytes.alias("n_bytes"), encoded(F.col("text")).alias("media")), "media", "zstd")


def read_back(media: DataFrame) -> DataFrame:
    """doc_id, n_bytes and everything read from the stored streams.

    Null and empty texts give a stream of one unit of zeros; repeated rows and equal texts give equal
    values; very long texts become more PES packets. Broken streams raise an error.
    """
    return media.select("doc_id", "n_bytes", decoded(F.col("media")).alias("m")).select("doc_id", "n_bytes", "m.*")
