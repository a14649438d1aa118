"""Telephony audio columns: mu-law, A-law and IMA ADPCM in WAVE, expanded to 16-bit samples, resampled and stored as PCM.

The G.711 laws are expanded by 256-entry tables built from their segment rule.
ADPCM blocks are decoded together: one numpy step for the k-th nibble of all
blocks of a batch. Resampling doubles the rate with an integer half-band filter, so that
results are the same on every machine.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import map_arrow, only

PCM, A_LAW, MU_LAW, IMA = 1, 6, 7, 17
UNIT, RATE = 192, 8000
#: Fixed values of IMA ADPCM: the change of the step index by the code's lower three bits.
INDEX_CHANGE = np.array([-1, -1, -1, -1, 2, 4, 6, 8] * 2, np.int32)
#: Half-band taps at odd distances 1, 3, 5, 7 from the new sample, in 1/32768.
TAPS = (20475, -5615, 2019, -495)


def mu_law_table() -> np.ndarray:
    code = ~np.arange(256) & 0xFF
    size = ((((code & 15) << 3) + 132) << ((code >> 4) & 7)) - 132
    return np.where(code & 128, -size, size).astype(np.int16)


def a_law_table() -> np.ndarray:
    code = np.arange(256) ^ 0x55
    segment, low = (code >> 4) & 7, ((code & 15) << 4) + 8
    size = np.where(segment == 0, low, (low + 256) << np.maximum(segment - 1, 0))
    return np.where(code & 128, size, -size).astype(np.int16)


def step_table() -> np.ndarray:
    """Step sizes of IMA ADPCM: from 7, each about a tenth above the last, as the format rounds them."""
    #: fixed values
    return np.array([7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45, 50, 55, 60, 66, 73, 80, 88, 97, 107, 118, 130, 143, 157, 173, 190, 209, 230, 253, 279, 307, 337, 371, 408, 449, 494, 544, 598, 658, 724, 796, 876, 963, 1060, 1166, 1282, 1411, 1552, 1707, 1878, 2066, 2272, 2499, 2749, 3024, 3327, 3660, 4026, 4428, 4871, 5358, 5894, 6484, 7132, 7845, 8630, 9493, 10442, 11487, 12635, 13899, 15289, 16818, 18500, 20350, 22385, 24623, 27086, 29794, 32767], np.int32)


MU, A, STEPS = mu_law_table(), a_law_table(), step_table()


def decode_ima(blocks: np.ndarray) -> np.ndarray:
    """Samples of mono IMA ADPCM blocks (blocks, bytes): the header's one and two for each byte after it. All blocks advance together, nibble by nibble."""
    n, size = blocks.shape
    head = np.ascontiguousarray(blocks[:, :2]).view("<i2").reshape(-1).astype(np.int32)
    index = np.minimum(blocks[:, 2].astype(np.int32), 88)
    out = np.empty((1 + 2 * (size - 4), n), np.int16)
    value = head.copy()
    out[0] = value
    for k, byte in enumerate(np.ascontiguousarray(blocks[:, 4:].T)):
        for shift in (0, 4):
            code = ((byte >> shift) & 15).astype(np.int32)
            step = STEPS[index]
            change = step >> 3
            change += (step >> 2) * (code & 1)
            change += (step >> 1) * (code >> 1 & 1)
            change += step * (code >> 2 & 1)
            value += np.where(code & 8, -change, change)
            np.clip(value, -32768, 32767, out=value)
            index += INDEX_CHANGE[code]
            np.clip(index, 0, 88, out=index)
            out[1 + 2 * k + (shift > 0)] = value
    return out.T


def wave(data: bytes, kind: int, rate: int = RATE, block: int = UNIT) -> bytes:
    """A mono WAVE file of stored bytes of the named kind."""
    align, bits = {PCM: (2, 16), A_LAW: (1, 8), MU_LAW: (1, 8), IMA: (block, 4)}[kind]
    fmt = struct.pack("<HHIIHH", kind, 1, rate, rate * align if kind != IMA else rate * block // (1 + 2 * (block - 4)), align, bits)
    if kind != PCM:
        fmt += struct.pack("<HH", 2, 1 + 2 * (block - 4)) if kind == IMA else struct.pack("<H", 0)
    chunks = b"fmt " + struct.pack("<I", len(fmt)) + fmt + b"data" + struct.pack("<I", len(data)) + data + b"\0" * (len(data) & 1)
    return b"RIFF" + struct.pack("<I", 4 + len(chunks)) + b"WAVE" + chunks


def read_wave(media: bytes | None) -> tuple[int, int, int, bytes] | None:
    """Kind, rate, block size and stored bytes; None for what is no WAVE file with a format and data. A data chunk that ends early is read as far as it goes."""
    if not media or media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        return None
    at, fmt = 12, None
    while at + 8 <= len(media):
        name, size = media[at : at + 4], struct.unpack_from("<I", media, at + 4)[0]
        if name == b"fmt " and size >= 16 and at + 24 <= len(media):
            fmt = struct.unpack_from("<HHIIHH", media, at + 8)
        elif name == b"data" and fmt:
            return fmt[0], fmt[2], fmt[4], media[at + 8 : at + 8 + size]
        at += 8 + size + (size & 1)
    return None


def doubled(samples: np.ndarray) -> np.ndarray:
    """Twice the rate: old samples, and between them the half-band filter's; silence around the ends."""
    if not len(samples):
        return samples.astype(np.int16)
    x = np.zeros(len(samples) + 8, np.int32)
    x[3:-5] = samples
    n = len(samples)
    between = np.full(n, 1 << 14, np.int32)
    for k, tap in enumerate(TAPS):
        between += (x[3 - k : 3 - k + n] + x[4 + k : 4 + k + n]) * tap
    out = np.empty(2 * n, np.int16)
    out[::2] = samples
    out[1::2] = np.clip(between >> 15, -32768, 32767)
    return out


def decoded(files: list[bytes | None]) -> list[tuple[int, np.ndarray] | None]:
    """Rate and 16-bit samples of every file, None for what is none. Compressed blocks of equal size of all files are decoded in one go; a last, shorter block is padded with zeros and its surplus cut."""
    read = [read_wave(f) for f in files]
    out: list = [None] * len(files)
    ima: dict[int, list[int]] = {}
    for i, r in enumerate(read):
        if r is None:
            continue
        kind, rate, align, data = r
        raw = np.frombuffer(data, np.uint8)
        if kind == MU_LAW:
            out[i] = rate, MU[raw]
        elif kind == A_LAW:
            out[i] = rate, A[raw]
        elif kind == PCM:
            out[i] = rate, np.frombuffer(data[: len(data) // 2 * 2], "<i2")
        elif kind == IMA and align > 4:
            ima.setdefault(align, []).append(i)
    for align, members in ima.items():
        counts = [-(-len(read[i][3]) // align) for i in members]
        flat = np.frombuffer(b"".join(read[i][3].ljust(c * align, b"\0") for i, c in zip(members, counts, strict=True)), np.uint8).reshape(-1, align)
        samples, at = decode_ima(flat) if len(flat) else np.zeros((0, 1 + 2 * (align - 4)), np.int16), 0
        for i, c in zip(members, counts, strict=True):
            short = c * align - len(read[i][3])
            own = samples[at : at + c].reshape(-1)
            out[i] = read[i][1], own[: max(0, len(own) - 2 * min(short, align - 4) - (short > align - 4))]
            at += c
    return out


def to_pcm(media: DataFrame, column: str = "media", key: str = "doc_id") -> DataFrame:
    """key and pcm: the file in `column`, expanded and resampled to twice its rate, as a 16-bit WAVE file. Null where the column is null or no readable file; repeated rows stay, an empty table gives no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                pcm = [None if x is None else wave(doubled(x[1]).tobytes(), PCM, 2 * x[0]) for x in decoded(part.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(pcm, pa.binary())], [key, "pcm"])

    return map_arrow(only(media, **{key: key, "media": column}).select(F.col(key).cast("long"), F.col("media").cast("binary")), run, f"{key} bigint, pcm binary")


def store_pcm(media: DataFrame, path: str, column: str = "media", key: str = "doc_id") -> None:
    """Writes to_pcm() of every row as Parquet."""
    to_pcm(media, column, key).write.option("compression", "zstd").parquet(path)


def payload(text: bytes) -> bytes:
    """The text's bytes with spaces up to a positive multiple of UNIT."""
    return text.ljust(max(UNIT, -(-len(text) // UNIT) * UNIT), b" ")


def store(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, n_bytes and media: every whole text (null: empty) as the stored bytes of a mu-law file at 8 kHz. Repeated rows stay, an empty table gives no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                raw = [x or b"" for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(x) for x in raw], pa.int64()), pa.array([wave(payload(x), MU_LAW) for x in raw], pa.binary())], ["doc_id", "n_bytes", "media"])

    return map_arrow(only(docs, doc_id="doc_id", text=text).select(F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary").alias("text")), run, "doc_id bigint, n_bytes bigint, media binary")


def summary(samples: np.ndarray) -> str:
    """Of 16-bit samples: count, mean level, peak, sign changes and the crc32 of the samples."""
    if not len(samples):
        return "0:0:0:0:0"
    level = int(np.sqrt(np.mean(samples.astype(np.float64) ** 2)))
    return f"{len(samples)}:{level}:{int(np.abs(samples.astype(np.int32)).max())}:{int(np.count_nonzero(np.diff(samples >= 0)))}:{zlib.crc32(samples.tobytes())}"


def analysed(stored: DataFrame) -> DataFrame:
    """Digests of stored files: the payload read back, and as `feature` summaries of the PCM, resampled to twice the rate, of the file by mu-law (as stored), and of the same bytes as an A-law and as an ADPCM file. Repeated rows stay, an empty table gives no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                media = part.column(2).to_pylist()
                data = [read_wave(m)[3] for m in media]
                by = [decoded(media), decoded([wave(d, A_LAW) for d in data]), decoded([wave(d, IMA) for d in data])]
                feature = [f"mu {summary(doubled(m[1]))} a {summary(doubled(a[1]))} ima {summary(doubled(x[1]))}" for m, a, x in zip(*by, strict=True)]
                sha = lambda xs: pa.array([hashlib.sha256(x).hexdigest() for x in xs])
                size = lambda xs: pa.array([len(x) for x in xs], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), size(data), sha(data), pa.array([zlib.crc32(d[-16:]) for d in data], pa.int64()), size(media), sha(media), pa.array(feature)], names)

    return map_arrow(stored, run, "doc_id bigint, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string")
