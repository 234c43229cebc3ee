"""Audio columns: lossless 8-bit PCM storage, polyphase resampling, log-mel filterbanks, hysteresis segmentation.

``store`` turns texts into sound files (a WAV container of 8-bit mono samples), ``analyse`` reads the stored bytes back:
samples are resampled by a polyphase filter, cut into overlapping frames, turned into log-mel energies, and segmented by
frame energy with two thresholds (a segment starts above the upper and lasts until the lower). Segments are stored as
fixed-shape Arrow tensors, FRAMES x MELS each, padded with the floor, with the time span that each covers.

All steps work in blocks of frames whose places depend on the file alone, so memory stays bounded however long a
file is, and equal texts give equal values wherever they run.

Defined cases: a null text is stored as an empty payload, padded like any other; a null file is left out by ``analyse``. A file
shorter than a frame is padded to one. A flat file has no segment and an empty tensor list. Files of any length are read
whole. Repeated rows get equal values. Extra columns stay, whatever their names; the result columns' are replaced. An empty table
gives an empty table.
"""

from __future__ import annotations

import hashlib
import io
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import any_names, fresh

PAD_BYTE, PAD_TO = 255, 576
RATE, UP, DOWN = 16_000, 3, 4
HALF_TAPS = 8
#: At 12,000 samples a second: windows of 20 ms, a new one every 10 ms.
WINDOW, HOP, FFT, MELS = 240, 120, 256, 40
FRAMES = 32
#: Frames worked on at once.
BLOCK = 1024
FLOOR = 1e-10
#: Upper and lower threshold in dB over the file's median frame energy.
ON_DB, OFF_DB = 1.0, -1.0
#: Rows of an Arrow batch worked on, and sent on, at once.
ROWS = 64


def payload(text: str | None) -> bytes:
    data = (text or "").encode()
    return data + bytes([PAD_BYTE]) * (-len(data) % PAD_TO if data else PAD_TO)


def wav(samples: bytes, rate: int = RATE) -> bytes:
    """An 8-bit unsigned mono WAV file of these samples."""
    n = len(samples)
    head = b"RIFF" + struct.pack("<I", 36 + n + n % 2) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, rate, rate, 1, 8)
    return head + b"data" + struct.pack("<I", n) + samples + b"\0" * (n % 2)


def samples_of(media: bytes) -> tuple[bytes, int]:
    """(samples, rate) of a file that wav() wrote; other chunks are passed over."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a WAV file")
    at, rate = 12, RATE
    while at + 8 <= len(media):
        name, n = media[at : at + 4], struct.unpack_from("<I", media, at + 4)[0]
        if name == b"fmt ":
            kind, channels, rate, _, _, bits = struct.unpack_from("<HHIIHH", media, at + 8)
            if (kind, channels, bits) != (1, 1, 8):
                raise ValueError("8-bit mono PCM is read here")
        elif name == b"data":
            return media[at + 8 : at + 8 + n], rate
        at += 8 + n + n % 2
    raise ValueError("no samples")


@lru_cache
def phases(up: int, down: int) -> np.ndarray:
    """One row of filter taps for each of the ``up`` phases of a Kaiser-windowed sinc at the lower Nyquist rate."""
    wide = max(up, down)
    half = HALF_TAPS * wide
    k = np.arange(-half, half + 1)
    taps = np.sinc(k / wide) / wide * np.kaiser(2 * half + 1, 8.0) * up
    rows = -(-taps.size // up)
    return np.pad(taps, (0, rows * up - taps.size)).reshape(rows, up).T[:, ::-1].astype(np.float32)


def resample(x: np.ndarray, first: int, n: int, up: int = UP, down: int = DOWN) -> np.ndarray:
    """Samples first to first + n of x resampled by up / down; x counts as zero outside."""
    bank = phases(up, down)
    taps, out = bank.shape[1], np.empty(n, np.float32)
    center = HALF_TAPS * max(up, down)
    at = lambda m: (m * down + center) // up
    lo, hi = at(first) - taps + 1, at(first + n - 1) + 1
    piece = np.zeros(hi - lo, np.float32)
    a, b = max(lo, 0), min(hi, x.size)
    if b > a:
        piece[a - lo : b - lo] = x[a:b]
    windows = np.lib.stride_tricks.sliding_window_view(piece, taps)
    for k in range(min(up, n)):  # every up-th sample has one phase, and its inputs lie ``down`` apart
        m = first + k
        out[k::up] = windows[at(m) - taps + 1 - lo :: down][: len(range(k, n, up))] @ bank[(m * down + center) % up]
    return out


@lru_cache
def mel_bank(rate: int) -> np.ndarray:
    """Triangular filters, MELS columns over FFT // 2 + 1 bins, evenly spaced in mel up to the Nyquist rate."""
    mel = lambda f: 2595.0 * np.log10(1.0 + f / 700.0)
    edges = 700.0 * (10.0 ** (np.linspace(0.0, mel(rate / 2), MELS + 2) / 2595.0) - 1.0)
    bins = np.linspace(0.0, rate / 2, FFT // 2 + 1)[:, None]
    low, mid, high = edges[:-2], edges[1:-1], edges[2:]
    return np.clip(np.minimum((bins - low) / (mid - low), (high - bins) / (high - mid)), 0.0, None).astype(np.float32)


def log_mel(samples: bytes, rate: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(frames x MELS log energies, frame energies in dB, frames a second)."""
    x = (np.frombuffer(samples, np.uint8).astype(np.float32) - 128.0) / 128.0
    new_rate = rate * UP / DOWN
    total = max(1, -(-x.size * UP // DOWN))
    n = 1 + -(-max(0, total - WINDOW) // HOP)  # the last frame is padded with silence
    bank, hann = mel_bank(int(new_rate)), np.hanning(WINDOW).astype(np.float32)
    mels, energy = np.empty((n, MELS), np.float32), np.empty(n, np.float32)
    for at in range(0, n, BLOCK):
        m = min(BLOCK, n - at)
        y = resample(x, at * HOP, (m - 1) * HOP + WINDOW)
        frames = np.lib.stride_tricks.sliding_window_view(y, WINDOW)[::HOP]
        power = np.abs(np.fft.rfft(frames * hann, FFT)) ** 2
        mels[at : at + m] = np.log(np.maximum(power.astype(np.float32) @ bank, FLOOR))
        energy[at : at + m] = 10.0 * np.log10(np.maximum(np.square(frames).mean(axis=1), FLOOR))
    return mels, energy, new_rate / HOP


def segments(energy: np.ndarray) -> list[tuple[int, int]]:
    """Frame ranges [start, end): from a frame above the upper threshold until one is below the lower."""
    level = float(np.median(energy))
    state = np.zeros(energy.size, np.int8)
    state[energy > level + ON_DB], state[energy < level + OFF_DB] = 1, -1
    told = np.maximum.accumulate(np.where(state != 0, np.arange(energy.size), -1))
    active = np.where(told >= 0, state[told], -1) == 1
    edges = np.flatnonzero(np.diff(np.r_[False, active, False].astype(np.int8)))
    return [(int(a), int(b)) for a, b in edges.reshape(-1, 2)]


def tensor_type() -> pa.DataType:
    return pa.fixed_shape_tensor(pa.float32(), (FRAMES, MELS), dim_names=("frame", "mel"))


def tensors(samples: bytes, rate: int) -> pa.RecordBatch:
    """One row for each FRAMES frames of a segment: segment, start_s, end_s and the tensor, quantised to 1/1024."""
    mels, energy, per_second = log_mel(samples, rate)
    spans = [(k, at, min(at + FRAMES, b)) for k, (a, b) in enumerate(segments(energy)) for at in range(a, b, FRAMES)]
    data = np.full((len(spans), FRAMES, MELS), np.float32(np.log(FLOOR)))
    for row, (_, a, b) in zip(data, spans):
        row[: b - a] = mels[a:b]
    data = np.round(data * 1024.0) / np.float32(1024.0)
    storage = pa.FixedSizeListArray.from_arrays(pa.array(data.reshape(-1)), FRAMES * MELS)
    end = lambda b: (b * HOP + WINDOW - HOP) / (per_second * HOP)
    columns = [pa.array([k for k, _, _ in spans], pa.int32()), pa.array([a / per_second for _, a, _ in spans], pa.float64()), pa.array([end(b) for _, _, b in spans], pa.float64())]
    return pa.RecordBatch.from_arrays([*columns, pa.ExtensionArray.from_storage(tensor_type(), storage)], names=["segment", "start_s", "end_s", "log_mel"])


def ipc(batch: pa.RecordBatch) -> bytes:
    out = io.BytesIO()
    with pa.ipc.new_stream(out, batch.schema) as writer:
        writer.write_batch(batch)
    return out.getvalue()


def tensors_from(features: bytes) -> pa.Table:
    """What ``analyse`` stored in a row's features, with the tensor column as fixed-shape tensors."""
    return pa.ipc.open_stream(features).read_all()


def _mapped(df: DataFrame, source: str, outputs: list[tuple[str, str, pa.DataType]], make, cast: pa.DataType, drop_source: bool) -> DataFrame:
    df = df.drop(*[n for n, _, _ in outputs])
    kept = [c for c in df.columns if not (drop_source and c == source)]
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                made = [make(v.as_py()) for v in batch.column(batch.num_columns - 1).cast(cast)]
                arrays = [pa.array([m[k] for m in made], kind) for k, (_, _, kind) in enumerate(outputs)]
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *arrays], names=[*kept, *[n for n, _, _ in outputs]])

    schema = ", ".join([f"`{c}` {types[c]}" for c in kept] + [f"`{n}` {t}" for n, t, _ in outputs])
    return df.select(*kept, df[source].alias(fresh(df, "_source_value")[0])).mapInArrow(run, schema)


@any_names
def store(docs: DataFrame, text: str = "text", keep_text: bool = True) -> DataFrame:
    """docs with n_bytes (of the text, unpadded) and media, the WAV file."""

    def make(value: str | None) -> tuple[int, bytes]:
        return len((value or "").encode()), wav(payload(value))

    return _mapped(docs, text, [("n_bytes", "bigint", pa.int64()), ("media", "binary", pa.binary())], make, pa.string(), not keep_text)


@any_names
def analyse(media: DataFrame, column: str = "media", keep_media: bool = True) -> DataFrame:
    """Rows with payload_bytes, payload_sha256, tail_crc32 (of the samples read back), media_bytes, media_sha256 and
    features: an Arrow stream of fixed-shape tensors with their time spans (see tensors_from)."""

    def make(value: bytes) -> tuple:
        samples, rate = samples_of(value)
        sha = lambda b: hashlib.sha256(b).hexdigest()
        return len(samples), sha(samples), zlib.crc32(samples[-32:]), len(value), sha(value), ipc(tensors(samples, rate))

    outputs = [("payload_bytes", "bigint", pa.int64()), ("payload_sha256", "string", pa.string()), ("tail_crc32", "bigint", pa.int64()), ("media_bytes", "bigint", pa.int64()), ("media_sha256", "string", pa.string()), ("features", "binary", pa.binary())]
    return _mapped(media.where(media[column].isNotNull()), column, outputs, make, pa.binary(), not keep_media)
