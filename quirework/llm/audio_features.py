"""Audio features of media columns: polyphase resampling, overlapped log-mel filterbanks, hysteresis energy segments.

A payload is stored losslessly as a WAV file of 8-bit mono samples. Features come from the stored bytes:
resampling from 16 kHz to 12 kHz by a windowed-sinc filter in its three phases; frames of 36 ms every 12 ms under a Hann window; 32 log-mel
bands; and segments of activity, which start where a frame's energy rises above a high threshold and last until it falls below
a low one (both relative to the recording's median). Frames are kept as float32 tensors of a fixed shape (16 frames of 32 bands, the last padded with the floor), each with its
time span. Their values are rounded to steps of 1 / STEPS, at most half a step (0.002) from the unrounded ones, and all features are taken from the rounded ones; as_tensors() gives them Arrow's fixed-shape tensor type.

Each recording is computed by itself, in chunks of frames of one fixed size, so equal bytes give equal features and a very long recording takes
bounded memory beyond its bytes. A null or empty text becomes one block of padding.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, text_slices, written

RATE = 16_000
UP, DOWN, TAPS = 3, 4, 16
FRAME, HOP, FFT, MELS = 432, 144, 512, 32
SHAPE = (16, MELS)
UNIT, PAD = 576, 255
FLOOR = 1e-8
#: Steps of a band's logarithm to base 10: the values that tensors hold are whole numbers of them, some 0.04 dB each.
STEPS = 256
RISE, FALL = 3.0, 1.0
CHUNK = 1024


def to_wav(payload: bytes, rate: int = RATE) -> bytes:
    """8-bit unsigned mono PCM. The payload has an even number of bytes."""
    return struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + len(payload), b"WAVE", b"fmt ", 16, 1, 1, rate, rate, 1, 8, b"data", len(payload)) + payload


def from_wav(wav: bytes) -> tuple[int, bytes]:
    """Rate and samples, from whichever chunks the file has."""
    if wav[:4] != b"RIFF" or wav[8:12] != b"WAVE":
        raise ValueError("not a WAV file")
    at, rate = 12, 0
    while at + 8 <= len(wav):
        name, size = struct.unpack_from("<4sI", wav, at)
        if name == b"fmt ":
            kind, channels, rate, _, _, bits = struct.unpack_from("<HHIIHH", wav, at + 8)
            if (kind, channels, bits) != (1, 1, 8):
                raise ValueError("not 8-bit mono PCM")
        elif name == b"data":
            return rate, wav[at + 8 : at + 8 + size]
        at += 8 + size + size % 2
    raise ValueError("no samples")


def _phases() -> np.ndarray:
    """The low-pass filter of the resampler, one row a phase."""
    n = UP * TAPS
    t = np.arange(n) - (n - 1) / 2
    h = np.sinc(t / DOWN) * np.kaiser(n, 8.0)
    return (h * UP / h.sum()).reshape(TAPS, UP).T[:, ::-1].astype(np.float32).copy()


def _mel_bank() -> np.ndarray:
    mel = lambda f: 2595 * np.log10(1 + f / 700)
    edges = 700 * (10 ** (np.linspace(0, mel(RATE * UP / DOWN / 2), MELS + 2) / 2595) - 1)
    at = np.arange(FFT // 2 + 1) * (RATE * UP / DOWN / FFT)
    up = (at[:, None] - edges[:-2]) / (edges[1:-1] - edges[:-2])
    down = (edges[2:] - at[:, None]) / (edges[2:] - edges[1:-1])
    return np.maximum(0, np.minimum(up, down)).astype(np.float32)


PHASES, BANK, HANN = _phases(), _mel_bank(), np.hanning(FRAME).astype(np.float32)


def resample(x: np.ndarray) -> np.ndarray:
    """By UP / DOWN: output m is phase m*DOWN mod UP of the filter over the TAPS inputs up to m*DOWN // UP. Only outputs that are kept are computed."""
    n = len(x) * UP // DOWN
    x = np.concatenate([np.zeros(TAPS - 1, np.float32), x])
    windows = np.lib.stride_tricks.sliding_window_view(x, TAPS)
    out = np.empty(n, np.float32)
    for m in range(UP):
        mine = out[m::UP]
        mine[:] = windows[m * DOWN // UP :: DOWN][: len(mine)] @ PHASES[m * DOWN % UP]
    return out


def log_mel(samples: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Log-mel bands (frames x MELS) and energy in dB of each frame."""
    x = resample((np.frombuffer(samples, np.uint8).astype(np.float32) - 128) / 128)
    frames = np.lib.stride_tricks.sliding_window_view(x, FRAME)[::HOP]
    bands, energy = [], []
    for i in range(0, len(frames), CHUNK):
        f = frames[i : i + CHUNK]
        energy.append(10 * np.log10(np.einsum("ij,ij->i", f, f) / FRAME + FLOOR))
        spectrum = np.fft.rfft(f * HANN, FFT)
        bands.append(np.round(np.log10((spectrum.real**2 + spectrum.imag**2).astype(np.float32) @ BANK + FLOOR) * STEPS) / np.float32(STEPS))
    return np.concatenate(bands), np.concatenate(energy)


def segments(energy: np.ndarray) -> np.ndarray:
    """(first frame, end) of each stretch that rises RISE dB above the median and lasts until FALL dB above it."""
    middle = np.median(energy)
    mark = np.where(energy >= middle + RISE, 1, np.where(energy < middle + FALL, -1, 0))
    last = np.maximum.accumulate(np.where(mark != 0, np.arange(len(mark)), -1))
    on = np.where(last >= 0, mark[np.maximum(last, 0)], -1) == 1
    edge = np.diff(np.concatenate([[0], on.astype(np.int8), [0]]))
    return np.stack([np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)], axis=1)


def seconds(frame: int) -> float:
    return frame * HOP / (RATE * UP / DOWN)


def tensors(bands: np.ndarray) -> np.ndarray:
    """Frames in tensors of SHAPE."""
    n = -(-len(bands) // SHAPE[0])
    out = np.full((n * SHAPE[0], MELS), np.log10(FLOOR), np.float32)
    out[: len(bands)] = bands
    return out.reshape(n, *SHAPE)


def payload_of(text: bytes) -> bytes:
    return text + bytes([PAD]) * (max(UNIT, -(-len(text) // UNIT) * UNIT) - len(text))


def _store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, data, off in text_slices(batch, "text"):
            raw = data.tobytes()
            media = [to_wav(payload_of(raw[a:b])) for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
            yield pa.record_batch([rows.column("doc_id"), pa.array(np.diff(off)), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "media"])


def store_media(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, media: a table of WAV files in the shared folder, read back from there."""
    return written(docs.select("doc_id", "text").mapInArrow(_store, "doc_id long, n_bytes long, media binary"), "media")


def _parts(bands: np.ndarray, spans: np.ndarray) -> tuple[pa.Array, pa.Array, pa.Array, pa.Array]:
    """The tensors of a recording: start_s, end_s, active, log_mel of each."""
    found = tensors(bands)
    n = len(found)
    first = np.arange(n) * SHAPE[0]
    last = np.minimum(first + SHAPE[0], len(bands)) - 1
    active = [float(np.clip(np.minimum(spans[:, 1], b + 1) - np.maximum(spans[:, 0], a), 0, None).sum() / (b + 1 - a)) for a, b in zip(first, last, strict=True)]
    values = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * SHAPE[0] * MELS), pa.array(found.ravel()))
    return pa.array([seconds(a) for a in first]), pa.array([seconds(b) + FRAME / (RATE * UP / DOWN) for b in last]), pa.array(active), values


def _tensor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for doc_id, media in zip(batch.column("doc_id"), batch.column("media"), strict=True):
            bands, energy = log_mel(from_wav(media.as_py())[1])
            parts = _parts(bands, segments(energy))
            n = len(parts[0])
            yield pa.record_batch([pa.array([doc_id.as_py()] * n, pa.int64()), pa.array(np.arange(n, dtype=np.int32)), *parts], names=["doc_id", "nth", "start_s", "end_s", "active", "log_mel"])


def audio_tensors(media: DataFrame) -> DataFrame:
    """One row a tensor: doc_id, nth, start_s, end_s, active (share of its frames in segments), log_mel (SHAPE, flat)."""
    return media.select("doc_id", "media").mapInArrow(_tensor_rows, "doc_id long, nth int, start_s double, end_s double, active double, log_mel array<float>")


def as_tensors(table: pa.Table) -> pa.Table:
    """The Arrow table of audio_tensors() with log_mel as Arrow's fixed-shape tensors."""
    flat = table.column("log_mel").combine_chunks()
    flat = flat.chunk(0) if isinstance(flat, pa.ChunkedArray) else flat
    kind = pa.fixed_shape_tensor(pa.float32(), SHAPE)
    held = pa.FixedSizeListArray.from_arrays(flat.flatten().cast(pa.float32()), SHAPE[0] * MELS)
    return table.set_column(table.schema.get_field_index("log_mel"), "log_mel", pa.ExtensionArray.from_storage(kind, held))


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "n_frames", "n_segments", "active_s"]
    for batch in batches:
        rows = []
        for media in batch.column("media"):
            wav = media.as_py()
            _, samples = from_wav(wav)
            bands, energy = log_mel(samples)
            spans = segments(energy)
            active = round(float(sum(seconds(b - a) for a, b in spans)), 3)
            shown = " ".join(f"{v:.2f}" for v in [*bands.mean(axis=0, dtype=np.float64), energy.mean(dtype=np.float64), len(spans), active])
            rows.append((len(samples), hashlib.sha256(samples).hexdigest(), zlib.crc32(samples[-32:]), len(wav), hashlib.sha256(wav).hexdigest(), shown, len(bands), len(spans), active))
        columns = [pa.array(c) for c in zip(*rows, strict=True)]
        yield pa.record_batch([batch.column("doc_id"), batch.column("n_bytes"), *columns], names=names)


_PARTS = "array<struct<start_s:double,end_s:double,active:double,log_mel:array<float>>>"


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "energy", "spans", "tensors"]
    for batch in batches:
        for i in range(batch.num_rows):
            one = batch.slice(i, 1)
            wav = one.column("media")[0].as_py()
            _, samples = from_wav(wav)
            bands, energy = log_mel(samples)
            spans = segments(energy)
            parts = pa.StructArray.from_arrays(_parts(bands, spans), ["start_s", "end_s", "active", "log_mel"])
            row = [len(samples), hashlib.sha256(samples).hexdigest(), zlib.crc32(samples[-32:]), len(wav), hashlib.sha256(wav).hexdigest()]
            lists = [pa.array([energy], pa.list_(pa.float32())), pa.array([spans.ravel()], pa.list_(pa.int64())), pa.ListArray.from_arrays(pa.array([0, len(parts)], pa.int32()), parts)]
            yield pa.record_batch([one.column("doc_id"), one.column("n_bytes"), *(pa.array([x]) for x in row), *lists], names=names)


def stored_tensors(media: DataFrame) -> DataFrame:
    """One row a recording, written and read back: digests, energy of each frame, spans (first frame and end of each segment, flat), and its tensors with their time spans."""
    return written(media.mapInArrow(_keep, f"doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, energy array<float>, spans array<long>, tensors {_PARTS}"), "tensors")


def _from_tensors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    same = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256"]
    for batch in batches:
        rows = []
        for energy, spans, parts in zip(batch.column("energy"), batch.column("spans"), batch.column("tensors"), strict=True):
            energy, spans = energy.values.to_numpy(), spans.values.to_numpy().reshape(-1, 2)
            held = as_tensors(pa.table({"log_mel": parts.values.field("log_mel")})).column("log_mel").combine_chunks()
            held = held.chunk(0) if isinstance(held, pa.ChunkedArray) else held
            bands = held.to_numpy_ndarray().reshape(-1, MELS)[: len(energy)]
            active = round(float(sum(seconds(b - a) for a, b in spans)), 3)
            shown = " ".join(f"{v:.2f}" for v in [*bands.mean(axis=0, dtype=np.float64), energy.mean(dtype=np.float64), len(spans), active])
            rows.append((shown, len(bands), len(spans), active))
        columns = [pa.array(c) for c in zip(*rows, strict=True)] if rows else [pa.array([], t) for t in (pa.string(), pa.int64(), pa.int64(), pa.float64())]
        yield pa.record_batch([*(batch.column(c) for c in same), *columns], names=[*same, "feature", "n_frames", "n_segments", "active_s"])


def op9_audio_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = stored_tensors(store_media(documents(spark, sf_dir)))
    return kept.mapInArrow(_from_tensors, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, n_frames long, n_segments long, active_s double")
