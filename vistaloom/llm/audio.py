"""Audio columns: texts as 8-bit sound, polyphase resampling, log-mel filterbanks and energy segments.

A payload is stored as a mono PCM WAV file of 8-bit samples at RATE. Features come from the file's samples: they are
resampled to FEATURE_RATE, framed, and each frame has a short-time spectrum in MELS bands; frames are grouped into windows
of one fixed shape, each with its time span. Active spans are found with two energy thresholds.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from math import gcd

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vistaloom.llm.common import document_bytes, partitions, passing, saved, scratch, small_batches

UNIT = 576
RATE, FEATURE_RATE = 16_000, 10_000
FRAME, HOP, MELS = 256, 160, 24
#: Frames of a tensor: every window of features has the shape (WINDOW, MELS).
WINDOW = 16
#: Energies, as shares of the loudest frame's, where a span begins and where it ends.
ON, OFF = 0.9, 0.6


def padded(raw: bytes) -> bytes:
    """The payload of a text: its bytes, then bytes 255 up to a positive multiple of UNIT."""
    return raw + b"\xff" * (max(1, -(-len(raw) // UNIT)) * UNIT - len(raw))


def wav(payload: bytes) -> bytes:
    """A WAV file with the payload's bytes as its unsigned 8-bit samples."""
    return struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + len(payload), b"WAVE", b"fmt ", 16, 1, 1, RATE, RATE, 1, 8, b"data", len(payload)) + payload


def samples(file: bytes) -> tuple[int, bytes]:
    """Rate and samples of an 8-bit mono WAV file."""
    if file[:4] != b"RIFF" or file[8:12] != b"WAVE":
        raise ValueError("not a WAV file")
    at, rate = 12, 0
    while at + 8 <= len(file):
        kind, size = struct.unpack_from("<4sI", file, at)
        if kind == b"fmt ":
            code, channels, rate, _, _, bits = struct.unpack_from("<HHIIHH", file, at + 8)
            if (code, channels, bits) != (1, 1, 8):
                raise ValueError("8-bit mono PCM only")
        elif kind == b"data":
            return rate, file[at + 8 : at + 8 + size]
        at += 8 + size + size % 2
    raise ValueError("no samples")


@lru_cache
def polyphase(up: int, down: int, reach: int = 8) -> np.ndarray:
    """A windowed-sinc low-pass cut into `up` phases: row p has the weights of the 2 * reach inputs around a place p / up past one."""
    away = np.arange(1 - reach, reach + 1)[None, :] - np.arange(up)[:, None] / up
    cut = min(1.0, up / down)
    h = cut * np.sinc(cut * away) * np.cos(np.pi * away / (2 * reach)) ** 2
    return (h / h.sum(axis=1, keepdims=True)).astype(np.float32)


def resampled(x: np.ndarray, rate: int, target: int) -> np.ndarray:
    """x at another rate: output k lies at input k * down / up, and the fraction there picks its filter's phase."""
    g = gcd(rate, target)
    up, down = target // g, rate // g
    h = polyphase(up, down)
    reach = h.shape[1] // 2
    n = -(-len(x) * up // down)
    out = np.empty(n, np.float32)
    wide = np.concatenate((np.zeros(reach, np.float32), x, np.zeros(reach + 1, np.float32)))
    views = np.lib.stride_tricks.sliding_window_view(wide, 2 * reach)
    for p in range(min(up, n)):  # outputs p, p + up, ... lie `down` inputs apart and share a phase
        first, phase = divmod(p * down, up)
        out[p::up] = np.einsum("ij,j->i", views[first + 1 :: down][: len(range(p, n, up))], h[phase])
    return out


@lru_cache
def mel_bank() -> np.ndarray:
    """Overlapped triangles, evenly spaced on the mel scale."""
    mel = lambda f: 2595 * np.log10(1 + f / 700)
    edges = 700 * (10 ** (np.linspace(mel(60), mel(FEATURE_RATE / 2), MELS + 2) / 2595) - 1)
    f = np.fft.rfftfreq(FRAME, 1 / FEATURE_RATE)[:, None]
    up, down = (f - edges[:-2]) / (edges[1:-1] - edges[:-2]), (edges[2:] - f) / (edges[2:] - edges[1:-1])
    return np.maximum(0, np.minimum(up, down)).astype(np.float32)


def log_mel(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(frames, MELS) log energies and each frame's energy; the last frame is padded with silence."""
    n = max(1, -(-max(0, len(x) - FRAME) // HOP) + 1)
    wide = np.concatenate((x, np.zeros(max(0, (n - 1) * HOP + FRAME - len(x)), np.float32)))
    frames = np.lib.stride_tricks.sliding_window_view(wide, FRAME)[::HOP][:n]
    window, bank = np.hanning(FRAME).astype(np.float32), mel_bank()
    mels, energy = np.empty((n, MELS), np.float32), np.empty(n, np.float32)
    for k in range(0, n, 1024):  # blocks of frames: memory doesn't grow with the text
        part = frames[k : k + 1024] * window
        power = np.abs(np.fft.rfft(part, axis=1)).astype(np.float32) ** 2
        mels[k : k + 1024] = np.log(power @ bank + np.float32(1e-6))
        energy[k : k + 1024] = (part**2).mean(axis=1)
    return mels, energy


def segments(energy: np.ndarray) -> list[tuple[int, int]]:
    """[start, end) frames of spans that begin above ON times the loudest frame's energy and last until it falls below OFF times."""
    top = float(energy.max(initial=0))
    if top <= 0:
        return []
    mark = np.where(energy >= ON * top, 1, np.where(energy < OFF * top, -1, 0))
    at = np.maximum.accumulate(np.where(mark != 0, np.arange(len(mark)), -1))
    active = np.where(at >= 0, mark[np.maximum(at, 0)], -1) == 1
    edge = np.diff(np.pad(active.astype(np.int8), 1))
    return list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True))


def features(file: bytes) -> tuple[np.ndarray, list[tuple[float, float]], list[tuple[float, float]]]:
    """Of a WAV file: tensors (windows, WINDOW, MELS), each window's time span, and the active spans, in seconds."""
    rate, raw = samples(file)
    x = (np.frombuffer(raw, np.uint8).astype(np.float32) - np.float32(128)) / np.float32(128)
    mels, energy = log_mel(resampled(x, rate, FEATURE_RATE))
    n = -(-len(mels) // WINDOW)
    tensors = np.full((n * WINDOW, MELS), np.log(np.float32(1e-6)), np.float32)
    tensors[: len(mels)] = mels
    step = HOP / FEATURE_RATE
    spans = [(k * WINDOW * step, min((k + 1) * WINDOW, len(mels)) * step) for k in range(n)]
    return tensors.reshape(n, WINDOW, MELS), spans, [(a * step, b * step) for a, b in segments(energy)]


#: Half precision: log energies of 8-bit sound are not known better.
TENSOR = pa.fixed_shape_tensor(pa.float16(), (WINDOW, MELS), dim_names=["frame", "mel"])
SPANS = pa.list_(pa.struct([("start", pa.float64()), ("end", pa.float64())]))
FILE = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("media", pa.large_binary()), ("features", pa.large_list(TENSOR)), ("spans", SPANS), ("active", SPANS)])


def tensor_batch(doc_ids: pa.Array, sizes: pa.Array, files: list[bytes]) -> pa.RecordBatch:
    """Of WAV files, a row each: the file, its feature windows as fixed-shape tensors, each window's time span, and the active spans."""
    found = [features(f) for f in files]
    flat = np.concatenate([t.reshape(-1) for t, *_ in found]).astype(np.float16) if found else np.zeros(0, np.float16)
    windows = pa.ExtensionArray.from_storage(TENSOR, pa.FixedSizeListArray.from_arrays(pa.array(flat), WINDOW * MELS))
    upto = np.cumsum([0, *[len(t) for t, *_ in found]])
    spans, active = ([[{"start": x, "end": y} for x, y in each[k]] for each in found] for k in (1, 2))
    return pa.record_batch([doc_ids, sizes, pa.array(files, pa.large_binary()), pa.LargeListArray.from_arrays(pa.array(upto, pa.int64()), windows), pa.array(spans, SPANS), pa.array(active, SPANS)], schema=FILE)


def media(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, media): every whole text as a WAV file. Null texts are empty, and so one unit of bytes 255."""
    small_batches(docs.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = list(document_bytes(b.column(1)))
            yield pa.record_batch([b.column(0), pa.array(map(len, texts), pa.int64()), pa.array([wav(padded(t)) for t in texts], pa.binary())], names=["doc_id", "n_bytes", "media"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(rows, "doc_id long, n_bytes long, media binary")


SPAN = "struct<start:double,end:double>"


def audio_features(files: DataFrame) -> DataFrame:
    """files with their sound's features; files has a column `media` of WAV files.

    Adds payload (the samples, read back), tensor (all windows' values, WINDOW * MELS each), spans (each window's time span)
    and active (spans of energy). Every value follows from the one file; rows repeat as they come. An empty table gives no
    rows. A null file has null features.
    """
    names = files.columns
    small_batches(files.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.index("media")
        for b in batches:
            payload, tensor, spans, active = [], [], [], []
            for f in b.column(at).to_pylist():
                t, s, a = features(f) if f is not None else (None, None, None)
                payload.append(samples(f)[1] if f is not None else None)
                tensor.append(t if t is None else t.ravel())
                spans.append(s if s is None else [{"start": x, "end": y} for x, y in s])
                active.append(a if a is None else [{"start": x, "end": y} for x, y in a])
            yield pa.record_batch([*b.columns, pa.array(payload, pa.binary()), pa.array(tensor, pa.list_(pa.float32())), pa.array(spans, SPANS), pa.array(active, SPANS)], names=[*names, "payload", "tensor", "spans", "active"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in files.schema.fields)
    return files.mapInArrow(rows, f"{fields}, payload binary, tensor array<float>, spans array<{SPAN}>, active array<{SPAN}>")


def stored(files: DataFrame, folder: str) -> DataFrame:
    """Writes files (doc_id, n_bytes, media) with their features below folder; (file, n_rows) of what was written.

    An Arrow file per task, with one row per row of files in the columns of FILE. Each attempt writes a file of its own, and
    only what a finished task names counts.
    """
    small_batches(files.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(folder)
        fs.create_dir(base, recursive=True)
        name, n = f"part-{TaskContext.get().partitionId():07d}-{uuid.uuid4().hex}.arrow", 0
        with fs.open_output_stream(f"{base}/{name}") as out, pa.ipc.new_file(out, FILE, options=pa.ipc.IpcWriteOptions(compression="zstd")) as to:
            for b in batches:
                to.write_batch(tensor_batch(b.column(0), b.column(1), b.column(2).to_pylist()))
                n += b.num_rows
        if n:
            yield pa.record_batch([pa.array([name]), pa.array([n], pa.int64())], names=["file", "n_rows"])

    return saved(files.select("doc_id", "n_bytes", "media").mapInArrow(rows, "file string, n_rows long"), "audio-files")


def described(files: DataFrame) -> DataFrame:
    """files (doc_id, n_bytes, media) with the digests and features, as text, of what stored() has written.

    feature: windows, the mean of each of four bands of mels, the deviation, and number and length of active spans. Rows
    repeat as they come; equal files have equal values. An empty table gives no rows.
    """
    spark = files.sparkSession
    folder = scratch(spark, "audio")
    written = stored(files, folder).repartitionByRange(partitions(spark), "file")
    passing(spark, folder)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(folder)
        for name in (n for b in batches for n in b.column(0).to_pylist()):
            with fs.open_input_file(f"{base}/{name}") as source, pa.ipc.open_file(source) as read:
                for b in map(read.get_batch, range(read.num_record_batches)):
                    yield summary(b)

    return written.mapInArrow(rows, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def summary(b: pa.RecordBatch) -> pa.RecordBatch:
    """The digests of a batch of FILE's rows."""
    out = []
    tensors, upto = b["features"].values.to_numpy_ndarray(), b["features"].offsets.to_numpy()
    for k, (f, spans, active) in enumerate(zip(b["media"].to_pylist(), b["spans"].to_pylist(), b["active"].to_pylist(), strict=True)):
        _, payload = samples(f)
        t, last = tensors[upto[k] : upto[k + 1]], spans[-1]["end"]
        frames = t.reshape(-1, MELS)[: round(last * FEATURE_RATE / HOP)].astype(np.float64)
        bands = ",".join(f"{x:.3f}" for x in frames.mean(axis=0).reshape(4, -1).mean(axis=1))
        feature = f"{len(t)}x{WINDOW}x{MELS} {last:.3f}s bands={bands} sd={frames.std():.3f} active={len(active)}/{sum(x['end'] - x['start'] for x in active):.3f}s"
        out.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(f), hashlib.sha256(f).hexdigest(), feature))
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    cols = zip(*out, strict=True) if out else [()] * 6
    return pa.record_batch([*b.columns[:2], *[pa.array(c, k) for c, k in zip(cols, types, strict=True)]], names=["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])
