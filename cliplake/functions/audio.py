"""WAV decoding and MFCC clip records as Arrow UDFs, and the filter tables as DataFrames."""

from __future__ import annotations

import io
import math
import wave
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cliplake import schemas
from cliplake.params import AudioParams


#: Bytes of spectra that a task gives out at once.
SPECTRA_BYTES = 4 << 20


def _read_wav(data: bytes) -> tuple[np.ndarray, int]:
    """Samples in file order and the rate: 16-bit or else unsigned 8-bit, over 32768."""
    with wave.open(io.BytesIO(data), "rb") as clip:
        raw = clip.readframes(clip.getnframes())
        kind = np.int16 if clip.getsampwidth() == 2 else np.uint8
        return np.frombuffer(raw, dtype=kind) / 32768.0, clip.getframerate()


def wav_samples(data: Column) -> Column:
    """Rate and samples of a WAV file; an unreadable file gives only ``error``."""

    @F.pandas_udf("struct<sample_rate:int,samples:array<float>,error:string>")
    def apply(files: pd.Series) -> pd.DataFrame:
        rows = []
        for content in files:
            try:
                samples, rate = _read_wav(content)
                rows.append((rate, samples.astype(np.float32), None))
            except (wave.Error, EOFError, TypeError, ValueError) as problem:
                rows.append((None, None, str(problem) or type(problem).__name__))
        return pd.DataFrame(rows, columns=["sample_rate", "samples", "error"])

    return apply(data)


def frame_sizes(sample_rate: int, params: AudioParams = AudioParams()) -> tuple[int, int]:
    """Samples per frame and per hop."""
    return int(params.frame_seconds * sample_rate), int(params.hop_seconds * sample_rate)


def _power_spectrum(samples: np.ndarray, rate: int, params: AudioParams) -> np.ndarray:
    """Power per frame and bin of the pre-emphasised, Hamming-windowed signal."""
    size, hop = frame_sizes(rate, params)
    if not len(samples):
        raise ValueError("clip without samples")
    emphasised = samples.astype(float)
    emphasised[1:] -= params.pre_emphasis * samples[:-1]
    padded = np.pad(emphasised, (0, -len(emphasised) % hop))
    if len(padded) < size:
        raise ValueError("clip shorter than one frame")
    frames = np.lib.stride_tricks.sliding_window_view(padded, size)[::hop] * np.hamming(size)
    return np.abs(np.fft.rfft(frames, n=params.n_fft)) ** 2


def _mel_edges(rate: int, params: AudioParams) -> np.ndarray:
    """Bin numbers of the filter corners, evenly spaced in mel from 0 to half the rate."""
    top = 2595 * math.log10(1 + rate / 2 / 700)
    mels = np.linspace(0, top, params.n_filters + 2)
    hertz = 700 * (10 ** (mels / 2595) - 1)
    return np.floor((params.n_fft + 1) * hertz / rate).astype(int)


def _mel_weights(rate: int, params: AudioParams) -> np.ndarray:
    """Triangular filters, one row each."""
    bins = np.arange(params.n_fft // 2 + 1)
    edges = _mel_edges(rate, params)
    weights = np.zeros((params.n_filters, len(bins)))
    for row, (left, center, right) in enumerate(zip(edges, edges[1:], edges[2:])):
        rise = (bins >= left) & (bins < center)
        fall = (bins >= center) & (bins < right)
        weights[row, rise] = (bins[rise] - left) / max(center - left, 1)
        weights[row, fall] = (right - bins[fall]) / max(right - center, 1)
    return weights


def _dct_weights(params: AudioParams) -> np.ndarray:
    k = np.arange(params.n_mfcc)[:, None]
    n = np.arange(params.n_filters)[None, :]
    return np.cos(np.pi * k * (2 * n + 1) / (2 * params.n_filters))


def _mfcc(
    samples: np.ndarray, rate: int, filters: np.ndarray, params: AudioParams
) -> np.ndarray:
    """MFCC per frame: power, mel filters, log, unnormalised DCT."""
    energies = _power_spectrum(samples, rate, params) @ filters.T
    energies[energies == 0] = np.finfo(float).eps
    return np.log(energies) @ _dct_weights(params).T


def _spectra(
    batches: Iterator[tuple[pd.Series, pd.Series]], params: AudioParams
) -> Iterator[pd.Series]:
    """Spectra of the clips in order, in pieces of about ``SPECTRA_BYTES``: a clip's spectrum is many
    times its samples, so those of a whole batch are never held together."""
    for rates, clips in batches:
        spectra, held = [], 0
        for hertz, clip in zip(rates, clips):
            try:
                power = _power_spectrum(np.asarray(clip, dtype=float), int(hertz), params)
                spectra.append(list(power))
                held += power.nbytes
            except (ValueError, TypeError):
                spectra.append(None)
            if held >= SPECTRA_BYTES:
                yield pd.Series(spectra)
                spectra, held = [], 0
        if spectra:
            yield pd.Series(spectra)


def power_spectrum(rate: Column, samples: Column, params: AudioParams = AudioParams()) -> Column:
    """Power per frame and bin; null for a clip shorter than one frame."""

    @F.pandas_udf("array<array<double>>")
    def apply(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        yield from _spectra(batches, params)

    return apply(rate, samples)


def clip_record(data: Column, params: AudioParams = AudioParams()) -> Column:
    """Placeholder transcript, segment count, duration and mean MFCC of a WAV file.

    A frame counts as speech when its summed squared MFCC is above ``speech_ratio`` times the
    mean of the clip.  A file that fails gives an error transcript and zeros.
    """

    def record(content: bytes, filters: dict[int, np.ndarray]) -> tuple:
        samples, rate = _read_wav(content)
        if rate not in filters:
            filters[rate] = _mel_weights(rate, params)
        mfcc = _mfcc(samples, rate, filters[rate], params)
        energy = (mfcc**2).sum(axis=1)
        speech = energy > energy.mean() * params.speech_ratio
        starts = int(speech[0]) + int((speech[1:] & ~speech[:-1]).sum())
        label = f"[Audio contains approximately {starts} speech segments]"
        return label, starts, len(samples) / rate, mfcc.mean(axis=0), None

    @F.pandas_udf(f"struct<{schemas.CLIP.replace(' ', ':').replace(',:', ',')}>")
    def apply(files: pd.Series) -> pd.DataFrame:
        rows = []
        filters = {}
        for content in files:
            try:
                rows.append(record(content, filters))
            except (wave.Error, EOFError, TypeError, ValueError) as problem:
                reason = str(problem) or type(problem).__name__
                rows.append((f"[Transcription error: {reason}]", 0, 0.0, [], reason))
        names = ["transcript", "num_segments", "duration", "mfcc_features", "error"]
        return pd.DataFrame(rows, columns=names)

    return apply(data)


def mel_filterbank(
    spark: SparkSession, rate: int, params: AudioParams = AudioParams()
) -> DataFrame:
    """Filter weights as rows: filter, bin, weight; every filter has at least one row."""
    top = 2595 * math.log10(1 + rate / 2 / 700)

    def edge(number: Column) -> Column:
        mel = number * F.lit(top / (params.n_filters + 1))
        hertz = 700 * (F.pow(F.lit(10.0), mel / 2595) - 1)
        return F.floor((params.n_fft + 1) * hertz / rate)

    corners = spark.range(params.n_filters).select(
        F.col("id").alias("filter"),
        edge(F.col("id")).alias("left"),
        edge(F.col("id") + 1).alias("center"),
        edge(F.col("id") + 2).alias("right"),
    )
    bins = F.sequence("left", F.greatest(F.col("left"), F.col("right") - 1))
    rise = F.try_divide(F.col("bin") - F.col("left"), F.col("center") - F.col("left"))
    fall = F.try_divide(F.col("right") - F.col("bin"), F.col("right") - F.col("center"))
    return corners.select("*", F.explode(bins).alias("bin")).select(
        "filter",
        "bin",
        F.when(F.col("bin") < F.col("center"), rise)
        .when(F.col("bin") < F.col("right"), fall)
        .otherwise(0.0)
        .alias("weight"),
    )


def dct_basis(spark: SparkSession, params: AudioParams = AudioParams()) -> DataFrame:
    """DCT-II factors as rows: k, n, factor."""
    cells = spark.range(params.n_mfcc * params.n_filters).select(
        F.floor(F.col("id") / params.n_filters).alias("k"),
        (F.col("id") % params.n_filters).alias("n"),
    )
    angle = F.col("k") * (2 * F.col("n") + 1) * F.lit(math.pi / (2 * params.n_filters))
    return cells.withColumn("factor", F.cos(angle))


def mel_energies(spectra: DataFrame, filters: DataFrame) -> DataFrame:
    """Energy per clip, frame and filter from rows of (clip, frame, power array).

    ``filters`` is the filter table: at most n_filters * (n_fft / 2 + 1) rows.  Filters without
    any energy get the machine epsilon.
    """
    rows = spectra.select("clip", "frame", F.posexplode("power").alias("bin", "power"))
    summed = (
        rows.join(F.broadcast(filters), "bin")
        .groupBy("clip", "frame", "filter")
        .agg(F.sum(F.col("power") * F.col("weight")).alias("energy"))
    )
    floor = F.lit(float(np.finfo(float).eps))
    return summed.withColumn(
        "energy", F.when(F.col("energy") == 0, floor).otherwise(F.col("energy"))
    )


def cepstrum(energies: DataFrame, basis: DataFrame) -> DataFrame:
    """MFCC per clip, frame and coefficient from mel energies.

    ``basis`` is the DCT table: n_mfcc * n_filters rows.
    """
    logs = energies.select("clip", "frame", F.col("filter").alias("n"), F.ln("energy").alias("log"))
    return (
        logs.join(F.broadcast(basis), "n")
        .groupBy("clip", "frame", "k")
        .agg(F.sum(F.col("log") * F.col("factor")).alias("mfcc"))
    )
