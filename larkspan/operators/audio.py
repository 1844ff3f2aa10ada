"""PCM wave data in columns: durations, cutting and joining."""

from __future__ import annotations

import io
import wave

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _open(data: bytes):
    return wave.open(io.BytesIO(data))


def duration_of(data: bytes) -> float:
    """Seconds by the header; 0 if there is none that can be read."""
    try:
        with _open(data) as w:
            return w.getnframes() / w.getframerate()
    except (wave.Error, EOFError, ZeroDivisionError):
        return 0.0


def wave_duration(content: Column) -> Column:
    """Seconds of wave data in a column; 0 for null."""

    @F.pandas_udf("double")
    def read(data: pd.Series) -> pd.Series:
        return data.map(lambda c: 0.0 if c is None else duration_of(bytes(c)))

    return read(content)


def cut(data: bytes, ranges: list[tuple[float, float]], rate: int | None = None, silence: float = 0.0) -> bytes:
    """The ranges, in order, as one wave file; bounds are rounded outwards to samples, and ``silence`` follows each range.
    A sample rate other than ``rate`` is an error."""
    with _open(data) as w:
        params, frames = w.getparams(), w.readframes(w.getnframes())
    if rate is not None and params.framerate != rate:
        raise ValueError(f"sample rate {params.framerate}, not {rate}")
    size = params.sampwidth * params.nchannels
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setparams(params)
        for start, end in ranges:
            first, last = int(start * params.framerate // 1), int(-(-end * params.framerate // 1))
            w.writeframes(frames[max(0, first) * size : last * size])
            if silence:
                w.writeframes(bytes(int(silence * params.framerate) * size))
    return out.getvalue()


def joined(parts: list[bytes]) -> bytes:
    """Wave files end to end; the first one's header counts, and others of another rate are an error."""
    out, rate = io.BytesIO(), None
    with wave.open(out, "wb") as w:
        for p in parts:
            with _open(p) as r:
                if rate is None:
                    w.setparams(r.getparams())
                    rate = r.getframerate()
                if r.getframerate() != rate:
                    raise ValueError("sample rates differ")
                w.writeframes(r.readframes(r.getnframes()))
    return out.getvalue()


def cut_files(files: DataFrame, ranges: DataFrame, key: str = "id", silence: float = 0.0, rate: int | None = None) -> DataFrame:
    """(key, audio): each file (key, content) cut to its ranges (key, start, end), by start."""
    kind = files.schema[key].dataType.simpleString()
    own = ranges.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("ranges"))

    def run(batches):
        for b in batches:
            yield pd.DataFrame({key: b[key], "audio": [cut(bytes(c), [(r["start"], r["end"]) for r in rs], rate, silence) for c, rs in zip(b["content"], b["ranges"], strict=True)]})

    return files.select(key, "content").join(own, key).mapInPandas(run, f"{key} {kind}, audio binary")


def concat_files(pieces: DataFrame, group: str, order: list[str]) -> DataFrame:
    """(group, audio): the pieces (group, audio, ...) of a group end to end, in order; a group is one bounded result."""
    kind = pieces.schema[group].dataType.simpleString()
    rows = pieces.groupBy(group).agg(F.transform(F.sort_array(F.collect_list(F.struct(*order, "audio"))), lambda x: x["audio"]).alias("parts"))

    def run(batches):
        for b in batches:
            yield pd.DataFrame({group: b[group], "audio": [joined([bytes(p) for p in ps]) for ps in b["parts"]]})

    return rows.mapInPandas(run, f"{group} {kind}, audio binary")
