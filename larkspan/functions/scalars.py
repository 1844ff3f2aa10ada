"""Scalar functions: names, paths, formats, durations and small codecs, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def file_id(name: Column) -> Column:
    """md5 of a file's name."""
    return F.md5(name.cast("binary"))


def cluster_name(line: Column) -> Column:
    """s_ and ten digits of the md5 of a cluster's line, which ends with a line feed."""
    return F.concat(F.lit("s_"), F.substring(F.md5(F.concat(line, F.lit("\n")).cast("binary")), 1, 10))


def speaker_number(n: Column) -> Column:
    return F.format_string("sp_%05d", n)


def rounded(x: Column, places: int) -> Column:
    """As SQL engines round doubles: the product with the power of ten, not the printed digits, decides on halves."""
    return F.round(x * 10.0**places) / 10.0**places


def six_digits(n: Column) -> Column:
    return F.lpad(n.cast("string"), 6, "0")


def variant_name(stem: Column, n: Column) -> Column:
    return F.concat(stem, F.format_string("_%02d", n))


def dirname(path: Column) -> Column:
    return F.regexp_replace(path, "/?[^/]*$", "")


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def stem(path: Column) -> Column:
    return F.regexp_replace(basename(path), r"(?<=.)\.[^.]*$", "")


def extension(path: Column) -> Column:
    """Lower-cased, without its dot; '' where there is none."""
    return F.lower(F.regexp_extract(basename(path), r".\.([^.]+)$", 1))


def has_extension(path: Column, extensions: list[str]) -> Column:
    """No extensions: everything passes."""
    return F.lit(True) if not extensions else extension(path).isin([e.lower().lstrip(".") for e in extensions])


def has_suffix(path: Column, suffix: str) -> Column:
    return path.endswith(suffix)


def without_prefix(path: Column, prefix: str) -> Column:
    own = prefix.rstrip("/") + "/"
    return F.when(path.startswith(own), F.substr(path, F.lit(len(own) + 1), F.length(path))).otherwise(path)


def relative_to(path: Column, base: str) -> Column:
    return without_prefix(path, base)


def output_path(path: Column, in_dir: str, out_dir: str, name: str, same_dir: bool = False) -> Column:
    """Where a file's result goes: a folder named as the file, or the file's folder if ``same_dir``."""
    place = without_prefix(path, in_dir)
    place = dirname(place) if same_dir else place
    return F.when(place == "", F.concat(F.lit(out_dir.rstrip("/") + "/"), F.lit(name))).otherwise(F.concat(F.lit(out_dir.rstrip("/") + "/"), place, F.lit("/" + name)))


def audio_path(base: str, path: Column) -> Column:
    return F.when(path.startswith("/"), path).otherwise(F.concat(F.lit(base.rstrip("/") + "/"), path))


def cache_name(path: Column, cache_dir: str, base: str, name: str) -> Column:
    return F.concat_ws("/", F.lit(cache_dir.rstrip("/")), relative_to(path, base), F.lit(name))


def language_code(label: Column) -> Column:
    """The part before a colon, as in 'lt: Lithuanian'."""
    return F.trim(F.split_part(label, F.lit(":"), F.lit(1)))


def duration_text(seconds: Column) -> Column:
    """The two largest units that a whole number of seconds has: 2d 2h, 18h 1m, 50m, 10s."""
    s = F.floor(seconds).cast("long")
    days, hours, minutes, rest = F.floor(s / 86400), F.floor(s % 86400 / 3600), F.floor(s % 3600 / 60), s % 60

    def two(large: Column, l_unit: str, small: Column, s_unit: str) -> Column:
        return F.concat(large.cast("string"), F.lit(l_unit), F.when(small > 0, F.concat(F.lit(" "), small.cast("string"), F.lit(s_unit))).otherwise(""))

    return F.when(days > 0, two(days, "d", hours, "h")).when(hours > 0, two(hours, "h", minutes, "m")).when(minutes > 0, two(minutes, "m", rest, "s")).otherwise(F.concat(rest.cast("string"), F.lit("s")))


def size_bytes(text: str) -> int:
    """10G, 512M, 3K or plain bytes."""
    units = {"K": 10, "M": 20, "G": 30, "T": 40}
    text = text.strip().upper().removesuffix("B")
    return int(float(text[:-1]) * (1 << units[text[-1]])) if text[-1:] in units else int(text)


def megabytes(n: Column) -> Column:
    return n / F.lit(1024.0 * 1024.0)


def gender_letter(name: Column) -> Column:
    return F.when(F.lower(name).isin("male", "m"), "m").when(F.lower(name).isin("female", "f"), "f").otherwise("-")


def gender_number(letter: Column) -> Column:
    """Training labels: 1 for m, 0 for f, else null."""
    return F.when(letter == "m", 1).when(letter == "f", 0)


def gender_of_probability(p: Column, dead_band: float = 0.2) -> Column:
    """m at 0.5 + band or more, f at 0.5 - band or less, else -."""
    return F.when(p >= 0.5 + dead_band, "m").when(p <= 0.5 - dead_band, "f").otherwise("-")


def sample_range(start: Column, end: Column, rate: int) -> Column:
    """First and last-plus-one sample of a time range: rounded outwards."""
    return F.struct(F.floor(start * rate).cast("long").alias("first"), F.ceil(end * rate).cast("long").alias("last"))


def middle(start: Column, end: Column, seconds: float) -> Column:
    """The middle ``seconds`` of a range that is longer."""
    centre = (start + end) / 2
    longer = end - start > seconds
    return F.struct(F.when(longer, centre - seconds / 2).otherwise(start).alias("start"), F.when(longer, centre + seconds / 2).otherwise(end).alias("end"))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def normalised(a: Column) -> Column:
    n = norm(a)
    return F.transform(a, lambda x: F.when(n > 0, x / n).otherwise(x.cast("double")))
