"""Pixel and image-geometry expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def crop_square(width: Column, height: Column) -> Column:
    """The largest centred square: ``side, left, top``."""
    side = F.least(width, height)
    return F.struct(
        side.cast("bigint").alias("side"),
        F.floor((width - side) / 2).cast("bigint").alias("left"),
        F.floor((height - side) / 2).cast("bigint").alias("top"),
    )


def unit_signed(byte: Column) -> Column:
    """0..255 to [-1, 1]."""
    return byte.cast("double") / 255 * 2 - 1


def clipped(value: Column) -> Column:
    return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), value))


def byte_of(value: Column) -> Column:
    """[-1, 1] to 0..255, clamped and truncated."""
    unit = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (value + 1) / 2))
    return (unit * 255).cast("int")


def to_unit_signed(values: Column) -> Column:
    return F.transform(values, unit_signed)


def to_bytes(values: Column) -> Column:
    return F.transform(values, byte_of)


def channels_first(x: Column, height: int, width: int, channels: int, reverse: bool = False) -> Column:
    """``[H,W,C]`` to ``[C,H,W]``; ``reverse`` also turns BGR into RGB."""
    area = height * width

    def pick(i: Column) -> Column:
        channel = F.floor(i / area)
        if reverse:
            channel = F.lit(channels - 1) - channel
        return F.get(x, (F.pmod(i, F.lit(area)) * channels + channel).cast("int"))

    return F.transform(F.sequence(F.lit(0), F.lit(area * channels - 1)), pick)


def channels_last(x: Column, height: int, width: int, channels: int, reverse: bool = False) -> Column:
    """``[C,H,W]`` to ``[H,W,C]``."""
    area = height * width

    def pick(i: Column) -> Column:
        channel = F.pmod(i, F.lit(channels))
        if reverse:
            channel = F.lit(channels - 1) - channel
        return F.get(x, (channel * area + F.floor(i / channels)).cast("int"))

    return F.transform(F.sequence(F.lit(0), F.lit(area * channels - 1)), pick)
