"""User models on batches: encode images, score noise, decode latents.

A model is given as a factory without arguments that returns a function on numpy arrays. The factory
runs once per Python worker; Spark moves the rows as Arrow batches.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.functions import vectors as vec
from corpusmill.functions.images import to_bytes
from corpusmill.functions.rules import CORRUPT

# Default image size and encode batch.
IMAGE_SIZE = 256
BATCH_SIZE = 16

Model = Callable[..., np.ndarray]
ENCODE_FAILED = "encode_failed"


class DecoderMissing(RuntimeError):
    """No image can be decoded at all. This alone stops a job; any other error of a decoder is the failure of one image."""


# --- pixels ---------------------------------------------------------------------------------------


def decode_rgb(content: bytes) -> np.ndarray:
    """Bytes of an image file to RGB ``[H,W,3]``; needs Pillow on the workers."""
    try:
        from PIL import Image
    except ImportError as missing:
        raise DecoderMissing("give a decoder, or install Pillow on the workers") from missing
    with Image.open(io.BytesIO(content)) as image:
        return np.asarray(image.convert("RGB"))


def bgr_rows(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    """The image source's bytes as RGB ``[H,W,3]``."""
    pixels = np.frombuffer(data, dtype=np.uint8).reshape(height, width, channels)
    if channels == 1:
        return np.repeat(pixels, 3, axis=2)
    return pixels[:, :, 2::-1]


_BLOCK_ROWS = 256


def _cubic_taps(size_in: int, size_out: int) -> tuple[np.ndarray, np.ndarray]:
    """Cubic convolution (a = -0.5), widened when shrinking so that no pixel is skipped: for each output the inputs it uses and their weights."""
    ratio = size_in / size_out
    stretch = max(ratio, 1.0)
    centres = (np.arange(size_out) + 0.5) * ratio
    first = np.floor(centres - 0.5 - 2 * stretch).astype(np.int64) + 1
    taps = first[:, None] + np.arange(int(np.ceil(4 * stretch)) + 1)
    x = np.abs((taps + 0.5 - centres[:, None]) / stretch)
    near = (1.5 * x - 2.5) * x * x + 1.0
    far = ((-0.5 * x + 2.5) * x - 4.0) * x + 2.0
    weights = np.where(x < 1, near, np.where(x < 2, far, 0.0))
    weights[(taps < 0) | (taps >= size_in)] = 0.0
    return np.clip(taps, 0, size_in - 1), (weights / weights.sum(axis=1, keepdims=True)).astype(np.float32)


def _resize_rows(rows: np.ndarray, taps: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """``[n, width, channels]`` resized along its width, one tap of all outputs at a time."""
    out = np.zeros((rows.shape[0], len(taps), rows.shape[2]), dtype=np.float32)
    for k in range(taps.shape[1]):
        out += weights[:, k, None] * rows[:, taps[:, k]]
    return out


def crop_and_resize(rgb: np.ndarray, size: int) -> np.ndarray:
    """Largest centred square, resized to ``size``.

    One axis after the other, each output from the few inputs it depends on; the first axis in blocks of rows, so that no copy of
    the whole image is made.
    """
    height, width = rgb.shape[:2]
    side = min(height, width)
    top, left = (height - side) // 2, (width - side) // 2
    square = rgb[top : top + side, left : left + side]
    if side == size:
        return square.astype(np.float64)
    taps, weights = _cubic_taps(side, size)
    narrow = np.concatenate([_resize_rows(square[i : i + _BLOCK_ROWS], taps, weights) for i in range(0, side, _BLOCK_ROWS)])
    resized = _resize_rows(narrow.transpose(1, 0, 2), taps, weights).transpose(1, 0, 2)
    return np.clip(np.rint(resized.astype(np.float64)), 0, 255)


def model_input(rgb: np.ndarray, size: int) -> np.ndarray:
    """``[3,size,size]`` in [-1, 1]."""
    return (crop_and_resize(rgb, size) / 255.0 * 2.0 - 1.0).transpose(2, 0, 1).astype(np.float32)


def block_average(block: int = vec.LATENT_STRIDE) -> Callable[[], Model]:
    """A stand-in encoder: the mean of each block and channel."""

    def make() -> Model:
        def encode(batch: np.ndarray) -> np.ndarray:
            n, c, h, w = batch.shape
            return batch.reshape(n, c, h // block, block, w // block, block).mean(axis=(3, 5))

        return encode

    return make


# --- encode ---------------------------------------------------------------------------------------


def encode_batches(
    rows: DataFrame,
    encoder: Callable[[], Model],
    image_size: int = IMAGE_SIZE,
    batch_size: int = BATCH_SIZE,
    scale: float = vec.LATENT_SCALE,
    encoder_id: str = "encoder",
    decoder: Callable[[bytes], np.ndarray] = decode_rgb,
) -> DataFrame:
    """``path, caption, [dataset, ordinal,] latent, shape, ..., reason``; a row that fails has NULL
    latent and a reason.

    ``rows`` has ``path``, ``caption`` and either ``content`` (file bytes) or the image source's
    ``verdict, n_channels, data``. Keep ``spark.sql.execution.arrow.maxRecordsPerBatch`` near the
    batch size: images are large.
    """
    decoded = "data" in rows.columns
    carried = ["path", "caption", *[c for c in ("dataset", "ordinal") if c in rows.columns]]
    if decoded:
        size = [F.col(f"verdict.{side}").alias(side) for side in ("height", "width")]
        flat = rows.select(*carried, "data", "n_channels", *size)
    else:
        flat = rows.select(*carried, "content")

    def pixels(row) -> np.ndarray:
        if decoded:
            return bgr_rows(row.data, int(row.height), int(row.width), int(row.n_channels))
        return decoder(row.content)

    def run(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = encoder()
        for pdf in pdfs:
            for start in range(0, len(pdf), batch_size):
                part = pdf.iloc[start : start + batch_size]
                latents, shapes, reasons = _encode_part(part, pixels, model, image_size, scale)
                yield part[carried].assign(latent=latents, shape=shapes, reason=reasons)

    schema = T.StructType(rows.select(*carried).schema.fields)
    schema = (
        schema.add("latent", T.ArrayType(T.FloatType()))
        .add("shape", T.ArrayType(T.IntegerType()))
        .add("reason", T.StringType())
    )
    return (
        flat.mapInPandas(run, schema)
        .withColumn("image_size", F.lit(image_size))
        .withColumn("encoder_id", F.lit(encoder_id))
        .withColumn("latent_scale", F.lit(float(scale)))
    )


def _encode_part(part: pd.DataFrame, pixels, model: Model, image_size: int, scale: float):
    inputs, used, reasons = [], [], [None] * len(part)
    for at, row in enumerate(part.itertuples(index=False)):
        try:
            inputs.append(model_input(pixels(row), image_size))
            used.append(at)
        except DecoderMissing:
            raise
        except Exception as failure:  # a bad image must not stop the batch
            reasons[at] = f"{ENCODE_FAILED}:{type(failure).__name__}"
    latents, shapes = [None] * len(part), [None] * len(part)
    if inputs:
        encoded = np.asarray(model(np.stack(inputs))) * scale
        for at, latent in zip(used, encoded):
            latents[at] = latent.astype(np.float32).ravel()
            shapes[at] = list(latent.shape)
    return latents, shapes, reasons


def drop_failed_encodes(encoded: DataFrame) -> DataFrame:
    return encoded.filter(F.col("latent").isNotNull()).drop("reason")


def probe_images(rows: DataFrame, decoder: Callable[[bytes], np.ndarray] = decode_rgb) -> DataFrame:
    """Add ``verdict`` to rows that carry ``content``: for archive members, which no image source reads."""

    def probe(content: pd.Series) -> pd.DataFrame:
        out = []
        for data in content:
            try:
                height, width = decoder(data).shape[:2]
                out.append((True, "ok", width, height))
            except DecoderMissing:
                raise
            except Exception as failure:
                out.append((False, f"{CORRUPT}:{type(failure).__name__}", None, None))
        frame = pd.DataFrame(out, columns=["ok", "reason", "width", "height"])
        return frame.astype({"width": "Int32", "height": "Int32"})

    as_verdict = F.pandas_udf(probe, "ok boolean, reason string, width int, height int")
    return rows.withColumn("verdict", as_verdict("content"))


# --- score and decode -----------------------------------------------------------------------------


def score_noise(
    rows: DataFrame,
    model: Callable[[], Model],
    inputs: tuple[str, ...] = ("xt", "t", "y"),
    size: int | None = None,
    batch_size: int = 32,
    name: str = "pred",
) -> DataFrame:
    """Add the model's noise prediction. The first input is an array, the others are numbers."""
    shapes = [[size] if size else None, *[None] * (len(inputs) - 1)]
    predict = predict_batch_udf(
        model,
        return_type=T.ArrayType(T.DoubleType()),
        batch_size=batch_size,
        input_tensor_shapes=shapes if size else None,
    )
    return rows.withColumn(name, predict(*inputs))


def decode_latents(
    shards: DataFrame, decoder: Callable[[], Model], n: int, size: int, pixels: int, batch_size: int = BATCH_SIZE
) -> DataFrame:
    """Images of the first ``n`` samples of each shard: unscale, decode, turn into bytes.

    ``size`` and ``pixels`` are the lengths of a latent and of a decoded image.
    """
    first = shards.filter(F.col("index") < n)
    plain = vec.unscaled(vec.doubles(F.col("latent")), F.col("latent_scale"))
    predict = predict_batch_udf(
        decoder, return_type=T.ArrayType(T.DoubleType()), batch_size=batch_size, input_tensor_shapes=[[size]]
    )
    decoded = first.withColumn("_z", plain).withColumn("_x", predict("_z"))
    whole = F.when(F.size("_x") == pixels, F.col("_x")).otherwise(
        F.raise_error(F.lit(f"decoder must return {pixels} values")).cast("array<double>")
    )
    return decoded.withColumn("image", to_bytes(whole)).drop("_z", "_x")


# --- precision ------------------------------------------------------------------------------------


def cast_precision(x: Column, precision: str = "fp16") -> Column:
    """Stored precision: ``fp32`` is ARRAY<FLOAT>; ``fp16`` is packed bytes, half the size."""
    if precision == "fp32":
        return x.cast("array<float>")
    if precision != "fp16":
        raise ValueError("precision must be fp16 or fp32")

    @F.pandas_udf("binary")
    def pack(values: pd.Series) -> pd.Series:
        return values.map(lambda v: None if v is None else np.asarray(v, dtype="<f2").tobytes())

    return pack(x.cast("array<float>"))


def unpack_half(packed: Column) -> Column:
    @F.pandas_udf("array<float>")
    def unpack(values: pd.Series) -> pd.Series:
        return values.map(lambda v: None if v is None else np.frombuffer(v, dtype="<f2").astype(np.float32))

    return unpack(packed)
