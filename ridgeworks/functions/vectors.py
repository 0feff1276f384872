"""Column expressions on feature arrays, labels and score arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: lowest and highest exponent and size of the default lambda grid
GRID = (-5.0, 5.0, 10)


def quantise(features: Column, scale: int = 65536) -> Column:
    """``floor(x * scale)`` per element, kept as double so that sums of products stay exact."""
    return F.transform(features, lambda x: F.floor(x.cast("double") * scale).cast("double"))


def binarise(features: Column, threshold: float = 0.5) -> Column:
    """Below the threshold 0, above it 1, exactly on it unchanged."""
    return F.transform(
        features,
        lambda x: F.when(x < threshold, 0.0).when(x > threshold, 1.0).otherwise(x.cast("double")),
    )


def scale_bytes(pixels: Column) -> Column:
    """Byte pixels 0..255 to 0..1."""
    return F.transform(pixels, lambda x: x.cast("double") / 255.0)


def fold_rows(features: Column, width: int) -> Column:
    """A flat vector as an array of rows of ``width`` elements."""
    last = (F.size(features) / width).cast("int") - 1
    return F.transform(F.sequence(F.lit(0), last), lambda r: F.slice(features, r * width + 1, width))


def flatten_rows(matrix: Column) -> Column:
    """Array of rows to one row-major vector."""
    return F.flatten(matrix)


def one_vs_rest(label: Column, chosen: Column | int) -> Column:
    """+1 where the label is the chosen class, -1 elsewhere."""
    return F.when(label == chosen, 1).otherwise(-1)


def scale_vector(features: Column, factor: Column) -> Column:
    return F.transform(features, lambda x: x.cast("double") * factor)


def sign_decision(score: Column, zero: int = -1) -> Column:
    """Two-class decision: +1 / -1; a score of 0 gives ``zero`` (-1 or 0)."""
    return F.when(score > 0, 1).when(score < 0, -1).otherwise(zero)


def argmax_position(scores: Column) -> Column:
    """0-based position of the largest score, the first one on a tie (NaN counts as largest)."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def hit(label: Column, prediction: Column) -> Column:
    return (label == prediction).cast("int")


def dot(left: Column, right: Column) -> Column:
    products = F.zip_with(left, right, lambda a, b: a.cast("double") * b.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def log_spaced(low: float = GRID[0], high: float = GRID[1], count: int = GRID[2]) -> list[float]:
    """``count`` powers of ten with evenly spaced exponents, both ends included."""
    step = (high - low) / (count - 1) if count > 1 else 0.0
    return [10.0 ** (low + i * step) for i in range(count)]


def lambda_array(lambdas: list[float]) -> Column:
    """The grid as a literal array of (lambda_id, lambda), to explode beside any row."""
    return F.array(
        *[
            F.struct(F.lit(i).alias("lambda_id"), F.lit(float(v)).alias("lambda"))
            for i, v in enumerate(lambdas)
        ]
    )


def lambda_grid(
    spark: SparkSession, low: float = GRID[0], high: float = GRID[1], count: int = GRID[2]
) -> DataFrame:
    """(lambda_id, lambda) for the log-spaced grid."""
    return spark.range(1).select(F.inline(lambda_array(log_spaced(low, high, count))))
