"""Label encoding to ``0..n-1`` and back."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lexispark.functions.arithmetic import literal_array
from lexispark.session import class_values


def encode_labels(df: DataFrame, label: str, classes: list | None = None, out: str = "label_idx") -> DataFrame:
    """Position of each label among the sorted distinct labels.

    The classes are a short sorted list, so the position is a column expression and no join is needed.
    """
    classes = class_values(df, label) if classes is None else classes
    return df.withColumn(out, (F.array_position(literal_array(classes), F.col(label)) - 1).cast("long"))


def decode_labels(df: DataFrame, classes: list, idx: str = "label_idx", out: str = "label") -> DataFrame:
    return df.withColumn(out, literal_array(classes)[F.col(idx).cast("int")])
