"""Vector arithmetic on array columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewloom.functions.constants import CLASS_NAMES


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_vector(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def dot(a, b) -> Column:
    # widen before multiplying: float products would lose digits
    products = F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def norm(a) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a, b, norm_a=None, norm_b=None) -> Column:
    """Cosine similarity; pass stored norms to spare the row work."""
    size = (norm(a) if norm_a is None else _col(norm_a)) * (norm(b) if norm_b is None else _col(norm_b))
    return F.when(size > 0, dot(a, b) / size)


def softmax(logits) -> Column:
    def scaled(exps: Column) -> Column:
        total = F.aggregate(exps, F.lit(0.0), lambda s, x: s + x)
        return F.transform(F.array(total), lambda t: F.transform(exps, lambda x: x / t))[0]

    logits = _col(logits)
    exps = F.transform(F.array(F.array_max(logits)), lambda top: F.transform(logits, lambda x: F.exp(x - top)))
    return F.transform(exps, scaled)[0]


def unit(values) -> Column:
    """Scaled to length one; a zero vector stays zero."""
    values = _col(values)
    by_size = F.transform(
        F.array(norm(values)), lambda size: F.transform(values, lambda x: F.when(size > 0, x / size).otherwise(0.0))
    )
    return by_size[0]


def predicted_class(logits, names: Sequence[str] = tuple(CLASS_NAMES)) -> Column:
    """Name of the largest logit, the first one on ties."""
    logits = _col(logits)
    return F.element_at(F.array(*[F.lit(n) for n in names]), F.array_position(logits, F.array_max(logits)).cast("int"))


def class_confidences(logits, names: Sequence[str] = tuple(CLASS_NAMES)) -> Column:
    """Rounded softmax keyed by the first three letters of each class."""
    keys = F.array(*[F.lit(n[:3]) for n in names])
    return F.map_from_arrays(keys, F.transform(softmax(logits), lambda p: F.round(p, 2)))
