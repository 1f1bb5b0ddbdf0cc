"""Dense vectors in array columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


LETTERS = "abcdefghijklmnopqrstuvwxyz0123456789"


def dot(a: Column, b: Column) -> Column:
    """Accumulated in double precision; null where a side is missing."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


@F.arrow_udf(DoubleType())
def product(a: pa.Array, b: pa.Array) -> pa.Array:
    """``dot`` of many pairs, a batch at a time; null where a side is missing. A batch's vectors have one length."""
    there = np.asarray(a.is_valid()) & np.asarray(b.is_valid())
    x, y = (v.filter(pa.array(there)).flatten().to_numpy(zero_copy_only=False).astype(np.float64) for v in (a, b))
    out = np.zeros(len(there))
    if there.any():
        out[there] = np.einsum("ij,ij->i", x.reshape(there.sum(), -1), y.reshape(there.sum(), -1))
    return pa.array(out, mask=~there)


def normalized(v: Column, least: float = 1e-6) -> Column:
    """Vector and norm are bound once: an expression inside a lambda is evaluated anew for each element."""
    bound = lambda x, f: F.transform(F.array(x), f)[0]
    return bound(v, lambda w: bound(F.greatest(F.sqrt(dot(w, w)), F.lit(least)), lambda n: F.transform(w, lambda x: x.cast("double") / n)))


def hashed_ngrams(text: Column, size: int = 64, n: int = 3) -> Column:
    """A default text encoder: signed counts of hashed character n-grams, of unit length."""
    padded = F.concat(F.lit(" "), F.lower(text), F.lit(" "))
    grams = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(padded) - n + 1)), lambda i: F.xxhash64(F.substring(padded, i, F.lit(n))))
    lanes = F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda k: F.aggregate(F.filter(grams, lambda h: F.pmod(h, F.lit(size)) == k), F.lit(0.0), lambda s, h: s + F.when(F.shiftright(h, 32) % 2 == 0, 1.0).otherwise(-1.0)))
    return normalized(lanes)


def letter_counts(text: Column) -> Column:
    """A plain text encoder: counts of letters and digits, of unit length."""
    held = lambda c: (F.length(text) - F.length(F.replace(text, c, F.lit("")))).cast("double")
    return normalized(F.transform(F.array(*[F.lit(c) for c in LETTERS]), held))
