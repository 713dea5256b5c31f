"""Vector expressions on ``ARRAY<DOUBLE>`` columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkstrata.functions.binding import let

DIGEST_BYTES = 32


def _sum_of(products: Column) -> Column:
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def as_doubles(v: Column) -> Column:
    return v.cast("array<double>")


def norm(v: Column) -> Column:
    """Euclidean length; a zero vector counts as length one."""
    length = F.sqrt(_sum_of(F.transform(v, lambda x: x * x)))
    return F.when(length == 0.0, F.lit(1.0)).otherwise(length)


def normalize(v: Column) -> Column:
    return let(norm(v), lambda n: F.transform(v, lambda x: x / n))


def dot(a: Column, b: Column) -> Column:
    return _sum_of(F.zip_with(a, b, lambda x, y: x * y))


def cosine(a: Column, b: Column) -> Column:
    return dot(normalize(a), normalize(b))


def checked(v: Column, dim: int) -> Column:
    """The vector itself; the job fails on a vector of another size."""
    return F.when(F.size(v) == dim, v).otherwise(
        F.raise_error(
            F.concat(F.lit(f"vector dimension mismatch: expected {dim}, got "), F.size(v).cast("string"))
        )
    )


def digest_embedding(text: Column, dim: int = 768) -> Column:
    """Unit vector from the SHA-256 bytes of the text, repeated up to ``dim``."""
    copies = dim // DIGEST_BYTES + 1

    def spread(digest: Column) -> Column:
        values = F.array(
            *[F.conv(F.substring(digest, 2 * i + 1, 2), 16, 10).cast("double") for i in range(DIGEST_BYTES)]
        )
        return F.slice(F.flatten(F.array_repeat(values, copies)), 1, dim)

    return let(let(F.sha2(text, 256), spread), normalize)


def keyword_embedding(text: Column, keywords: list[str]) -> Column:
    """Counts of each keyword in the lower-cased text, without overlaps."""
    if not all(keywords):
        raise ValueError("keywords must not be empty")

    def counts(lowered: Column) -> Column:
        # bytes that go when the keyword is taken out: no pattern, no decoding
        size = F.octet_length(lowered)
        return F.array(
            *[
                ((size - F.octet_length(F.replace(lowered, F.lit(k.lower())))) / F.octet_length(F.lit(k.lower())))
                for k in keywords
            ]
        )

    return let(F.lower(text), counts)


def log_softmax(logits: Column) -> Column:
    def shifted(top: Column) -> Column:
        log_total = F.log(_sum_of(F.transform(logits, lambda x: F.exp(x - top))))
        return let(log_total, lambda t: F.transform(logits, lambda x: x - top - t))

    return let(F.array_max(logits), shifted)


def chosen_log_prob(logits: Column, action: Column) -> Column:
    """Log-probability of the action, an index from zero."""
    return F.element_at(log_softmax(logits), (action + 1).cast("int"))


def last_value(values: Column, mask: Column | None = None) -> Column:
    """Value at the last position, or at the last unmasked one if a mask is given."""
    if mask is None:
        return F.element_at(values, -1)
    kept = F.filter(F.arrays_zip(values.alias("v"), mask.alias("m")), lambda p: p["m"] != 0)
    return F.element_at(F.transform(kept, lambda p: p["v"]), -1)
