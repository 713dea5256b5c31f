"""Expressions on token-id arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def resolve_special_ids(pad_id: int, bos_id: int) -> tuple[int, int]:
    """Padding falls back to 0 and the start id to padding where undefined."""
    pad = pad_id if pad_id >= 0 else 0
    return pad, bos_id if bos_id >= 0 else pad


def fixed_length(ids: Column, seq_length: int, bos: int, pad: int) -> Column:
    """Start id, then as many ids as fit, then padding: always ``seq_length`` long."""
    body = F.slice(F.concat(F.array(F.lit(bos)), ids), 1, seq_length)
    return pad_to(body, F.lit(seq_length), pad)


def pad_to(ids: Column, length: Column, pad: int) -> Column:
    return F.concat(ids, F.array_repeat(F.lit(pad), F.greatest(length - F.size(ids), F.lit(0))))


def attention_mask(ids: Column, pad: int) -> Column:
    return F.transform(ids, lambda x: (x != pad).cast("int"))


def model_inputs(ids: Column) -> Column:
    return F.slice(ids, F.lit(1), F.size(ids) - 1)


def next_token_labels(ids: Column) -> Column:
    return F.slice(ids, F.lit(2), F.size(ids) - 1)


def counted_labels(labels: Column, ignored: int) -> Column:
    """How many labels take part in the loss."""
    return F.size(F.filter(labels, lambda x: x != ignored))
