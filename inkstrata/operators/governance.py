"""Audit log, retention and encryption of an index."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RETENTION_MONTHS = 13


def audit_log(documents: DataFrame, operator: Column, commit: Column, at: Column | None = None) -> DataFrame:
    """One event per document: who, which commit, and the fingerprint of the text."""
    events = documents.select(
        "file_path",
        operator.alias("operator"),
        commit.alias("commit"),
        F.sha2(F.col("text"), 256).alias("fingerprint"),
    )
    return events if at is None else events.withColumn("ingested_at", at)


def append_audit_log(events: DataFrame, path: str) -> None:
    events.write.mode("append").parquet(path)


def retained(events: DataFrame, as_of: Column, ts: str = "ts", months: int = RETENTION_MONTHS) -> DataFrame:
    """Events of the retention period that ends at ``as_of``."""
    return events.where(F.col(ts) >= F.add_months(as_of, -months))


def _json_metadata(index: DataFrame) -> Column:
    return F.to_json("metadata")


def _keyed(index: DataFrame, key: bytes, change: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """``change`` applied with the key as a column that comes from a one-row table.

    As a literal the key would be in the text of the plan, and so in event logs.
    """
    keys = index.sparkSession.createDataFrame([(0, bytearray(key))], "_key_id int, _key binary")
    joined = index.withColumn("_key_id", F.lit(0)).join(F.broadcast(keys), "_key_id")
    return joined.withColumns({name: f(F.col("_key")) for name, f in change.items()}).drop("_key_id", "_key")


def encrypt_index(index: DataFrame, key: bytes) -> DataFrame:
    """Text and metadata under AES-256 in GCM mode; no plan names the key."""
    if len(key) != 32:
        raise ValueError("AES-256 needs a key of 32 bytes")

    def sealed(c: Column) -> Callable[[Column], Column]:
        return lambda k: F.aes_encrypt(c.cast("binary"), k, F.lit("GCM"))

    return _keyed(index, key, {"content": sealed(F.col("content")), "metadata": sealed(_json_metadata(index))})


def decrypt_index(sealed: DataFrame, key: bytes) -> DataFrame:
    def opened(name: str) -> Callable[[Column], Column]:
        return lambda k: F.aes_decrypt(F.col(name), k, F.lit("GCM")).cast("string")

    plain = _keyed(sealed, key, {name: opened(name) for name in ("content", "metadata")})
    return plain.withColumn("metadata", F.from_json("metadata", "map<string,string>"))


def reencrypt_index(sealed: DataFrame, old: bytes, new: bytes) -> DataFrame:
    """The same index under a new key."""
    return encrypt_index(decrypt_index(sealed, old), new)


KEY_ID = "key_id"


def _ringed(sealed: DataFrame, ring: Mapping[str, bytes], change: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """``change`` applied with the key that each row names; a key the ring lacks is an error."""
    if any(len(key) != 32 for key in ring.values()):
        raise ValueError("AES-256 needs keys of 32 bytes")
    # a ring is a handful of keys, and no plan names them
    keys = sealed.sparkSession.createDataFrame([(name, bytearray(key)) for name, key in ring.items()], f"{KEY_ID} string, _key binary")
    lost = F.raise_error(F.concat(F.lit("no key in the ring for key id "), F.coalesce(F.col(KEY_ID), F.lit("null"))))
    joined = sealed.join(F.broadcast(keys), KEY_ID, "left").withColumn("_key", F.coalesce("_key", lost.cast("binary")))
    return joined.withColumns({name: f(F.col("_key")) for name, f in change.items()}).drop("_key").select(*sealed.columns)


def seal(index: DataFrame, ring: Mapping[str, bytes], key_id: str) -> DataFrame:
    """Text and metadata under the key ``key_id`` of the ring; each row names its key in ``key_id``."""
    named = index.withColumn("metadata", _json_metadata(index)).withColumn(KEY_ID, F.lit(key_id))
    return _ringed(named, {key_id: ring[key_id]}, {name: _sealed(name) for name in ("content", "metadata")})


def unseal(sealed: DataFrame, ring: Mapping[str, bytes]) -> DataFrame:
    """Rows under any keys of the ring, in one read; ``key_id`` is dropped."""
    plain = _ringed(sealed, ring, {name: _opened(name) for name in ("content", "metadata")})
    return plain.withColumns({"content": F.col("content").cast("string"), "metadata": F.from_json(F.col("metadata").cast("string"), "map<string,string>")}).drop(KEY_ID)


def rotate(sealed: DataFrame, ring: Mapping[str, bytes], key_id: str) -> DataFrame:
    """All rows under ``key_id``; those that are so already, as after a rotation that broke off, stay as they are."""
    done, left = sealed.where(F.col(KEY_ID).eqNullSafe(key_id)), sealed.where(~F.col(KEY_ID).eqNullSafe(key_id))
    opened = _ringed(left, ring, {name: _opened(name) for name in ("content", "metadata")}).withColumn(KEY_ID, F.lit(key_id))
    return done.unionByName(_ringed(opened, {key_id: ring[key_id]}, {name: _sealed(name) for name in ("content", "metadata")}))


def _sealed(name: str) -> Callable[[Column], Column]:
    return lambda key: F.aes_encrypt(F.col(name).cast("binary"), key, F.lit("GCM"))


def _opened(name: str) -> Callable[[Column], Column]:
    return lambda key: F.aes_decrypt(F.col(name), key, F.lit("GCM"))
