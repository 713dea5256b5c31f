"""Queries: audit, retention, encryption (M1-M4)."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from inkstrata.catalog.base import SQL_PATHS, document_chunks, query, sql_chunks, table, with_paths
from inkstrata.operators import governance
from inkstrata.session import fresh_dir, materialize


@query(
    "m1_audit_log",
    f"""WITH {SQL_PATHS} SELECT file_path, 'user-' || source AS operator, coalesce("commit", 'HEAD') AS "commit",
      sha256(text) AS fingerprint FROM paths""",
)
def _(spark, sf):
    docs = with_paths(table(spark, sf, "documents"))
    events = governance.audit_log(
        docs, F.concat(F.lit("user-"), F.col("source")), F.coalesce("commit", F.lit("HEAD"))
    )
    path = fresh_dir(spark, "audit")
    governance.append_audit_log(events, path)
    return spark.read.parquet(path)


@query(
    "m2_retention",
    "SELECT event_id FROM events WHERE ts >= TIMESTAMP '2025-02-15 00:00:00' - INTERVAL 13 MONTH",
)
def _(spark, sf):
    as_of = F.lit("2025-02-15").cast("date")
    return governance.retained(table(spark, sf, "events"), as_of).select("event_id")


SQL_SEALED = f"""WITH {sql_chunks('documents', 'doc_id')}
    SELECT doc_id, chunk_index, content, 'docs/' || doc_id AS file_path, CAST(1 AS INTEGER) AS unreadable FROM chunks"""


def index(spark, sf):
    path = F.concat(F.lit("docs/"), F.col("doc_id").cast("string"))
    return document_chunks(spark, sf).withColumn("metadata", F.create_map(F.lit("file_path"), path))


def opened(plain, sealed, key, decrypt=governance.decrypt_index):
    """The decrypted rows, and whether the sealed ones hide their text.

    A row is compared with itself in place. Only rows whose key is there more than once,
    which are compared with each row of that key, are shuffled with their texts.
    """
    keys = ["doc_id", "chunk_index"]
    named = sealed.dropna(subset=keys)
    unreadable = (F.col("sealed") != F.encode("content", "UTF-8")).cast("int").alias("unreadable")
    shown = [*keys, "content", F.col("metadata")["file_path"].alias("file_path"), unreadable]
    repeated = named.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*keys)
    repeated = materialize(repeated, "repeated")
    own = decrypt(named.withColumn("sealed", F.col("content")), key)
    once = own.join(repeated, keys, "left_anti").select(*shown)
    if repeated.isEmpty():
        return once
    again = named.join(repeated, keys, "left_semi")
    hidden = again.select(*keys, F.col("content").alias("sealed"))
    return once.unionByName(decrypt(again, key).join(hidden, keys).select(*shown))


def stored(spark, sealed):
    path = fresh_dir(spark, "sealed")
    sealed.write.parquet(path)
    return spark.read.parquet(path)


@query("m3_encrypt_index", SQL_SEALED)
def _(spark, sf):
    key = os.urandom(32)
    plain = index(spark, sf)
    return opened(plain, stored(spark, governance.encrypt_index(plain, key)), key)


@query("m4_rotate_key", SQL_SEALED)
def _(spark, sf):
    ring = {"old": os.urandom(32), "new": os.urandom(32)}
    plain = index(spark, sf)
    sealed = stored(spark, governance.seal(plain, ring, "old"))
    # a rotation that broke off half-way, and is taken up again
    first = F.pmod(F.xxhash64("content"), F.lit(2)) == 0
    half = stored(spark, governance.rotate(sealed.where(first), ring, "new").unionByName(sealed.where(~first)))
    whole = stored(spark, governance.rotate(half, ring, "new"))
    return opened(plain, whole, {"new": ring["new"]}, governance.unseal)
