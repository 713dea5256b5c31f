"""Merkle manifest of a dataset: concatenated-level strings.

The leaves of a source, in order, are dealt to aligned blocks of ``3 ** LEVELS``. A
block keeps each level of its tree as one string of hex digests: parents are hashes of
fixed-width substrings, and what a node needs to be checked, its siblings, are the
substrings to the left and right of it in its run. The tops of the blocks are the
leaves of the next tree, and so on until one node is left; the nodes that are left of
all sources make the last tree. Going back down, every block is given the siblings on
its own way up once, not every leaf.

Only DataFrame expressions are used. A text is read once; what is shuffled are digests.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkstrata.operators.numbering import number_rows
from inkstrata.session import materialize

# Nodes of a run, levels of a block, nodes of a block.
FAN = 3
LEVELS = 4
BLOCK = FAN**LEVELS
HEX = 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

Path = "array<struct<left:string,right:string>>"


def field(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(**values: Column) -> Column:
    """Digest of a row; ``values`` replace columns of the same name."""
    return F.sha2(F.concat(*[field(values.get(name, F.col(name))) for name in FIELDS]), 256)


def _parents(level: Column) -> Column:
    runs = F.sequence(F.lit(0), F.ceil(F.length(level) / (FAN * HEX)).cast("int") - 1)
    return F.array_join(F.transform(runs, lambda i: F.sha2(F.substr(level, i * (FAN * HEX) + 1, F.lit(FAN * HEX)), 256)), "")


def _height(block: Column, nodes: Column) -> Column:
    """Levels above the first one in a block.

    A block that is not full is its group's last. Where it is the only one as well,
    its tree ends at the first single node; all others have the whole height.
    """
    low = F.lit(LEVELS)
    for levels in range(LEVELS - 1, -1, -1):
        low = F.when(nodes <= FAN**levels, F.lit(levels)).otherwise(low)
    return F.when((block > 0) | (nodes == BLOCK), F.lit(LEVELS)).otherwise(low)


def _blocks(nodes: DataFrame, carried: list[str]) -> DataFrame:
    """``group, block, levels, rows`` from ``group, pos, node`` and what rows carry.

    A group of rows is one block, so its size is bounded.
    """
    row = F.struct("pos", "node", *carried)
    dealt = nodes.groupBy("group", F.floor(F.col("pos") / BLOCK).cast("bigint").alias("block")).agg(F.array_sort(F.collect_list(row)).alias("rows"))
    first = F.array_join(F.transform("rows", lambda r: r["node"]), "")
    steps = F.slice(F.array(*[F.lit(i) for i in range(LEVELS)]), F.lit(1), _height(F.col("block"), F.size("rows")))
    levels = F.aggregate(steps, F.array(first), lambda made, _: F.concat(made, F.array(_parents(F.element_at(made, -1)))))
    kept = F.transform("rows", lambda r: F.struct(*[r[c].alias(c) for c in carried])) if carried else F.lit(None).cast("array<string>")
    return dealt.select("group", "block", F.size("rows").alias("nodes"), levels.alias("levels"), kept.alias("rows"))


@dataclass(frozen=True)
class Tree:
    """Stored blocks, from the leaves up; ``tops`` are ``group, node``, one row for each group."""

    levels: list[DataFrame]
    tops: DataFrame


def build(nodes: DataFrame, carried: list[str]) -> Tree:
    """Trees of all groups of ``nodes`` (``group, pos, node``; ``pos`` counts from 0 in each group)."""
    levels: list[DataFrame] = []
    while True:
        blocks = materialize(_blocks(nodes, [] if levels else carried), "merkle")
        levels.append(blocks)
        nodes = blocks.select("group", F.col("block").alias("pos"), F.element_at("levels", -1).alias("node"))
        if blocks.where(F.col("block") > 0).isEmpty():
            return Tree(levels, nodes.select("group", "node"))


def _siblings(levels: Column, place: Column) -> Column:
    """Left and right neighbours in its run of the node at ``place`` and of those above it."""

    def at(level: Column, height: Column) -> Column:
        pos = F.floor(place / F.element_at(F.array(*[F.lit(FAN**i) for i in range(LEVELS)]), height + 1)).cast("int")
        inside = pos % FAN
        left = F.substr(level, (pos - inside) * HEX + 1, inside * HEX)
        right = F.substr(level, (pos + 1) * HEX + 1, (FAN - 1 - inside) * HEX)
        return F.struct(left.alias("left"), right.alias("right"))

    return F.transform(F.slice(levels, F.lit(1), F.size(levels) - 1), at)


def paths(tree: Tree, above: DataFrame) -> DataFrame:
    """``group, pos, node, path``, what ``above`` and the rows carry, for every leaf of ``tree``.

    ``above`` has a row for each group: ``group, path`` of the way from its top on, and
    further columns that are handed down.
    """
    way = above.withColumn("pos", F.lit(0).cast("bigint"))
    more = [c for c in above.columns if c not in ("group", "path")]
    for blocks in reversed(tree.levels):
        upper = way.select("group", F.col("pos").alias("block"), F.col("path").alias("above"), *more)
        # keys are unique on both sides
        met = blocks.join(upper, ["group", "block"])
        spread = met.withColumn("place", F.explode(F.sequence(F.lit(0), F.col("nodes") - 1)))
        way = spread.select(
            "group",
            (F.col("block") * BLOCK + F.col("place")).alias("pos"),
            F.substr(F.element_at("levels", 1), F.col("place") * HEX + 1, F.lit(HEX)).alias("node"),
            F.concat(_siblings(F.col("levels"), F.col("place")), F.col("above")).alias("path"),
            *more,
            F.get("rows", F.col("place")).alias("row"),
        )
    return way


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its way up lead to."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def proof_digest(path: Column) -> Column:
    """Digest of the siblings on the way up, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def manifest(docs: DataFrame, **carry: Column) -> DataFrame:
    """``doc_id, leaf, subroot, root, path`` of every row, and the columns of ``carry``.

    ``docs`` has the columns ``FIELDS``; a null counts as ``-`` in a leaf, null sources
    are one group, which comes first. Leaves of a source ascend by ``doc_id``, null
    first; rows of equal id by their digest, so repeated rows give the same manifest in
    any order. ``carry`` are expressions over ``docs`` that go along with a leaf. Other
    columns are not read, whatever their names. No rows give no rows.
    """
    kind = docs.schema["doc_id"].dataType
    least = F.lit("") if isinstance(kind, T.StringType) else F.lit(-(2**63)).cast(kind) if isinstance(kind, T.LongType) else F.lit(0).cast(kind)
    group = F.when(F.col("source").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("source").cast("string")))
    carried = list(carry)
    rows = docs.select("doc_id", group.alias("group"), leaf_hash().alias("node"), *[value.alias(f"carry_{name}") for name, value in carry.items()])
    leaves = materialize(rows, "leaves").withColumns({"known": F.col("doc_id").isNotNull().cast("int"), "order": F.coalesce("doc_id", least)})
    # null ids go first where the key has a least value, else they are set apart by the first key
    keys = ["order", "known", "node"] if isinstance(kind, (T.StringType, T.LongType)) else ["known", "order", "node"]
    placed = number_rows(leaves, keys, partition_by=["group"], out="pos", start=0)
    tree = build(placed, ["doc_id", *[f"carry_{name}" for name in carried]])

    tops = materialize(tree.tops, "subroots")
    ordered = number_rows(tops, ["group"], out="pos", start=0)
    last = build(ordered.select(F.lit("").alias("group"), "pos", "node", F.col("group").alias("source_group")), ["source_group"])
    root = last.tops.first()
    start = docs.sparkSession.createDataFrame([("", [], root["node"] if root else None)], f"group string, path {Path}, root string")
    sources = paths(last, start).select(F.col("row.source_group").alias("group"), "path", F.col("node").alias("subroot"), "root")
    return paths(tree, sources).select(
        F.col("row.doc_id").alias("doc_id"), F.col("node").alias("leaf"), "subroot", "root", "path", *[F.col(f"row.carry_{name}").alias(name) for name in carried]
    )


def report(docs: DataFrame) -> DataFrame:
    """Every row's manifest digests, and the root its possibly tampered form folds to.

    Line ends are taken out of the texts of rows whose ``crc32(doc_id)`` is even. A null
    id or text is never tampered with.
    """
    hit = (F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 2 == 0) & F.contains(F.col("text"), F.lit("\n"))
    tampered = F.when(hit, leaf_hash(text=F.replace(F.col("text"), F.lit("\n"), F.lit(""))))
    made = manifest(docs, tampered=tampered)
    folded = made.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        proof_digest(F.col("path")).alias("proof_sha256"),
        fold(F.coalesce("tampered", "leaf"), F.col("path")).alias("folded_root"),
    )
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))


def sql() -> str:
    def leaf(text: str) -> str:
        def one(c: str) -> str:
            return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || {c} END"

        return "sha256(" + " || ".join(one(text if c == "text" else c) for c in FIELDS) + ")"

    def up(nodes: str) -> str:
        return f"list_transform(range(0, (len({nodes}) + 2) // 3), lambda i: sha256(array_to_string({nodes}[3 * i + 1 : 3 * i + 3], '')))"

    def siblings(nodes: str, place: str) -> str:
        run = f"({place} // 3 * 3)"
        return (
            f"{{'l': array_to_string({nodes}[{run} + 1 : {place}], ''),"
            f" 'r': array_to_string({nodes}[{place} + 2 : {run} + 3], '')}}"
        )

    return f"""
WITH RECURSIVE
bits AS (
  SELECT i, i AS v, 0 AS s FROM range(256) r(i)
  UNION ALL SELECT i, CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, s + 1 FROM bits WHERE s < 8),
crc AS (SELECT list(v ORDER BY i) AS t FROM bits WHERE s = 8),
d AS (
  SELECT doc_id, source, {leaf("text")} AS leaf, {leaf("replace(text, chr(10), '')")} AS bare,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
      lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295::BIGINT) % 2 = 0 AS hit
  FROM documents, crc),
p AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos FROM d),
lv AS (
  SELECT source, 0 AS l, list(leaf ORDER BY doc_id) AS nodes FROM d GROUP BY source
  UNION ALL SELECT source, l + 1, {up("nodes")} FROM lv WHERE len(nodes) > 1),
sub AS (SELECT source, nodes[1] AS subroot FROM lv WHERE len(nodes) = 1),
place AS (SELECT *, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS spot FROM sub),
top AS (
  SELECT 0 AS l, list(subroot ORDER BY source NULLS FIRST) AS nodes FROM sub
  UNION ALL SELECT l + 1, {up("nodes")} FROM top WHERE len(nodes) > 1),
root AS (SELECT nodes[1] AS root FROM top WHERE len(nodes) = 1),
own AS (
  SELECT doc_id, pos, p.source, list({siblings("nodes", "(pos // CAST(pow(3, l) AS BIGINT))")} ORDER BY l) AS way
  FROM p JOIN lv ON lv.source IS NOT DISTINCT FROM p.source AND len(nodes) > 1 GROUP BY ALL),
high AS (
  SELECT source, list({siblings("nodes", "(spot // CAST(pow(3, l) AS BIGINT))")} ORDER BY l) AS way
  FROM place JOIN top ON len(nodes) > 1 GROUP BY ALL),
whole AS (
  SELECT p.doc_id, leaf, subroot, CASE WHEN hit THEN bare ELSE leaf END AS start, list_concat(coalesce(own.way, []), coalesce(high.way, [])) AS way
  FROM p JOIN sub ON sub.source IS NOT DISTINCT FROM p.source
  LEFT JOIN own ON own.doc_id = p.doc_id AND own.source IS NOT DISTINCT FROM p.source
  LEFT JOIN high ON high.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(way, lambda x: x.l || x.r), '')) AS proof_sha256,
  list_reduce(list_prepend({{'l': start, 'r': ''}}, way), lambda a, x: {{'l': sha256(x.l || a.l || x.r), 'r': ''}}).l AS folded_root,
  folded_root = root AS verified
FROM whole, root"""
