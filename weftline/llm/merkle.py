"""A Merkle manifest of a dataset, with a proof for each row.

A row's leaf is the SHA-256 of its fields, each with its length in bytes, so that no
two rows have the same input. The leaves of a partition of the dataset (`tree`, such
as a language) form a tree in the order of the ids; the roots of the trees form one
above them. All digests go into the next hash as lower-case hex text.

Each level is one table of nodes (tree, number, digest). A node's siblings are found
by equijoins of the level with itself, on sibling numbers that are computed: number
XOR 1 in a binary tree, the slot shifted by 1 to arity - 1 within the run otherwise.
The node in slot zero then emits the parent. The last run of a level may be short; a
node without siblings is hashed alone. On the way back down every node puts its own
siblings before what its parent has, which gives each leaf its path; a proof and a
root that is folded from any leaf are expressions over that path.

Numbers come from a prefix scan, so a tree may hold any share of the rows. A level
has a join key of its own for each node. Levels whose number of nodes (known from the
sizes of the trees) is at most SMALL are joined by broadcast.

Defined results: a null field is written `-`; rows without a tree are a tree, before
the others; rows with equal ids lie next to each other, by their leaves, and equal
rows can't be told apart; null ids come first and are never tampered with; an empty
table gives an empty table; texts of any length are hashed in whole; other columns
are not looked at.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import scratch, stored
from weftline.operators import scan

#: Nodes of a level that are sent to all tasks at most, and its bytes with their paths.
SMALL = 20_000
SMALL_BYTES = 8 << 20

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PATH = "array<struct<before: binary, after: binary>>"


def written(value: Column) -> Column:
    """A field as it is hashed: its length in bytes and the value, or - for null."""
    own = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(own).cast("string"), F.lit(":"), own), F.lit("-"))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def _hex(value: Column | str) -> Column:
    return F.lower(F.hex(value))


def leaves(docs: DataFrame, fields: Sequence[str], tree: str, key: str, tampered: dict[str, Column] | None = None) -> DataFrame:
    """key, tree, leaf and changed (the leaf with the tampered fields; the same where nothing is), digests as 32 bytes."""
    new = tampered or {}
    leaf = digest(*(written(docs[c]) for c in fields))
    changed = digest(*(written(new.get(c, docs[c])) for c in fields))
    return docs.select(docs[key].alias("key"), docs[tree].alias("tree"), F.unhex(leaf).alias("leaf"), F.unhex(changed).alias("changed"))


def _siblings(level: DataFrame, arity: int, few: bool) -> DataFrame:
    """The level's nodes with the digests of their siblings before and after them."""
    others = level.select(F.col("tree").alias("_tree"), F.col("at").alias("_at"), F.col("node").alias("_node"))
    others = F.broadcast(others) if few else others
    slot = F.col("at") % arity
    out, found = level, []
    for shift in range(1, arity):
        to = F.col("at").bitwiseXOR(F.lit(1)) if arity == 2 else F.col("at") - slot + (slot + shift) % arity
        one = others.select("_tree", "_at", F.col("_node").alias(f"_s{shift}"))
        out = out.withColumn("_to", to).join(one, (F.col("tree") == F.col("_tree")) & (F.col("_to") == F.col("_at")), "left").drop("_tree", "_at", "_to")
        found.append(F.col(f"_s{shift}"))
    none = F.lit(b"")
    if arity == 2:
        before, after = F.when(slot == 1, found[0]).otherwise(none), F.when(slot == 0, F.coalesce(found[0], none)).otherwise(none)
    else:
        run = F.array_sort(F.array(*(F.struct(((slot + i + 1) % arity).alias("slot"), x.alias("node")) for i, x in enumerate(found))))
        joined = lambda keep: F.aggregate(F.filter(run, lambda x: keep(x["slot"]) & x["node"].isNotNull()), none, lambda acc, x: F.concat(acc, x["node"]))
        before, after = joined(lambda s: s < slot), joined(lambda s: s > slot)
    out = out.select("tree", "n", "at", "node", before.alias("before"), after.alias("after"))
    return out.coalesce(1) if few else out


def _depth(n: int, arity: int) -> int:
    levels = 0
    while n > 1:
        n, levels = -(-n // arity), levels + 1
    return levels


def _up(nodes: DataFrame, arity: int, n: int, n_trees: int, largest: int) -> tuple[list[DataFrame], DataFrame]:
    """nodes: tree, n (nodes of the tree), at, node. The levels with siblings, from the leaves, and the roots (tree, level, node)."""
    levels, level = [], nodes
    roots = nodes.filter("n = 1").select("tree", F.lit(0).alias("level"), "node")
    for i in range(_depth(largest, arity)):
        some = n // arity**i + n_trees
        levels.append(stored(_siblings(level.filter("n > 1"), arity, some <= SMALL), "level"))
        level = levels[-1].filter(F.col("at") % arity == 0).select("tree", F.ceil(F.col("n") / arity).cast("long").alias("n"), F.expr(f"at div {arity}").alias("at"), F.unhex(digest(_hex("node"), _hex("after"))).alias("node"))
        roots = roots.unionByName(level.filter("n = 1").select("tree", F.lit(i + 1).alias("level"), "node"))
    return levels, roots


def _down(levels: list[DataFrame], roots: DataFrame, arity: int, n: int, n_trees: int) -> DataFrame:
    """tree, at, subroot and path of all leaves; roots: tree, level, node, path (that goes on above the root)."""
    own = lambda i: roots.filter(F.col("level") == i).select("tree", F.lit(0).cast("long").alias("at"), F.col("node").alias("subroot"), "path")
    above = own(len(levels))
    for i in range(len(levels) - 1, -1, -1):
        some = n // arity ** (i + 1) + n_trees
        up = above.select(F.col("tree").alias("_tree"), F.col("at").alias("_up"), "subroot", "path")
        up = F.broadcast(up) if some <= SMALL and some * 80 * (len(levels) - i + 8) * arity <= SMALL_BYTES else up
        level = levels[i].withColumn("_to", F.expr(f"at div {arity}"))
        path = F.concat(F.array(F.struct("before", "after")).cast(_PATH), F.col("path"))
        below = level.join(up, (F.col("tree") == F.col("_tree")) & (F.col("_to") == F.col("_up"))).select("tree", "at", "subroot", path.alias("path"))
        above = below.unionByName(own(i))
        if i and i % 4 == 0:
            above = stored(above, "paths")
    return above


def manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, tree: str = "lang", key: str = "doc_id", arity: int = 2, tampered: dict[str, Column] | None = None) -> DataFrame:
    """For each row its key, leaf, subroot and root, proof_sha256 (of its siblings, level by level), folded_root (from the
    tampered leaf, if any, and the siblings), verified (whether that is the root), and path (the siblings before and after it)."""
    if arity < 2:
        raise ValueError("a run has two nodes at least")
    with scratch(docs.sparkSession) as keep:
        rows = scan.ranked(leaves(docs, fields, tree, key, tampered), ["tree"], ["key", "leaf"], "at", "n")
        first = rows.filter("at = 0").select("tree", F.col("n").alias("_size"))
        trees = stored(scan.ranked(first, [], ["tree"], "number", "n_trees"), "trees")
        n, n_trees, largest = trees.agg(F.coalesce(F.sum("_size"), F.lit(0)), F.count(F.lit(1)), F.coalesce(F.max("_size"), F.lit(0))).first()
        named = trees.select(F.col("tree").alias("_tree"), "number")
        rows = stored(rows.join(named, F.col("tree").eqNullSafe(F.col("_tree"))).select("key", F.col("number").alias("tree"), "n", "at", "leaf", "changed"), "leaves")
        levels, roots = _up(rows.select("tree", "n", "at", F.col("leaf").alias("node")), arity, n, n_trees, largest)
        roots = stored(roots, "roots")
        top = roots.select(F.lit(0).cast("long").alias("tree"), F.lit(n_trees).cast("long").alias("n"), F.col("tree").alias("at"), "node")
        top_levels, top_root = _up(top, arity, n_trees, 1, n_trees)
        root = top_root.first()  # a single row
        whole = bytes(root["node"]).hex() if root else ""
        above = _down(top_levels, top_root.withColumn("path", F.array().cast(_PATH)), arity, n_trees, 1).select(F.col("at").alias("tree"), "path")
        paths = _down(levels, roots.join(above, "tree"), arity, n, n_trees).withColumnsRenamed({"tree": "_tree", "at": "_at"})
        out = rows.join(paths, (F.col("tree") == F.col("_tree")) & (F.col("at") == F.col("_at")))
        folded = F.aggregate("path", _hex("changed"), lambda acc, x: digest(_hex(x["before"]), acc, _hex(x["after"])))
        proof = F.sha2(F.aggregate("path", F.lit(""), lambda acc, x: F.concat(acc, _hex(x["before"]), _hex(x["after"]))), 256)
        out = out.select(F.col("key").alias(key), _hex("leaf").alias("leaf"), _hex("subroot").alias("subroot"), F.lit(whole).alias("root"), proof.alias("proof_sha256"), folded.alias("folded_root"), "path")
        return keep(out.withColumn("verified", F.col("folded_root") == F.col("root")), "manifest")


def tampering(docs: DataFrame, key: str = "doc_id", number: str = "n_chars", every: int = 7) -> dict[str, Column]:
    """One more in a number, in rows whose key's CRC-32 the divisor divides."""
    hit = F.crc32(docs[key].cast("string").cast("binary")) % every == 0
    return {number: F.when(hit, docs[number].cast("decimal(38,0)") + 1).otherwise(docs[number].cast("decimal(38,0)"))}


#: DuckDB has no CRC-32: the eight steps of each byte of the decimal id are folded.
_CRC = "xor(list_reduce(list_transform(range(0, strlen(doc_id::VARCHAR)), lambda i: ascii(substr(doc_id::VARCHAR, i + 1, 1))::BIGINT), lambda c, b: list_reduce(range(0, 8), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(c, b)), 4294967295), 4294967295)"


def _field(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR) || ':' || {value}::VARCHAR, '-')"


_LEAF = " || ".join(_field(c) for c in FIELDS)
_CHANGED = " || ".join(_field(f"(n_chars + CASE WHEN {_CRC} % 7 = 0 THEN 1 ELSE 0 END)" if c == "n_chars" else c) for c in FIELDS)

ORACLE_SQL = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, lang, sha256({_LEAF}) AS leaf, sha256({_CHANGED}) AS changed FROM documents
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS no, count(*) OVER (PARTITION BY lang) AS n FROM leaves
), own AS (
  SELECT lang, 0 AS level, no, n, leaf AS node FROM placed
  UNION ALL
  SELECT lang, any_value(level) + 1, no // 2, any_value((n + 1) // 2), sha256(string_agg(node, '' ORDER BY no)) FROM own WHERE n > 1 GROUP BY lang, no // 2
), subroots AS (
  SELECT lang, node AS subroot, level AS depth, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS no, count(*) OVER () AS n FROM own WHERE n = 1
), above AS (
  SELECT 0 AS level, no, n, subroot AS node FROM subroots
  UNION ALL
  SELECT any_value(level) + 1, no // 2, any_value((n + 1) // 2), sha256(string_agg(node, '' ORDER BY no)) FROM above WHERE n > 1 GROUP BY no // 2
), root AS (
  SELECT node AS root FROM above WHERE n = 1
), folded AS (
  SELECT doc_id, lang, leaf, no AS leaf_no, no, n, 0 AS level, false AS is_above, '' AS path, changed AS acc FROM placed
  UNION ALL
  SELECT f.doc_id, f.lang, f.leaf, f.leaf_no, CASE WHEN f.n = 1 THEN u.no ELSE f.no // 2 END, CASE WHEN f.n = 1 THEN u.n ELSE (f.n + 1) // 2 END,
    CASE WHEN f.n = 1 THEN 0 ELSE f.level + 1 END, f.is_above OR f.n = 1,
    f.path || CASE WHEN f.n = 1 THEN '' ELSE coalesce(o.node, t.node, '') END,
    CASE WHEN f.n = 1 THEN f.acc WHEN f.no % 2 = 0 THEN sha256(f.acc || coalesce(o.node, t.node, '')) ELSE sha256(coalesce(o.node, t.node, '') || f.acc) END
  FROM folded f
  LEFT JOIN (SELECT * FROM own) o ON NOT f.is_above AND f.n > 1 AND o.lang IS NOT DISTINCT FROM f.lang AND o.level = f.level AND o.no = xor(f.no, 1)
  LEFT JOIN (SELECT * FROM above) t ON f.is_above AND t.level = f.level AND t.no = xor(f.no, 1)
  LEFT JOIN subroots u ON f.n = 1 AND NOT f.is_above AND u.lang IS NOT DISTINCT FROM f.lang
  WHERE NOT (f.is_above AND f.n = 1)
)
SELECT f.doc_id, f.leaf, s.subroot, r.root, sha256(f.path) AS proof_sha256, f.acc AS folded_root, f.acc = r.root AS verified
FROM folded f JOIN subroots s ON s.lang IS NOT DISTINCT FROM f.lang, root r
WHERE f.is_above AND f.n = 1
"""
