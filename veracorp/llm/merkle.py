"""Operator 11, Merkle dataset manifest by octopus multiproofs.

Every row is a leaf; the leaves of a source, ascending by doc_id, form a tree of fan-out
three, and the roots of the sources, ordered by source, form the top tree.  Leaves are
dealt to partitions of 3**HEIGHT neighbours.  A partition climbs as far as its own leaves
reach and names the minimal union of nodes that all of its proofs need from elsewhere: at
most two per level, for the siblings that lie in a run with its own nodes are derived, not
fetched.  One join fetches these nodes for all partitions; then each partition derives the
interiors its proofs share and expands one proof per leaf.

Bounds: a partition holds 3**HEIGHT leaves and two nodes per level; rounds are the levels
divided by HEIGHT, each over a 3**HEIGHT-th of the nodes before.  Digests move, texts never.
Positions come from ``ranking``, so that one source may hold any share of the rows.

Defined results
  * a null in any of the five columns reads as ``-``; an empty text as ``0:``.
  * null sources form the first tree; null doc_ids come first in their source.
  * rows that repeat a doc_id are leaves of their own, in the order of their digests.
  * an empty table has no leaves and no root; extra columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veracorp.llm.common import CRC32_SQL, documents, stage
from veracorp.llm.ranking import placed, ranked

FANOUT = 3
# Leaves per partition: FANOUT ** HEIGHT neighbours.
HEIGHT = 5
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# The tree over the sources' roots; trees of sources are numbered from 0.
TOP = -1

LOT = FANOUT ** HEIGHT
_LOT_OF = f"pos div {LOT} AS lot"


def leaf_digest(text: Column | None = None) -> Column:
    """Hex digest of the row's five fields; ``text`` stands in for the text column."""
    def field(name: str) -> Column:
        value = (text if text is not None and name == "text" else F.col(name)).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))
    return F.sha2(F.concat(*map(field, FIELDS)), 256)


def node_hash(children: list[str]) -> str:
    return hashlib.sha256("".join(children).encode()).hexdigest()


def levels_of(size: int) -> int:
    """Hashing steps from ``size`` leaves to one node."""
    n = 0
    while size > 1:
        size, n = -(-size // FANOUT), n + 1
    return n


def missing(first: int, end: int, size: int) -> list[tuple[int, int]]:
    """(level, position) of the fewest nodes that, with the leaves [first, end) of a tree of
    ``size``, give the root and every proof of these leaves."""
    out, level = [], 0
    while size > 1:
        low, high = first // FANOUT * FANOUT, min(-(-end // FANOUT) * FANOUT, size)
        out += [(level, p) for p in (*range(low, first), *range(end, high))]
        first, end, size, level = first // FANOUT, -(-end // FANOUT), -(-size // FANOUT), level + 1
    return out


def derive(first: int, nodes: list[str], size: int, fetched: dict) -> tuple[list[tuple[int, list[str]]], str]:
    """Per level the first position and digests of the whole runs above the leaves
    [first, first + len(nodes)), and the root."""
    levels, level = [], 0
    while size > 1:
        end = first + len(nodes)
        low, high = first // FANOUT * FANOUT, min(-(-end // FANOUT) * FANOUT, size)
        runs = [fetched[level, p] for p in range(low, first)] + nodes + [fetched[level, p] for p in range(end, high)]
        levels.append((low, runs))
        nodes = [node_hash(runs[i:i + FANOUT]) for i in range(0, len(runs), FANOUT)]
        first, size, level = low // FANOUT, -(-size // FANOUT), level + 1
    return levels, nodes[0]


def siblings(levels: list[tuple[int, list[str]]], pos: int) -> list[tuple[str, str]]:
    """The proof of one leaf: per level the digests left and right of its ancestor in its run."""
    out = []
    for low, runs in levels:
        at = pos - low
        start = at // FANOUT * FANOUT
        out.append(("".join(runs[start:at]), "".join(runs[at + 1:start + FANOUT])))
        pos //= FANOUT
    return out


# ---- building -------------------------------------------------------------------------

_NODES = "tree long, level int, pos long, size long, digest binary, lot long, wants long"
_NODE_SCHEMA = pa.schema([("tree", pa.int64()), ("level", pa.int32()), ("pos", pa.int64()), ("size", pa.int64()),
                          ("digest", pa.binary()), ("lot", pa.int64()), ("wants", pa.int64())])


def _lots(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]):
    """Rows grouped by (tree, lot); the batches are sorted by it."""
    key, held = None, []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("tree", "lot", *names))):
            if row[:2] != key:
                if held:
                    yield key, held
                key, held = row[:2], []
            held.append(row[2:])
    if held:
        yield key, held


def _climb(base: int, keep: bool, trees: int | None):
    """Climb HEIGHT levels from nodes of level ``base``.  Rows out: nodes (digest set; all climbed levels,
    and level 0, where ``keep`` is set, else the last; ``size`` counts the tree's nodes of that level), and
    where ``trees`` is given the nodes that the lot's proofs want (tree and lot want the node (level, pos)
    of the tree ``wants``)."""
    def run(batches):
        out = []
        for (tree, lot), rows in _lots(batches, ("pos", "size", "digest")):
            at, size = rows[0][0], rows[0][1]
            nodes = [r[2].hex() for r in rows]
            if trees is not None:
                out += [(tree, level, p, None, None, lot, tree) for level, p in missing(at, at + len(nodes), size)]
                out += [(tree, level, p, None, None, lot, TOP) for level, p in missing(tree, tree + 1, trees)]
            up = min(HEIGHT, levels_of(size))
            for step in range(up + 1):
                if step:
                    nodes = [node_hash(nodes[i:i + FANOUT]) for i in range(0, len(nodes), FANOUT)]
                    at, size = at // FANOUT, -(-size // FANOUT)
                if (step or not base) if keep else step == up:
                    out += [(tree, base + step, at + i, size, bytes.fromhex(n), None, None) for i, n in enumerate(nodes)]
            if len(out) >= 4096:
                yield _batch(out)
                out = []
        if out:
            yield _batch(out)
    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _NODE_SCHEMA)], schema=_NODE_SCHEMA)


def _grow(nodes: DataFrame, largest: int, keep: bool, trees: int | None, name: str) -> list[DataFrame]:
    """All rounds of climbing over (tree, pos, size, digest); ``largest`` is the largest tree's size."""
    out, base = [], 0
    while True:
        lots = nodes.selectExpr("tree", _LOT_OF, "pos", "size", "digest").repartitionByRange("tree", "lot").sortWithinPartitions("tree", "lot", "pos")
        out.append(stage(lots.mapInArrow(_climb(base, keep, trees if base == 0 else None), _NODES), f"merkle-{name}"))
        base, largest, keep = base + HEIGHT, -(-largest // LOT), True
        if largest <= 1:
            return out
        nodes = out[-1].where(F.col("digest").isNotNull() & (F.col("level") == base) & (F.col("size") > 1))


class Manifest:
    """The trees over a documents table.

    ``root`` (None for no rows), ``subroots`` (source, tree, size, subroot), ``nodes`` (tree, level, pos,
    digest: what lies above the partitions), ``leaves`` (doc_id, source, leaf, tampered, tree, pos, size).
    """

    def __init__(self, docs: DataFrame, tampered: Column | None = None):
        """``tampered``: another digest of some rows, null elsewhere, carried beside the leaf."""
        self.spark = docs.sparkSession
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                           F.unhex(leaf_digest()).alias("leaf"),
                           (F.unhex(tampered) if tampered is not None else F.lit(None).cast("binary")).alias("tampered"))
        rows, runs = ranked(rows, ["source"], ["doc_id", "leaf"], "merkle")
        sources, parts = ranked(runs.where(F.col("_before") == 0).select("source", F.col("_size").alias("n")), [], ["source"], "merkle-sources")
        self.sources = stage(placed(sources, parts, [], "tree", "trees"), "merkle-trees")  # source, n, tree, trees
        largest, self.trees = self.sources.agg(F.max("n"), F.count("*")).first()
        named = self.sources.select(F.col("source").alias("_s"), "tree")
        runs = runs.join(named, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
        self.leaves = placed(rows, runs, ["source"])
        if not self.trees:
            self.root = None
            return
        grown = _grow(self.leaves.select("tree", "pos", "size", F.col("leaf").alias("digest")), largest, False, self.trees, "nodes")
        wanted = grown[0].where(F.col("wants").isNotNull())
        self._wanted = wanted.select("tree", "lot", F.col("wants").alias("of"), "level", "pos")
        own = self._union(grown)
        tops = own.where(F.col("size") == 1).join(self.sources.select("tree", "n", "source"), "tree")
        self.subroots = stage(tops.select("source", "tree", F.col("n").alias("size"), F.col("digest").alias("subroot")), "merkle-subroots")
        top = self.subroots.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("pos"),
                                   F.lit(self.trees).cast("long").alias("size"), F.col("subroot").alias("digest"))
        over = self._union(_grow(top, self.trees, True, None, "top"))
        self.nodes = own.unionByName(over)
        self.root = over.where(F.col("size") == 1).first()["digest"].hex()

    @staticmethod
    def _union(tables: list[DataFrame]) -> DataFrame:
        return reduce(DataFrame.unionByName, [t.where(F.col("digest").isNotNull()).drop("lot", "wants") for t in tables])

    def proofs(self) -> DataFrame:
        """doc_id, source, leaf, tampered (hex), pos, size, subroot, derived_root, and the proof: per level,
        leaf to root, the digests left and right of the leaf's ancestor."""
        if self.root is None:
            return self.spark.createDataFrame([], _PROOF_DDL)
        fetched = (self._wanted.join(self.nodes.select(F.col("tree").alias("of"), "level", "pos", "digest"), ["of", "level", "pos"])
                   .select("tree", "lot", F.col("of").isin(TOP).cast("int").alias("kind"), "level", "pos", F.lit(0).cast("long").alias("size"),
                           "digest", F.lit(None).cast("binary").alias("tampered"), F.lit(None).cast("long").alias("doc_id"),
                           F.lit(None).cast("string").alias("source")))
        leaves = self.leaves.selectExpr("tree", _LOT_OF, "2 AS kind", "0 AS level", "pos", "size", "leaf AS digest", "tampered", "doc_id", "source")
        both = fetched.unionByName(leaves).repartition("tree", "lot").sortWithinPartitions("tree", "lot", "kind", "pos")
        return both.mapInArrow(_expand(self.trees), _PROOF_DDL)


_PROOF_DDL = ("doc_id long, source string, leaf string, tampered string, pos long, size long, subroot string, derived_root string, "
              "proof array<struct<left:string,right:string>>")
_STEP = pa.struct([("left", pa.string()), ("right", pa.string())])
_PROOF_SCHEMA = pa.schema([("doc_id", pa.int64()), ("source", pa.string()), ("leaf", pa.string()), ("tampered", pa.string()),
                           ("pos", pa.int64()), ("size", pa.int64()), ("subroot", pa.string()), ("derived_root", pa.string()),
                           ("proof", pa.list_(_STEP))])


def _expand(trees: int):
    """Per lot: derive the shared interiors from its leaves and fetched nodes, then a proof for each leaf."""
    def run(batches):
        rows, left, right, offsets = [], [], [], [0]
        for (tree, _), own in _lots(batches, ("kind", "level", "pos", "size", "digest", "tampered", "doc_id", "source")):
            fetched: tuple[dict, dict] = ({}, {})
            leaves = []
            for kind, level, pos, size, digest, *rest in own:
                if kind == 2:
                    leaves.append((pos, size, digest.hex(), *rest))
                else:
                    fetched[kind][level, pos] = digest.hex()
            first, last, size = leaves[0][0], leaves[-1][0], leaves[0][1]
            levels, subroot = derive(first, [r[2] for r in leaves], size, fetched[0])
            above, root = derive(tree, [subroot], trees, fetched[1])
            apart = 0  # levels on which the leaves have different ancestors
            while first // FANOUT ** apart != last // FANOUT ** apart:
                apart += 1
            shared = siblings(levels[apart:], first // FANOUT ** apart) + siblings(above, tree)
            for pos, size, leaf, tampered, doc_id, source in leaves:
                rows.append((doc_id, source, leaf, tampered and tampered.hex(), pos, size, subroot, root))
                for x, y in (*siblings(levels[:apart], pos), *shared):
                    left.append(x)
                    right.append(y)
                offsets.append(len(left))
            if len(rows) >= 2048:
                yield _proof_batch(rows, left, right, offsets)
                rows, left, right, offsets = [], [], [], [0]
        if rows:
            yield _proof_batch(rows, left, right, offsets)
    return run


def _proof_batch(rows, left, right, offsets) -> pa.RecordBatch:
    steps = pa.StructArray.from_arrays([pa.array(left, pa.string()), pa.array(right, pa.string())], fields=list(_STEP))
    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), _PROOF_SCHEMA)]
    return pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), steps)], schema=_PROOF_SCHEMA)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, leaf, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def proof_digest(proof: Column) -> Column:
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    cut = F.when(even & F.col("text").contains("\n"), leaf_digest(F.translate(F.col("text"), "\n", "")))
    manifest = Manifest(docs, cut)
    root = F.lit(manifest.root)
    out = manifest.proofs().withColumn("folded_root", fold(F.coalesce("tampered", "leaf"), F.col("proof")))
    return out.select("doc_id", "leaf", "subroot", root.alias("root"), proof_digest(F.col("proof")).alias("proof_sha256"),
                      "folded_root", (F.col("folded_root") == root).alias("verified"))


REGISTRY = {"op11_merkle_manifest": op11_merkle_manifest}

_FIELD = "coalesce(strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR, '-')"
_HEAD = " || ".join(_FIELD.format(c) for c in FIELDS[:-1])
_STEPS = """SELECT {0} lvl, pos, h, n, coalesce(string_agg(h, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(h, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {1} WHERE n > 1 WINDOW w AS (PARTITION BY {0} lvl, pos // 3 ORDER BY pos)"""

SQL = {"op11_merkle_manifest": f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, source, sha256({_HEAD} || {_FIELD.format('text')}) AS h,
         sha256({_HEAD} || {_FIELD.format("replace(text, chr(10), '')")}) AS cut
  FROM documents),
leaf AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, h) - 1 AS pos,
         {CRC32_SQL.format('doc_id')} AS crc FROM docs),
tree AS (
  SELECT source, 0 AS lvl, pos, h, count(*) OVER (PARTITION BY source) AS n FROM leaf
  UNION ALL
  SELECT source, lvl + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), any_value((n + 2) // 3)
  FROM tree WHERE n > 1 GROUP BY source, lvl, pos // 3),
subroots AS (SELECT source, h, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM tree WHERE n = 1),
top AS (
  SELECT 0 AS lvl, pos, h, n FROM subroots
  UNION ALL
  SELECT lvl + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), any_value((n + 2) // 3) FROM top WHERE n > 1 GROUP BY lvl, pos // 3),
low AS ({_STEPS.format('source,', 'tree')}),
high AS ({_STEPS.format('', 'top')}),
above AS (
  SELECT s.source, s.h AS subroot, coalesce(list({{'l': t.l, 'r': t.r}} ORDER BY t.lvl) FILTER (t.l IS NOT NULL), []) AS steps
  FROM subroots s LEFT JOIN high t ON t.pos = s.pos // (3 ** t.lvl)::BIGINT GROUP BY ALL),
below AS (
  SELECT f.source, f.pos, coalesce(list({{'l': t.l, 'r': t.r}} ORDER BY t.lvl) FILTER (t.l IS NOT NULL), []) AS steps
  FROM leaf f LEFT JOIN low t ON t.source IS NOT DISTINCT FROM f.source AND t.pos = f.pos // (3 ** t.lvl)::BIGINT GROUP BY ALL),
proofs AS (
  SELECT f.doc_id, f.h AS leaf, CASE WHEN f.crc % 2 = 0 THEN f.cut ELSE f.h END AS start, a.subroot, b.steps || a.steps AS steps
  FROM leaf f JOIN below b ON b.source IS NOT DISTINCT FROM f.source AND b.pos = f.pos
  JOIN above a ON a.source IS NOT DISTINCT FROM f.source),
folded AS (
  SELECT *, list_reduce([{{'l': start, 'r': ''}}] || steps, lambda a, s: {{'l': sha256(s.l || a.l || s.r), 'r': ''}}).l AS folded_root FROM proofs),
root AS (SELECT h AS root FROM top WHERE n = 1)
SELECT doc_id, leaf, subroot, root,
       sha256(array_to_string(list_transform(steps, lambda s: s.l || s.r), '')) AS proof_sha256,
       folded_root, folded_root = root AS verified
FROM folded, root"""}
