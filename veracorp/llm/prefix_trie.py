"""Operator 13, conversation prefix trie by depth-band rollup.

Conversations that begin with the same turns share the nodes of their beginnings.  Each
node stands once, under the smallest member's id.  Sums over subtrees are rolled up by
bands of BAND depths: a node adds to its ancestors of its own band only, read off its
smallest member's chain; the band roots, now holding their band's totals, form a trie of a
BAND-th of the depth, which is rolled up in the same way; each band root's completed total
then goes to its ancestors in the band above it.  So no row explodes to more than BAND
rows, and a depth of d takes log_BAND(d) rounds.

Texts are read once.  From then on a turn is a digest, and a prefix is the sum of 32-bit
pieces of the hashes of its (digest, place) pairs: sums of pieces can be taken chunk by
chunk, so that a conversation of any length is spread over tasks, as are its positions
(``ranking``).  Prefixes are equal up to collisions of these 128 bits.

A node's ends_sha256 is a hash over all its ids in order, which only one task can fold; it
gets them as strings of ENDS ids that other tasks have joined, streams them, and holds one
batch.

Defined results
  * null role or text reads as empty; null turns come first; turns of one number come in the
    order of their digests, rows that are equal throughout are turns of their own.
  * rows without a conv_id belong to no conversation.
  * an empty table has no nodes, no root either; extra columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veracorp.llm.common import CRC32_SQL, stage
from veracorp.llm.ranking import placed, ranked

BAND = 8
# Rows of one conversation that a window holds at most.
CHUNK = 4096
ENDS = 512
# Nodes with at least 1/HOT_SHARE of all nodes as children are hot: at most HOT_SHARE of them.
HOT_SHARE = 1000
LANES = ("s0", "s1", "s2", "s3")


def turn_digest() -> Column:
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    return F.substring(F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)), 1, 16)


def rebuilt(conversations: DataFrame, share: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """(conv_id, p, digest, chars) of the rebuilt conversations, and (conv_id, length) of each.

    Conversation c begins with the first h = crc32(c) % ``most`` turns of c - c % ``share`` and goes
    on with its own turns after its first h.
    """
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), turn_digest().alias("digest"),
        F.length(F.coalesce(F.col("text").cast("string"), F.lit(""))).cast("long").alias("chars"))
    rows, runs = ranked(rows, ["conv_id"], ["turn", "digest"], "trie")
    convs = runs.where(F.col("_before") == 0).select(
        "conv_id", F.col("_size").alias("n"), F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(most)).alias("h"),
        (F.col("conv_id") - F.col("conv_id") % share).alias("base"))
    # at most 2 * share - 1 conversations have the same base
    sizes = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("nb"))
    plan = stage(convs.join(sizes, "base", "left").withColumn("from_base", F.least("h", F.coalesce("nb", F.lit(0)))), "trie-plan")
    own = placed(rows, runs.join(plan.select("conv_id", "h", "from_base"), "conv_id"), ["conv_id"])
    own = own.where(F.col("pos") >= F.col("h")).select("conv_id", (F.col("from_base") + F.col("pos") - F.col("h")).alias("p"), "digest", "chars")
    heads = (placed(rows, runs, ["conv_id"]).where((F.col("conv_id") % share == 0) & (F.col("pos") < most - 1))
             .select(F.col("conv_id").alias("base"), F.col("pos").alias("p"), "digest", "chars"))
    begun = plan.where("h > 0").join(heads, "base").where(F.col("p") < F.col("h")).select("conv_id", "p", "digest", "chars")
    lengths = plan.select("conv_id", (F.col("from_base") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"))
    return own.unionByName(begun), lengths


def running_sums(rows: DataFrame, cols: tuple[str, ...], deepest: int) -> DataFrame:
    """``rows`` (conv_id, p, cols, ...) with ``cols`` summed over the places up to p; ``deepest`` bounds p.
    Windows hold CHUNK rows; the chunks' totals are summed in the same way."""
    chunk = (F.col("p") / CHUNK).cast("long") if deepest >= CHUNK else F.lit(0).cast("long")
    rows = rows.withColumn("_chunk", chunk)
    upto = Window.partitionBy("conv_id", "_chunk").orderBy("p").rowsBetween(Window.unboundedPreceding, 0)
    out = rows.select("*", *[F.sum(c).over(upto).alias(f"_{c}") for c in cols]).drop(*cols).withColumnsRenamed({f"_{c}": c for c in cols})
    if deepest < CHUNK:
        return out.drop("_chunk")
    totals = rows.groupBy("conv_id", F.col("_chunk").alias("p")).agg(*[F.sum(c).alias(c) for c in cols])
    before = running_sums(totals, cols, deepest // CHUNK).select("conv_id", (F.col("p") + 1).alias("_chunk"), *[F.col(c).alias(f"_{c}") for c in cols])
    out = out.join(before, ["conv_id", "_chunk"], "left")
    return out.select(*[c for c in out.columns if c not in cols and not c.startswith("_")],
                      *[(F.col(c) + F.coalesce(f"_{c}", F.lit(0))).alias(c) for c in cols])


def _key(depth: Column, sums: list[Column]) -> Column:
    return F.substring(F.unhex(F.sha2(F.concat_ws(",", depth, *sums), 256)), 1, 16)


def chains(turns: DataFrame, lengths: DataFrame, deepest: int) -> DataFrame:
    """(conv_id, depth, key, parent, chars, ends): every conversation's nodes from the root down."""
    hashes = (F.xxhash64("digest", "p"), F.xxhash64(F.lit(1), "digest", "p"))
    pieces = [piece for h in hashes for piece in (h.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(h, 32))]
    own = [p.alias(f"o{i}") for i, p in enumerate(pieces)]
    rows = turns.select("conv_id", "p", "chars", *[p.alias(c) for c, p in zip(LANES, pieces)], *own)
    summed = running_sums(rows, LANES, deepest).join(lengths, "conv_id")
    down = summed.select(
        "conv_id", (F.col("p") + 1).alias("depth"), _key(F.col("p") + 1, [F.col(c) for c in LANES]).alias("key"),
        _key(F.col("p"), [F.col(c) - F.col(f"o{i}") for i, c in enumerate(LANES)]).alias("parent"), "chars",
        (F.col("p") + 1 == F.col("length")).alias("ends"))
    zero = F.lit(0).cast("long")
    roots = lengths.select("conv_id", zero.alias("depth"), _key(zero, [zero] * len(LANES)).alias("key"), F.lit(None).cast("binary").alias("parent"),
                           zero.alias("chars"), (F.col("length") == 0).alias("ends"))
    return down.unionByName(roots)


def nodes(chain: DataFrame) -> DataFrame:
    """key, conv_id (smallest member), depth, n_convs, chars, n_children, parent_conv_id per node."""
    counted = chain.groupBy("key").agg(F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.count("*").alias("n_convs"), F.max("chars").alias("chars"))
    # the smallest member's chain names the node's parent: one row per (conv_id, depth) on both sides
    found = stage(counted.join(chain.select("conv_id", "depth", "parent"), ["conv_id", "depth"]), "trie-nodes")
    children = stage(found.where(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("n_children"))
                     .join(found.select("key", F.col("conv_id").alias("parent_conv_id")), "key"), "trie-parents")
    total = found.count()
    # children that together are a large part of all nodes meet their parent by a broadcast of at most HOT_SHARE rows
    hot = F.col("n_children") >= max(2, -(-total // HOT_SHARE))
    above = children.select(F.col("key").alias("parent"), "parent_conv_id", "n_children")
    near = F.broadcast(above.where(hot).drop("n_children"))
    linked = (found.join(near, "parent").unionByName(
        found.join(near.drop("parent_conv_id"), "parent", "left_anti").join(above.where(~hot).drop("n_children"), "parent", "left")))
    return linked.join(children.select("key", "n_children"), "key", "left").select(
        "key", "conv_id", "depth", "n_convs", "chars", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), "parent_conv_id")


def subtree_sums(chain: DataFrame, values: DataFrame, cols: tuple[str, ...], deepest: int, band: int = BAND) -> DataFrame:
    """(key, cols): ``cols`` of ``values`` summed over each node's subtree.

    ``chain`` (conv_id, depth, key): the conversations' nodes; ``values`` (conv_id, depth, cols): one row per
    node, under its smallest member; ``deepest`` bounds the depth.
    """
    chain = chain.withColumn("band", (F.col("depth") / band).cast("long"))
    # up: within its band, a node adds to itself and the ancestors on its smallest member's chain
    held = (chain.join(values, ["conv_id", "depth"], "left").groupBy("conv_id", "band")
            .agg(F.sort_array(F.collect_list(F.struct("depth", "key", *cols))).alias("rows")))   # at most ``band`` rows
    held = held.where(F.exists("rows", lambda r: r[cols[0]].isNotNull()))

    def from_here(c: str, i: Column) -> Column:
        return F.aggregate(F.slice("rows", i + 1, F.lit(band)), F.lit(0).cast("long"), lambda t, r: t + F.coalesce(r[c], F.lit(0)))

    added = held.select(F.explode(F.transform("rows", lambda r, i: F.struct(r["key"].alias("key"), *[from_here(c, i).alias(c) for c in cols]))).alias("r")).select("r.*")
    totals = added.groupBy("key").agg(*[F.sum(c).alias(c) for c in cols])
    if deepest < band:
        return totals
    totals = stage(totals, "trie-band")
    # the band roots, with their band's totals, are a trie of their own
    at_roots = F.col("depth") % band == 0
    root_chain = stage(chain.where(at_roots).select("conv_id", F.col("band").alias("depth"), "key"), "trie-roots")
    root_nodes = values.where(at_roots).select("conv_id", (F.col("depth") / band).cast("long").alias("depth"))
    root_keys = stage(root_nodes.join(root_chain, ["conv_id", "depth"]), "trie-root-keys")
    done = subtree_sums(root_chain, root_keys.join(totals, "key").drop("key"), cols, deepest // band, band)
    # down: a band root's completed total goes to its ancestors in the band above
    complete = (root_keys.where(F.col("depth") > 0).join(done, "key")
                .select("conv_id", (F.col("depth") - 1).alias("band"), *cols))
    passed = chain.select("conv_id", "band", "key").join(complete, ["conv_id", "band"]).select("key", *cols)
    return totals.unionByName(passed).groupBy("key").agg(*[F.sum(c).alias(c) for c in cols])


def _columns(batches: Iterator[pa.RecordBatch], *names: str):
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in names))


def _join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of up to ENDS ids of one node as one row."""
    key, ids, out = None, [], []
    for k, c in _columns(batches, "key", "conv_id"):
        if ids and (k != key or len(ids) == ENDS):
            out.append((key, ids[0], ",".join(map(str, ids))))
            ids = []
            if len(out) == 256:
                yield pa.RecordBatch.from_pydict(dict(zip(("key", "first", "ids"), map(list, zip(*out)))))
                out = []
        key = k
        ids.append(c)
    if ids:
        out.append((key, ids[0], ",".join(map(str, ids))))
    if out:
        yield pa.RecordBatch.from_pydict(dict(zip(("key", "first", "ids"), map(list, zip(*out)))))


def _fold_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, state, out = None, None, []
    for k, ids in _columns(batches, "key", "ids"):
        if k != key:
            if state is not None:
                out.append((key, state.hexdigest()))
                if len(out) == 4096:
                    yield pa.RecordBatch.from_pydict(dict(zip(("key", "ends_sha256"), map(list, zip(*out)))))
                    out = []
            key, state = k, hashlib.sha256()
        else:
            state.update(b",")
        state.update(ids.encode())
    if state is not None:
        out.append((key, state.hexdigest()))
        yield pa.RecordBatch.from_pydict(dict(zip(("key", "ends_sha256"), map(list, zip(*out)))))


def ends(chain: DataFrame) -> DataFrame:
    """(key, ends_sha256) of the nodes where conversations end."""
    pairs = chain.where("ends").select("key", "conv_id")
    joined = pairs.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id").mapInArrow(_join_ids, "key binary, first long, ids string")
    return joined.repartition("key").sortWithinPartitions("key", "first").select("key", "ids").mapInArrow(_fold_ids, "key binary, ends_sha256 string")


def trie(turns: DataFrame, lengths: DataFrame, band: int = BAND) -> DataFrame:
    """All nodes over ``turns`` (conv_id, p, digest, chars) and ``lengths`` (conv_id, length)."""
    deepest = lengths.agg(F.max("length")).first()[0] or 0
    chain = stage(chains(turns, lengths, deepest), "trie-chains")
    found = stage(nodes(chain), "trie-linked")
    values = found.select("conv_id", "depth", (F.col("n_children") == 0).cast("long").alias("n_leaves"),
                          ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"))
    sums = subtree_sums(chain.select("conv_id", "depth", "key"), values, ("n_leaves", "saved_tokens"), deepest, band)
    none = F.lit(hashlib.sha256().hexdigest())
    return (found.join(sums, "key").join(ends(chain), "key", "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", none).alias("ends_sha256")))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, lengths = rebuilt(spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet"))
    return trie(turns, lengths)


REGISTRY = {"op13_prefix_trie": op13_prefix_trie}

SQL = {"op13_prefix_trie": f"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, count(*) OVER (PARTITION BY conv_id) AS n,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, any_value(n) AS n, conv_id - conv_id % 100 AS base FROM t GROUP BY conv_id),
h AS (SELECT *, {CRC32_SQL.format('conv_id')} % 6 AS h FROM c),
plan AS (SELECT h.*, least(h.h, coalesce(b.n, 0)) AS nb FROM h LEFT JOIN c b ON b.conv_id = h.base),
r AS (
  SELECT t.conv_id, plan.nb + t.pos - plan.h AS p, role, text FROM t JOIN plan ON plan.conv_id = t.conv_id WHERE t.pos >= plan.h
  UNION ALL
  SELECT plan.conv_id, t.pos, role, text FROM plan JOIN t ON t.conv_id = plan.base AND t.pos < plan.h),
chain AS (
  SELECT conv_id, p + 1 AS depth, length(text) AS chars,
         string_agg(strlen(role) || ':' || strlen(text) || ':' || role || text, '' ) OVER (PARTITION BY conv_id ORDER BY p) AS prefix,
         string_agg(strlen(role) || ':' || strlen(text) || ':' || role || text, '' ) OVER (PARTITION BY conv_id ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS parent,
         p + 1 = count(*) OVER (PARTITION BY conv_id) AS ends
  FROM r
  UNION ALL
  SELECT conv_id, 0, 0, '', NULL, conv_id NOT IN (SELECT conv_id FROM r) FROM c),
node AS (
  SELECT depth, prefix, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
         CASE WHEN depth > 0 THEN coalesce(any_value(parent), '') END AS parent,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM chain GROUP BY depth, prefix),
kids AS (
  SELECT a.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM node k WHERE k.depth = a.depth + 1 AND k.parent = a.prefix) AS n_children
  FROM node a LEFT JOIN node p ON p.depth = a.depth - 1 AND p.prefix = a.parent),
total AS (
  SELECT up.depth, up.prefix, sum((k.n_children = 0)::INT) AS n_leaves, sum((k.n_convs - 1) * k.chars) AS saved_tokens
  FROM kids k JOIN chain up ON up.conv_id = k.conv_id AND up.depth <= k.depth GROUP BY up.depth, up.prefix)
SELECT k.conv_id, k.depth::BIGINT AS depth, k.parent_conv_id, k.n_convs, k.n_children, total.n_leaves::BIGINT AS n_leaves,
       total.saved_tokens::BIGINT AS saved_tokens, k.ends_sha256
FROM kids k JOIN total ON total.depth = k.depth AND total.prefix = k.prefix"""}
