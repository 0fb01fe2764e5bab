"""Operator 8, MinHash near-dedup with b-bit signatures.

Per document the distinct word shingles are hashed and K minima taken under K
permutations.  Whole minima, ROWS at a time, give the band keys; of every minimum
only the low BITS bits are kept, packed as bit planes.  Documents that share a band
key are candidates.  A candidate pair's similarity is estimated from the planes by
bit counts, corrected for chance agreement, ``(p - c) / (1 - c)`` with c = 2**-BITS;
pairs far below the threshold go, the others are confirmed on the full sets.

Large buckets are never expanded.  Documents with equal sets enter once (the smallest
id stands for them).  STAR_ROUNDS times, each bucket links its rows to one leader and
connected components are taken; a bucket that lies in one component is done.  Only
rows of a bucket that still lie in different components are then compared with each
other, and the join condition holds the size test, the b-bit estimate and the exact test,
so that it emits links alone.  No pair of a shared bucket is left untested unless its two
documents are already in one component.

At Jaccard 0.8 a pair shares no band with probability (1 - 0.8**ROWS)**BANDS, 1e-6;
the estimate's cut lies six standard deviations below the threshold.

Defined results: null and empty texts have no shingles, are linked with nothing and
stay; a text of fewer words than a shingle is one shingle; rows that repeat
a doc_id share its component; rows without doc_id always stay and have the component of
an equal set, if one has an id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veracorp.llm import hashing as H
from veracorp.llm.common import documents, stage, whole_text

ROWS, BANDS = 6, 45
HOT_SHARE = 1000
K = ROWS * BANDS
BITS, PLANE_WORDS = 4, 4          # 256 of the K minima are packed
SIGMAS = 6
STAR_ROUNDS = 2
_A = (H.numbers(21, K) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_B = (H.numbers(22, K) >> np.uint64(32)).astype(np.uint32)

SIGNED = pa.int64()


def shingle_hashes(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, concatenated, and their offsets."""
    words, _, _, first, _ = H.words_of(texts, lower=True)
    sums = H.prefix_of(words)
    grams = H.grams(sums, width)
    parts = []
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= width:
            parts.append(np.unique(grams[a:b - width + 1]))
        elif b > a:
            parts.append(H.spans(sums, np.array([a]), np.array([b])))
        else:
            parts.append(np.zeros(0, np.uint64))
    return np.concatenate(parts), np.cumsum([0] + [len(p) for p in parts])


def _signatures(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Set ids (2 words), band keys and bit planes of the non-empty sets."""
    n = len(offsets) - 1
    x = (flat >> np.uint64(32)).astype(np.uint32)
    minima = np.empty((K, n), np.uint32)
    for k in range(K):
        minima[k] = np.minimum.reduceat(x * _A[k] + _B[k], offsets[:-1])
    ids = np.stack([np.add.reduceat(flat, offsets[:-1]), np.bitwise_xor.reduceat(H.mix(flat), offsets[:-1])])
    wide = minima.astype(np.uint64).reshape(BANDS, ROWS, n)
    keys = np.tile(H.numbers(23, BANDS)[:, None], (1, n))
    for r in range(ROWS):
        keys = H.mix(keys ^ wide[:, r]) * np.uint64(H.BASE)
    packed = minima[:64 * PLANE_WORDS].astype(np.uint64)
    planes = np.zeros((BITS * PLANE_WORDS, n), np.uint64)
    for b in range(BITS):
        for w in range(PLANE_WORDS):
            bits = (packed[64 * w:64 * w + 64] >> np.uint64(b)) & np.uint64(1)
            planes[b * PLANE_WORDS + w] = np.bitwise_or.reduce(bits << np.arange(64, dtype=np.uint64)[:, None], axis=0)
    return ids, keys, planes


def _lists(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.ascontiguousarray(values).view(np.int64)))


def _column_lists(rows: np.ndarray) -> pa.Array:
    """A (width, n) array as n lists."""
    width, n = rows.shape
    return _lists(np.ascontiguousarray(rows.T).ravel(), np.arange(0, width * n + 1, width))


def _sign(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.encode() for t in batch.column("text").to_pylist()]
            for lo, hi in H.chunks(texts):
                flat, offsets = shingle_hashes(texts[lo:hi], width)
                sizes = np.diff(offsets)
                keep = np.flatnonzero(sizes)
                ids = np.zeros((2, hi - lo), np.uint64)
                keys = np.zeros((BANDS, hi - lo), np.uint64)
                planes = np.zeros((BITS * PLANE_WORDS, hi - lo), np.uint64)
                if len(keep):
                    full = np.concatenate([offsets[keep], offsets[-1:]])
                    ids[:, keep], keys[:, keep], planes[:, keep] = _signatures(flat, full)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), pa.array(sizes, SIGNED),
                     pa.array(ids[0].view(np.int64)), pa.array(ids[1].view(np.int64)),
                     _column_lists(keys), _column_lists(planes)],
                    names=["doc_id", "n", "id0", "id1", "bands", "planes"])
    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.encode() for t in batch.column("text").to_pylist()]
            for lo, hi in H.chunks(texts):
                flat, offsets = shingle_hashes(texts[lo:hi], width)
                yield pa.RecordBatch.from_arrays([batch.column("rid").slice(lo, hi - lo), _lists(flat, offsets)],
                                                 names=["rid", "items"])
    return run


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n (set size), id0/id1 (set identity), bands, planes per document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return rows.mapInArrow(_sign(width), "doc_id long, n long, id0 long, id1 long, bands array<long>, planes array<long>")


def estimate(a: str, b: str):
    """Collision-corrected similarity from the bit planes of two columns."""
    differ = None
    for w in range(PLANE_WORDS):
        words = [F.col(a)[i * PLANE_WORDS + w].bitwiseXOR(F.col(b)[i * PLANE_WORDS + w]) for i in range(BITS)]
        joined = words[0]
        for x in words[1:]:
            joined = joined.bitwiseOR(x)
        count = F.bit_count(joined)
        differ = count if differ is None else differ + count
    agree = 1 - differ / F.lit(64.0 * PLANE_WORDS)
    chance = 2.0 ** -BITS
    return (agree - chance) / (1 - chance)


def estimate_cut(threshold: float) -> float:
    """Estimates of pairs at the threshold fall below this with odds of about 1e-9."""
    chance = 2.0 ** -BITS
    p = threshold + (1 - threshold) * chance
    return threshold - SIGMAS * (p * (1 - p) / (64 * PLANE_WORDS)) ** 0.5 / (1 - chance)


def near(threshold: float, a: str = "a", b: str = "b"):
    """Size test and estimate on columns n_<a>, planes_<a>, n_<b>, planes_<b>."""
    small, large = F.least(f"n_{a}", f"n_{b}"), F.greatest(f"n_{a}", f"n_{b}")
    t = round(threshold * 100)
    return (100 * small >= t * large) & (estimate(f"planes_{a}", f"planes_{b}") >= estimate_cut(threshold))


def shingle_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """Full shingle sets (rid, items) of the documents whose id is in ``wanted``."""
    texts = docs.select(F.col("doc_id").cast("long").alias("rid"), whole_text().alias("text"))
    return texts.join(wanted, "rid", "left_semi").mapInArrow(_sets(width), "rid long, items array<long>")


def similar(threshold: float, a: str = "items_a", b: str = "items_b"):
    """The exact test on two set columns."""
    common = F.size(F.array_intersect(a, b))
    return 100 * common >= round(threshold * 100) * (F.size(a) + F.size(b) - common)


def confirm(sets: DataFrame, pairs: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) whose full shingle sets reach the threshold."""
    both = (pairs.join(sets.select(F.col("rid").alias("a"), F.col("items").alias("items_a")), "a")
            .join(sets.select(F.col("rid").alias("b"), F.col("items").alias("items_b")), "b"))
    return both.where(similar(threshold)).select("a", "b").distinct()


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Smallest reachable rid of every node: minimum labels spread along the edges with
    pointer jumping; every round is a table in the shared folder."""
    both = stage(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    labels = nodes.select("rid", F.col("rid").alias("comp"))
    linked = stage(both.select(F.col("a").alias("rid")).distinct(), "linked")
    small = linked.select("rid", F.col("rid").alias("comp"))
    while True:
        told = (both.join(small.select(F.col("rid").alias("b"), "comp"), "b")
                .groupBy(F.col("a").alias("rid")).agg(F.min("comp").alias("heard")))
        heard = small.join(told, "rid", "left").select(
            "rid", "comp", F.least("comp", F.coalesce("heard", "comp")).alias("new"))
        jump = small.select(F.col("rid").alias("new"), F.col("comp").alias("far"))
        nxt = stage(heard.join(jump, "new", "left").select(
            "rid", F.least("new", F.coalesce("far", "new")).alias("comp"), F.col("comp").alias("old")), "labels")
        changed = nxt.where(F.col("comp") != F.col("old")).limit(1).count()
        small = nxt.select("rid", "comp")
        if not changed:
            break
    return labels.join(small.withColumnRenamed("comp", "found"), "rid", "left").select(
        "rid", F.coalesce("found", "comp").alias("comp"))


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (rid, comp) after new ``links`` (a, b): components run over the labels that the links join, so a
    round costs what its own links cost, whatever was linked before."""
    ends = links.join(labels.select(F.col("rid").alias("a"), F.col("comp").alias("ca")), "a").join(
        labels.select(F.col("rid").alias("b"), F.col("comp").alias("cb")), "b")
    edges = stage(ends.where("ca <> cb").select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")).distinct(), "contracted")
    touched = edges.select(F.col("a").alias("rid")).unionByName(edges.select(F.col("b").alias("rid"))).distinct()
    moved = components(touched, edges).select(F.col("rid").alias("comp"), F.col("comp").alias("into"))
    return labels.join(moved, "comp", "left").select("rid", F.coalesce("into", "comp").alias("comp"))


def _between(placed: DataFrame, reps: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Links between rows of a bucket that lie in different components.  The join condition
    tests components, sizes, estimate, that this bucket is the first the pair shares, and
    then the full sets, so that only links leave the join."""
    rest = placed.join(reps.join(sets, "rid"), "rid")

    def named(x):
        return rest.select("key", *[F.col(c).alias(f"{c}_{x}") for c in ("rid", "comp", "n", "planes", "bands", "items")])

    first = F.filter(F.zip_with("bands_a", "bands_b", lambda x, y: F.when(x == y, x)), lambda x: x.isNotNull())[0]
    both = named("a").join(named("b"), "key")
    both = both.where((F.col("comp_a") < F.col("comp_b")) & F.when(near(threshold), F.when(first == F.col("key"), similar(threshold))))
    return both.select(F.least("rid_a", "rid_b").alias("a"), F.greatest("rid_a", "rid_b").alias("b")).distinct()


def near_components(docs: DataFrame, threshold: float = 0.8, width: int = 4) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``."""
    signed = stage(signatures(docs, width), "signatures")
    identity = ["id0", "id1", "n"]
    sized = signed.where("n > 0").groupBy(*identity).agg(F.min("doc_id").alias("rid"), F.count("*").alias("rows")).where("rid IS NOT NULL")
    sized = stage(sized, "identities")
    classes = sized.select(*identity, "rid")
    # rows of a large exact group meet their class by a broadcast: at most HOT_SHARE sets have so many rows
    hot = F.col("rows") >= max(2, -(-signed.count() // HOT_SHARE))
    named = signed.select("doc_id", *identity)
    large = F.broadcast(sized.where(hot).select(*identity, "rid"))
    members = stage(named.join(large, identity).unionByName(
        named.join(large.select(*identity), identity, "left_anti").join(sized.where(~hot).select(*identity, "rid"), identity, "left")), "classes")
    reps = stage(signed.where("n > 0").join(classes.select(F.col("rid").alias("doc_id")), "doc_id", "left_semi")
                 .dropDuplicates(["doc_id", "id0", "id1"]).select(F.col("doc_id").alias("rid"), "n", "bands", "planes"), "representatives")
    bucket = reps.select("rid", F.explode("bands").alias("key"))
    shared = bucket.groupBy("key").agg(F.count("*").alias("rows")).where("rows > 1").select("key")
    rows = stage(bucket.join(shared, "key"), "buckets")
    sets = stage(shingle_sets(docs, rows.select("rid").distinct(), width), "near-sets")
    facts = reps.select("rid", "n", "planes")

    def side(name):
        return facts.select(F.col("rid").alias(name), F.col("n").alias(f"n_{name}"), F.col("planes").alias(f"planes_{name}"))

    nodes = reps.select("rid").distinct()
    tried = None
    labels = nodes.select("rid", F.col("rid").alias("comp"))
    for turn in range(STAR_ROUNDS + 1):
        placed = rows.join(labels, "rid")
        rank = F.xxhash64("rid", F.lit(turn)) if turn else F.col("rid")
        open_keys = (placed.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high"),
                                               F.min(F.struct(rank.alias("rank"), "rid", "comp")).alias("lead"))
                     .where("low < high"))
        open_keys = stage(open_keys, "open-buckets")
        if open_keys.isEmpty():
            break
        placed = placed.join(open_keys.select("key", F.col("lead.rid").alias("leader"), F.col("lead.comp").alias("leader_comp")), "key")
        if turn < STAR_ROUNDS:
            found = (placed.where(F.col("comp") != F.col("leader_comp"))
                     .select(F.least("rid", "leader").alias("a"), F.greatest("rid", "leader").alias("b")).distinct())
            found = found.join(side("a"), "a").join(side("b"), "b").where(near(threshold)).select("a", "b")
            found = stage(found if tried is None else found.join(tried, ["a", "b"], "left_anti"), "candidates")
            tried = found if tried is None else tried.unionByName(found)
            sure = stage(confirm(sets, found, threshold), "links")
        else:
            sure = stage(_between(placed.select("key", "rid", "comp"), reps, sets, threshold), "links")
        if not sure.isEmpty():
            labels = stage(merged(labels, sure), "components")
    out = members.join(labels, "rid", "left")
    component = F.coalesce("comp", "doc_id")
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(documents(spark, sf_dir).select("doc_id", "text"), threshold=0.8, width=4)


def stage_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each near-duplicate group (five-word shingles, similarity 0.8
    or more) the document with the smallest id stays."""
    groups = near_components(docs.select("doc_id", "text"), threshold=0.8, width=5)
    gone = stage(groups.where(~F.col("kept")).select("doc_id").distinct(), "near-gone")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


REGISTRY = {"op8_minhash": op8_minhash}

SQL = {"op8_minhash": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') IF x <> ''] AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(ws, i, i + 3), ' ') AS sh
  FROM (SELECT doc_id, ws, unnest(generate_series(1, greatest(1, len(ws) - 3))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT p.a, p.b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.sh = y.sh AND x.doc_id <> y.doc_id
                        GROUP BY 1, 2) p
  JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b WHERE 100 * c >= 80 * (na.n + nb.n - c)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM w
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
comp AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, comp.component_id, w.doc_id = comp.component_id AS kept
FROM w LEFT JOIN n USING (doc_id) JOIN comp USING (doc_id)"""}
