"""Operator 6, SentencePiece encoding and decoding over a relational lattice.

A text's units are its parts between two characters that stand side by side in no piece
(``piece_units``): most are words with the space before them.  A unit's substrings of bounded
length (that of the longest piece with the same first HEAD characters) are exploded and
equi-joined to the piece table (bounded by the model, hence broadcast);
the matches are the unit's edges, put together by unit and folded with ``aggregate``:

  * ``viterbi``: the path of largest summed score, the rule of unigram models;
  * ``bpe``: edges in the order of their scores merge the two pieces they span, the rule
    of BPE models.  The public model is one: under ``viterbi`` fewer than half of the test
    documents' words get the ids that the library gives, under ``bpe`` all do.

Characters without a piece become byte pieces.  Words with a unit of more than LONGEST
characters (text without spaces) go to the library under ``bpe``, as their cuts do not fit a
number and their substrings are many.

The corpus's units are counted, and those of the FREQUENT most used are encoded once and
broadcast (their number is bounded, their text by LONGEST).  All others are encoded where
their documents are, once a chunk of texts: no text and no id is shuffled, only the counts.
A chunk's units go through explode and join before its documents and keep their order, as
neither moves a row to another task; rows of one unit are thus side by side.  A document's ids
are put in order, decoded as a whole and compared with its own text.

Defined results: null and empty texts have no pieces; every row is a document of its own;
a text that holds a literal U+2581 has the ids that the library gives it, decodes to a space
in its place and so does not come back; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veracorp.llm import piece_units as U
from veracorp.llm.common import bound_batches, documents, stage, whole_text

SPACE = U.SPACE
LONGEST = 32
FREQUENT = 100_000
HEAD = 3            # first characters by which a substring's greatest length is looked up
_loaded: dict = {}


def library(path: str):
    """The library's processor of this Python process."""
    if path not in _loaded:
        import sentencepiece

        _loaded[path] = sentencepiece.SentencePieceProcessor(model_file=path)
    return _loaded[path]


class Pieces:
    """The model's piece table: bounded by the model file."""

    def __init__(self, path: str):
        self.path = path
        sp = library(path)
        every = range(sp.get_piece_size())
        self.first_byte = next(i for i in every if sp.is_byte(i))
        self.plain = [(sp.id_to_piece(i), i, sp.get_score(i)) for i in every
                      if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.lowest = min(s for _, _, s in self.plain)
        self.scores = sorted({s for _, _, s in self.plain}, reverse=True)
        self.cut = U.cut_table([p for p, _, _ in self.plain])
        self.hex = [sp.id_to_piece(i)[3:5] if sp.is_byte(i) else "" if sp.is_control(i) or sp.is_unknown(i)
                    else sp.id_to_piece(i).replace(SPACE, " ").encode().hex().upper() for i in every]

    def table(self, spark: SparkSession) -> DataFrame:
        """piece, edge: the piece's edge at the start of a unit."""
        rank = {s: r for r, s in enumerate(self.scores)}
        # the empty piece gives every unit a row, also if no piece matches
        return spark.createDataFrame([("", 0), *((p, rank[s] << 44 | len(p) << 20 | i) for p, i, s in self.plain)], "piece string, edge long")


    def reach(self, spark: SparkSession) -> DataFrame:
        """head, longest: the length of the longest piece with these first HEAD characters."""
        longest: dict = {}
        for p, _, _ in self.plain:
            if len(p) >= HEAD:
                longest[p[:HEAD]] = max(len(p), longest.get(p[:HEAD], 0))
        return spark.createDataFrame(list(longest.items()), "head string, longest int")


# SQL: an edge is one number, made of its score's rank, its start, its length and its piece's id; so edges sort by score, then start
def _start(edge: str) -> str:
    return f"CAST(shiftright({edge}, 28) & 65535 AS INT)"


def _length(edge: str) -> str:
    return f"CAST(shiftright({edge}, 20) & 255 AS INT)"


def _id(edge: str) -> str:
    return f"CAST({edge} & 1048575 AS INT)"


def _edges(rows: DataFrame, pieces: Pieces, *others: str) -> DataFrame:
    """unit (on one row of every unit), edge, others: the lattice of every unit, unit by unit in the order of ``rows``."""
    starts = (rows.select("unit", *others, F.explode(F.expr("sequence(0, greatest(length(unit) - 1, 0))")).alias("s"))
              .withColumn("head", F.expr(f"substring(unit, s + 1, {HEAD})"))
              .join(F.broadcast(pieces.reach(rows.sparkSession)), "head", "left"))
    spans = (starts.select("unit", *others, "s", F.explode(F.expr(
                f"sequence(if(s = 0, 0, 1), least(coalesce(longest, {HEAD} - 1), length(unit) - s))")).alias("l"))
             .withColumn("piece", F.expr("substring(unit, s + 1, l)")))
    found = spans.join(F.broadcast(pieces.table(rows.sparkSession)), "piece")
    return found.select("unit", "l", F.expr("edge | shiftleft(CAST(s AS BIGINT), 28)").alias("edge"), *others)


# SQL: the bytes of a character without a piece, as ids
_BYTES = """transform(sequence(1, length(hex(encode({c}, 'UTF-8'))) div 2),
    j -> CAST(conv(substring(hex(encode({c}, 'UTF-8')), 2 * j - 1, 2), 16, 10) AS INT) + {first})"""


def _bpe(unit: str, edges: str, pieces: Pieces) -> str:
    """SQL: fold over the edges from the best score down: an edge that joins two adjacent pieces
    merges them.  The cuts between pieces are the bits of a number m.  As a piece scores worse
    than the pieces it is made of, an edge that does not join two pieces when its turn
    comes never will."""
    def seen(e: str) -> str:        # the cuts from an edge's start to its end
        return f"shiftright(m, {_start(e)}) & (shiftleft(2L, {_length(e)}) - 1L)"

    fold = f"""aggregate(sort_array(filter({edges}, e -> {_length('e')} > 1)), shiftleft(2L, length({unit})) - 1L,
               (m, e) -> if(bit_count({seen('e')}) = 3 AND (shiftright(m, {_start('e')}) & 1L) = 1L AND (shiftright(m, {_start('e')} + {_length('e')}) & 1L) = 1L,
                            m & ~shiftleft(shiftleft(1L, {_length('e')}) - 2L, {_start('e')}), m))"""
    path = f"""sort_array(transform(filter({edges}, e -> {_length('e')} > 0 AND ({seen('e')}) = shiftleft(1L, {_length('e')}) + 1L), e -> e & (shiftleft(1L, 44) - 1L)))"""
    own = _BYTES.format(c=f"substring({unit}, i + 1, 1)", first=pieces.first_byte)
    missing = f"""flatten(transform(filter(sequence(0, length({unit}) - 1), i -> (shiftright(m, i) & 1L) = 1L), i ->
                  if(exists(p, e -> {_start('e')} = i), transform(filter(p, e -> {_start('e')} = i), e -> {_id('e')}), {own})))"""
    # values that a lambda uses are bound by a transform over one element: as columns they would be worked out again for every use
    return f"""transform(array({fold}), m -> transform(array({path}), p ->
               if(size(p) = bit_count(m) - 1, transform(p, e -> {_id('e')}), {missing}))[0])[0]"""


def _viterbi(unit: str, edges: str, pieces: Pieces) -> str:
    """SQL fold: best score and path at every position, over edges by end and start."""
    unknown = pieces.lowest - 10
    scores = f"split('{','.join(map(repr, pieces.scores))}', ',')"
    chars = f"""transform(sequence(0, length({unit}) - 1), i -> named_struct('e', i + 1, 's', i, 'score', CAST({unknown} AS DOUBLE), 'id', -1))"""
    known = f"""transform(filter({edges}, x -> {_length('x')} > 0), x -> named_struct('e', {_start('x')} + {_length('x')}, 's', {_start('x')},
                'score', CAST(get({scores}, CAST(shiftright(x, 44) AS INT)) AS DOUBLE), 'id', {_id('x')}))"""
    missing = f"filter({chars}, c -> NOT exists({edges}, x -> {_length('x')} = 1 AND {_start('x')} = c.s))"
    bytes_of = _BYTES.format(c=f"substring({unit}, e.s + 1, 1)", first=pieces.first_byte)
    return f"""aggregate(array_sort(concat({known}, {missing})), array(named_struct('score', CAST(0 AS DOUBLE), 'ids', CAST(array() AS ARRAY<INT>))),
        (best, e) -> transform(array(named_struct('score', best[e.s].score + e.score,
                'ids', concat(best[e.s].ids, if(e.id >= 0, array(e.id), {bytes_of})))), x ->
            CASE WHEN size(best) <= e.e THEN concat(best, array(x))
                 WHEN x.score > best[e.e].score THEN concat(slice(best, 1, e.e), array(x)) ELSE best END)[0],
        best -> best[length({unit})].ids)"""


_RULES = {"bpe": _bpe, "viterbi": _viterbi}


def _by_library(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = library(path)
        for batch in batches:
            texts = [u[1:].replace(SPACE, " ") for u in batch.column("unit").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("unit"), batch.column("n"), pa.array(sp.encode(texts), pa.list_(pa.int32()))],
                                             names=["unit", "n", "ids"])
    return run


def encode_units(vocabulary: DataFrame, pieces: Pieces, rule: str = "bpe") -> DataFrame:
    """unit, n, ids of distinct units (unit, n)."""
    short = vocabulary.where(F.length("unit") <= LONGEST) if rule == "bpe" else vocabulary
    lattice = _edges(short, pieces, "n").groupBy("unit", "n").agg(F.collect_list("edge").alias("edges"))
    coded = lattice.select("unit", "n", F.expr(_RULES[rule]("unit", "edges", pieces)).alias("ids"))
    if rule == "viterbi":
        return coded
    long = vocabulary.where(F.length("unit") > LONGEST).mapInArrow(_by_library(pieces.path), "unit string, n long, ids array<int>")
    return coded.unionByName(long)


def decoded(ids: str, pieces: Pieces):
    """Column: the text of an array of ids, with its spaces; the piece table is a literal."""
    table = F.split(F.lit(",".join(pieces.hex)), ",")
    return F.decode(F.unhex(F.array_join(F.transform(ids, lambda i: table[i]), "")), "UTF-8")


def vocabulary(docs: DataFrame, pieces: Pieces, rule: str = "bpe") -> DataFrame:
    """unit, n (occurrences) of the corpus's distinct units that the lattice takes."""
    bound_batches(docs.sparkSession)
    counted = docs.select(whole_text().alias("text")).mapInArrow(U.counting(pieces.cut, _longest(rule)), "unit string, n long")
    return counted.groupBy("unit").agg(F.sum("n").alias("n")).select(F.replace("unit", F.lit(" "), F.lit(SPACE)).alias("unit"), "n")


def _longest(rule: str) -> int | None:
    return LONGEST if rule == "bpe" else None


def _frequent(words: DataFrame, pieces: Pieces, rule: str) -> list:
    """(unit, ids) of the most used units, at most FREQUENT of at most LONGEST characters."""
    words = words.where(F.length("unit") <= LONGEST)
    sizes = words.groupBy("n").agg(F.count("*").alias("c"))
    top = sizes.orderBy(F.desc("n")).limit(FREQUENT).collect()      # few distinct counts; a class of count n holds one unit at least
    total, least = 0, None
    for r in top:
        total += r["c"]
        if total > FREQUENT:
            break
        least = r["n"]
    if least is None:
        return []
    often = encode_units(words.where(F.col("n") >= least), pieces, rule).select("unit", "ids").collect()
    return [(r["unit"].replace(SPACE, " "), r["ids"]) for r in often]


def _whole_words(path: str):
    return lambda words: library(path).encode(words)


def encode(docs: DataFrame, path: str | None = None, rule: str = "bpe") -> DataFrame:
    """doc_id, text, n_units (words with the spaces before them), ids (the token ids, in order) of every row of ``docs``."""
    spark = docs.sparkSession
    pieces = Pieces(path or public_tokenizers.path("piece_bpe_32k.model"))
    words = stage(vocabulary(docs, pieces, rule), "piece-units")
    table = spark.sparkContext.broadcast(U.known_units(_frequent(words, pieces, rule)))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    rows = own.mapInArrow(U.cutting(pieces.cut, _longest(rule), table, _whole_words(pieces.path)), U.CUT_SCHEMA)
    rows = rows.withColumn("unit", F.replace("unit", F.lit(" "), F.lit(SPACE)))
    named = F.when(F.col("l") == 0, F.col("unit")).alias("unit")
    edges = _edges(rows, pieces, "k", "doc_id", "text", "n_units", "code").select("k", "edge", named, "doc_id", "text", "n_units", "code")
    fold = _RULES[rule]("r.unit", "r.edges", pieces)
    ids = F.expr(f"flatten(transform(runs, r -> if(r.unit IS NULL, r.ids, concat(r.ids, {fold}))))").alias("ids")
    return edges.mapInArrow(U.gathering, U.RUNS_SCHEMA).select("doc_id", "text", "n_units", ids)


def decode(coded: DataFrame, path: str | None = None) -> DataFrame:
    """Encoded documents (doc_id, ids) with the text of their ids; the space put before a text is taken off."""
    pieces = Pieces(path or public_tokenizers.path("piece_bpe_32k.model"))
    return coded.withColumn("text", F.substr(decoded("ids", pieces), F.lit(2)))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: units, pieces, its ids in order, and whether they decode to its own text."""
    coded = encode(documents(spark, sf_dir).select("doc_id", "text")).withColumnRenamed("text", "own")
    return decode(coded).select("doc_id", "n_units", F.size("ids").cast("long").alias("n_pieces"), "ids",
                                (F.col("text") == F.col("own")).alias("round_trip"))


REGISTRY = {"op6_sentencepiece": op6_sentencepiece}
