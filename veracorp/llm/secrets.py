"""Operator 2, secret scans by dictionary-primed zstandard novelty.

Three patterns find the usual forms (assignments, access keys, long hexadecimal runs).
The method adds what has no fixed form: a candidate is a run of CANDIDATE characters of
mixed classes that follows a sensitive word within REACH characters.  Its novelty is the
number of bytes by which the compressed size of its surroundings grows when it is put
in, per character, with the compressor primed by a dictionary of common identifiers.  A
name that the code around it or the dictionary already holds costs few bytes; a
candidate of MIN_NOVELTY or more is incompressible and reported as ``novel``.

Each document is scanned on its own inside map tasks; nothing is shuffled.

Defined results: null and empty texts have no spans; repeated rows are scanned each; an
empty table gives an empty result; columns of the input are carried in a struct.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veracorp.llm.common import documents, whole_text

# The kinds in the order in which they are listed, and their patterns.
KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
ASSIGN_LENGTH = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LENGTH = 20
HEX = re.compile(r"[0-9a-f]{24,}")
HEX_BYTES = re.compile(rb"[0-9a-f]{24,}")

SENSITIVE = (b"key", b"secret", b"token", b"pass", b"pwd", b"auth", b"cred", b"bearer", b"private", b"signature")
CONTEXT = re.compile(r"(?ai:key|secret|token|pass|pwd|auth|cred|bearer|private|signature)")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
REACH = 48
SURROUND = 512
MIN_NOVELTY = 0.6
# Identifiers that prime the compressor.
IDENTIFIERS = """
access accessor account action address algorithm allow alpha append application argument array assert async attribute
authorization backend base64 basic batch bearer boolean buffer build builder bytes cache callback certificate channel
character class client close cluster code collection column command comment commit compile config configuration connect
connection const constructor container content context controller cookie copy count create credential current cursor
customer data database dataset date debug decode default define delete dependency description develop device dictionary
digest directory disable document domain download driver element email enable encode encoding endpoint engine entity
enum environment error event example exception execute export expression extend extension external factory false feature
field file filter final fingerprint float folder format function gateway generate global graph group handler hash header
helper hidden host identifier implement import include index infrastructure init insert instance integer interface
internal invalid iterator javascript kernel keyword lambda language length level library license limit listener load
local location lock log logger login logout machine main manager manifest map mapper master match max member memory
message metadata method metric middleware min mode model module monitor mount multiple mutable name namespace native
network next node notification null number object observer offset operation operator option order organization origin
output override owner package page parameter parent parse parser partition password patch path pattern payload pending
permission persist platform plugin pointer policy pool port position prefix previous primary private process processor
product profile program project promise property protocol provider proxy public publish query queue random range read
reader receive record redirect reference refresh region register registry release remote remove render replace replica
report repository request require reset resolve resource response rest result retry return role root route router runtime
sample save schedule schema scope script search secret section secure security select sequence serial server service
session setting setup shard share signature simple size socket source stack stage start state static statistics status
storage store stream string structure submit subscribe success suffix switch symbol sync system table target task template
temporary tenant test thread threshold time timeout timestamp title token trace track transaction transfer transform
transport trigger type undefined unique unit update upload upper user username util utility valid validate validator value
variable vector vendor verify version view virtual visible volume wait warning watch webhook widget window worker workflow
workspace wrapper write writer yield zone
""".split()


def _compressor() -> zstandard.ZstdCompressor:
    primed = zstandard.ZstdCompressionDict(" ".join(IDENTIFIERS).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(level=9, dict_data=primed, write_content_size=False, write_checksum=False, write_dict_id=False)


def novelty(squeeze: zstandard.ZstdCompressor, before: str, candidate: str, after: str) -> float:
    """Marginal compressed bytes of ``candidate`` per character."""
    base = len(squeeze.compress((before + after).encode()))
    return (len(squeeze.compress((before + candidate + after).encode())) - base) / len(candidate)


def _mixed(s: str) -> bool:
    """Digits and letters, or cases that do not look like a word."""
    digit, lower, upper = any(c.isdigit() for c in s), any(c.islower() for c in s), any(c.isupper() for c in s[1:])
    return (digit and (lower or upper)) or (lower and upper and not re.fullmatch(r"[A-Z]?[a-z]+([A-Z][a-z]+)*", s))


def base_spans(text: str, coded: bytes) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the three patterns, leftmost and non-overlapping per kind."""
    out = []
    low = coded.lower()
    if any(w in low for w in ASSIGN_WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LENGTH]
    if b"AKIA" in coded:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LENGTH]
    if HEX_BYTES.search(coded):
        out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def novel_spans(text: str, coded: bytes, base: list, squeeze) -> list[tuple[int, int, int]]:
    """Incompressible candidates in sensitive context that no base span overlaps."""
    low = coded.lower()
    if not any(w in low for w in SENSITIVE):
        return []
    taken = [(a, b) for a, _, b in base]
    out = []
    for m in CANDIDATE.finditer(text):
        a, b = m.span()
        if not _mixed(m[0]) or not CONTEXT.search(text, max(0, a - REACH), a) or any(x < b and a < y for x, y in taken):
            continue
        if novelty(squeeze, text[max(0, a - SURROUND):a], m[0], text[b:b + SURROUND]) >= MIN_NOVELTY:
            out.append((a, 3, b))
    return out


def _digest(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every merged run of spans replaced by a mark."""
    out, at = [], 0
    for a, _, b in sorted(spans):
        if a >= at:
            out += [text[at:a], "[SECRET]"]
        at = max(at, b)
    return "".join(out) + text[at:]


_FOUND = ("row {row}, n_assign long, n_access long, n_hex long, n_novel long, base_sha256 string, spans string, redacted string")


def _scan(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = _compressor()
        for batch in batches:
            counts, shas, spans, clean = [], [], [], []
            for text in batch.column("text").to_pylist():
                coded = text.encode()
                base = base_spans(text, coded)
                new = novel_spans(text, coded, base, squeeze)
                every = sorted(base + new)
                counts.append([sum(k == j for _, k, _ in every) for j in range(4)])
                shas.append(hashlib.sha256(_digest(base).encode()).hexdigest())
                spans.append(_digest(every))
                clean.append(redact(text, every) if with_text and every else None)
            columns = [pa.array(c, pa.int64()) for c in zip(*counts)] if counts else [pa.array([], pa.int64())] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), *columns, pa.array(shas, pa.string()), pa.array(spans, pa.string()), pa.array(clean, pa.string())],
                names=["row", "n_assign", "n_access", "n_hex", "n_novel", "base_sha256", "spans", "redacted"])
    return run


def scan(docs: DataFrame, carry: list[str], with_text: bool = False) -> DataFrame:
    """Struct ``row`` (the ``carry`` columns) with the counts, spans and, where asked for
    and any span was found, the redacted text."""
    rows = docs.select(F.struct(*carry).alias("row"), whole_text().alias("text"))
    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(_scan(with_text), _FOUND.format(row=kind))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(documents(spark, sf_dir).select("doc_id", "text"), ["doc_id"])
    return found.select("row.doc_id", "n_assign", "n_access", "n_hex", "n_novel", "base_sha256", "spans")


def stage_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every document stays; its secrets are replaced in the text."""
    found = scan(docs, docs.columns, with_text=True)
    out = []
    for c in docs.columns:
        old = F.col("row").getField(c)
        if c == "text":
            old = F.coalesce("redacted", old)
        elif c == "n_chars":
            old = F.when(F.col("redacted").isNotNull(), F.length("redacted").cast(docs.schema[c].dataType)).otherwise(old)
        out.append(old.alias(c))
    return found.select(*out)


REGISTRY = {"op2_secrets": op2_secrets}
