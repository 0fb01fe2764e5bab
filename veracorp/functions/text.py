"""Column -> Column text operators.

All of these are built-in JVM expressions (regexp_replace, regexp_extract_all,
higher-order array functions), so they stay inside whole-stage codegen and
never cross into Python.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import groupby
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from veracorp.functions import patterns as P
from veracorp.functions.lexicon import DEFAULT_STOPWORDS, DOMAIN_STOPWORDS


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# --- cleaning (T1-T9) --------------------------------------------------------

def strip_tags(col) -> Column:                     # T1
    return F.regexp_replace(_c(col), P.HTML_TAG, " ")


def mask_urls(col) -> Column:                      # T2
    return F.regexp_replace(_c(col), P.URL, P.URL_TOKEN)


def mask_emails(col) -> Column:                    # T3
    return F.regexp_replace(_c(col), P.EMAIL, P.EMAIL_TOKEN)


def mask_mentions(col) -> Column:                  # T4
    return F.regexp_replace(_c(col), P.MENTION, P.MENTION_TOKEN)


def unwrap_hashtags(col) -> Column:                # T5
    return F.regexp_replace(_c(col), P.HASHTAG, " $1 ")


def squeeze_punctuation(col) -> Column:            # T6
    return F.regexp_replace(_c(col), P.REPEATED_PUNCT, "$1")


def drop_emoji(col) -> Column:                     # T7
    return F.regexp_replace(_c(col), P.EMOJI_RUN, " ")


def squash_whitespace(col) -> Column:              # T8 / T26
    return F.trim(F.regexp_replace(_c(col), P.WS_RUN, " "))


def strip_edges(col) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode whitespace (linear character-set trim)."""
    return F.btrim(_c(col), F.lit(P.WS_LITERAL))


def clean_text(col) -> Column:                     # T9
    """The whole cleaner, T1..T8 in order; null (or non-text) gives ''."""
    c = F.coalesce(_c(col).cast("string"), F.lit(""))
    for step in (strip_tags, mask_urls, mask_emails, mask_mentions, unwrap_hashtags,
                 squeeze_punctuation, drop_emoji):
        c = step(c)
    return F.lower(squash_whitespace(c))


# --- tokenisers ---------------------------------------------------------------

def word_tokens(col, lowercase: bool = True) -> Column:
    """``\\b\\w+\\b`` tokens (bag-of-words pattern)."""
    c = F.lower(_c(col)) if lowercase else _c(col)
    return F.regexp_extract_all(c, F.lit(P.WORD_RUN), 0)


def word_tokens_2plus(col, lowercase: bool = True) -> Column:
    """``\\b\\w\\w+\\b`` tokens (TF-IDF default pattern)."""
    return F.filter(word_tokens(col, lowercase), lambda t: F.length(t) >= 2)


def regex_tokens(col) -> Column:                   # T11
    return F.regexp_extract_all(_c(col), F.lit(P.REGEX_TOKEN), 0)


def whitespace_tokens(col) -> Column:              # T14
    return F.filter(F.split(F.lower(_c(col)), P.WS_RUN), lambda t: t != "")


# Treebank-style rules (T12).  A published rule set (spacing out punctuation,
# brackets, quotes and clitics) applied as one regexp chain, then split on
# whitespace.  They are meant for one sentence; ``operators.sentences`` splits
# texts into sentences first.  Row-wise uses without a corpus (requests, streams)
# take the whole text as one and separate each period that ends a word.
TREEBANK_RULES = (
    (r'^"', "``"),
    (r"(``)", " $1 "),
    (r'([ (\[{<])("|\'\')', "$1 `` "),
    (r"([:,])([^\p{Nd}])", " $1 $2"),
    (r"([:,])$", " $1 "),
    (r"\.\.\.", " ... "),
    (r"[;@#$%&]", " $0 "),
    (r"([^.])(\.)([\]\)}>\"']*)[" + P.WS_CHARS + r"]*$", "$1 $2$3 "),
    (r"[?!]", " $0 "),
    (r"([^'])' ", "$1 ' "),
    (r"[\]\[\(\)\{\}<>]", " $0 "),
    (r"--", " -- "),
    (r'"', " '' "),
    (r"([^" + P.WS_CHARS + r"])('')", "$1 $2 "),
    (r"([^' ])('[sS]|'[mM]|'[dD]|') ", "$1 $2 "),
    (r"([^' ])('ll|'LL|'re|'RE|'ve|'VE|n't|N'T) ", "$1 $2 "),
    (r"(?i)\b(can)(not)\b", " $1 $2 "),
    (r"(?i)\b(d)('ye)\b", " $1 $2 "),
    (r"(?i)\b(gim)(me)\b", " $1 $2 "),
    (r"(?i)\b(gon)(na)\b", " $1 $2 "),
    (r"(?i)\b(got)(ta)\b", " $1 $2 "),
    (r"(?i)\b(lem)(me)\b", " $1 $2 "),
    (r"(?i)\b(more)('n)\b", " $1 $2 "),
    (r"(?i)\b(wan)(na)[" + P.WS_CHARS + "]", " $1 $2 "),
    (r"(?i) ('t)(is)\b", " $1 $2 "),
    (r"(?i) ('t)(was)\b", " $1 $2 "),
)


# Stands before the question marks: a period after a small letter or mark, before white space.
_INNER_PERIOD = (r"([^.\p{Lu}])(\.)([" + P.WS_CHARS + r"])", "$1 $2$3")
_PERIOD_RULE_AT = next(i for i, (pattern, _) in enumerate(TREEBANK_RULES) if pattern == r"[?!]")


# What a text holds wherever a rule changes it (one of these): most texts lack it and skip the rule.
_NEEDS = {
    r'^"': ('"',), r"(``)": ("``",), r'([ (\[{<])("|\'\')': ('"', "''"), r"([:,])([^\p{Nd}])": (":", ","), r"([:,])$": (":", ","),
    r"\.\.\.": ("...",), r"[?!]": ("?", "!"), r"([^'])' ": ("'",), r"--": ("--",), r'"': ('"',),
    r"([^" + P.WS_CHARS + r"])('')": ("''",), r"([^' ])('[sS]|'[mM]|'[dD]|') ": ("'",),
    r"([^' ])('ll|'LL|'re|'RE|'ve|'VE|n't|N'T) ": ("'",), r"(?i)\b(d)('ye)\b": ("'",), r"(?i)\b(more)('n)\b": ("'",),
    r"(?i) ('t)(is)\b": ("'",), r"(?i) ('t)(was)\b": ("'",), _INNER_PERIOD[0]: (".",),
    r"([^.])(\.)([\]\)}>\"']*)[" + P.WS_CHARS + r"]*$": (".",),
}
# Contractions that are whole words of letters cannot overlap, nor make one another: one pass finds them all.
_JOINED = (r"(?i)\b(can)(not)\b", r"(?i)\b(gim)(me)\b", r"(?i)\b(gon)(na)\b", r"(?i)\b(got)(ta)\b", r"(?i)\b(lem)(me)\b")
_JOINED_RULE = (r"(?i)\b(can(?=not\b)|gim(?=me\b)|gon(?=na\b)|got(?=ta\b)|lem(?=me\b))(not|me|na|ta)\b", " $1 $2 ")


def _fewer_passes(rules) -> list[tuple]:
    """The same replacements: those of ``_JOINED`` as one, at the place of the first."""
    out = [r for r in rules if r[0] not in _JOINED]
    at = next((i for i, r in enumerate(rules) if r[0] in _JOINED), None)
    if at is not None:
        assert sum(r[0] in _JOINED for r in rules) == len(_JOINED)
        out.insert(at, _JOINED_RULE)
    return out


def _replaced(text: Column, rules) -> Column:
    for pat, rep in rules:
        text = F.regexp_replace(text, pat, rep)
    return text


def _replaced_where(needs, rules):
    def one(text: Column) -> Column:
        held = reduce(or_, [F.contains(text, F.lit(n)) for n in needs])
        return F.when(held, _replaced(text, rules)).otherwise(text)
    return one


def _split_by(rules, col: Column) -> Column:
    c = F.concat(F.lit(" "), col, F.lit(" "))
    for needs, group in groupby(_fewer_passes(rules), key=lambda r: _NEEDS.get(r[0])):
        # the text is bound once, by a one-element transform
        c = F.get(F.transform(F.array(c), _replaced_where(needs, list(group))), 0) if needs else _replaced(c, group)
    return F.filter(F.split(F.trim(c), P.WS_RUN), lambda t: t != "")


def treebank_sentence_tokens(col) -> Column:       # T12, one sentence
    return _split_by(TREEBANK_RULES, _c(col))


def treebank_rules_for_texts():
    """The rules for a whole text that is not split into sentences."""
    return (*TREEBANK_RULES[:_PERIOD_RULE_AT], _INNER_PERIOD, *TREEBANK_RULES[_PERIOD_RULE_AT:])


def treebank_tokens(col) -> Column:                # T12 without sentences
    return _split_by(treebank_rules_for_texts(), _c(col))


# --- stopwords (T17, T18) and token filters ---------------------------------

def stopword_list(custom: bool) -> Sequence[str]:
    return DOMAIN_STOPWORDS if custom else DEFAULT_STOPWORDS


def _stop_array(words: Sequence[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def kept_tokens(tokens, custom: bool = True) -> Column:
    stop = _stop_array(stopword_list(custom))
    return F.filter(_c(tokens), lambda t: ~F.array_contains(stop, F.lower(t)))


def removed_tokens(tokens, custom: bool = True) -> Column:
    stop = _stop_array(stopword_list(custom))
    return F.filter(_c(tokens), lambda t: F.array_contains(stop, F.lower(t)))


def min_length_tokens(tokens, n: int) -> Column:   # T24
    return F.filter(_c(tokens), lambda t: F.length(t) >= n)


def join_tokens(tokens) -> Column:
    return F.array_join(_c(tokens), " ")


# --- keyword and marker predicates (T25, T27) --------------------------------

def any_keyword(col, keywords: Sequence[str]) -> Column:
    low = F.lower(_c(col))
    return F.exists(F.array(*[F.lit(k) for k in keywords]), lambda k: F.instr(low, k) > 0)


def marker_words(col, markers: Sequence[str]) -> Column:
    """Lower-case ASCII words of the text that are marker words (with repeats)."""
    words = F.regexp_extract_all(F.lower(_c(col)), F.lit(P.LOWER_ASCII_WORD), 0)
    m = F.array(*[F.lit(w) for w in markers])
    return F.filter(words, lambda w: F.array_contains(m, w))


# --- P1: joined text columns ----------------------------------------------------

def coalesce_text(cols: Sequence) -> Column:
    """Join the given columns by a space (null -> ''), collapse whitespace, trim."""
    if not cols:
        raise ValueError("none of the configured text columns is present")
    parts = [F.coalesce(_c(c).cast("string"), F.lit("")) for c in cols]
    return strip_edges(F.regexp_replace(F.concat_ws(" ", *parts), P.WS_RUN, " "))
