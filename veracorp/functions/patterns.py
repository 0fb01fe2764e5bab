"""Regular expressions, written once in a dialect both Java regex (Spark) and
RE2 (the SQL oracle) read identically.

Python's ``\\s``/``\\w``/``\\d`` are Unicode-aware while Java's are ASCII unless
``(?U)`` is given and RE2's are always ASCII, so the classes are spelled out:
whitespace as Python's ``str.isspace`` set, word characters as letters,
numbers and underscore, digits as ``\\p{Nd}``.

FIXED VALUES: the patterns below reproduce the cleaning and tokenising rules.
"""

# --- Fixed values -----------------------------------------------------------

# The rules as published, in Python regex syntax, in the order they are applied:
#   html tags            <[^>]+>                                   -> " "
#   urls                 http[s]?://\S+|www\.\S+                   -> " [URL] "
#   emails               [a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}  -> " [EMAIL] "
#   mentions             @\w+                                      -> " [MENTION] "
#   hashtags             #(\w+)                                    -> " \1 "
#   repeated punctuation ([!?.,])\1{1,}                            -> "\1"
#   emoji                [\U0001F300-\U0001FAFF\U00002700-\U000027BF\U000024C2-\U0001F251]+  -> " "
#   whitespace           \s+                                       -> " ", then strip, then lower
#   regex tokens         [A-Za-z]+(?:'[A-Za-z]+)?|\d+|(?:\[URL\]|\[EMAIL\]|\[MENTION\])
#   reference words      [A-Za-z]+(?:'[A-Za-z]+)?
#   bag-of-words tokens  (?u)\b\w+\b        TF-IDF tokens  (?u)\b\w\w+\b
#   contractions         \b\w+'\w+\b        lower words  [a-z]+
# Below, the same rules in the engine-neutral dialect (Unicode classes spelled out).

# Characters Python treats as whitespace.
WS_CHARS = (r"\t\n\x{0B}\f\r \x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
            r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")
WS_RUN = "[" + WS_CHARS + "]+"
NON_WS_RUN = "[^" + WS_CHARS + "]+"
WORD_CHAR = r"[\p{L}\p{N}_]"
WORD_RUN = WORD_CHAR + "+"
EDGE_WS = r"\A[" + WS_CHARS + r"]+|[" + WS_CHARS + r"]+\z"
# The same whitespace set as literal characters (for character-set trimming).
WS_LITERAL = ("\t\n\x0b\x0c\r \x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B))
              + "\u2028\u2029\u202f\u205f\u3000")

HTML_TAG = r"<[^>]+>"
URL = r"http[s]?://" + NON_WS_RUN + r"|www\." + NON_WS_RUN
EMAIL = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
MENTION = "@" + WORD_RUN
HASHTAG = "#(" + WORD_RUN + ")"
REPEATED_PUNCT = r"([!?.,])\1{1,}"
PUNCT_MARKS = ("!", "?", ".", ",")
EMOJI_RUN = r"[\x{1F300}-\x{1FAFF}\x{2700}-\x{27BF}\x{24C2}-\x{1F251}]+"

URL_TOKEN, EMAIL_TOKEN, MENTION_TOKEN = " [URL] ", " [EMAIL] ", " [MENTION] "

# Regex tokeniser: words with one apostrophe part, digit runs, placeholders.
REGEX_TOKEN = r"[A-Za-z]+(?:'[A-Za-z]+)?|\p{Nd}+|(?:\[URL\]|\[EMAIL\]|\[MENTION\])"
# Reference-vocabulary words (tokeniser comparison).
ALPHA_WORD = r"[A-Za-z]+(?:'[A-Za-z]+)?"
# Contractions and lower-case ASCII words inside a text.
CONTRACTION_WORD = WORD_RUN + "'" + WORD_RUN
LOWER_ASCII_WORD = r"[a-z]+"
