"""Word lists and small lookup tables.

FIXED VALUES: everything in this module must equal the published behaviour
being reproduced, so it is stated plainly, in natural order, as data.
"""

# --- Fixed values -----------------------------------------------------------

# Class domain (three-class corpus).
CANONICAL_CLASSES = ("Real", "Fake", "Satire")

# English stopword list as distributed with NLTK 3.8.1 (179 words, file order).
ENGLISH_STOPWORDS = (
    "i me my myself we our ours ourselves you you're you've you'll you'd your yours "
    "yourself yourselves he him his himself she she's her hers herself it it's its "
    "itself they them their theirs themselves what which who whom this that that'll "
    "these those am is are was were be been being have has had having do does did "
    "doing a an the and but if or because as until while of at by for with about "
    "against between into through during before after above below to from up down "
    "in out on off over under again further then once here there when where why how "
    "all any both each few more most other some such no nor not only own same so "
    "than too very s t can will just don don't should should've now d ll m o re ve "
    "y ain aren aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn "
    "hasn't haven haven't isn isn't ma mightn mightn't mustn mustn't needn needn't "
    "shan shan't shouldn shouldn't wasn wasn't weren weren't won won't wouldn wouldn't"
).split()

# Words the domain list keeps although they are default stopwords (15).
KEEP_WORDS = (
    "not", "no", "nor", "never", "cannot", "can't", "won't", "don't", "shouldn't",
    "completely", "absolutely", "definitely", "clearly", "obviously", "without",
)

# Words the domain list adds (15).
DOMAIN_WORDS = (
    "breaking", "share", "post", "article", "news", "reported", "reportedly", "says",
    "said", "via", "amp", "thread", "update", "watch", "read",
)

# Code-switch marker words (24).
CODE_SWITCH_MARKERS = (
    "acha", "awam", "baji", "banda", "bilkul", "fake", "hai", "hain", "ho", "hukumat",
    "insaaf", "jhoot", "kia", "kya", "magar", "masla", "news", "nahi", "pakistan",
    "qaum", "sach", "sarkar", "shayad", "yeh",
)

# Topic keywords for feed filtering (10).
TOPIC_KEYWORDS = (
    "covid", "covid-19", "coronavirus", "vaccine", "vaccination", "booster",
    "pandemic", "omicron", "lockdown", "mask",
)

# Reliability scorecard rules: (substring, score), first hit wins.
CREDIBILITY_RULES = (("liar", 5), ("isot", 4), ("covid", 4))
CREDIBILITY_DEFAULT = 3
RELEVANCE_TERMS = ("pakistan", "dawn", "geo", "ary")
RELEVANCE_SCORE, RELEVANCE_COVID, RELEVANCE_DEFAULT = 5, 3, 2
# Recency by mean year: (lower bound, score); no year -> 2.
RECENCY_RULES = ((2023, 5), (2021, 4), (2019, 3))
RECENCY_DEFAULT = 2
# Balance by max/min class ratio: (upper bound inclusive, score); else 1.
BALANCE_RULES = ((1.25, 5), (1.75, 4), (2.5, 3), (4.0, 2))
# Consistency by coefficient of variation: (upper bound exclusive, score); else 1.
CONSISTENCY_RULES = ((0.45, 5), (0.8, 4), (1.2, 3), (1.6, 2))

# Label maps per source kind.
LABEL_MAP_SIX_WAY = {
    "true": "Real", "mostly-true": "Real", "half-true": "Real",
    "barely-true": "Fake", "false": "Fake", "pants-fire": "Fake",
}
LABEL_MAP_TRUE_FAKE = {"true": "Real", "real": "Real", "fake": "Fake"}
LABEL_MAP_BINARY = {"0": "Real", "1": "Fake", "real": "Real", "fake": "Fake", "true": "Real", "false": "Fake"}
LABEL_MAP_THREE_WAY = {"real": "Real", "fake": "Fake", "satire": "Satire", "true": "Real", "false": "Fake"}

# Six-run preprocessing ablation grid.
ABLATION_GRID = (
    {"name": "baseline", "stopwords": "default", "normalization": "none", "min_token_length": 1, "max_features": 5000},
    {"name": "custom_stopwords", "stopwords": "custom", "normalization": "none", "min_token_length": 1, "max_features": 5000},
    {"name": "porter_stemming", "stopwords": "custom", "normalization": "porter", "min_token_length": 1, "max_features": 5000},
    {"name": "wordnet_lemma", "stopwords": "custom", "normalization": "wordnet", "min_token_length": 1, "max_features": 5000},
    {"name": "min_len_3", "stopwords": "custom", "normalization": "wordnet", "min_token_length": 3, "max_features": 5000},
    {"name": "reduced_vocab", "stopwords": "custom", "normalization": "wordnet", "min_token_length": 3, "max_features": 2000},
)
NORMALIZATION_CODES = {"none": 0, "porter": 1, "snowball": 2, "wordnet": 3}

# Naive Bayes smoothing sweep.
NB_ALPHAS = (0.01, 0.1, 0.5, 1.0, 2.0, 5.0)

# Language-model constants.
KN_DISCOUNT = 0.75
LM_PROB_FLOOR = 1e-10
LM_START, LM_END = "<START>", "<END>"

# Request bounds.
TEXT_MIN_CHARS, TEXT_MAX_CHARS = 10, 10000
BATCH_MIN, BATCH_MAX = 1, 100
TOP_K_MIN, TOP_K_MAX, TOP_K_DEFAULT = 1, 20, 5

# --- Derived lists ------------------------------------------------------------

DOMAIN_STOPWORDS = tuple(sorted((set(ENGLISH_STOPWORDS) - set(KEEP_WORDS)) | set(DOMAIN_WORDS)))
DEFAULT_STOPWORDS = tuple(ENGLISH_STOPWORDS)

assert len(ENGLISH_STOPWORDS) == 179
