"""Porter (1980) and Snowball English (Porter2) stemmers, and suffix lemma rules.

Written from the published algorithm descriptions.  They are plain Python
functions on one word; the Spark operators apply them to the *distinct*
vocabulary (a pandas UDF over Arrow batches) and join the result back, so the
per-word Python cost is paid once per distinct term, not per token.
"""

from __future__ import annotations

# --- Porter (1980) ---------------------------------------------------------------

_VOWELS = set("aeiou")


def _is_cons(w: str, i: int) -> bool:
    c = w[i]
    if c in _VOWELS:
        return False
    if c == "y":
        return i == 0 or not _is_cons(w, i - 1)
    return True


def _measure(stem: str) -> int:
    m, prev_v = 0, False
    for i in range(len(stem)):
        v = not _is_cons(stem, i)
        if prev_v and not v:
            m += 1
        prev_v = v
    return m


def _has_vowel(stem: str) -> bool:
    return any(not _is_cons(stem, i) for i in range(len(stem)))


def _double_cons(w: str) -> bool:
    return len(w) >= 2 and w[-1] == w[-2] and _is_cons(w, len(w) - 1)


def _cvc(w: str) -> bool:
    if len(w) < 3:
        return False
    return (_is_cons(w, len(w) - 3) and not _is_cons(w, len(w) - 2) and _is_cons(w, len(w) - 1)
            and w[-1] not in "wxy")


# Porter's suffix rules (steps 2, 3, 4).
_P_STEP2 = (("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
            ("abli", "able"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
            ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
            ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"))
_P_STEP3 = (("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""),
            ("ness", ""))
_P_STEP4 = ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou",
            "ism", "ate", "iti", "ous", "ive", "ize")


def _longest(w: str, rules):
    best = None
    for suf, rep in rules:
        if w.endswith(suf) and (best is None or len(suf) > len(best[0])):
            best = (suf, rep)
    return best


def porter(word: str) -> str:
    w = word.lower()
    if len(w) <= 2:
        return w
    # 1a
    if w.endswith("sses"):
        w = w[:-2]
    elif w.endswith("ies"):
        w = w[:-2]
    elif w.endswith("ss"):
        pass
    elif w.endswith("s"):
        w = w[:-1]
    # 1b
    extra = False
    if w.endswith("eed"):
        if _measure(w[:-3]) > 0:
            w = w[:-1]
    elif w.endswith("ed") and _has_vowel(w[:-2]):
        w, extra = w[:-2], True
    elif w.endswith("ing") and _has_vowel(w[:-3]):
        w, extra = w[:-3], True
    if extra:
        if w.endswith(("at", "bl", "iz")):
            w += "e"
        elif _double_cons(w) and w[-1] not in "lsz":
            w = w[:-1]
        elif _measure(w) == 1 and _cvc(w):
            w += "e"
    # 1c
    if w.endswith("y") and _has_vowel(w[:-1]):
        w = w[:-1] + "i"
    # 2, 3
    for rules in (_P_STEP2, _P_STEP3):
        hit = _longest(w, rules)
        if hit and _measure(w[:-len(hit[0])]) > 0:
            w = w[:-len(hit[0])] + hit[1]
    # 4
    hit = _longest(w, [(s, "") for s in _P_STEP4])
    if hit:
        stem = w[:-len(hit[0])]
        if _measure(stem) > 1 and (hit[0] != "ion" or stem.endswith(("s", "t"))):
            w = stem
    # 5a
    if w.endswith("e"):
        stem = w[:-1]
        m = _measure(stem)
        if m > 1 or (m == 1 and not _cvc(stem)):
            w = stem
    # 5b
    if _measure(w) > 1 and _double_cons(w) and w.endswith("l"):
        w = w[:-1]
    return w


# --- Snowball English (Porter2) -----------------------------------------------------

_V2 = set("aeiouy")
_DOUBLES = ("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt")
_LI_ENDING = set("cdeghkmnrt")
# Porter2 exceptional forms and suffix rules.
_EXCEPTIONS = {"skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl",
               "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl",
               "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas", "cosmos": "cosmos",
               "bias": "bias", "andes": "andes"}
_POST_1A = {"inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed"}
_S2_STEP2 = (("ization", "ize"), ("ational", "ate"), ("fulness", "ful"), ("ousness", "ous"), ("iveness", "ive"),
             ("tional", "tion"), ("biliti", "ble"), ("lessli", "less"), ("entli", "ent"), ("ation", "ate"),
             ("alism", "al"), ("aliti", "al"), ("ousli", "ous"), ("iviti", "ive"), ("fulli", "ful"),
             ("enci", "ence"), ("anci", "ance"), ("abli", "able"), ("izer", "ize"), ("ator", "ate"),
             ("alli", "al"), ("bli", "ble"), ("ogi", "og"), ("li", ""))
_S2_STEP3 = (("ational", "ate"), ("tional", "tion"), ("alize", "al"), ("icate", "ic"), ("iciti", "ic"),
             ("ative", ""), ("ical", "ic"), ("ness", ""), ("ful", ""))
_S2_STEP4 = ("ement", "ance", "ence", "able", "ible", "ment", "ant", "ent", "ism", "ate", "iti", "ous", "ive",
             "ize", "ion", "al", "er", "ic")


def _regions(w: str) -> tuple[int, int]:
    def after(start):
        for i in range(start + 1, len(w)):
            if w[i] not in _V2 and w[i - 1] in _V2:
                return i + 1
        return len(w)
    r1 = None
    for pre in ("gener", "commun", "arsen"):
        if w.startswith(pre):
            r1 = len(pre)
    if r1 is None:
        r1 = after(0)
    r2 = after(r1) if r1 < len(w) else len(w)
    return r1, r2


def _short_syllable_end(w: str) -> bool:
    if len(w) == 2:
        return w[0] in _V2 and w[1] not in _V2
    return (len(w) >= 3 and w[-3] not in _V2 and w[-2] in _V2 and w[-1] not in _V2 and w[-1] not in "wxY")


def snowball(word: str) -> str:
    w = word.lower()
    if len(w) <= 2:
        return w
    if w in _EXCEPTIONS:
        return _EXCEPTIONS[w]
    if w.startswith("'"):
        w = w[1:]
    if w.startswith("y"):
        w = "Y" + w[1:]
    w = "".join("Y" if c == "y" and i > 0 and w[i - 1] in _V2 else c for i, c in enumerate(w))
    r1, r2 = _regions(w)
    # 0
    for suf in ("'s'", "'s", "'"):
        if w.endswith(suf):
            w = w[:-len(suf)]
            break
    # 1a
    if w.endswith("sses"):
        w = w[:-2]
    elif w.endswith(("ied", "ies")):
        w = w[:-2] if len(w) > 4 else w[:-1]
    elif w.endswith(("us", "ss")):
        pass
    elif w.endswith("s") and any(c in _V2 for c in w[:-2]):
        w = w[:-1]
    if w in _POST_1A:
        return w
    # 1b
    for suf in ("eedly", "eed"):
        if w.endswith(suf):
            if len(w) - len(suf) >= r1:
                w = w[:-len(suf)] + "ee"
            break
    else:
        for suf in ("ingly", "edly", "ing", "ed"):
            if w.endswith(suf):
                stem = w[:-len(suf)]
                if any(c in _V2 for c in stem):
                    w = stem
                    if w.endswith(("at", "bl", "iz")):
                        w += "e"
                    elif w.endswith(_DOUBLES):
                        w = w[:-1]
                    elif _short_syllable_end(w) and r1 >= len(w):
                        w += "e"
                break
    # 1c
    if len(w) > 2 and w[-1] in "yY" and w[-2] not in _V2:
        w = w[:-1] + "i"
    # 2
    for suf, rep in _S2_STEP2:
        if w.endswith(suf):
            if len(w) - len(suf) >= r1:
                if suf == "ogi":
                    if w[:-3].endswith("l"):
                        w = w[:-3] + "og"
                elif suf == "li":
                    if len(w) >= 3 and w[-3] in _LI_ENDING:
                        w = w[:-2]
                else:
                    w = w[:-len(suf)] + rep
            break
    # 3
    for suf, rep in _S2_STEP3:
        if w.endswith(suf):
            if len(w) - len(suf) >= r1:
                if suf == "ative":
                    if len(w) - len(suf) >= r2:
                        w = w[:-5]
                else:
                    w = w[:-len(suf)] + rep
            break
    # 4
    for suf in _S2_STEP4:
        if w.endswith(suf):
            if len(w) - len(suf) >= r2:
                if suf == "ion":
                    if w[:-3].endswith(("s", "t")):
                        w = w[:-3]
                else:
                    w = w[:-len(suf)]
            break
    # 5
    if w.endswith("e"):
        if len(w) - 1 >= r2 or (len(w) - 1 >= r1 and not _short_syllable_end(w[:-1])):
            w = w[:-1]
    elif w.endswith("l") and len(w) - 1 >= r2 and w[:-1].endswith("l"):
        w = w[:-1]
    return w.replace("Y", "y")


# --- suffix lemma rules (noun inflections) ---------------------------------------------

# Regular English noun inflection rules (suffix, replacement).
NOUN_RULES = (("ses", "s"), ("xes", "x"), ("zes", "z"), ("ches", "ch"), ("shes", "sh"), ("men", "man"),
              ("ies", "y"), ("s", ""))


def lemma_rules(word: str, lexicon: dict | None = None) -> str:
    """Lemma from a user (token, lemma) table when given, else the first matching noun rule.

    Words ending in 'ss' and words of three letters or fewer are left unchanged.
    """
    w = word.lower()
    if lexicon is not None and w in lexicon:
        return lexicon[w]
    if len(w) <= 3 or w.endswith("ss"):
        return w
    for suf, rep in NOUN_RULES:
        if w.endswith(suf):
            return w[:-len(suf)] + rep
    return w
