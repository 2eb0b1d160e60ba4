"""Patterns, word lists and thresholds that results depend on.

They are stated once, as plain text, and must not be changed to other spellings:
every rate, redaction and filter decision follows from them. Patterns are written
without flags; ``java()`` adds the flags that make Java agree with the Unicode
meaning of ``\\b \\w \\d \\s``.
"""

import re

# --- fixed values: code detection ---------------------------------------------
CODE_KEYWORD = (
    r"\b(function|var|const|let|=>|console\.log|document\.getElementById|"
    r"window\.|return|import|export|class|def|printf|iostream)\b"
)
CODE_SYMBOL = r"[\{\}\(\);=<>]"
MAX_CODE_KEYWORDS = 5
MAX_CODE_SYMBOL_SHARE = 0.05

# --- fixed values: personal data ----------------------------------------------
EMAIL = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b"
IPV4 = r"\b\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}\b"
PHONE = r"\b(?:\+\d{1,2}\s)?\(?\d{3}\)?[\s.-]?\d{3}[\s.-]?\d{4}\b"
EMAIL_TAG, IP_TAG, PHONE_TAG = "<EMAIL>", "<IP>", "<PHONE>"
REDACTION_TAG = r"<EMAIL>|<IP>|<PHONE>"

# --- fixed values: markup ------------------------------------------------------
HTML_TAG = r"<[^>]+>"
HIDDEN_ELEMENTS = ("script", "style", "header", "footer", "nav", "noscript")

# --- fixed values: artifact scan ------------------------------------------------
WIDE_SPACE = r"\s{4,}"

# --- fixed values: default lexicon of the toxicity filter (slurs it must catch) --
TOXIC_WORDS = (
    "nigger", "nigga", "chink", "kike", "fag", "faggot", "tranny",
    "retard", "spic", "wetback", "gook", "cunt", "whore", "slut",
)

# --- fixed values: names of the classifier categories ---------------------------
TOXICITY_CATEGORIES = (
    "toxicity", "severe_toxicity", "obscene", "identity_attack", "insult", "threat",
)

# --- fixed values: well-known metadata keys of a raw corpus ----------------------
METADATA_KEYS = (
    "source", "url", "domain", "timestamp", "date",
    "id", "author", "title", "lang", "language",
)

# --- word lists of the built-in language scorer (our own, not a model) -----------
STOPWORDS = {
    "en": ("the", "of", "and", "to", "in", "is", "that"),
    "fr": ("le", "la", "les", "des", "et", "que", "qui", "un"),
    "de": ("der", "die", "und", "nicht", "ein", "das"),
    "es": ("el", "los", "de", "que", "y", "en", "por", "la"),
}


def java(pattern: str, flags: str = "U") -> str:
    """The pattern with inline Java flags (``U``: Unicode classes and boundaries)."""
    return f"(?{flags}){pattern}"


def whole_words(words) -> str:
    """Alternation of escaped words between word boundaries. A look at the first character
    leaves most words of a text without a try of each alternative."""
    ahead = "(?=[" + "".join(sorted({re.escape(w[0]) for w in words})) + "])" if words and all(words) else ""
    return rf"\b{ahead}(" + "|".join(re.escape(w) for w in words) + r")\b"
