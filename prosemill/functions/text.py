"""Column functions for cleaning and measuring text; all run inside the JVM."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P

# ---------------------------------------------------------------- cleaning steps


def strip_tags(text: Column) -> Column:
    """Delete everything that looks like a tag."""
    return F.regexp_replace(text, P.HTML_TAG, "")


def html_to_text_native(html: Column) -> Column:
    """Visible text by regular expressions, for well-formed pages.

    Comments, then hidden elements with their content, then the remaining tags.
    Broken markup needs :func:`prosemill.functions.markup.decode_markup`.
    """
    out = F.regexp_replace(html, r"(?is)<!--.*?-->", "")
    for tag in P.HIDDEN_ELEMENTS:
        out = F.regexp_replace(out, rf"(?is)<{tag}\b[^>]*>.*?</{tag}\s*>", "")
    return strip_tags(out)


# replaced in this order: the ampersand comes last, so nothing is decoded twice
_BASIC_ENTITIES = (
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"),
    ("&nbsp;", "\u00a0"), ("&amp;", "&"),
)


def unescape_basic(text: Column) -> Column:
    """Decode the XML entities and the no-break space once."""
    for entity, char in _BASIC_ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def strip_control(text: Column, keep_new: bool = False) -> Column:
    """Delete characters of the general categories C*, except newline and tab.

    ``keep_new`` keeps code points that this Java version does not know yet.
    """
    cls = r"\p{Cc}\p{Cf}\p{Co}\p{Cs}" if keep_new else r"\p{C}"
    return F.regexp_replace(text, rf"[{cls}&&[^\n\t]]", "")


def standardize_spaces(text: Column) -> Column:
    """No-break spaces and tabs become plain spaces."""
    for blank in ("\u00a0", "\t"):
        text = F.replace(text, F.lit(blank), F.lit(" "))
    return text


def collapse_spaces(text: Column) -> Column:
    """Runs of spaces and tabs become one space."""
    return F.regexp_replace(text, "[ \t]{2,}|\t", " ")


def strip_lines(text: Column) -> Column:
    """Strip Unicode whitespace at both ends of each line.

    The flag ``d`` makes ``\\n`` the only line end; the look-behind keeps long
    runs of blanks linear.
    """
    return F.regexp_replace(text, r"(?Umd)^[^\S\n]+|(?<![^\S\n])[^\S\n]+$", "")


def collapse_newlines(text: Column) -> Column:
    return F.regexp_replace(text, "\n{3,}", "\n\n")


def trim_unicode(text: Column) -> Column:
    return F.regexp_replace(text, r"(?Ud)^\s+|(?<!\s)\s+\z", "")


def tidy(text: Column, keep_new: bool = False) -> Column:
    """Every cleaning step after markup and Unicode normalisation.

    Spaces collapse before lines are stripped: same result, no quadratic runs. Plain
    substring searches spare most texts the costly pattern of the line step; once
    lines are stripped, only newlines are left to trim.
    """
    def lines(spaced):
        blank_at_end = (
            F.startswith(spaced, F.lit(" ")) | F.endswith(spaced, F.lit(" "))
            | F.contains(spaced, F.lit(" \n")) | F.contains(spaced, F.lit("\n ")))
        # after the steps before, only non-ASCII text has other whitespace in a line
        other_blanks = (F.octet_length(spaced) != F.length(spaced)) & spaced.rlike(r"(?U)[\s&&[^ \n]]")
        return F.when(blank_at_end | other_blanks, strip_lines(spaced)).otherwise(spaced)

    spaced = collapse_spaces(standardize_spaces(strip_control(text, keep_new)))
    return F.btrim(collapse_newlines(bound(spaced, lines)), F.lit("\n"))


# ---------------------------------------------------------------------- measures


def char_count(text: Column) -> Column:
    return F.length(text).cast("bigint")


def word_count(text: Column) -> Column:
    """Runs of non-whitespace characters; 0 for an empty text."""
    return F.regexp_count(text, F.lit(r"(?U)\S+")).cast("bigint")


def matches(text: Column, pattern: str, flags: str = "U") -> Column:
    """Number of matches of a pattern from :mod:`patterns`."""
    return F.regexp_count(text, F.lit(P.java(pattern, flags))).cast("bigint")


def contains(text: Column, pattern: str, flags: str = "U") -> Column:
    return text.rlike(P.java(pattern, flags))


def share(part: Column, whole: Column) -> Column:
    """part / whole as a double, null when the whole is 0."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


# ----------------------------------------------------------------- code detection


def code_keyword_count(text: Column) -> Column:
    return matches(text, P.CODE_KEYWORD)


def code_symbol_density(text: Column) -> Column:
    symbols = F.length(text) - F.length(F.regexp_replace(text, P.CODE_SYMBOL, ""))
    return F.coalesce(share(symbols, F.length(text)), F.lit(0.0))


def is_code(text: Column) -> Column:
    """More than 5 keywords, or at least one and a symbol share above 5 %.

    The cheap search for one keyword guards both counts.
    """
    return contains(text, P.CODE_KEYWORD) & (
        (code_symbol_density(text) > P.MAX_CODE_SYMBOL_SHARE)
        | (code_keyword_count(text) > P.MAX_CODE_KEYWORDS)
    )


# ------------------------------------------------------------------------ quality


def punc_ratio(text: Column) -> Column:
    """Share of characters that are neither letters, digits nor whitespace; 1 if empty."""
    odd = F.length(F.regexp_replace(text, r"(?U)[\p{L}\p{N}\s]+", ""))
    return F.when(F.length(text) == 0, F.lit(1.0)).otherwise(share(odd, F.length(text)))


# ----------------------------------------------------------------------------- ids


def doc_id(text: Column, method: str = "xxhash64") -> Column:
    """Content id. ``xxhash64``: XXH64 with Spark's seed 42, 16 hex digits, native.
    ``xxh64``: XXH64 with seed 0 through an Arrow UDF. ``md5``: 128 bits, native;
    choose it for more than about a billion documents, where 64 bits start to collide.
    """
    if method == "xxhash64":
        return F.lower(F.lpad(F.hex(F.xxhash64(text)), 16, "0"))
    if method == "md5":
        return F.md5(text)
    if method == "xxh64":
        from .markup import xxh64_seed0

        return xxh64_seed0(text)
    raise ValueError(f"unknown id method {method!r}; use xxhash64, xxh64 or md5")


# -------------------------------------------------------------------------- tokens


def normalized(text: Column) -> Column:
    """Lower case without punctuation; whitespace stays."""
    return F.regexp_replace(F.lower(text), r"(?U)[^\p{L}\p{N}_\s]", "")


def shingles(text: Column, size: int = 5) -> Column:
    """Distinct word n-grams. Fewer words than ``size``: the whole normalised text,
    whitespace untouched; nothing left after normalising: no shingle.
    """
    def from_norm(norm):
        trimmed = F.regexp_replace(norm, r"(?U)^\s+|\s+\z", "")
        return bound(F.split(trimmed, r"(?U)\s+"), lambda words: from_words(norm, words))

    def from_words(norm, words):
        grams = F.transform(
            F.sequence(F.lit(1), F.size(words) - F.lit(size - 1)),
            lambda i: F.array_join(F.slice(words, i, size), " "))
        return (
            F.when(F.length(norm) == 0, F.array().cast("array<string>"))
            .when(F.size(words) < size, F.array(norm))
            .otherwise(F.array_distinct(grams)))

    return bound(normalized(text), from_norm)


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.transform(F.array(value), use).getItem(0)
