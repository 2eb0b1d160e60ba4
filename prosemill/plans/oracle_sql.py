"""SQL fragments shared by the oracles (DuckDB dialect)."""

from ..functions import patterns as P


def lit(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("'", "''") + "'"


def rx(text: str, pattern: str, replacement: str = "''") -> str:
    return f"regexp_replace({text}, {lit(pattern)}, {replacement}, 'g')"


def hits(text: str, pattern: str) -> str:
    return f"len(regexp_extract_all({text}, {lit(pattern)}))"


# --- cleaning ---------------------------------------------------------------------


def html_text(html: str) -> str:
    out = rx(html, r"(?is)<!--.*?-->")
    for tag in P.HIDDEN_ELEMENTS:
        out = rx(out, rf"(?is)<{tag}\b[^>]*>.*?</{tag}\s*>")
    return rx(out, "<[^>]+>")


def unescape(text: str, more: bool = False) -> str:
    """The basic entities; with ``more`` as HTML decodes them: further names, and the
    final semicolon may be missing (some page titles end inside an entity)."""
    pairs = [("&lt;", "'<'"), ("&gt;", "'>'"), ("&quot;", "'\"'"), ("&#39;", "chr(39)"),
             ("&apos;", "chr(39)"), ("&nbsp;", "chr(160)"), ("&amp;", "'&'")]
    if more:
        pairs[-1:-1] = [("&copy;", "chr(169)"), ("&middot;", "chr(183)")]
    for entity, char in pairs:
        if more and entity not in ("&#39;", "&apos;"):
            text = rx(text, f"{entity}?", char)
        else:
            text = f"replace({text}, '{entity}', {char})"
    return text


def strip_control(text: str) -> str:
    return rx(text, r"[^\P{C}\n\t]")


def spaces(text: str) -> str:
    return f"translate({text}, chr(160) || chr(9), '  ')"


def strip_lines(text: str) -> str:
    return rx(text, r"(?m)^[^\S\n]+|[^\S\n]+$")


def newlines(text: str) -> str:
    return rx(text, "\n{3,}", "chr(10) || chr(10)")


def collapse(text: str) -> str:
    return rx(text, "[ \t]+", "' '")


def trim(text: str) -> str:
    return rx(text, r"^\s+|\s+$")


def tidy(text: str) -> str:
    return trim(collapse(newlines(strip_lines(spaces(strip_control(text))))))


# --- measures -----------------------------------------------------------------------


def words(text: str) -> str:
    return hits(text, r"\S+")


def code_symbols(text: str) -> str:
    return f"(length({text}) - length({rx(text, P.CODE_SYMBOL)}))::double / length({text})"


def is_code(text: str) -> str:
    kw = hits(text, P.CODE_KEYWORD)
    return f"({kw} > 0 AND ({kw} > 5 OR {code_symbols(text)} > 0.05))"


def punc(text: str) -> str:
    odd = rf"length({rx(text, '[\\p{L}\\p{N}\\s]+')})"
    return f"CASE WHEN length({text}) = 0 THEN 1.0::double ELSE {odd}::double / length({text}) END"


def whole_words(text: str, words) -> str:
    """Hits of a word list, by splitting at everything that is not a word character."""
    names = ", ".join(lit(w) for w in words)
    return rf"len(list_filter(string_split_regex(lower({text}), '[^\p{{L}}\p{{N}}_]+'), lambda x: x IN ({names})))"


# --- language -----------------------------------------------------------------------


def quarter(text: str, n: int = 1000) -> str:
    return (f"CASE WHEN length({text}) > {n} THEN substring({text}, "
            f"least(length({text}) // 4, length({text}) - {n}) + 1, {n}) ELSE {text} END")


def head(text: str, n: int = 1000) -> str:
    return f"replace(substring({text}, 1, {n}), chr(10), ' ')"


def model_text(text: str) -> str:
    return f"trim({rx(text, '\\s+', repr(' '))})"


def whole(text: str) -> str:
    return text


def language(source: str, sample=whole) -> str:
    """A query adding ``label`` and ``score`` to the rows of ``source`` (needs ``text``)."""
    langs = list(P.STOPWORDS)
    counts = ", ".join(f"{whole_words('m', P.STOPWORDS[x])} AS {x}" for x in langs)
    best = f"greatest({', '.join(langs)})"
    label = " ".join(f"WHEN {x} = {best} THEN '__label__{x}'" for x in langs)
    total = " + ".join(langs)
    return (
        f"SELECT * EXCLUDE (m, {total.replace(' +', ',')}), "
        f"CASE WHEN {best} = 0 THEN '__label__unknown' {label} END AS label, "
        f"CASE WHEN {best} = 0 THEN 0.0::double ELSE {best}::double / ({total}) END AS score "
        f"FROM (SELECT *, {counts} FROM (SELECT *, {model_text(sample('text'))} AS m FROM {source}))")


# --- personal data --------------------------------------------------------------------


def redact(text: str) -> str:
    for pattern, tag in ((P.EMAIL, P.EMAIL_TAG), (P.IPV4, P.IP_TAG), (P.PHONE, P.PHONE_TAG)):
        text = rx(text, pattern, lit(tag))
    return text


# --- toxicity --------------------------------------------------------------------------

# words that occur almost only in documents labelled toxic
LEXICON = ("trash", "clown", "idiot", "scum", "worthless",
           "moron", "pathetic", "loser", "disgusting", "stupid")


def toxic(text: str, limit: float = 0.001) -> str:
    found = whole_words(text, LEXICON)
    return f"({found} > 0 AND {found}::double / {words(text)} > {limit})"


# --- near duplicates ---------------------------------------------------------------------


def shingles(source: str, size: int = 5) -> str:
    """doc_id, gram rows of a relation with doc_id and text."""
    return f"""
    SELECT doc_id, unnest(list_distinct(CASE
             WHEN norm = '' THEN []::varchar[] WHEN len(w) < {size} THEN [norm]
             ELSE list_transform(range(1, len(w) - {size} + 2), lambda i: array_to_string(w[i:i + {size - 1}], ' ')) END)) AS gram
    FROM (SELECT doc_id, norm, list_filter(string_split_regex(norm, '\\s+'), lambda x: x <> '') AS w
          FROM (SELECT doc_id, {rx('lower(text)', '[^\\p{L}\\p{N}_\\s]')} AS norm FROM {source}))"""


def md5_int(text: str) -> str:
    return f"('0x' || substr(md5({text}), 1, 7))::bigint"


def sha1_int(text: str) -> str:
    """The first four bytes of a SHA-1, little-endian."""
    pairs = " || ".join(f"substr(sha1({text}), {i}, 2)" for i in (7, 5, 3, 1))
    return f"('0x' || {pairs})::bigint"


def sha1_signatures(source: str, num_perm: int = 128, size: int = 5, seed: int = 42) -> str:
    """As ``signatures``, for the default hash family; products need 128 bits."""
    from ..functions.minhash import coefficients

    pairs = ", ".join(f"({i}, {a}::hugeint, {b}::hugeint)" for i, (a, b) in enumerate(zip(*coefficients("sha1", num_perm, seed))))
    return f"""
    SELECT doc_id, i, min(((a * h + b) % 18446744073709551616::hugeint % 2305843009213693951::hugeint) % 4294967296::hugeint)::bigint AS value
    FROM (SELECT doc_id, {sha1_int('gram')}::hugeint AS h FROM ({shingles(source, size)})), (VALUES {pairs}) c(i, a, b)
    GROUP BY doc_id, i"""


def signatures(source: str, num_perm: int = 128, size: int = 5, seed: int = 42, family: str = "md5") -> str:
    """doc_id, i, value rows: minimum of permutation i over the shingles."""
    if family == "sha1":
        return sha1_signatures(source, num_perm, size, seed)
    return f"""
    SELECT doc_id, i, min((a * h + b) % 2147483647) AS value
    FROM (SELECT doc_id, {md5_int('gram')} AS h FROM ({shingles(source, size)})),
         (SELECT i, 1 + {md5_int(f"'{seed}:a:' || i")} AS a, {md5_int(f"'{seed}:b:' || i")} AS b
          FROM (SELECT unnest(range({num_perm})) AS i))
    GROUP BY doc_id, i"""


def buckets(source: str, bands: int, rows: int, num_perm: int = 128, size: int = 5, family: str = "md5") -> str:
    """doc_id, band, bucket rows."""
    return f"""
    SELECT doc_id, i // {rows} AS band,
           md5((i // {rows}) || ':' || string_agg(value::varchar, ',' ORDER BY i)) AS bucket
    FROM ({signatures(source, num_perm, size, family=family)}) WHERE i < {bands * rows} GROUP BY doc_id, band"""


def walk(source: str, bands: int = 8, rows: int = 16, num_perm: int = 128, size: int = 5, family: str = "md5") -> str:
    """CTEs ending in ``seen(doc_id, is_kept)``: documents with shingles one by one, in
    the order of doc_id, against the buckets of those kept before. Needs WITH RECURSIVE.
    """
    free = "NOT list_has_any(w.held, p.bs)"
    return f"""
    bucketed AS MATERIALIZED ({buckets(source, bands, rows, num_perm, size, family)}),
    perdoc AS MATERIALIZED (
      SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS rn, bs
      FROM (SELECT doc_id, list(hash(bucket)) AS bs FROM bucketed GROUP BY doc_id)),
    walked AS (
      SELECT 0::bigint AS rn, []::ubigint[] AS held, false AS is_kept
      UNION ALL
      SELECT p.rn, CASE WHEN {free} THEN list_concat(w.held, p.bs) ELSE w.held END, {free}
      FROM walked w JOIN perdoc p ON p.rn = w.rn + 1),
    seen AS MATERIALIZED (SELECT doc_id, is_kept FROM walked JOIN perdoc USING (rn))"""


def shingle_lists(source: str, size: int = 5) -> str:
    """doc_id, grams rows: the shingle set of each document that has any."""
    return f"SELECT doc_id, list(gram) AS grams FROM ({shingles(source, size)}) GROUP BY doc_id"


def jaccard(a: str, b: str) -> str:
    """Of two lists without repeats."""
    both = f"len(list_intersect({a}, {b}))"
    return f"{both}::double / (len({a}) + len({b}) - {both})"


def verified_walk(source: str, threshold: float, bands: int = 8, rows: int = 16, num_perm: int = 128, size: int = 5, family: str = "md5") -> str:
    """As ``walk``, but a kept document hides a later one only if their shingle sets are as
    similar as the threshold. Ends in ``seen(doc_id, is_kept)`` of documents with such a pair."""
    return f"""
    bucketed AS MATERIALIZED ({buckets(source, bands, rows, num_perm, size, family)}),
    lists AS MATERIALIZED ({shingle_lists(source, size)}),
    hits AS MATERIALIZED (SELECT DISTINCT a.doc_id AS a, b.doc_id AS b FROM bucketed a JOIN bucketed b USING (bucket) WHERE a.doc_id < b.doc_id),
    edges AS MATERIALIZED (SELECT a, b FROM hits JOIN lists x ON x.doc_id = a JOIN lists y ON y.doc_id = b
        WHERE {jaccard('x.grams', 'y.grams')} >= {threshold}),
    perdoc AS MATERIALIZED (
      SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS rn, coalesce(before, []::bigint[]) AS before
      FROM (SELECT DISTINCT unnest([a, b]) AS doc_id FROM edges) LEFT JOIN (SELECT b AS doc_id, list(a) AS before FROM edges GROUP BY b) USING (doc_id)),
    walked AS (
      SELECT 0::bigint AS rn, []::bigint[] AS held, false AS is_kept
      UNION ALL
      SELECT p.rn, CASE WHEN NOT list_has_any(w.held, p.before) THEN list_append(w.held, p.doc_id) ELSE w.held END,
        NOT list_has_any(w.held, p.before)
      FROM walked w JOIN perdoc p ON p.rn = w.rn + 1),
    seen AS MATERIALIZED (SELECT doc_id, is_kept FROM walked JOIN perdoc USING (rn))"""
