"""Arrow UDFs for what has no Spark expression: HTML parsing, entities, NFC, XXH64."""

import html
import re
import unicodedata
from collections import Counter
from html.entities import html5
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .patterns import HIDDEN_ELEMENTS, HTML_TAG

# elements without content, and elements whose text is not body text
_VOID = frozenset(
    "area base br col embed hr img input keygen link menuitem meta param source track wbr "
    "basefont bgsound command frame image isindex nextid spacer".split()
)
# the parser loses an ampersand in the last word of its input unless something follows
_END = "\0"
_SKIPPED = frozenset(HIDDEN_ELEMENTS) | {"template", "rt", "rp"}


class _BodyText(HTMLParser):
    """Collects text outside skipped elements; an end tag closes all it contains."""

    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.out, self.path, self.open = [], [], Counter()

    def handle_starttag(self, tag, attrs):
        if tag not in _VOID:
            self.path.append(tag)
            self.open[tag] += 1
            self.open[None] += tag in _SKIPPED

    def handle_startendtag(self, tag, attrs):
        pass

    def handle_endtag(self, tag):
        closed = None
        while self.open[tag] and closed != tag:
            closed = self.path.pop()
            self.open[closed] -= 1
            self.open[None] -= closed in _SKIPPED

    def handle_data(self, data):
        if not self.open[None]:
            self.out.append(data)

    def handle_charref(self, name):
        self.handle_data(html.unescape(f"&#{name};"))

    def handle_entityref(self, name):
        self.handle_data(html5.get(f"{name};", f"&{name}"))

    def unknown_decl(self, data):
        if data.upper().startswith("CDATA["):
            self.handle_data(data[6:])


def visible_text(text: str) -> str:
    """Text of an HTML fragment, no separator between elements; tags cut by pattern
    if the parser fails."""
    if "<" not in text and "&" not in text:
        return text
    try:
        parser = _BodyText()
        parser.feed(text + _END)
        parser.close()
        return "".join(parser.out).removesuffix(_END)
    except Exception:
        return re.sub(HTML_TAG, "", text)


def _per_text(fn):
    """Arrow UDF applying a str -> str function; null stays null. Declared
    non-deterministic so that the optimizer never evaluates it twice."""

    @F.arrow_udf(T.StringType())
    def udf(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else fn(t) for t in texts.to_pylist()], pa.string())

    return udf.asNondeterministic()


def nfc(text: str) -> str:
    return text if text.isascii() else unicodedata.normalize("NFC", text)


def _xxh64(text: str) -> str:
    import xxhash

    return xxhash.xxh64_hexdigest(text.encode("utf-8"))


html_to_text = _per_text(visible_text)
html_unescape = _per_text(html.unescape)
normalize_nfc = _per_text(nfc)
xxh64_seed0 = _per_text(_xxh64)
# the three cleaning steps fused: one trip to Python per batch
decode_markup = _per_text(lambda t: nfc(html.unescape(visible_text(t))))
