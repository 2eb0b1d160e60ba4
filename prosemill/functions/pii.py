"""Personal data: e-mail, IPv4, phone."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P
from .text import contains, matches

# kind -> (pattern, tag), in the order in which they are redacted
KINDS = {
    "email": (P.EMAIL, P.EMAIL_TAG),
    "ip": (P.IPV4, P.IP_TAG),
    "phone": (P.PHONE, P.PHONE_TAG),
}


def redact(text: Column, *kinds: str) -> Column:
    """Replace matches by their tag; all kinds unless some are named. Texts without an
    @ sign skip the e-mail pattern."""
    for kind in kinds or KINDS:
        pattern, tag = KINDS[kind]
        redacted = F.regexp_replace(text, P.java(pattern), tag)
        text = F.when(F.contains(text, F.lit("@")), redacted).otherwise(text) if kind == "email" else redacted
    return text


def has_pii(text: Column) -> Column:
    found = [contains(text, pattern) for pattern, _ in KINDS.values()]
    return found[0] | found[1] | found[2]


def leaks(text: Column, kind: str) -> Column:
    return matches(text, KINDS[kind][0])


def tag_count(text: Column) -> Column:
    return matches(text, P.REDACTION_TAG)
