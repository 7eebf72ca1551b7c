"""Identifiers normalised and deterministic ids minted, as column expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioflow.functions.text import none_if_empty, slug, strip

#: The namespaces of the deterministic ids.
NAMESPACES = {
    "work": "bbe57bbd-5083-583f-80f9-62d3991b0434",
    "author": "b0ec7744-d353-590f-b2b6-a455dcebe2b8",
    "institution": "112a35ab-d01a-5bdf-a676-8b32468eeb77",
    "venue": "83e33036-b483-5724-8e0e-5194f6e1380c",
}


#: The forms of the identifiers and what may stand before them.
DOI, DOI_PREFIXES = r"^10\.[0-9]{4,9}/\S+$", (r"^https?://(dx\.)?doi\.org/", r"^doi:\s*")
ARXIV_NEW, ARXIV_OLD, ARXIV_PREFIXES = r"^[0-9]{4}\.[0-9]{4,5}(v[0-9]+)?$", r"^[a-z\-]+(\.[a-z]{2})?/[0-9]{7}(v[0-9]+)?$", (r"^https?://arxiv\.org/(abs|pdf)/", r"^arxiv:\s*")
ORCID, ORCID_PREFIX = r"^(?i)[0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{3}[0-9X]$", r"^https?://orcid\.org/"
ROR, ROR_PREFIX = r"^0[a-hj-km-np-tv-z0-9]{6}[0-9]{2}$", r"^https?://ror\.org/"


def payload_hash(c: Column) -> Column:
    """SHA-256 in hex."""
    return F.sha2(c, 256)


def _bare(c: Column, *prefixes: str) -> Column:
    c = F.lower(strip(c))
    for p in prefixes:
        c = F.regexp_replace(c, p, "")
    return strip(c)


def doi(c: Column) -> Column:
    """A DOI in lower case without resolver and prefix; null if it isn't one."""
    bare = _bare(c, *DOI_PREFIXES)
    return F.when(bare.rlike(DOI), bare)


def arxiv_id(c: Column, strip_version: bool = True) -> Column:
    """A modern or legacy arXiv id in lower case, by default without its version; null if it isn't one."""
    bare = _bare(c, *ARXIV_PREFIXES)
    if strip_version:
        bare = F.regexp_replace(bare, r"v[0-9]+$", "")
    return F.when(bare.rlike(ARXIV_NEW) | bare.rlike(ARXIV_OLD), bare)


def orcid_check(digits: Column) -> Column:
    """Whether 16 signs carry the right ISO 7064 MOD 11-2 check sign."""
    total = F.aggregate(F.sequence(F.lit(1), F.lit(15)), F.lit(0), lambda acc, i: (acc + F.coalesce(F.try_to_number(F.substring(digits, i, F.lit(1)), F.lit("9")).cast("int"), F.lit(0))) * 2)
    due = (12 - total % 11) % 11
    return digits.rlike("^[0-9]{15}[0-9X]$") & (F.substring(digits, 16, 1) == F.when(due == 10, F.lit("X")).otherwise(due.cast("string")))


def orcid(c: Column) -> Column:
    """An ORCID as dddd-dddd-dddd-dddX with a right check sign; null otherwise."""
    bare = strip(F.regexp_replace(strip(c), ORCID_PREFIX, ""))
    digits = F.when(bare.rlike(ORCID), F.upper(F.replace(bare, F.lit("-"), F.lit("")))).otherwise(F.regexp_replace(F.upper(bare), "[^0-9X]", ""))
    dashed = F.concat_ws("-", *[F.substring(digits, 4 * k + 1, 4) for k in range(4)])
    return F.when((F.length(digits) == 16) & orcid_check(digits), dashed)


def ror(c: Column) -> Column:
    """A ROR id as its URL; null if it isn't one."""
    bare = F.regexp_replace(F.lower(strip(c)), ROR_PREFIX, "")
    return F.when(bare.rlike(ROR), F.concat(F.lit("https://ror.org/"), bare))


def uuid5(namespace: str, name: Column) -> Column:
    """The version 5 UUID of name in a namespace of NAMESPACES, by SHA-1 and the fixed bits."""
    h = F.sha1(F.concat(F.unhex(F.lit(NAMESPACES[namespace].replace("-", ""))), F.encode(name, "UTF-8")))
    variant = F.substring(F.lit("89ab"), (F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4 + 1), F.lit(1))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12))


def work_id(anchor: Column) -> Column:
    return uuid5("work", anchor)


def author_id(orcid_: Column, source_author_id: Column, name: Column) -> Column:
    """By ORCID, else by the source's id, else by the name's slug."""
    return uuid5("author", F.coalesce(F.concat(F.lit("orcid:"), none_if_empty(orcid_)), F.concat(F.lit("source_id:"), none_if_empty(source_author_id)), F.concat(F.lit("name:"), slug(name))))


def institution_id(ror_: Column, name: Column) -> Column:
    """By ROR id, else by the name's slug."""
    return uuid5("institution", F.coalesce(F.concat(F.lit("ror:"), ror(ror_)), F.concat(F.lit("name:"), slug(name))))


def venue_id(name: Column, issn: Column) -> Column:
    """By ISSN, else by the name's slug."""
    return uuid5("venue", F.coalesce(F.concat(F.lit("issn:"), F.lower(strip(none_if_empty(issn)))), F.concat(F.lit("name:"), slug(name))))


def fingerprint(title: Column, year: Column, first_author: Column) -> Column:
    """MD5 of title slug, year (or unknown) and author slug: a candidate key, never a reason to merge."""
    known = F.when(year != 0, year.cast("string"))
    return F.md5(F.concat_ws("|", slug(title), F.coalesce(known, F.lit("unknown")), slug(first_author)))
