"""Entities matched across sources that share no key, each pair with a confidence: collective graph linkage.

Records that share rare attributes (title words, families of authors) become the
edges of a candidate graph, weighted by how rare these attributes are in the
corpus. Which attributes are rare is told by rank within a record, never by a
count: two titles that have enough words in common always meet over their rarest
ones (prefix filtering). Meta-blocking prunes edges that are light for both ends,
the others are scored by title, authors and date. Records of one identifier and
copies form a class beforehand, and similarity is then propagated between
neighbouring classes until no pair gains any more.
"""

from __future__ import annotations

import html
import json
import math
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.functions.text import id_key
from folioflow.llm.canonical import distance
from folioflow.llm.names import slipped, slipped_twice
from folioflow.operators.common import HOT_SHARE, hot_keys, removed, spread_join, table, written

#: Records of one key that a task compares pair by pair; those of larger keys are split first. It changes cost, not results.
BLOCK = 256
#: What two titles must have in common, as a share of the shorter one's words, to be compared; more without a common family, or without any common word in the names of their authors.
SHARE, SHARE_ALONE, SHARE_APART = 0.4, 0.6, 0.7
#: Small words of titles, and what stands for a missing title.
SMALL = frozenset("a an the of on in for from to and or with by at as is are how their its towards toward via using".split())
JUNK = frozenset(("", "na", "n a", "none", "null", "untitled", "unknown", "title", "no title", "tbd", "test"))
_TAG = re.compile(r"<[^<>]*>|\$[^$]{0,80}\$|\\[A-Za-z]+")
_WORD = re.compile(r"[^\W_]+")
#: Words before and behind a title that make a work of its own, and the kind they stand for.
MARKS_BEFORE = {"reply": "reply", "response": "reply", "rejoinder": "reply", "comment": "comment", "comments": "comment", "correction": "correction", "corrections": "correction", "corrigendum": "correction", "erratum": "correction", "errata": "correction", "addendum": "addendum", "retraction": "retraction", "withdrawal": "retraction"}
MARKS_BEHIND = {"revisited": "revisited", "supplement": "supplement", "supplementary": "supplement", "continued": "continued", "addendum": "addendum", "sequel": "sequel"}
EXTENDED = ("report", "version", "abstract")
ROMAN = ("ii", "iii", "iv", "vi", "vii", "viii", "ix")
LINKS = frozenset("to on of for the a comments comment note notice".split())
IDLE = ("preprint", "pre-print", "working", "draft", "manuscript", "arxiv", "submitted")
_IDLE_ANY = re.compile("|".join(IDLE))
_IDLE_BEFORE = re.compile(r"^\W*(?:preprint|working\s+paper|draft|manuscript|pre-print|arxiv)\s*[:.–—-]\s*", re.I)
_IDLE_BEHIND = re.compile(r"\W*(?:[\[(]\s*(?:working\s+paper|preprint|pre-print|draft|manuscript|accepted\s+manuscript|submitted)\s*[\])]|:\s*(?:a\s+)?(?:preprint|working\s+paper|draft))\W*$", re.I)


_COMBINING = re.compile(r"[\u0300-\u036f\u1ab0-\u1aff\u20d0-\u20ff]+")


def folded(text: str) -> str:
    """Lower case without accents."""
    return text.lower() if text.isascii() else _COMBINING.sub("", unicodedata.normalize("NFKD", text)).lower()


@lru_cache(maxsize=1 << 14)
def _letters(word: str) -> frozenset:
    return frozenset(word)


def _slip(typed: str, word: str) -> bool:
    """Whether typed is word, also with a slip or two in a long one."""
    most = 2 if len(word) >= 8 else 1 if len(word) >= 5 else 0
    return typed == word or most > 0 and abs(len(typed) - len(word)) <= most and len(_letters(typed) ^ _letters(word)) <= 2 * most and distance(typed, word, most) <= most


@lru_cache(maxsize=1 << 14)
def _before(word: str) -> str | None:
    return next((k for w, k in MARKS_BEFORE.items() if _slip(word, w)), None)


@lru_cache(maxsize=1 << 14)
def _behind(word: str) -> str | None:
    return next((k for w, k in MARKS_BEHIND.items() if _slip(word, w)), None)


@lru_cache(maxsize=1 << 14)
def _extended(word: str) -> bool:
    return _slip(word, "extended")


def title_parts(title: str | None) -> tuple[list[str], str]:
    """(words, mark): the telling words of a title in order, and what makes it a work of its own ("" for nothing)."""
    text = title or ""
    if "&" in text:
        text = html.unescape(text)
    if "<" in text or "$" in text or "\\" in text:
        text = _TAG.sub(lambda m: " " if m[0][0] != "<" else "", text)
    text = folded(" ".join(text.split()))
    for _ in range(2 if _IDLE_ANY.search(text) else 0):
        text = _IDLE_BEHIND.sub("", _IDLE_BEFORE.sub("", text))
    tokens = _WORD.findall(text)
    marks = []
    while len(tokens) > 3:
        kind = _before(tokens[0])
        if kind is None or len(tokens[1]) > 3 and not any(_slip(tokens[1], w) for w in LINKS if len(w) > 3):
            break
        marks.append(kind)
        tokens = tokens[2:]
        while len(tokens) > 2 and (tokens[0] in LINKS or _slip(tokens[0], "comments")):
            tokens = tokens[1:]
    while len(tokens) > 3:
        last = tokens[-1]
        kind = _behind(last)
        if kind:
            tokens = tokens[:-1]
        elif _extended(tokens[-2]) and any(_slip(last, w) for w in EXTENDED):
            kind, tokens = "extended", tokens[:-2]
        elif tokens[-2] in ("part", "pt", "vol", "volume", "no", "number") and (last.isdigit() or last in ROMAN or last in ("i", "v", "x")):
            kind, tokens = f"part {last}", tokens[:-2]
        elif last in ROMAN or len(last) == 1 and last in "23456789":
            kind, tokens = last, tokens[:-1]
        else:
            break
        marks.append(kind)
    mark = " ".join(marks)
    if " ".join(tokens) in JUNK:
        return [], mark
    return [t for t in tokens if t not in SMALL], mark


_ET_AL = re.compile(r"^\W*(?:et\.?\s*al|and\s+others|others|unknown|anonymous|n/?a|none|null)\W*$", re.I)


def author_names(raw: str | None) -> list[str]:
    """The names of a JSON list of authors by position, each as its words of three letters and more; [] for anything else."""
    try:
        rows = json.loads(raw or "[]")
    except (ValueError, RecursionError):
        return []
    out = []
    for r in rows if isinstance(rows, list) else []:
        name = r.get("raw_name") if isinstance(r, dict) else r if isinstance(r, str) else None
        if not isinstance(name, str):
            continue
        tokens = _name_words(name)
        if tokens:
            at = r.get("position") if isinstance(r, dict) else None
            out.append((at if isinstance(at, int) else len(out) + 1, len(out), tokens))
    return [t for _, _, t in sorted(out)]


@lru_cache(maxsize=1 << 14)
def _name_words(name: str) -> str:
    """The words of a name in order of the alphabet, "" for what stands for others or none."""
    if _ET_AL.match(name):
        return ""
    return " ".join(sorted({t for t in _WORD.findall(folded(name).replace("'", "").replace("’", "")) if len(t) >= 3 and t not in ("the", "van", "der", "von", "del", "ibn", "behalf", "for", "and")}))


def family(name: str) -> str:
    """The longest word of a name (words in order of the alphabet), which both orders of its parts have; of equal ones the last."""
    best = ""
    for w in name.split(" "):
        if len(w) >= len(best):
            best = w
    return best


@lru_cache(maxsize=1 << 15)
def _hash(tag: str, word: str) -> int:
    return xxhash.xxh3_64_intdigest(tag + word) - (1 << 63)


@lru_cache(maxsize=1 << 14)
def _prints(name: str) -> list[int]:
    return [1 + xxhash.xxh3_64_intdigest(w) % 4095 for w in name.split(" ")]


@lru_cache(maxsize=1 << 14)
def _family_hash(name: str) -> int:
    return _hash("f", family(name))


_NODES = pa.schema([("id", pa.string()), ("source", pa.string()), ("doi", pa.string()), ("arxiv", pa.string()), ("year", pa.int32()), ("day", pa.int32()), ("t", pa.string()), ("mark", pa.string()), ("names", pa.string()), ("words", pa.list_(pa.int64())), ("families", pa.list_(pa.int64())), ("people", pa.list_(pa.int16()))])
_NODES_DDL = "id string, source string, doi string, arxiv string, year int, day int, t string, mark string, names string, words array<bigint>, families array<bigint>, people array<smallint>"


def _prepared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        titles = [title_parts(t) for t in batch.column(6).to_pylist()]
        names = [author_names(a) for a in batch.column(7).to_pylist()]
        words = [list(dict.fromkeys([_hash("w", w) for w in t])) for t, _ in titles]
        families = [list(dict.fromkeys([_family_hash(x) for x in each])) for each in names]
        people = [list(set().union(*[_prints(x) for x in each])) for each in names]
        yield pa.RecordBatch.from_arrays([*batch.columns[:6], pa.array([" ".join(t) for t, _ in titles], pa.string()), pa.array([m for _, m in titles], pa.string()), pa.array(["|".join(x) for x in names], pa.string()), pa.array(words, pa.list_(pa.int64())), pa.array(families, pa.list_(pa.int64())), pa.array(people, pa.list_(pa.int16()))], schema=_NODES)


def records(observations: DataFrame) -> DataFrame:
    """The nodes of the graph, one for each observation row: identifiers as compared, title words, mark, author names.

    words and families are the hashes of the distinct title words and families of authors,
    in order, and people the fingerprints of all words of authors' names.
    """
    o = observations.where("observation_id is not null").select(F.col("observation_id").alias("id"), F.col("source_name").alias("source"), id_key(F.col("normalized_doi")).alias("doi"), id_key(F.col("normalized_arxiv_id")).alias("arxiv"), F.col("publication_year").cast("int").alias("year"), F.datediff("publication_date", F.lit("1970-01-01").cast("date")).alias("day"), "title", "raw_authors")
    return o.mapInArrow(_prepared, _NODES_DDL)


# --- candidates -------------------------------------------------------------------------

#: How many counters tell how frequent words are: those of one counter count together, which keeps the order of words the same for all nodes.
COUNTERS = 1 << 19
#: What a key is made of: a title word and a family, two title words, a whole title, the first family and the day, or a word of a long title.
WORD_FAMILY, WORDS, TITLE, FAMILY_DAY, WORD = range(5)
#: Titles of more words meet over single ones; those from LONG on do so too.
LONG, LONGEST = 14, 26
#: Words of a title, and words of authors' names, whose fingerprints (of 16 and 12 bits) a row of a key bears.
PRINTS, NAME_PRINTS = 12, 16
#: side packs what is compared, as one column is cheaper to move than nine: bytes of the title's fingerprints, the low and high bits of the names', the families' bits, the number of words and that of words without a fingerprint.
_SIDE = {"prints": slice(0, 24), "low": slice(24, 40), "high": slice(40, 48), "own": slice(48, 56), "size": slice(56, 58), "more": slice(58, 60)}
_WIDTH = 60
_ROW = pa.schema([("key", pa.int64()), ("n", pa.int64()), ("side", pa.binary()), ("rule", pa.int8())])
_ROW_DDL = "key bigint, n bigint, side binary, rule byte"
_MET = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("key", pa.int64()), ("side", pa.binary()), ("rule", pa.int8())])
_MET_DDL = "a bigint, b bigint, key bigint, side binary, rule byte"


def _packed(rows: np.ndarray) -> pa.Array:
    """A matrix of bytes as a column of its rows."""
    rows = np.ascontiguousarray(rows)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(np.arange(len(rows) + 1, dtype=np.int32) * _WIDTH), pa.py_buffer(rows)])


def _unpacked(column: pa.Array) -> np.ndarray:
    """The matrix of bytes of a column of _packed()."""
    at = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], dtype=np.uint8)[at[0] : at[-1]].reshape(-1, _WIDTH)


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _key(rule: int, x: np.ndarray, y: np.ndarray | int = 0) -> np.ndarray:
    with np.errstate(over="ignore"):
        return _mixed(_mixed(x + np.uint64(rule)) + np.asarray(y, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def attributes(shared):
    """(n, words, families, day, several, people) into the keys over which nodes meet, as rows of _ROW.

    Words rank from the rarest to the most frequent, ties by hash, so all nodes have their
    common words in one order. By prefix filtering, two titles that have `share` of the
    longer one's words in common have one among the first size - ceil(share * size) + 1 of
    each, and two among one more. So titles with half of their words and a family in
    common meet over one rare word and the family, those with SHARE_ALONE of their words
    over two rare words, equal ones over the whole title, long ones over single words, and
    records without a title over the first family and the day.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        held = lambda h: counts[(h.view(np.uint64) % np.uint64(COUNTERS)).astype(np.int64)]
        for big in batches:
            for start in range(0, big.num_rows, 4096):
                batch = big.slice(start, 4096)
                n = batch.column(0).to_numpy()
                flat = lambda c: (c.flatten().to_numpy().astype(np.int64), np.diff(c.offsets.to_numpy()).astype(np.int64))
                words, size = flat(batch.column(1))
                families, fsize = flat(batch.column(2))
                rows = np.arange(len(n))
                # one row of ranked words for each node; words that no other node has rank last and are left out
                width = int(max(size.max(initial=0), PRINTS))
                at, place = np.repeat(rows, size), np.arange(len(words)) - np.repeat(np.cumsum(size) - size, size)
                rank = np.full((len(n), width), np.uint64(2**64 - 1))
                c = held(words)
                rank[at, place] = np.where(c > 1, (np.minimum(c, 2**31 - 1).astype(np.uint64) << np.uint64(32)) | (words.view(np.uint64) >> np.uint64(32)), np.uint64(2**64 - 1))
                order = np.argsort(rank, axis=1, kind="stable")
                w = np.zeros((len(n), width), dtype=np.uint64)
                w[at, place] = words.view(np.uint64)
                w = np.take_along_axis(w, order, axis=1)
                known = np.bincount(at[c > 1], minlength=len(n))
                valid = np.arange(PRINTS) < np.minimum(known, PRINTS)[:, None]
                prints = np.where(valid, np.maximum(_mixed(w[:, :PRINTS]) >> np.uint64(48), np.uint64(1)), np.uint64(0)).astype(np.uint16)
                people, psize = flat(batch.column(5))
                pat, pplace = np.repeat(rows, psize), np.arange(len(people)) - np.repeat(np.cumsum(psize) - psize, psize)
                fits = psize[pat] <= NAME_PRINTS
                named = np.zeros((len(n), NAME_PRINTS), dtype=np.uint16)
                named[pat[fits], pplace[fits]] = people[fits]
                fat = np.repeat(rows, fsize)
                own = np.zeros(len(n), dtype=np.uint64)
                np.bitwise_or.at(own, fat, np.uint64(1) << (families.view(np.uint64) & np.uint64(63)))
                prefix = lambda share, least: np.minimum(known, np.maximum(least, size - np.ceil(share * size - 1e-9).astype(np.int64) + least))
                short = size <= LONGEST
                half, most = prefix(0.5, 1), prefix(SHARE_ALONE, 2)
                keys, of, rules = [], [], []

                def put(rule: int, key: np.ndarray, node: np.ndarray) -> None:
                    keys.append(key)
                    of.append(node)
                    rules.append(np.full(len(key), rule, dtype=np.int8))

                shown = held(families) > 1
                fam, fat = families.view(np.uint64)[shown], fat[shown]
                for j in range(int(half[short].max(initial=0))):
                    ok = short[fat] & (half[fat] > j)
                    put(WORD_FAMILY, _key(WORD_FAMILY, w[fat[ok], j], fam[ok]), fat[ok])
                for j in range(1, int(most[short].max(initial=0))):
                    ok = np.flatnonzero(short & (most > j))
                    for i in range(j):
                        put(WORDS, _key(WORDS, w[ok, i], w[ok, j]), ok)
                for j in range(int(half[size >= LONG].max(initial=0))):
                    ok = np.flatnonzero((size >= LONG) & (half > j))
                    put(WORD, _key(WORD, w[ok, j]), ok)
                with np.errstate(over="ignore"):
                    whole = np.zeros(len(n), dtype=np.uint64)
                    np.add.at(whole, at, _mixed(words.view(np.uint64)))
                ok = np.flatnonzero(size > 0)
                put(TITLE, _key(TITLE, whole[ok], size[ok]), ok)
                day, several = batch.column(3), batch.column(4).to_numpy(zero_copy_only=False).astype(bool)
                ok = np.flatnonzero(day.is_valid().to_numpy(zero_copy_only=False) & several & (fsize > 0))
                first = families.view(np.uint64)[(np.cumsum(fsize) - fsize)[ok]]
                put(FAMILY_DAY, _key(FAMILY_DAY, first, day.fill_null(0).to_numpy()[ok].astype(np.int64).view(np.uint64)), ok)
                of_ = np.concatenate(of)
                limit = lambda x: np.minimum(x, 2**15 - 1).astype(np.int16)
                side = np.zeros((len(n), _WIDTH), dtype=np.uint8)
                for part, kind, x in (("prints", np.uint16, prints), ("low", np.uint8, named & 255), ("high", np.uint8, (named[:, ::2] >> 8) | ((named[:, 1::2] >> 8) << 4)), ("own", np.uint64, own[:, None]), ("size", np.int16, limit(size)[:, None]), ("more", np.int16, limit(np.maximum(0, known - PRINTS))[:, None])):
                    side[:, _SIDE[part]] = np.ascontiguousarray(x.astype(kind)).view(np.uint8)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(n[of_]), _packed(side[of_]), pa.array(np.concatenate(rules), pa.int8())], schema=_ROW)

    return run


def _names(side: np.ndarray) -> np.ndarray:
    """The fingerprints of names' words."""
    low, high = side[:, _SIDE["low"]], side[:, _SIDE["high"]]
    return low.astype(np.uint16) | (np.stack([high & 15, high >> 4], 2).reshape(-1, NAME_PRINTS).astype(np.uint16) << 8)


def _possible(x: np.ndarray, y: np.ndarray, rule: np.ndarray) -> np.ndarray:
    """Whether titles may have enough words in common, by fingerprints; x and y hold what _SIDE packs.

    Equal words have equal fingerprints and words without one count as common, so the
    bound is never below the number of common words. Lists of names with more words than
    fit (and empty ones) count as if they had one in common.
    """
    part = lambda side, name, kind: side[:, _SIDE[name]].view(kind)
    a, b = part(x, "prints", np.uint16), part(y, "prints", np.uint16)
    (own_a, size_a, more_a), (own_b, size_b, more_b) = ([part(z, name, kind)[:, 0] for name, kind in (("own", np.uint64), ("size", np.int16), ("more", np.int16))] for z in (x, y))
    common = more_a.astype(np.int32) + more_b
    for k in range(PRINTS):
        one = a[:, k]
        if not one.any():
            break
        common += (b == one[:, None]).any(1) & (one != 0)
    short = np.minimum(size_a, size_b)
    alone = (rule == WORDS) & (own_a != 0) & (own_b != 0) & ((own_a & own_b) == 0)
    ok = (common >= np.where(alone, SHARE_ALONE, SHARE) * short - 1e-9) & ((rule != FAMILY_DAY) | (short == 0))
    doubt = np.flatnonzero(ok & ((rule == WORDS) | (rule == WORD)) & (common < SHARE_APART * short - 1e-9) )
    if len(doubt):
        p, q = _names(x[doubt]), _names(y[doubt])
        shared = ~(p.any(1) & q.any(1))
        for k in range(NAME_PRINTS):
            open_ = np.flatnonzero(~shared & (p[:, k] != 0))
            if not len(open_):
                break
            shared[open_] = (q[open_] == p[open_, k][:, None]).any(1)
        ok[doubt[~shared]] = False
    # Equal titles meet as such, once, and need no other key: all their words have a fingerprint.
    twin = np.flatnonzero(ok & (rule != TITLE) & (rule != FAMILY_DAY) & (size_a == size_b) & (common >= size_a) & (more_a == 0) & (more_b == 0))
    if len(twin):
        p = a[twin]
        ok[twin[(p == b[twin]).all(1) & ((p != 0).sum(1) == size_a[twin])]] = False
    return ok


_AT_ONCE = 1 << 17


def _met(block: int):
    """Rows of _ROW sorted by key into the possible pairs (a, b) of each key of up to `block` rows.

    The rows of a larger key come out again as (a = n, key, ...) to be split. Only up to
    `block` rows of a key are ever held.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []  # the rows of the key at the end of the last batch, by column
        hot = None
        for batch in _and_none(batches):
            if batch is not None:
                if not batch.num_rows:
                    continue
                now = [_unpacked(c) if c.type == pa.binary() else c.to_numpy(zero_copy_only=False) for c in batch.columns]
                cols = [np.concatenate(x) for x in zip(held, now)] if held else now
            else:
                cols = held
                if not cols:
                    return
            key = cols[0]
            starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            ends = np.append(starts[1:], len(key))
            if batch is not None:  # the last key may go on
                keep = [c[starts[-1] :] for c in cols]
                going_hot = len(keep[0]) > block or hot == key[-1]
                held = [] if going_hot else keep
                if not going_hot:
                    starts, ends = starts[:-1], ends[:-1]
            size = ends - starts
            is_hot = size > block
            if hot is not None and len(starts) and key[starts[0]] == hot:
                is_hot[0] = True
            found = []
            for m in np.unique(size[~is_hot & (size > 1)]):
                of_size = starts[~is_hot & (size == m)]
                i, j = np.triu_indices(int(m), 1)
                step = max(1, _AT_ONCE // len(i))
                for k in range(0, len(of_size), step):
                    at = of_size[k : k + step]
                    x, y = (at[:, None] + i).ravel(), (at[:, None] + j).ravel()
                    ok = _possible(cols[2][x], cols[2][y], cols[3][x])
                    a, b = cols[1][x[ok]], cols[1][y[ok]]
                    found.append(np.stack([np.minimum(a, b), np.maximum(a, b)], 1))
            rest = [np.arange(s, e) for s, e, h in zip(starts, ends, is_hot) if h]
            if rest:
                hot = key[rest[-1][0]]
            pairs = np.concatenate(found) if found else np.zeros((0, 2), dtype=np.int64)
            for k in range(0, len(pairs), 1 << 16):
                one = pairs[k : k + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array(one[:, 0]), pa.array(one[:, 1]), *(pa.nulls(len(one), f.type) for f in list(_MET)[2:])], schema=_MET)
            if rest:
                rows = np.concatenate(rest)
                yield pa.RecordBatch.from_arrays([pa.array(cols[1][rows]), pa.nulls(len(rows), pa.int64()), pa.array(cols[0][rows]), _packed(cols[2][rows]), pa.array(cols[3][rows], pa.int8())], schema=_MET)

    return run


def _and_none(batches):
    yield from batches
    yield None


def _crossed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (cell, n, side, rule, part) sorted by cell into the possible pairs (a, b) of a row of part 0 and one of part 1 of each cell.

    Part 2 is both: the rows of such a cell meet each other, each pair once. Only one cell is ever held.
    """

    def met(cell: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        _, n, side, rule, part = cell
        one, two = np.flatnonzero(part != 1), np.flatnonzero(part != 0)
        step = max(1, _AT_ONCE // max(1, len(two)))
        for k in range(0, len(one) if len(two) else 0, step):
            x, y = (z.ravel() for z in np.meshgrid(one[k : k + step], two, indexing="ij"))
            new = np.where(part[x] == 2, n[x] < n[y], n[x] != n[y])
            x, y = x[new], y[new]
            ok = _possible(side[x], side[y], rule[x])
            x, y = n[x[ok]], n[y[ok]]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["a", "b"])

    held: list[np.ndarray] = []
    for batch in _and_none(batches):
        if batch is not None:
            if not batch.num_rows:
                continue
            now = [_unpacked(c) if c.type == pa.binary() else c.to_numpy(zero_copy_only=False) for c in batch.columns]
            held = [np.concatenate(x) for x in zip(held, now)] if held else now
        if not held:
            return
        ends = np.append(np.flatnonzero(held[0][1:] != held[0][:-1]) + 1, len(held[0]))
        done = ends if batch is None else ends[:-1]  # the last cell may go on
        for start, end in zip(np.append(0, done[:-1]), done):
            yield from met([c[start:end] for c in held])
        held = [c[ends[-2] if len(ends) > 1 else 0 :] for c in held]


#: Rows of one side in a cell, in blocks: those of a cell are held in one task, so its pairs need no shuffle.
CELL = 16


def _all_of(left: DataFrame, right: DataFrame | None, block: int) -> DataFrame:
    """(a, b): the possible pairs of a row of left and a row of right of one key, or of two rows of left if right is None.

    The rows of a key are dealt out to chunks of about CELL * block; two chunks are a cell, which is one task's.
    """
    chunk = lambda rows: rows.join(rows.groupBy("key").agg(F.ceil(F.count("*") / (CELL * block)).cast("int").alias("k")), "key").withColumn("c", F.pmod(F.xxhash64("n"), F.col("k")).cast("int"))
    each = lambda k: F.explode(F.sequence(F.lit(0), F.col(k) - 1)).alias("other")
    cell = lambda i, j, part: [F.xxhash64("key", i, j).alias("cell"), "n", "side", "rule", part.cast("byte").alias("part")]
    x = chunk(left)
    if right is None:
        c, other = F.col("c"), F.col("other")
        rows = x.select("*", each("k")).select(*cell(F.least(c, other), F.greatest(c, other), F.when(c == other, 2).otherwise((c > other).cast("int"))))
    else:
        y = chunk(right)
        of = lambda d, e: d.join(e.groupBy("key").agg(F.max("k").alias("ke")), "key").select("*", each("ke"))
        rows = of(x, y).select(*cell("c", "other", F.lit(0))).unionByName(of(y, x).select(*cell("other", "c", F.lit(1))))
    return rows.repartition("cell").sortWithinPartitions("cell").mapInArrow(_crossed, "a bigint, b bigint")


def _near_names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch.filter(pa.array([_near(_word(x), _word(y)) for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())], pa.bool_()))


def name_marks(nodes: DataFrame) -> DataFrame:
    """(n, marks): the hashes of the words of authors' names, and of the lesser words that these are a slip or two from.

    So nodes with an equal or a near word of a name have a mark in common. Near words are
    looked for among the distinct words only, by the forms that slips leave in common.
    """
    word = F.explode(F.array_distinct(F.split(F.regexp_replace("names", r"\|", " "), " "))).alias("word")
    held = written(nodes.where("names <> ''").select("n", word), "words")
    long = F.when(F.char_length("word") >= 7, slipped_twice(F.col("word"))).otherwise(slipped(F.col("word")))
    forms = written(held.where(F.char_length("word") >= 5).select("word").distinct().select("word", F.explode(F.transform(long, lambda f: F.xxhash64(f))).alias("form")), "forms")
    near = forms.join(forms.select(F.col("word").alias("lesser"), "form").hint("shuffle_hash"), "form").where("lesser < word").select("word", "lesser").distinct().mapInArrow(_near_names, "word string, lesser string")
    others = written(near.groupBy("word").agg(F.collect_list("lesser").alias("others")), "near")
    every = F.explode(F.concat(F.array("word"), F.coalesce("others", F.array().cast("array<string>"))))
    marks = written(spread_join(held, others, "word", hot_keys(held, "word", held.count()), "left").select("n", every.alias("w")).groupBy("n").agg(F.collect_set(F.xxhash64("w")).alias("marks")), "marks")
    for t in (held, forms, others):
        removed(t)
    return marks


def met_pairs(keys: DataFrame, nodes: DataFrame, block: int) -> tuple[DataFrame, list[DataFrame]]:
    """(pairs, tables): all possible pairs (a, b) of rows with one key, once or more; tables are to be removed in the end.

    Pairs that are ever accepted agree in the name of an author, slips allowed, unless one
    of them has no authors. So the rows of a key that more than `block` hold are split by
    name_marks(), and rows without authors meet all others of the key. Rows of a key that
    has a family in it agree in a name already, so these are not split: they are compared
    once, those of a day only with rows that have no title, as others are no pair there.
    What is compared in full is so in cells, so none gets a hot key whole.
    """
    cut = lambda rows: written(rows.repartition("key").sortWithinPartitions("key").mapInArrow(_met(block), _MET_DDL), "met")
    hot_of = lambda met: met.where("key is not null").select("key", F.col("a").alias("n"), "side", "rule")
    met = cut(keys)
    tables, pairs, hot = [met], met.where("key is null").select("a", "b"), hot_of(met)
    rules = {r.rule for r in hot.select("rule").distinct().collect()}
    if WORD_FAMILY in rules:
        pairs = pairs.unionByName(_all_of(hot.where(F.col("rule") == WORD_FAMILY), None, block))
    if FAMILY_DAY in rules:
        days = hot.where(F.col("rule") == FAMILY_DAY)
        pairs = pairs.unionByName(_all_of(days.join(nodes.where("t = ''").select("n"), "n", "left_semi").select(days.columns), days, block))
    if rules <= {WORD_FAMILY, FAMILY_DAY}:
        return pairs, tables
    hot = hot.where(~F.col("rule").isin(WORD_FAMILY, FAMILY_DAY))
    marks = name_marks(nodes.join(hot.select("n").distinct(), "n", "left_semi"))
    again = cut(hot.join(marks, "n").select(*hot.columns, F.explode("marks").alias("mark")).withColumn("key", F.xxhash64("key", "mark")).drop("mark"))
    tables += [marks, again]
    pairs, still = pairs.unionByName(again.where("key is null").select("a", "b")), hot_of(again)
    if not still.isEmpty():
        pairs = pairs.unionByName(_all_of(still, None, block))
    lone = hot.join(nodes.where("names = ''").select("n"), "n", "left_semi").select(hot.columns)
    if not lone.isEmpty():
        pairs = pairs.unionByName(_all_of(lone, hot, block))
    return pairs, tables


@lru_cache(maxsize=1 << 15)
def _word(w: str) -> tuple[str, int, int]:
    """(word, length, bits of its letters)."""
    bits = 0
    for c in w:
        bits |= 1 << (ord(c) & 63)
    return w, len(w), bits


def _near(x: tuple[str, int, int], y: tuple[str, int, int]) -> bool:
    """Whether two words are the same but for a slip or, if they are long, two."""
    if x[0] == y[0]:
        return True
    n, m = (x[1], y[1]) if x[1] < y[1] else (y[1], x[1])
    most = 2 if n >= 7 else 1 if n >= 4 else 0
    return m - n <= most and most > 0 and (x[2] ^ y[2]).bit_count() <= 2 * most and _measured(x[0], y[0], most)


@lru_cache(maxsize=1 << 14)
def _measured(x: str, y: str, most: int) -> bool:
    return distance(x, y, most) <= most


def title_likeness(a: list[str], b: list[str], least: float = 0.0) -> float:
    """The share of words two titles have in common, slips allowed; of a title cut short, the share within it.

    0 as soon as it is sure to be below `least`.
    """
    if a == b:
        return 1.0 if a else 0.0
    if not a or not b:
        return 0.0
    rest_a, rest_b = [], list(b)
    for t in a:
        if t in rest_b:
            rest_b.remove(t)
        else:
            rest_a.append(t)
    same = len(a) - len(rest_a)
    if 4 * same < min(len(a), len(b)):  # too little for slips to make up
        return 0.0
    short, long = (a, b) if len(a) < len(b) else (b, a)
    if len(short) >= 2 and len(long) - len(short) >= 2 and all(x == y or _near(_word(x), _word(y)) for x, y in zip(short, long)):
        return max(2 * len(short) / (len(a) + len(b)), 0.9)
    need = least * (len(a) + len(b)) / 2 - 1e-9
    left = len(rest_a)
    others = [_word(u) for u in rest_b]
    for t in rest_a:
        if same + min(left, len(others)) < need:
            return 0.0
        left -= 1
        t = _word(t)
        for k, u in enumerate(others):
            if -3 < t[1] - u[1] < 3 and (t[2] ^ u[2]).bit_count() <= 4 and _near(t, u):
                del others[k]
                same += 1
                break
    return 2 * same / (len(a) + len(b)) if same >= need else 0.0


@lru_cache(maxsize=1 << 15)
def _name(name: str) -> tuple[list, list, list]:
    """(words, words of five letters and more, words as such) of a name."""
    words = name.split(" ")
    each = [_word(w) for w in words]
    return each, [w for w in each if w[1] >= 5], words


def author_likeness(a: list[str], b: list[str]) -> float | None:
    """The share of the shorter list of names that the other one has; None if one is empty."""
    if not a or not b:
        return None
    if a == b:
        return 1.0
    if len(a) > len(b):
        a, b = b, a
    rest = list(b)
    hits = 0
    for name in a:
        if name in rest:
            hits += 1
            rest.remove(name)
            continue
        own = _name(name)[0]
        best, score, whole = None, 0, True
        for other in rest:
            words, long, every = _name(other)
            n = total = 0
            for t in own:
                if t[0] in every:
                    n, total = n + 1, total + 3
                elif t[1] >= 5:
                    for u in long:
                        if -3 < t[1] - u[1] < 3 and (t[2] ^ u[2]).bit_count() <= 4 and _near(t, u):
                            n, total = n + 1, total + 2
                            break
            if total > score:
                best, score, whole = other, total, n == len(own) or n == len(words)
        if best is not None:
            hits += 1 if whole else 0.5  # other words on both sides: a namesake or a pet name
            rest.remove(best)
    return hits / len(a)


def confidence(x: dict, y: dict, least: float = 0.0) -> float:
    """How sure it is that two records with the same mark are of one work, 0 to 1; 0 once it is sure to be below `least`."""
    years = abs(x["year"] - y["year"]) if x["year"] is not None and y["year"] is not None else None
    one_day = x["day"] is not None and x["day"] == y["day"]
    if not x["tokens"] or not y["tokens"]:
        if not one_day or author_likeness(x["names"], y["names"]) != 1:
            return 0.0
        return 0.75 if min(len(x["names"]), len(y["names"])) > 1 else 0.6
    time = 0.7 if years is None else (1.0, 0.85, 0.5)[years] if years <= 2 else 0.1
    if one_day:
        time = 1.0
    known = bool(x["names"] and y["names"])
    title = title_likeness(x["tokens"], y["tokens"], (least - 0.3 * (1.0 if known else 0.45) - 0.1 * time) / 0.6)
    if title < 0.5:
        return 0.0
    people = author_likeness(x["names"], y["names"]) if known else 0.45
    return 0.6 * title + 0.3 * people + 0.1 * time


@lru_cache(maxsize=1 << 14)
def _title(t: str) -> tuple[list[str], frozenset]:
    tokens = t.split()
    return tokens, frozenset(tokens)


def _strangers(a: str, b: str) -> bool:
    """Whether two lists of names, if both are known, have no word in common."""
    return a != "" and b != "" and set(a.replace("|", " ").split(" ")).isdisjoint(b.replace("|", " ").split(" "))


_EDGE = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("w", pa.float32()), ("s", pa.float32())])


def _scored(shared, total: int, least: float):
    """Pairs with their texts into edges (a, b, weight, similarity); those with too few words in common are none.

    Titles have SHARE of the shorter one's words in common, or SHARE_APART if the authors
    of both are known and have no word of a name in common. An edge weighs the sum of
    log(all / holders) over the title words both ends have.
    """
    log_total = math.log(max(2, total))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value

        weights: dict[str, float] = {}

        def weight(word: str) -> float:
            if word not in weights:
                if len(weights) > 1 << 15:
                    weights.clear()
                weights[word] = log_total - math.log(max(1, int(counts[(_hash("w", word) % (1 << 64)) % COUNTERS])))
            return weights[word]

        for batch in batches:
            out: list[list] = [[], [], [], []]
            for a, b, tx, ty, nx, ny, yx, yy, dx, dy in zip(*(c.to_pylist() for c in batch.columns)):
                (p, ps), (q, qs) = _title(tx), _title(ty)
                both = ps if tx == ty else ps & qs
                if p and q:
                    short = min(len(ps), len(qs))
                    if len(both) < SHARE * short - 1e-9 or len(both) < SHARE_APART * short - 1e-9 and _strangers(nx, ny):
                        continue
                w = sum([weight(t) for t in both])
                s = confidence({"tokens": p, "names": nx.split("|") if nx else [], "year": yx, "day": dx}, {"tokens": q, "names": ny.split("|") if ny else [], "year": yy, "day": dy}, least)
                for c, v in zip(out, (a, b, w, s if s >= least else 0.0)):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, _EDGE)], schema=_EDGE)

    return run


def candidate_edges(nodes: DataFrame, live: DataFrame, total: int, least: float, block: int = BLOCK, keep: float = 0.45) -> DataFrame:
    """(a, b, s), a < b: the edges of the candidate graph with a similarity of `least` or more that meta-blocking keeps.

    An edge is kept if it has at least `keep` of the weight of the heaviest edge at one of
    its ends. live has the nodes that are matched (n, words, families, day, several, people), nodes
    the texts of these and others; ends with another mark are no edge.
    """
    spark = nodes.sparkSession
    counted = live.select(F.explode(F.concat("words", "families")).alias("h")).groupBy(_counter(F.col("h")).alias("k")).agg(F.count("*").alias("c")).toArrow()
    counts = np.zeros(COUNTERS, dtype=np.int64)
    counts[counted.column("k").to_numpy()] = counted.column("c").to_numpy()
    shared = spark.sparkContext.broadcast(counts)
    pairs, tables = met_pairs(live.select("n", "words", "families", "day", "several", "people").mapInArrow(attributes(shared), _ROW_DDL), nodes, block)
    own = nodes.select("n", "t", "mark", "names", "year", "day")
    side = lambda e: own.toDF(e, f"t{e}", f"m{e}", f"n{e}", f"y{e}", f"d{e}").hint("shuffle_hash")
    both = pairs.distinct().join(side("a"), "a").join(side("b"), "b").where("ma = mb")
    edges = written(both.select("a", "b", "ta", "tb", "na", "nb", "ya", "yb", "da", "db").mapInArrow(_scored(shared, total, least), "a bigint, b bigint, w float, s float"), "edges")
    for t in tables:
        removed(t)
    top = edges.select(F.explode(F.array("a", "b")).alias("n"), "w").groupBy("n").agg((F.max("w") * keep).alias("least"))
    sure = edges.where(F.col("s") >= least)
    kept = written(sure.join(top.toDF("a", "la").hint("shuffle_hash"), "a").join(top.toDF("b", "lb").hint("shuffle_hash"), "b").where("w >= la or w >= lb").select("a", "b", "s"), "kept")
    removed(edges)
    return kept


def _counter(h: Column) -> Column:
    """The counter of a hash, read as an unsigned number."""
    return h.bitwiseAND(F.lit(COUNTERS - 1)).cast("int")


# --- classes and propagation ------------------------------------------------------------


def _least_labels(edges: DataFrame) -> DataFrame:
    """(v, label) for each vertex of edges (x, y): the least vertex it is joined to, with pointer jumping."""
    arcs = written(edges.unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct(), "arcs")
    label = written(arcs.groupBy(F.col("x").alias("v")).agg(F.min("y").alias("m")).select("v", F.least("v", "m").alias("label")), "label")
    while True:
        near = arcs.join(label.toDF("y", "l"), "y").groupBy(F.col("x").alias("v")).agg(F.min("l").alias("l"))
        step = label.join(near, "v").select("v", F.least("label", "l").alias("label"), F.col("label").alias("old"))
        jump = label.toDF("at", "beyond")
        new = written(step.join(jump, step.label == jump["at"], "left").select("v", F.least("label", "beyond").alias("label"), "old"), "label")
        label = new.select("v", "label")
        if new.where("label < old").isEmpty():
            return label


def classes(nodes: DataFrame, total: int) -> DataFrame:
    """(n, c): the class of each node that is not alone in it, named by its least node.

    One class are nodes with the same DOI or arXiv id and mark, and copies: nodes equal in
    all that is compared (p), if that tells a work; directly or through others.
    """
    tagged = lambda tag, c: F.when(F.col(c).isNotNull(), F.xxhash64(F.lit(tag), F.col(c), F.col("mark")))
    keys = F.array(F.when(F.col("telling"), F.xxhash64(F.lit("p"), "p")), tagged("d", "doi"), tagged("x", "arxiv"))
    member = nodes.select("n", F.explode(F.array_compact(keys)).alias("k"))
    held = written(member.groupBy("k").agg(F.min("n").alias("least"), F.count("*").alias("c")).where("c > 1"), "held")
    hot = held.where(F.col("c") > max(1000, total // HOT_SHARE)).select("k")
    star = written(spread_join(member, held.select("k", "least"), "k", hot).select("k", "n", "least"), "star")
    label = written(star.groupBy("n").agg(F.min("least").alias("c")), "class")
    # Keys whose members got different labels join them.
    of_key = star.join(label, "n").groupBy("k", "c").agg(F.lit(1).alias("one")).select("k", "c")
    ends = of_key.groupBy("k").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("k", "lo")
    across = written(of_key.join(ends, "k").where("c > lo").select(F.col("c").alias("x"), F.col("lo").alias("y")).distinct(), "across")
    if not across.isEmpty():
        to = _least_labels(across)
        label = written(label.join(to.toDF("c", "to"), "c", "left").select("n", F.coalesce("to", "c").alias("c")), "class")
    for t in (held, star):
        removed(t)
    return label


def propagated(edges: DataFrame, strong: float, fade: float) -> DataFrame:
    """(a, b, s) with similarity passed on by neighbours until no pair gains: s(a, b) is at least fade * s(a, c) * s(c, b).

    Only pairs of at least `strong` pass theirs on, so a weak link joins no two groups.
    """
    now = news = written(edges.where(F.col("s") >= strong).groupBy("a", "b").agg(F.max("s").alias("s")), "sims")
    turned = lambda e: e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"), "s"))
    while True:
        step = turned(news).select(F.col("b").alias("c"), "a", "s").join(turned(now).select(F.col("a").alias("c"), "b", F.col("s").alias("s2")), "c").where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), (F.col("s") * F.col("s2") * fade).cast("float").alias("s")).where(F.col("s") >= strong).groupBy("a", "b").agg(F.max("s").alias("s"))
        gained = written(step.join(now.select("a", "b", F.col("s").alias("old")), ["a", "b"], "left").where("old is null or s > old + 1e-6").select("a", "b", "s"), "gain")
        if gained.isEmpty():
            return now
        news, now = gained, written(now.unionByName(gained).groupBy("a", "b").agg(F.max("s").alias("s")), "sims")


def linked_classes(observations: DataFrame, least: float = 0.72, fade: float = 1.0, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(members, links): the class of each observation (id, source, doi, arxiv, p, self, c) and the pairs of classes (a, b, s), a < b.

    Copies cost one node: only one of those equal in all that is compared is matched.
    """
    title, people = F.col("t") != "", F.contains("names", F.lit("|"))
    own = 0.6 + 0.3 * F.when(F.col("names") != "", 1.0).otherwise(0.45) + 0.1 * F.when(F.col("year").isNotNull() | F.col("day").isNotNull(), 1.0).otherwise(0.7)
    made = records(observations).withColumn("n", F.monotonically_increasing_id()).withColumn("p", F.xxhash64("t", "mark", "names", F.coalesce("year", F.lit(-9999)), F.coalesce("day", F.lit(-9999999))))
    # Without a title only several authors and a day tell a work; other records match nothing.
    nodes = written(made.withColumn("telling", title | people & F.col("day").isNotNull()).withColumn("self", F.when(title, own).otherwise(0.75)), "nodes")
    total = nodes.count()
    telling = nodes.where("telling").select("n", "p", "words", "families", "day", people.alias("several"), "people")
    live = written(telling.groupBy("p").agg(F.min(F.struct("n", "words", "families", "day", "several", "people")).alias("x")).select("x.*"), "live")
    kept = candidate_edges(nodes, live, total, least, block)
    removed(live)
    label = classes(nodes, total)
    named = lambda e: label.toDF(e, f"c{e}")
    among = kept.join(named("a"), "a", "left").join(named("b"), "b", "left").select(F.coalesce("ca", "a").alias("x"), F.coalesce("cb", "b").alias("y"), "s").where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "s")
    links = propagated(among, least, fade)
    members = nodes.select("n", "id", "source", "doi", "arxiv", "p", "self").join(label.hint("shuffle_hash"), "n", "left").select("id", "source", "doi", "arxiv", "p", "self", F.coalesce("c", "n").alias("c"))
    return members, links


def linked_records(observations: DataFrame, least: float = 0.72, fade: float = 1.0, block: int = BLOCK) -> DataFrame:
    """(observation_id_a, observation_id_b, confidence) for pairs of different sources that share no DOI and no arXiv id.

    Records with one DOI or arXiv id are joined beforehand, if their titles bear the
    same mark (sequel, correction, reply, extended report), and pass similarity on,
    but are no result themselves. Rows without an observation_id give nothing; null
    sources differ from none; unreadable or null author lists and junk titles count
    as absent, and a pair is then judged by what is left. Whole repeated rows give
    each pair once, empty tables none; of an id with several different rows all count.

    Pairs of classes are spread to their members only where source and identifiers
    differ, which is told by the distinct combinations of these first.
    """
    members, links = linked_classes(observations, least, fade, block)
    members = written(members.withColumn("sub", F.xxhash64("c", *[F.coalesce(c, F.lit("\0")) for c in ("source", "doi", "arxiv")])), "members")
    subs = written(members.select("c", "sub", "source", "doi", "arxiv").distinct(), "subs")
    within = subs.groupBy("c").agg(F.count("*").alias("k")).where("k > 1").select(F.col("c").alias("a"), F.col("c").alias("b"), F.lit(None).cast("float").alias("s"))
    side = lambda e: subs.toDF(e, f"sub{e}", f"s{e}", f"d{e}", f"x{e}")
    both = links.unionByName(within).join(side("a").hint("shuffle_hash"), "a").join(side("b").hint("shuffle_hash"), "b").where("a <> b or suba < subb")
    apart = (F.col("sa") != F.col("sb")) & F.coalesce(F.col("da") != F.col("db"), F.lit(True)) & F.coalesce(F.col("xa") != F.col("xb"), F.lit(True))
    one = lambda e: members.select(F.col("sub").alias(f"sub{e}"), F.col("id").alias(f"i{e}"), F.col("p").alias(f"p{e}"), F.col("self").alias(f"self{e}"))
    found = both.where(apart).select("suba", "subb", "s").join(one("a"), "suba").join(one("b"), "subb").where("ia <> ib")
    sure = F.coalesce(F.col("s").cast("double"), F.when(F.col("pa") == F.col("pb"), F.col("selfa")).otherwise(F.lit(1.0)))
    return found.groupBy(F.least("ia", "ib").alias("observation_id_a"), F.greatest("ia", "ib").alias("observation_id_b")).agg(F.round(F.max(sure), 4).alias("confidence"))


_COLUMNS = ("observation_id", "source_name", "normalized_doi", "normalized_arxiv_id", "title", "publication_year", "publication_date", "raw_authors")


def p7_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(observation_id_a, observation_id_b, confidence) of every matched pair; see linked_records()."""
    return linked_records(table(spark, sf_dir, "source_work_observations", *_COLUMNS))


def p7_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(class_a, class_b, confidence): the pairs of classes; with p7_members the same result without writing out copies."""
    members, links = linked_classes(table(spark, sf_dir, "source_work_observations", *_COLUMNS))
    return _named(members, links)[1]


def p7_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(observation_id, class_id) of each observation; a class is named by its least observation_id."""
    members, links = linked_classes(table(spark, sf_dir, "source_work_observations", *_COLUMNS))
    return _named(members, links)[0]


def _named(members: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
    names = members.groupBy("c").agg(F.min("id").alias("class_id"))
    of = lambda e: names.toDF(e, f"class_{e}")
    pairs = links.join(of("a"), "a").join(of("b"), "b").select(F.least("class_a", "class_b").alias("class_a"), F.greatest("class_a", "class_b").alias("class_b"), F.round(F.col("s").cast("double"), 4).alias("confidence"))
    return members.join(names, "c").select(F.col("id").alias("observation_id"), "class_id").distinct(), pairs


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(observation_id_a, observation_id_b) of every matched pair; see linked_records()."""
    return p7_pairs(spark, sf_dir).select("observation_id_a", "observation_id_b")
