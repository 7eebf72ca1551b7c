"""Freely typed values mapped to the closest entry of a reference list, unmatched ones reported.

Distinct values are normalised; candidates come from a character n-gram inverted
index of the list and are scored by weighted cosine (rare n-grams weigh more);
of the candidates above a threshold the best is accepted if an exact check of
its words holds and it leads the next one by a margin.
"""

from __future__ import annotations

import math
import re
import unicodedata
import uuid
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.functions.text import strip
from folioflow.operators.common import hot_keys, table, written

#: Words that tell nothing about which entry is meant.
IDLE = frozenset("of on in the and for de la le des und der die du et a an online print forthcoming press issn vol volume no nr number issue pp pages p to appear".split())
#: Short forms that are no beginning of the word they stand for.
SHORT = {"jnl": "journal", "jrnl": "journal", "jour": "journal", "wksp": "workshop", "wkshp": "workshop", "ws": "workshop", "intl": "international", "int'l": "international", "trans": "transactions", "proc": "proceedings", "conf": "conference", "symp": "symposium", "adv": "advances", "ann": "annals", "bull": "bulletin", "eur": "european", "lett": "letters", "rev": "review"}
_BEHIND = re.compile(r"\b(?:vol(?:ume)?|no|nr|pp?|issue|pages?)(?:\.\s*|\s+)\d+(?:\s*[-–]\s*\d+)?\b|\(\s*issn[^)]*\)|\bissn[:\s]*[\dx-]{8,9}|\[[^\]]*\]|\(\s*(?:print|online|forthcoming|in press|to appear)\s*\)|\b\d+\s*\(\d+\)|['’]\d{2}\b|\b(?:1[6-9]|20)\d\d\b|^\s*in\s*:", re.I)
_BEFORE = re.compile(r"^\s*(?:proceedings|proc)\.?\s+(?:of\s+)?(?:the\s+)?(?:\d+(?:st|nd|rd|th)\s+)?", re.I)
_ORDINAL = re.compile(r"\d+(?:st|nd|rd|th)")
_LEET = str.maketrans("01345", "oleas")
_WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)?")


def fold(text: str) -> str:
    """Lower case, compatible forms and accents folded, white space of any kind a blank."""
    text = unicodedata.normalize("NFKD", text.replace("\u0000", " "))
    return " ".join("".join(c for c in text if not unicodedata.combining(c)).replace("_", " ").lower().split())


def words(text: str) -> list[str]:
    """The words of a folded name without what is written around it; digits inside words are read as letters."""
    out = []
    for w in _WORD.findall(_BEHIND.sub(" ", text)):
        if _ORDINAL.fullmatch(w):
            continue
        if not w.isalpha() and not w.isdigit():
            w = w.translate(_LEET)
        if w.isdigit():
            continue
        out.append(w.replace("’", "'"))
    return out


def distance(a: str, b: str, most: int) -> int:
    """Edit distance with swaps of neighbours, most + 1 when it is larger."""
    if a == b:
        return 0
    n, m = len(a), len(b)
    if n - m > most or m - n > most:
        return most + 1
    same = min(n, m)
    i = 0
    while i < same and a[i] == b[i]:  # slips are few: what both words begin and end with needs no table
        i += 1
    k = 0
    while k < same - i and a[n - 1 - k] == b[m - 1 - k]:
        k += 1
    a, b = a[i : n - k], b[i : m - k]
    if len(a) < 2 and len(b) < 2 or not a or not b:
        return min(max(len(a), len(b)), most + 1)
    before, row = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, before, row = before, row, [i]
        for j, y in enumerate(b, 1):
            d = min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y))
            if last is not None and i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, last[j - 2] + 1)
            row.append(d)
        if min(row) > most:
            return most + 1
    return row[-1]


@lru_cache(maxsize=1 << 18)
def word_likeness(typed: str, word: str) -> float:
    """How far a typed word may stand for a word of an entry, 0 when it can't."""
    if typed == word:
        return 1.0
    n, m = len(typed), len(word)
    if SHORT.get(typed) == word:
        return 0.97
    best = 0.0
    if word.startswith(typed):
        best = 0.95 if n >= 3 else 0.85 if n == 1 else 0.8
    most = 1 if max(n, m) <= 5 else 2 if min(n, m) < 12 else 3
    if n >= 4 and m >= 4 and abs(n - m) <= most and (d := distance(typed, word, most)) <= most:
        best = max(best, 0.96 - 0.05 * d if d < 2 or min(n, m) > 7 else 0.72)
    if best < 0.9 and 2 <= n <= m:  # a beginning with one slip
        for k in (n - 1, n, n + 1):
            if 2 <= k < m and distance(typed, word[:k], 1) <= 1:
                best = max(best, (0.86 if n >= 4 else 0.78 if n == 3 else 0.6) - 0.02 * (k != n))
    if best < 0.7 and n >= 4 and any(w == word and len(k) >= 4 and distance(typed, k, 1) <= 1 for k, w in SHORT.items()):
        best = 0.7
    if best < 0.7 and 3 <= n < m and typed[0] == word[0]:  # letters left out
        rest = iter(word)
        if all(c in rest for c in typed):
            best = max(best, 0.75)
    return best


@dataclass
class Entry:
    key: str
    words: list[str]
    acronym: str | None


def entry(key: str, name: str | None, normalized: str | None) -> Entry:
    """An entry of the list; a last word in brackets is taken as its acronym."""
    acronym = None
    base = fold(name or normalized or "")
    if m := re.search(r"\(([^()\s]{3,12})\)\s*$", base):
        acronym, base = m[1], base[: m.start()]
    return Entry(key, [w for w in words(base) if w not in IDLE], acronym)


def grams(tokens: list[str], n: int = 3) -> list[str]:
    """The n-grams of each word with its ends marked."""
    return [t[i : i + n] for w in tokens for t in (f"^{w}$",) for i in range(max(1, len(t) - n + 1))]


class Index:
    """An inverted index from n-grams to the forms of the list's entries (name and acronym), weighted by rarity."""

    def __init__(self, entries: list[Entry]):
        self.entries = entries
        forms = [(k, f) for k, e in enumerate(entries) for f in (e.words, [e.acronym] if e.acronym else []) if f]
        self.owner = np.array([k for k, _ in forms], dtype=np.int64)
        self.short = np.array([f == [entries[k].acronym] for k, f in forms], dtype=bool)
        posting: dict[str, dict[int, int]] = defaultdict(lambda: defaultdict(int))
        for i, (_, f) in enumerate(forms):
            for g in grams(f):
                posting[g][i] += 1
        n = max(1, len(forms))
        self.weight = {g: math.log(1 + n / len(p)) for g, p in posting.items()}
        self.rare = math.log(1 + n)
        norm = np.zeros(n)
        for g, p in posting.items():
            for i, c in p.items():
                norm[i] += (c * self.weight[g]) ** 2
        self.norm = np.sqrt(np.maximum(norm, 1e-12))
        self.posting = {g: (np.fromiter(p, dtype=np.int64), np.fromiter(p.values(), dtype=np.float64) * self.weight[g]) for g, p in posting.items()}
        self.vocabulary = {w for e in entries for w in e.words}
        self.begun = {w[:3] for w in self.vocabulary}

    def scores(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(forms, cosines): the forms that share an n-gram with tokens and their weighted cosine with them."""
        own: dict[str, int] = defaultdict(int)
        for g in grams(tokens):
            own[g] += 1
        norm, at, x = 0.0, [], []
        for g, c in own.items():
            w = self.weight.get(g)
            norm += (c * (w if w is not None else self.rare * 0.5)) ** 2
            if w is not None:
                ids, values = self.posting[g]
                at.append(ids)
                x.append(values * (c * w))
        if not at:
            return np.zeros(0, dtype=np.int64), np.zeros(0)
        forms, where = np.unique(np.concatenate(at), return_inverse=True)
        dots = np.bincount(where, weights=np.concatenate(x))
        return forms, dots / (self.norm[forms] * math.sqrt(max(norm, 1e-12)))

    def aligned(self, tokens: list[str], e: Entry) -> float:
        """How well tokens spell the words of e, 0 unless each word is there and nothing else is."""
        if len(tokens) < len(e.words) or not e.words:
            return 0.0
        pairs = []
        for j, w in enumerate(e.words):
            row = [(s, -i, -j) for i, t in enumerate(tokens) if (t == w or t not in self.vocabulary) and (s := word_likeness(t, w)) > 0]
            if not row:
                return 0.0
            pairs += row
        free, used, total = set(range(len(tokens))), set(), 0.0
        for s, i, j in sorted(pairs, reverse=True):
            if -i in free and -j not in used:
                free.remove(-i)
                used.add(-j)
                total += s
        if len(used) < len(e.words):
            return 0.0
        for i in free:
            t = tokens[i]
            named = e.acronym is not None and len(t) > 3 and distance(t, e.acronym, 1) <= 1
            if not named and len(t) > 2 and not (len(t) == 3 and t not in self.begun):  # a mistyped "of", "on" or "in"
                return 0.0
        return total / len(e.words)

    def fits(self, value: str, least: float) -> list[tuple[str, float, float]]:
        """The entries whose words value spells: (key, fit, cosine); all with a cosine of `least` or more are tried."""
        text = fold(value)
        out: dict[int, tuple[float, float]] = {}
        text = _BEHIND.sub(" ", text).strip(" ,.;:")
        for form in dict.fromkeys((_BEFORE.sub("", text), text)):
            tokens = words(form)
            content = [t for t in tokens if t not in IDLE] or tokens
            if not content:
                continue
            forms, cosines = self.scores(content)
            for i, c in zip(forms[cosines >= least].tolist(), cosines[cosines >= least].tolist()):
                k = int(self.owner[i])
                if self.short[i]:
                    fit = float(content == [self.entries[k].acronym])
                else:
                    fit = self.aligned(content, self.entries[k])
                if fit > 0:
                    out[k] = max(out.get(k, (0.0, 0.0)), (fit, c))
        return [(self.entries[k].key, fit, cosine) for k, (fit, cosine) in out.items()]

    def meant(self, value: str, least: float, margin: float) -> str:
        """The key of the entry meant, "" for none: the best fit, if it leads the next by margin in fit, else in cosine."""
        order = sorted(((f, c, k) for k, f, c in self.fits(value, least)), reverse=True)
        if order and (len(order) == 1 or order[0][0] - order[1][0] >= margin or order[0][1] - order[1][1] >= margin):
            return order[0][2]
        return ""


_FITS = pa.schema([("value", pa.string()), ("key", pa.string()), ("fit", pa.float64()), ("cosine", pa.float64())])


@lru_cache(maxsize=2)
def _built(key: object, make: Callable, rows: Shared) -> object:
    return make(rows.value)


class Shared:
    """A broadcast of the rows of a block; what is built from them is built once in a worker, not by the driver."""

    def __init__(self, broadcast):
        self.broadcast, self.key = broadcast, uuid.uuid4().hex

    @property
    def value(self):
        return self.broadcast.value

    def built(self, make: Callable):
        return _built(self.key, make, self)


def in_blocks(rows: Iterator, size: int, spark: SparkSession, search: Callable[[Shared], DataFrame]) -> DataFrame:
    """search() of each block of `size` rows, one block after the other, united.

    Only one block is in memory and broadcast at a time: where there are several, what is
    found for one is written before the next is read. An empty list is searched as one block.
    """
    out, block, more = None, list(islice(rows, size)), True
    while more:
        following = list(islice(rows, size))
        more = bool(following)
        shared = spark.sparkContext.broadcast(block)
        one = search(Shared(shared))
        if more or out is not None:
            one = written(one, "found")
            shared.destroy()
        out, block = one if out is None else out.unionByName(one), following
    return out


def _search(shared: Shared, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.built(lambda block: Index([entry(*r) for r in block]))
        for batch in batches:
            rows = [(v, *fit) for v in batch.column(0).to_pylist() for fit in index.fits(v, least)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_FITS)], schema=_FITS)

    return run


#: Entries whose index a worker holds at once; a longer list is searched in further blocks.
BLOCK_ENTRIES = 20_000


def canonical_entries(values: DataFrame, entries: DataFrame, least: float = 0.1, margin: float = 0.01, block: int = BLOCK_ENTRIES) -> DataFrame:
    """(value, key, fit, cosine): for each distinct value the entry it means, key "" when it means none.

    values has the column value, entries has key, name and normalized. All entries of
    which a form (name, or acronym) has a weighted cosine of `least` or more are
    candidates; one is accepted if its words are all spelled (whole, shortened or with
    slips) and nothing else is, and if it leads the next such entry by `margin`. Ties
    therefore mean none. Null and blank values give no row; entries without a name are
    never meant; with an empty list all values come out with "". Of the list, `block`
    entries are broadcast at a time.
    """
    spark = values.sparkSession
    distinct = values.select(F.col("value").cast("string")).where(F.coalesce(strip(F.col("value")) != "", F.lit(False))).distinct()
    listed = entries.select("key", "name", "normalized").where("key is not null").groupBy("key").agg(F.min(F.struct("name", "normalized")).alias("x")).select("key", "x.*").orderBy("key")
    # Values are few bytes and much work each, so they are spread by number, not by size.
    spread = written(distinct, "values")
    spread = spread.repartition(max(spark.sparkContext.defaultParallelism, -(-spread.count() // 20_000)))
    found = in_blocks((tuple(r) for r in listed.toLocalIterator()), block, spark, lambda shared: spread.mapInArrow(_search(shared, least), "value string, key string, fit double, cosine double"))
    best = F.slice(F.sort_array(F.collect_list(F.struct("fit", "cosine", "key")), asc=False), 1, 2)
    leads = (F.size("b") == 1) | (F.col("b")[0]["fit"] - F.try_element_at("b", F.lit(2))["fit"] >= margin) | (F.col("b")[0]["cosine"] - F.try_element_at("b", F.lit(2))["cosine"] >= margin)
    chosen = found.groupBy("value").agg(best.alias("b")).where(leads).select("value", F.col("b")[0]["key"].alias("key"), F.col("b")[0]["fit"].alias("fit"), F.col("b")[0]["cosine"].alias("cosine"))
    return spread.join(chosen, "value", "left").select("value", F.coalesce("key", F.lit("")).alias("key"), "fit", "cosine")


def p1_mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(value, key, fit, cosine) of each distinct venue name typed in source_work_observations."""
    typed = table(spark, sf_dir, "source_work_observations", "raw_venue_name").select(F.col("raw_venue_name").alias("value"))
    venues = table(spark, sf_dir, "canonical_venues", "canonical_venue_id", "name", "normalized_name").toDF("key", "name", "normalized")
    return canonical_entries(typed, venues)


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(observation_id, canonical_venue_id) of each observation with a venue name, "" when it means no listed venue.

    The distinct values' results go back to the rows by value; values holding more
    than one row in HOT_SHARE are joined by broadcast, the others by shuffle.
    """
    rows = table(spark, sf_dir, "source_work_observations", "observation_id", "raw_venue_name").toDF("observation_id", "value").where(F.coalesce(strip(F.col("value")) != "", F.lit(False)))
    mapped = written(p1_mapped(spark, sf_dir).select("value", "key"), "mapped")
    hot = F.broadcast(hot_keys(rows, "value", rows.count()))
    by_broadcast = rows.join(F.broadcast(mapped.join(hot, "value", "left_semi")), "value")
    by_shuffle = rows.join(hot, "value", "left_anti").join(mapped, "value")
    return by_broadcast.unionByName(by_shuffle).select("observation_id", F.col("key").alias("canonical_venue_id")).distinct()


def p1_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(raw_venue_name, n_rows): the values that mean no listed venue, with how many rows hold them."""
    rows = table(spark, sf_dir, "source_work_observations", "raw_venue_name").toDF("value").groupBy("value").agg(F.count("*").alias("n_rows"))
    return p1_mapped(spark, sf_dir).where("key = ''").join(rows, "value").select(F.col("value").alias("raw_venue_name"), "n_rows")
