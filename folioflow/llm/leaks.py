"""Evaluation texts leaking into training text: containment search by size-partitioned MinHash sketches.

The held-out items are the queries. Items are partitioned by size; each class has
a sampling rate, and the sketch of an item holds the shingle hashes below that
rate (a MinHash sketch whose size follows the set, so it estimates containment in
a document of any length). A class's rate is as low as the smallest part that
still counts as a leak allows: enough of its intact shingles must fall into the
sketch. Where changed words may leave only a few intact shingles the rate is 1.
Documents are scanned where they lie; sketch hits are then verified by exact
containment of the words around them.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.llm.canonical import in_blocks
from folioflow.operators.common import table

#: Letters of other scripts that look like Latin ones, pair by pair.
LOOK_ALIKES = dict(zip("аеорсхуіѕјԁһӏкмтвнοανιρτυκεχηγıɡɑ", "aeopcxyisjdhlkmtbhoaviptukexnyiga"))
_DROP = {c: None for c in [0xAD, *range(0x200B, 0x2010), *range(0x202A, 0x202F), *range(0x2060, 0x2065), 0xFEFF, *range(0x300, 0x370), *range(0xFE00, 0xFE10)]}
_FOLD = _DROP | {ord(a): b for a, b in LOOK_ALIKES.items()}
_TAG = re.compile(r"<sup>[\d,; –-]*</sup>|</?[A-Za-z][^<>]{0,200}>|<!--.*?-->|\\[A-Za-z]+\*?|\[\d+(?:[,; –-]+\d+)*\]", re.S)
_BREAK = re.compile(r"(?<=\w)-[ \t]*\r?\n[ \t]*(?=\w)")
_WORD = re.compile(r"[^\W_]+|_{3,}")
_WORD_ASCII = re.compile(r"[a-z0-9]+|_{3,}")


def words(text: str | None) -> list[str]:
    """The words of text as they are compared: lower case, without markup, numbered references, invisible
    characters, accents and line-end hyphens, look-alike letters folded. Null gives none."""
    if not text:
        return []
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text)
    if "&" in text:
        text = html.unescape(text)
    if "<" in text or "[" in text or "\\" in text:
        text = _TAG.sub(lambda m: " " if m[0][0] in "[\\" or m[0].startswith(("<p", "</p", "<br", "<sup", "<li", "<div")) else "", text)
    if "-" in text:
        text = _BREAK.sub("", text)
    if text.isascii():
        return _WORD_ASCII.findall(text.lower())
    return _WORD.findall(text.lower().translate(_FOLD))


_DIGITS = str.maketrans("01", "ol")


class _Vocabulary(dict):
    """Word to id, 0 for words of no item; digits that look like letters inside a word count as these."""

    def __missing__(self, word: str) -> int:
        if not word.isalpha() and not word.isdigit():
            return self.get(word.translate(_DIGITS), 0)
        return 0


SHINGLE = 5
_P = np.uint64(0x9E3779B97F4A7C15)


def shingle_hashes(ids: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """A 64-bit hash for the `size` words from each place on."""
    n = len(ids) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    x = ids.astype(np.uint64)
    with np.errstate(over="ignore"):
        h = x[:n].copy()
        for k in range(1, size):
            h = h * _P + x[k : k + n]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(27)
        h *= np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def shingle_size(n_words: int, one_in: int) -> int:
    """The words of a shingle for items of n_words: SHINGLE, or less where so few words may leave no longer run whole."""
    changed = n_words // one_in
    return max(1, min(SHINGLE, -(-(n_words - changed) // (changed + 1)))) if n_words < 2 * SHINGLE else SHINGLE


def intact_shingles(n: int, one_in: int) -> int:
    """The fewest shingles left whole in n words or more of which one in `one_in` may be changed."""
    return min(max(1, m - SHINGLE + 1 - SHINGLE * (m // one_in)) for m in range(n, n + 4 * one_in))


def sketch_rate(n_words: int, least_words: int, one_in: int, miss: float = 1e-9) -> float:
    """The share of hashes that the sketch of an item of n_words must hold, 1 where too few shingles stay intact."""
    intact = intact_shingles(min(n_words, least_words), one_in)
    rate = 1 - miss ** (1 / intact)
    return 1.0 if rate > 0.5 else rate


class Sketches:
    """The sketches of the items of one shingle size: sorted hashes with the item and place of each."""

    def __init__(self, size: int, items: list[tuple[int, np.ndarray]], least_words: int, one_in: int):
        self.size = size
        hashes, owners, places = [], [], []
        for k, ids in items:
            h = shingle_hashes(ids, size)
            rate = sketch_rate(len(ids), least_words, one_in)
            at = np.flatnonzero(h <= np.uint64(rate * float(2**64 - 2048)) if rate < 1 else np.ones(len(h), dtype=bool))
            hashes.append(h[at])
            owners.append(np.full(len(at), k))
            places.append(at)
        h = np.concatenate(hashes)
        order = np.argsort(h, kind="stable")
        self.hashes, self.owners, self.places = h[order], np.concatenate(owners)[order], np.concatenate(places)[order]
        # a bit table in front of the search, of which at most a sixteenth is set, so that most places of a document cost one look-up
        width = max(20, (16 * len(h)).bit_length())
        self.shift = np.uint64(64 - width)
        self.bits = np.zeros(1 << width, dtype=bool)
        self.bits[(self.hashes >> self.shift).astype(np.int64)] = True

    def hits(self, doc: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(place in doc, item, place in item) of each shingle of doc that an item's sketch holds."""
        h = shingle_hashes(doc, self.size)
        if not len(h):
            return
        at = np.flatnonzero(self.bits[(h >> self.shift).astype(np.int64)])
        lo = np.searchsorted(self.hashes, h[at], side="left")
        hi = np.searchsorted(self.hashes, h[at], side="right")
        for p, a, b in zip(at[hi > lo].tolist(), lo[hi > lo].tolist(), hi[hi > lo].tolist()):
            for i in range(a, b):
                yield p, int(self.owners[i]), int(self.places[i])


class Index:
    """A block of items partitioned by size: those of a class have one shingle size and one sketch."""

    def __init__(self, items: list[tuple[int, str]], least_words: int, one_in: int):
        self.least, self.one_in = least_words, one_in
        self.ids = [i for i, _ in items]
        self.vocabulary = _Vocabulary()
        self.words: list[np.ndarray] = []
        classes: dict[int, list] = {}
        for k, (_, text) in enumerate(items):
            own = [w if w.isalpha() or w.isdigit() else w.translate(_DIGITS) for w in words(text)]
            ids = np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in own], dtype=np.int64)
            self.words.append(ids)
            if len(ids):
                classes.setdefault(shingle_size(len(ids), one_in), []).append((k, ids))
        self.sketches = [Sketches(size, own, least_words, one_in) for size, own in sorted(classes.items())]

    def found(self, doc: np.ndarray) -> set[int]:
        """The items that doc (word ids) holds wholly or in a part that counts."""
        out: set[int] = set()
        for sketch in self.sketches:
            done: dict[tuple[int, int], int] = {}  # (item, diagonal) to the end in doc of what was looked at
            for p, k, q in sketch.hits(doc):
                if k in out or done.get((k, p - q), -1) >= p:
                    continue
                ok, end = self._verify(doc, p, self.words[k], q, sketch.size)
                done[k, p - q] = end
                if ok:
                    out.add(k)
        return out

    def _verify(self, doc: np.ndarray, p: int, item: np.ndarray, q: int, size: int) -> tuple[bool, int]:
        """Whether enough words of item around the seed stand in doc in a row; the end in doc of the seed's run."""
        d, w = doc, item
        n, m = len(d), len(w)
        i, j = p + size, q + size
        if not np.array_equal(d[p:i], w[q:j]):
            return False, p
        while i < n and j < m and d[i] == w[j]:
            i, j = i + 1, j + 1
        end = i - size
        need = min(self.least, m)
        right = self._extend(d[i : i + m + 16].tolist(), w[j:].tolist())
        a, b = p, q
        while a and b and d[a - 1] == w[b - 1]:
            a, b = a - 1, b - 1
        left = self._extend(d[max(0, a - m - 16) : a][::-1].tolist(), w[:b][::-1].tolist())
        steps = left[::-1] + [1] * (i - a) + right
        # steps: 1 a word that stands there, 0 a word of the item changed or left out, -1 a word put in.
        if m < self.least:  # an item that counts as a whole only: what its ends lack is changed or left out
            errors = m - sum(s == 1 for s in steps) + sum(s == -1 for s in steps)
            return errors * self.one_in <= m, end
        # A part counts when it begins and ends with words that stand there and 8 times its errors are no more than its words.
        length = errors = 0
        before: list[tuple[int, int]] = []  # (words so far, balance) at each place where a part may begin
        least_balance: list[int] = []
        for s in steps:
            if s == 1:
                balance = length - self.one_in * errors
                before.append((length, balance))
                least_balance.append(min(balance, least_balance[-1]) if least_balance else balance)
                length += 1
                k = len(before) - 1
                while k >= 0 and length - before[k][0] < need:
                    k -= 1
                if k >= 0 and least_balance[k] <= length - self.one_in * errors:
                    return True, end
            else:
                errors += 1
                length += s == 0
        return False, end

    def _extend(self, d: list[int], w: list[int]) -> list[int]:
        """Steps along doc and item from a seed outwards, through single changed, missing and added words."""
        out: list[int] = []
        i = j = errors = 0
        while i < len(d) and j < len(w):
            if d[i] == w[j]:
                out.append(1)
                i, j = i + 1, j + 1
                continue
            errors += 1
            if errors > 2 + len(w) // self.one_in:
                break
            now, then = w[j : j + 2], w[j + 1 : j + 3]  # at the item's end fewer than two words must do
            change, added, missing = d[i + 1 : i + 1 + len(then)] == then, d[i + 1 : i + 1 + len(now)] == now, bool(then) and d[i : i + len(then)] == then
            if change or not (added or missing):
                out.append(0)
                i, j = i + 1, j + 1
            elif added:
                out.append(-1)
                i += 1
            else:
                out.append(0)
                j += 1
            if len(out) > 4 and not any(x == 1 for x in out[-4:]):
                break
        while out and out[-1] != 1:
            out.pop()
        return out


_FOUND = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64())])


def _scan(shared, least_words: int, one_in: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.built(lambda block: Index(block, least_words, one_in))
        look = index.vocabulary.__getitem__
        for batch in batches:
            docs, items = [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.fromiter(map(look, words(text)), dtype=np.int64)
                for k in index.found(ids):
                    docs.append(doc_id)
                    items.append(index.ids[k])
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(items, pa.int64())], schema=_FOUND)

    return run


#: Items whose sketches a worker holds at once; more items are searched for in further blocks.
BLOCK_ITEMS = 20_000


def leaked_items(docs: DataFrame, items: DataFrame, least_words: int = 15, one_in: int = 8, block: int = BLOCK_ITEMS) -> DataFrame:
    """(doc_id, item_id): the documents that hold an item wholly or at least least_words of its words in a row.

    Up to one word in `one_in` may be changed, left out or put in within that part.
    Letter case, punctuation, markup, layout, invisible and look-alike characters do
    not matter. Items of fewer words than least_words count only as a whole. Null and
    empty texts on either side, and items without a word, give no row. Repeated rows
    give one. Documents are neither moved nor cut; of the items, `block` are broadcast at
    a time, and each block is searched for in all documents.
    """
    rows = docs.select(F.col("doc_id").cast("bigint"), "text").where("text is not null")
    query = items.select("item_id", "text").where("item_id is not null and text is not null").distinct().orderBy("item_id", "text").toLocalIterator()
    return in_blocks(((r.item_id, r.text) for r in query), block, docs.sparkSession, lambda shared: rows.mapInArrow(_scan(shared, least_words, one_in), "doc_id bigint, item_id bigint")).distinct()


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, item_id) of every leaked item; see leaked_items()."""
    return leaked_items(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "eval_items", "item_id", "text"))


def p9_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(benchmark_name, n_items, n_leaked, n_documents): how far each benchmark has leaked."""
    items = table(spark, sf_dir, "eval_items", "item_id", "benchmark_name")
    found = p9_found(spark, sf_dir)
    return items.distinct().join(found, "item_id", "left").groupBy("benchmark_name").agg(F.countDistinct("item_id").alias("n_items"), F.countDistinct(F.when(F.col("doc_id").isNotNull(), F.col("item_id"))).alias("n_leaked"), F.countDistinct("doc_id").alias("n_documents"))
