"""Encoding whole corpora with a public byte-level BPE tokenizer, and cutting texts to token limits."""

from __future__ import annotations

import base64
import importlib.util
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.operators.common import BROADCAST_BYTES, disk_bytes, hot_keys, spread_join, table, written

#: Fixed value: the word pattern of byte_bpe_50k.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def vocabulary_path(name: str = "byte_bpe_50k.tiktoken", folder: str | None = None) -> str:
    """Where a vocabulary lies: in folder, else in $TOKENIZER_DIR, else in the installed package."""
    folder = folder or os.environ.get("TOKENIZER_DIR")
    if folder is None:
        spec = importlib.util.find_spec("public_tokenizers")
        folder = os.path.dirname(spec.origin) if spec else "/opt/tokenizers"
    return os.path.join(folder, name)


@lru_cache(maxsize=4)
def encoder(path: str):
    """The tokenizer of a vocabulary file, once per process."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=4)
def token_lengths(path: str) -> np.ndarray:
    """The number of bytes of each token id."""
    enc = encoder(path)
    out = np.zeros(enc.n_vocab + 1, dtype=np.int64)
    for i in range(enc.n_vocab):
        try:
            out[i] = len(enc.decode_single_token_bytes(i))
        except KeyError:  # an id that is free
            pass
    return out


# --- content-defined chunks -------------------------------------------------------------

WINDOW = 16  # code points that the rolling hash sees
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _BASE, dtype=np.uint64), np.full(n, _INVERSE, dtype=np.uint64)
    up[0] = down[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(up), np.multiply.accumulate(down)


def chunk_ends(text: str, least: int, mean: int, most: int) -> list[tuple[int, bool]]:
    """Ends of the content-defined chunks of text, each with whether the cut is sure.

    A sure cut lies before a single blank between two other characters, where the
    word pattern always begins a new word; there the two sides encode on their own.
    It is taken where the rolling hash of the WINDOW code points before it is 0
    modulo the mean number of such places. A text without one for `most` code
    points gets a hard cut, to be repaired later.
    """
    n = len(text)
    if n <= least:
        return [(n, True)]
    x = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    space = (x == 32) | ((x >= 9) & (x <= 13)) | ((x >= 28) & (x <= 31)) | (x == 0x85) | (x == 0xA0) | ((x >= 0x1680) & ((x == 0x1680) | ((x >= 0x2000) & (x <= 0x200A)) | (x == 0x2028) | (x == 0x2029) | (x == 0x202F) | (x == 0x205F) | (x == 0x3000)))
    at = np.flatnonzero((x[1:-1] == 32) & ~space[:-2] & ~space[2:]) + 1
    sure = at[at >= WINDOW]
    up, down = _powers(1 << max(12, (n + 1).bit_length()))
    with np.errstate(over="ignore"):
        prefix = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(x.astype(np.uint64) * up[:n], out=prefix[1:])
        rolled = (prefix[sure] - prefix[sure - WINDOW]) * down[sure - WINDOW]
    mixed = rolled ^ (rolled >> np.uint64(29))
    chosen = sure[(mixed * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(40)) % np.uint64(max(1, mean // 6)) == 0]
    out: list[tuple[int, bool]] = []
    start, i, j = 0, 0, 0
    while n - start > most or i < len(chosen):
        i = int(np.searchsorted(chosen, start + least, side="left"))
        if i < len(chosen) and chosen[i] - start <= most:
            start = int(chosen[i])
            out.append((start, True))
        elif n - start <= most:
            break
        else:  # no chosen place in reach: the last sure one, else a hard cut
            j = int(np.searchsorted(at, start + most, side="right")) - 1
            ok = j >= 0 and at[j] > start
            start = int(at[j]) if ok else start + most
            out.append((start, ok))
    if start < n:
        out.append((n, True))
    return out


#: cut: 1 when a chunk starts at a hard cut, 2 when it ends in one, 3 for both. text: of the first of equal chunks in a task, and where cut is not 0.
_CHUNK = pa.schema([("uid", pa.int64()), ("doc_id", pa.int64()), ("seq", pa.int32()), ("cut", pa.int8()), ("h", pa.binary()), ("size", pa.int32()), ("text", pa.string())])
_CODES = pa.schema([("h", pa.binary()), ("ids", pa.binary())])
_DOC = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])
_BATCH_BYTES = 4 << 20
#: Hashes of chunks that a task remembers to send each text once; beyond, it forgets and sends some again.
_KNOWN = 1 << 20


def _batch(schema: pa.Schema, columns: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _chunk(least: int, mean: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[bytes] = set()
        for batch in batches:
            columns: list[list] = [[] for _ in _CHUNK]
            size = 0
            for uid, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                text = text or ""
                start, before = 0, 0
                for seq, (end, sure) in enumerate(chunk_ends(text, least, mean, most)):
                    piece = text[start:end]
                    h, cut = xxhash.xxh3_128_digest(piece.encode("utf-8")), before | (0 if sure else 2)
                    kept = piece if cut or h not in sent else None
                    if len(sent) > _KNOWN:
                        sent.clear()
                    sent.add(h)
                    for c, v in zip(columns, (uid, doc_id, seq, cut, h, len(piece), kept)):
                        c.append(v)
                    start, before, size = end, 0 if sure else 1, size + len(kept or "")
                if size > _BATCH_BYTES:
                    yield _batch(_CHUNK, columns)
                    columns, size = [[] for _ in _CHUNK], 0
            if columns[0]:
                yield _batch(_CHUNK, columns)

    return run


def _encode(path: str):
    """(h, text) sorted by h into (h, ids), each h once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        kind = np.uint16 if enc.n_vocab <= 1 << 16 else np.uint32
        last = None
        for batch in batches:
            hashes, ids = [], []
            for h, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if h != last:
                    hashes.append(h)
                    ids.append(np.array(enc.encode_ordinary(t), dtype=kind).tobytes())
                    last = h
            yield _batch(_CODES, [hashes, ids])

    return run


_SURE = re.compile(r"(?<=\S) (?=\S)")


def joined(enc, parts: list[tuple[np.ndarray, int, str | None]]) -> np.ndarray:
    """The ids of a whole text from its chunks in order: (ids, cut, text where cut is not 0).

    At a sure cut ids are joined as they are. Over hard cuts they may differ from
    those of the whole text: there the span from the last sure place before to the
    first one behind, with every chunk between, is encoded again, which is where both
    sides agree with the encoding of the whole.
    """
    out: list[np.ndarray] = []
    i = 0
    while i < len(parts):
        ids, cut, text = parts[i]
        if not cut & 2:
            out.append(ids)
            i += 1
            continue
        sure = [m.start() for m in _SURE.finditer(text)]
        tail = text[sure[-1] if sure else 0 :]
        out.append(ids[: len(ids) - len(enc.encode_ordinary(tail))])
        span = [tail]
        while True:
            i += 1
            ids, cut, text = parts[i]
            place = _SURE.search(text)
            if not place and cut & 2:
                span.append(text)
                continue
            head = text[: place.start()] if place else text
            span.append(head)
            out.append(np.array(enc.encode_ordinary("".join(span)), dtype=ids.dtype))
            rest = ids[len(enc.encode_ordinary(head)) :] if place else ids[:0]
            parts[i] = (rest, cut & 2, text[place.start() :] if place else "")
            break
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint16)


def _assemble(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        kind = np.uint16 if enc.n_vocab <= 1 << 16 else np.uint32
        now, doc, parts = None, None, []
        docs: list = []
        ids: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            offsets = np.zeros(len(ids) + 1, dtype=np.int32)
            np.cumsum([len(x) for x in ids], out=offsets[1:])
            values = np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, dtype=np.int32)
            return pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))], schema=_DOC)

        for batch in batches:
            for uid, doc_id, cut, raw, text in zip(*(c.to_pylist() for c in batch.columns)):
                if uid != now and now is not None:
                    docs.append(doc)
                    ids.append(joined(enc, parts))
                    size += len(ids[-1])
                    parts = []
                    if size > _BATCH_BYTES // 4:
                        yield flush()
                        docs, ids, size = [], [], 0
                now, doc = uid, doc_id
                parts.append((np.frombuffer(raw, dtype=kind), cut, text))
        if now is not None:
            docs.append(doc)
            ids.append(joined(enc, parts))
            yield flush()

    return run


def encode_corpus(docs: DataFrame, path: str | None = None, least: int = 256, mean: int = 1024, most: int = 8192, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids) of every row of docs: its text's token ids without special tokens.

    Texts are cut into content-defined chunks of about `mean` characters, told by hashes
    of 128 bits. Of equal chunks a task sends the text once, each distinct chunk of the
    corpus is encoded once, and its ids (of two bytes each) go back to all its places;
    chunks with many places are joined by broadcast. Each document is then put together
    from its chunks in order and hard cuts are repaired by encoding the span around them
    again, so the result is exactly that of encoding the whole text.

    Null and empty texts give an empty list. Special-token strings in a text are
    ordinary text. Every row gives a row, repeated rows included; an empty table
    gives none. Extra columns are not read.
    """
    path = path or vocabulary_path()
    chunks = written(corpus_chunks(docs, least, mean, most, key, text), "chunks")
    codes = written(chunks.where("text is not null").select("h", "text").repartition("h").sortWithinPartitions("h").mapInArrow(_encode(path), "h binary, ids binary"), "codes")
    places = chunks.select("uid", "doc_id", "seq", "cut", "h", F.when(F.col("cut") != 0, F.col("text")).alias("text"))
    encoded = spread_join(places, codes, "h", hot_keys(places, "h", chunks.count()))
    whole = encoded.select("uid", "doc_id", "seq", "cut", "ids", "text").repartition("uid").sortWithinPartitions("uid", "seq").select("uid", "doc_id", "cut", "ids", "text")
    return whole.mapInArrow(_assemble(path), "doc_id bigint, ids array<int>")


def corpus_chunks(docs: DataFrame, least: int = 256, mean: int = 1024, most: int = 8192, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(uid, doc_id, seq, cut, h, size, text): the content-defined chunks of every row, in order; see encode_corpus()."""
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(_chunk(least, mean, most), "uid bigint, doc_id bigint, seq int, cut byte, h binary, size int, text string")


def p8_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(n_chunks, n_distinct, n_chars, n_encoded): chunks and characters of all documents, and how many of them are encoded."""
    each = corpus_chunks(table(spark, sf_dir, "documents", "doc_id", "text")).groupBy("h").agg(F.count("*").alias("n"), F.max("size").alias("size"))
    return each.agg(F.sum("n").alias("n_chunks"), F.count("*").alias("n_distinct"), F.sum(F.col("n") * F.col("size")).alias("n_chars"), F.sum("size").cast("bigint").alias("n_encoded"))


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, ids) of every document by byte_bpe_50k; see encode_corpus()."""
    return encode_corpus(table(spark, sf_dir, "documents", "doc_id", "text"))


# --- pieces within a token limit --------------------------------------------------------

_WHITE = np.zeros(256, dtype=bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_STOPS = np.zeros(256, dtype=bool)
_STOPS[[ord("."), ord("!"), ord("?")]] = True
_CLOSERS = np.zeros(256, dtype=bool)
_CLOSERS[[ord('"'), ord("'"), ord(")"), ord("]")]] = True
#: Fixed value: the ideographic full stop in UTF-8.
_FULL_STOP = (0xE3, 0x80, 0x82)
KINDS = ("paragraph", "line", "sentence", "word", "hard")


def natural_boundaries(raw: np.ndarray) -> list[np.ndarray]:
    """Byte places in UTF-8 text where it may be cut, for paragraph, line, sentence and word; each holds the ones before.

    A place lies before a run of white space that follows something else. It ends a
    paragraph when the run has two line ends or more, a line when it has one, a
    sentence when a stop, also with closing marks, stands before it.
    """
    if len(raw) < 2:
        return [np.zeros(0, dtype=np.int64)] * 4
    white = _WHITE[raw]
    starts = np.flatnonzero(white[1:] & ~white[:-1]) + 1
    ends = np.flatnonzero(~white[1:] & white[:-1]) + 1
    ends = ends[np.searchsorted(ends, starts[0], side="right") :] if len(starts) else ends
    if len(ends) < len(starts):
        ends = np.append(ends, len(raw))
    newlines = np.concatenate(([0], np.cumsum(raw == 10)))
    n = newlines[ends] - newlines[starts]
    last = raw[starts - 1]
    stop = _STOPS[last] | (_CLOSERS[last] & (starts > 1) & _STOPS[raw[starts - 2]])
    cjk = np.flatnonzero((raw[:-2] == _FULL_STOP[0]) & (raw[1:-1] == _FULL_STOP[1]) & (raw[2:] == _FULL_STOP[2])) + 3 if len(raw) > 2 else np.zeros(0, dtype=np.int64)
    paragraph = starts[n >= 2]
    line = starts[n >= 1]
    sentence = np.union1d(starts[(n >= 1) | stop], cjk[cjk < len(raw)])
    return [paragraph, line, sentence, np.union1d(starts, sentence)]


def cut_places(enc, lengths: np.ndarray, text: str, most: int, overlap: int, filled: float = 0.5) -> list[tuple[int, int, int, int, int, str]]:
    """The pieces of text as (start byte, end byte, start token, end token, tokens, kind of the cut at the end).

    Token offsets are the prefix sums of the tokens' byte lengths. From each start the
    last boundary within the limit is found by binary search in the sorted boundaries
    of each kind, from paragraph to word; a coarser kind is taken while the piece is
    filled to `filled`; without any boundary the text is cut hard between two whole
    characters. The next piece starts `overlap` tokens before the cut, further back
    only where that place is inside a character. Tokens are counted as in the piece
    encoded on its own.
    """
    data = text.encode("utf-8")
    ids = np.array(enc.encode_ordinary(text), dtype=np.int64)
    total = len(ids)
    if total <= most:
        return [(0, len(data), 0, total, total, "end")] if total else []
    overlap = max(0, min(overlap, most - 1))
    raw = np.frombuffer(data, dtype=np.uint8)
    offset = np.concatenate(([0], np.cumsum(lengths[ids])))
    whole = np.ones(total + 1, dtype=bool)
    whole[:-1] = (raw[offset[:-1]] & 0xC0) != 0x80  # token offsets that are between two characters
    kinds = []
    for places in natural_boundaries(raw):
        t = np.searchsorted(offset, places)
        kinds.append(t[(t <= total) & (offset[np.minimum(t, total)] == places)])
    sure = kinds[3]

    def alone(s: int, e: int) -> int:
        """Tokens of the span s to e encoded on its own: only its ends can differ from the whole."""
        i, j = np.searchsorted(sure, s), np.searchsorted(sure, e, side="right") - 1
        if i > j or j < 0:
            return len(enc.encode_ordinary(data[offset[s] : offset[e]].decode("utf-8")))
        a, b = int(sure[i]), int(sure[j])
        n = b - a
        if a > s:
            n += len(enc.encode_ordinary(data[offset[s] : offset[a]].decode("utf-8")))
        if e > b:
            n += e - b if e == total else len(enc.encode_ordinary(data[offset[b] : offset[e]].decode("utf-8")))
        return n

    out = []
    s = 0
    while True:
        if total - s <= most and alone(s, total) <= most:
            out.append((int(offset[s]), len(data), s, total, alone(s, total), "end"))
            return out
        top = min(total, s + most)
        least = s + overlap  # a cut must lie behind it, else the next piece wouldn't start later
        while True:
            end, kind = -1, "hard"
            for k, places in enumerate(kinds):
                i = int(np.searchsorted(places, top, side="right")) - 1
                floor = least if k == 3 else max(least, s + int(most * filled))
                if i >= 0 and places[i] > floor:
                    end, kind = int(places[i]), KINDS[k]
                    break
            if end < 0:
                end = top
                while not whole[end] and end > s:
                    end -= 1
                if end <= s:  # not even one character within the limit
                    end = top + 1
                    while not whole[end]:
                        end += 1
                    break
            if (n := alone(s, end)) <= most or end <= s + 1:
                break
            top = min(end, top) - max(1, n - most)
            if top <= s:
                top = s + 1
        out.append((int(offset[s]), int(offset[end]), s, end, alone(s, end), kind))
        if end >= total:
            return out
        back = end - overlap
        while back > s and not whole[back]:
            back -= 1
        s = back if back > s else end


_PIECES = pa.schema([("doc_id", pa.int64()), ("piece_no", pa.int32()), ("n_pieces", pa.int32()), ("start_char", pa.int64()), ("end_char", pa.int64()), ("start_token", pa.int64()), ("end_token", pa.int64()), ("n_tokens", pa.int32()), ("over", pa.bool_()), ("cut", pa.string()), ("text", pa.string())])


def _split(path: str, filled: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, lengths = encoder(path), token_lengths(path)
        columns: list[list] = [[] for _ in _PIECES]
        size = 0
        for batch in batches:
            for doc_id, text, most, overlap in zip(*(c.to_pylist() for c in batch.columns)):
                places = cut_places(enc, lengths, text, most, overlap or 0, filled)
                if len(places) < 2:
                    continue
                data = text.encode("utf-8")
                chars = None if len(data) == len(text) else np.concatenate(([0], np.cumsum((np.frombuffer(data, dtype=np.uint8) & 0xC0) != 0x80)))
                for no, (a, b, s, e, n, kind) in enumerate(places, 1):
                    x, y = (a, b) if chars is None else (int(chars[a]), int(chars[b]))
                    for c, v in zip(columns, (doc_id, no, len(places), x, y, s, e, n, n > most, kind, text[x:y])):
                        c.append(v)
                    size += b - a
            if size > _BATCH_BYTES:
                yield _batch(_PIECES, columns)
                columns, size = [[] for _ in _PIECES], 0
        if columns[0]:
            yield _batch(_PIECES, columns)

    return run


def split_oversized(docs: DataFrame, limits: DataFrame, path: str | None = None, filled: float = 0.5) -> DataFrame:
    """The pieces of every text longer than the max_tokens of its source; see cut_places().

    Columns doc_id, piece_no (from 1), n_pieces, start_char, end_char, start_token,
    end_token, n_tokens, over, cut (paragraph, line, sentence, word, hard, or end for the
    last piece) and text. over is true for the pieces above the limit, which only a limit
    below the tokens of a single character can force. Texts within the limit, null and empty texts give no row,
    nor do documents whose source is null or has no positive limit. A null overlap is
    0, an overlap of the limit or more is the limit less one. A source listed twice
    takes its smallest limit. Repeated rows give their pieces again. No row is moved:
    the limits are broadcast if their files are small, and texts stay where they are read.
    """
    path = path or vocabulary_path()
    one = limits.where("source is not null and max_tokens > 0").groupBy("source").agg(F.min(F.struct("max_tokens", "overlap_tokens")).alias("x")).select("source", "x.*")
    if disk_bytes(limits) <= BROADCAST_BYTES:
        one = F.broadcast(one)
    # A text has at most as many tokens as bytes, so shorter ones need no encoding.
    long = docs.select("doc_id", "text", "source").join(one, "source").where("octet_length(text) > max_tokens")
    return long.select(F.col("doc_id").cast("bigint"), "text", "max_tokens", "overlap_tokens").mapInArrow(_split(path, filled), "doc_id bigint, piece_no int, n_pieces int, start_char bigint, end_char bigint, start_token bigint, end_token bigint, n_tokens int, over boolean, cut string, text string")


def p10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of documents longer than the limit of their source in chunk_limits; see split_oversized()."""
    return split_oversized(table(spark, sf_dir, "documents", "doc_id", "text", "source"), table(spark, sf_dir, "chunk_limits"))
