"""Deeply nested records as related flat tables, by Merkle subtree identities.

Every JSON payload is canonicalised and hashed bottom-up: the hash of a scalar
covers its type and literal, that of an object its sorted (key, child hash)
pairs, that of an array its child hashes in order. Identical subtrees have one
hash and are stored once (``objects``); the links from each of them to its
children, with key or ordinal, are stored once too (``bridges``). Together with
the root of each record (``roots``) they keep every occurrence: fields come out
flat by walking from the roots over the bridges.
"""

from __future__ import annotations

import hashlib
import json
import sys
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.functions.text import strip
from folioflow.operators.common import table, written

#: tag: o an object (hash, kind, literal, n places), b a bridge (parent, key or ordinal, hash), r a root (record_no, hash), x a record that is none (record_no, kind tells why).
_ROWS = "tag string, record_no bigint, parent string, key string, ordinal bigint, hash string, kind string, literal string, n bigint"
_ARROW = pa.schema([("tag", pa.string()), ("record_no", pa.int64()), ("parent", pa.string()), ("key", pa.string()), ("ordinal", pa.int64()), ("hash", pa.string()), ("kind", pa.string()), ("literal", pa.string()), ("n", pa.int64())])


class _Number(str):
    """A number kept as the literal it was written with, which is part of its identity: values come out as received."""


def _constant(x: str):
    raise ValueError(x)


def parse(payload: str | None):
    """The payload as Python values with numbers as written, or why there are none: "unreadable" (also for being nested
    deeper than the parser goes) or "no object"."""
    try:
        value = json.loads(payload, parse_int=_Number, parse_float=_Number, parse_constant=_constant)
    except (ValueError, TypeError, RecursionError, MemoryError):
        return "unreadable"
    return value if isinstance(value, dict) else "no object"


def _hash(kind: str, *parts: str) -> str:
    """The hash of parts, each with its length before it, so that no two lists of parts run together."""
    out = hashlib.blake2b(kind.encode(), digest_size=16)
    for p in parts:
        raw = p.encode("utf-8", "surrogatepass")
        out.update(b"%d:" % len(raw))
        out.update(raw)
    return out.hexdigest()


def merkle(value, seen: dict) -> str:
    """The hash of value; seen gets for each distinct subtree [kind, literal, children as (key, ordinal, hash), places]."""
    literal, children = None, ()
    if isinstance(value, dict):
        kind = "object"
        children = [(k, 0, merkle(value[k], seen)) for k in sorted(value)]
        h = _hash("o", *(x for k, _, c in children for x in (k, c)))
    elif isinstance(value, list):
        kind = "array"
        children = [(None, i, merkle(x, seen)) for i, x in enumerate(value, 1)]
        h = _hash("a", *(c for _, _, c in children))
    else:
        if value is None:
            kind = "null"
        elif value is True or value is False:
            kind, literal = "boolean", "true" if value else "false"
        elif isinstance(value, _Number):
            kind, literal = "number", str(value)
        else:
            kind, literal = "string", value
        h = _hash(kind, literal or "")
    known = seen.get(h)
    if known is None:
        seen[h] = [kind, literal, children, 1]
    else:
        known[3] += 1
    return h


def _no_surrogates(s: str | None) -> str | None:
    return s if s is None or s.isascii() else s.encode("utf-8", "replace").decode("utf-8")


#: Distinct subtrees that a task holds before it puts them out.
_HELD = 20_000


def _flatten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 100_000))
    seen: dict = {}
    of_records: list[tuple] = []

    def put_out() -> pa.RecordBatch:
        rows = list(of_records)
        for h, (kind, literal, children, n) in seen.items():
            rows.append(("o", None, None, None, None, h, kind, _no_surrogates(literal), n))
            rows += [("b", None, h, _no_surrogates(k), i, c, None, None, None) for k, i, c in children]
        seen.clear()
        of_records.clear()
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_ARROW)], schema=_ARROW)

    for batch in batches:
        for no, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            value = parse(payload)
            if isinstance(value, str):
                of_records.append(("x", no, None, None, None, None, value, None, None))
            else:
                of_records.append(("r", no, None, None, None, merkle(value, seen), None, None, None))
            if len(seen) > _HELD or len(of_records) > _HELD:
                yield put_out()
    if seen or of_records:
        yield put_out()


class Subtrees(NamedTuple):
    """What records consist of, each distinct subtree and link once.

    objects (hash, kind, literal, n_places), bridges (parent, key, ordinal, hash) with the
    key of an object's child (ordinal 0) or the 1-based ordinal of an array's, roots
    (record_no, hash) and rejects (record_no, reason) for payloads that are null,
    unreadable or no JSON object.
    """

    objects: DataFrame
    bridges: DataFrame
    roots: DataFrame
    rejects: DataFrame


def subtrees(records: DataFrame, number: str = "record_no", payload: str = "payload") -> Subtrees:
    """The distinct subtrees of all payloads and their links; see Subtrees.

    Equal subtrees of a task leave it once. Redelivered records keep a root under each
    number. Extra columns of records are not read; an empty table gives empty tables.
    """
    nodes = written(records.select(F.col(number).cast("bigint"), F.col(payload)).mapInArrow(_flatten, _ROWS), "nodes")
    of = lambda tag: nodes.where(F.col("tag") == tag)
    objects = of("o").groupBy("hash").agg(F.first("kind").alias("kind"), F.first("literal").alias("literal"), F.sum("n").alias("n_places"))
    bridges = of("b").select("parent", "key", "ordinal", "hash").distinct()
    return Subtrees(written(objects, "objects"), written(bridges, "bridges"), of("r").select("record_no", "hash").distinct(), of("x").select("record_no", F.col("kind").alias("reason")).distinct())


def members(trees: Subtrees, field: str, steps: list[str], listed: list[bool]) -> DataFrame:
    """The scalars below a path of keys, with 1-based places of the lists on the way.

    listed tells for each step whether a list is usual there; a single value in its
    place counts as a list of one. Null and blank values give no row. Places are
    (parent_pos, child_pos), child_pos 0 where only one list is usual. Equal records are
    walked once, and the occurrences are restored from the bridges at the end.
    """
    at = trees.roots.select(F.col("hash").alias("root"), "hash").distinct()
    by_key = trees.bridges.where("ordinal = 0").select("key", F.col("parent").alias("hash"), F.col("hash").alias("to"))
    by_place = trees.bridges.where("ordinal > 0").select("ordinal", F.col("parent").alias("hash"), F.col("hash").alias("to"))
    places: list[str] = []
    for step, many in zip(steps, listed):
        at = at.join(by_key.where(F.col("key") == step).select("hash", "to"), "hash").select("root", F.col("to").alias("hash"), *places)
        if many:
            pos = f"_pos{len(places)}"
            at = at.join(by_place, "hash", "left").select("root", F.coalesce("to", "hash").alias("hash"), *places, F.coalesce("ordinal", F.lit(1)).cast("bigint").alias(pos))
            places.append(pos)
    scalars = trees.objects.where(F.col("kind").isin("string", "number", "boolean")).select("hash", strip(F.col("literal")).alias("value")).where("value <> ''")
    found = at.join(scalars, "hash").select(F.col("root").alias("hash"), F.col(places[0]).alias("parent_pos"), (F.col(places[1]) if len(places) > 1 else F.lit(0)).cast("bigint").alias("child_pos"), "value")
    return trees.roots.join(found, "hash").select(F.lit(field).alias("field"), "record_no", "parent_pos", "child_pos", "value")


#: The fields that come out flat: table, keys, where lists are usual.
FIELDS = (
    ("sample_openalex", ["authorships", "author", "id"], [True, False, False]),
    ("sample_semantic_scholar", ["citations", "intents"], [True, True]),
    ("sample_crossref", ["reference", "DOI"], [True, False]),
)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(field, record_no, parent_pos, child_pos, value) of FIELDS."""
    out = None
    for name, steps, listed in FIELDS:
        one = members(subtrees(table(spark, sf_dir, name, "record_no", "payload")), ".".join([name, *steps]), steps, listed)
        out = one if out is None else out.unionByName(one)
    return out.distinct()


def p2_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source, kind, n_objects, n_places): how often identical subtrees are stored and occur."""
    out = None
    for name, _, _ in FIELDS:
        one = subtrees(table(spark, sf_dir, name, "record_no", "payload")).objects.groupBy("kind").agg(F.count("*").alias("n_objects"), F.sum("n_places").alias("n_places")).select(F.lit(name).alias("source"), "kind", "n_objects", "n_places")
        out = one if out is None else out.unionByName(one)
    return out


def p2_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source, record_no, reason) of the payloads that give no rows."""
    out = None
    for name, _, _ in FIELDS:
        one = subtrees(table(spark, sf_dir, name, "record_no", "payload")).rejects.select(F.lit(name).alias("source"), "record_no", "reason")
        out = one if out is None else out.unionByName(one)
    return out


def _list_of(path: str, source: str = "j") -> str:
    """SQL for a JSON list, a lone value as a list of one."""
    x = f"json_extract({source}, '{path}')"
    return f"case json_type({x}) when 'ARRAY' then cast({x} as json[]) when 'NULL' then [] else case when {x} is null then [] else [{x}] end end"


def _p2_sql(table_name: str, parent: str, child: str, many: bool) -> str:
    base = f"select record_no, json(payload) j from {table_name} where json_valid(payload) and json_type(payload) = 'OBJECT'"
    parents = f"select record_no, unnest(l) p, unnest(range(1, len(l) + 1)) parent_pos from (select record_no, {_list_of('$.' + parent)} l from ({base}))"
    if many:
        rows = f"select record_no, parent_pos, unnest(range(1, len(m) + 1)) child_pos, unnest(m) x from (select record_no, parent_pos, {_list_of('$.' + child, 'p')} m from ({parents}) where json_type(p) = 'OBJECT')"
    else:
        rows = f"select record_no, parent_pos, 0 child_pos, json_extract(p, '$.{child}') x from ({parents}) where json_type(p) = 'OBJECT'"
    return f"select distinct '{table_name}.{parent}.{child}' field, record_no, cast(parent_pos as bigint) parent_pos, cast(child_pos as bigint) child_pos, trim(json_extract_string(x, '$')) as value from ({rows}) where json_type(x) not in ('NULL', 'OBJECT', 'ARRAY') and trim(json_extract_string(x, '$')) <> ''"


P2_FOUND_SQL = " union all ".join([_p2_sql("sample_openalex", "authorships", "author.id", False), _p2_sql("sample_semantic_scholar", "citations", "intents", True), _p2_sql("sample_crossref", "reference", "DOI", False)])
P2_REJECTS_SQL = " union all ".join(f"select distinct '{t}' as source, record_no, case when coalesce(json_valid(payload), false) then 'no object' else 'unreadable' end reason from {t} where not case when coalesce(json_valid(payload), false) then json_type(payload) = 'OBJECT' else false end" for t, _, _ in FIELDS)
