"""What all sources share: reading JSON lines and the shape of a parsed work."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioflow.functions import identifiers as ids
from folioflow.functions.text import none_if_empty, strip

AUTHOR = "struct<raw_name:string,position:int,orcid:string,source_author_id:string,raw_affiliation:string,institution_name:string,institution_ror:string,institution_country:string,is_corresponding:boolean>"
CITATION = "struct<cited_doi:string,cited_arxiv_id:string,cited_source_id:string,raw_citation_string:string,is_influential:boolean,citation_intents:array<string>>"
WORK = f"struct<source_name:string,source_work_id:string,title:string,abstract:string,publication_year:int,publication_date:date,normalized_doi:string,normalized_arxiv_id:string,raw_venue_name:string,venue_issn:string,venue_type:string,citation_count:int,influential_citation_count:int,authors:array<{AUTHOR}>,citations:array<{CITATION}>,external_ids:array<struct<type:string,value:string>>>"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line_idx, line) of a text file or folder: non-blank lines, stripped, numbered from 0 over all lines.

    Numbers follow the names of the files and the places in them, however Spark splits or packs them.

    A path that does not exist raises FileNotFoundError before anything is read.
    Lines end at \\n, \\r or \\r\\n only, so other separators may stand inside JSON strings.
    """
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        raise FileNotFoundError(path)
    rows = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    # Lines of a split are numbered in order, so the lines before each split make the numbers global.
    splits = rows.groupBy("file", "block").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1))
    splits = splits.select("file", "block", "first", F.coalesce(before, F.lit(0)).alias("before"))
    # One row for each split, a million of them for 128 TB.
    numbered = rows.join(F.broadcast(splits), ["file", "block"]).select((F.col("at") - F.col("first") + F.col("before")).cast("bigint").alias("line_idx"), strip(F.col("value")).alias("line"))
    return numbered.where("line <> ''")


def field(v: Column, path: str, kind: str = "string") -> Column:
    """A field of a variant, null when it is absent, null or of another kind."""
    return F.try_variant_get(v, path, kind)


def text(v: Column, path: str) -> Column:
    """A text field with "" read as null."""
    return none_if_empty(field(v, path))


def items(v: Column, path: str) -> Column:
    """A list of variants; empty when it is none."""
    return F.coalesce(field(v, path, "array<variant>"), F.array().cast("array<variant>"))


def kind(v: Column, path: str) -> Column:
    """The JSON kind of a field: STRING, BIGINT, OBJECT<..>, ARRAY<..>, BOOLEAN, VOID for null; null when absent."""
    return F.schema_of_variant(field(v, path, "variant"))


def wrong_kind(v: Column, path: str, *allowed: str) -> Column:
    """Whether a field is there, not null, and of none of the kinds allowed."""
    k = F.coalesce(kind(v, path), F.lit("VOID"))
    return reduce(lambda a, b: a & b, [~k.startswith(x) for x in ("VOID", *allowed)])


def count(v: Column, path: str) -> Column:
    """A number of 0 for absent, null and unreadable."""
    return F.coalesce(F.try_variant_get(v, path, "double").cast("int"), F.lit(0))


def strict_date(c: Column) -> Column:
    """A date written as year-month-day and nothing else; null for others."""
    return F.try_to_date(F.when(c.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"), c), "yyyy-M-d")


def dated(v: Column, year_path: str, date_path: str) -> tuple[Column, Column]:
    """(date, year): the year as given, else that of the date."""
    date = strict_date(text(v, date_path))
    year = F.try_variant_get(v, year_path, "int")
    return date, F.when(year != 0, year).otherwise(F.coalesce(F.year(date), year))


def author(name: Column, position: Column, orcid: Column | None = None, source_id: Column | None = None, affiliation: Column | None = None, inst_name: Column | None = None, inst_ror: Column | None = None, inst_country: Column | None = None) -> Column:
    none = F.lit(None).cast("string")
    pick = lambda c: none if c is None else c.cast("string")
    return F.struct(name.alias("raw_name"), position.cast("int").alias("position"), pick(orcid).alias("orcid"), pick(source_id).alias("source_author_id"), pick(affiliation).alias("raw_affiliation"), pick(inst_name).alias("institution_name"), pick(inst_ror).alias("institution_ror"), pick(inst_country).alias("institution_country"), F.lit(False).alias("is_corresponding"))


def citation(doi: Column | None = None, source_id: Column | None = None, raw: Column | None = None, influential: Column | None = None, intents: Column | None = None) -> Column:
    none = F.lit(None).cast("string")
    return F.struct((none if doi is None else doi).alias("cited_doi"), none.alias("cited_arxiv_id"), (none if source_id is None else source_id).alias("cited_source_id"), (none if raw is None else raw).alias("raw_citation_string"), (F.lit(False) if influential is None else influential).alias("is_influential"), (F.array().cast("array<string>") if intents is None else intents).alias("citation_intents"))


def external_ids(*pairs: tuple[str, Column]) -> Column:
    """The ids that are there, in this order."""
    every = F.array(*[F.struct(F.lit(t).alias("type"), none_if_empty(v.cast("string")).alias("value")) for t, v in pairs])
    return F.filter(every, lambda x: x["value"].isNotNull())


def kept(array: Column, name: str) -> Column:
    """The elements whose field `name` is neither null nor empty."""
    return F.filter(array, lambda x: F.coalesce(x[name] != "", F.lit(False)))


Parser = Callable[[Column], tuple[dict[str, Column], Column]]
_REGISTRY: dict[str, Parser] = {}


def register(name: str) -> Callable[[Parser], Parser]:
    """Register a source: a function from the record (a variant) to the parts of a work and an error (null for none)."""

    def put(parser: Parser) -> Parser:
        _REGISTRY[name] = parser
        return parser

    return put


def parser_of(source: str) -> Parser:
    """The parser of a source, whatever its letter case; ValueError for an unknown one."""
    if source.lower() not in _REGISTRY:
        raise ValueError(f"unknown source {source!r}; known are {', '.join(sorted(_REGISTRY))}")
    return _REGISTRY[source.lower()]


def decoding_error(v: Column) -> tuple[Column, Column]:
    """(error_type, error_message) of a line read as a variant: no JSON, no object, or null for none."""
    is_object = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    return F.when(v.isNull(), "MALFORMED_JSON").when(~is_object, "PARSER_EXCEPTION"), F.when(v.isNull(), "not JSON").when(~is_object, "not a JSON object")


def parse(lines: DataFrame, source: str, line: str = "line") -> DataFrame:
    """lines with `work` (as WORK), `error_type` and `error_message`.

    error_type is MALFORMED_JSON for a line that is no JSON, PARSER_EXCEPTION for JSON
    that is no object or whose fields are of kinds the source can't have, else null;
    work is null where there is an error. Null lines are malformed.
    """
    parts, error = parser_of(source)(F.col("_v"))
    empty = {"normalized_arxiv_id": F.lit(None).cast("string"), "venue_issn": F.lit(None).cast("string"), "influential_citation_count": F.lit(0), "citations": F.array().cast(f"array<{CITATION}>")}
    parts = empty | {"source_name": F.lit(source.lower())} | parts
    order = [f.split(":")[0] for f in ("source_name", "source_work_id", "title", "abstract", "publication_year", "publication_date", "normalized_doi", "normalized_arxiv_id", "raw_venue_name", "venue_issn", "venue_type", "citation_count", "influential_citation_count", "authors", "citations", "external_ids")]
    work = F.struct(*[parts[k].alias(k) for k in order]).cast(WORK)
    kind_, said = decoding_error(F.col("_v"))
    kind_, said = F.coalesce(kind_, F.when(error.isNotNull(), "PARSER_EXCEPTION")), F.coalesce(said, error)
    return lines.withColumn("_v", F.try_parse_json(line)).withColumn("error_type", kind_).withColumn("error_message", F.when(F.col("error_type").isNotNull(), said)).withColumn("work", F.when(F.col("error_type").isNull(), work)).drop("_v")


__all__ = ["ids", "parse", "parser_of", "read_lines", "register"]
