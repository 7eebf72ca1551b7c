"""Registered queries of the resolution: all observations as one log, and each gold table with the same rows in DuckDB SQL.

The log has the observations in order of observed_at, with DOIs as keys; SQL can then name
each work without following pointers, by the DOI or the source's id.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.functions import identifiers as ids
from folioflow.functions.text import none_if_empty, strip
from folioflow.operators import quality
from folioflow.operators.common import table
from folioflow.operators.resolve import gold
from folioflow.plans.reference import _UUID, AS_OF, _slug, _strip
from folioflow.sources.records import CITATION, WORK, author, citation


def observed_works(spark: SparkSession, d: str) -> DataFrame:
    """Each distinct observation as a parsed work (work, error_type, error_message) with its place in the log."""
    columns = ("observation_id", "source_name", "source_work_id", "normalized_doi", "title", "abstract", "publication_year", "publication_date", "raw_venue_name", "citation_count", "influential_citation_count", "raw_authors", "raw_citations", "observed_at")
    o = table(spark, d, "source_work_observations", *columns).where("observation_id is not null").distinct()
    none = F.lit(None).cast("string")
    names = F.coalesce(F.from_json("raw_authors", "array<struct<raw_name:string>>"), F.array().cast("array<struct<raw_name:string>>"))
    cited = F.coalesce(F.from_json("raw_citations", "array<struct<cited_doi:string,cited_source_id:string,is_influential:boolean,citation_intents:array<string>>>"), F.array().cast("array<struct<cited_doi:string,cited_source_id:string,is_influential:boolean,citation_intents:array<string>>>"))
    parts = {
        "source_name": F.col("source_name"), "source_work_id": F.coalesce("source_work_id", F.lit("unknown")), "title": F.col("title"), "abstract": F.col("abstract"), "publication_year": F.col("publication_year"), "publication_date": F.col("publication_date"),
        "normalized_doi": F.lower(strip(F.col("normalized_doi"))), "normalized_arxiv_id": none, "raw_venue_name": F.col("raw_venue_name"), "venue_issn": none, "venue_type": none,
        "citation_count": F.coalesce("citation_count", F.lit(0)), "influential_citation_count": F.coalesce("influential_citation_count", F.lit(0)),
        "authors": F.transform(names, lambda a, i: author(a["raw_name"], i + 1)),
        "citations": F.transform(cited, lambda c: citation(doi=ids.doi(c["cited_doi"]), source_id=none_if_empty(c["cited_source_id"]), influential=F.coalesce(c["is_influential"], F.lit(False)), intents=c["citation_intents"])).cast(f"array<{CITATION}>"),
        "external_ids": F.array().cast("array<struct<type:string,value:string>>"),
    }
    at = [F.coalesce(F.unix_micros(F.col("observed_at").cast("timestamp")), F.lit(0)).alias("run_no"), F.conv(F.substring(F.md5("observation_id"), 1, 15), 16, 10).cast("bigint").alias("line_idx")]
    return o.select(*at, F.lit("run").alias("run_id"), "observation_id", F.struct(*[v.alias(k) for k, v in parts.items()]).cast(WORK).alias("work"), none.alias("error_type"), none.alias("error_message"))


def _of(name: str, *columns: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, d: str) -> DataFrame:
        log = quality.check(observed_works(spark, d), AS_OF).where("error_type is null").select("run_no", "run_id", "line_idx", "observation_id", "work")
        return gold(log, F.lit("2026-01-01").cast("timestamp"))[name].selectExpr(*columns)

    query.__doc__ = f"{name} of all observations, resolved."
    return query


def checked_works(spark: SparkSession, d: str) -> DataFrame:
    """What the quality rules make of each observation: (observation_id, error_type, doi, publication_year, n_authors, n_citations, n_warnings)."""
    w = F.col("work")
    done = quality.check(observed_works(spark, d), AS_OF)
    ok = F.col("error_type").isNull()
    return done.select("observation_id", "error_type", F.when(ok, w["normalized_doi"]).alias("doi"), F.when(ok, w["publication_year"]).alias("publication_year"), F.when(ok, F.size(w["authors"])).alias("n_authors"), F.when(ok, F.size(w["citations"])).alias("n_citations"), F.when(ok, F.size("warnings")).alias("n_warnings"))


def authors_explode(spark: SparkSession, d: str) -> DataFrame:
    """(observation_id, author_position, raw_name) of the authors of each observation as parsed."""
    return observed_works(spark, d).select("observation_id", F.explode("work.authors").alias("a")).select("observation_id", F.col("a.position").alias("author_position"), strip(F.col("a.raw_name")).alias("raw_name")).distinct()


def dq_authors(spark: SparkSession, d: str) -> DataFrame:
    """(observation_id, raw_name, position) of the authors that the quality rules keep."""
    return quality.check(observed_works(spark, d), AS_OF).where("error_type is null").select("observation_id", F.explode("work.authors").alias("a")).select("observation_id", "a.raw_name", "a.position").distinct()


QUERIES = {
    "authors_explode": authors_explode,
    "dq_authors": dq_authors,
    "gold_works": _of("canonical_works", "canonical_work_id", "title", "abstract", "publication_year", "publication_date", "canonical_doi", "canonical_venue_id", "is_stub", "stub_reason", "created_from_source", "citation_count", "influential_citation_count"),
    "gold_identifiers": _of("canonical_work_identifiers", "identifier_type", "normalized_value", "canonical_work_id", "raw_value"),
    "gold_venues": _of("canonical_venues", "canonical_venue_id", "name", "normalized_name", "venue_type", "tier", "issn"),
    "gold_authors": _of("canonical_authors", "canonical_author_id", "display_name", "orcid"),
    "gold_work_authors": _of("canonical_work_authors", "canonical_work_id", "canonical_author_id", "author_position", "raw_author_name", "raw_affiliation_string", "is_corresponding"),
    "gold_citations": _of("canonical_citations", "citing_work_id", "cited_work_id", "is_influential", "array_join(citation_intents, ',') intents", "source_provider"),
    "gold_provenance": _of("canonical_work_provenance", "canonical_work_id", "attribute_name", "winning_source", "source_observation_id", "resolution_rule"),
    "gold_metrics": _of("metrics_provenance", "canonical_work_id", "source_provider", "source_observation_id", "metric_name", "metric_value"),
    "checked_works": checked_works,
}


def _minted(kind: str, rows: str, anchor: str, name: str) -> str:
    """SQL for rows with the id minted from an anchor."""
    return f"(select * exclude (h), {_UUID} {name} from (select *, sha1(from_hex('{ids.NAMESPACES[kind].replace('-', '')}') || encode({anchor})) h from {rows}))"


_DOI = r"case when regexp_matches({0}, '^10[.][0-9]{{4,9}}/[^[:space:]]+$') then {0} end"
_BARE = _strip("regexp_replace(regexp_replace(lower(" + _strip("x.c->>'$.cited_doi'") + "), '^https?://(dx[.])?doi[.]org/', ''), '^doi:[[:space:]]*', '')")
_PLACE = "case lower(s) when 'crossref' then 1 when 'openalex' then 2 when 'semantic_scholar' then 3 when 'arxiv' then 4 else 99 end"
_ABSTRACT_PLACE = "case lower(s) when 'semantic_scholar' then 1 when 'arxiv' then 2 when 'openalex' then 3 when 'crossref' then 4 else 99 end"
_BASE = f"""
with recursive o as materialized (
  select distinct observation_id, source_name s, coalesce(source_work_id, 'unknown') swid, normalized_doi, lower({_strip('normalized_doi')}) given, title, abstract, publication_year y0, publication_date d, raw_venue_name, coalesce(citation_count, 0) cc, coalesce(influential_citation_count, 0) ic, raw_authors, raw_citations,
    coalesce(epoch_us(observed_at), 0) r, ('0x' || substr(md5(observation_id), 1, 15))::bigint l from source_work_observations where observation_id is not null
), p as materialized (
  select *, {_DOI.format('given')} doi, case when y0 between 1665 and {AS_OF} + 1 then y0 end y,
    case when length(coalesce(trim(title), '')) < 3 or lower(trim(title)) in ('[untitled]', 'untitled', 'none', 'unknown', 'n/a', 'na', 'null', '') then 'DQ-02_TITLE_INCOMPLETE' end error_type,
    case when json_valid(raw_authors) and json_type(raw_authors) = 'ARRAY' then cast(raw_authors as json[]) else [] end la, case when json_valid(raw_citations) and json_type(raw_citations) = 'ARRAY' then cast(raw_citations as json[]) else [] end lc from o
), a as materialized (select * from {_minted('work', 'p', "coalesce('doi:' || doi, 'cluster:' || s || ':' || swid)", 'id')} where error_type is null),
people0 as (select observation_id, id, r, l, {_strip("x.c->>'$.raw_name'")} n, x.i from (select *, unnest(la) c, unnest(range(1, len(la) + 1)) i from a) x),
people as materialized (select *, row_number() over (partition by observation_id order by i) pos from people0 where n <> ''),
cites0 as (select observation_id, id citing, s, r, l, x.i, doi own, swid, {_DOI.format(_BARE)} cdoi, nullif(x.c->>'$.cited_source_id', '') raw, coalesce(cast(x.c->>'$.is_influential' as boolean), false) infl, x.c->'$.citation_intents' ints from (select *, unnest(lc) c, unnest(range(1, len(lc) + 1)) i from a) x),
cites1 as materialized (select *, case when cdoi is null then lower({_strip('raw')}) end loose from cites0 where not coalesce(cdoi = own, false) and not coalesce(swid <> '' and raw = swid, false)),
cites2 as (select *, first_value(s) over (partition by loose order by r, l, i) fs from cites1 where coalesce(cdoi, loose) is not null),
cites as materialized (select * from {_minted('work', 'cites2', "coalesce('doi:' || cdoi, 'cluster:' || fs || ':' || loose)", 'cited')}),
firsts as materialized (select id, min((r, l)) f from a group by id),
stubs as materialized (select cited id, min((r, l, i)) f, arg_min(s, (r, l, i)) ss, arg_min(coalesce(cdoi, loose), (r, l, i)) v, arg_min(cdoi, (r, l, i)) sdoi from cites group by cited),
k as materialized (select a.*, (a.r, a.l) = firsts.f is_first, stubs.id is not null and (stubs.f[1], stubs.f[2]) < firsts.f after_stub from a join firsts on a.id = firsts.id left join stubs on a.id = stubs.id)
"""


def _won(value: str, gate: str, place: str) -> str:
    return f"select id, s, observation_id, {value} as v, case when not is_first then 'PRIORITY_OVERRIDE' when after_stub then 'STUB_UPGRADE' else 'INITIAL_CREATION' end rule from {{0}} where is_first or {gate} qualify row_number() over (partition by id order by {place}, r desc, l desc) = 1"


_VENUED = "(select * from " + _minted("venue", "(select *, " + _slug("raw_venue_name") + " vs from k)", "case when raw_venue_name <> '' and vs <> '' then 'name:' || vs end", "vid") + ")"
_WINS = f"""
, venued as materialized (select * from {_VENUED}),
title as ({_won('title', "title <> ''", _PLACE).format('k')}), abstract_ as ({_won('abstract', "abstract <> ''", _ABSTRACT_PLACE).format('k')}), year_ as ({_won('y', 'y <> 0', _PLACE).format('k')}), venue as ({_won('vid', 'vid is not null', _PLACE).format('venued')}),
turns as (select *, min({_PLACE}) over (partition by id order by r, l rows between unbounded preceding and 1 preceding) b, {_PLACE} pl from k where is_first or y <> 0),
dated as (select id, arg_max(d, (r, l)) d from turns where (b is null or pl <= b) and d is not null group by id)
"""
SQL = {
    "authors_explode": f"""select distinct observation_id, cast(i as int) author_position, {_strip("cast(raw_authors as json[])[i]->>'$.raw_name'")} raw_name from (select observation_id, raw_authors, unnest(range(1, cast(json_array_length(raw_authors) as int) + 1)) i from source_work_observations where json_valid(raw_authors) and json_type(raw_authors) = 'ARRAY')""",
    "dq_authors": _BASE + "select distinct observation_id, n raw_name, cast(pos as int) as position from people",
    "checked_works": _BASE + """, na as (select observation_id, count(*) n from people group by 1), nc as (select observation_id, count(*) n from cites1 group by 1)
select p.observation_id, p.error_type, case when p.error_type is null then p.doi end doi, case when p.error_type is null then p.y end publication_year, case when p.error_type is null then cast(coalesce(na.n, 0) as int) end n_authors, case when p.error_type is null then cast(coalesce(nc.n, 0) as int) end n_citations,
case when p.error_type is null then cast((p.given is not null and p.doi is null) as int) + cast((p.y0 is not null and p.y is null) as int) + cast(coalesce(nc.n, 0) < len(p.lc) as int) + cast(coalesce(na.n, 0) < len(p.la) as int) end n_warnings
from p left join na using (observation_id) left join nc using (observation_id)""",
    "gold_works": _BASE + _WINS + """, every as (select coalesce(x.id, stubs.id) id, x.id is null is_stub, x.cc, x.ic, x.doi, stubs.* exclude (id), x.f xf from (select k.id, max(cc) cc, max(ic) ic, arg_min(k.doi, (r, l)) filter (where is_first) doi, any_value(firsts.f) f from k join firsts using (id) group by k.id) x full join stubs on x.id = stubs.id)
select e.id canonical_work_id, case when e.is_stub then '[Stub Citation: ' || e.v || ']' else coalesce(title.v, case when e.v is not null and (e.f[1], e.f[2]) < e.xf then '[Stub Citation: ' || e.v || ']' end) end title, abstract_.v abstract, year_.v publication_year, dated.d publication_date, coalesce(e.doi, e.sdoi) canonical_doi, venue.v canonical_venue_id, e.is_stub, case when e.is_stub then 'DANGLING_CITATION_TARGET' end stub_reason,
case when e.is_stub or (e.f[1], e.f[2]) < e.xf then e.ss end created_from_source, coalesce(e.cc, 0) citation_count, coalesce(e.ic, 0) influential_citation_count
from every e left join title on title.id = e.id left join abstract_ on abstract_.id = e.id left join year_ on year_.id = e.id left join venue on venue.id = e.id left join dated on dated.id = e.id""",
    "gold_identifiers": _BASE + """select 'DOI' identifier_type, v normalized_value, any_value(id) canonical_work_id, v raw_value from (select doi v, id from a where doi is not null union all select cdoi, cited from cites where cdoi is not null) group by v
union all select case arg_min(s, (r, l, i)) when 'semantic_scholar' then 'S2_PAPER_ID' else 'OPENALEX' end, loose, any_value(cited), loose from cites where loose is not null group by loose""",
    "gold_venues": _BASE + _WINS + "select vid canonical_venue_id, arg_min(raw_venue_name, (r, l)) as name, any_value(vs) normalized_name, 'UNSPECIFIED' venue_type, 'UNRANKED' tier, cast(null as varchar) issn from venued where vid is not null group by vid",
    "gold_authors": _BASE + f"select aid canonical_author_id, arg_min(n, (r, l, pos)) display_name, cast(null as varchar) orcid from {_minted('author', '(select *, ' + _slug('n') + ' sl from people)', chr(39) + 'name:' + chr(39) + ' || sl', 'aid')} group by aid",
    "gold_work_authors": _BASE + f"select id canonical_work_id, aid canonical_author_id, cast(pos as int) author_position, arg_min(n, (r, l)) raw_author_name, cast(null as varchar) raw_affiliation_string, false is_corresponding from {_minted('author', '(select *, ' + _slug('n') + ' sl from people)', chr(39) + 'name:' + chr(39) + ' || sl', 'aid')} group by id, aid, pos",
    "gold_citations": _BASE + """select citing citing_work_id, cited cited_work_id, bool_or(infl) is_influential, array_to_string(arg_max(cast(ints as varchar[]), (r, l, i)) filter (where json_type(ints) = 'ARRAY'), ',') intents, arg_min(s, (r, l, i)) source_provider from cites where citing <> cited group by citing, cited""",
    "gold_provenance": _BASE + _WINS + "select id canonical_work_id, 'title' attribute_name, s winning_source, observation_id source_observation_id, rule resolution_rule from title union all select id, 'abstract', s, observation_id, rule from abstract_ union all select id, 'publication_date', s, observation_id, rule from year_ union all select id, 'venue', s, observation_id, rule from venue",
    "gold_metrics": _BASE + "select id canonical_work_id, s source_provider, observation_id source_observation_id, m metric_name, v metric_value from (select id, s, observation_id, 'citation_count' m, cast(cc as double) v from a union all select id, s, observation_id, 'influential_citation_count', cast(ic as double) from a) where v > 0",
}
