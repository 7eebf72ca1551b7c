"""Registered queries of the engine's own operators over the given tables, each with the same result in DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioflow.functions import identifiers as ids
from folioflow.functions import text as tx
from folioflow.operators import quality
from folioflow.operators.common import table
from folioflow.operators.orphans import Reference, orphans
from folioflow.operators.resolve import accepted_dates, merged_edges, unpivoted_metrics, winner
from folioflow.operators.schemas import violations
from folioflow.plans import analytics
from folioflow.plans.ingest import counters, fresh, prepared
from folioflow.sources import providers, records  # noqa: F401

AS_OF = 2026
QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None):
    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return put


# --- reports ----------------------------------------------------------------------------

@query(f"""select w.canonical_work_id, w.title, w.publication_year, v.name venue_name, w.citation_count, w.influential_citation_count, count(c.citing_work_id) inbound_citation_edges,
floor(cast(w.citation_count as double) / greatest(1, {AS_OF} - w.publication_year + 1) * 100 + 0.5) / 100 citation_velocity
from canonical_works w left join canonical_venues v using (canonical_venue_id) left join canonical_citations c on w.canonical_work_id = c.cited_work_id
where w.is_stub = false and (w.publication_year >= 2015 or w.publication_year is null) group by 1, 2, 3, 4, 5, 6
order by influential_citation_count desc nulls last, citation_velocity desc nulls last, canonical_work_id limit 50""")
def citation_velocity(spark: SparkSession, d: str) -> DataFrame:
    return analytics.citation_velocity(table(spark, d, "canonical_works"), table(spark, d, "canonical_venues"), table(spark, d, "canonical_citations"), AS_OF)


@query("""select a1.display_name author_1, a2.display_name author_2, count(distinct x.canonical_work_id) shared_works
from canonical_work_authors x join canonical_work_authors y on x.canonical_work_id = y.canonical_work_id and x.canonical_author_id < y.canonical_author_id
join canonical_authors a1 on x.canonical_author_id = a1.canonical_author_id join canonical_authors a2 on y.canonical_author_id = a2.canonical_author_id
group by 1, 2 order by shared_works desc, author_1 nulls last, author_2 nulls last limit 50""")
def coauthorship_network(spark: SparkSession, d: str) -> DataFrame:
    return analytics.coauthorship_network(table(spark, d, "canonical_work_authors"), table(spark, d, "canonical_authors"))


@query("""select v.name venue_name, v.venue_type, count(w.canonical_work_id) total_works, cast(sum(w.citation_count) as bigint) total_citations,
floor(cast(sum(w.citation_count) as double) / nullif(count(w.citation_count), 0) * 100 + 0.5) / 100 avg_citations_per_work
from canonical_venues v join canonical_works w using (canonical_venue_id) where w.is_stub = false group by 1, 2 order by total_citations desc nulls last, venue_name nulls last, venue_type nulls last limit 20""")
def venue_impact(spark: SparkSession, d: str) -> DataFrame:
    return analytics.venue_impact(table(spark, d, "canonical_works"), table(spark, d, "canonical_venues"))


@query("""select attribute_name, winning_source, source_observation_id, resolution_rule, selected_at, o.source_work_id from canonical_work_provenance p join source_work_observations o on p.source_observation_id = o.observation_id
where p.canonical_work_id = (select min(canonical_work_id) from canonical_work_provenance)""")
def work_provenance_audit(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "canonical_work_provenance")
    chosen = p.agg(F.min("canonical_work_id")).first()[0]
    return analytics.work_provenance_audit(p, table(spark, d, "source_work_observations"), chosen)


# --- scalar functions -------------------------------------------------------------------

_WS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_KEEP = r"[^\p{L}\p{N}_\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_WS}+|{_WS}+$', '', 'g')"


def _squeeze(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '{_WS}+', ' ', 'g'), '^ +| +$', '', 'g')"


def _slug(x: str) -> str:
    return f"coalesce({_squeeze(f"regexp_replace(lower({x}), '{_KEEP}', '', 'g')")}, '')"


@query(f"select distinct title, {_slug('title')} slug from canonical_works")
def slugify(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "canonical_works", "title").select("title", tx.slug(F.col("title")).alias("slug")).distinct()


_TAGLESS = "regexp_replace(abstract, '<[^>]+>', ' ', 'g')"


@query(f"select distinct observation_id, nullif({_squeeze('title')}, '') title, nullif({_squeeze(_TAGLESS)}, '') abstract from source_work_observations")
def clean_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "source_work_observations", "observation_id", "title", "abstract").select("observation_id", tx.clean_text(F.col("title")).alias("title"), tx.without_tags(F.col("abstract")).alias("abstract")).distinct()


@query(f"select distinct replace(replace(replace(coalesce({_squeeze('title')}, ''), '``', '\"'), '''''', '\"'), '`', '''') title, observation_id from source_work_observations")
def clean_tex(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "source_work_observations", "observation_id", "title").select("observation_id", tx.plain_tex(F.col("title")).alias("title")).distinct()


@query("select doc_id, sha256(text) payload_hash from documents")
def payload_hash(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents", "doc_id", "text").select("doc_id", ids.payload_hash(F.col("text")).alias("payload_hash"))


@query(f"""with b as (select distinct raw_value, {_strip("regexp_replace(regexp_replace(lower(" + _strip('raw_value') + "), '^https?://(dx[.])?doi[.]org/', ''), '^doi:[[:space:]]*', '')")} v from canonical_work_identifiers)
select raw_value, case when regexp_matches(v, '^10[.][0-9]{{4,9}}/[^[:space:]]+$') then v end doi from b""")
def doi_normalize(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "canonical_work_identifiers", "raw_value").distinct().select("raw_value", ids.doi(F.col("raw_value")).alias("doi"))


@query(f"""with b as (select distinct raw_value, {_strip("regexp_replace(regexp_replace(lower(" + _strip('raw_value') + "), '^https?://arxiv[.]org/(abs|pdf)/', ''), '^arxiv:[[:space:]]*', '')")} w from canonical_work_identifiers), c as (select raw_value, w, regexp_replace(w, 'v[0-9]+$', '') v from b)
select raw_value, case when regexp_matches(v, '^([0-9]{{4}}[.][0-9]{{4,5}}(v[0-9]+)?|[a-z-]+([.][a-z]{{2}})?/[0-9]{{7}}(v[0-9]+)?)$') then v end arxiv_id,
case when regexp_matches(w, '^([0-9]{{4}}[.][0-9]{{4,5}}(v[0-9]+)?|[a-z-]+([.][a-z]{{2}})?/[0-9]{{7}}(v[0-9]+)?)$') then w end versioned from c""")
def arxiv_normalize(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "canonical_work_identifiers", "raw_value").distinct().select("raw_value", ids.arxiv_id(F.col("raw_value")).alias("arxiv_id"), ids.arxiv_id(F.col("raw_value"), False).alias("versioned"))


_ORCID_VALUES = "select distinct orcid raw from canonical_authors union select distinct 'https://orcid.org/' || replace(orcid, '-', '') from canonical_authors where orcid is not null union select lpad(cast(c_custkey as varchar), 16, '0') from customer"


@query(f"""with r as ({_ORCID_VALUES}), g as (select raw, regexp_replace(upper(regexp_replace(trim(raw), '^https?://orcid[.]org/', '')), '[^0-9X]', '', 'g') dg from r),
k as (select raw, dg, list_reduce(list_prepend(0, [cast(coalesce(try_cast(substr(dg, i, 1) as int), 0) as bigint) for i in range(1, 16)]), lambda x, y: (x + y) * 2) t from g where length(dg) = 16)
select g.raw, case when regexp_matches(k.dg, '^[0-9]{{15}}[0-9X]$') and substr(k.dg, 16, 1) = case (12 - k.t % 11) % 11 when 10 then 'X' else cast((12 - k.t % 11) % 11 as varchar) end then substr(k.dg, 1, 4) || '-' || substr(k.dg, 5, 4) || '-' || substr(k.dg, 9, 4) || '-' || substr(k.dg, 13, 4) end orcid from g left join k on g.raw = k.raw""")
def orcid_normalize(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "canonical_authors", "orcid")
    raw = o.select(F.col("orcid").alias("raw")).union(o.where("orcid is not null").select(F.concat(F.lit("https://orcid.org/"), F.replace("orcid", F.lit("-"), F.lit(""))))).union(table(spark, d, "customer", "c_custkey").select(F.lpad(F.col("c_custkey").cast("string"), 16, "0")))
    return raw.distinct().select("raw", ids.orcid(F.col("raw")).alias("orcid"))


@query("""with r as (select 'https://ROR.org/0' || substr(md5(cast(s_suppkey as varchar)), 1, 6) || lpad(cast(s_suppkey % 100 as varchar), 2, '0') raw from supplier union select s_name from supplier),
b as (select raw, regexp_replace(lower(trim(raw)), '^https?://ror[.]org/', '') v from r) select raw, case when regexp_matches(v, '^0[a-hj-km-np-tv-z0-9]{6}[0-9]{2}$') then 'https://ror.org/' || v end ror from b""")
def ror_normalize(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier", "s_suppkey", "s_name")
    made = F.concat(F.lit("https://ROR.org/0"), F.substring(F.md5(F.col("s_suppkey").cast("string")), 1, 6), F.lpad((F.col("s_suppkey") % 100).cast("string"), 2, "0"))
    raw = s.select(made.alias("raw")).union(s.select("s_name")).distinct()
    return raw.select("raw", ids.ror(F.col("raw")).alias("ror"))


_UUID = "substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab', (strpos('0123456789abcdef', substr(h, 17, 1)) - 1) % 4 + 1, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12)"


@query(f"""with k as (select distinct name, issn, case when trim(issn) <> '' then 'issn:' || lower(trim(issn)) else 'name:' || {_slug('name')} end a from canonical_venues),
h as (select name, issn, sha1(from_hex('{ids.NAMESPACES["venue"].replace("-", "")}') || encode(a)) h from k) select name, issn, {_UUID} venue_id from h""")
def venue_mint(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "canonical_venues", "name", "issn").distinct().select("name", "issn", ids.venue_id(F.col("name"), F.col("issn")).alias("venue_id"))


@query(f"""with k as (select distinct display_name, orcid, case when orcid is not null then 'orcid:' || orcid else 'name:' || {_slug('display_name')} end a from canonical_authors),
h as (select display_name, orcid, sha1(from_hex('{ids.NAMESPACES["author"].replace("-", "")}') || encode(a)) h from k) select display_name, orcid, {_UUID} author_id from h""")
def author_mint(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "canonical_authors", "display_name", "orcid").distinct().select("display_name", "orcid", ids.author_id(F.col("orcid"), F.lit(None).cast("string"), F.col("display_name")).alias("author_id"))


@query(f"""with k as (select distinct normalized_doi, 'doi:' || normalized_doi a from source_work_observations where normalized_doi is not null),
h as (select normalized_doi, sha1(from_hex('{ids.NAMESPACES["work"].replace("-", "")}') || encode(a)) h from k) select normalized_doi, {_UUID} work_id from h""")
def work_mint(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "source_work_observations", "normalized_doi").where("normalized_doi is not null").distinct().select("normalized_doi", ids.work_id(F.concat(F.lit("doi:"), F.col("normalized_doi"))).alias("work_id"))


@query(f"""with k as (select distinct raw_affiliation_string name, 'name:' || {_slug('raw_affiliation_string')} a from canonical_work_authors where raw_affiliation_string is not null),
h as (select name, sha1(from_hex('{ids.NAMESPACES["institution"].replace("-", "")}') || encode(a)) h from k) select name, {_UUID} institution_id from h""")
def institution_mint(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "canonical_work_authors", "raw_affiliation_string").where("raw_affiliation_string is not null").distinct().select(F.col("raw_affiliation_string").alias("name"), ids.institution_id(F.lit(None).cast("string"), F.col("raw_affiliation_string")).alias("institution_id"))


@query(f"select distinct observation_id, md5({_slug('title')} || '|' || coalesce(cast(nullif(publication_year, 0) as varchar), 'unknown') || '|' || {_slug('raw_venue_name')}) fingerprint from source_work_observations")
def fingerprint(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "source_work_observations", "observation_id", "title", "publication_year", "raw_venue_name").select("observation_id", ids.fingerprint(F.col("title"), F.col("publication_year"), F.col("raw_venue_name")).alias("fingerprint")).distinct()


# --- sources ----------------------------------------------------------------------------

def _parsed(spark: SparkSession, d: str, source: str) -> DataFrame:
    return records.parse(table(spark, d, f"sample_{source}", "record_no", "payload"), source, "payload")


@query(" union all ".join(f"select '{t}' as source, record_no, case when not coalesce(json_valid(payload), false) then 'MALFORMED_JSON' when json_type(payload) <> 'OBJECT' then 'PARSER_EXCEPTION' else 'object' end outcome from {t}" for t in ("sample_openalex", "sample_crossref", "sample_semantic_scholar")))
def json_decode(spark: SparkSession, d: str) -> DataFrame:
    v = F.try_parse_json("payload")
    out = None
    for name in ("sample_openalex", "sample_crossref", "sample_semantic_scholar"):
        one = table(spark, d, name, "record_no", "payload").select(F.lit(name).alias("source"), "record_no", F.coalesce(records.decoding_error(v)[0], F.lit("object")).alias("outcome"))
        out = one if out is None else out.unionByName(one)
    return out


def _valid(name: str) -> str:
    return f"select record_no, case when json_valid(payload) then json(payload) end j from {name} where case when coalesce(json_valid(payload), false) then json_type(payload) = 'OBJECT' else false end"


def _items(path: str) -> str:
    return f"case when json_type(j, '{path}') = 'ARRAY' then cast(json_extract(j, '{path}') as json[]) else [] end"


def _text(path: str, j: str = "j") -> str:
    """A field as text, null when it is an object or a list."""
    return f"case when json_type({j}, '{path}') in ('OBJECT', 'ARRAY', 'NULL') then null else {j}->>'{path}' end"


def _no_objects(items: str) -> str:
    return f"coalesce(list_bool_or([coalesce(json_type(x), 'NULL') <> 'OBJECT' for x in {items}]), false)"


def _joined(x: str, parts: str) -> str:
    return f"array_to_string([{parts} for a in {x}], '; ')"


def _bare(c: str, *prefixes: str) -> str:
    out = f"lower({_strip(c)})"
    for p in prefixes:
        out = f"regexp_replace({out}, '{p}', '')"
    return _strip(out)


def _sql_doi(c: str) -> str:
    bare = _bare(c, "^https?://(dx[.])?doi[.]org/", "^doi:[[:space:]]*")
    return f"case when regexp_matches({bare}, '^10[.][0-9]{{4,9}}/[^[:space:]]+$') then {bare} end"


def _sql_date(c: str) -> str:
    return f"case when regexp_matches({c}, '^[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}$') then try_cast({c} as date) end"


def _parts(df: DataFrame) -> DataFrame:
    """All fields of the works parsed without error, lists as text."""
    w = F.col("work")
    shown = lambda *c: F.concat_ws("/", *[F.coalesce(x.cast("string"), F.lit("-")) for x in c])
    people = F.array_join(F.transform(w["authors"], lambda a: shown(a["raw_name"], a["position"], a["source_author_id"], a["raw_affiliation"], a["institution_name"], a["institution_country"])), "; ")
    cited = F.array_join(F.transform(w["citations"], lambda c: shown(c["cited_doi"], c["cited_source_id"], c["raw_citation_string"], c["is_influential"], F.array_join(c["citation_intents"], ","))), "; ")
    others = F.array_join(F.transform(w["external_ids"], lambda x: shown(x["type"], x["value"])), "; ")
    plain = ("source_name", "source_work_id", "title", "abstract", "publication_year", "publication_date", "normalized_doi", "normalized_arxiv_id", "raw_venue_name", "venue_issn", "venue_type", "citation_count", "influential_citation_count")
    return df.where("error_type is null").select("record_no", *[w[c].alias(c) for c in plain], people.alias("authors"), cited.alias("citations"), others.alias("external_ids"))


_OPENALEX_YEAR = "try_cast(j->>'$.publication_year' as int)"
_OPENALEX_DATE = _sql_date("nullif(" + _text("$.publication_date") + ", '')")
_NAMED = "coalesce(nullif(" + _text("$.author.display_name", "a") + ", ''), nullif(" + _text("$.raw_author_name", "a") + ", ''))"
_INST = "nullif(" + _text("$.institutions[0].display_name", "a") + ", '')"


@query(f"""with j as ({_valid("sample_openalex")}),
ok as (select *, {_items("$.authorships")} ships, {_items("$.referenced_works")} refs, coalesce({_strip(_text("$.id"))}, '') raw_id, {_sql_doi("coalesce(nullif(" + _text("$.doi") + ", ''), nullif(" + _text("$.ids.doi") + ", ''))")} doi from j
  where coalesce(json_type(j, '$.title'), 'NULL') in ('NULL', 'VARCHAR') and coalesce(json_type(j, '$.primary_location.source.type'), 'VARCHAR') <> 'NULL' and not {_no_objects(_items("$.authorships"))} and coalesce(json_type(j, '$.publication_year'), 'NULL') in ('NULL', 'UBIGINT', 'BIGINT') and not coalesce({_text("$.cited_by_count")} is not null and try_cast({_text("$.cited_by_count")} as double) is null, false)),
k as (select record_no ab_no, unnest(json_keys(j, '$.abstract_inverted_index')) w, unnest(range(1, len(json_keys(j, '$.abstract_inverted_index')) + 1)) o, j from ok where json_type(j, '$.abstract_inverted_index') = 'OBJECT'),
pl as (select ab_no, w, o, unnest(cast(map_extract(cast(json_extract(j, '$.abstract_inverted_index') as map(varchar, int[])), w)[1] as int[])) p from k),
ab as (select ab_no, nullif({_squeeze("string_agg(w, ' ' order by p)")}, '') abstract from (select ab_no, p, max_by(w, o) w from pl where p >= 0 group by 1, 2) where w <> '' group by 1)
select record_no, 'openalex' source_name, raw_id source_work_id, coalesce({_squeeze("coalesce(nullif(" + _text("$.title") + ", ''), nullif(" + _text("$.display_name") + ", ''))")}, '') title, ab.abstract, case when {_OPENALEX_YEAR} <> 0 then {_OPENALEX_YEAR} else coalesce(year({_OPENALEX_DATE}), {_OPENALEX_YEAR}) end publication_year, {_OPENALEX_DATE} publication_date, doi normalized_doi, cast(null as varchar) normalized_arxiv_id,
{_text("$.primary_location.source.display_name")} raw_venue_name, {_text("$.primary_location.source.issn_l")} venue_issn, coalesce(upper({_text("$.primary_location.source.type")}), 'UNSPECIFIED') venue_type, coalesce(trunc(try_cast({_text("$.cited_by_count")} as double)), 0)::int citation_count, 0 influential_citation_count,
array_to_string([x.t for x in [{{'t': {_NAMED} || '/' || i || '/' || coalesce(nullif({_text("$.author.id", "a")}, ''), '-') || '/' || coalesce(nullif({_text("$.raw_affiliation_string", "a")}, ''), {_INST}, '-') || '/' || coalesce({_INST}, '-') || '/' || coalesce(nullif({_text("$.institutions[0].country_code", "a")}, ''), '-'), 'n': {_NAMED}}} for a, i in ships] if x.n <> ''], '; ') authors,
array_to_string(['-/' || x || '/-/false/' for x in [{_strip("r->>'$'")} for r in refs if json_type(r) = 'VARCHAR'] if x <> ''], '; ') citations,
array_to_string(list_filter([case when raw_id <> '' then 'OPENALEX/' || raw_id end, 'DOI/' || doi, 'MAG/' || nullif({_text("$.ids.mag")}, ''), 'PMID/' || nullif({_text("$.ids.pmid")}, '')], lambda x: x is not null), '; ') external_ids
from ok left join ab on ab.ab_no = record_no""")
def parse_openalex(spark: SparkSession, d: str) -> DataFrame:
    """All fields of the OpenAlex records."""
    return _parts(_parsed(spark, d, "openalex"))


def _chosen(k: str) -> str:
    return f"case when json_array_length(j, '$.\"{k}\".\"date-parts\"[0]') > 0 then try_cast(json_extract(j, '$.\"{k}\".\"date-parts\"[0]') as int[]) end"


_CROSSREF_NAME = f"case when {_strip(_text('$.given', 'a'))} <> '' then {_strip(_text('$.given', 'a'))} || ' ' || coalesce({_strip(_text('$.family', 'a'))}, '') else coalesce({_strip(_text('$.family', 'a'))}, '') end"
_CROSSREF_DATE = "try_cast(printf('%04d-%02d-%02d', dp[1], case when len(dp) >= 2 then dp[2] else 1 end, case when len(dp) >= 3 then dp[3] else 1 end) as date)"


@query(f"""with j as ({_valid("sample_crossref")}),
ok as (select *, {_items("$.author")} people, {_items("$.reference")} refs, coalesce({_text("$.DOI")}, '') raw, coalesce({_chosen("published-print")}, {_chosen("published-online")}, {_chosen("issued")}, {_chosen("created")}) dp from j
  where coalesce(json_type(j, '$.type'), 'VARCHAR') <> 'NULL' and coalesce(json_type(j, '$.abstract'), 'NULL') in ('NULL', 'VARCHAR') and not {_no_objects(_items("$.author"))} and not {_no_objects(_items("$.reference"))} and not coalesce({_text('$."is-referenced-by-count"')} is not null and try_cast({_text('$."is-referenced-by-count"')} as double) is null, false))
select record_no, 'crossref' source_name, raw source_work_id, coalesce({_squeeze("case when json_type(j, '$.title') = 'VARCHAR' then j->>'$.title' else " + _text("$.title[0]") + " end")}, '') title, nullif({_squeeze("regexp_replace(nullif(" + _text("$.abstract") + ", ''), '<[^>]+>', ' ', 'g')")}, '') abstract, dp[1] publication_year, {_CROSSREF_DATE} publication_date, {_sql_doi("raw")} normalized_doi, cast(null as varchar) normalized_arxiv_id,
{_text('$."container-title"[0]')} raw_venue_name, {_text("$.ISSN[0]")} venue_issn, case when contains({_text("$.type")}, 'journal') then 'JOURNAL' else 'CONFERENCE' end venue_type, coalesce(trunc(try_cast({_text('$."is-referenced-by-count"')} as double)), 0)::int citation_count, 0 influential_citation_count,
array_to_string([x.t for x in [{{'t': {_strip(_CROSSREF_NAME)} || '/' || i || '/-/' || coalesce({_text("$.affiliation[0].name", "a")}, '-') || '/-/-', 'n': {_strip(_CROSSREF_NAME)}}} for a, i in people] if x.n <> ''], '; ') authors,
array_to_string([coalesce(x.d, '-') || '/-/' || coalesce(x.u, '-') || '/false/' for x in [{{'d': {_sql_doi(_text("$.DOI", "a"))}, 'u': nullif({_text("$.unstructured", "a")}, '')}} for a in refs] if x.d is not null or x.u is not null], '; ') citations,
case when {_sql_doi("raw")} is not null then 'DOI/' || {_sql_doi("raw")} else '' end external_ids from ok""")
def parse_crossref(spark: SparkSession, d: str) -> DataFrame:
    """All fields of the Crossref records."""
    return _parts(_parsed(spark, d, "crossref"))


_S2_DATE = _sql_date("nullif(" + _text("$.publicationDate") + ", '')")
_S2_YEAR = "try_cast(j->>'$.year' as int)"
_S2_ARXIV = "regexp_replace(" + _bare(_text("$.externalIds.ArXiv"), "^https?://arxiv[.]org/(abs|pdf)/", "^arxiv:[[:space:]]*") + ", 'v[0-9]+$', '')"


@query(f"""with j as ({_valid("sample_semantic_scholar")}),
ok as (select *, {_items("$.authors")} people, {_items("$.citations")} cites, coalesce({_strip(_text("$.paperId"))}, '') paper, nullif(nullif({_text("$.corpusId")}, ''), '0') corpus, {_sql_doi(_text("$.externalIds.DOI"))} doi, case when regexp_matches({_S2_ARXIV}, '^([0-9]{{4}}[.][0-9]{{4,5}}|[a-z-]+([.][a-z]{{2}})?/[0-9]{{7}})$') then {_S2_ARXIV} end aid from j
  where coalesce(json_type(j, '$.title'), 'NULL') in ('NULL', 'VARCHAR') and coalesce(json_type(j, '$.abstract'), 'NULL') in ('NULL', 'VARCHAR') and coalesce(json_type(j, '$.publicationVenue.type'), 'VARCHAR') <> 'NULL' and not {_no_objects(_items("$.authors"))} and not {_no_objects(_items("$.citations"))} and coalesce(json_type(j, '$.year'), 'NULL') in ('NULL', 'UBIGINT', 'BIGINT'))
select record_no, 'semantic_scholar' source_name, coalesce(nullif(paper, ''), corpus, 'unknown') source_work_id, coalesce({_squeeze(_text("$.title"))}, '') title, nullif({_squeeze(_text("$.abstract"))}, '') abstract, case when {_S2_YEAR} <> 0 then {_S2_YEAR} else coalesce(year({_S2_DATE}), {_S2_YEAR}) end publication_year, {_S2_DATE} publication_date, doi normalized_doi, aid normalized_arxiv_id,
coalesce(nullif({_text("$.publicationVenue.name")}, ''), {_text("$.venue")}) raw_venue_name, {_text("$.publicationVenue.issn")} venue_issn, coalesce(upper({_text("$.publicationVenue.type")}), 'UNSPECIFIED') venue_type, coalesce(trunc(try_cast({_text("$.citationCount")} as double)), 0)::int citation_count, coalesce(trunc(try_cast({_text("$.influentialCitationCount")} as double)), 0)::int influential_citation_count,
array_to_string([x.t for x in [{{'t': coalesce({_strip(_text("$.name", "a"))}, '') || '/' || i || '/' || coalesce(nullif({_text("$.authorId", "a")}, ''), '-') || '/-/-/-', 'n': {_strip(_text("$.name", "a"))}}} for a, i in people] if x.n <> ''], '; ') authors,
array_to_string(['-/' || x.p || '/-/' || x.f || '/' || x.i for x in [{{'p': {_strip(_text("$.paperId", "a"))}, 'f': coalesce(try_cast({_text("$.isInfluential", "a")} as boolean), false), 'i': case when json_type(a, '$.intents') = 'ARRAY' then array_to_string([upper(coalesce(i->>'$', 'NONE')) for i in cast(json_extract(a, '$.intents') as json[])], ',') else '' end}} for a in cites] if x.p <> ''], '; ') citations,
array_to_string(list_filter(['S2_PAPER_ID/' || nullif(paper, ''), 'CORPUS_ID/' || corpus, 'DOI/' || doi, 'ARXIV/' || aid, 'PUBMED/' || nullif({_text("$.externalIds.PubMed")}, ''), 'DBLP/' || nullif({_text("$.externalIds.DBLP")}, '')], lambda x: x is not null), '; ') external_ids from ok""")
def parse_semantic_scholar(spark: SparkSession, d: str) -> DataFrame:
    """All fields of the Semantic Scholar records."""
    return _parts(_parsed(spark, d, "semantic_scholar"))


_ARXIV_BARE = _bare("rid", "^https?://arxiv[.]org/(abs|pdf)/", "^arxiv:[[:space:]]*")
_ARXIV_ID = f"case when regexp_matches(regexp_replace({_ARXIV_BARE}, 'v[0-9]+$', ''), '^([0-9]{{4}}[.][0-9]{{4,5}}|[a-z-]+([.][a-z]{{2}})?/[0-9]{{7}})$') then regexp_replace({_ARXIV_BARE}, 'v[0-9]+$', '') end"
_YY = "regexp_extract(rid, '^([0-9]{2})[0-9]{2}[.][0-9]+', 1)"
_ARXIV_DATE = f"coalesce(d, case when {_YY} <> '' then make_date(case when cast({_YY} as int) < 90 then 2000 else 1900 end + cast({_YY} as int), 1, 1) end)"


@query(f"""with o as (select distinct observation_id record_no, coalesce(normalized_arxiv_id, source_work_id) rid, title, abstract, normalized_doi, publication_date d, raw_venue_name, case when json_valid(raw_authors) and json_type(raw_authors) = 'ARRAY' then cast(raw_authors as json[]) else [] end la from source_work_observations),
p as (select *, {_ARXIV_ID} aid, {_sql_doi("normalized_doi")} doi, coalesce({_strip("nullif(raw_venue_name, '')")}, 'arXiv.org') venue from o)
select record_no, 'arxiv' source_name, coalesce(nullif({_strip("rid")}, ''), aid, 'unknown') source_work_id, replace(replace(replace(coalesce({_squeeze('title')}, ''), '``', '"'), '''''', '"'), '`', '''') title, replace(replace(replace(coalesce({_squeeze('abstract')}, ''), '``', '"'), '''''', '"'), '`', '''') abstract, year({_ARXIV_DATE}) publication_year, {_ARXIV_DATE} publication_date, doi normalized_doi, aid normalized_arxiv_id, venue raw_venue_name, cast(null as varchar) venue_issn, case when venue = 'arXiv.org' then 'PREPRINT_SERVER' else 'JOURNAL' end venue_type, 0 citation_count, 0 influential_citation_count,
array_to_string(list_transform(list_filter([case when {_strip("a->>'$.raw_name'")} <> '' then 'F. ' || {_strip("a->>'$.raw_name'")} else 'F.' end for a in la], lambda x: x <> ''), lambda x, i: x || '/' || i || '/-/Lab/-/-'), '; ') authors, '' citations, array_to_string(list_filter(['ARXIV/' || aid, 'DOI/' || doi], lambda x: x is not null), '; ') external_ids from p""")
def parse_arxiv(spark: SparkSession, d: str) -> DataFrame:
    """All fields of arXiv records, which the observations are written as first."""
    o = table(spark, d, "source_work_observations", "observation_id", "normalized_arxiv_id", "source_work_id", "title", "abstract", "normalized_doi", "publication_date", "raw_venue_name", "raw_authors").distinct()
    names = F.transform(F.coalesce(F.from_json("raw_authors", "array<struct<raw_name:string>>"), F.array().cast("array<struct<raw_name:string>>")), lambda a: F.array(a["raw_name"], F.lit("F."), F.lit("Lab")))
    line = F.to_json(F.struct(F.coalesce("normalized_arxiv_id", "source_work_id").alias("id"), "title", "abstract", F.col("normalized_doi").alias("doi"), F.col("publication_date").cast("string").alias("update_date"), F.col("raw_venue_name").alias("journal-ref"), names.alias("authors_parsed")))
    return _parts(records.parse(o.select(F.col("observation_id").alias("record_no"), line.alias("line")), "arxiv"))


@query(r"""with j as (select record_no, json(payload) j from sample_openalex where json_valid(payload) and json_type(payload) = 'OBJECT' and json_type(payload, '$.abstract_inverted_index') = 'OBJECT'),
k as (select record_no, unnest(json_keys(j, '$.abstract_inverted_index')) w, unnest(range(1, len(json_keys(j, '$.abstract_inverted_index')) + 1)) o, j from j),
p as (select record_no, w, o, unnest(cast(map_extract(cast(json_extract(j, '$.abstract_inverted_index') as map(varchar, int[])), w)[1] as int[])) p from k),
b as (select record_no, p, max_by(w, o) w from p group by 1, 2)
select record_no, nullif(trim(regexp_replace(string_agg(w, ' ' order by p), '\s+', ' ', 'g')), '') abstract from b where w <> '' group by 1""")
def inverted_abstracts(spark: SparkSession, d: str) -> DataFrame:
    v = F.try_parse_json("payload")
    return table(spark, d, "sample_openalex", "record_no", "payload").select("record_no", providers.inverted_abstract(v, "$.abstract_inverted_index").alias("abstract")).where("abstract is not null")


# --- quality ----------------------------------------------------------------------------

@query("select distinct observation_id, title, length(coalesce(trim(title), '')) < 3 or lower(trim(title)) in ('[untitled]', 'untitled', 'none', 'unknown', 'n/a', 'na', 'null', '') incomplete from source_work_observations")
def dq_title(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "source_work_observations", "observation_id", "title").select("observation_id", "title", quality.title_incomplete(F.col("title")).alias("incomplete")).distinct()


@query(f"select distinct observation_id, case when publication_year between 1665 and {AS_OF} + 1 then publication_year end publication_year, publication_year is not null and not publication_year between 1665 and {AS_OF} + 1 warned from source_work_observations")
def dq_year(spark: SparkSession, d: str) -> DataFrame:
    y = F.col("publication_year")
    ok = quality.year_in_bounds(y, AS_OF)
    return table(spark, d, "source_work_observations", "observation_id", "publication_year").select("observation_id", F.when(ok, y).alias("publication_year"), F.coalesce(~ok, F.lit(False)).alias("warned")).distinct()


@query("select citing_work_id, count(*) n, count(*) filter (where citing_work_id = cited_work_id) self_edges from canonical_citations where citing_work_id is not null group by 1")
def dq_self_edge(spark: SparkSession, d: str) -> DataFrame:
    c = F.struct(F.lit(None).cast("string").alias("cited_doi"), F.lit(None).cast("string").alias("cited_arxiv_id"), F.col("cited_work_id").alias("cited_source_id"))
    none = F.lit(None).cast("string")
    return table(spark, d, "canonical_citations", "citing_work_id", "cited_work_id").where("citing_work_id is not null").withColumn("self", quality.is_self_citation(c, none, none, F.col("citing_work_id"))).groupBy("citing_work_id").agg(F.count("*").alias("n"), F.count_if("self").alias("self_edges"))


def _outcomes() -> str:
    """SQL for the error of each raw record: malformed, an exception of its parser, or a title that says nothing."""
    broken = {
        "openalex": f"coalesce(json_type(j, '$.title'), 'NULL') not in ('NULL', 'VARCHAR') or coalesce(json_type(j, '$.primary_location.source.type'), 'VARCHAR') = 'NULL' or {_no_objects(_items('$.authorships'))} or coalesce(json_type(j, '$.publication_year'), 'NULL') not in ('NULL', 'UBIGINT', 'BIGINT') or coalesce({_text('$.cited_by_count')} is not null and try_cast({_text('$.cited_by_count')} as double) is null, false)",
        "crossref": f"coalesce(json_type(j, '$.type'), 'VARCHAR') = 'NULL' or coalesce(json_type(j, '$.abstract'), 'NULL') not in ('NULL', 'VARCHAR') or {_no_objects(_items('$.author'))} or {_no_objects(_items('$.reference'))} or coalesce({_text('$.\"is-referenced-by-count\"')} is not null and try_cast({_text('$.\"is-referenced-by-count\"')} as double) is null, false)",
        "semantic_scholar": f"coalesce(json_type(j, '$.title'), 'NULL') not in ('NULL', 'VARCHAR') or coalesce(json_type(j, '$.abstract'), 'NULL') not in ('NULL', 'VARCHAR') or coalesce(json_type(j, '$.publicationVenue.type'), 'VARCHAR') = 'NULL' or {_no_objects(_items('$.authors'))} or {_no_objects(_items('$.citations'))} or coalesce(json_type(j, '$.year'), 'NULL') not in ('NULL', 'UBIGINT', 'BIGINT')",
    }
    titles = {
        "openalex": _squeeze("coalesce(nullif(" + _text("$.title") + ", ''), nullif(" + _text("$.display_name") + ", ''))"),
        "crossref": _squeeze("case when json_type(j, '$.title') = 'VARCHAR' then j->>'$.title' else " + _text("$.title[0]") + " end"),
        "semantic_scholar": _squeeze(_text("$.title")),
    }
    one = lambda t: f"select '{t}' as source_name, record_no, payload, case when not good then 'MALFORMED_JSON' when json_type(j) <> 'OBJECT' then 'PARSER_EXCEPTION' when {broken[t]} then 'PARSER_EXCEPTION' when length(coalesce({titles[t]}, '')) < 3 or lower({titles[t]}) in ('[untitled]', 'untitled', 'none', 'unknown', 'n/a', 'na', 'null', '') then 'DQ-02_TITLE_INCOMPLETE' end error_type from (select record_no, payload, coalesce(json_valid(payload), false) good, case when json_valid(payload) then json(payload) end j from sample_{t})"
    return " union all ".join(map(one, broken))


@query(f"select source_name, cast(count(*) as int) record_count, cast(count(distinct case when error_type is null then {_strip('payload')} end) as int) accepted_count, cast(count(error_type) as int) rejected_count from ({_outcomes()}) where {_strip('payload')} <> '' group by 1")
def run_counters(spark: SparkSession, d: str) -> DataFrame:
    """Records read, accepted and rejected of each raw source, as a run counts them."""
    out = None
    for s in ("openalex", "crossref", "semantic_scholar"):
        lines = table(spark, d, f"sample_{s}", "record_no", "payload").select(F.col("record_no").alias("line_idx"), tx.strip(F.col("payload")).alias("line")).where("line <> ''")
        one = counters(prepared(lines, s, None, AS_OF)).select(F.lit(s).alias("source_name"), "*")
        out = one if out is None else out.unionByName(one)
    return out


@query(f"select source_name, error_type, count(*) n from ({_outcomes()}) where error_type is not null group by 1, 2")
def quarantine_by_error(spark: SparkSession, d: str) -> DataFrame:
    """How many raw records of each source are quarantined for which error."""
    out = None
    for s in ("openalex", "crossref", "semantic_scholar"):
        one = quality.check(_parsed(spark, d, s), AS_OF).where("error_type is not null").groupBy("error_type").agg(F.count("*").alias("n")).select(F.lit(s).alias("source_name"), "error_type", "n")
        out = one if out is None else out.unionByName(one)
    return out


# --- ingestion and resolution -----------------------------------------------------------

@query("with d as (select doc_id, sha256(text) h from documents where text is not null) select min(doc_id) line_idx, h payload_hash from d group by h")
def first_writer_dedupe(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "documents", "doc_id", "text").where("text is not null").select(F.col("doc_id").alias("line_idx"), ids.payload_hash(F.col("text")).alias("payload_hash"))
    return fresh(lines, None)


@query("with d as (select doc_id, sha256(text) h from documents where text is not null), s as (select distinct sha256(text) h from documents where source = 'arxiv' and text is not null) select min(doc_id) line_idx, h payload_hash from d where h not in (select h from s) group by h")
def replay_skip(spark: SparkSession, d: str) -> DataFrame:
    """Of all documents those whose payload no document from arXiv, the earlier run, holds."""
    lines = table(spark, d, "documents", "doc_id", "text", "source").where("text is not null").select(F.col("doc_id").alias("line_idx"), ids.payload_hash(F.col("text")).alias("payload_hash"), "source")
    return fresh(lines.drop("source"), lines.where("source = 'arxiv'").select("payload_hash"))


@query("""with o as (select distinct lower(trim(normalized_doi)) k, observation_id, source_name, title, observed_at from source_work_observations where trim(normalized_doi) <> ''),
f as (select k, min((observed_at, observation_id)) f from o group by k),
c as (select o.*, (observed_at, observation_id) = f.f is_first, case source_name when 'crossref' then 1 when 'openalex' then 2 when 'semantic_scholar' then 3 when 'arxiv' then 4 else 99 end p from o join f using (k) where (observed_at, observation_id) = f.f or title <> '')
select k, source_name as source, observation_id, title as value, case when is_first then 'INITIAL_CREATION' else 'PRIORITY_OVERRIDE' end rule from c qualify row_number() over (partition by k order by p, observed_at desc, observation_id desc) = 1""")
def authority_winner(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "source_work_observations", "normalized_doi", "observation_id", "source_name", "title", "observed_at").select(tx.id_key(F.col("normalized_doi")).alias("k"), "observation_id", F.col("source_name").alias("source"), F.col("title").alias("value"), F.struct("observed_at", "observation_id").alias("seq")).where("k is not null").distinct()
    first = o.groupBy("k").agg(F.min("seq").alias("first"))
    c = o.join(first, "k").withColumn("is_first", F.col("seq") == F.col("first")).withColumn("after_stub", F.lit(False)).where("is_first or value <> ''")
    return winner(c, "title", "k")


@query("""with o as (select distinct lower(trim(normalized_doi)) k, observation_id, source_name, publication_date d, publication_year y, observed_at from source_work_observations where trim(normalized_doi) <> ''),
f as (select k, min((observed_at, observation_id)) f from o group by k),
c as (select o.*, case source_name when 'crossref' then 1 when 'openalex' then 2 when 'semantic_scholar' then 3 when 'arxiv' then 4 else 99 end p from o join f using (k) where (observed_at, observation_id) = f.f or y <> 0),
r as (select *, min(p) over (partition by k order by observed_at, observation_id rows between unbounded preceding and 1 preceding) b from c)
select k, cast(arg_max(d, (observed_at, observation_id)) as varchar) publication_date from r where (b is null or p <= b) and d is not null group by k""")
def authority_running_accept(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "source_work_observations", "normalized_doi", "observation_id", "source_name", "publication_date", "publication_year", "observed_at").select(tx.id_key(F.col("normalized_doi")).alias("k"), F.col("source_name").alias("source"), F.col("publication_date").alias("date"), "publication_year", F.struct("observed_at", "observation_id").alias("seq")).where("k is not null").distinct()
    first = o.groupBy("k").agg(F.min("seq").alias("first"))
    return accepted_dates(o.join(first, "k").where("seq = first or publication_year <> 0"), "k").withColumn("publication_date", F.col("publication_date").cast("string"))


@query("""select citing_work_id, cited_work_id, coalesce(bool_or(is_influential), false) is_influential, array_to_string(arg_max(citation_intents, (created_at, source_provider, array_to_string(citation_intents, ','))) filter (where citation_intents is not null), ',') intents, arg_min(source_provider, (created_at, source_provider, coalesce(array_to_string(citation_intents, ','), ''))) source_provider
from canonical_citations group by 1, 2""")
def edge_merge(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "canonical_citations").withColumn("seq", F.struct("created_at", "source_provider", F.coalesce(F.array_join("citation_intents", ","), F.lit("")).alias("i")))
    return merged_edges(c).select("citing_work_id", "cited_work_id", "is_influential", F.array_join("citation_intents", ",").alias("intents"), "source_provider")


@query("select lower(trim(cited_work_id)) stub_id, count(*) n_edges from canonical_citations where trim(cited_work_id) <> '' and lower(trim(cited_work_id)) not in (select lower(trim(canonical_work_id)) from canonical_works where canonical_work_id is not null) group by 1")
def stub_targets(spark: SparkSession, d: str) -> DataFrame:
    """Cited works without a record, which ingestion would make stubs of, with their edges."""
    cited = table(spark, d, "canonical_citations", "cited_work_id").select(F.col("cited_work_id").alias("ref_id"), F.lit(None).cast("string").alias("period"))
    works = table(spark, d, "canonical_works", "canonical_work_id").select(F.col("canonical_work_id").alias("target_id"), F.lit(None).cast("timestamp").alias("since"))
    return orphans([Reference("canonical_citations", cited, works)]).select(F.col("missing_id").alias("stub_id"), F.col("n_rows").alias("n_edges"))


@query("""select distinct observation_id, source_name, metric_name, metric_value from (select observation_id, source_name, 'citation_count' metric_name, cast(citation_count as double) metric_value from source_work_observations
union all select observation_id, source_name, 'influential_citation_count', cast(influential_citation_count as double) from source_work_observations) where metric_value > 0""")
def metrics_unpivot(spark: SparkSession, d: str) -> DataFrame:
    return unpivoted_metrics(table(spark, d, "source_work_observations", "observation_id", "source_name", "citation_count", "influential_citation_count").distinct())


@query("""select 'canonical_citations' table_name, 'primary key' as rule, count(*) n from (select 1 from canonical_citations group by citing_work_id, cited_work_id having count(*) > 1)
union all select 'canonical_work_identifiers', 'primary key', count(*) from (select 1 from canonical_work_identifiers group by identifier_type, normalized_value having count(*) > 1)
union all select 'canonical_authors', 'primary key', count(*) from (select 1 from canonical_authors group by canonical_author_id having count(*) > 1)
union all select 'canonical_authors', 'unique orcid', count(*) from (select 1 from canonical_authors where orcid is not null group by orcid having count(*) > 1)
union all select 'canonical_works', 'primary key', count(*) from (select 1 from canonical_works group by canonical_work_id having count(*) > 1)
union all select 'canonical_works', 'unique canonical_doi', count(*) from (select 1 from canonical_works where canonical_doi is not null group by canonical_doi having count(*) > 1)
union all select 'canonical_works', 'unique canonical_arxiv_id', count(*) from (select 1 from canonical_works where canonical_arxiv_id is not null group by canonical_arxiv_id having count(*) > 1)
union all select 'source_work_observations', 'primary key', count(*) from (select 1 from source_work_observations group by observation_id having count(*) > 1)
union all select 'canonical_work_provenance', 'primary key', count(*) from (select 1 from canonical_work_provenance group by canonical_work_id, attribute_name having count(*) > 1)
union all select 'canonical_work_provenance', 'foreign key source_observation_id', count(*) from (select distinct source_observation_id from canonical_work_provenance where source_observation_id is not null and source_observation_id not in (select observation_id from source_work_observations where observation_id is not null))""".replace("union all", "\nunion all"))
def constraint_check(spark: SparkSession, d: str) -> DataFrame:
    names = ("canonical_citations", "canonical_work_identifiers", "canonical_authors", "canonical_works", "source_work_observations", "canonical_work_provenance")
    return violations({n: table(spark, d, n) for n in names})


SQL["constraint_check"] = f"select * from ({SQL['constraint_check']}) where n > 0"


@query("select user_id, event_type, count(*) n, cast(min(ts) as timestamp) first_ts from events group by 1, 2 qualify row_number() over (partition by user_id order by n desc, event_type) <= 2")
def top_events(spark: SparkSession, d: str) -> DataFrame:
    """The two most frequent event types of each user; ties by type."""
    n = table(spark, d, "events", "user_id", "event_type", "ts").groupBy("user_id", "event_type").agg(F.count("*").alias("n"), F.min("ts").alias("first_ts"))
    return n.withColumn("r", F.row_number().over(Window.partitionBy("user_id").orderBy(F.desc("n"), "event_type"))).where("r <= 2").drop("r")


@query(None)
def resolved_gold(spark: SparkSession, d: str) -> DataFrame:
    """The works that the three raw sources, ingested one after the other, resolve to."""
    from folioflow.operators.common import written
    from folioflow.operators.resolve import gold

    log = None
    for no, s in enumerate(("openalex", "crossref", "semantic_scholar")):
        lines = table(spark, d, f"sample_{s}", "record_no", "payload").select(F.col("record_no").alias("line_idx"), tx.strip(F.col("payload")).alias("line")).where("line <> ''")
        seen = None if log is None else log.select("payload_hash")
        one = prepared(lines, s, seen, AS_OF).where("outcome = 'accepted'").select(F.lit(no).cast("bigint").alias("run_no"), F.lit(f"run_{s}").alias("run_id"), "line_idx", F.concat(F.lit(f"obs_run_{s}_"), F.col("line_idx").cast("string")).alias("observation_id"), "work", "payload_hash")
        log = written(one if log is None else log.unionByName(one), "log")
    return gold(log, F.lit("2026-01-01").cast("timestamp"))["canonical_works"].drop("created_at", "updated_at")

