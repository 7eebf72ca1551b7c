"""The four sources: how a record of each becomes a work."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioflow.functions import identifiers as ids
from folioflow.functions.text import SPACE, clean_text, none_if_empty, plain_tex, strip, without_tags
from folioflow.sources.records import CITATION, author, citation, count, dated, external_ids, field, items, kept, kind, register, text, wrong_kind


def _first_error(*rules: tuple[Column, str]) -> Column:
    out = F.lit(None).cast("string")
    for broken, said in reversed(rules):
        out = F.when(F.coalesce(broken, F.lit(False)), said).otherwise(out)
    return out


def _not_objects(array: Column) -> Column:
    return F.exists(array, lambda x: ~F.coalesce(F.schema_of_variant(x).startswith("OBJECT"), F.lit(False)))


@register("arxiv")
def arxiv(v: Column) -> tuple[dict[str, Column], Column]:
    """arXiv records: TeX titles, dates from several fields or the id, names as [surname, forename, affiliation]."""
    raw_id = F.coalesce(strip(field(v, "$.id")), F.lit(""))
    arxiv_id = ids.arxiv_id(raw_id)
    doi = ids.doi(field(v, "$.doi"))
    versions = items(v, "$.versions")
    last = F.when(F.size(versions) > 0, F.try_variant_get(F.element_at(versions, -1), "$.created", "string"))
    written = F.coalesce(text(v, "$.update_date"), text(v, "$.created"), last)
    found = F.regexp_extract(written, r"[0-9]{4}-[0-9]{2}-[0-9]{2}", 0)
    by_text = F.try_to_date(none_if_empty(found), "yyyy-MM-dd")
    yy = F.regexp_extract(field(v, "$.id"), r"^([0-9]{2})[0-9]{2}\.[0-9]+", 1)
    by_id = F.when(yy != "", F.try_to_date(F.concat(F.when(yy.cast("int") < 90, "20").otherwise("19"), yy, F.lit("-01-01")), "yyyy-MM-dd"))
    date = F.coalesce(by_text, by_id)

    def parsed_name(x: Column) -> Column:
        parts = F.try_variant_get(x, "$", "array<variant>")
        part = lambda i: F.coalesce(strip(F.try_variant_get(F.try_element_at(parts, F.lit(i)), "$", "string")), F.lit(""))
        name = F.when(F.size(parts) >= 2, F.when(part(2) != "", strip(F.concat(part(2), F.lit(" "), part(1)))).otherwise(part(1)))
        return F.struct(name.alias("n"), none_if_empty(part(3)).alias("a"))

    listed = kept(F.transform(items(v, "$.authors_parsed"), parsed_name), "n")
    one_text = F.when(kind(v, "$.authors") == "STRING", field(v, "$.authors"))
    split = kept(F.transform(F.split(one_text, rf",{SPACE}*|{SPACE}+and{SPACE}+"), lambda x: F.struct(strip(x).alias("n"), F.lit(None).cast("string").alias("a"))), "n")
    names = F.when(F.coalesce(kind(v, "$.authors_parsed").startswith("ARRAY"), F.lit(False)), listed).otherwise(F.coalesce(split, F.array().cast("array<struct<n:string,a:string>>")))
    venue = F.coalesce(strip(F.coalesce(text(v, "$['journal-ref']"), text(v, "$.journal_ref"))), F.lit("arXiv.org"))
    parts = {
        "source_work_id": F.coalesce(none_if_empty(raw_id), arxiv_id, F.lit("unknown")),
        "title": plain_tex(field(v, "$.title")),
        "abstract": plain_tex(F.coalesce(text(v, "$.abstract"), text(v, "$.summary"))),
        "publication_year": F.year(date), "publication_date": date,
        "normalized_doi": doi, "normalized_arxiv_id": arxiv_id,
        "raw_venue_name": venue, "venue_type": F.when(venue == "arXiv.org", "PREPRINT_SERVER").otherwise("JOURNAL"),
        "citation_count": F.lit(0),
        "authors": F.transform(names, lambda x, i: author(x["n"], i + 1, affiliation=x["a"])),
        "external_ids": external_ids(("ARXIV", arxiv_id), ("DOI", doi)),
    }
    return parts, _first_error((wrong_kind(v, "$.title", "STRING"), "title is no text"), (wrong_kind(v, "$.abstract", "STRING"), "abstract is no text"))


def inverted_abstract(v: Column, path: str) -> Column:
    """The text of an inverted index {word: [places]}: words by place, of two words at one place the later one."""
    index = F.map_entries(F.coalesce(F.try_variant_get(v, path, "map<string,array<int>>"), F.create_map().cast("map<string,array<int>>")))
    placed = F.flatten(F.transform(index, lambda e, k: F.transform(F.coalesce(e["value"], F.array().cast("array<int>")), lambda p: F.struct(p.alias("p"), k.alias("k"), e["key"].alias("w")))))
    order = F.array_sort(F.filter(placed, lambda x: x["p"] >= 0))
    winners = F.filter(order, lambda x, i: (i + 1 == F.size(order)) | (F.try_element_at(order, (i + 2).cast("int"))["p"] != x["p"]))
    return clean_text(F.array_join(F.filter(F.transform(winners, lambda x: x["w"]), lambda w: w != ""), " "))


@register("openalex")
def openalex(v: Column) -> tuple[dict[str, Column], Column]:
    """OpenAlex records: inverted abstracts, authorships with institutions, references by id."""
    raw_id = F.coalesce(strip(field(v, "$.id")), F.lit(""))
    doi = ids.doi(F.coalesce(text(v, "$.doi"), text(v, "$.ids.doi")))
    date, year = dated(v, "$.publication_year", "$.publication_date")
    ships = items(v, "$.authorships")

    def one(x: Column, i: Column) -> Column:
        at = lambda p: none_if_empty(F.try_variant_get(x, p, "string"))
        inst = at("$.institutions[0].display_name")
        return author(F.coalesce(at("$.author.display_name"), at("$.raw_author_name")), i + 1, ids.orcid(at("$.author.orcid")), at("$.author.id"), F.coalesce(at("$.raw_affiliation_string"), inst), inst, ids.ror(at("$.institutions[0].ror")), at("$.institutions[0].country_code"))

    refs = F.filter(F.transform(items(v, "$.referenced_works"), lambda x: F.when(F.schema_of_variant(x) == "STRING", strip(F.try_variant_get(x, "$", "string")))), lambda x: F.coalesce(x != "", F.lit(False)))
    parts = {
        "source_work_id": raw_id,
        "title": F.coalesce(clean_text(F.coalesce(text(v, "$.title"), text(v, "$.display_name"))), F.lit("")),
        "abstract": inverted_abstract(v, "$.abstract_inverted_index"),
        "publication_year": year, "publication_date": date, "normalized_doi": doi,
        "raw_venue_name": field(v, "$.primary_location.source.display_name"), "venue_issn": field(v, "$.primary_location.source.issn_l"),
        "venue_type": F.coalesce(F.upper(field(v, "$.primary_location.source.type")), F.lit("UNSPECIFIED")),
        "citation_count": count(v, "$.cited_by_count"),
        "authors": kept(F.transform(ships, one), "raw_name"),
        "citations": F.transform(refs, lambda x: citation(source_id=x)).cast(f"array<{CITATION}>"),
        "external_ids": external_ids(("OPENALEX", raw_id), ("DOI", doi), ("MAG", field(v, "$.ids.mag")), ("PMID", field(v, "$.ids.pmid"))),
    }
    return parts, _first_error(
        (wrong_kind(v, "$.title", "STRING"), "title is no text"),
        (kind(v, "$.primary_location.source.type") == "VOID", "venue type is null"),
        (_not_objects(ships), "an authorship is no object"),
        (wrong_kind(v, "$.publication_year", "BIGINT"), "publication_year is no integer"),
        (field(v, "$.cited_by_count").isNotNull() & field(v, "$.cited_by_count", "double").isNull(), "cited_by_count is no number"),
    )


@register("crossref")
def crossref(v: Column) -> tuple[dict[str, Column], Column]:
    """Crossref records: titles in lists, JATS abstracts, date-parts, given and family names, references by DOI."""
    raw_doi = F.coalesce(field(v, "$.DOI"), F.lit(""))
    doi = ids.doi(raw_doi)
    title = F.when(kind(v, "$.title") == "STRING", field(v, "$.title")).otherwise(field(v, "$.title[0]"))
    parts_of = [F.when(F.size(field(v, f"$['{k}']['date-parts'][0]", "array<variant>")) > 0, field(v, f"$['{k}']['date-parts'][0]", "array<int>")) for k in ("published-print", "published-online", "issued", "created")]
    chosen = F.coalesce(*parts_of)
    part = lambda i, d: F.when(F.size(chosen) >= i, F.try_element_at(chosen, F.lit(i))).otherwise(F.lit(d))
    year = F.when(chosen.isNotNull(), F.try_element_at(chosen, F.lit(1)))
    date = F.try_to_date(F.format_string("%04d-%02d-%02d", year, part(2, 1), part(3, 1)), "yyyy-MM-dd")
    people, refs = items(v, "$.author"), items(v, "$.reference")

    def one(x: Column, i: Column) -> Column:
        at = lambda p: F.try_variant_get(x, p, "string")
        name = strip(F.concat_ws(" ", none_if_empty(strip(at("$.given"))), F.coalesce(strip(at("$.family")), F.lit(""))))
        return author(name, i + 1, ids.orcid(at("$.ORCID")), affiliation=at("$.affiliation[0].name"))

    def cited(x: Column) -> Column:
        return citation(doi=ids.doi(F.try_variant_get(x, "$.DOI", "string")), raw=none_if_empty(F.try_variant_get(x, "$.unstructured", "string")))

    parts = {
        "source_work_id": raw_doi,
        "title": F.coalesce(clean_text(title), F.lit("")),
        "abstract": without_tags(text(v, "$.abstract")),
        "publication_year": year, "publication_date": date, "normalized_doi": doi,
        "raw_venue_name": field(v, "$['container-title'][0]"), "venue_issn": field(v, "$.ISSN[0]"),
        "venue_type": F.when(F.contains(field(v, "$.type"), F.lit("journal")), "JOURNAL").otherwise("CONFERENCE"),
        "citation_count": count(v, "$['is-referenced-by-count']"),
        "authors": kept(F.transform(people, one), "raw_name"),
        "citations": F.filter(F.transform(refs, cited).cast(f"array<{CITATION}>"), lambda c: c["cited_doi"].isNotNull() | c["raw_citation_string"].isNotNull()),
        "external_ids": external_ids(("DOI", doi)),
    }
    return parts, _first_error(
        (kind(v, "$.type") == "VOID", "type is null"),
        (wrong_kind(v, "$.abstract", "STRING"), "abstract is no text"),
        (_not_objects(people), "an author is no object"),
        (_not_objects(refs), "a reference is no object"),
        (field(v, "$['is-referenced-by-count']").isNotNull() & field(v, "$['is-referenced-by-count']", "double").isNull(), "is-referenced-by-count is no number"),
    )


@register("semantic_scholar")
def semantic_scholar(v: Column) -> tuple[dict[str, Column], Column]:
    """Semantic Scholar records: several external ids, citations with intents as outgoing edges."""
    paper = F.coalesce(strip(field(v, "$.paperId")), F.lit(""))
    corpus = none_if_empty(field(v, "$.corpusId"))
    corpus = F.when(corpus != "0", corpus)
    doi, arxiv_id = ids.doi(field(v, "$.externalIds.DOI")), ids.arxiv_id(field(v, "$.externalIds.ArXiv"))
    date, year = dated(v, "$.year", "$.publicationDate")
    people, cites = items(v, "$.authors"), items(v, "$.citations")

    def one(x: Column, i: Column) -> Column:
        return author(F.coalesce(strip(F.try_variant_get(x, "$.name", "string")), F.lit("")), i + 1, source_id=none_if_empty(F.try_variant_get(x, "$.authorId", "string")))

    def cited(x: Column) -> Column:
        intents = F.transform(F.coalesce(F.try_variant_get(x, "$.intents", "array<variant>"), F.array().cast("array<variant>")), lambda i: F.upper(F.coalesce(F.try_variant_get(i, "$", "string"), F.lit("NONE"))))
        return citation(source_id=none_if_empty(strip(F.try_variant_get(x, "$.paperId", "string"))), influential=F.coalesce(F.try_variant_get(x, "$.isInfluential", "boolean"), F.lit(False)), intents=intents)

    parts = {
        "source_work_id": F.coalesce(none_if_empty(paper), corpus, F.lit("unknown")),
        "title": F.coalesce(clean_text(field(v, "$.title")), F.lit("")),
        "abstract": clean_text(field(v, "$.abstract")),
        "publication_year": year, "publication_date": date, "normalized_doi": doi, "normalized_arxiv_id": arxiv_id,
        "raw_venue_name": F.coalesce(text(v, "$.publicationVenue.name"), field(v, "$.venue")), "venue_issn": field(v, "$.publicationVenue.issn"),
        "venue_type": F.coalesce(F.upper(field(v, "$.publicationVenue.type")), F.lit("UNSPECIFIED")),
        "citation_count": count(v, "$.citationCount"), "influential_citation_count": count(v, "$.influentialCitationCount"),
        "authors": kept(F.transform(people, one), "raw_name"),
        "citations": F.filter(F.transform(cites, cited).cast(f"array<{CITATION}>"), lambda c: c["cited_source_id"].isNotNull()),
        "external_ids": external_ids(("S2_PAPER_ID", paper), ("CORPUS_ID", corpus), ("DOI", doi), ("ARXIV", arxiv_id), ("PUBMED", field(v, "$.externalIds.PubMed")), ("DBLP", field(v, "$.externalIds.DBLP"))),
    }
    return parts, _first_error(
        (wrong_kind(v, "$.title", "STRING"), "title is no text"),
        (wrong_kind(v, "$.abstract", "STRING"), "abstract is no text"),
        (kind(v, "$.publicationVenue.type") == "VOID", "venue type is null"),
        (_not_objects(people), "an author is no object"),
        (_not_objects(cites), "a citation is no object"),
        (wrong_kind(v, "$.year", "BIGINT"), "year is no integer"),
    )
