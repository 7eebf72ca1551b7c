"""Data quality rules over parsed works; each is a column expression, together they run in the fixed order 02, 01, 03, 04, 05."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.functions import identifiers as ids
from folioflow.functions.text import none_if_empty, strip

#: Titles that say nothing.
PLACEHOLDER_TITLES = ("[untitled]", "untitled", "none", "unknown", "n/a", "na", "null", "")
FIRST_YEAR = 1665


def title_incomplete(title: Column) -> Column:
    """DQ-02: a title of less than three characters or a placeholder; null counts as empty."""
    clean = F.coalesce(strip(title), F.lit(""))
    return (F.length(clean) < 3) | F.lower(clean).isin(*PLACEHOLDER_TITLES)


def year_in_bounds(year: Column, as_of_year: int) -> Column:
    """DQ-03: whether a year lies between FIRST_YEAR and the year after as_of_year."""
    return year.between(FIRST_YEAR, as_of_year + 1)


def is_self_citation(c: Column, doi: Column, arxiv: Column, source_work_id: Column) -> Column:
    """DQ-04: whether a citation names its own work by DOI, arXiv id or source id; empty values name nothing."""
    same = lambda a, b: F.coalesce((none_if_empty(a) == b), F.lit(False))
    return same(doi, c["cited_doi"]) | same(arxiv, c["cited_arxiv_id"]) | same(source_work_id, c["cited_source_id"])


def check(parsed: DataFrame, as_of_year: int) -> DataFrame:
    """parsed with its works sanitised, `warnings`, and error_type DQ-02_TITLE_INCOMPLETE where the title fails.

    Valid identifiers stay as they are, invalid ones and years out of bounds become
    null (the date stays), self-citations and blank names go, the other names are
    stripped and numbered from 1, ORCIDs normalised or dropped. Rows that have an error
    already, or fail the title rule, keep their work unchanged and without warnings.
    """
    w = F.col("work")
    bad_title = F.col("error_type").isNull() & title_incomplete(w["title"])
    out = parsed.withColumn("_bad", F.coalesce(bad_title, F.lit(False)))
    fine = F.col("error_type").isNull() & ~F.col("_bad")
    doi_ok = w["normalized_doi"].isNull() | ids.doi(w["normalized_doi"]).isNotNull()
    arxiv_ok = w["normalized_arxiv_id"].isNull() | ids.arxiv_id(w["normalized_arxiv_id"]).isNotNull()
    year_ok = w["publication_year"].isNull() | year_in_bounds(w["publication_year"], as_of_year)
    out = out.withColumn("_doi", F.when(doi_ok, w["normalized_doi"])).withColumn("_arxiv", F.when(arxiv_ok, w["normalized_arxiv_id"]))
    kept = F.filter(w["citations"], lambda c: ~is_self_citation(c, F.col("_doi"), F.col("_arxiv"), w["source_work_id"]))
    named = F.filter(w["authors"], lambda a: F.coalesce(strip(a["raw_name"]) != "", F.lit(False)))
    people = F.transform(named, lambda a, i: a.withField("raw_name", strip(a["raw_name"])).withField("position", (i + 1).cast("int")).withField("orcid", ids.orcid(a["orcid"])))
    bad_orcids = F.size(F.filter(named, lambda a: F.coalesce(a["orcid"] != "", F.lit(False)) & ids.orcid(a["orcid"]).isNull()))
    warnings = F.filter(
        F.array(
            F.when(~doi_ok, F.concat(F.lit("DQ-01: invalid DOI "), w["normalized_doi"])),
            F.when(~arxiv_ok, F.concat(F.lit("DQ-01: invalid arXiv id "), w["normalized_arxiv_id"])),
            F.when(~year_ok, F.concat(F.lit("DQ-03: year out of bounds "), w["publication_year"].cast("string"))),
            F.when(F.size(kept) < F.size(w["citations"]), F.concat(F.lit("DQ-04: self-citations dropped "), (F.size(w["citations"]) - F.size(kept)).cast("string"))),
            F.when(F.size(named) < F.size(w["authors"]), F.concat(F.lit("DQ-05: blank names dropped "), (F.size(w["authors"]) - F.size(named)).cast("string"))),
            F.when(bad_orcids > 0, F.concat(F.lit("DQ-01: invalid ORCIDs dropped "), bad_orcids.cast("string"))),
        ),
        lambda x: x.isNotNull(),
    )
    clean = w.withField("normalized_doi", F.col("_doi")).withField("normalized_arxiv_id", F.col("_arxiv")).withField("publication_year", F.when(year_ok, w["publication_year"])).withField("citations", kept).withField("authors", people)
    return (
        out.withColumn("warnings", F.when(fine, warnings).otherwise(F.array().cast("array<string>")))
        .withColumn("work", F.when(fine, clean).otherwise(w))
        .withColumn("error_message", F.when(F.col("_bad"), F.concat(F.lit("title too short or a placeholder: "), F.coalesce(w["title"], F.lit("")))).otherwise(F.col("error_message")))
        .withColumn("error_type", F.when(F.col("_bad"), "DQ-02_TITLE_INCOMPLETE").otherwise(F.col("error_type")))
        .drop("_bad", "_doi", "_arxiv")
    )
