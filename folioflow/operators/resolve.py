"""Order-dependent entity resolution as set operations.

Every accepted record is an identity event with its keys in order, followed by
its citation events. Whatever comes first to a key registers it: an identity
event for each of its keys, a citation event for a target not known yet (which
makes a stub). So the registrant of a key is the smallest event number that has
it, and the owner of an event is found without replaying the log: an identity
event belongs to the registrant of its first key that was registered before it,
otherwise it founds a work; following these pointers (each to an earlier event)
by pointer doubling gives every event its work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioflow.functions import identifiers as ids
from folioflow.functions.text import none_if_empty, slug, strip
from folioflow.operators.common import written

#: The authority of the sources, lower wins; others have 99.
PRIORITIES = {
    "title": {"crossref": 1, "openalex": 2, "semantic_scholar": 3, "arxiv": 4},
    "abstract": {"semantic_scholar": 1, "arxiv": 2, "openalex": 3, "crossref": 4},
    "publication_date": {"crossref": 1, "openalex": 2, "semantic_scholar": 3, "arxiv": 4},
    "venue": {"crossref": 1, "openalex": 2, "semantic_scholar": 3, "arxiv": 4},
}


def priority(attribute: str, source: Column) -> Column:
    out = F.lit(99)
    for name, p in PRIORITIES[attribute].items():
        out = F.when(F.lower(source) == name, p).otherwise(out)
    return out


def keys_of(work: Column) -> Column:
    """The keys of a work in lookup order: DOI, arXiv id, then other ids as they came; array of (type, value, raw)."""
    key = lambda t, v, r: F.struct(t.alias("type"), v.alias("value"), r.alias("raw"))
    own = F.array(key(F.lit("DOI"), work["normalized_doi"], work["normalized_doi"]), key(F.lit("ARXIV"), work["normalized_arxiv_id"], work["normalized_arxiv_id"]))
    others = F.transform(F.filter(work["external_ids"], lambda x: ~x["type"].isin("DOI", "ARXIV")), lambda x: key(F.upper(x["type"]), F.lower(strip(x["value"])), strip(x["value"])))
    return F.filter(F.concat(own, others), lambda x: F.coalesce(x["value"] != "", F.lit(False)))


def anchor(work: Column, keys: Column) -> Column:
    """What a new work's id is minted from: DOI, arXiv id, the first other key, else source and source id."""
    first = F.try_element_at(keys, F.lit(1))
    return F.coalesce(F.concat(F.lit("doi:"), work["normalized_doi"]), F.concat(F.lit("arxiv:"), work["normalized_arxiv_id"]), F.concat(F.lower(first["type"]), F.lit(":"), first["value"]), F.concat(F.lit("cluster:"), work["source_name"], F.lit(":"), work["source_work_id"]))


def events(accepted: DataFrame) -> DataFrame:
    """accepted (run_no, line_idx, observation_id, work) as events with a global number seq.

    seq is a (run, line, place) struct: place 0 is the identity event, i the i-th citation.
    """
    base = accepted.withColumn("keys", keys_of(F.col("work")))
    at = lambda place: F.struct("run_no", "line_idx", place.cast("int").alias("place"))
    identity = base.select(at(F.lit(0)).alias("seq"), F.lit("identity").alias("kind"), "keys", anchor(F.col("work"), F.col("keys")).alias("anchor"), F.col("work.source_name").alias("source"), F.lit(None).cast("string").alias("title"), F.lit(None).cast("string").alias("loose"), F.lit(None).cast("struct<is_influential:boolean,citation_intents:array<string>>").alias("edge"), F.col("observation_id"))
    c = F.col("c")
    cited = base.select("run_no", "line_idx", "observation_id", F.col("work.source_name").alias("source"), F.posexplode("work.citations").alias("i", "c"))
    doi, arxiv, loose = none_if_empty(c["cited_doi"]), none_if_empty(c["cited_arxiv_id"]), F.lower(strip(none_if_empty(c["cited_source_id"])))
    kind_of_loose = F.when(F.col("source") == "semantic_scholar", "S2_PAPER_ID").otherwise("OPENALEX")
    one_key = F.when(doi.isNotNull(), F.struct(F.lit("DOI").alias("type"), doi.alias("value"), doi.alias("raw"))).when(arxiv.isNotNull(), F.struct(F.lit("ARXIV").alias("type"), arxiv.alias("value"), arxiv.alias("raw"))).when(loose.isNotNull(), F.struct(kind_of_loose.alias("type"), loose.alias("value"), loose.alias("raw")))
    minted = F.coalesce(F.concat(F.lit("doi:"), doi), F.concat(F.lit("arxiv:"), arxiv), F.concat(F.lit("cluster:"), F.col("source"), F.lit(":"), loose))
    citing = cited.where(F.coalesce(doi, arxiv, loose).isNotNull()).select(at(F.col("i") + 1).alias("seq"), F.lit("citation").alias("kind"), F.array(one_key).alias("keys"), minted.alias("anchor"), "source", F.concat(F.lit("[Stub Citation: "), F.coalesce(doi, arxiv, loose), F.lit("]")).alias("title"), F.when(doi.isNull() & arxiv.isNull(), loose).alias("loose"), F.struct(c["is_influential"].alias("is_influential"), c["citation_intents"].alias("citation_intents")).alias("edge"), "observation_id")
    return identity.unionByName(citing)


def owners(ev: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(owned, registered): events with canonical_work_id and whether they founded it, and the identifier table.

    registered has (type, value, raw, canonical_work_id, seq). Typed keys are looked up by type and value, loose
    ones (citations by source id) by value alone, where the earliest registration of any type counts.
    """
    mention = ev.select("seq", "kind", "loose", F.posexplode("keys").alias("i", "k")).select("seq", "kind", "loose", "i", F.col("k.type").alias("type"), F.col("k.value").alias("value"), F.col("k.raw").alias("raw"))
    typed = mention.where("loose is null")
    # A loose citation registers its key only where nothing of that value was there before.
    first_typed = typed.groupBy("value").agg(F.min("seq").alias("first_typed"))
    first_loose = mention.where("loose is not null").groupBy("value").agg(F.min(F.struct("seq", "type", "raw")).alias("m")).select("value", F.col("m.seq").alias("seq"), F.col("m.type").alias("type"), F.col("m.raw").alias("raw"))
    stubs = first_loose.join(first_typed, "value", "left").where("first_typed is null or seq < first_typed").select("type", "value", "raw", "seq")
    registered = written(typed.select("type", "value", "raw", "seq").unionByName(stubs).groupBy("type", "value").agg(F.min(F.struct("seq", "raw")).alias("r")).select("type", "value", F.col("r.seq").alias("reg"), F.col("r.raw").alias("raw")), "registered")
    by_value = registered.groupBy("value").agg(F.min("reg").alias("reg"))
    hits_typed = typed.join(registered.select("type", "value", "reg"), ["type", "value"]).where("reg < seq").groupBy("seq").agg(F.min(F.struct("i", "reg")).alias("h")).select("seq", F.col("h.reg").alias("parent"))
    hits_loose = mention.where("loose is not null").join(by_value, "value").where("reg < seq").select("seq", F.col("reg").alias("parent"))
    parent = ev.select("seq", "anchor").join(hits_typed.unionByName(hits_loose), "seq", "left").select("seq", "parent", ids.work_id(F.col("anchor")).alias("minted"))
    # Pointer doubling: parents are earlier events, so every chain ends at a founder after log2(length) rounds.
    pointer = written(parent.select("seq", F.coalesce("parent", "seq").alias("at")), "pointer")
    while True:
        step = pointer.join(pointer.select(F.col("seq").alias("at"), F.col("at").alias("beyond")), "at").select("seq", F.col("beyond").alias("at"), (F.col("beyond") != F.col("at")).alias("moved"))
        step = written(step, "pointer")
        pointer = step.select("seq", "at")
        if step.where("moved").isEmpty():
            break
    founder = parent.select(F.col("seq").alias("at"), "minted")
    named = written(pointer.join(founder, "at").select("seq", F.col("minted").alias("canonical_work_id"), (F.col("at") == F.col("seq")).alias("founded")), "named")
    owned = ev.join(named, "seq")
    identifiers = registered.join(named.select(F.col("seq").alias("reg"), "canonical_work_id"), "reg").select("type", "value", "raw", "canonical_work_id", F.col("reg").alias("seq"))
    return owned, identifiers


def winner(candidates: DataFrame, attribute: str, group: str = "canonical_work_id") -> DataFrame:
    """(group, source, observation_id, value, rule): of each group's candidates (seq, is_first, source, observation_id, value)
    the one that wins the attribute.

    The best priority wins and among equals the last, which is where applying records one
    by one ends when each takes over at equal or better priority. The first record of a
    work is a candidate even with a null value and then keeps others of less authority out.
    """
    rank = F.struct((-priority(attribute, F.col("source"))).alias("p"), F.col("seq"))
    best = candidates.groupBy(group).agg(F.max_by(F.struct("source", "observation_id", "value", "is_first", "after_stub"), rank).alias("w"))
    rule = F.when(~F.col("w.is_first"), "PRIORITY_OVERRIDE").when(F.col("w.after_stub"), "STUB_UPGRADE").otherwise("INITIAL_CREATION")
    return best.select(group, F.col("w.source").alias("source"), F.col("w.observation_id").alias("observation_id"), F.col("w.value").alias("value"), rule.alias("rule"))


def accepted_dates(candidates: DataFrame, group: str = "canonical_work_id") -> DataFrame:
    """(group, publication_date): the last date that is not null among the candidates accepted in their turn.

    One is accepted when its priority is no worse than the best before it; a null date leaves the one there is.
    """
    w = Window.partitionBy(group).orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    p = candidates.withColumn("p", priority("publication_date", F.col("source"))).withColumn("best", F.min("p").over(w))
    return p.where("best is null or p <= best").where("date is not null").groupBy(group).agg(F.max_by("date", "seq").alias("publication_date"))


def gold(accepted: DataFrame, at: Column) -> dict[str, DataFrame]:
    """The gold tables from all accepted records (run_no, run_id, line_idx, observation_id, work); `at` stamps them.

    A pure function of the record log: the same log gives the same tables, in whatever
    batches it came. Works without any key whose source gives them one id are the same
    work. Where two works would carry one DOI or arXiv id the later one's is null.
    """
    ev = written(events(accepted), "events")
    owned, identifiers = owners(ev)
    owned = written(owned, "owned")
    works_of = owned.where("kind = 'identity'").select("observation_id", "canonical_work_id", "seq")
    full = accepted.join(works_of, "observation_id")
    first = works_of.groupBy("canonical_work_id").agg(F.min("seq").alias("first_seq"))
    stub = owned.where("kind = 'citation' and founded").groupBy("canonical_work_id").agg(F.min(F.struct("seq", "source", "title", "keys")).alias("s")).select("canonical_work_id", F.col("s.seq").alias("stub_seq"), F.col("s.source").alias("stub_source"), F.col("s.title").alias("stub_title"), F.filter("s.keys", lambda k: k["type"].isin("DOI", "ARXIV")).alias("stub_keys"))
    w = F.col("work")
    named_venue = none_if_empty(w["raw_venue_name"]).isNotNull() & (slug(w["raw_venue_name"]) != "")
    venue_key = F.when(named_venue, ids.venue_id(w["raw_venue_name"], w["venue_issn"]))
    full = full.join(first, "canonical_work_id").join(stub.select("canonical_work_id", "stub_seq"), "canonical_work_id", "left").withColumn("is_first", F.col("seq") == F.col("first_seq")).withColumn("after_stub", F.coalesce(F.col("stub_seq") < F.col("first_seq"), F.lit(False))).withColumn("venue_id", venue_key)
    full = written(full, "full")

    def candidates(value: Column, gate: Column) -> DataFrame:
        return full.where(F.col("is_first") | F.coalesce(gate, F.lit(False))).select("canonical_work_id", "seq", "is_first", "after_stub", w["source_name"].alias("source"), "observation_id", value.alias("value"), w["publication_date"].alias("date"))

    has = lambda c: none_if_empty(c).isNotNull()
    dates = candidates(w["publication_year"].cast("string"), w["publication_year"] != 0)
    won = {
        "title": winner(candidates(w["title"], has(w["title"])), "title"),
        "abstract": winner(candidates(w["abstract"], has(w["abstract"])), "abstract"),
        "publication_date": winner(dates, "publication_date"),
        "venue": winner(candidates(F.col("venue_id"), F.col("venue_id").isNotNull()), "venue"),
    }
    provenance = None
    for attribute, df in won.items():
        one = df.select("canonical_work_id", F.lit(attribute).alias("attribute_name"), F.col("source").alias("winning_source"), F.col("observation_id").alias("source_observation_id"), F.col("rule").alias("resolution_rule"), at.alias("selected_at"))
        provenance = one if provenance is None else provenance.unionByName(one)

    value_of = lambda name, alias: won[name].select("canonical_work_id", F.col("value").alias(alias))
    facts = full.groupBy("canonical_work_id").agg(
        F.max(w["citation_count"]).alias("citation_count"), F.max(w["influential_citation_count"]).alias("influential_citation_count"),
        F.min_by(F.struct(w["normalized_doi"].alias("doi"), w["normalized_arxiv_id"].alias("arxiv")), "seq").alias("f"),
    )
    key_value = lambda t: F.element_at(F.transform(F.filter("stub_keys", lambda k: k["type"] == t), lambda k: k["value"]), 1)
    every = facts.join(stub, "canonical_work_id", "full_outer")
    pick = lambda t: F.when(F.size(F.filter("stub_keys", lambda k: k["type"] == t)) > 0, key_value(t))
    every = every.withColumn("doi", F.coalesce(F.col("f.doi"), pick("DOI"))).withColumn("arxiv", F.coalesce(F.col("f.arxiv"), pick("ARXIV")))
    born = owned.where("founded").groupBy("canonical_work_id").agg(F.min("seq").alias("born"))
    every = every.join(born, "canonical_work_id")
    for c in ("doi", "arxiv"):  # of works that would share one, the first founded keeps it
        keeps = every.where(F.col(c).isNotNull()).groupBy(c).agg(F.min("born").alias("keeps"))
        every = every.join(keeps, c, "left").withColumn(c, F.when(F.col("born") == F.col("keeps"), F.col(c))).drop("keeps")
    works = (
        every.join(value_of("title", "won_title"), "canonical_work_id", "left").join(value_of("abstract", "abstract"), "canonical_work_id", "left")
        .join(value_of("publication_date", "won_year"), "canonical_work_id", "left").join(accepted_dates(dates), "canonical_work_id", "left")
        .join(value_of("venue", "canonical_venue_id"), "canonical_work_id", "left")
        .select(
            "canonical_work_id", F.coalesce("won_title", "stub_title").alias("title"), "abstract", F.col("won_year").cast("int").alias("publication_year"), "publication_date",
            F.col("doi").alias("canonical_doi"), F.col("arxiv").alias("canonical_arxiv_id"), "canonical_venue_id", F.col("f").isNull().alias("is_stub"),
            F.when(F.col("f").isNull(), "DANGLING_CITATION_TARGET").alias("stub_reason"), F.col("stub_source").alias("created_from_source"),
            F.coalesce("citation_count", F.lit(0)).alias("citation_count"), F.coalesce("influential_citation_count", F.lit(0)).alias("influential_citation_count"), at.alias("created_at"), at.alias("updated_at"),
        )
    )
    venues = full.where("venue_id is not null").groupBy(F.col("venue_id").alias("canonical_venue_id")).agg(F.min_by(F.struct(w["raw_venue_name"].alias("name"), slug(w["raw_venue_name"]).alias("normalized_name"), F.coalesce(none_if_empty(w["venue_type"]), F.lit("UNSPECIFIED")).alias("venue_type"), w["venue_issn"].alias("issn")), "seq").alias("v")).select("canonical_venue_id", "v.name", "v.normalized_name", "v.venue_type", F.lit("UNRANKED").alias("tier"), "v.issn", at.alias("created_at"))
    a = F.col("a")
    people = full.select("canonical_work_id", "seq", F.posexplode("work.authors").alias("i", "a"))
    with_inst = none_if_empty(a["institution_name"]).isNotNull() | none_if_empty(a["institution_ror"]).isNotNull()
    people = people.select("canonical_work_id", F.struct("seq", "i").alias("seq"), "a", ids.author_id(a["orcid"], a["source_author_id"], a["raw_name"]).alias("canonical_author_id"), F.when(with_inst, ids.institution_id(a["institution_ror"], a["institution_name"])).alias("canonical_inst_id"))
    people = written(people, "people")
    authors = people.groupBy("canonical_author_id").agg(F.min_by(a["raw_name"], "seq").alias("display_name"), F.min(F.when(a["orcid"].isNotNull(), F.struct("seq", a["orcid"].alias("orcid")))).alias("o")).select("canonical_author_id", "display_name", F.col("o.orcid").alias("orcid"), F.lit(None).cast("array<string>").alias("aliases"), at.alias("created_at"), at.alias("updated_at"))
    institutions = people.where("canonical_inst_id is not null").groupBy("canonical_inst_id").agg(F.min_by(F.coalesce(none_if_empty(a["institution_name"]), F.lit("Unknown Institution")), "seq").alias("name"), F.min(F.when(a["institution_ror"].isNotNull(), F.struct("seq", a["institution_ror"].alias("x")))).alias("r"), F.min(F.when(a["institution_country"].isNotNull(), F.struct("seq", a["institution_country"].alias("x")))).alias("c")).select("canonical_inst_id", "name", F.col("r.x").alias("ror_id"), F.col("c.x").alias("country_code"), F.lit(None).cast("string").alias("homepage_url"), at.alias("created_at"))
    work_authors = people.groupBy("canonical_work_id", "canonical_author_id", a["position"].alias("author_position")).agg(F.min_by(F.struct("canonical_inst_id", a["raw_name"].alias("raw_author_name"), a["raw_affiliation"].alias("raw_affiliation_string"), a["is_corresponding"].alias("is_corresponding")), "seq").alias("x")).select("canonical_work_id", "canonical_author_id", "author_position", "x.*")
    citing = owned.where("kind = 'citation'").select("seq", "observation_id", "source", "edge", F.col("canonical_work_id").alias("cited_work_id")).join(works_of.select("observation_id", F.col("canonical_work_id").alias("citing_work_id")), "observation_id").where("citing_work_id <> cited_work_id")
    citations = merged_edges(citing.select("citing_work_id", "cited_work_id", "seq", F.col("source").alias("source_provider"), "edge.*")).withColumn("created_at", at)
    metrics = unpivoted_metrics(full.select("canonical_work_id", w["source_name"].alias("source_provider"), F.col("observation_id").alias("source_observation_id"), "run_id", w["citation_count"].alias("citation_count"), w["influential_citation_count"].alias("influential_citation_count"))).withColumn("observed_at", at)
    table_ids = identifiers.select(F.col("type").alias("identifier_type"), F.col("value").alias("normalized_value"), "canonical_work_id", F.col("raw").alias("raw_value"), at.alias("created_at"))
    return {"canonical_works": works, "canonical_work_identifiers": table_ids, "canonical_venues": venues, "canonical_authors": authors, "canonical_institutions": institutions, "canonical_work_authors": work_authors, "canonical_citations": citations, "canonical_work_provenance": provenance, "metrics_provenance": metrics}


def merged_edges(edges: DataFrame, order: str = "seq") -> DataFrame:
    """Repeated edges (citing_work_id, cited_work_id) as one: influential if any is, the last intents, the first provider."""
    return edges.groupBy("citing_work_id", "cited_work_id").agg(F.bool_or("is_influential").alias("is_influential"), F.max(F.when(F.col("citation_intents").isNotNull(), F.struct(order, "citation_intents"))).alias("i"), F.min_by("source_provider", order).alias("source_provider")).select("citing_work_id", "cited_work_id", F.coalesce("is_influential", F.lit(False)).alias("is_influential"), F.col("i.citation_intents").alias("citation_intents"), "source_provider")


def unpivoted_metrics(df: DataFrame, metrics: tuple[str, ...] = ("citation_count", "influential_citation_count")) -> DataFrame:
    """One row for each metric above 0: metric_name, metric_value and the other columns."""
    pairs = F.array(*[F.struct(F.lit(m).alias("metric_name"), F.col(m).cast("double").alias("metric_value")) for m in metrics])
    keep = [c for c in df.columns if c not in metrics]
    return df.select(*keep, F.explode(pairs).alias("m")).select(*keep, "m.*").where("metric_value > 0")
