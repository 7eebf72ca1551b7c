"""Sources, quality rules, resolution and the store, from lines to reports."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from folioflow.operators import quality
from folioflow.operators.resolve import PRIORITIES, accepted_dates, gold, winner
from folioflow.plans import analytics
from folioflow.plans.ingest import ingest, ingest_file
from folioflow.sources import providers, records  # noqa: F401
from folioflow.sources.store import ConstraintError, Store

TS = dt.datetime(2026, 1, 1)
ARXIV = [
    {"id": "2203.04455v2", "title": "Echoes of drumlin ice\n", "abstract": "Heard ``twice''", "authors_parsed": [["Ekholm", "Tuva", "Fen Lab"], ["", ""]], "doi": "10.7777/TARN.88", "update_date": "2022-03-09", "journal-ref": "Tarn Notes 4"},
    {"id": "lost", "title": "[untitled]", "update_date": "2024-11-30"},
]
OPENALEX = [{"id": "https://works.example/K31", "doi": "https://doi.org/10.7777/tarn.88", "title": "Echoes of Drumlin Ice", "abstract_inverted_index": {"Ice": [0], "sings": [1, 4], "and": [2], "then": [3]}, "publication_year": 2022, "publication_date": "2022-4-3", "primary_location": {"source": {"display_name": "Moraine Letters", "issn_l": "7070-4242", "type": "conference"}}, "authorships": [{"author": {"id": "https://works.example/P5", "display_name": "Tuva Ekholm", "orcid": "https://orcid.org/0000-0003-4172-9503"}, "institutions": [{"display_name": "Fen Lab", "ror": "https://ror.org/0qrs7tv42", "country_code": "SE"}]}], "referenced_works": ["https://works.example/K8", " "], "cited_by_count": 41}]
CROSSREF = [{"DOI": "10.6060/kelp.7", "title": ["Kelp tides by radar"], "abstract": "<jats:p>Measured.</jats:p>", "published-print": {"date-parts": [[2021, 5]]}, "container-title": ["Strand Days"], "ISSN": ["9191-3030"], "type": "proceedings-article", "is-referenced-by-count": 63, "author": [{"given": "Bo", "family": "Rask"}], "reference": [{"DOI": "10.7777/TARN.88"}, {"unstructured": "an old chart"}, {}]}]
S2 = [{"paperId": "m4", "corpusId": 12, "title": "Echoes of ice", "abstract": "Listen.", "year": 2022, "venue": "Tarn", "externalIds": {"DOI": "10.7777/tarn.88", "ArXiv": "2203.04455"}, "authors": [{"authorId": 31, "name": "Tuva"}], "citations": [{"paperId": "m9", "isInfluential": True, "intents": ["result"]}, {"paperId": "m4"}], "citationCount": 50, "influentialCitationCount": 6}, {"paperId": "m9", "title": "Older sounds", "year": 2016, "externalIds": {"DOI": "10.4040/older"}, "authors": [], "citations": []}]


def lines(spark, rows):
    return spark.createDataFrame([(i, r if isinstance(r, str) else json.dumps(r)) for i, r in enumerate(rows)], "line_idx bigint, line string")


def parsed(spark, source, *rows):
    return [r.asDict(True) for r in records.parse(lines(spark, rows), source).orderBy("line_idx").collect()]


def test_sources(spark):
    a = parsed(spark, "arxiv", *ARXIV)[0]["work"]
    assert a["title"] == "Echoes of drumlin ice" and a["abstract"] == 'Heard "twice"' and a["publication_date"] == dt.date(2022, 3, 9) and a["normalized_arxiv_id"] == "2203.04455" and [x["raw_name"] for x in a["authors"]] == ["Tuva Ekholm"]
    o = parsed(spark, "openalex", *OPENALEX)[0]["work"]
    assert o["abstract"] == "Ice sings and then sings" and o["publication_date"] == dt.date(2022, 4, 3) and o["authors"][0]["institution_ror"] == "https://ror.org/0qrs7tv42" and o["authors"][0]["orcid"] == "0000-0003-4172-9503" and [c["cited_source_id"] for c in o["citations"]] == ["https://works.example/K8"]
    c = parsed(spark, "crossref", *CROSSREF)[0]["work"]
    assert c["abstract"] == "Measured." and c["publication_date"] == dt.date(2021, 5, 1) and c["venue_type"] == "CONFERENCE" and len(c["citations"]) == 2
    s = parsed(spark, "semantic_scholar", *S2)[0]["work"]
    assert s["citations"][0]["citation_intents"] == ["RESULT"] and s["authors"][0]["source_author_id"] == "31" and [x["type"] for x in s["external_ids"]] == ["S2_PAPER_ID", "CORPUS_ID", "DOI", "ARXIV"]


def test_arxiv_dates_and_author_text(spark):
    rows = parsed(spark, "arxiv", {"id": "0811.2233", "title": "x", "authors": "A B, C D and E F"}, {"id": "x", "title": "t", "versions": [{"created": "2001-02-03"}, {"created": "2004-05-06 x"}]}, {"id": "9703.5", "title": "t"}, {"id": "y", "authors": ["list"]})
    w = [r["work"] for r in rows]
    assert w[0]["publication_year"] == 2008 and [a["raw_name"] for a in w[0]["authors"]] == ["A B", "C D", "E F"]
    assert w[1]["publication_date"] == dt.date(2004, 5, 6) and w[2]["publication_year"] == 1997 and w[3]["authors"] == [] and w[3]["publication_date"] is None


def test_lines_are_numbered_by_file_and_place(spark, tmp_path):
    folder = tmp_path / "lines"
    folder.mkdir()
    due = []
    for name, n in (("b", 2000), ("a", 3), ("c", 700)):  # the reader takes larger files first
        (folder / f"{name}.txt").write_text("".join(f"{name} {i}\n" if i % 5 else " \n" for i in range(n)))
    for name, n in (("a", 3), ("b", 2000), ("c", 700)):
        due += [f"{name} {i}" if i % 5 else "" for i in range(n)]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("1000", before):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            got = {r.line_idx: r.line for r in records.read_lines(spark, str(folder)).collect()}
            assert got == {i: x for i, x in enumerate(due) if x}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_errors(spark):
    kinds = [r["error_type"] for r in parsed(spark, "crossref", "{", "[1]", "7", '{"type": null}', '{"author": [1]}', '{"is-referenced-by-count": "x"}', '{"title": "plain", "published-print": {"date-parts": [[2019, 13, 1]]}}')]
    assert kinds == ["MALFORMED_JSON"] + ["PARSER_EXCEPTION"] * 5 + [None]
    with pytest.raises(ValueError):
        records.parser_of("no such source")
    with pytest.raises(FileNotFoundError):
        records.read_lines(spark, "/nowhere/at/all.jsonl")


def test_quality(spark):
    rows = [{"paperId": "self", "title": "Good title", "year": 2099, "authors": [{"name": " "}, {"name": " A "}], "citations": [{"paperId": "self"}, {"paperId": "o"}]}, {"paperId": "b", "title": "ab"}, {"paperId": "c", "title": "N/A"}]
    got = [r.asDict(True) for r in quality.check(records.parse(lines(spark, rows), "semantic_scholar"), 2026).orderBy("line_idx").collect()]
    w = got[0]["work"]
    assert w["publication_year"] is None and [(a["raw_name"], a["position"]) for a in w["authors"]] == [("A", 1)] and [c["cited_source_id"] for c in w["citations"]] == ["o"] and len(got[0]["warnings"]) == 2
    assert [g["error_type"] for g in got[1:]] == ["DQ-02_TITLE_INCOMPLETE"] * 2


def test_ingest_replay_and_reports(spark, tmp_path):
    store = Store(spark, str(tmp_path / "w"))
    assert store.migrate() == 0 and store.read("schema_migrations").count() == 1
    folder = tmp_path / "in"
    folder.mkdir()
    counts = []
    for source, rows in (("arxiv", ARXIV), ("openalex", OPENALEX), ("crossref", CROSSREF), ("semantic_scholar", S2)):
        path = folder / f"{source}.jsonl"
        path.write_text("\n".join(["", *map(json.dumps, rows), ""]))
        r = ingest_file(spark, store, str(path), source, run_ts=TS)
        counts.append((r["record_count"], r["accepted_count"], r["rejected_count"]))
    assert counts == [(2, 1, 1), (1, 1, 0), (1, 1, 0), (2, 2, 0)]
    works = {r.canonical_doi or r.title: r for r in store.read("canonical_works").collect()}
    w1 = works["10.7777/tarn.88"]
    assert w1.title == "Echoes of Drumlin Ice" and w1.abstract == "Listen." and w1.citation_count == 50 and w1.canonical_arxiv_id == "2203.04455"
    assert works["10.4040/older"].is_stub is False and works["10.4040/older"].created_from_source == "semantic_scholar"
    assert works["[Stub Citation: https://works.example/k8]"].is_stub
    rules = {(r.attribute_name, r.winning_source): r.resolution_rule for r in store.read("canonical_work_provenance").where(F.col("canonical_work_id") == w1.canonical_work_id).collect()}
    assert rules[("title", "openalex")] == "PRIORITY_OVERRIDE" and rules[("abstract", "semantic_scholar")] == "PRIORITY_OVERRIDE"
    assert {r.resolution_rule for r in store.read("canonical_work_provenance").where(F.col("canonical_work_id") == works["10.4040/older"].canonical_work_id).collect()} == {"STUB_UPGRADE"}
    before = {n: store.read(n).count() for n in ("canonical_works", "canonical_work_identifiers", "source_work_observations")}
    again = ingest_file(spark, store, str(folder / "arxiv.jsonl"), "arxiv", run_ts=TS)
    assert (again["record_count"], again["accepted_count"], again["rejected_count"]) == (2, 0, 1)
    assert {n: store.read(n).count() for n in before} == before
    v = analytics.citation_velocity(store.read("canonical_works"), store.read("canonical_venues"), store.read("canonical_citations"), 2026).collect()
    assert v[0].canonical_work_id == w1.canonical_work_id and v[0].inbound_citation_edges == 1 and v[0].citation_velocity == 10.0
    assert analytics.coauthorship_network(store.read("canonical_work_authors"), store.read("canonical_authors")).count() >= 1
    assert analytics.venue_impact(store.read("canonical_works"), store.read("canonical_venues")).first().total_citations == 63
    audit = analytics.work_provenance_audit(store.read("canonical_work_provenance"), store.read("source_work_observations"), w1.canonical_work_id)
    assert [r.attribute_name for r in audit.collect()] == ["abstract", "publication_date", "title", "venue"]


def test_a_failed_run_leaves_no_trace(spark, tmp_path):
    store = Store(spark, str(tmp_path / "w"))
    ingest(spark, store, lines(spark, CROSSREF), "crossref", run_id="r1", run_ts=TS)
    before = store.pointer()
    with pytest.raises(ConstraintError):
        ingest(spark, store, lines(spark, OPENALEX), "openalex", run_id="r1", run_ts=TS)  # a run id twice
    with pytest.raises(ValueError):
        ingest(spark, store, lines(spark, OPENALEX), "nosource", run_ts=TS)
    assert store.pointer() == before and store.read("canonical_works").where("not is_stub").count() == 1


def sequential(log):
    """Records one by one, as the rules read: an independent model of the resolution."""
    from uuid import UUID, uuid5

    from folioflow.functions.identifiers import NAMESPACES

    mint = lambda a: str(uuid5(UUID(NAMESPACES["work"]), a))
    idents, owner, targets = {}, {}, []
    for n, w in enumerate(log):
        keys = ([("DOI", w["doi"])] if w["doi"] else []) + [("OPENALEX", x) for x in w["ids"]]
        hit = next((idents[k] for k in keys if k in idents), None)
        anchor = f"doi:{w['doi']}" if w["doi"] else f"openalex:{w['ids'][0]}" if w["ids"] else f"cluster:openalex:w{n}"
        owner[n] = hit or mint(anchor)
        for k in keys:
            idents.setdefault(k, owner[n])
        for kind, v in w["cites"]:
            if kind == "doi":
                t = idents.get(("DOI", v))
                if t is None:
                    t = mint(f"doi:{v}")
                    idents[("DOI", v)] = t
            else:
                t = next((o for (_, x), o in idents.items() if x == v), None)  # the earliest registered
                if t is None:
                    t = mint(f"cluster:openalex:{v}")
                    idents[("OPENALEX", v)] = t
            if t != owner[n]:
                targets.append((owner[n], t))
    return owner, idents, set(targets)


@pytest.mark.parametrize("seed", range(4))
def test_resolution_equals_one_record_at_a_time(spark, seed):
    rng = random.Random(seed)
    log = [{"doi": rng.choice(["10.1000/a", "10.1000/b", "10.1000/c", None]), "ids": rng.sample(["u", "v", "x", "y"], rng.randint(0, 2)), "cites": [(rng.choice(["doi", "id"]), None) for _ in range(rng.randint(0, 3))]} for _ in range(25)]
    for w in log:
        w["cites"] = [(k, rng.choice(["10.1000/a", "10.1000/d"] if k == "doi" else ["u", "z", "10.1000/b"])) for k, _ in w["cites"]]
    rows = []
    for n, w in enumerate(log):
        ids = [{"type": "OPENALEX", "value": x} for x in w["ids"]]
        cites = [{"cited_doi": v if k == "doi" else None, "cited_arxiv_id": None, "cited_source_id": v if k == "id" else None, "raw_citation_string": None, "is_influential": False, "citation_intents": []} for k, v in w["cites"]]
        rows.append((0, "r", n, f"o{n}", {"source_name": "openalex", "source_work_id": f"w{n}", "title": f"title {n}", "abstract": None, "publication_year": 2000, "publication_date": None, "normalized_doi": w["doi"], "normalized_arxiv_id": None, "raw_venue_name": None, "venue_issn": None, "venue_type": None, "citation_count": 0, "influential_citation_count": 0, "authors": [], "citations": cites, "external_ids": ids}))
    df = spark.createDataFrame(rows, f"run_no bigint, run_id string, line_idx bigint, observation_id string, work {records.WORK}")
    owner, idents, edges = sequential(log)
    tables = gold(df, F.lit(TS))
    assert {(r.identifier_type, r.normalized_value): r.canonical_work_id for r in tables["canonical_work_identifiers"].collect()} == idents
    assert {(r.citing_work_id, r.cited_work_id) for r in tables["canonical_citations"].collect()} == edges
    assert {r.canonical_work_id for r in tables["canonical_works"].where("not is_stub").collect()} == set(owner.values())


@pytest.mark.parametrize("seed", range(3))
def test_authority_closed_form_equals_applying_in_turn(spark, seed):
    rng = random.Random(seed)
    rows, due = [], {}
    for g in range(60):
        title = date = incumbent = incumbent_d = None
        for seq in range(rng.randint(1, 6)):
            source = rng.choice(list(PRIORITIES["title"]) + ["other"])
            value, d = rng.choice([None, "", f"v{seq}"]), rng.choice([None, dt.date(2000 + seq, 1, 1)])
            rows.append((g, seq, seq == 0, False, source, f"o{g}_{seq}", value, d))
            p = PRIORITIES["title"].get(source, 99)
            if seq == 0:
                title, incumbent, who = value, p, f"o{g}_{seq}"
            elif value and p <= incumbent:
                title, incumbent, who = value, p, f"o{g}_{seq}"
            if seq == 0 or p <= incumbent_d:
                incumbent_d, date = p, d or date
        due[g] = (title, who, date)
    df = spark.createDataFrame(rows, "k int, seq int, is_first boolean, after_stub boolean, source string, observation_id string, value string, date date")
    got = {r.k: (r.value, r.observation_id) for r in winner(df.where("is_first or value <> ''"), "title", "k").collect()}
    dates = {r.k: r.publication_date for r in accepted_dates(df, "k").collect()}
    assert {k: (*got[k], dates.get(k)) for k in due} == due


def test_streaming_ingests_each_file_once(spark, tmp_path):
    from folioflow.streaming.ingest_stream import ingest_stream

    store, folder = Store(spark, str(tmp_path / "w")), tmp_path / "in"
    folder.mkdir()
    (folder / "a.jsonl").write_text(json.dumps(CROSSREF[0]) + "\n")
    for _ in range(2):
        ingest_stream(spark, store, str(folder), "crossref", str(tmp_path / "c"), 2026).awaitTermination(120)
    assert store.read("ingestion_runs").count() == 1 and store.read("source_work_observations").count() == 1
