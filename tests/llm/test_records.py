"""Mapping to a list, survivors, record matching and name variants on small cases and their edges."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from folioflow.llm import canonical, matching, names, survivors

D = dt.datetime
VENUES = [("v1", "Journal of Harmonic Forestry", None), ("v2", "International Journal of Harmonic Forestry", None), ("v3", "Harmonic Forestry Letters", None), ("v4", "Symposium on Xeric Dynamics (SYMXEDY)", None), ("v5", "PrepNest", None), ("v6", None, None), ("v7", "Annals of Insular Ecology", None)]


@pytest.mark.parametrize(
    ("value", "due"),
    [("Journal of Harmonic Forestry", "v1"), ("Int. J. Harmon. Forest., vol. 3, no. 2, pp. 1-9", "v2"), ("J. of Harmonic Forestyr 2019", "v1"), ("HARMONIC FORESTRY LETTERS (forthcoming)", "v3"), ("symxedy '24", "v4"), ("Harmonic Forestry (Letters)", "v3"), ("In: Proc. 9th Symposium on Xeric Dynamics", "v4"), ("2018 PrpeNest", "v5"), ("Handbook of Harmonic Forestry", ""), ("Journal of Insular Ecology", ""), ("see website", ""), ("J0urna1 0f Harm0nic F0restry", "v1"), ("Forestry", ""), ("x" * 20_000, ""), ("...", "")],
)
def test_meaning(value, due):
    index = canonical.Index([canonical.entry(*v) for v in VENUES])
    assert index.meant(value, 0.1, 0.01) == due


def test_mapping(spark):
    e = spark.createDataFrame([(*v, 0) for v in VENUES], "key string, name string, normalized string, value int")
    values = spark.createDataFrame([("PrepNest", 1), ("PrepNest", 1), (" ", 1), (None, 1), ("nothing known", 1), ("Harmonic Forestry", 1)], "value string, key int")
    got = {r.value: r.key for r in canonical.canonical_entries(values, e).collect()}
    assert got == {"PrepNest": "v5", "nothing known": "", "Harmonic Forestry": ""}
    assert {r.value: r.key for r in canonical.canonical_entries(values, e, block=2).collect()} == got
    assert {r.key for r in canonical.canonical_entries(values, e.limit(0)).collect()} == {""}
    assert canonical.canonical_entries(values.limit(0), e).count() == 0
    twins = spark.createDataFrame([("a", "Same Name", None), ("b", "Same Name", None)], "key string, name string, normalized string")
    assert canonical.canonical_entries(spark.createDataFrame([("same name",)], "value string"), twins).first().key == ""  # a tie means none


GOOD = "We measured the field twice. It was stable."


def observations(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "observation_id string, source_name string, normalized_doi string, title string, abstract string, publication_date date, publication_year int, observed_at timestamp, truth string")


def test_usable_abstracts(spark):
    texts = [GOOD, f"<jats:p>{GOOD}</jats:p>", f"Abstract: {GOOD}", "Abstract: not available", "N/A", "<p> </p>", "A title of this.", "We measured the field...", "We measured […]", "We measured the", None, "", "See full text.", f"&lt;p&gt;{GOOD}&lt;/p&gt;", "Is it? Yes (it is.)"]
    df = spark.createDataFrame([(i, t, "A title of this") for i, t in enumerate(texts)], "i int, a string, t string")
    text = survivors.unmarked(F.col("a"))
    got = [r.ok for r in df.select("i", survivors.real_abstract(text, survivors.plain(text), survivors.plain(F.col("t"))).alias("ok")).orderBy("i").collect()]
    assert got == [True, True, True] + [False] * 10 + [True, True]


def test_ends_that_are_cut_off(spark):
    ends = ["and more.", "and nothing more!", "Read more.", "(more)", "[more]", "one more.", "read more", "[...]", "spread more."]
    df = spark.createDataFrame([(i, "We discuss ten tasks. " + e, "A title") for i, e in enumerate(ends)], "i int, a string, t string")
    text = survivors.unmarked(F.col("a"))
    got = [r.ok for r in df.select("i", survivors.real_abstract(text, survivors.plain(text), survivors.plain(F.col("t"))).alias("ok")).orderBy("i").collect()]
    assert got == [True, True, False, False, False, True, False, False, True]


def test_long_bare_titles_are_no_abstracts(spark):
    title = "A long title of many words " * 20 + "ends here."
    df = spark.createDataFrame([(0, title, title), (1, title.replace("ends", "ensd"), title), (2, GOOD * 12, title)], "i int, a string, t string")
    text = survivors.unmarked(F.col("a"))
    assert [r.ok for r in df.select("i", survivors.real_abstract(text, survivors.plain(text), survivors.plain(F.col("t"))).alias("ok")).orderBy("i").collect()] == [False, False, True]


def test_survivors(spark):
    rows = [
        ("o1", "crossref", "10.1/A", "t", GOOD, dt.date(2020, 1, 2), 2020, D(2021, 1, 1)), ("o2", "semantic_scholar", " 10.1/a ", "t", "N/A", dt.date(2019, 1, 2), 2020, D(2021, 1, 1)), ("o3", "openalex", "10.1/a", "t", GOOD + " More.", None, None, D(2021, 1, 1)), ("o4", "openalex", "10.1/a", "t", GOOD, dt.date(2099, 1, 1), None, D(2021, 6, 1)), ("o4", "openalex", "10.1/a", "t", GOOD, dt.date(2099, 1, 1), None, D(2021, 6, 1)),
        ("s1", "arxiv", "10.1/single", "t", GOOD, None, None, D(2021, 1, 1)), ("s1", "arxiv", "10.1/single", "t", GOOD, None, None, D(2021, 1, 1)),
        ("n1", "arxiv", None, "t", GOOD, None, None, D(2021, 1, 1)), ("n2", "arxiv", " ", "t", GOOD, None, None, D(2021, 1, 1)),
        ("e1", "arxiv", "10.1/e", "t", "none", None, None, D(2021, 1, 1)), ("e2", "arxiv", "10.1/e", "t", "", None, None, None),
        ("t1", "other", "10.1/t", "t", GOOD, None, None, D(2021, 1, 1)), ("t2", "other", "10.1/t", "t", GOOD, None, None, D(2021, 1, 1)),
    ]
    got = {(r.group, r.field): (r.source, r.observation_id) for r in survivors.survivors(observations(spark, rows)).collect()}
    assert got == {("10.1/a", "abstract"): ("openalex", "o4"), ("10.1/a", "publication_date"): ("crossref", "o1"), ("10.1/t", "abstract"): ("other", "t2")}
    assert survivors.survivors(observations(spark, rows).limit(0)).count() == 0


def test_quality_model_learns_who_is_right(spark):
    import random

    rng, rows = random.Random(1), []
    for g in range(300):
        for v in range(3):
            true = v == 0
            votes = [("good", rng.random() < (0.95 if true else 0.05)), ("poor", rng.random() < (0.5 if true else 0.5)), ("fair", rng.random() < (0.8 if true else 0.2)), ("other", rng.random() < (0.85 if true else 0.1))]
            rows.append((f"{g}", "f", True, [{"source": s, "claims": c} for s, c in votes], true))
    df = spark.createDataFrame(rows, "g string, field string, possible boolean, votes array<struct<source:string,claims:boolean>>, is_true boolean")
    truth, quality = survivors.quality_model(df, prior=1 / 3)
    q = {s: v for (_, s), v in quality.items()}
    assert q["good"].sensitivity > 0.8 and q["good"].specificity > 0.85 and abs(q["poor"].sensitivity - 0.5) < 0.15
    right = df.withColumn("t", truth).where("(t >= 0.5) = is_true").count()
    assert right > 0.93 * len(rows)


def works(spark, rows):
    return spark.createDataFrame([(*r, 1) for r in rows], "observation_id string, source_name string, normalized_doi string, normalized_arxiv_id string, title string, publication_year int, publication_date date, raw_authors string, s int")


def people(*n):
    import json

    return json.dumps([{"raw_name": x, "position": i} for i, x in enumerate(n, 1)])


def test_title_parts():
    p = matching.title_parts
    assert p("Reply to comments on: <i>Coarse</i> mesh of zalith") == (["coarse", "mesh", "zalith"], "reply")
    assert p("Coarse mesh of zalith II")[1] == "ii" and p("Coarse mesh of zalith, Part 2")[1] == "part 2"
    assert p("corection to: coarse mesh of zalith")[1] == "correction" and p("Coarse mesh of zalith (extended reprot)")[1] == "extended"
    assert p("Preprint: Coarse mesh &amp; zalith (working paper)") == (["coarse", "mesh", "zalith"], "")
    assert p(None) == ([], "") and p("n/a") == ([], "") and p("[Untitled]") == ([], "")


def test_matching(spark):
    a = people("Ana B. Kalzoton", "Wen Mörk")
    b = people("Kalzoton, A. B.", "Mork Wen")
    t = "Coarse mesh estimation for zanuflux in {} archives of lorith"
    rows = [
        ("o1", "crossref", "10.1/x", None, t.format("humid"), 2020, dt.date(2020, 1, 1), a), ("o2", "arxiv", None, "2001.1", t.format("hunid") + " (working paper)", 2019, None, b), ("o3", "openalex", "10.1/X ", None, t.format("humid"), 2020, None, a),
        ("o4", "arxiv", None, None, t.format("humid") + " II", 2020, None, a), ("o5", "semantic_scholar", None, None, "Coarse mesh estimation for zanuflux", None, None, people("A. Kalzoton", "et al.")), ("o6", "crossref", None, None, t.format("humid"), 2020, None, a),
        ("o7", "crossref", None, None, None, None, None, None), ("o8", "arxiv", None, None, "", None, None, "not json"), (None, "arxiv", None, None, t.format("humid"), 2020, None, a), ("o2", "arxiv", None, "2001.1", t.format("hunid") + " (working paper)", 2019, None, b),
        ("o9", "openalex", None, None, "untitled", 2020, dt.date(2020, 5, 5), people("Uma Grensk", "Bo Tralm")), ("p1", "arxiv", None, None, "na", 2020, dt.date(2020, 5, 5), people("Grensk, Uma", "Tralm, Bo")),
    ]
    got = {(r.observation_id_a, r.observation_id_b): r.confidence for r in matching.linked_records(works(spark, rows)).collect()}
    assert set(got) == {("o1", "o2"), ("o1", "o5"), ("o2", "o3"), ("o2", "o5"), ("o2", "o6"), ("o3", "o5"), ("o3", "o6"), ("o5", "o6"), ("o9", "p1")}
    assert all(0.7 < c <= 1 for c in got.values())
    assert matching.linked_records(works(spark, rows).limit(0)).count() == 0


def test_matching_hot_block_keeps_its_links(spark):
    rows = [(f"a{i:03d}", "crossref" if i % 2 else "arxiv", None, None, f"Hot word zanuflux variant{i // 2} of lorith", 2020, None, people(f"Ana Kal{'abcdefghijklmnopqrstuvwxyz'[i // 2 % 26]}ton{i // 2}q", "Bo Trem")) for i in range(120)]
    got = {(r.observation_id_a, r.observation_id_b) for r in matching.linked_records(works(spark, rows), block=4).collect()}
    assert {(f"a{i:03d}", f"a{i + 1:03d}") for i in range(0, 120, 2)} <= got


def test_matching_clean_title_meets_mistyped_copy_by_its_authors(spark):
    rows = [(f"c{i}", "crossref", None, None, t, 2020, None, people("Ana Kalzoton", "Wen Trembor", "Uma Grensk")) for i, t in enumerate(["on the saline grid of drennaderm and bounded motsonite", "on the saline grid of drenaderm and bounded mostonite"])]
    other = [(f"f{i}{w}", "arxiv", None, None, f"on the saline grid of {w} and bounded {v}", 2000 + i % 20, None, people(f"Bo Fam{i}x")) for i in range(20) for w, v in [("drennaderm", f"lorith{i}"), (f"xoral{i}", "motsonite")]]
    other += [(f"h{i}", "arxiv", None, None, f"the saline grid with bounded filler{i}", 1990, None, people(f"Cy Gam{i}x")) for i in range(30)]
    rows[1] = (rows[1][0], "openalex", *rows[1][2:5], None, *rows[1][6:])
    got = {(r.observation_id_a, r.observation_id_b) for r in matching.linked_records(works(spark, rows + other)).collect()}
    assert ("c0", "c1") in got


def test_matching_titles_of_frequent_words_only(spark):
    rows = [("c0", "crossref", None, None, "saline grid bounded lorith", 2020, None, people("Ana Kalzoton", "Wen Trembor")), ("c1", "openalex", None, None, "saline grid bounded lorit", 2020, None, people("Ana Kalzotin", "Wen Trembar"))]
    other = [(f"{w}{i}", "arxiv", None, None, f"{w} filler{i}", 2000 + i % 20, None, people(f"Bo Fam{i}x", f"Cy {w.replace(' ', '')}{i}x")) for i in range(40) for w in ("saline grid", "bounded lorith", "saline bounded", "grid lorit")]
    got = {(r.observation_id_a, r.observation_id_b) for r in matching.linked_records(works(spark, rows + other)).collect()}
    assert ("c0", "c1") in got


def test_matching_many_records_of_one_title(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    name = lambda i, end: f"{letters[i] * 4} {letters[i]}{letters[-1 - i]}{letters[i]}{letters[(i + 9) % 26]}{letters[(i + 5) % 26]}{end}"
    rows = [(f"{k}{i:02d}", "crossref" if k == "a" else "arxiv", None, None, "Coarse mesh estimation", 2000 + i if k == "a" else None, None, people(name(i, "on" if k == "a" else "in"))) for i in range(24) for k in "ab"]
    got = {(r.observation_id_a, r.observation_id_b) for r in matching.linked_records(works(spark, rows)).collect()}
    assert {(f"a{i:02d}", f"b{i:02d}") for i in range(24)} <= got


def test_a_hot_key_of_a_family_is_compared_once(spark):
    import numpy as np

    rows = [(f"o{i:02d}", "crossref", None, None, f"lorith filler{i}", 2020, None, people("The Big Ring Collaboration")) for i in range(30)]
    nodes = matching.records(works(spark, rows)).withColumn("n", F.monotonically_increasing_id()).cache()
    shared = spark.sparkContext.broadcast(np.full(matching.COUNTERS, 5))
    keys = nodes.select("n", "words", "families", "day", F.lit(False).alias("several"), "people").mapInArrow(matching.attributes(shared), matching._ROW_DDL)
    for block in (1, 4):  # in several cells and in one
        pairs, _ = matching.met_pairs(keys, nodes, block)
        assert pairs.distinct().count() == pairs.count() == 30 * 29 // 2


def test_matching_does_not_depend_on_the_block(spark):
    import random

    rng = random.Random(5)
    word = lambda: "".join(rng.choice("bdfgklmnprstvz") + rng.choice("aeiou") for _ in range(3))
    common, rare, first, last = [word() for _ in range(6)], [word() for _ in range(30)], [word() for _ in range(4)], [word() for _ in range(12)]
    slip = lambda w: w[:2] + "x" + w[3:] if rng.random() < 0.15 else w
    rows = []
    for i in range(60):
        title, names = rng.sample(common, 4) + rng.sample(rare, 2), [f"{rng.choice(first)} {rng.choice(last)}" for _ in range(rng.randint(1, 2))]
        for source in rng.sample(("crossref", "arxiv", "openalex", "semantic_scholar"), rng.randint(1, 3)):
            rows.append((f"o{len(rows):03d}", source, f"10.1/{i % 9}" if rng.random() < 0.2 else None, None, " ".join(map(slip, title)), 2000 + i % 3, None, people(*[" ".join(map(slip, n.split())) for n in names]) if rng.random() < 0.9 else None))
    rows += [(f"u{i}", s, None, None, None, 2020, dt.date(2020, 5, i % 2 + 1), people("Uma Grensk", "Bo Tralm")) for i, s in enumerate(("crossref", "arxiv", "openalex", "arxiv") * 2)]
    df = works(spark, rows)
    found = [{tuple(r) for r in matching.linked_records(df, block=b).collect()} for b in (2, 10, 1 << 20)]
    assert found[0] == found[1] == found[2] and len(found[0]) > 60


@pytest.mark.parametrize("sizes", [(1, 10), (10, 40), (200, 300)])
def test_titles_with_enough_in_common_share_a_key(sizes):
    import random

    import numpy as np
    import pyarrow as pa

    rng = random.Random(2)
    words = [rng.getrandbits(63) for _ in range(900)]
    titles = [rng.sample(words, rng.randint(*sizes)) for _ in range(40)]
    titles += [[w if rng.random() < 0.8 else rng.choice(words) for w in t] for t in titles for _ in range(2)]
    titles = [list(dict.fromkeys(t)) for t in titles]
    counts = np.random.default_rng(1).integers(2, 50, matching.COUNTERS)
    families = [[7], [7, 9], [7, 9, 11]] * 40
    batch = pa.RecordBatch.from_arrays([pa.array(range(120)), pa.array(titles, pa.list_(pa.int64())), pa.array(families, pa.list_(pa.int64())), pa.nulls(120, pa.int32()), pa.array([False] * 120), pa.array([[1, 2]] * 120, pa.list_(pa.int16()))], names=["n", "words", "families", "day", "several", "people"])
    shared = type("S", (), {"value": counts})
    rows = [r for b in matching.attributes(shared)(iter([batch])) for r in b.to_pylist()]
    keys, side = [[set() for _ in range(5)] for _ in range(120)], {}
    for r in rows:
        keys[r["n"]][r["rule"]].add(r["key"])
        side[r["n"]] = np.frombuffer(r["side"], dtype=np.uint8).reshape(1, -1)
    seen = 0
    for i in range(120):
        for j in range(i):
            a, b = set(titles[i]), set(titles[j])
            rate = len(a & b) / max(len(a), len(b))
            shares = lambda *rules: any(keys[i][r] & keys[j][r] for r in rules)
            if rate >= 0.5:
                seen += 1
                assert shares(matching.WORD_FAMILY, matching.WORD)
            if rate >= matching.SHARE_ALONE and len(a & b) > 1:
                assert shares(matching.WORDS, matching.WORD)
            assert (a == b) == shares(matching.TITLE)
            if len(a & b) >= matching.SHARE * min(len(a), len(b)) and a != b:
                assert matching._possible(side[i], side[j], np.array([matching.WORD_FAMILY]))[0]
    assert seen > 60


def test_classes_join_by_ids_and_copies(spark):
    t, a = "Coarse mesh estimation for zanuflux in humid archives", people("Ana Kalzoton")
    rows = [(f"k{i:02d}", "crossref", f"10.1/{i // 2}", f"2001.{(i + 1) // 2}", f"{t} site{i}x", 2020, None, a) for i in range(20)] + [(f"c{i}", ("arxiv", "openalex")[i % 2], None, None, t + " and shallow ponds", 2020, None, a) for i in range(4)]
    members, links = matching._named(*matching.linked_classes(works(spark, rows)))
    of = {r.observation_id: r.class_id for r in members.collect()}
    assert {of[f"k{i:02d}"] for i in range(20)} == {"k00"} and {of[f"c{i}"] for i in range(4)} == {"c0"}
    assert {(r.class_a, r.class_b) for r in links.collect()} == {("c0", "k00")}
    got = {(r.observation_id_a, r.observation_id_b) for r in matching.linked_records(works(spark, rows)).collect()}
    assert got == {(f"c{i}", f"c{j}") for i in range(4) for j in range(i, 4) if i % 2 != j % 2} | {(f"c{i}", f"k{j:02d}") for i in range(4) for j in range(20)}


def test_names(spark):
    ids = {
        "p1": ["Christopher F. Gukmoumara"], "p2": ["Gukmoumara, Chris F.", "GUKMOUMARA, Chris F."], "p3": ["C. F. Gukmomuara"], "p4": ["Gukmoumara, Robert"], "p5": ["Dr. Christopher Gukmoumara Jr."],
        "q1": ["Li Na D. Vleirtbirndra"], "q2": ["Vleirtbirndra, Li Na"], "q3": ["Vleirtbirndra, Li Na D."], "q4": ["L. N. D. Vleirtbirndra"],
        "o1": ["The Drail Isolated Pattern Collaboration"], "o2": ["on behalf of the Drail Isolated Pattern Consortium"], "o3": ["Drail I. Pattern Collaboration"], "o4": ["Drail Coastal Ring Collaboration"],
        "e1": [" "], "e2": [None], "e3": ["?"],
    }
    rows = [(k, n, "x") for k, ns in ids.items() for n in ns] + [(None, "Nobody", "x"), ("p1", "Christopher F. Gukmoumara", "x")]
    filler = [(f"f{i}", f"{g} Xoril{i}aq", "x") for i, g in enumerate(["Christopher", "Robert", "Li Na"] * 6)] + [(f"g{i}", f"Xoril{i}aq, {g}", "x") for i, g in enumerate(["Christopher", "Robert", "Li Na"] * 6)]
    df = spark.createDataFrame(rows + filler, "id string, name string, v string")
    cluster = {r.id: r.cluster for r in names.name_clusters(df).collect()}
    groups = {}
    for k in ids:
        if k in cluster:
            groups.setdefault(cluster[k], set()).add(k)
    assert sorted(map(sorted, groups.values())) == [["o1", "o2", "o3"], ["o4"], ["p1", "p2", "p3", "p5"], ["p4"], ["q1", "q2", "q3", "q4"]]
    assert names.name_clusters(df.limit(0)).count() == 0
    crowded = {r.id: r.cluster for r in names.name_clusters(df, block=1).collect()}
    joined = lambda c: {(a, b) for a in c for b in c if c[a] == c[b]}
    assert joined({k: v for k, v in crowded.items() if k in ids and k != "p3"}) == joined({k: v for k, v in cluster.items() if k in ids and k != "p3"})


def test_near_words_of_a_crowded_anchor_are_those_of_a_calm_one(spark):
    df = spark.createDataFrame([(w, 1) for w in ("gelpindottir", "gelsirdottir", "gelpundottir", "helpindottir", "marbaldottir", "lindenberg", "lundanberg", "limdemberg")], "w string, count int")
    pairs = lambda block: {(r.w, r.v) for r in names.near_words(df, least=0.1, block=block).collect()}
    assert ("gelpindottir", "gelsirdottir") in pairs(200)
    assert pairs(1) == pairs(200)


def test_crowded_given_names_meet_as_calm_ones_do(spark):
    ids = {"p1": "William Gukmoumara", "p2": "Gukmoumara, Bily", "q1": "Christopher Vleirtbirndra", "q2": "Vleirtbirndra, Chrostophar", "o1": "Drail Deep Sky Survey Collaboration", "o2": "Drail Deep Sky S. Collaboration"}
    filler = [(f"f{i}", f"Xoril{i}aq, {g}") for i in range(8) for g in ("Christopher", "William")]
    df = spark.createDataFrame([*ids.items(), *filler], "id string, name string")

    def pairs(block):
        c = {r.id: r.cluster for r in names.name_clusters(df, block=block).collect()}
        return {(a, b) for a in ids for b in ids if a < b and c[a] == c[b]}

    assert pairs(200) == {("p1", "p2"), ("q1", "q2"), ("o1", "o2")} and pairs(1) == pairs(200)


def average_linkage(n, sims, least):
    clusters = [{i} for i in range(n)]
    s = lambda x, y: sum(sims.get((min(a, b), max(a, b)), 0) for a in x for b in y) / len(x) / len(y)
    while len(clusters) > 1:
        best, i, j = max((s(clusters[i], clusters[j]), i, j) for i in range(len(clusters)) for j in range(i))
        if best < least:
            break
        clusters[j] |= clusters[i]
        del clusters[i]
    return sorted(map(sorted, clusters))


@pytest.mark.parametrize("seed", range(2))
def test_average_linkage_equals_merging_one_pair_at_a_time(spark, seed):
    import random

    rng = random.Random(seed)
    sims = {(i, j): rng.uniform(0.3, 1) for i in range(14) for j in range(i + 1, 14) if rng.random() < 0.5}
    edges = spark.createDataFrame([(f"{a:02d}", f"{b:02d}", s) for (a, b), s in sims.items()], "a string, b string, s double")
    sizes = spark.createDataFrame([(f"{i:02d}", 1) for i in range(14)], "v string, n bigint")
    got = {}
    for r in names.average_linkage(edges, sizes, 0.45).collect():
        got.setdefault(r.cluster, []).append(int(r.v))
    assert sorted(map(sorted, got.values())) == average_linkage(14, sims, 0.45)
