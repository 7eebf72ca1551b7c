"""Variant spellings of people's and organisations' names linked: n-gram cosine joins and average-linkage clustering.

Every id's spellings are read into one profile (family, given, middle initial).
Family names are compared as weighted character n-gram vectors by a distributed
sparse cosine join; profiles that meet over a family name are scored by it, given
name and initials; scores are grouped by average linkage, in rounds that merge
reciprocal nearest clusters.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.llm.canonical import distance
from folioflow.operators.common import HOT_SHARE, hot_keys, removed, spread_join, table, written

#: Pet names and the names they are short for.
PET_NAMES = {
    "abby": "abigail", "gail": "abigail", "alex": "alexander alexandra", "sasha": "alexander alexandra", "sandy": "alexander alexandra", "andy": "andrew andreas andres", "tony": "anthony antonio", "ben": "benjamin", "benny": "benjamin", "chris": "christopher christine christina", "kit": "christopher", "dan": "daniel", "danny": "daniel", "dave": "david", "dima": "dmitri", "ed": "edward edwin", "eddie": "edward edwin", "ted": "edward theodore theodor", "ned": "edward", "liz": "elizabeth", "beth": "elizabeth", "betty": "elizabeth", "lisa": "elizabeth", "paco": "francisco", "pancho": "francisco", "frank": "francis franklin francisco", "fritz": "friedrich", "fred": "frederick friedrich alfred", "gabi": "gabriella gabriele", "gabby": "gabriella", "beppe": "giuseppe", "pepe": "giuseppe jose", "hans": "johannes", "johan": "johannes", "jo": "johannes joanna", "jadzia": "jadwiga", "jim": "james", "jimmy": "james", "jamie": "james", "jack": "john", "johnny": "john", "joe": "joseph", "kate": "katherine", "kathy": "katherine", "katie": "katherine", "kitty": "katherine", "lenny": "leonard", "leo": "leonard leopold", "lucy": "lucia", "peggy": "margaret", "maggie": "margaret", "meg": "margaret", "greta": "margaret", "tilly": "matilda", "mattie": "matilda", "matt": "matthew", "mike": "michael", "mick": "michael", "misha": "michael mikhail", "nick": "nicholas", "nico": "nicholas", "trish": "patricia", "pat": "patricia patrick", "patty": "patricia", "pete": "peter", "dick": "richard", "rick": "richard", "rich": "richard", "bob": "robert", "rob": "robert", "bobby": "robert", "sam": "samuel samantha", "steve": "stephen steven", "sue": "susanna susan", "susie": "susanna susan", "dora": "theodora dorothea", "thea": "theodora dorothea", "tom": "thomas", "tommy": "thomas", "vicky": "victoria", "vic": "victor victoria", "tori": "victoria", "bill": "william", "will": "william", "billy": "william", "liam": "william",
}
#: Names that stand together and are compared pair by pair; where there are more, a narrower key decides who meets.
BLOCK = 200
#: Names of a crowded block that initials alone meet in one task.
CHUNK = 1000
#: Spellings of one id that vote together.
VOTES = 1000
PARTICLES = frozenset("de di da do dos das del della der den van von vom zu la le du el al bin ibn ter ten st".split())
TITLES = frozenset("dr prof professor mr mrs ms sir phd md jr sr ii iii iv the".split())
BODIES = frozenset("collaboration collab consortium group network team project initiative society committee".split())
_FOLD = str.maketrans({"ø": "o", "æ": "ae", "œ": "oe", "ł": "l", "đ": "d", "ð": "d", "þ": "th", "ß": "ss", "ı": "i", "’": "'", "‐": "-", "‑": "-", "–": "-"})
_TOKEN = re.compile(r"[^\W\d_]+(?:['-][^\W\d_]+)*\.?")


def fold(text: str) -> str:
    text = unicodedata.normalize("NFKD", text.translate(_FOLD))
    return "".join(c for c in text if not unicodedata.combining(c)).lower().translate(_FOLD)


def spelled(name: str) -> tuple[list[tuple[str, str]], list[str], bool]:
    """(words, initials, body) of a name. A word has its side: "f" before a comma, "g" behind one, "" without one."""
    name = re.sub(r"^\W*on behalf of\b", " ", name, flags=re.I)
    shouted = not any(c.islower() for c in name)
    head, comma, tail = name.partition(",")
    if comma and fold(tail).strip(" .") in TITLES:
        head, comma, tail = head, "", ""
    words, initials, body = [], [], False
    for side, part in (("f" if comma else "", head), ("g" if comma else "", tail)):
        for token in _TOKEN.findall(part):
            t = fold(token)
            bare = t.rstrip(".")
            if bare in TITLES or bare in PARTICLES:
                continue
            if bare in BODIES:
                body = True
                continue
            letters = re.sub(r"[^a-z]", "", bare) if bare.isascii() else bare
            if len(letters) <= 1 or t.endswith(".") and len(letters) <= 2 and "-" in bare:
                initials += list(letters)
            elif len(letters) <= 3 and not shouted and side != "f" and token.rstrip(".").isupper():
                initials += list(letters)
            else:
                words.append((bare.replace("'", ""), side))
    return words, initials, body


_FORMS = pa.schema([("id", pa.string()), ("form", pa.int64()), ("body", pa.bool_()), ("initials", pa.string()), ("pos", pa.int32()), ("word", pa.string()), ("side", pa.string())])


def _spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for key, form, name in zip(*(c.to_pylist() for c in batch.columns)):
            words, initials, body = spelled(name)
            rows += [(key, form, body, "".join(initials), i, w, side) for i, (w, side) in enumerate(words)]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_FORMS)], schema=_FORMS)


def _initials(given: str) -> str:
    """The initials of the parts of a given name; a pet name has that of the name it is short for."""
    return "".join(w[0] for w in re.split("[ -]", PET_NAMES.get(given, given).split(" ")[0] if given in PET_NAMES else given) if w)


def profile(forms: list[dict]) -> tuple[str, str, str, bool]:
    """(family, given, initials, body) of an id by the vote of its spellings.

    Each row of forms is a word with its form, place, side and how often the corpus
    has it behind and before a comma (g, f). initials are those of given and middle
    name, "" where unknown. For a body (organisation) family is its first word and
    given the others.
    """
    by: dict[int, list[dict]] = {}
    for r in forms:
        by.setdefault(r["form"], []).append(r)
    families, givens, whole, alone, middle, bodies = Counter(), Counter(), Counter(), Counter(), Counter(), Counter()
    for rows in by.values():
        rows.sort(key=lambda r: r["pos"])
        initials = rows[0]["initials"] or ""
        if rows[0]["body"]:
            bodies[True] += 1
            families[rows[0]["word"]] += 1
            whole[(" ".join([r["word"] for r in rows[1:]]), initials)] += 1
            continue
        bodies[False] += 1
        if any(r["side"] for r in rows):
            family = [r["word"] for r in rows if r["side"] == "f"]
            given = [r["word"] for r in rows if r["side"] != "f"]
        else:
            known = [r for r in rows if r["f"] > r["g"]]
            new = [r for r in rows if r["f"] == 0 and r["g"] == 0]
            pick = known or new[-1:] or rows[-1:]
            if len(rows) > 1 and len(pick) == len(rows):
                pick = rows[-1:]
            if len(rows) == 1 and not initials and rows[0]["g"] > rows[0]["f"]:
                pick = []
            family = [r["word"] for r in rows if any(r is p for p in pick)]
            given = [r["word"] for r in rows if not any(r is p for p in pick)]
        families[" ".join(family)] += 1
        if given:
            givens[" ".join(given)] += 1
            if initials:
                middle[initials[0]] += 1
        elif initials:
            alone[initials] += 1

    common: dict[str, int] = {}
    for r in forms:
        common[r["word"]] = max(common.get(r["word"], 0), r["g"], r["f"])

    def top(c: Counter) -> str:
        """The most voted; of equals the one whose words the corpus has most, as slips are rare."""
        return min(c.items(), key=lambda x: (-x[1], x[0] in PET_NAMES, -min((common.get(w, 0) for w in x[0].split()), default=0), -len(x[0]), x[0]))[0] if c else ""

    if bodies[True] > bodies[False]:
        given, initials = max(whole.items(), key=lambda x: (len(x[0][0].split()), x[1], x[0]))[0]
        return top(families), given, initials, True
    given = top(Counter({k: n for k, n in givens.items() if k not in PET_NAMES}) or givens)
    if not given:
        return top(Counter({k: n for k, n in families.items() if k})), "", top(alone) or "?", False
    own = _initials(given)
    if not middle:  # a second initial may be that of a given name of two parts
        for s, n in alone.items():
            rest = s[len(own) :] if s.startswith(own) else s[1:] if s[:1] == own[:1] else ""
            if rest:
                middle[rest[0]] += n
    return top(Counter({k: n for k, n in families.items() if k})), given, own[0] + top(middle), False


_PROFILE = pa.schema([("id", pa.string()), ("family", pa.string()), ("given", pa.string()), ("initials", pa.string()), ("body", pa.bool_())])


def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(k, *profile(forms)) for k, forms in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_PROFILE)], schema=_PROFILE)


def profiles(spellings: DataFrame) -> DataFrame:
    """(id, family, given, initials, body) of each id of spellings (id, name); see profile()."""
    distinct = spellings.where("id is not null and name is not null").distinct().select("id", F.xxhash64("name").alias("form"), "name")
    words = distinct.mapInArrow(_spelled, "id string, form bigint, body boolean, initials string, pos int, word string, side string")
    words = written(words, "words")
    roles = words.where("not body and side <> ''").groupBy("word").agg(F.count_if(F.col("side") == "g").alias("g"), F.count_if(F.col("side") == "f").alias("f"))
    total = words.count()
    hot = F.broadcast(hot_keys(words, "word", total))
    seen = words.join(hot, "word", "left_semi").join(F.broadcast(roles.join(hot, "word", "left_semi")), "word", "left").unionByName(words.join(hot, "word", "left_anti").join(roles, "word", "left"))
    # Of ids with very many spellings each thousand votes on its own, so no task holds all of them; then the most frequent profile counts.
    many = words.groupBy("id").agg(F.countDistinct("form").alias("forms")).where(F.col("forms") > VOTES)
    seen = seen.join(many, "id", "left").withColumn("part", F.coalesce(F.pmod("form", F.ceil(F.col("forms") / VOTES)), F.lit(0)))
    whole = seen.groupBy("id", "part").agg(F.collect_list(F.struct("form", "body", "initials", "pos", "word", "side", F.coalesce("g", F.lit(0)).alias("g"), F.coalesce("f", F.lit(0)).alias("f"))).alias("forms"))
    voted = whole.select("id", "forms").mapInArrow(_profiles, "id string, family string, given string, initials string, body boolean").where("family <> ''")
    one = F.struct("family", "given", "initials", "body")
    return voted.groupBy("id", one.alias("p")).agg(F.count("*").alias("c")).groupBy("id").agg(F.max(F.struct("c", "p")).alias("m")).select("id", "m.p.*")


def slipped(word):
    """A word and all forms of it with one letter left out: words one slip apart have one of these in common."""
    return F.concat(F.array(word), F.transform(F.sequence(F.lit(1), F.char_length(word)), lambda i: F.concat(F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, F.char_length(word)))))


def slipped_twice(word):
    """A word and all forms of it with one or two letters left out: words two slips apart have one of these in common."""
    return F.array_distinct(F.flatten(F.transform(slipped(word), slipped)))


def near_words(words: DataFrame, least: float = 0.35, n: int = 3, block: int = BLOCK) -> DataFrame:
    """(w, v, cosine) for distinct words (w, count) whose weighted n-gram vectors have a cosine of `least` or more.

    Only words that keep their first or last half can be one slip apart, so candidates
    share an anchored n-gram of half their length (words of one or two letters only equal ones); their exact cosine is then the sum
    of products over all common n-grams. In an anchor that more than `block` words
    share only those meet that also have a form with up to two letters left out in
    common, which all words two slips apart have.
    """
    marked = F.concat(F.lit("^"), F.col("w"), F.lit("$"))
    size = F.char_length("w")
    words = words.where(size >= 3)
    anchors = words.select("w", F.explode(F.array(
        *[F.concat(F.lit("^"), F.substring("w", 1, 1), F.lit("|"), (F.expr("substring(w, 1, greatest(2, cast(floor(char_length(w) / 2) as int)) - %d)" % d))) for d in (0, 1)],
        *[F.concat(F.lit("$|"), F.expr("right(w, greatest(2, cast(floor(char_length(w) / 2) as int)) - %d)" % d)) for d in (0, 1)],
    )).alias("key"), size.alias("n")).distinct()
    wide = anchors.groupBy("key").agg(F.count("*").alias("held")).where(F.col("held") > block).select("key")
    narrowed = anchors.join(wide, "key", "left_semi").select("w", "key", "n", F.explode(slipped_twice(F.col("w"))).alias("form")).select("w", F.concat_ws("|", "key", "form").alias("key"), "n")
    anchors = written(anchors.join(wide, "key", "left_anti").select("w", "key", "n").unionByName(narrowed), "anchors")
    pairs = anchors.join(anchors.toDF("v", "key", "m"), "key").where((F.col("w") < F.col("v")) & (F.abs(F.col("n") - F.col("m")) <= 2)).select("w", "v").distinct()
    pairs = pairs.where(F.levenshtein("w", "v", 2) >= 0)
    grams = words.select("w", F.explode(F.transform(F.sequence(F.lit(1), size + 3 - n), lambda i: F.substring(marked, i, F.lit(n)))).alias("g")).groupBy("w", "g").agg(F.count("*").alias("c"))
    total = words.count()
    weight = written(grams.groupBy("g").agg(F.count("*").alias("n")), "weight")
    hot = weight.where(F.col("n") > max(1000, (weight.agg(F.sum("n")).first()[0] or 0) // HOT_SHARE)).select("g")
    grams = spread_join(grams, weight.select("g", F.log(1 + F.lit(total) / F.col("n")).alias("idf")), "g", hot).select("w", "g", (F.col("c") * F.col("idf")).alias("x"))
    norm = grams.groupBy("w").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    grams = written(grams.join(norm, "w").select("w", "g", (F.col("x") / F.col("norm")).alias("x")), "grams")
    dots = pairs.join(grams, "w").join(grams.toDF("v", "g", "y"), ["v", "g"]).groupBy("w", "v").agg(F.sum(F.col("x") * F.col("y")).alias("cosine"))
    return dots.where(F.col("cosine") >= least)


def _given_likeness(a: str, b: str, known: bool) -> float:
    if a == b:
        return 1.0
    x, y = set((PET_NAMES.get(a) or a).split(" ") if " " not in a else [a]), set((PET_NAMES.get(b) or b).split(" ") if " " not in b else [b])
    if x & y or a in y or b in x:
        return 0.97
    n = max(len(a), len(b))
    most = 1 if n <= 6 else 2
    if not known and abs(len(a) - len(b)) <= most and distance(a, b, most) <= most:
        return 0.9
    for s, t in ((a, b), (b, a)):  # a pet name or the name it is short for with a slip
        for formal in PET_NAMES.get(t, "").split():
            if not known and min(len(s), len(formal)) >= 4 and distance(s, formal, 1) <= 1:
                return 0.88
        for pet in PET_NAMES:
            if len(pet) >= 3 and t in PET_NAMES[pet].split() and len(s) >= 2 and abs(len(s) - len(pet)) <= 1 and not known and distance(s, pet, 1) <= 1:
                return 0.88
    return 0.0


def _word_fits(short: list[str], initials: str, long: list[str]) -> float:
    rest, hits = list(long), 0
    for w in short:
        hit = next((u for u in rest if u == w), None) or next((u for u in rest if min(len(u), len(w)) >= 4 and distance(u, w, 2 if len(w) > 6 else 1) <= (2 if len(w) > 6 else 1)), None)
        if hit is None:
            return 0.0
        rest.remove(hit)
        hits += 1
    for c in initials:
        hit = next((u for u in rest if u.startswith(c)), None)
        if hit is None:
            return 0.0
        rest.remove(hit)
        hits += 0.9
    return hits / max(1, len(long)) if long else 1.0


def likeness(x: dict, y: dict, family: float, known: bool) -> float:
    """How like two profiles are, 0 if they contradict each other; known: both given names are about as frequent."""
    if x["body"] != y["body"]:
        return 0.0
    if x["body"]:
        a, b = x["given"].split(), y["given"].split()
        if len(a) > len(b):
            x, y, a, b = y, x, b, a
        return family * _word_fits(a, x["initials"], b) if len(a) + len(x["initials"]) <= len(b) or x["initials"] == y["initials"] else 0.0
    if not x["given"]:
        x, y = y, x
    xi, yi = x["initials"], y["initials"]
    if x["given"] and y["given"]:
        given = _given_likeness(x["given"], y["given"], known)
        middle = 1.0 if xi[1:2] == yi[1:2] else 0.97 if not xi[1:2] or not yi[1:2] else 0.35
        return family * given * middle
    if "?" in (xi[:1], yi[:1]):
        return 0.0
    # Initials alone on at least one side: they must begin the same, with or without those of a given name's further parts.
    forms = {xi, _initials(x["given"]) + xi[1:]} if x["given"] else {xi}
    if any(f == yi and len(yi) > 1 for f in forms):
        return family * 0.85
    return family * 0.75 if any(f.startswith(yi) or yi.startswith(f) for f in forms) else 0.0


_PAIR = pa.schema([("a", pa.string()), ("b", pa.string()), ("s", pa.float64())])


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            s = likeness(r["x"], r["y"], r["cosine"], r["known"])
            if s > 0.2:
                rows.append((r["a"], r["b"], s))
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_PAIR)], schema=_PAIR)


def average_linkage(edges: DataFrame, sizes: DataFrame, least: float) -> DataFrame:
    """(v, cluster) by average linkage over sparse similarities (a, b, s); absent pairs count as 0.

    sizes has (v, n), the members each vertex stands for. In each round every cluster
    finds the one it is most like on average, and those that choose each other merge;
    as average linkage never makes a merged cluster more like a third than its parts
    were, this gives the dendrogram of merging one pair at a time, cut at `least`. No
    cluster is ever gathered in one task; ties fall to the smaller name.
    """
    now = written(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "s").where("a <> b").join(sizes.toDF("a", "na"), "a").join(sizes.toDF("b", "nb"), "b").groupBy("a", "b", "na", "nb").agg((F.max("s") * F.col("na") * F.col("nb")).alias("total")), "links")
    label = start = sizes.select("v", F.col("v").alias("cluster"))
    while True:
        live = now.select("a", "b", "na", "nb", "total", (F.col("total") / (F.col("na") * F.col("nb"))).alias("s")).where(F.col("s") >= least)
        arcs = live.select(F.col("a").alias("v"), F.col("b").alias("w"), "s").unionByName(live.select(F.col("b").alias("v"), F.col("a").alias("w"), "s"))
        # Of equally like pairs the one with the smaller ends counts as nearer for both, so some pair always agrees.
        best = arcs.groupBy("v").agg(F.max_by("w", F.struct(F.col("s"), -F.xxhash64(F.least("v", "w"), F.greatest("v", "w")))).alias("w"))
        merge = best.join(best.select(F.col("v").alias("w"), F.col("w").alias("v")), ["v", "w"]).where("v < w").select("v", "w")
        merge = written(merge, "merge")
        if merge.isEmpty():
            removed(now)
            return label
        to = merge.select(F.col("w").alias("old"), F.col("v").alias("new"))
        before, last = label, now
        label = written(label.join(to, label.cluster == to.old, "left").select("v", F.coalesce("new", "cluster").alias("cluster")), "label")
        moved = now.join(to.toDF("a", "ta"), "a", "left").join(to.toDF("b", "tb"), "b", "left").select(F.coalesce("ta", "a").alias("a"), F.coalesce("tb", "b").alias("b"), "total").where("a <> b")
        count = label.join(sizes, "v").groupBy("cluster").agg(F.sum("n").alias("n"))
        now = written(moved.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.sum("total").alias("total")).join(count.toDF("a", "na"), "a").join(count.toDF("b", "nb"), "b"), "links")
        for t in (merge, last, *([before] if before is not start else [])):
            removed(t)


def name_clusters(spellings: DataFrame, least: float = 0.5, block: int = BLOCK) -> DataFrame:
    """(id, cluster): ids whose names are variants of one; spellings has (id, name), several rows for an id.

    Ids with equal profiles are one vertex, so copies cost nothing. Vertices meet by
    family name (the same or a near one) with the initial of the given name, also its
    second letter to allow for a slip. Ids without a name, or of which no family name
    can be read, are in no row. Ids compare as they are; repeated rows add nothing.
    """
    each = written(profiles(spellings), "profiles")
    key = F.concat_ws("|", "family", "given", "initials", F.col("body").cast("string"))
    vertices = written(each.groupBy(key.alias("v"), "family", "given", "initials", "body").agg(F.count("*").alias("n"), F.min("id").alias("least_id")), "vertices")
    # One name and initials known to be those of one person, but not the initials alone: copies share a cluster by their vertex.
    words = vertices.select(F.col("family").alias("w"), "n").groupBy("w").agg(F.sum("n").alias("count"))
    near = near_words(words, block=block).join(words.toDF("w", "cw"), "w").join(words.toDF("v", "cv"), "v")
    # A word also stands under the near word that is more frequent, so two slips of one name meet there.
    up = near.select(F.when((F.col("cv") > F.col("cw")) | ((F.col("cv") == F.col("cw")) & (F.col("v") < F.col("w"))), F.col("w")).otherwise(F.col("v")).alias("family"), F.when((F.col("cv") > F.col("cw")) | ((F.col("cv") == F.col("cw")) & (F.col("v") < F.col("w"))), F.col("v")).otherwise(F.col("w")).alias("block"), "cosine")
    up = written(up, "near")
    own = vertices.select("v", "family", F.col("family").alias("block"), F.lit(1.0).alias("cosine"))
    other = vertices.select("v", "family").join(up, "family").select("v", "family", "block", "cosine")
    starts = F.when(F.col("body"), F.array(F.lit("#"))).otherwise(F.array_distinct(F.filter(F.array(F.substring("initials", 1, 1), F.when(F.length("given") > 2, F.substring("given", 1, 1)), F.when(F.length("given") > 2, F.substring("given", 2, 1))), lambda c: c.isNotNull() & (c != "?") & (c != ""))))
    facts = vertices.select("v", F.struct("given", "initials", "body").alias("x"), starts.alias("starts"), "family")
    placed = written(own.unionByName(other).join(facts.drop("family"), "v").select("v", "family", "block", "cosine", "x", F.explode("starts").alias("start")), "placed")
    frequent = vertices.where("not body and given <> ''").groupBy("given").agg(F.countDistinct("family").alias("families"))
    # Where more than `block` profiles stand together, given names meet by forms with letters left out, which all that
    # likeness() accepts have in common: of the name, of the names it is short for and its pet names with one slip; of an
    # organisation, of each word. Initials alone are few and still meet every name.
    wide = placed.groupBy("block", "start").agg(F.count("*").alias("held")).where(F.col("held") > block).select("block", "start", F.ceil(F.col("held") / CHUNK).cast("int").alias("chunks"))
    pets: dict[str, str] = {}
    for k, v in PET_NAMES.items():
        for x in v.split():
            pets[x] = f"{pets[x]} {k}" if x in pets else k
    table_of = lambda d: F.create_map(*[F.lit(x) for k, v in d.items() for x in (k, v)])
    related = lambda d: F.filter(F.split(F.coalesce(F.try_element_at(table_of(d), F.col("x.given")), F.lit("")), " "), lambda w: w != "")
    deep = lambda w: F.when(F.char_length(w) >= 5, slipped_twice(w)).otherwise(slipped(w))
    of_person = F.concat(deep(F.col("x.given")), F.flatten(F.transform(F.concat(related(PET_NAMES), related(pets)), slipped)))
    of_body = F.flatten(F.transform(F.split("x.given", " "), deep))
    forms = F.array_distinct(F.when(F.col("x.body"), of_body).otherwise(of_person))
    crowded = placed.join(wide, ["block", "start"])
    by_form = crowded.where("x.given <> ''").withColumn("form", F.explode(forms))
    # All names of a block stand in chunks, and initials alone meet each chunk in a task of its own.
    initial = crowded.where("x.given = ''").withColumn("form", F.explode(F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda c: F.concat(F.lit("#"), c.cast("string")))))
    every = crowded.withColumn("form", F.concat(F.lit("#"), F.pmod(F.xxhash64("v"), F.col("chunks")).cast("string")))
    calm = placed.join(wide, ["block", "start"], "left_anti").withColumn("form", F.lit(""))
    keep = ["block", "start", "form", "v", "family", "cosine", "x"]

    def meet(one: DataFrame, other: DataFrame, rule: str) -> DataFrame:
        left = one.select("block", "start", "form", F.col("v").alias("a"), F.col("family").alias("fa"), F.col("cosine").alias("ca"), "x")
        right = other.select("block", "start", "form", F.col("v").alias("b"), F.col("family").alias("fb"), F.col("cosine").alias("cb"), F.col("x").alias("y"))
        cosine = F.when(F.col("fa") == F.col("fb"), 1.0).otherwise(F.sqrt(F.col("ca") * F.col("cb")))
        return left.join(right, ["block", "start", "form"]).where(rule).select("a", "b", "x", "y", cosine.alias("cosine"))

    same = calm.select(*keep).unionByName(by_form.select(*keep))
    met = meet(same, same, "a < b")
    lone = meet(initial.select(*keep), every.select(*keep), "a <> b")
    turned = F.col("a") > F.col("b")
    met = met.unionByName(lone.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.when(turned, F.col("y")).otherwise(F.col("x")).alias("x"), F.when(turned, F.col("x")).otherwise(F.col("y")).alias("y"), "cosine"))
    met = met.groupBy("a", "b").agg(F.max("cosine").alias("cosine"), F.first("x").alias("x"), F.first("y").alias("y"))
    # Two near given names are two names if both are about as frequent, else the rarer one is a slip of the other.
    met = met.join(frequent.toDF("ga", "ka"), F.col("x.given") == F.col("ga"), "left").join(frequent.toDF("gb", "kb"), F.col("y.given") == F.col("gb"), "left").withColumn("known", F.coalesce((F.least("ka", "kb") >= 5) & (F.least("ka", "kb") * 5 > F.greatest("ka", "kb")), F.lit(False)))
    # A cosine of one slip counts nearly as the same family: what decides is whether the given names agree.
    edges = met.select("a", "b", "x", "y", (0.6 + 0.4 * F.col("cosine")).alias("cosine"), "known").mapInArrow(_scored, "a string, b string, s double")
    clusters = average_linkage(written(edges, "scored"), vertices.select("v", "n"), least)
    return each.withColumn("v", key).join(clusters, "v").select("id", "cluster")


def author_spellings(authors: DataFrame, links: DataFrame) -> DataFrame:
    """(id, name): the display names of authors and the names typed for them in their works."""
    shown = authors.select(F.col("canonical_author_id").alias("id"), F.col("display_name").alias("name"))
    typed = links.select(F.col("canonical_author_id").alias("id"), F.col("raw_author_name").alias("name")).where("name is not null").distinct()
    return shown.unionByName(typed.join(shown.select("id").distinct(), "id", "left_semi")).where(F.coalesce(F.trim("name") != "", F.lit(False))).distinct()


def p3_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(canonical_author_id, cluster) of every author with a readable name."""
    spellings = author_spellings(table(spark, sf_dir, "canonical_authors", "canonical_author_id", "display_name"), table(spark, sf_dir, "canonical_work_authors", "canonical_author_id", "raw_author_name"))
    return name_clusters(spellings).select(F.col("id").alias("canonical_author_id"), "cluster")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(author_id_a, author_id_b) for each pair of ids of one person or organisation; see name_clusters()."""
    each = written(p3_clusters(spark, sf_dir), "clusters")
    return each.select(F.col("canonical_author_id").alias("author_id_a"), "cluster").join(each.select(F.col("canonical_author_id").alias("author_id_b"), "cluster"), "cluster").where("author_id_a < author_id_b").select("author_id_a", "author_id_b")
