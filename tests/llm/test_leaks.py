"""Leaks of evaluation items: planted parts, dirt and look-alikes against a slow search."""

import random

from folioflow.llm import leaks as L

WORDS = [f"w{a}{b}" for a in "abcdefghij" for b in "klmnopqrstuvwxyz"]
WORDS = [w.replace("w", "") + "ing" for w in WORDS]


def table(spark, rows, kind):
    return spark.createDataFrame([(*r, 0) for r in rows], f"{kind} bigint, text string, found int")


def run(spark, docs, items, **more):
    return {tuple(r) for r in L.leaked_items(table(spark, docs, "doc_id"), table(spark, items, "item_id"), **more).collect()}


def passage(rng, n):
    return [rng.choice(WORDS) for _ in range(n)]


def test_planted_parts(spark):
    rng = random.Random(4)
    items = [(k, passage(rng, n)) for k, n in enumerate((10, 15, 16, 40, 90, 3))]
    docs, due = [], set()

    def put(words, hit):
        d = len(docs)
        docs.append((d, " ".join(passage(rng, 30) + words + passage(rng, 30))))
        if hit is not None:
            due.add((d, hit))

    for k, w in items:
        put(w, k)
    change = lambda w, at: [("changed" + "x" * (i % 3)) if i in at else x for i, x in enumerate(w)]
    put(items[3][1][7:22], 3)
    put(change(items[3][1][7:23], {5, 10}), 3)  # two of sixteen, five whole words at most in a row
    put(change(items[3][1][7:22], {7}), 3)
    put(items[3][1][7:21], None)  # fourteen words
    put(change(items[3][1][7:22], {3, 7, 11}), None)  # three of fifteen
    put(items[0][1][:9], 0)  # one of ten, the last, is another
    put(items[0][1][:8], None)  # a short item counts as a whole only
    put(items[4][1][:20] + ["put"] + items[4][1][20:40], 4)
    put(items[4][1][:20] + items[4][1][21:40], 4)
    assert run(spark, docs, [(k, " ".join(w)) for k, w in items]) == due


def test_layout_does_not_matter(spark):
    words = "the quick brown fox jumps over one lazy dog while many other animals look at it calmly".split()
    item = " ".join(words)
    docs = [
        item.upper().replace(" ", ",\n "), "<p>" + item.replace("fox", "<b>fox</b>").replace("dog", "dog<sup>3</sup>") + "</p>", item.replace("animals", "ani-\nmals").replace("lazy", "la­zy"),
        item.replace("o", "о").replace("a", "а"), item.replace("quick", "\\emph{quick}").replace("while", "[12] while"), item.replace("brown", "br0wn").replace("calmly", "ca1mly"), item.replace("i", "​i"), item.replace("e", "é"),
    ]
    assert run(spark, list(enumerate(docs)), [(7, item)]) == {(i, 7) for i in range(len(docs))}


def test_nulls_empties_copies_and_long_texts(spark):
    text = " ".join(WORDS[:20])
    docs = [(1, None), (2, ""), (3, "  "), (4, text), (4, text), (5, "filler " * 60_000 + text), (None, "x")]
    assert run(spark, docs, [(1, text), (1, text), (2, None), (3, ""), (4, "!!"), (None, text)]) == {(4, 1), (5, 1)}
    assert run(spark, [], [(1, text)]) == set() and run(spark, docs, []) == set()


def test_short_items_with_a_changed_word(spark):
    rng = random.Random(8)
    items = [(n, passage(rng, n)) for n in (1, 2, 4, 5, 7, 8, 9, 11, 14)]
    docs, due = [], set()
    for n, w in items:
        for k in range(n):
            for new in (["changed"], [], ["put", w[k]]):
                docs.append((len(docs), " ".join(["before"] * 9 + w[:k] + new + w[k + 1 :] + ["behind"] * 9)))
                if n >= 8:  # one word in eight; a word put in before the first or behind the last is no change
                    due.add((len(docs) - 1, n))
                elif new[:1] == ["put"] and k == 0:
                    due.add((len(docs) - 1, n))
    found = run(spark, docs, [(n, " ".join(w)) for n, w in items])
    assert {x for x in found if x[1] > 2} == {x for x in due if x[1] > 2}


def test_blocks_of_items_find_the_same(spark):
    rng = random.Random(9)
    items = [(k, " ".join(passage(rng, 20))) for k in range(7)]
    docs = [(k, t) for k, t in items] + [(9, items[3][1] + " and " + items[5][1])]
    assert run(spark, docs, items, block=3) == run(spark, docs, items) == {(k, k) for k in range(7)} | {(9, 3), (9, 5)}


def test_rates_keep_small_parts_whole():
    assert L.sketch_rate(100, 15, 8) == 1.0 and L.intact_shingles(15, 8) == 2
    assert L.sketch_rate(400, 300, 10**6) < 0.2
