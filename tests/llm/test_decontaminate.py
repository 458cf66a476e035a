"""Template decontamination: planted leaks, exchanged slots, clean texts."""

import random

import pytest
from pyspark.sql import functions as F

from cabmeter.llm import decontaminate as D
from cabmeter.llm import queries

ITEM = ("A farmer called Tom Miller sells 14 boxes of apples for 3.50 dollars each to Anna and "
        "then Tom Miller gives 14 more boxes to a school near the river before lunch")
SHORT = "Which river runs past the old mill?"


def _pairs(df):
    return {(r["doc_id"], r["item_id"]) for r in df.collect()}


@pytest.mark.parametrize("limit", [D.MAX_BROADCAST, 0])
def test_planted_and_clean(spark, limit):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    noise = lambda n: " ".join(word() for _ in range(n))
    swapped = (ITEM.replace("Tom Miller", "Éva").replace("14", "2,300").replace("3.50", "9")
               .replace("dollars", "euros").replace("Anna", "Bo Lee Chan"))
    cases = {
        1: (noise(50) + " " + ITEM + " " + noise(40), True),
        2: (ITEM.upper().replace(" ", " \n"), False),       # capitals hide names and each line starts a sentence
        3: (noise(9) + ", " + ITEM.replace(" ", "  ") + ".", True),
        4: (noise(30) + ". " + swapped, True),
        5: (noise(200), False),
        6: (" ".join(ITEM.split()[:9]) + " " + noise(30), False),
        7: (noise(3) + " " + " ".join(ITEM.split()[10:27]) + " " + noise(30), True),
        8: (None, False), 9: ("", False), 10: ("| $$ !! |", False),
        11: ("12 13 14 15 16 17 18 19 20 21 22 23 24 25 26 27", False),
    }
    rows = [(k, t) for k, (t, _) in cases.items()] + [(1, cases[1][0]), (None, ITEM), (50, noise(20) + " " + SHORT)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("item", F.lit(0)).withColumn("h", F.lit(1))
    bench = spark.createDataFrame(
        [(100, ITEM), (100, ITEM), (200, SHORT), (300, None), (400, ""), (500, "Yes 7")], "item_id long, text string"
    ).withColumn("doc_id", F.lit(1))
    got = D.find_leaks(docs, bench, limit=limit)
    found = _pairs(got)
    for k, (_, leaked) in cases.items():
        assert ((k, 100) in found) == leaked, k
    assert (None, 100) in found and (50, 200) in found
    assert {i for _, i in found} == {100, 200}
    assert got.count() == len(found)
    # Different fillers where the item repeats one within a window do not count.
    riddle = "so Bob takes 7 red pens and Bob gives all 7 to the clerk"
    pairs = [(1, riddle), (2, riddle.replace("7", "31").replace("Bob", "Ida Roe")),
             (3, riddle.replace("takes 7", "takes 31")), (4, riddle.replace("and Bob", "and Tim"))]
    riddles = spark.createDataFrame([(9, riddle)], "item_id long, text string")
    assert _pairs(D.find_leaks(spark.createDataFrame(pairs, "doc_id long, text string"), riddles, limit=limit)
                  ) == {(1, 9), (2, 9)}
    clashing = docs.withColumn("doc", F.lit("x")).withColumn("th", F.lit(1)).withColumn("item", F.lit(None))
    kept = D.drop_leaked(clashing, bench, limit=limit)
    assert kept.columns == clashing.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted(
        [k for k, (_, leaked) in cases.items() if not leaked], key=str)
    assert D.find_leaks(docs.limit(0), bench, limit=limit).count() == 0
    assert D.drop_leaked(docs, bench.limit(0), limit=limit).count() == len(rows)
    assert D.find_leaks(docs, bench.limit(0), limit=limit).count() == 0


def test_whole_items_in_given_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    bench = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    want = {(d, i) for d, t in docs.items() for i, b in bench.items() if b in t}
    got = _pairs(queries.op4_decontaminate(spark, sf))
    assert want <= got
    plain = lambda t: [w.strip(".,").lower() for w in t.split()]
    grams = {i: {tuple(w[k:k + 13]) for k in range(len(w) - 12)} for i, w in ((i, plain(b)) for i, b in bench.items())}
    for d, i in got - want:  # anything else shares a run of 13 words
        w = plain(docs[d])
        assert grams[i] & {tuple(w[k:k + 13]) for k in range(len(w) - 12)}


@pytest.mark.parametrize("limit", [D.MAX_BROADCAST, 0])
def test_exchanged_names_that_begin_sentences(spark, limit):
    one = "Maria buys 12 pens and gives half of them to her old brother"
    many = "Maria has 5 red hats to sell. Maria Lopez sells 2 of them today. The shop then pays Maria for both."
    items = spark.createDataFrame([(1, one), (2, many)], "item_id long, text string")
    other = many.replace("Maria Lopez", "Peter").replace("Maria", "Peter").replace("5", "8")
    docs = spark.createDataFrame([
        (1, one.replace("Maria", "Peter").replace("12", "30")), (2, "All is well. " + one.replace("Maria", "Ida Roe")),
        (3, "so it goes that " + one.replace("Maria", "Bo")), (4, other.replace("Peter sells", "Peter Cho sells")),
        (5, "It is said: " + many.replace("Maria", "Zoë")), (6, "Peter has a hat.\nMaria buys a shop"),
        (7, one.replace("Maria buys", "Peter sells")), (8, many)], "doc_id long, text string")
    want = {(1, 1), (2, 1), (3, 1), (4, 2), (5, 2), (8, 2)}
    assert _pairs(D.find_leaks(docs, items, limit=limit)) == want
    assert sorted(r["doc_id"] for r in D.drop_leaked(docs, items, limit=limit).collect()) == [6, 7]


@pytest.mark.parametrize("limit", [D.MAX_BROADCAST, 0])
def test_verbatim_copies_of_windows_without_words(spark, limit):
    items = {1: "12 + 30 = 42 km, 7 x 8 = 56 kg, 90 - 31 = 59 and 14 / 2 = 7 cm",
             2: "Anna Berg, Tom Miller, Ida Roe; Bo Chan, Zoë Lund, Émile Roux; Ada King, Max Born, Lise Ott", 3: "17 x 23 = 391"}
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    rows = [(k, f"so we see that {t}, as was said") for k, t in items.items()]
    rows += [(11, items[1].replace("56", "57")), (12, items[2].replace("Chan", "Lee")), (13, "17 x 24 = 391")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert _pairs(D.find_leaks(docs, bench, limit=limit)) == {(1, 1), (2, 2), (3, 3)}
    assert sorted(r["doc_id"] for r in D.drop_leaked(docs, bench, limit=limit).collect()) == [11, 12, 13]


@pytest.mark.parametrize("limit", [D.MAX_BROADCAST, 0])
def test_copies_with_other_lines_or_in_lower_case(spark, limit):
    bench = spark.createDataFrame([(100, ITEM)], "item_id long, text string")
    rows = [(1, ITEM.lower()), (2, ITEM.replace(" ", "\n")), (3, ITEM.lower().replace(" ", " \n")),
            (4, ITEM.lower().replace("apples", "pears").replace("anna", "ida").replace("school", "church"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert _pairs(D.find_leaks(docs, bench, limit=limit)) == {(1, 100), (2, 100), (3, 100)}
    assert [r["doc_id"] for r in D.drop_leaked(docs, bench, limit=limit).collect()] == [4]


@pytest.mark.parametrize("limit", [D.MAX_BROADCAST, 0])
def test_repeated_fillers_of_one_class(spark, limit):
    """Two or three slots of one class, all equal in the item, and slots that
    differ in the item but not in the document."""
    two = "box on shelf holds 7 red and 7 blue caps for the club"
    three = "box on shelf holds 7 red and 7 blue and 7 old caps for clubs"
    free = "tray on desk holds 3 red and 5 blue caps for the club"
    items = spark.createDataFrame([(1, two), (2, three), (3, free)], "item_id long, text string")
    put = lambda text, *n: text.replace("7", "%s").replace("3", "%s").replace("5", "%s") % n
    docs = spark.createDataFrame([
        (1, put(two, 3, 5)), (2, put(two, 4, 4)), (3, put(three, 1, 1, 2)), (4, put(three, 1, 2, 2)), (5, put(three, 9, 9, 9)),
        (6, put(free, 4, 4)), (7, put(free, 8, 6)), (8, two), (9, put(three, 1, 2, 1))], "doc_id long, text string")
    assert _pairs(D.find_leaks(docs, items, limit=limit)) == {(2, 1), (5, 2), (6, 3), (7, 3), (8, 1)}
    assert sorted(r["doc_id"] for r in D.drop_leaked(docs, items, limit=limit).collect()) == [1, 3, 4, 9]


def _leaks_by_hand(item, doc):
    """Whether a document holds a window of an item, for texts of lower-case
    words and numbers."""
    a, b = item.split(), doc.split()
    size = min(len(a), D.WINDOW)
    least = D.LEAST_WORDS if size == D.WINDOW else D.LEAST_WORDS_SHORT
    for i in range(len(a) - size + 1):
        for k in range(len(b) - size + 1):
            x, y = a[i:i + size], b[k:k + size]
            if x == y:
                return True
            slots = [(p, q) for p, q in zip(x, y) if p.isdigit()]
            if any(p.isdigit() != q.isdigit() or not p.isdigit() and p != q for p, q in zip(x, y)):
                continue
            if size - len(slots) >= least and all(q == s for p, q in slots for r, s in slots if p == r):
                return True
    return False


@pytest.mark.parametrize("limit", [D.MAX_BROADCAST, 0])
def test_random_templates_match_brute_force(spark, limit):
    rng = random.Random(11)
    stems = ["red", "box", "cap", "club", "shop", "lane"]

    def text(n):
        return " ".join(str(rng.randint(1, 3)) if rng.random() < .35 else rng.choice(stems) for _ in range(n))

    items = {i: text(rng.choice([6, 9, 12, 13, 15, 20])) for i in range(40)}
    docs = {}
    for d in range(300):
        new = {str(k): str(rng.randint(1, 4)) for k in range(1, 4)}
        kept = [rng.choice([new[w], w, str(rng.randint(1, 3))]) if w.isdigit() and rng.random() < .4 else new.get(w, w)
                for w in items[rng.randrange(40)].split()]
        docs[d] = " ".join(["so", *kept, "end"]) if rng.random() < .9 else text(30)
    want = {(d, i) for d, t in docs.items() for i, s in items.items() if _leaks_by_hand(s, t)}
    assert 60 < len(want) and len({d for d, _ in want}) < 290
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    assert _pairs(D.find_leaks(frame, bench, limit=limit)) == want
    kept = {r["doc_id"] for r in D.drop_leaked(frame, bench, limit=limit).collect()}
    assert kept == set(docs) - {d for d, _ in want}
