"""Leaks of short and number-rich items, of names that open sentences, and of items that stand twice in a document."""

import random

import pytest

from fleetlens.llm import decontaminate

PENS = "Tom has 5 red pens. Sam has 3 blue pens. How many pens do they have?"
TRAIN = "A train leaves Boston at 60 miles per hour and reaches the far station after 5 hours"
PLAIN = "some other words that lead up to it all. "


def found(spark, docs, items):
    docs, items = (spark.createDataFrame(list(enumerate(x)), f"{k} long, text string") for x, k in ((docs, "doc_id"), (items, "item_id")))
    return {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, items).collect()}


def test_short_and_number_rich_items(spark):
    items = ["What is 12 times 7?", "1 2 4 7 11 16 22 29 37 46", "2 3 5 8 13 21 34 55 what comes next"]
    docs = [PLAIN + x + " and more" for x in items] + [PLAIN + "what is 9 times 8", PLAIN + "3 9 1 4 44 12 90 2 8 7 5", PLAIN + "what is there"]
    assert found(spark, docs, items) == {(0, 0), (1, 1), (2, 2), (3, 0)}


def test_names_that_open_sentences(spark):
    rewritten = PENS.replace("Tom", "Ann").replace("Sam", "Bob").replace("5", "8").replace("3", "2")
    assert found(spark, [PLAIN + rewritten, PLAIN * 5], [PENS]) == {(0, 0)}


@pytest.mark.parametrize("more", ["", "a 7 at the end "])
def test_each_occurrence_is_judged_by_itself(spark, more):
    item = "Take 3 cups and 5 bowls then 9 plates and 2 pans so 4 forks " + more
    other = item.replace("3", "6").replace("5", "8").replace("9", "1").replace("2", "7")
    same = item.replace("3", "6").replace("5", "6")
    docs = [item + PLAIN * 3 + other, other + PLAIN * 3 + other.replace("6", "12"), same]
    assert found(spark, docs, [item, TRAIN]) == {(0, 0), (1, 0), (2, 0)}


# ---------------------------------------------------------------- shared phrases, recall over many patterns

RNG = random.Random(8)
SYLLABLES = ["ba", "ce", "di", "fo", "gu", "ha", "ji", "ko", "lu", "me", "na", "po"]
WORDS = sorted({"".join(RNG.choice(SYLLABLES) for _ in range(RNG.randint(2, 4))) for _ in range(1200)})
STOCK = "Which of the following statements is the best answer to the question that was asked above"


def prose(n, rng=RNG, pre=""):
    return " ".join(pre + rng.choice(WORDS) for _ in range(n))


@pytest.mark.parametrize("pre", ["", "9"])
def test_a_stock_question_is_no_leak(spark, pre):
    """Clean documents share a question's wording with many items; also where all else in the items is slots."""
    items = [f"{prose(30, pre=pre)}. {STOCK}" for _ in range(120)]
    clean = [f"{prose(60, pre=pre)}. {STOCK} {prose(40)}" for _ in range(120)]
    copies = [f"{prose(20)}. {items[k]} {prose(20)}" for k in range(0, 120, 10)]
    got = found(spark, clean + copies, items)
    assert got == {(120 + k, 10 * k) for k in range(12)}


def test_a_family_of_items_is_found(spark):
    """Items that are one template have nothing of their own but their numbers; a new member is a leak of all of them."""
    make = lambda a, b: f"A baker sells {a} loaves before noon and {b} loaves after it so how many loaves does the baker sell on that day in the market"
    items = [make(10 + k, 60 + k) for k in range(25)]
    assert found(spark, [f"{prose(30)}. {make(997, 998)}", prose(50)], items) == {(0, k) for k in range(25)}


def test_joined_rows_follow_hits(spark):
    """Candidates of items that share a phrase are joined by the rare places alone."""
    items = spark.createDataFrame([(k, f"{prose(30)}. {STOCK}") for k in range(200)], "item_id long, text string")
    bench = decontaminate.ranked(decontaminate.bench_windows(items))
    own = bench.where("first").groupBy("hash").count().agg({"count": "max"}).first()[0]
    assert own <= 4 and bench.groupBy("hash").count().agg({"count": "max"}).first()[0] >= 200


PLACES, NAMES = ["Boston", "Dallas", "Oslo", "Lima", "Quito", "Delhi", "Cairo", "Perth"], ["Ann", "Bob", "Carla", "Dmitri", "Eve", "Farid", "Greta", "Hugo"]
#: {a}, {b}: numbers; {n}, {m}: names; {p}, {q}: places; {u}: a unit.
PATTERNS = [
    "A train leaves {p} at {a} {u} per hour and reaches {q} after {b} hours so how far apart are the two towns",
    "{n} has {a} red pens and {m} has {b} blue pens. How many pens do they have together at school?",
    "If a tank holds {a} {u} of water and loses {b} {u} every day, after how many days is the tank empty?",
    "On Monday {n} read {a} pages of the book and on Tuesday {b} pages more than on the day before, so how many in all?",
    "The price of a coat fell by {a} percent in spring and rose by {b} percent in autumn; what is the change over the whole year?",
    "In {p} there live {a} people, of whom {b} work in the harbour. What share of the people of {p} does not work there?",
    "{n} walks {a} {u} north and then {b} {u} east before turning home. How long is the straight way back to the start?",
    "A farmer keeps {a} hens and {b} cows behind the barn. How many legs are there altogether when the farmer counts them?",
    "What remains when the product of {a} and the number of weeks in a year is divided by {b}, leaving no fraction behind?",
    "{n} and {m} share a cake that weighs {a} {u} so that {n} gets {b} {u} more than {m}; how much does each of them get?",
    "The library of {p} lends {a} books each week and gets {b} of them back late. How many come back in time in a month?",
    "A rope of {a} {u} is cut into pieces of {b} {u} each, how many cuts are needed and how much rope is left over?",
    "Between {p} and {q} a bus stops {a} times for {b} minutes each. By how much is the journey longer than without stops?",
    "Every morning {n} puts {a} coins into a jar and every evening takes {b} coins out again; when does the jar hold a hundred?",
    "A recipe for {a} people asks for {b} {u} of flour. How much flour does {n} need to bake the same for a whole class?",
    "The sum of two numbers is {a} and their difference is {b}. Find the larger of the two and show how it was found.",
    "From a bag with {a} white and {b} black stones {n} draws two at once. How likely is it that both are of one colour?",
    "A wall of {a} {u} takes {n} and {m} working side by side {b} hours. How long would {n} alone need for that wall?",
    "During a storm in {p} it rained {a} {u} in the first hour and {b} {u} in the second; what was the mean over both?",
    "{n} borrows {a} dollars at {b} percent a year from the bank in {p}. How much has to be paid back after the third year?",
]


def filled(pattern, rng, low, high):
    n, m = rng.sample(NAMES, 2)
    p, q = rng.sample(PLACES, 2)
    a, b = rng.sample(range(low, high), 2)
    return pattern.format(a=a, b=b, n=n, m=m, p=p, q=q, u=rng.choice(["miles", "km", "pounds", "litres"]))


def test_recall_over_twenty_patterns(spark):
    """Re-parameterised, literal and embedded copies are found; clean prose, and prose with the patterns' frequent words, isn't."""
    rng = random.Random(3)
    items = [filled(p, rng, 2, 90) for p in PATTERNS]
    again = [f"{prose(30, rng)}. {filled(p, rng, 100, 900)} {prose(20, rng)}" for p in PATTERNS for _ in range(5)]
    words = [w for p in PATTERNS for w in p.split() if w[0] not in "{("]
    clean = [f"{prose(40, rng)}. {' '.join(rng.choice(words) for _ in range(80))} {rng.randrange(99)}" for _ in range(300)]
    got = found(spark, again + clean, items)
    hit = sum((5 * k + j, k) in got for k in range(20) for j in range(5))
    assert hit >= 90 and not [d for d, _ in got if d >= 100] and all(d // 5 == i for d, i in got)


def test_one_broadcast_or_none(spark, monkeypatch):
    """A benchmark too large to broadcast is joined by Spark's choice, with the same leaks."""
    docs, items = [PENS.replace("5", "8"), TRAIN, prose(40)], [PENS, TRAIN]
    want = found(spark, docs, items)
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", 0)
    assert found(spark, docs, items) == want == {(0, 0), (1, 1)}
