"""Cases in which results were once wrong, and the ways for very common passages and many languages."""

import random

import numpy as np
import pytest
from test_operators import brute_repeats

from fleetlens.llm import decontaminate, induced_sort, language_id, license_scan, line_quality, quality_classifier, suffix_dedup

RNG = random.Random(11)


def prose(n):
    return " ".join(f"w{RNG.randrange(3000)}" for _ in range(n))


@pytest.mark.parametrize("hot", [3, 20_000])
def test_a_passage_in_many_contexts(spark, hot):
    passage = prose(24)
    rows = [(i, f"{prose(20)} {passage} {prose(20)}") for i in range(25)] + [(100, "ab" * 3000), (101, "ab" * 40 + prose(30)), (102, prose(30) + "é" * 120 + "x"), (103, "é" * 130)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = brute_repeats(rows)
    spans = {r.doc_id: r.spans for r in suffix_dedup.repeats(df, hot=hot, shard_bytes=4000, budget=2000, small=64).collect()}
    for doc, text in rows:
        own = np.array([(s.a, s.b) for s in spans.get(doc, [])], np.int64).reshape(-1, 2)
        gone = suffix_dedup.merged(own[:, 0], own[:, 1], len(text.encode()))
        assert (sum(b - a for a, b in gone), len(gone)) == want[doc][1:3], doc


def test_a_periodic_text_is_few_rows(spark):
    df = spark.createDataFrame([(1, "a" * 20_000)], "doc_id long, text string")
    sent = df.mapInArrow(lambda it: suffix_dedup._anchors(it, 100, 24), suffix_dedup._ANCHOR_SCHEMA).collect()
    assert len(sent) < 400 and suffix_dedup.digest(df).first().n_removed == 19_999


ITEM = "A train leaves Boston at 60 miles per hour and reaches the far station after 5 hours so how long is the whole way"


def test_clean_rows_with_null_ids_stay(spark):
    bench = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    rows = [(None, prose(30) + ". " + ITEM), (None, prose(40)), (7, prose(40)), (7, ITEM)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.text for r in decontaminate.keep_clean(df, bench).collect()} == {rows[1][1], rows[2][1]}


def test_recall_of_new_parameters(spark):
    rng = random.Random(4)
    names, places = ["Boston", "Dallas", "Oslo", "Lima", "Quito"], ["station", "harbour", "market", "tower"]
    make = lambda k, a, b, n: f"On day {a} the {places[k % 4]} keeper number {k} of {n} counts crates marked {chr(97 + k % 26)}{chr(97 + k // 26)} and then sells {b} of them to {n} before the evening bell so how many are left there"
    items = [(k, make(k, rng.randrange(90), rng.randrange(90), rng.choice(names))) for k in range(60)]
    docs = [(k, f"{prose(40)}. {make(k, rng.randrange(100, 999), rng.randrange(100, 999), rng.choice(names))}. {prose(20)}") for k in range(60)] + [(1000 + k, prose(90)) for k in range(60)]
    found = {(r.doc_id, r.item_id) for r in decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert len({d for d, i in found if d == i}) >= 54 and not {d for d, _ in found if d >= 1000}


def test_lines_count_documents_and_a_share_of_the_host(spark):
    text = f"{prose(10)}\nall of one footer here\n{prose(15)}"
    rows = [(i, text, "copies") for i in range(30)] + [(100 + i, f"{prose(30)}\n{'Introduction' if i < 8 else prose(3)}", "large") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    got = {r.doc_id: r for r in line_quality.line_quality(df).collect()}
    assert not any(got[i].kept for i in range(30)) and all(got[100 + i].kept and not got[100 + i].removed_chars for i in range(400))


def test_letters_and_many_languages(spark):
    rows = [(i, f"xx{a}{b} q{a}{b}z " * 20, f"l{a}{b}") for i, (a, b) in enumerate((a, b) for a in "abcdefghij" for b in "abcdefghij" for _ in range(4))]
    model = language_id.build([(lang, text) for _, text, lang in rows])
    assert len(model.languages) == 100
    df = spark.createDataFrame(rows[::4] + [(900, "½ ²", None), (901, "① ②", None), (902, "١٢٣", None)], "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in language_id.identify(df, model).collect()}
    assert all(got[i] == lang for i, _, lang in rows[::4]) and got[900] == got[901] == got[902] == "und"


def test_word_numbers_of_many_places():
    line = license_scan.joined("mit license and " * 3000)
    base, _ = license_scan.scan(line)
    assert [w for _, w in base] == list(range(0, 9000, 3))


def test_word_vectors_see_all_documents(spark):
    df = spark.createDataFrame([("alpha beta gamma",), (None,), ("delta alpha beta",)], "text string").repartition(2)
    ids = quality_classifier.tokens(*(lambda b: (b, np.array([0, len(b)])))(np.frombuffer(b"alpha beta gamma delta", np.uint8)))[0]
    index, got = quality_classifier.index_vectors().astype(np.float64), quality_classifier.word_vectors(df)
    a, b, c, d = ids
    want = index[a] + index[b] + index[c] + index[d] + index[b]
    assert np.allclose(got[a], want / np.linalg.norm(want), atol=1e-6)


def test_a_range_of_an_induced_sort_is_worked_through_at_once(monkeypatch):
    """Over many names, a scan takes a chunk or so for each of its ranges, in the order that piecewise work gives."""
    rng = np.random.default_rng(1)
    words = [rng.integers(1, 5000, 8) for _ in range(300)]
    text = np.concatenate([*(words[k] for k in rng.integers(0, 300, 5000)), np.arange(900, 700, -2), np.full(40, 7), np.zeros(1, np.int64)])

    def chunks():
        level = induced_sort.Level(text, 1 << 21, 1 << 10)
        return [(smaller, pos.tolist()) for smaller, pos in level.both_scans(level.sorted_lms())]

    got = chunks()
    assert len(got) <= 3 * induced_sort.RANGES
    monkeypatch.setattr(induced_sort, "within", lambda *a: None)
    pieces = chunks()
    assert len(pieces) > 3 * induced_sort.RANGES
    for kind in (False, True):
        assert [p for smaller, pos in got if smaller == kind for p in pos] == [p for smaller, pos in pieces if smaller == kind for p in pos]
