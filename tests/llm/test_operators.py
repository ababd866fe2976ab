"""The corpus operators against brute force and on edge cases."""

import functools
import hashlib
import random
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from fleetlens.llm import decontaminate, html_text, language_id, license_scan, line_quality, packing, quality_classifier, sharding, simhash, suffix_dedup
from fleetlens.llm.common import components
from fleetlens.llm.induced_sort import Induction

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, shard string, spans string, content string, hash string, host string"
RNG = random.Random(5)
WORDS = ["alpha", "beta", "gamma", "delta", "épsilon", "zeta", "eta", "theta", "iota", "kappa", "lambda", "mu", "Nu", "xi", "omicron", "pi"]


def prose(n, rng=RNG):
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 9)) * (rng.random() < 0.5) for _ in range(n))


@functools.cache
def edge_rows():
    shared = prose(60)
    rows = [
        (1, None, None, None), (2, "", "en", "a"), (3, "x", "en", None), (4, "  \n\t ", "de", "a"), (5, shared, "en", "a"), (5, shared, "en", "a"), (6, shared, "en", "b"), (None, prose(40), "en", "a"),
        (7, prose(30) + " " + shared, "de", "a"), (8, shared[:150] + " " + prose(20), "de", "a"), (9, prose(30000), "en", "a"), (10, "\n".join([prose(8)] * 20), "en", "a"), (11, "ß" * 300, "de", "b"), (12, "1 2 3 !!! ???", "en", "a"), (13, "one two", None, "a"), (14, "a" * 500, "en", "a"),
    ]
    return [(i, t, lang, s, None if t is None else len(t), "s", "sh", "sp", "c", "h", "ho") for i, t, lang, s in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# ---------------------------------------------------------------- packing


def test_packing_round_trip(docs, empty):
    from tokenizers import Tokenizer
    import public_tokenizers

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = packing.pack(docs.where("doc_id is not null")).toPandas()
    assert got.sequence_id.is_unique and (got.offset == 0).all()
    assert all(n & (n - 1) == 0 and n <= 1024 for n in got.length)
    for doc, text in {r[0]: r[1] for r in edge_rows() if r[0] is not None}.items():
        part = got[got.doc_id == doc].drop_duplicates("start").sort_values("start")
        ids = np.concatenate([np.frombuffer(b, "<u4") for b in part.ids])
        assert ids.tolist() == [*t.encode(text or "", add_special_tokens=False).ids, 0]
        assert (part.doc_tokens == len(ids)).all()
    assert packing.pack(empty).count() == 0
    assert packing.lengths(2051) == [1024, 1024, 2, 1]


def test_quick_encoder_equals_the_library():
    from tokenizers import Tokenizer
    import public_tokenizers

    t, quick = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), packing.encoder("byte_bpe_50k")
    for text in ["Hello  world's\n\n x", "déjà vu — naïve", "日本語 text", "<|endoftext|> a", "  \t\r\n", "a" * 3000, "'s'S 12345 ½"]:
        assert quick(text).tolist() == t.encode(text, add_special_tokens=False).ids


# ---------------------------------------------------------------- line quality


def brute_quality(text):
    import re

    words = [w for w in re.split("[ \t-\r]+", text or "") if w]
    wins = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen = {}
    for w in wins:
        seen[w] = seen.get(w, 0) + 1
    cover = {i + k for i, w in enumerate(wins) if seen[w] > 1 for k in range(8)}
    lines = [x for x in (text or "").split("\n") if re.search("[^ \t-\r]", x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(cover)


def test_line_quality(docs, empty, spark):
    got = {r.doc_id: r for r in line_quality.line_quality(docs).collect()}
    for row in edge_rows():
        if row[0] is not None:
            r = got[row[0]]
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_quality(row[1])
            assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
    assert line_quality.line_quality(docs).count() == len(edge_rows())
    assert line_quality.line_quality(empty).count() == 0
    template = prose(30)
    many = spark.createDataFrame([(i, f"{template}\n{prose(3)}" if i < 40 else prose(40), "h") for i in range(60)], "doc_id long, text string, source string")
    judged = {r.doc_id: r for r in line_quality.line_quality(many).collect()}
    assert not any(judged[i].kept for i in range(40)) and all(judged[i].kept for i in range(40, 60))
    stripped = {r.doc_id: r.text for r in line_quality.strip_lines(many).collect()}
    assert template not in stripped[3] and stripped[50] == {r.doc_id: r.text for r in many.collect()}[50]


# ---------------------------------------------------------------- decontamination


def test_leaks(spark, docs, empty):
    item = "A train leaves Boston at 60 miles per hour and reaches the far station after 5 hours so how long is the whole way from Boston"
    other = "Water boils when the pot over the small fire has been heated for long enough and no lid keeps the vapour in it"
    bench = spark.createDataFrame([(1, item), (2, other), (3, None), (4, ""), (None, "only five words stand here")], "item_id long, text string")
    twisted = item.replace("60", "45").replace("5 hours", "7 hours").replace("Boston", "Dallas")
    broken = item.replace("from Boston", "from Paris").replace("60", "45")
    rows = [(1, "before it. " + item + " after it."), (2, prose(20) + ". " + twisted), (3, prose(200)), (4, other.upper()), (5, None), (6, ""), (7, item.replace("train", "bus").replace("far", "near")), (8, "x. " + broken)]
    found = {(r.doc_id, r.item_id): r for r in decontaminate.leaks(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()}
    assert {(1, 1), (2, 1), (4, 2)} <= set(found) and not {3, 5, 6} & {d for d, _ in found}
    assert found[2, 1].n_slots and found[2, 1].slots_consistent
    assert (8, 1) not in found or not found[8, 1].slots_consistent or found[8, 1].n_windows < found[1, 1].n_windows
    passes = {(r.doc_id, r.item_id) for r in decontaminate.leaks(spark.createDataFrame(rows, "doc_id long, text string"), bench, held=5).collect()}
    assert passes == set(found)
    assert decontaminate.leaks(docs, bench).count() == 0 and decontaminate.leaks(empty, bench).count() == 0
    assert decontaminate.leaks(docs, bench.where("false")).count() == 0
    assert decontaminate.keep_clean(docs, bench).columns == docs.columns


# ---------------------------------------------------------------- language


def test_language(spark, docs, empty):
    rng = random.Random(2)
    syllables = {"en": ["th", "ing", "er", "wh"], "de": ["sch", "ung", "keit", "ä"], "fr": ["eau", "tion", "é", "que"]}
    make = lambda lang: " ".join("".join(rng.choice(syllables[lang]) for _ in range(rng.randint(1, 4))) for _ in range(60))
    rows = [(i, make(lang), lang) for i in range(300) for lang in [list(syllables)[i % 3]]]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = {r.doc_id: r for r in language_id.identify(df, language_id.train(df)).collect()}
    held = [i for i in range(300) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert held and all(out[i].lang_pred == rows[i][2] for i in held)
    edge = language_id.identify(docs, language_id.train(df)).collect()
    assert len(edge) == len(edge_rows()) and all(0 <= r.score <= 1 for r in edge)
    assert all(r.lang_pred == "und" and r.score == 0 for r in edge if r.doc_id in (1, 2, 4, 12))
    assert language_id.identify(empty, language_id.train(df)).count() == 0
    assert {r.lang_pred for r in language_id.identify(docs, language_id.train(empty)).collect()} == {"und"}
    kept = language_id.keep_known(df.union(spark.createDataFrame([(900, "!!! 123", "en")], df.schema)).withColumn("score", F.lit("x")))
    assert kept.columns == ["doc_id", "text", "lang", "score"] and {r.doc_id for r in kept.collect()} == set(range(300))


def test_bit_sliced_filter_has_no_false_negatives():
    model = language_id.build([("a", "abcd efgh"), ("a", "abcd efgh"), ("b", "wxyz"), ("b", "wxyz")], slots=1 << 10)
    raw = np.frombuffer(language_id.letters("abcd").encode(), np.uint8)
    assert (model.masks(language_id.grams(raw, np.array([0, len(raw)]))[0]) & 1).all()


# ---------------------------------------------------------------- suffix arrays


@pytest.mark.parametrize("seed", range(40))
def test_induced_sorting(seed):
    rng = random.Random(seed)
    k, n = rng.choice([1, 2, 3, 20]), rng.randint(0, 120)
    t = [rng.randint(1, k) for _ in range(n)]
    t = t + t[2 : n // 2] + t[: n // 3] if seed % 2 else t
    text, cap = np.array([*t, 0], np.uint16), rng.choice([5, 100])
    buckets = list(Induction(text, cap, budget=rng.choice([64, 1 << 20]), small=rng.choice([2, 1 << 20])).buckets())[::-1]
    raw = text.tolist()
    want = sorted(range(len(raw)), key=lambda i: raw[i:])
    assert np.concatenate([p for p, _ in buckets]).tolist() == want

    def common(a, b):
        m = 0
        while max(a, b) + m < len(raw) and raw[a + m] == raw[b + m]:
            m += 1
        return min(m, cap)

    assert np.concatenate([x for _, x in buckets]).tolist() == [0, *(common(a, b) for a, b in zip(want, want[1:], strict=False))]


def brute_repeats(rows, length=100):
    seen, out = set(), {}
    for doc, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        raw = (text or "").encode()
        cover, fresh = bytearray(len(raw)), []
        for s in range(len(raw) - length + 1):
            w = raw[s : s + length]
            if w in seen:
                cover[s : s + length] = b"\1" * length
            elif doc not in out:
                seen.add(w)
        runs = sum(1 for k, c in enumerate(cover) if c and (k == 0 or not cover[k - 1]))
        if doc not in out:
            out[doc] = (len(raw), sum(cover), runs, hashlib.sha256(bytes(b for b, c in zip(raw, cover, strict=True) if not c)).hexdigest())
    return out


def test_suffix_dedup(docs, empty, spark):
    got = suffix_dedup.digest(docs).collect()
    want = brute_repeats([(r[0], r[1]) for r in edge_rows()])
    assert len(got) == len(edge_rows())
    for r in got:
        if r.doc_id is not None:
            assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id], r.doc_id
    assert suffix_dedup.digest(empty).count() == 0
    short = suffix_dedup.remove_repeats(docs)
    assert short.columns == docs.columns and short.count() == len(edge_rows())
    assert {r.doc_id: r.text for r in short.collect()}[6] == ""


def test_suffix_dedup_by_tiny_shards_and_queues(docs):
    rows = [(i, prose(30) + " " + edge_rows()[4][1]) for i in range(12)]
    df = docs.sparkSession.createDataFrame(rows, "doc_id long, text string")
    spans = {r.doc_id: r.spans for r in suffix_dedup.repeats(df, shard_bytes=2000, budget=500, small=8).collect()}
    want = brute_repeats(rows)
    for doc, text in rows:
        own = np.array([(s.a, s.b) for s in spans.get(doc, [])], np.int64).reshape(-1, 2)
        gone = suffix_dedup.merged(own[:, 0], own[:, 1], len(text.encode()))
        assert (sum(b - a for a, b in gone), len(gone)) == want[doc][1:3]


# ---------------------------------------------------------------- quality classifier


def test_quality_classifier(spark, docs, empty):
    rng = random.Random(9)
    good = lambda: ". ".join(prose(8, rng) for _ in range(8))
    bad = lambda: " ".join(rng.choice(WORDS) + rng.choice(["###", "%%%", "$$$"]) for _ in range(60))
    rows = [(i, good() if i % 3 else bad(), int(i % 3 > 0)) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    model = quality_classifier.train(df.drop("quality"), df.drop("text"))
    out = {r.doc_id: r.score for r in quality_classifier.score(df, model).collect()}
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert np.mean([(out[i] >= 0.7) == bool(rows[i][2]) for i in held]) > 0.95
    edge = quality_classifier.score(docs, model).collect()
    assert len(edge) == len(edge_rows()) and all(0 <= r.score <= 1 for r in edge)
    assert quality_classifier.score(empty, model).count() == 0
    assert quality_classifier.train(docs, spark.createDataFrame([], "doc_id long, quality int")) is None
    assert {r.score for r in quality_classifier.score(docs, None).collect()} == {0.5}


# ---------------------------------------------------------------- pages

PAGE = """<html><head><title>t</title><script>var a="<p>no</p>";</script></head><body><nav><ul><li><a href=/>Home</a></ul></nav>
<div class="ad">Buy</div><div id=post-{n} class="content c{n}"><h1>Head &amp; tail</h1><p>First <b>bold&nbsp;text</b>
 here.<p>Second &#233; &lt;tag&gt;<br>line</p><ul><li>one<li>two</ul><form><input>Mail</form></div><div class=comments><p>Nice post, thanks a lot to you all</p></div><footer>&copy; me</footer></body></html>"""


def test_html(spark):
    pages = [(n, f"http://h{n % 2}.example/{n}", PAGE.format(n=n), "x") for n in range(6)] + [(7, None, None, "x"), (8, "not a url", "", "x"), (9, "http://z.example", "<p>open <b>and never closed", "x"), (None, "http://z.example", "no markup at all", "x"), (7, None, None, "x")]
    got = html_text.extract(spark.createDataFrame(pages, "page_id long, url string, html string, path string")).collect()
    assert len(got) == len(pages)
    texts = {r.page_id: r.text for r in got}
    for n in range(6):
        assert texts[n] == "Head & tail\nFirst bold text here.\nSecond é <tag> line\none\ntwo"
    assert texts[7] == "" and texts[8] == "" and texts[9] == "open and never closed" and texts[None] == "no markup at all"
    assert html_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


# ---------------------------------------------------------------- licences


def test_licences(spark, docs, empty):
    base, fuzzy = license_scan.scan(license_scan.joined("x Released under the\n * MIT License. And the GNU General Public-License, mit license"))
    assert base == [("mit", 4), ("mit", 12), ("gpl", 9)] and ("mit", 1, 5, 0) in fuzzy
    _, fuzzy = license_scan.scan(license_scan.joined("Licenced under the Apache Licence, Version 2.0"))
    assert ("apache", 0, 7) in {f[:3] for f in fuzzy}
    got = license_scan.scan_licenses(docs).collect()
    assert len(got) == len(edge_rows()) and all(not r.base for r in got)
    assert license_scan.scan_licenses(empty).count() == 0


@pytest.mark.parametrize("seed", range(30))
def test_licence_windows_lose_no_match(seed):
    rng = random.Random(seed)
    notice, label, edits = rng.choice(license_scan.NOTICES)
    raw = list(notice)
    for _ in range(rng.randint(0, edits)):
        k = rng.randrange(len(raw))
        raw[k : k + 1] = rng.choice([[], ["q"], [raw[k], "q"]])
    line = license_scan.joined("some words before " + "".join(raw) + " some words after")
    _, found = license_scan.scan(line)
    assert label in {f[0] for f in found}


# ---------------------------------------------------------------- SimHash


def test_masks_cover_every_three_bits():
    masks = simhash.covering_masks()
    assert len(masks) == 15 and all(m.bit_count() == 32 for m in masks)
    rng = random.Random(1)
    assert all(any(not m & sum(1 << b for b in bits) for m in masks) for bits in (rng.sample(range(64), 3) for _ in range(5000)))


def brute_components(values, radius=3):
    parent = list(range(len(values)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= radius:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(values))]


@pytest.mark.parametrize("bucket", [4096, 3])
def test_links_connect_all_near_values(spark, bucket):
    rng = random.Random(4)
    values = [rng.getrandbits(64) for _ in range(40)]
    for v in values[:8]:
        values += [v ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 6))) for _ in range(6)]
    values = sorted({simhash.signed(v) for v in values})
    edges = simhash.links(spark.createDataFrame([(v,) for v in values], "fp long"), bucket=bucket)
    mask = (1 << 64) - 1
    assert all(((r.a & mask) ^ (r.b & mask)).bit_count() <= 3 for r in edges.collect())
    roots = {r.node: r.root for r in components(edges).collect()}
    want = brute_components([v & mask for v in values])
    assert [roots.get(v, v) for v in values] == [min(v for v, w in zip(values, want, strict=True) if w == x) for x in want]


def test_simhash(docs, empty):
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(edge_rows())
    by = {r.doc_id: r for r in got}
    assert by[1].fp == by[2].fp == by[4].fp == 0 and by[4].component_id == 1 and by[6].component_id == 5
    assert by[13].fp & ((1 << 64) - 1) == xxhash.xxh64_intdigest(b"one two", 42)
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in (b"a b c", b"b c d")]
    assert simhash.fingerprint(b"A b\tC d") == hashes[0] & hashes[1]
    assert simhash.near_duplicates(empty).count() == 0
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns and {1, 5} <= {r.doc_id for r in kept.collect()} and 6 not in {r.doc_id for r in kept.collect()}


# ---------------------------------------------------------------- sharding


def test_sharding(spark, docs, empty):
    rows = [(i, f"copy {i % 7}" if i < 140 else f"text {i}") for i in range(600)] + [(1000 + i, "hot") for i in range(300)] + [(None, None), (5000, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sharding.shard(df).toPandas()
    sizes = got.groupby("shard").size()
    assert len(got) == len(rows) and len(sizes) == 24 and sizes.max() - sizes.min() <= 1
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in got.groupby("shard"))
    copies = got[got.doc_id < 140].groupby("text_crc32").shard.nunique()
    start = 20 * (1 - (23 / 24) ** 20)
    assert copies.mean() < start / 3
    assert got[(got.doc_id >= 1000) & (got.doc_id < 1300)].shard.nunique() <= 14  # 8 would hold them if nothing else were linked
    assert sharding.shard(docs).count() == len(edge_rows()) and sharding.shard(empty).count() == 0
