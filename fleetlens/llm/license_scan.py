"""Licence scan: exact phrases, and fuzzy search for short notices.

A notice that may differ by k edits is split into k+1 pieces, one of which must then stand unchanged in the text
(the pigeonhole principle). Pieces are looked up exactly; around each place where one is found the regex library matches
the whole notice with at most k edits, and the span it reports is turned into word positions. Texts are read as runs of
letters and digits joined by one space, so line breaks, comment signs and punctuation never hide a notice.
"""

import functools
from collections import Counter

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Phrases of the base scan and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Short notices of common licences, their labels, and the edits allowed in each.
NOTICES = [
    ("released under the mit license", "mit", 3),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit", 8),
    ("licensed under the apache license version 2 0", "apache", 4),
    ("you may not use this file except in compliance with the license", "apache", 6),
    ("licensed under the gnu general public license version", "gpl", 5),
    ("you can redistribute it and or modify it under the terms of the gnu general public license", "gpl", 8),
    ("under the terms of the gnu lesser general public license", "lgpl", 4),
    ("gnu affero general public license", "agpl", 3),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd", 8),
    ("neither the name of the copyright holder nor the names of its contributors may be used", "bsd", 8),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc", 8),
    ("this source code form is subject to the terms of the mozilla public license", "mpl", 7),
    ("this program and the accompanying materials are made available under the terms of the eclipse public license", "epl", 8),
    ("licensed under a creative commons attribution", "cc", 4),
    ("this is free and unencumbered software released into the public domain", "unlicense", 6),
    ("distributed under the boost software license", "bsl", 4),
    ("spdx license identifier", "spdx", 2),
    ("all rights reserved", "all-rights-reserved", 1),
    ("creative commons attribution", "cc", 2),
    ("licensed under cc by", "cc", 2),
    *[(f"cc by {x}", "cc", 0) for x in ("nc", "nd", "sa", "1 0", "2 0", "2 5", "3 0", "4 0", "license")],
]
#: What tells a licence from others in a notice; one edit, or two from six letters on, is allowed in it.
NAMES = ["mit", "apache", "gnu general", "gnu lesser general", "gnu affero general", "mozilla", "eclipse", "creative commons", "cc by", "boost", "spdx"]
_KEEP = np.array([48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in range(256)])
_LOWER = [b + 32 if 65 <= b <= 90 else b for b in range(256)]
#: Bytes to lower case, with a space for whatever is not in a word.
TABLE = bytes(b if _KEEP[b] else 32 for b in _LOWER)


def pieces(notice: str, edits: int) -> list[tuple[int, bytes]]:
    """edits+1 consecutive parts of about equal length, with their offsets."""
    raw = notice.encode()
    cuts = [len(raw) * k // (edits + 1) for k in range(edits + 2)]
    return [(a, raw[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


@functools.cache
def patterns() -> list:
    out = []
    for notice, label, edits in NOTICES:
        body = b"(?:" + regex.escape(notice.encode(), special_only=True) + b"){e<=%d}" % edits
        out.append((label, len(notice), edits, pieces(notice, edits), regex.compile(b"(?e)" + body if edits else b"(?<![^ ])" + body + b"(?![^ ])")))
    return out


@functools.cache
def names() -> list:
    """Of each notice, a pattern of the licence's name in it; None if it has none."""
    found = [next((x for x in NAMES if f" {x} " in f" {notice} "), None) for notice, _, _ in NOTICES]
    return [x and regex.compile(b"(?:%s){e<=%d}" % (x.encode(), 1 if len(x) < 6 else 2)) for x in found]


def joined(text: str) -> bytes:
    """The words, lower-cased, with one space between and around them."""
    words = text.encode().translate(TABLE).split()
    return b" " + b" ".join(words) + b" " if words else b" "


@functools.cache
def seeds() -> dict[bytes, list[tuple[int, int]]]:
    """Piece -> (notice, offset in it)."""
    out: dict[bytes, list[tuple[int, int]]] = {}
    for k, (_, _, _, parts, _) in enumerate(patterns()):
        for offset, piece in parts:
            out.setdefault(piece, []).append((k, offset))
    return out


@functools.cache
def automaton():
    """All pieces in one pass; bytes are read as Latin-1 letters, so positions are byte positions."""
    out = ahocorasick.Automaton()
    for piece in seeds():
        out.add_word(piece.decode("latin-1"), piece)
    out.make_automaton()
    return out


def windows(line: bytes) -> list[tuple[int, int, int]]:
    """(notice, from, to) where a notice can stand, those of one notice merged where they overlap."""
    found: dict[int, list[tuple[int, int]]] = {}
    for end, piece in automaton().iter(line.decode("latin-1")):
        at = end + 1 - len(piece)
        for k, offset in seeds()[piece]:
            _, length, edits, _, _ = patterns()[k]
            found.setdefault(k, []).append((max(0, at - offset - edits - 1), min(len(line), at - offset + length + edits + 1)))
    out = []
    for k, spans in found.items():
        spans.sort()
        now = list(spans[0])
        for a, b in spans[1:]:
            if a <= now[1]:
                now[1] = max(now[1], b)
            else:
                out.append((k, *now))
                now = [a, b]
        out.append((k, *now))
    return [(k, a, b) for k, a, b in out if can_hold(k, line[a:b])]


def pairs(raw: bytes) -> Counter:
    return Counter(zip(raw, raw[1:], strict=False))


@functools.cache
def notice_pairs() -> list[Counter]:
    return [pairs(notice.encode()) for notice, _, _ in NOTICES]


def can_hold(k: int, window: bytes) -> bool:
    """Whether a window has enough of a notice's letter pairs: an edit spoils two at most, so too few rule a match out."""
    own = notice_pairs()[k]
    return (own & pairs(window)).total() >= own.total() - 2 * NOTICES[k][2]


def scan(line: bytes) -> tuple[list[tuple[str, int]], list[tuple[str, int, int, int]]]:
    """Base places (label, first word) and fuzzy ones (label, first word, last word, edits)."""
    base, fuzzy, spaces = [], [], np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    words_before = lambda at: int(np.searchsorted(spaces, at))
    for phrase, label in PHRASES.items():
        needle = f" {phrase} ".encode()
        at = line.find(needle)
        while at >= 0:
            base.append((label, words_before(at)))
            at = line.find(needle, at + 1)
    for k, a, b in windows(line):
        label, _, _, _, pattern = patterns()[k]
        for m in pattern.finditer(line, a, b):
            if names()[k] and not names()[k].search(line, m.start(), m.end()):
                continue  # the edits went into another licence's name
            first = words_before(m.start() + 1) - 1 + (line[m.start() : m.start() + 1] == b" ")
            last = words_before(m.end()) - 1 - (line[m.end() - 1 : m.end()] == b" ")
            fuzzy.append((label, max(0, first), max(0, last), sum(m.fuzzy_counts)))
    return base, fuzzy


_SCHEMA = "doc_id long, n_words long, base array<struct<label:string,word:long>>, notices array<struct<label:string,first:long,last:long,edits:int>>"


def _scan(batches):
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64())])), pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("edits", pa.int32())]))]
    for batch in batches:
        words, base, notices = [], [], []
        for t in batch.column(1):
            line = joined(t.as_py() or "")
            b, f = scan(line)
            words.append(line.count(b" ") - 1)
            base.append([{"label": x, "word": w} for x, w in b])
            notices.append([{"label": x, "first": p, "last": q, "edits": e} for x, p, q, e in f])
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(v, k) for v, k in zip((words, base, notices), kinds[1:], strict=True))], ["doc_id", "n_words", "base", "notices"])


def scan_licenses(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, base (each place of a phrase) and notices (each fuzzy match with its words and edits).

    A null or empty text has no words and no places; texts of any length are read whole; repeated rows give equal rows;
    a null doc_id stays; phrases may overlap and each place counts; an empty table gives no rows; other columns are not
    read. Nothing is shuffled.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_scan, _SCHEMA)


def op8_license_scan(spark, sf_dir: str) -> DataFrame:
    out = scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    comma = lambda c: F.array_join(F.sort_array(F.array_distinct(c)), ",")
    sure = F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max(F.transform("notices", lambda x: 1.0 - x.edits / 20.0)), F.lit(0.0)))
    return out.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min("base.word").alias("first_word"), F.array_max("base.word").alias("last_word"),
        comma(F.col("base.label")).alias("base_labels"), comma(F.concat("base.label", "notices.label")).alias("labels"), sure.alias("score"), "notices",
    )
