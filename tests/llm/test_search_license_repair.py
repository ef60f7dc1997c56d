"""Ranked search, license rules and conversation repair against plain loops."""

import hashlib
import heapq
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

from contigra.llm import conversation_repair, licenses, ranking
from contigra.llm.queries import queries

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


# ---------------------------------------------------------------- ranked search


def ranks(docs, items, k=10):
    """(item_id, rank, doc_id, score) from docs (doc_id, text) and items (item_id, text)."""
    own = [(d, Counter(terms(t))) for d, t in docs]
    own = [(d, c, sum(c.values())) for d, c in own if c]
    n, total, df = len(own), sum(x[2] for x in own), Counter(t for _, c, _ in own for t in c)
    out = []
    for item, text in items:
        scored = []
        for d, c, size in own:
            m = 100 - 75 + (75 * size * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms(text) if t in c)
            if s > 0:
                scored.append((-s, d is None, d or 0, d))
        out += [(item, i, d, -s) for i, (s, _, _, d) in enumerate(sorted(scored)[:k], 1)]
    return out


def key(r):
    return tuple((x is None, x if x is not None else 0) for x in r)


def same(df, want):
    assert sorted(map(tuple, df.collect()), key=key) == sorted(want, key=key)


def test_ranks_of_the_query(spark):
    con = duckdb.connect()
    docs = con.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    items = con.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    same(queries()["op11_impact_ranking"](spark, SF), ranks(docs, items))


@pytest.mark.parametrize(("segment", "block"), [(1, 1), (40, 60), (1 << 21, 4 << 20)])
def test_ranks_by_segments_and_blocks(spark, monkeypatch, segment, block):
    """Segments and blocks of any size, skewed words, copies that tie, and ids that are missing."""
    rng = random.Random(segment)
    words = [f"w{int(40 * rng.random() ** 3)}" for _ in range(2000)]
    docs = [(i if i % 17 else None, " ".join(rng.choices(words, k=rng.choice([0, 1, 3, 10, 60])))) for i in range(150)] + [(1000 + i, "w1 w2 w2 w30") for i in range(20)]
    docs += [(7, None), (8, ""), (9, "w5"), (9, "w5")]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([1, 4, 12])))) for i in range(8)] + [(50, None), (51, "absent"), (None, "w2, W2 w30!"), (52, "w5"), (52, "w5")]
    monkeypatch.setattr(ranking, "SEGMENT", segment)
    got = ranking.rank(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string"), block_bytes=block)
    same(got, ranks(docs, items))


def test_a_search_stops_early(monkeypatch):
    """A rare word decides: the postings of the frequent one aren't read to their end."""
    import numpy as np
    import pyarrow as pa

    n = 20_000
    terms_ = [[0, 1] if i % 1000 == 0 else [0] for i in range(n)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(n), pa.int64()), pa.array([10 + i % 50 for i in range(n)], pa.int64()), pa.array(terms_, pa.list_(pa.int32())), pa.array([[1] * len(t) for t in terms_], pa.list_(pa.int32()))], names=["doc_id", "n", "terms", "counts"])
    s = ranking.Segment([batch], np.array([500, 7000]), n, n * 35)
    called = []
    monkeypatch.setattr(ranking.Segment, "complete", lambda self, rows, *a, f=ranking.Segment.complete: called.append(len(rows)) or f(self, rows, *a))
    rows, score = s.search(np.array([0, 1]), np.array([1, 1]), 0, 10, np.zeros(2, np.int64))
    assert called and called[0] < 100 and {int(r) % 1000 for r in rows} == {0}


def test_no_items_or_no_documents(spark):
    docs, items = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert ranking.rank(docs, items.limit(0)).collect() == [] and ranking.rank(docs.limit(0), items).collect() == []
    assert ranking.rank(docs, spark.createDataFrame([(1, None)], "item_id long, text string")).collect() == []


# ---------------------------------------------------------------- licenses


def naive(text):
    """(words, places of the phrases) by comparing words."""
    words = WORD.findall((text or "").translate(LOWER))
    return len(words), [(label, i) for p, label in (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit")) for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]


def pattern_body(rule):
    return rule.pattern.pattern.decode().removeprefix(r"(?<!\S)(?:").removesuffix(r")(?!\S)")


def test_rules_are_gated_by_words_that_they_need():
    assert len(licenses.RULES) > 200 and len({(r.label, r.pattern.pattern) for r in licenses.RULES}) == len(licenses.RULES)
    for r in licenses.RULES:  # a keyword stands in the pattern as a word that is neither optional nor an alternative
        bare = pattern_body(r)
        while (less := re.sub(r"\((?:\?:|\?<=)[^()]*\)\??", " ", bare)) != bare:
            bare = less
        for k in r.keywords:
            word = re.compile(rf"(?<![a-z0-9]){re.escape(k.decode())}(?![a-z0-9?*])")
            assert word.search(bare) or "|" in pattern_body(r) and all(word.search(x) for x in re.findall(r"\(\?:([^()]*)\)(?!\?)", pattern_body(r))[0].split("|")), r


TEXTS = [
    "Licensed under the Apache License, Version 2.0 (the \"License\"); see http://www.apache.org/licenses/LICENSE-2.0",
    "GNU GENERAL\nPUBLIC LICENSE Version 3, or the GNU Lesser General Public License v2.1 and GNU Affero General Public License",
    "SPDX-License-Identifier: GPL-2.0-or-later OR MIT",
    "Licensed under CC BY-NC-SA 4.0. CC BY 4.0; https://creativecommons.org/licenses/by-sa/4.0/ cc by",
    "The MIT License (MIT). Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "mit licenses, xmit license, émit license, mit  license mit_license",
    "a general text about nothing in particular",
    "",
    None,
    "Redistribution and use in source and binary forms, with or without modification, are permitted. All rights reserved. BSD 3-Clause License",
    "gpl2 gpl 2 gpl v2 gplv2 gpl version 2.0 asl2.0 mpl v2.0",
    "apache license " * 300,
]


def test_detections_against_all_pairs():
    for text in TEXTS:
        words, places = naive(text)
        own = licenses.terms((text or "").encode())
        got_places, got = licenses.detect(own)
        assert len(own) == words and sorted(got_places) == sorted(places)
        flat = " ".join(w.decode() for w in own)
        all_ = [licenses.Detection(r.label, r.level, flat[: m.start()].count(" "), flat[: m.end()].count(" ") + 1) for r in licenses.RULES for m in re.finditer(r"(?<!\S)(?:" + pattern_body(r) + r")(?!\S)", flat)]
        want = []
        for i, d in enumerate(all_):
            inside = [x.level > d.level or x.level == d.level and ((x.start, x.stop) != (d.start, d.stop) or j < i) for j, x in enumerate(all_) if j != i and x.start <= d.start and d.stop <= x.stop]
            if not any(inside):
                want.append(d)
        assert sorted(got) == sorted(want)


def test_labels():
    labels = lambda t: {d.label for d in licenses.detect(licenses.terms(t.encode()))[1]}
    assert labels("Released under the MIT License.") >= {"mit"}
    assert "gpl-3.0" in labels("licensed under the GNU General Public License, version 3.") and "gpl" not in labels("GNU General Public License, version 3")
    assert labels("CC BY-NC 4.0") == {"cc-by-nc-4.0"} and labels("GNU Lesser General Public License v2.1") == {"lgpl-2.1"}
    assert labels("the mother spoke of the world and the children played") == set() and licenses.score([]) == 0


def test_license_query(spark):
    docs = {d: t for d, t in duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()}
    rows = queries()["op12_license_rules"](spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        words, places = naive(docs[r["doc_id"]])
        at = [i for _, i in places]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (words, len(at), min(at, default=None), max(at, default=None))
        assert r["base_labels"] == ",".join(sorted({x for x, _ in places})) and {x for x, _ in places} <= set(r["labels"].split(",")) | {""}
        assert 0 <= r["score"] <= 1 and bool(r["labels"]) == (r["score"] > 0)
    found = licenses.detections(spark.createDataFrame([(1, "x GNU GPL v3 y"), (None, None)], "doc_id long, text string")).collect()
    assert [tuple(x) for x in found] == [(1, "gpl-3.0", 4, 1, 4, "gnu gpl v3")]


# ---------------------------------------------------------------- conversations


def cheapest(rows):
    """(cost, audit, lines) of rows (role, text, fault): uniform-cost search over all edits."""
    heap, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, i, state, out = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and state in ("", "a"):
            return cost, audit, list(out)
        grow = lambda c, letter, j, s, line: heapq.heappush(heap, (cost + c, audit + letter, j, s, out + ((line,) if line is not None else ())))  # noqa: E731, B023
        follows = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
        for s, role in (("u", "user"), ("a", "assistant")):
            if s in follows:
                grow(5, "I", i, s, f"{role}:")
        if i < len(rows):
            role, text, fault = rows[i]
            grow(2, "D", i + 1, state, None)
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                if role[:1] and role[:1] in follows:
                    grow(more, "K", i + 1, role[:1], f"{role}:{text}")
                for s, name in (("u", "user"), ("a", "assistant")):
                    if s in follows:
                        grow(more + 1, "R", i + 1, s, f"{name}:{text}")


def repaired(table):
    """What the query gives, from rows (conv_id, turn, role, text)."""
    by, order = defaultdict(list), lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    for conv, turn, role, text in table:
        own = by[conv]
        role, text = role if role is not None else " ", text if text is not None else " "
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            own += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = []
    for conv, rows in by.items():
        rows.sort(key=order)
        seen, marked = set(), []
        for _, role, text in rows:
            full = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "blank" if not full else "duplicate" if (role, text) in seen else "truncated" if full[-1] not in ".!?" else ""
            seen.add((role, text))
            marked.append((role, text, fault))
        turns = [t for t, _, _ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        count = Counter(f for _, _, f in marked)
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
        cost, audit, lines = cheapest(marked)
        out.append((conv, gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_repair_query(spark, sf):
    table = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '/root/testdata/sf{sf}/conversations.parquet'").fetchall()
    same(queries()["op13_conversation_repair"](spark, f"/root/testdata/sf{sf}"), repaired(table))


CONVERSATIONS = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("chunk", [1, 3, 512])
def test_repair_of_awkward_conversations(spark, monkeypatch, chunk):
    rng = random.Random(chunk)
    roles, texts = ["user", "assistant", "system", "system", None, "", "User", "unknown", "été"], ["Yes.", "No!", "and", "", " \t", None, "é?", "x ", "Yes.", "line\nline."]
    table = [(c if c else None, rng.choice([None, *range(12)]), rng.choice(roles[: rng.choice([2, 9])]), rng.choice(texts)) for c in range(40) for _ in range(rng.choice([1, 2, 7, 12]))]
    table += [(100, i, "user" if i % 2 else "assistant", f"{i}.") for i in range(1300)] + [(101, 4, "user", "a.")] * 5
    monkeypatch.setattr(conversation_repair, "CHUNK", chunk)
    same(conversation_repair.repair(spark.createDataFrame(table, CONVERSATIONS).repartition(5)), repaired(table))


def test_repair_with_other_columns_and_without_rows(spark):
    names = ["c_", "n", "k_", "kind_", "copy_", "p_", "line", "plan", "letter", "fault", "audit", "head_", "seen_"]
    from pyspark.sql import functions as F

    table = [(1, 0, "user", "Hi."), (1, 1, "assistant", "Ho."), (2, 0, "user", "Hm.")]
    wide = spark.createDataFrame(table, CONVERSATIONS).select("*", *[F.lit(1).alias(x) for x in names])
    same(conversation_repair.repair(wide), repaired(table))
    assert conversation_repair.repair(wide.limit(0)).collect() == []
