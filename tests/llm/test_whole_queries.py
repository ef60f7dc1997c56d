"""Whole queries of op1 and op9 against plain loops, and the values that each operator gives for awkward rows."""

import hashlib
import re
import zlib
from collections import Counter

import pytest
from test_llm_operators import brute_components, brute_tiles

from contigra.llm import edit_counts, lattice, licenses, packing, queries, secret_scan, setsketch, sharding, telephony, tiling

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def words_one(text):
    """Lower-cased words without ASCII punctuation."""
    kept = "".join(c for c in text if c.isalnum() or not 32 < ord(c) < 127)
    return "".join(c.lower() if c.isascii() else c for c in kept).encode().split()


def runs(w, k):
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def test_contamination_of_all_documents(spark):
    """Every document against every item; only pairs without a common run of the seed's length are told apart beforehand."""
    docs = [(r["doc_id"], words_one(r["text"] or "")) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    items = [(r["item_id"], words_one(r["text"] or "")) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    want = []
    for i, d in docs:
        own: dict = {}
        for j, x in items:
            k = min(tiling.SEED, len(x))
            if k and runs(x, k) & own.setdefault(k, runs(d, k)):
                tiles = brute_tiles(d, x, k)
                covered = sum(t[2] for t in tiles)
                if covered >= tiling.COVERAGE * len(x):
                    want.append((i, j, round(covered / len(x), 9), len(tiles), max(t[2] for t in tiles), len(x)))
    got = [(r["doc_id"], r["item_id"], round(r["coverage"], 9), r["tiles"], r["longest"], r["item_tokens"]) for r in queries.op1_string_tiling(spark, SMALL).collect()]
    assert sorted(got) == sorted(want) and want


def test_near_duplicates_of_more_documents(spark):
    """The query on a thousand documents, each pair of which is compared here on full sets."""
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{MIDDLE}/documents.parquet").collect()}
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in queries.op9_setsketch_duplicates(spark, MIDDLE).collect()}
    want = brute_components(texts, 2)
    assert got == want and len({c for _, c in want.values()}) < len(want)


# ---- values of awkward rows


def data(text):
    return (text or "").encode()


def padded(text):
    d = data(text)
    return d + bytes(-len(d) % 64 if d else 64)


def two_word_sets(rows):
    sets = {}
    for i, t in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", data(t).lower())
        sets[i] = {tuple(w[j : j + 2]) for j in range(max(1, len(w) - 1))} if w else set()
    return sets


def values(df, rows, columns, plain):
    """The rows' values by id, repeated ones included, are those of plain loops."""
    got = sorted((tuple(r) for r in df.select("doc_id", *columns).collect()), key=repr)
    assert got == sorted(((i, *plain(i, t)) for i, t in rows), key=repr)


@pytest.fixture(scope="module")
def rows(awkward):
    return [(r["doc_id"], r["text"]) for r in awkward.collect()]


def test_sizes(spark, awkward, rows):
    values(sharding.shard(awkward), rows, ["size", "text_crc32"], lambda _, t: (len(data(t)) + 16, zlib.crc32(data(t))))


def test_no_secrets(spark, awkward, rows):
    none = hashlib.sha256(b"").hexdigest()
    values(secret_scan.scan(awkward), rows, ["n_assign", "n_access", "n_hex", "base_sha256"], lambda _, t: (0, 0, 0, none))


def test_components_of_awkward_rows(spark, awkward, rows):
    sets, seen = two_word_sets(rows), {}
    for i, s in sets.items():
        if i is not None and s:  # of these rows only equal sets are alike
            seen[frozenset(s)] = min(i, seen.get(frozenset(s), i))
    plain = lambda i, t: (len(sets[i]), seen.get(frozenset(sets[i]), i) if i is not None else None)
    values(setsketch.near_duplicates(awkward, k=2), rows, ["n_shingles", "component_id"], plain)


def test_payloads(spark, awkward, rows):
    plain = lambda _, t: (len(data(t)), len(padded(t)), hashlib.sha256(padded(t)).hexdigest(), zlib.crc32(padded(t)[-64:]))
    values(telephony.media_features(awkward), rows, ["n_bytes", "payload_bytes", "payload_sha256", "tail_crc32"], plain)


def test_words_without_licenses(spark, awkward, rows):
    n = lambda t: len(re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", data(t).lower()))
    values(licenses.scan(awkward), rows, ["n_words", "n_base", "first_word", "last_word", "base_labels"], lambda _, t: (n(t), 0, None, None, ""))


def test_token_numbers(spark, awkward, rows):
    n = lambda t: len(re.findall(rb"[^\x20\x09-\x0D]+", data(t))) + 1
    values(lattice.score(awkward), rows, ["n_tokens"], lambda _, t: (n(t),))


def test_counts_of_edited_rows(spark, awkward, rows):
    counts = edit_counts.counter(edit_counts.default_vocabulary())
    plain = lambda _, t: (len(counts.split.findall(t or "")), len(counts.encoding.encode_ordinary(t or "")))
    values(edit_counts.edited_counts(awkward), rows, ["n_pretokens", "n_tokens"], plain)


def test_pieces_of_awkward_rows(spark, awkward, rows):
    """Every sequence is filled without gaps to 4,096 tokens at most, and equal texts give equal pieces."""
    pieces = packing.pack(awkward).collect()
    at: dict = {}
    for r in sorted(pieces, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == at.get(r["sequence_id"], 0)
        at[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(at.values()) <= 4096
    own = {i: Counter((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in pieces if r["doc_id"] == i) for i, _ in rows}
    assert own[10] == own[11] and own[3] == own[4] == Counter({(0, 0, 1, zlib.crc32((1).to_bytes(4, "little"))): 1})
    assert sorted(own[1].values()) == [2] and all(x[2] == 4096 for x in own[8] if x[0] < len(own[8]) - 1) and len(own[8]) > 1
