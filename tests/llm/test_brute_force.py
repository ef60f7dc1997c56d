"""Whole queries of op2, op3, op6 and op10 against plain loops."""

import hashlib
import math
import struct
import zlib

import numpy as np
import pytest
from test_llm_operators import SF, adpcm_one

from contigra.llm import edit_counts, models, sharding, telephony, toxicity
from contigra.llm.common import mix, word_hashes


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def rows(docs):
    return {r["doc_id"]: r["text"] for r in docs.collect()}


def mulaw_one(byte):
    byte = 255 - byte
    size = 132 + 8 * (byte % 16)
    size = size * 2 ** (byte // 16 % 8) - 132
    return -size if byte >= 128 else size


def alaw_one(byte):
    byte ^= 0b01010101
    segment, step = byte // 16 % 8, byte % 16
    size = 16 * step + 8 if segment == 0 else (16 * step + 264) * 2 ** (segment - 1)
    return size if byte >= 128 else -size


def twice(pcm):
    """8 to 16 kHz: each sample, and the middle to the next one, rounded down."""
    out = []
    for a, b in zip(pcm, [*pcm[1:], pcm[-1]], strict=True):
        out += [a, a + (b - a) // 2]
    return out


def test_media_of_all_texts(spark, docs, rows):
    """Stored form, features and resampled samples of every text, sample by sample."""
    seen = set()
    for r in telephony.media_features(docs).collect():
        data = (rows[r["doc_id"]] or "").encode()
        data += bytes(-len(data) % 64 if data else 64)
        codec = ("mulaw", "alaw", "adpcm")[zlib.crc32(data) % 3]
        seen.add(codec)
        if codec == "adpcm":
            pcm = [x for a in range(0, len(data), 64) for x in adpcm_one(data[a : a + 64])]
            head = struct.pack("<HHIIHHHH", 17, 1, 8000, 8000 * 64 // 121, 64, 4, 2, 121)
        else:
            pcm = [(mulaw_one if codec == "mulaw" else alaw_one)(x) for x in data]
            head = struct.pack("<HHIIHHH", {"mulaw": 7, "alaw": 6}[codec], 1, 8000, 8000, 1, 8, 0)
        body = b"WAVEfmt " + struct.pack("<I", len(head)) + head + b"fact" + struct.pack("<II", 4, len(pcm)) + b"data" + struct.pack("<I", len(data)) + data
        media = b"RIFF" + struct.pack("<I", len(body)) + body
        assert (r["media_bytes"], r["media_sha256"]) == (len(media), hashlib.sha256(media).hexdigest())
        pcm = twice(pcm)
        raw = struct.pack(f"<{len(pcm)}h", *pcm)
        turns = sum((a < 0) != (b < 0) for a, b in zip(pcm, pcm[1:], strict=False))
        assert bytes(r["pcm"]) == raw
        assert r["feature"] == f"{codec};n={len(pcm)};power={sum(x * x for x in pcm) // len(pcm)};peak={max(map(abs, pcm))};turns={turns};crc={zlib.crc32(raw)}"
    assert seen == {"mulaw", "alaw", "adpcm"}


def test_edited_counts_of_all_texts(spark, docs, rows):
    counts = edit_counts.counter(edit_counts.default_vocabulary())
    for r in edit_counts.edited_counts(docs).collect():
        text = rows[r["doc_id"]] or ""
        assert (r["n_pretokens"], r["n_tokens"]) == (len(counts.split.findall(text)), len(counts.encoding.encode_ordinary(text)))
        for (a, b), delete, insert in edit_counts.EDITS:
            at = len(text) * a // b
            text = text[:at] + insert + text[at + delete :]
        assert (r["edited_chars"], r["edited_pretokens"], r["edited_tokens"]) == (len(text), len(counts.split.findall(text)), len(counts.encoding.encode_ordinary(text)))


def features_one(text):
    """Words without punctuation, their first 4 and 5 bytes, each kind hashed on its own."""
    out = set()
    for w in set((text or "").encode().lower().translate(None, bytes(c for c in range(33, 127) if not chr(c).isalnum())).split()):
        for kind, part in enumerate((w, w[:4] if len(w) > 4 else None, w[:5] if len(w) > 5 else None)):
            if part is not None:
                out.add(int(mix(word_hashes([part]) + np.uint64(kind))[0]))
    return out


def test_severity_of_all_texts(spark, docs, rows):
    """Grades by the cumulative law, from shared weights and ordered thresholds."""
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.fit(docs, labels)
    assert (np.diff(model.thresholds) > 0).all()
    weight = dict(zip(model.features.tolist(), model.weights.tolist(), strict=True))
    for r in toxicity.severity(docs, labels).collect():
        s = sum(weight.get(f, 0.0) for f in features_one(rows[r["doc_id"]]))
        upto = [0.0, *(1 / (1 + math.exp(-min(40.0, max(-40.0, t - s)))) for t in model.thresholds), 1.0]
        p = [b - a for a, b in zip(upto, upto[1:], strict=False)]
        assert r["expected_severity"] == pytest.approx(sum(k * x for k, x in enumerate(p)), abs=1e-6)
        assert r["p_toxic"] == pytest.approx(1 - p[0], abs=1e-6)
        if sorted(p)[-1] - sorted(p)[-2] > 1e-6:
            assert r["severity"] == p.index(max(p))


def test_lexical_features_match(rows):
    for t in list(rows.values())[:60]:
        assert set(models.lexical((t or "").encode()).tolist()) == features_one(t)


def test_permutations_are_uniform(spark):
    """Where one row lands, over many seeds: every shard and slot alike, whatever its cell."""
    df = spark.range(12, numPartitions=3).selectExpr("id as doc_id", "'x' as text").collect()
    table = spark.createDataFrame(df, "doc_id long, text string").repartition(3).cache()
    n, seen = 60, np.zeros((12, 12), int)
    for seed in range(n):
        for r in sharding.shard(table, 3, seed).select("doc_id", "shard", "slot").collect():
            seen[r["doc_id"], 4 * r["shard"] + r["slot"]] += 1
    assert (seen.sum(1) == n).all() and (seen.sum(0) == n).all()
    chi = ((seen - n / 12) ** 2 / (n / 12)).sum()
    assert chi < 121 + 5 * math.sqrt(2 * 121)


def test_inverted_draws_follow_the_law():
    """The draw for large populations against numpy's, by mean and variance, and its limits."""
    rng = np.random.default_rng(3)
    good, bad, n = 30, 50, 20
    x = np.array([sharding.inverted(rng, good, bad, n) for _ in range(20_000)])
    mean, var = n * good / 80, n * good / 80 * bad / 80 * (80 - n) / 79
    assert abs(x.mean() - mean) < 5 * math.sqrt(var / len(x)) and abs(x.var() / var - 1) < 0.06 and x.min() >= 0 and x.max() <= n
    assert sharding.inverted(rng, 5, 0, 3) == 3 and sharding.inverted(rng, 0, 5, 3) == 0
    big = [sharding.inverted(rng, 6 * 10**9, 4 * 10**9, 10**6) for _ in range(200)]
    assert abs(np.mean(big) - 6e5) < 5 * math.sqrt(1e6 * 0.24 / 200)
