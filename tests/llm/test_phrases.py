"""Phrase collocation mining (12) against a plain version."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from odd_rows import SF001, no_docs, odd_docs  # noqa: F401
from tarmac.llm import phrases as P


def plain_phrases(rows, support=10, top=2000):
    counts, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                counts[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= support}
        kept = []
        for p, a in cand.items():
            if any(len(q) > len(p) and 100 * b >= 50 * a and any(q[i:i + len(p)] == p for i in range(len(q)))
                   for q, b in cand.items() if len(q) > len(p)):
                continue
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(kept)[:top])]
    return sorted(out)


def mined(docs, **kw):
    return sorted(tuple(r) for r in P.collocations(docs, **kw).collect())


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(12)
    vocab = ["New york City", "york", "city", "é", "😀", "a", "b", "c\x00d", "x\xa0y", "of", "the", "\x0bz"]
    return [(rng.choice(["en", "de", None, "und"]),
             "".join(rng.choice(vocab) + rng.choice([" ", " ", " ", "\t", "  ", ". ", "\n", ","])
                     for _ in range(rng.randint(0, 60)))) for _ in range(160)]


def test_phrases_match_a_plain_version(spark, rows):
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    want = plain_phrases(rows)
    assert len(want) > 60 and any(len(r[2].split(" ")) == 3 for r in want)
    assert mined(docs) == want
    assert mined(docs, shards=1) == want and mined(docs, shards=9) == want
    assert mined(docs, support=3, top=7) == plain_phrases(rows, 3, 7)


def test_phrases_small_chunks_and_ranges(spark, rows, monkeypatch):
    docs = spark.createDataFrame(rows, "lang string, text string")
    monkeypatch.setattr(P, "RANGE_KEYS", 2000)
    cut = P.chunked(docs, 400)
    assert cut.count() > 30 and cut.agg(F.sum("n_words")).first()[0] > 1000
    assert mined(docs, chunk_bytes=400) == plain_phrases(rows)


def test_phrases_parts_of_long_texts():
    text = ("word " * 30 + ". " + "b c, " * 40 + "é" * 120).encode()
    parts = list(P._parts(text, 50))
    assert b"".join(parts) == text and len(parts) > 4
    assert all(len(p) <= 50 or not any(c in b".,;:!?\n" for c in p[:-1]) for p in parts)
    assert all(p[-1:] in b".,;:!?\n" for p in parts[:-1])


def test_phrases_sorted_keys_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, 5000):
        keys = np.sort(rng.integers(0, 1 << 63, n, np.uint64) * 2)
        counts = rng.integers(1, 1000, n)
        got, held = P._unpack(P._pack(keys, counts))
        assert (got == keys).all() and (held == np.minimum(counts, 255)).all()
        for ranges in (1, 7, 1 << 30):
            ids, first, end = P._ranges(keys, ranges)
            assert (np.diff(ids) > 0).all() and (end > first).all() and (end - first).sum() == n
            assert all(int(k) * ranges >> 64 in (r, r + 1) for r, i in zip(ids.tolist(), first) for k in keys[i:i + 1])
            assert ids.max(initial=0) < ranges


def test_phrases_no_frequent_run_is_lost_however_it_is_spread():
    """A run seen ten times is a candidate for any split of its occurrences over chunks."""
    rng = random.Random(4)
    for _ in range(200):
        chunks = rng.randint(1, 12)
        seen = Counter(rng.randrange(chunks) for _ in range(10))
        keys = [np.array([7] if c in seen else [], np.uint64) for c in range(chunks)]
        counts = [np.array([seen[c]] if c in seen else [], np.uint8) for c in range(chunks)]
        marks = P.mined(keys, counts, P.shard_of(np.arange(chunks), 4), 10, 4)
        assert all(m.all() for m in marks)
    marks = P.mined([np.array([7], np.uint64)], [np.array([9], np.uint8)], np.array([0]), 10, 4)
    assert not marks[0].any()


def test_phrases_odd_rows(spark, odd_docs, no_docs):
    docs = odd_docs.withColumn("phrase", F.lit(1)).withColumn("f", F.lit("x")).withColumn("words", F.lit("y"))
    rows = [(r.lang, r.text) for r in odd_docs.select("lang", "text").collect()]
    want = plain_phrases(rows, 3)
    assert mined(docs, support=3) == want and want[0][0] == "und"
    assert mined(no_docs) == [] and mined(odd_docs.filter("text IS NULL OR text = ''")) == []
    with pytest.raises(ValueError, match="support"):
        P.collocations(docs, support=0)


def test_op12_on_the_table(spark):
    rows = [(r.lang, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("lang", "text").collect()]
    got = sorted(tuple(r) for r in P.op12_phrase_collocations(spark, SF001).collect())
    assert got == plain_phrases(rows) and got


def test_phrases_products_beyond_64_bits(spark):
    """The score's decimal arithmetic at counts of twelve digits."""
    a, l, r = 10 ** 12 + 7, 10 ** 12 + 9, 3 * 10 ** 12 + 1
    got = spark.range(1).selectExpr(
        f"(CAST(1000000 AS DECIMAL(7,0)) * (CAST({a} AS DECIMAL(15,0)) * CAST({a} AS DECIMAL(15,0)))) div "
        f"(CAST({l} AS DECIMAL(15,0)) * CAST({r} AS DECIMAL(15,0))) AS s").first()[0]
    assert got == 1_000_000 * a * a // (l * r)
