"""Exact dedup (10), n-gram Jaccard join (1), line dedup (4) and suffix dedup (8)."""

import glob
import os
import random
import tempfile
import time

import pytest
from pyspark.sql import functions as F

import brute
from odd_rows import LOREM, SF001, no_docs, odd_docs  # noqa: F401
from tarmac.llm import exact_dedup as E
from tarmac.llm import jaccard_join as J
from tarmac.llm import line_dedup as L
from tarmac.llm import suffix_dedup as S
from tarmac.llm.common import saved


def rows_of(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]


# ---------------------------------------------------------------- exact dedup

def groups(df):
    return sorted((r.id if r.id is not None else -1, r.keep_id, r.group_size, r.kept) for r in df.collect())


def test_exact_dedup_odd_rows(odd_docs, no_docs):
    got = groups(E.dedup(odd_docs))
    assert (0, 1, 3, False) in got and (1, 1, 3, True) in got and (-1, 1, 3, False) in got
    assert (2, 3, 2, False) in got and (3, 3, 2, True) in got          # null is the empty text
    assert got.count((7, 7, 2, True)) == 2                            # one document, written twice
    assert (5, 5, 1, True) in got and (6, 6, 1, True) in got          # case counts
    assert E.dedup(no_docs).count() == 0


def test_exact_dedup_digest_clash_is_split_by_bytes(spark):
    docs = spark.createDataFrame([(1, "aa"), (2, "ab"), (3, "aa"), (4, "b"), (5, "ab")], "doc_id long, text string")
    got = groups(E.dedup(docs, digest=lambda t: F.substring(t, 1, 1)))
    assert got == [(1, 3, 2, False), (2, 5, 2, False), (3, 3, 2, True), (4, 4, 1, True), (5, 5, 2, True)]


def test_exact_dedup_state_goes_on_over_batches_and_runs(spark, tmp_path):
    path, state = str(tmp_path / "docs"), str(tmp_path / "state")
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    for rows in ([(1, "a"), (2, "b")], [(3, "a"), (4, "c")], [(5, "b")]):
        frame(rows).write.mode("append").parquet(path)
    first = groups(E.dedup_files(spark, path, state_root=state, max_files=1))     # a batch per file
    assert first == [(1, 3, 2, False), (2, 5, 2, False), (3, 3, 2, True), (4, 4, 1, True), (5, 5, 2, True)]
    frame([(6, "a"), (0, "c")]).write.mode("append").parquet(path)
    again = groups(E.dedup_files(spark, path, state_root=state, max_files=1))
    assert (3, 6, 3, False) in again and (6, 6, 3, True) in again and (0, 4, 2, False) in again


def test_exact_dedup_state_outlives_its_files(spark, tmp_path):
    """Rows whose file is gone count no more; a file rewritten in place is told, not dropped."""
    state = str(tmp_path / "state")
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    for k, rows in enumerate(([(1, "a"), (2, "b"), (7, "z")], [(3, "a"), (4, "c")])):
        frame(rows).write.parquet(str(tmp_path / f"w{k}"))
    docs = tmp_path / "docs"
    docs.mkdir()
    for k in (0, 1):
        part = next((tmp_path / f"w{k}").glob("part-*"))
        (docs / f"f{k}.parquet").write_bytes(part.read_bytes())
    path = f"{docs}/"
    first = groups(E.dedup_files(spark, path, state_root=state))
    assert first == [(1, 3, 2, False), (2, 2, 1, True), (3, 3, 2, True), (4, 4, 1, True), (7, 7, 1, True)]
    (docs / "f1.parquet").unlink()
    assert groups(E.dedup_files(spark, path, state_root=state)) == [(1, 1, 1, True), (2, 2, 1, True), (7, 7, 1, True)]
    frame([(8, "new")]).write.parquet(str(tmp_path / "w2"))
    (docs / "f0.parquet").write_bytes(next((tmp_path / "w2").glob("part-*")).read_bytes())
    os.utime(docs / "f0.parquet", (1, 1))
    with pytest.raises(Exception, match="rewritten in place|new state_root"):
        E.dedup_files(spark, path, state_root=state).collect()


def test_exact_dedup_stage_keeps_columns_and_one_row(odd_docs):
    got = E.stage(odd_docs.sparkSession, odd_docs, SF001)
    assert got.columns == odd_docs.columns
    assert sorted(r.doc_id for r in got.collect()) == [1, 3, 4, 5, 6, 7, 7, 8, 9]


# ---------------------------------------------------------------- Jaccard join

def test_jaccard_join_matches_brute_force(spark):
    rows = rows_of(spark)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.op1_jaccard_join(spark, SF001).collect()}
    assert got == brute.jaccard_components(rows)


@pytest.fixture(scope="module")
def near_copies(spark):
    """A chain and a star of near copies, pieces shared by many, and very small sets."""
    rng = random.Random(5)
    vocab = [f"v{i}" for i in range(4000)]
    base = [rng.choice(vocab) for _ in range(120)]
    rows, shared = [], [rng.choice(vocab) for _ in range(40)]
    for _ in range(60):
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        rows.append(w)
    for _ in range(40):
        rows.append(shared + [rng.choice(vocab) for _ in range(rng.randint(0, 30))])
    step = list(base[:60])
    for _ in range(12):
        step = list(step)
        step[rng.randrange(60)] = rng.choice(vocab)
        rows.append(step)
    large = [rng.choice(vocab) for _ in range(520)]     # sets just over and under LONG, and well over it
    for n in (1, 2, 6, 11, 40):
        rows.append(large[n:])
    for n in (0, 30, 400, 700):
        rows.append((large * 3)[: 1500 - n] + [rng.choice(vocab) for _ in range(n)])
    for _ in range(60):
        rows.append([rng.choice(vocab[:6]) for _ in range(rng.randint(1, 9))])
    return [(i, " ".join(w)) for i, w in enumerate(rows)]


@pytest.mark.parametrize("small, pivots, stars", [(J.SMALL, J.PIVOTS, J.STARS), (3, 2, 1)])
def test_jaccard_join_recursion_is_exact(spark, near_copies, monkeypatch, small, pivots, stars):
    real = J.class_components
    monkeypatch.setattr(J, "class_components", lambda c, s, b: real(c, s, b, small, pivots, stars))
    docs = spark.createDataFrame(near_copies, "doc_id long, text string")
    got = {r.id: (r.n_shingles, r.component_id) for r in J.join(docs).collect()}
    assert got == brute.jaccard_components(near_copies)


def test_jaccard_join_odd_rows(odd_docs, no_docs):
    got = sorted((r.id if r.id is not None else -1, r.n_shingles, r.component_id) for r in J.join(odd_docs).collect())
    n = len(brute.shingles(LOREM))
    assert [g for g in got if g[0] in (-1, 0, 1, 8)] == [(-1, n, 0), (0, n, 0), (1, n, 0), (8, n + 3, 0)]
    assert [g for g in got if g[0] in (2, 3, 4)] == [(2, 0, 2), (3, 0, 3), (4, 0, 4)]
    assert [g for g in got if g[0] in (5, 6)] == [(5, 1, 5), (6, 1, 5)]
    assert [g for g in got if g[0] == 7] == [(7, 59_996, 7)] * 2
    assert J.join(no_docs).count() == 0


def test_jaccard_stage_keeps_one_of_each(odd_docs):
    got = J.stage(odd_docs.sparkSession, odd_docs, SF001)
    assert got.columns == odd_docs.columns
    assert sorted(r.doc_id for r in got.collect()) == [0, 2, 3, 4, 5, 7, 7, 9]


def test_jaccard_null_and_repeated_ids(spark):
    """Rows of one id, or of none, are judged one by one, and a null-id set links others."""
    rng = random.Random(3)
    text = lambda n: " ".join(f"u{rng.randrange(10 ** 6)}" for _ in range(n))
    one, two, three, four = text(60), text(50), text(60), text(40)
    left = " ".join(three.split()[5:])                   # three: left -- three -- right, ends too far apart
    right = " ".join(three.split()[:-8])
    large = text(1200)
    docs = spark.createDataFrame([
        (1, one), (None, one), (None, two), (None, four), (4, one + " end"), (4, text(45)), (4, None),
        (10, left), (None, three), (11, right), (12, " ".join(large.split()[90:])), (None, large),
        (13, " ".join(large.split()[:-120]))], "doc_id long, text string")
    assert brute.jaccard_components([(1, left), (2, right)])[2][1] == 2
    got = {(r.id, r.n_shingles): r.component_id for r in J.join(docs).collect()}
    assert got[10, 51] == got[11, 48] == 10
    assert {r.component_id for r in J.join(docs).collect() if (r.id, r.n_shingles) == (None, 56)} == {1, 10}
    assert [got[12, 1106], got[None, 1196], got[13, 1076]] == [12, 12, 12]
    kept = sorted((r.doc_id or 0, r.text) for r in J.stage(spark, docs, SF001).collect() if r.text)
    gone = {(0, one), (4, one + " end"), (0, three), (11, right), (0, large), (13, " ".join(large.split()[:-120]))}
    assert kept == sorted({(r.doc_id or 0, r.text) for r in docs.collect() if r.text} - gone)
    assert J.stage(spark, docs, SF001).filter("doc_id = 4 AND text IS NULL").count() == 1


# ---------------------------------------------------------------- line dedup

def test_line_dedup_matches_brute_force(spark):
    want = brute.removed_lines(sorted(rows_of(spark)))
    got = {r.doc_id: [int(x) for x in r.removed_lines.split(",") if x] for r in L.op4_line_dedup(spark, SF001).collect()}
    assert got == want


def test_line_dedup_texts_and_odd_rows(spark, odd_docs, no_docs):
    docs = spark.createDataFrame([
        (1, "a b c d e\nsame line here now ok\n\nx"), (2, "same line here now OK\ny\na b c d e f\n"), (3, None), (4, "")],
        "doc_id long, text string")
    got = {r.doc_id: r.text for r in L.dedup(docs).collect()}
    assert got == {1: "a b c d e\nsame line here now ok\n\nx", 2: "y", 3: None, 4: ""}
    assert L.removed_lines(no_docs).count() == 0
    told = [(r.id, r.line, r.removed) for r in L.removed_lines(odd_docs).collect()]
    assert (0, 0, True) in told and (None, 0, False) in told and (6, 0, True) in told     # null ids come first


def test_line_dedup_null_and_repeated_ids(spark, tmp_path):
    """Texts under one id, or under none, keep their own lines; a document written twice counts once."""
    same = "one line that all of them hold"
    rows = [(i, f"{same}\nonly {k} has this\n{k}{k} and {k}{k}{k}") for i, k in
            [(None, "a"), (None, "b"), (5, "c"), (5, "d"), (7, "e"), (7, "e")]] + [(5, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = [r.text for r in L.dedup(docs).collect()]
    whole = [t for t in left if t and same in t]
    assert len(left) == 8 and len(whole) == 1                 # the first by id and hash, a null-id row
    cut = {t.split("\n", 1)[1] for _, t in rows if t}
    assert {t.replace(same + "\n", "") for t in left if t} == cut
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((r.doc_id or 0, r.n_lines, r.n_removed, r.removed_lines) for r in L.op4_line_dedup(spark, str(tmp_path)).collect())
    assert got == [(0, 0, 0, ""), (0, 3, 0, ""), (0, 3, 1, "0"), (5, 0, 0, ""), (5, 3, 1, "0"), (5, 3, 1, "0"),
                   (7, 3, 1, "0"), (7, 3, 1, "0")]


# ---------------------------------------------------------------- suffix dedup

def spans_of(df):
    got = {}
    for r in df.collect():
        got.setdefault(r.id, []).append((r.start_word, r.end_word))
    return {k: sorted(v) for k, v in got.items()}


def test_suffix_dedup_matches_brute_force(spark):
    assert spans_of(S.spans(spark.read.parquet(f"{SF001}/documents.parquet"))) == brute.repeated_spans(rows_of(spark))


@pytest.mark.parametrize("batch", ["10000", "7"])
def test_suffix_dedup_finds_planted_passages(spark, batch):
    """Passages of 49 to 120 words at random places; small batches cut every run of equal hashes."""
    rng = random.Random(9)
    word = lambda: f"t{rng.randrange(10 ** 6)}"
    passages = [[word() for _ in range(n)] for n in (49, 50, 51, 60, 83, 120)] + [["same"] * 70]
    rows = []
    for i in range(120):
        text = [word() for _ in range(rng.randint(0, 120))]
        for p in rng.sample(passages, rng.randint(0, 2)):
            text += p + [word() for _ in range(rng.randint(0, 60))]
        rows.append((i, " ".join(text)))
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, batch)
    try:
        got = spans_of(S.spans(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)))
    finally:
        spark.conf.set(key, before)
    assert got == brute.repeated_spans(rows)


def test_suffix_dedup_odd_rows(spark, odd_docs, no_docs):
    assert S.spans(odd_docs).count() == 0                   # the long text repeats under one id only
    assert S.spans(no_docs).count() == 0
    text = " ".join(f"z{i}" for i in range(55))
    twice = spark.createDataFrame([(None, text), (3, "x " + text), (3, text)], "doc_id long, text string")
    assert spans_of(S.spans(twice)) == {None: [(0, 55)], 3: [(0, 56)]}


# ---------------------------------------------------------------- tables between steps

def test_a_saved_table_leaves_no_shuffle_files(spark):
    """The shuffles of several steps must not add up on disk until the driver collects garbage."""
    found = lambda: set(glob.glob(f"{tempfile.gettempdir()}/blockmgr-*/*/shuffle_*.data"))
    df = spark.range(50_000).groupBy((F.col("id") % 9_000).alias("k")).count()
    df.write.format("noop").mode("overwrite").save()
    start = found()
    assert start  # this is where they are
    kept = saved(df, "no-shuffle-left")
    for _ in range(50):
        if not found() - start:
            break
        time.sleep(0.1)
    assert not found() - start
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    assert kept.count() == df.count() == 9_000


def test_line_dedup_long_lines_keep_their_filter(spark):
    """Postings carry 128 bits; pairs of long lines that only these let through are dropped by all 256."""
    words = [f"w{i}" for i in range(5_000)]
    lines = [" ".join(["rare", *random.Random(k).sample(words, 400)]) for k in range(6)]
    lines += [lines[0] + " more", lines[1].replace("rare", "scarce")]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    got = {r.id for r in L.removed_lines(docs).filter("removed").collect()}
    assert got == {6, 7}


def test_line_dedup_group_of_near_copies_makes_few_pairs(spark, monkeypatch):
    """Near copies meet a few of their group, not each other; lines that match a later copy only are still found."""
    rng = random.Random(11)
    base = [f"n{i}" for i in range(40)]
    lines = []
    for k in range(300):
        line = list(base)
        for at in rng.sample(range(40), rng.randint(0, 6)):
            line[at] = f"e{rng.randrange(10 ** 6)}"
        lines.append(" ".join(line))
    lines += [" ".join(f"o{rng.randrange(10 ** 6)}" for _ in range(40)) for _ in range(50)]
    rows = [(i if i % 7 else None, text) for i, text in enumerate(lines)]
    made = {}

    def spy(df, name, **options):
        made[name] = saved(df, name, **options)
        return made[name]

    monkeypatch.setattr(L, "saved", spy)
    got = {(r.id, r.h): r.removed for r in L.removed_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    pairs = made["line-candidates"].count() + made["line-lead-pairs"].count()
    h = {r.text: r.h for r in spark.createDataFrame(rows, "doc_id long, text string").select("text", F.xxhash64("text").alias("h")).collect()}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, h[r[1]]))
    want = brute.removed_lines([(i, text) for i, (_, text) in enumerate(order)])
    assert got == {(i, h[text]): bool(want[k]) for k, (i, text) in enumerate(order)}
    assert pairs < 10_000                                   # some 40,000 when all near copies meet
