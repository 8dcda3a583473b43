"""HTML extraction (2), BPE (3), decontamination (5), quality (6), language model (7), sharding (9)."""

import hashlib
import math
import time
import zlib
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import brute
from odd_rows import LOREM, SF001, no_docs, odd_docs  # noqa: F401
from tarmac.llm import bpe, decontaminate as D, html_extract as X, language_model as M, quality as Q, sharding as Z
from tarmac.llm.queries import ORACLE_SQL, QUERIES
from tarmac.oracle_check import compare


def test_queries_match_their_sql(spark):
    got = compare(spark, SF001, list(ORACLE_SQL), verbose=False)
    assert all(r["match"] for r in got.values()), got
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


# ---------------------------------------------------------------- HTML

BOILER = """<html><head><title>t</title><style>p{}</style></head><body class="has-sidebar">
<header><h2>Site</h2></header><nav><a href="/">Home</a></nav><div class="cookie-notice">We use cookies</div>"""


def extracted(spark, pages):
    frame = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(pages)], "page_id long, url string, html string")
    return [r.text for r in X.extract(frame).orderBy("page_id").collect()]


def test_html_leaves_furniture_out(spark):
    page = BOILER + """<div id="main"><div class="post-12"><h1>A &amp; B</h1><p>One  two\n three&nbsp;four.<p>Second <b>bold</b> text,
        <a href="#">a link</a> too.<ul><li>first<li>second</ul><form><input>Search</form>
        <div class="ad">Buy!</div><script>var x="<p>no</p>";</script><!-- <p>no</p> --></div>
        <div class="comments"><p>Reader says a lot of things here, longer than the article itself, on and on.</p></div></div>
        <aside>Side</aside><footer>&copy; me</footer></body></html>"""
    assert extracted(spark, [("http://a.org/1", page)]) == [
        "A & B\nOne two three four.\nSecond bold text, a link too.\nfirst\nsecond"]


def test_html_host_consensus_outvotes_a_page(spark):
    """On its own page the long list wins; the host's other pages show where the text is."""
    body = "<div class='story'><p>{}</p></div><div class='list'><p>{}</p></div>"
    pages = [("http://h.org/%d" % i, body.format("real text " * 30, "x")) for i in range(4)]
    pages.append(("http://h.org/9", body.format("short real text", "teaser words " * 40)))
    pages.append(("http://other.org/9", body.format("short real text", "teaser words " * 40)))
    got = extracted(spark, pages)
    assert got[4] == "short real text" and got[5].startswith("teaser words")


def test_html_odd_pages(spark):
    long_page = "<article>" + "".join(f"<p>part {i}</p>" for i in range(20_000)) + "</article>"
    got = extracted(spark, [(None, None), ("x", ""), ("http://a.b", "no markup &lt;here&gt;"), ("http://a.b", "<p>open <b>text"),
                            ("http://c.d", long_page), ("http://c.d", long_page), ("http://e.f", "<script>never ends")])
    assert got[:4] == ["", "", "no markup <here>", "open text"] and got[6] == ""
    assert got[4] == got[5] == "\n".join(f"part {i}" for i in range(20_000))
    empty = spark.createDataFrame([], "page_id long, url string, html string, path string, winning_path string, text int")
    assert X.extract(empty).count() == 0


def test_html_text_outside_of_blocks(spark):
    got = extracted(spark, [
        ("http://a.b/1", "Hello world this is plain text <b>bold</b> and more text <i>end</i>"),
        ("http://c.d/1", "plain text of the whole page <div class='ad'>Buy</div>"),
        ("http://e.f/1", "<p>first para</p>loose text of some length<p>second para</p><i>x</i>")])
    assert got == ["Hello world this is plain text bold and more text end", "plain text of the whole page",
                   "first para\nloose text of some length\nsecond para\nx"]


def test_html_deep_nesting_takes_linear_time(spark):
    """100,000 open tags, blocks and inline, within the seconds that a quadratic walk would not keep."""
    deep = "<div>" * 50_000 + "<p>deep text" + "<b><span>" * 25_000 + " goes on" + "</i>" * 50_000
    start = time.monotonic()
    assert extracted(spark, [("http://a.b/", deep)]) == ["deep text goes on"]
    assert time.monotonic() - start < 60


@pytest.mark.parametrize("name", ["text", "TEXT", "Text"])
def test_html_result_replaces_a_column_of_its_name(spark, name):
    pages = spark.createDataFrame([("http://a.b/", "<p>x y</p>", 5)], f"url string, html string, {name} int")
    assert [tuple(r) for r in X.extract(pages).select("url", "text").collect()] == [("http://a.b/", "x y")]


def test_html_article_over_several_containers(spark):
    """Every container with the winning path counts, on a host's own path and on a page that lacks it."""
    parts = ["words of part %d " % i * 20 for i in range(3)]
    want = "\n".join(p.strip() for p in parts)
    body = "<body><nav>menu</nav>{}<div class='teaser'><p>more</p></div></body>"
    shapes = ["".join(f"<div class='part-{i}'><p>{p}</p></div>" for i, p in enumerate(parts)),
              "<hr><div class='ad'>Buy!</div>".join(f"<section><p>{p}</p></section>" for p in parts),
              "".join(f"<article><p>{p}</p></article>" for p in parts),
              "<x-part>%s</x-part> <x-part>%s</x-part>aside<x-part>%s</x-part>" % tuple(
                  f"<div>{p}</div>" for p in parts),
              f"<section><p>{parts[0]}</p></section><section><a href='#'>{parts[1]}</a></section>"
              f"<section><p>{parts[2]}</p></section>"]
    pages = [(f"http://h{i}.org/{k}", body.format(s)) for i, s in enumerate(shapes) for k in range(2)]
    assert extracted(spark, pages) == [want] * len(pages)
    story = "<body><div class='story'><p>%s</p></div></body>" % ("real text " * 30)
    pages = [("http://g.org/%d" % i, story) for i in range(9)] + [("http://g.org/9", body.format(shapes[1].replace(
        parts[0], parts[0] * 9)))]
    assert extracted(spark, pages)[9] == "\n".join([(parts[0] * 9).strip(), *want.split("\n")[1:]])


# ---------------------------------------------------------------- BPE

@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(bpe.default_path())


ODD_TEXTS = ["", "a<|endoftext|>b <|startoftext|>", "ΑΣ ΣΑΣ Σ ΟΔΟΣ.", "İstanbul I İ", "don't we'll  x y\u0085z", "ﬁ é café",
             "x" * 3000, "𝔘𝔫 😀😀 👍🏽", "\x00\x01\x1c\x1d a", "１２３ ½ ²", "ß ẞ Ǆ ǅ ᾈ ŉ", "<|endoftext", "﻿hi", "a'S 'T I'LL", LOREM]


def test_bpe_equals_the_library(library):
    encode = bpe.Encoder(bpe.vocabulary(bpe.default_path()), limit=40)     # a cache that overflows at once
    for _ in range(2):
        got = encode(pa.array(ODD_TEXTS)).to_pylist()
        assert got == [e.ids for e in library.encode_batch(ODD_TEXTS, add_special_tokens=False)]


def test_bpe_works_out_a_stretch_once_in_all_pieces(library, monkeypatch):
    """However many distinct stretches there are, later pieces of a run do not work them out again."""
    vocab, seen = bpe.vocabulary(bpe.default_path()), Counter()
    real = bpe.Vocabulary.words
    monkeypatch.setattr(bpe.Vocabulary, "words", lambda self, chunks: seen.update(chunks) or real(self, chunks))
    texts = [" ".join(f"word{i}, it's" for i in range(k, 200 + k)) for k in range(6)] + ["<|endoftext|>"]
    coded = bpe.Encoder(vocab, limit=50).code(pa.array(texts), [(0, 2), (2, 3), (5, 2)])
    got = [ids for piece in range(3) for ids in coded.ids(piece).to_pylist()]
    assert got == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    del seen[""]
    assert len(seen) == 206 and set(seen.values()) == {1}


def test_bpe_round_trip_in_spark(spark, library, odd_docs, no_docs):
    path = bpe.default_path()
    both = bpe.encode(odd_docs, path, decoded="decoded")
    apart = bpe.decode(bpe.encode(odd_docs, path), path)
    assert both.columns == [*odd_docs.columns, "ids", "decoded"]
    rows = both.collect()
    assert sorted(map(str, rows)) == sorted(map(str, apart.collect()))
    for r in rows:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == ids and r.decoded == library.decode(ids, skip_special_tokens=False)
    assert bpe.encode(no_docs, path).count() == 0


def test_bpe_result_replaces_columns_of_its_names(spark, library):
    docs = spark.createDataFrame([(1, "some words", 7, "z")], "doc_id long, text string, IDS int, Decoded string")
    got = bpe.encode(docs, bpe.default_path(), decoded="decoded")
    assert got.columns == ["doc_id", "text", "ids", "decoded"]
    assert got.first().ids == library.encode("some words", add_special_tokens=False).ids
    again = bpe.decode(got.withColumnRenamed("decoded", "DECODED"), bpe.default_path())
    assert again.columns == ["doc_id", "text", "ids", "decoded"] and again.first().decoded == library.decode(
        got.first().ids, skip_special_tokens=False)


def test_bpe_query(spark, library):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = {r.doc_id: tuple(r)[1:] for r in bpe.op3_bpe(spark, SF001).collect()}
    for i, t in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect():
        ids = library.encode(t, add_special_tokens=False).ids
        assert got[i] == (len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))


# ---------------------------------------------------------------- decontamination

def test_decontaminate_odd_rows(spark, odd_docs, no_docs):
    items = spark.createDataFrame([("b", LOREM), ("a", LOREM), ("c", None), ("d", "..."), ("e", "One, TWO!"), ("f", "é")],
                                  "item_id string, text string")
    got = {(r.id, r.n_words): r for r in D.find(odd_docs, items).collect()}
    assert got[0, 21].n_hit == 21 and got[0, 21].items == ["a", "b"] and got[0, 21].contaminated
    assert got[5, 2].items == ["e"] and got[6, 2].items == ["e"] and got[9, 5].n_hit == 1
    assert got[2, 0].n_hit == 0 and not got[2, 0].contaminated and got[4, 0].n_words == 0
    assert got[7, 60_000].n_hit == 0 and got[None, 21].contaminated
    assert D.find(no_docs, items).count() == 0
    assert D.find(odd_docs, items.limit(0)).filter("n_hit > 0").count() == 0


def test_decontaminate_removes_spans(spark):
    items = spark.createDataFrame([(1, "b c d")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a B, c d. e b c d"), (2, "b  c")], "doc_id long, text string")
    found = D.find(docs, items)
    assert {r.doc_id: r.text for r in D.remove_spans(docs, found).collect()} == {1: "a e", 2: "b  c"}
    assert [r.doc_id for r in docs.join(found.filter("NOT contaminated"), docs.doc_id == found.id).collect()] == [2]


def test_decontaminate_plan_is_native(spark):
    plan = QUERIES["op5_decontaminate"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))


# ---------------------------------------------------------------- quality

def test_quality_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    rows = Q.op6_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out").collect()
    right = sum(r.predicted == r.quality for r in rows) / len(rows)
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    auc = sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad))
    assert right > 0.95 and auc > 0.95
    assert sum(r.predicted for r in rows if r.quality) >= 0.98 * len(good)          # clean documents stay
    for r in rows[:50]:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)


def test_quality_never_learns_from_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF001}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.withColumn("quality", F.when(Q.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = Q.fit(docs, labels), Q.fit(docs.repartition(7), flipped)
    assert (a.weights == b.weights).all() and a.prior == b.prior


def test_quality_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(0, 1, 0), (1, None, 1), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = Q.score(odd_docs.drop("score"), Q.fit(odd_docs, labels))
    assert got.count() == 12 and all(0 <= r.score <= 1 for r in got.collect())
    none = Q.fit(no_docs, labels)
    assert {r.score for r in Q.score(odd_docs, none).collect()} == {0.5}


def test_quality_hot_id_and_scaling_over_all_rows(spark, monkeypatch):
    """One id on a third of the rows: the sample keeps its bound, and the scaling is that of all training rows."""
    good, bad = "A calm and well written sentence number {}. It says what it means.", "xx {} !! BUY $$$ now {}"
    ids = [i for i in range(4000) if zlib.crc32(str(i).encode()) % 3 != 1]
    rows = [(ids[0], good.format(i)) for i in range(500)] + [
        (i, (good if i % 2 else bad).format(i, i)) for i in ids[1:1001]] + [(ids[5], good.format("same"))] * 300
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in ids[:1001] if i % 4 == 1 or i == ids[0]], "doc_id long, quality int")
    seen = []
    real = Q._fit
    monkeypatch.setattr(Q, "_fit", lambda p, u, *a: seen.append((len(p), len(u))) or real(p, u, *a))
    model = Q.fit(docs, labels, sample=50)
    assert seen[-1] == (50, 50) and all(max(x) <= 50 for x in seen)
    x = Q.features(pa.array([t for _, t in rows])).astype(float)
    assert abs(model.mean - x.mean(0)).max() < 1e-3 and abs(model.spread - x.std(0)).max() < 2e-2
    assert 0.05 <= model.prior <= 0.95
    rows = Q.score(docs.withColumn("SCORE", F.lit(1)), model, out="Score").collect()
    assert sum((r.Score >= 0.5) == r.text.startswith("A calm") for r in rows) > 0.95 * len(rows)


# ---------------------------------------------------------------- language model

def test_language_model_matches_brute_force(spark):
    got = {r.doc_id: r for r in M.op7_lm_score(spark, SF001).collect()}
    rows = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 1
    seq = {i: [*brute.words(t), "</s>"] for i, t in rows}
    c, pairs = Counter(), Counter()
    for i, w in seq.items():
        if not held(i):
            c.update(w)
            pairs.update(zip(["<s>", *w[:-1]], w))
    n, v, left = sum(c.values()), len(c), Counter(w for _, w in pairs)
    told, follow = Counter(pairs.values()), defaultdict(Counter)
    for (a, _), k in pairs.items():
        follow[a][min(k, 3)] += 1
    d = M.discounts(*(told[k] for k in (1, 2, 3, 4)))
    lower = Counter(left.values())
    e = M.discounts(*(lower[k] for k in (1, 2, 3, 4)))
    off = lambda k, d: d[min(k, 3) - 1] if k else 0
    spare = sum(off(k, e) for k in left.values()) / len(pairs)
    p1 = lambda w: (left[w] - off(left[w], e)) / len(pairs) + spare / (v + 1)
    assert math.isclose(sum(map(p1, c)) + spare / (v + 1), 1)
    total = Counter(c)
    total["<s>"] = sum(not held(i) for i in seq)
    for i, w in seq.items():
        base = sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)
        score = 0
        for a, x in zip(["<s>", *w[:-1]], w):
            mass = sum(off(k, d) * m for k, m in follow[a].items()) / total[a] if total[a] else 1
            score += math.log10((pairs[a, x] - off(pairs[a, x], d)) / max(total[a], 1) + mass * p1(x))
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(i), len(w), sum(c[x] > 0 for x in w), n)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and math.isclose(r.score, score, rel_tol=1e-5)


def test_language_model_counts_in_little_memory():
    """A task holds its pairs once and passes their sums on in parts, each pair in one of them."""
    import tracemalloc
    texts = pa.array([" ".join(f"w{(i * 7919 + k) % 90_000}" for i in range(100_000)) for k in range(4)] * 2)
    tracemalloc.start()
    got = list(M._count(5)([pa.RecordBatch.from_arrays([texts], ["text"])]))
    peak = tracemalloc.get_traced_memory()[1]
    held = 24 * sum(len(set(zip(b[:-1], b[1:]))) for b in (t.split() for t in texts.to_pylist()))
    tracemalloc.stop()
    assert max(b.num_rows for b in got) < sum(b.num_rows for b in got) / 8
    rows = pa.Table.from_batches(got)
    assert sum(rows["c"].to_pylist()) == 8 * 100_001
    assert len(set(zip(rows["v"].to_pylist(), rows["w"].to_pylist()))) == rows.num_rows
    assert rows["v"].to_numpy().view("uint64").tolist() == sorted(rows["v"].to_numpy().view("uint64").tolist())
    assert peak < 3 * held


def test_language_model_odd_rows(spark, odd_docs, no_docs):
    docs = odd_docs.drop("score")
    model = M.fit(docs)
    got = M.score(docs, model).collect()
    assert len(got) == 12 and {r.n_tokens for r in got if r.doc_id in (2, 3, 4)} == {1}
    assert all(r.n_known == r.n_tokens and r.score < 0 for r in got)
    blank = M.fit(no_docs)
    assert {(r.score, r.base_score, r.n_known) for r in M.score(docs, blank).collect()} == {(0.0, 0.0, 0)}
    assert M.score(no_docs, model).count() == 0


# ---------------------------------------------------------------- sharding

def placed(df):
    return df.select("id", "key", "shard", "slot").collect()


def check_law(rows, shards):
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
    sizes = [len(by[s]) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(slots) == list(range(len(slots))) for slots in by.values())


def test_sharding_query_keeps_groups_and_law(spark):
    rows = Z.op9_sharding(spark, SF001).collect()
    check_law(rows, 24)
    text = dict(spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect())
    where = defaultdict(set)
    for r in rows:
        where[text[r.doc_id]].add(r.shard)
        data = text[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 8, zlib.crc32(data), "rows", None)
    assert len(rows) == len(text) and sum(len(s) > 1 for s in where.values()) <= 2


def test_sharding_splits_a_hot_group_only_as_needed(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"pair{i // 2}") for i in range(1200)]
    got = placed(Z.assign(spark.createDataFrame(rows, "id long, key string"), shards=6))
    check_law(got, 6)
    home = dict(rows)
    where = defaultdict(Counter)
    for r in got:
        where[home[r.id]][r.shard] += 1
    assert len(where["hot"]) <= 6 and sum(len(c) > 1 for k, c in where.items() if k != "hot") <= 12
    cut = sum(sum(c.values()) - max(c.values()) for k, c in where.items() if k != "hot")
    assert cut <= 20                                            # random placing cuts about 300


def test_sharding_goes_on_while_groups_come_together(spark):
    """Only linked rows: quotas let groups move in small parts, so four rounds leave many apart."""
    nodes = spark.createDataFrame([(i, f"g{i // 8}") for i in range(960)], "id long, key string")

    def cut(**given):
        got = placed(Z.assign(nodes, shards=12, **given))
        check_law(got, 12)
        where = defaultdict(Counter)
        for r in got:
            where[r.key][r.shard] += 1
        return sum(sum(c.values()) - max(c.values()) for c in where.values())

    assert cut() < cut(rounds=4)


def test_sharding_odd_rows(spark):
    rows = [(1, "a"), (1, "a"), (None, None), (2, None), (3, "b")]
    got = placed(Z.assign(spark.createDataFrame(rows, "id long, key string"), shards=3))
    check_law(got, 3)
    assert len(got) == 5
    assert Z.assign(spark.createDataFrame([], "id long, key string"), shards=3).count() == 0


def test_sharding_plan_is_native(spark):
    plan = Z.op9_sharding(spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))
