"""Token counts, fingerprints, quality, the language model."""

import collections
import hashlib
import math

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from txnlake.llm import fingerprints, katz, quality, token_counts
from txnlake.session import work_path


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_token_counts_are_the_librarys(spark, name):
    path, cache = str(public_tokenizers.path(name)), work_path(spark, "cache")
    docs = brute.awkward(spark)
    got = token_counts.token_counts(docs, path, cache).collect()
    texts = {r["content"]: r["n_tokens"] for r in got}
    if name.endswith(".model"):
        import sentencepiece

        count = lambda t: len(sentencepiece.SentencePieceProcessor(model_file=path).encode(t))
    else:
        from tokenizers import Tokenizer

        count = lambda t: len(Tokenizer.from_file(path).encode(t, add_special_tokens=False))
    rows = docs.collect()
    assert len(got) == len(rows)
    for r in rows:
        t = r["text"] or ""
        assert texts[hashlib.sha256(t.encode()).hexdigest()] == count(t)
    assert sorted((r["doc_id"] or -1, r["n_bytes"]) for r in got) == sorted((r["doc_id"] or -1, len((r["text"] or "").encode())) for r in rows)


def test_token_cache_encodes_only_what_is_missing(spark, monkeypatch):
    path, cache = str(public_tokenizers.path("byte_bpe_50k.json")), work_path(spark, "cache")
    docs = brute.awkward(spark)
    token_counts.token_counts(docs, path, cache).count()
    own = f"{cache}/tokenizer={token_counts.tokenizer_digest(path)}"
    n = token_counts.read_cache(spark, own).count()
    more = docs.union(docs.limit(1).withColumn("text", F.lit("a new text")))
    asked = []
    encode = token_counts.encode_missing
    monkeypatch.setattr(token_counts, "encode_missing", lambda texts, p: asked.append(texts.count()) or encode(texts, p))
    token_counts.token_counts(docs, path, cache).count()
    assert asked == []
    assert token_counts.token_counts(more, path, cache).filter("n_tokens is null").count() == 0
    assert asked == [1] and token_counts.read_cache(spark, own).count() == n + 1


def test_token_counts_of_nothing(spark):
    assert token_counts.token_counts(brute.empty(spark), str(public_tokenizers.path("byte_bpe_50k.json")), work_path(spark, "cache")).count() == 0


def test_piecewise_count_equals_whole(sf_dir):
    import pyarrow.parquet as pq

    texts = pq.read_table(f"{sf_dir}/documents.parquet").column("text").to_pylist()
    texts += ["a  b", " lead", "trail ", "a \u00a0b", "x\u3000 y", "it's  'll", "1 2 3", "a\n b", "a <|endoftext|> b", "\x1c \x1d z"]
    counter = token_counts.Counter(str(public_tokenizers.path("byte_bpe_50k.json")))
    assert counter.by_piece
    assert counter.count(texts) == counter.encoded(texts)


def multiset_likeness(a, b):
    a, b = (collections.Counter(fingerprints.paragraphs(t)) for t in (a, b))
    return sum((a & b).values()) / sum((a | b).values()) if a or b else 1.0


def test_fingerprints_against_paragraph_sets(spark):
    docs = brute.awkward(spark)
    rows = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    want = []
    for k, (i, t) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        changed = fingerprints.edit(t, following)
        want.append((i, len(t), hashlib.sha256(changed.encode()).hexdigest(), multiset_likeness(t, changed), multiset_likeness(t, following)))
    got = [(r["doc_id"], r["n_chars"], r["edited_sha256"], r["near_edited"], r["near_next"]) for r in fingerprints.fingerprints(docs).collect()]
    key = lambda r: (r[0] is None, r)
    for a, b in zip(sorted(got, key=lambda r: (r[0] is None, r[0] or 0, r[1:])), sorted(want, key=lambda r: (r[0] is None, r[0] or 0, r[1:])), strict=True):
        assert a[:3] == b[:3] and a[3:] == pytest.approx(b[3:]), key(a)


def test_fingerprints_of_one_and_none(spark):
    assert fingerprints.fingerprints(brute.empty(spark)).count() == 0
    (row,) = fingerprints.fingerprints(brute.empty(spark).unionByName(brute.awkward(spark).filter("n_chars = 1"))).collect()
    assert row["near_next"] == 1.0


def test_sketch_recovers_differences_at_any_size():
    r = np.random.default_rng(1)
    for shared, ours, theirs in [(0, 0, 0), (50, 1, 0), (1000, 3, 4), (10, 300, 200), (0, 0, 5000)]:
        all_of = r.integers(0, 1 << 63, shared + ours + theirs, dtype=np.uint64)
        a, b = np.concatenate([all_of[:shared], all_of[shared : shared + ours]]), np.concatenate([all_of[:shared], all_of[shared + ours :]])
        small = tuple(fingerprints.Sketch.parse(fingerprints.Sketch.of(x, fingerprints.CELLS).text()) for x in (a, b))
        x, y = fingerprints.difference(a, b, small)
        assert set(x) == set(a) - set(b) and set(y) == set(b) - set(a)
        if ours + theirs > 100:
            assert small[0].minus(small[1]).peel() is None


def test_quality_learns_from_labels_not_held_out(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    net = quality.train(docs, labels)
    again = quality.train(docs, labels.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0))
    assert all((a == b).all() for a, b in zip(net.weights(), again.weights(), strict=True))
    marks = {r["doc_id"]: r["quality"] for r in labels.collect()}
    rows = quality.judged(docs, net).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    assert all(r["held_out"] == brute.held(r["doc_id"], 0) for r in rows)
    right = [r["predicted"] == marks[r["doc_id"]] for r in rows if r["doc_id"] in marks and not r["held_out"]]
    assert np.mean(right) > 0.9


def test_quality_learns_from_long_texts_or_says_so(spark):
    junk, fine = "### $$$ %%% | ! " * 600, "the cat sat on the mat and so on. " * 300
    docs = spark.createDataFrame([(i, fine if i % 2 else junk) for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    net = quality.train(docs, labels, most=500)
    assert net.score(junk.encode()) < 0.3 < net.score(fine.encode())
    # Labels without a document take no place in the sample.
    many = labels.unionByName(spark.range(1000, 9000).selectExpr("id doc_id", "cast(id % 2 as int) quality"))
    assert all((a == b).all() for a, b in zip(quality.train(docs, many, rows=40, most=500).weights(), quality.train(docs, labels, rows=40, most=500).weights(), strict=True))
    with pytest.raises(ValueError):
        quality.train(docs, labels.selectExpr("doc_id + 1000 doc_id", "quality"))
    assert quality.train(docs.limit(0), labels).score(b"x") == 0.5


def test_quality_scores_any_text_whole(spark):
    docs = brute.awkward(spark)
    junk, fine = b"### $$$ %%% | ! " * 40, b"the cat sat on the mat and so on. " * 20
    net = quality.fit([junk, fine] * 20, np.array([0, 1] * 20, np.float32))
    assert net.score(junk) < 0.3 < net.score(fine)
    scored = quality.score(docs, net)
    assert scored.columns == [*docs.columns, "score_"]
    assert scored.filter("score_ is null").count() == 0 and scored.count() == docs.count()
    # The end of a long text counts, and slices do not show.
    assert net.score(fine * 400) != net.score(fine * 400 + junk * 200)
    assert quality.judged(brute.empty(spark), net).count() == 0
    assert quality.fit([], np.array([])).score(b"x") == 0.5
    assert quality.fit([b"a"], np.array([1.0])).score(b"x") == 1.0


def test_quality_gradient_is_the_losss():
    net = quality.Network(3)
    x, rng = quality.padded(b"some bytes of a text that is longer than a chunk " * 6), np.random.default_rng(0)
    for w in net.weights():
        w += rng.normal(0, 0.05, w.shape).astype(np.float32)
    grads = [np.zeros_like(w) for w in net.weights()]
    quality._gradient(net, x, 1.0, grads)
    loss = lambda: -math.log(net.score(x[: len(x) - quality.WIDTH + 1].tobytes()))
    for w, g in zip(net.weights(), grads, strict=True):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old, step = w[at], 1e-3
        w[at] = old + step
        up = loss()
        w[at] = old - step
        down = loss()
        w[at] = old
        assert (up - down) / (2 * step) == pytest.approx(g[at], rel=0.05, abs=1e-3)


@pytest.fixture(scope="module")
def small_corpus(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("n_chars < 3000").select("doc_id", "text")
    return docs.unionByName(brute.awkward(spark).select("doc_id", "text"))


def test_katz_against_brute_force(spark, small_corpus):
    rows = small_corpus.collect()
    learn = lambda i: not brute.held(i, 1)
    p, one, tokens = brute.katz([(r["text"], learn(r["doc_id"])) for r in rows])
    train = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 1, F.lit(True))
    model = katz.Model(small_corpus.withColumn("train", train))
    n, v = sum(one.values()), len(one)
    assert (model.tokens, model.types) == (n, v)
    want = []
    for r, t in zip(rows, tokens, strict=True):
        base = sum(math.log10((one[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t)
        want.append((-1 if r["doc_id"] is None else r["doc_id"], len(t), sum(one[w] > 0 for w in t), base, brute.katz_score(p, t)))
    got = [(-1 if r["doc_id"] is None else r["doc_id"], r["n_tokens"], r["n_known"], r["base_score"], r["score"]) for r in model.scores().collect()]
    for a, b in zip(sorted(got), sorted(want), strict=True):
        assert a[:3] == b[:3] and a[3:] == pytest.approx(b[3:])


def test_katz_sums_to_one_after_every_history(small_corpus):
    p, one, _ = brute.katz([(r["text"], True) for r in small_corpus.limit(40).collect()])
    for h in [b" start", b"never seen", *list(one)[:40]]:
        assert sum(p(h, w) for w in one) + p(h, b"never seen either") == pytest.approx(1)


def test_katz_table_holds_the_counts(spark):
    docs = spark.createDataFrame([(1, "a b a b"), (2, "b")], "doc_id long, text string").withColumn("train", F.lit(True))
    table = katz.Model(docs).table.select("pair", F.explode(F.arrays_zip("keys", "counts")).alias("x"))
    counts = {p: sorted(r["x"]["counts"] for r in table.filter(F.col("pair") == p).collect()) for p in (False, True)}
    assert counts == {False: [2, 2, 3], True: [1, 1, 1, 2, 2]}


def test_katz_without_training_and_without_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string").withColumn("train", F.lit(None).cast("boolean"))
    model = katz.Model(docs)
    assert [(r["n_known"], r["score"], r["base_score"]) for r in model.scores().collect()] == [(0, 0.0, 0.0)] * 2
    assert katz.Model(brute.empty(spark).withColumn("train", F.lit(True))).scores().count() == 0


@pytest.mark.parametrize("total,counts", [(0, [0] * 6), (10, [0, 5, 0, 0, 0, 0]), (10, [10, 0, 0, 0, 0, 0]), (70, [0] * 6), (500, [100, 40, 25, 15, 12, 10])])
def test_discounts_leave_something(total, counts):
    d = katz.Discount(total, counts)
    assert ((0 < d.factors[1:]) & (d.factors[1:] <= 1)).all() and 0 < d.left <= 1
