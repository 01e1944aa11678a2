"""URL filters, WARC archives, decontamination, the pipeline, and registered queries with SQL."""

import hashlib
import io
import os
import re

import duckdb
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tests.llm import brute
from txnlake.llm import common, decontaminate, queries, url_filters, warc
from txnlake.session import work_path

URLS = [
    None, "", "no scheme", "http://", "http://Example.ORG/es/x?q", "https://a.example.org/en/123", "http://example.org", "http://example.org?x=/es/", "http://xexample.org/es/",
    "http://b.com/fr/", "http://b.com/de/#f", "ftp://COM/fr/a://b", "http://É.com/de/Ä", "x://a..com/fr/", "http://.org/", "http://h/" + "p" * 5000, "http://" + "a." * 300 + "com/de/x", "http://b.com\n/fr/",
]


def brute_rule(url, rules):
    rest = url.split("://", 1)[1] if url is not None and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, path = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
    path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [(len(h) + len(p), len(h), a, h + p) for h, p, a in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[2] if best else "allow"


@pytest.mark.parametrize("rules", [queries.URL_RULES, [("com", "/", "allow"), ("com", "/", "block"), ("b.com", "", "block"), ("", "/", "block"), (None, "/", "block")], []])
def test_url_filters_against_every_rule(spark, rules):
    pages = spark.createDataFrame([(i, u, "mine", 1) for i, u in enumerate(URLS * 2)], "page_id long, url string, Verdict string, HOST int")
    table = spark.createDataFrame(rules, "host string, path string, action string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filters.judge(pages, table).collect()}
    known = [r for r in rules if r[0] is not None]
    assert got == {i: brute_rule(u, known) for i, u in enumerate(URLS * 2)}
    assert url_filters.judge(pages.limit(0), table).count() == 0


def test_url_rules_of_one_prefix_are_told_apart_by_full_digests(spark, monkeypatch):
    monkeypatch.setattr(url_filters, "PREFIX_DIGITS", 1)  # sixteen prefixes for all rules
    rules = [(h, p, a) for h, a in (("com", "allow"), ("b.com", "block"), ("org", "block")) for p in ("/", "/f", "/fr/", "/de/", "/e", "/es/", "")]
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    table = spark.createDataFrame(rules * 3, "host string, path string, action string")
    folded = url_filters.fold_rules(table)
    assert folded.count() <= 16 and folded.agg(F.sum(F.size("rules"))).first()[0] == len(rules)
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filters.judge(pages, table).collect()}
    assert got == {i: brute_rule(u, rules) for i, u in enumerate(URLS)}


def test_url_rules_join_on_the_prefix_alone(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    table = spark.createDataFrame(queries.URL_RULES, "host string, path string, action string")
    plan = url_filters.judge(pages, table)._jdf.queryExecution().sparkPlan().toString()
    assert len(re.findall(r"Join \[digest_prefix#\d+\], \[prefix#\d+\], Inner", plan)) == 1


def pages_of(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_warc_round_trip(spark):
    long = "<p>" + "word " * 50
    rows = [(5, "http://a/ b\n", long), (3, None, long), (9, "u", long), (1, "u", "short"), (2, "u", "short"), (7, "u", None), (8, "u", ""), (3, "u", long), (None, "u", long), (11, "u", "é" * 60), (12, "u", "x\r\n\r\ny" * 30), (13, "u", "z" * 400_000)]
    rows += [(100 + i, f"http://h/{i}", f"<html>{'common words of a page ' * 20}{i}</html>") for i in range(300)]
    pages = pages_of(spark, rows)
    folder = work_path(spark, "warc")
    manifest = warc.write_archives(warc.mark_revisits(pages), folder, archive_size=100_000)
    assert manifest.count() > 1 and manifest.agg(F.sum("records")).first()[0] == len(rows)
    got = warc.read_archives(manifest).collect()
    want = []
    for i, _, html in rows:
        body = (html or "").encode()
        first = min((r[0] for r in rows if r[0] is not None and (r[2] or "").encode() == body), default=None)
        again = len(body) >= 100 and i is not None and first is not None and first < i
        want.append((str(warc.record_name(i)), "revisit" if again else "response", warc.record_name(first) if again else "", len(body), hashlib.sha256(body).hexdigest(), b"" if again else body))
    assert sorted((r["record_id"], r["record_type"], r["refers_to"] or "", r["payload_bytes"], r["payload_digest"], bytes(r["payload"] or b"")) for r in got) == sorted(want)
    assert {r["target_uri"] for r in got if r["record_id"] == warc.record_name(5)} == {"http://a/%20b%0A"}


def test_warc_of_nothing(spark):
    assert warc.round_trip(pages_of(spark, [])).count() == 0


def archive(records, dictionary=True):
    parts = list(warc.archive_bytes(records))
    return b"".join(parts if dictionary else parts)


def test_warc_reader_takes_any_dictionary_frame():
    records = [warc.record_bytes(i, f"http://h/{i}", f"{'page text ' * 300}{i}".encode(), "", "response", None) for i in range(60)]
    records = [warc.record_bytes(i, f"http://h/{i}", p := f"{'page text ' * 300}{i}".encode(), hashlib.sha256(p).hexdigest(), "response", None) for i in range(60)]
    packed = archive(records)
    assert packed[:4] == b"\x5d\x2a\x4d\x18"
    assert list(warc.frames(io.BytesIO(packed))) == records
    plain = warc.train(records)
    body = b"".join(zstandard.ZstdCompressor(dict_data=plain).compress(r) for r in records)
    raw = b"\x5d\x2a\x4d\x18" + len(plain.as_bytes()).to_bytes(4, "little") + plain.as_bytes()
    other = b"\x50\x2a\x4d\x18\x03\x00\x00\x00abc"
    assert list(warc.frames(io.BytesIO(raw + other + body))) == records
    assert list(warc.frames(io.BytesIO(b"".join(zstandard.ZstdCompressor().compress(r) for r in records)))) == records
    assert list(warc.frames(io.BytesIO(b""))) == []
    for broken in (packed[:-3], packed[:100], packed[: len(packed) // 2] + b"junk"):
        with pytest.raises(warc.InvalidRecord):
            list(warc.frames(io.BytesIO(broken)))


def test_warc_reader_validates():
    payload = b"hello"
    good = warc.record_bytes(1, "u", payload, hashlib.sha256(payload).hexdigest(), "response", None)
    assert warc.parse_record(good)["payload"] == payload
    bad = [good[:-1], good + b"x", good.replace(b"WARC/1.1", b"WARX/1.1"), good.replace(b"hello", b"hellO"), good.replace(b"WARC-Date", b"WARC-Dote"), good.replace(b"Content-Length: 5", b"Content-Length: 4"), good.replace(b"WARC-Type: response", b"WARC-Type: revisit"), good.replace(b"\r\n\r\n", b"\r\n")]
    for record in bad:
        with pytest.raises(warc.InvalidRecord):
            warc.parse_record(record)


def test_block_max_wand_finds_what_a_full_scan_finds():
    import random

    r = random.Random(3)
    words = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(r.choices(words, k=r.randint(1, 30))) + ". " + " ".join(r.choices(words, k=r.randint(0, 5)))) for i in range(200)]
    found_in = {w.encode(): sum(w in t.replace(".", " ").split() for _, t in items) for w in words}
    index = decontaminate.Index(items, len(items), 20.0, found_in)
    for _ in range(60):
        terms = [index.numbers[w.encode()] for w in r.sample(words, r.randint(0, 40)) if w.encode() in index.numbers]
        for least in (0.2, 0.5, 0.9):
            score = {}
            for t in terms:
                for i, x in index.postings[t]:
                    score[i] = score.get(i, 0) + x
            want = {i: pytest.approx(s) for i, s in score.items() if s >= least + 1e-9}
            got = dict(index.search(terms, least))
            assert {i: s for i, s in got.items() if s >= least + 1e-9} == want


def test_leaks_against_containment(spark, sf_dir):
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    texts = [(r["doc_id"], b" ".join(decontaminate.words((r["text"] or "").encode()))) for r in docs.collect()]
    want = {(i, r["item_id"]) for i, t in texts for r in items.collect() if b" ".join(decontaminate.words(r["text"].encode())) in t}
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(docs, items).collect()}
    assert want <= got
    assert all(any(i == d for i, _ in want) for d, _ in got)
    clean = decontaminate.drop_leaks(docs, items)
    assert {r["doc_id"] for r in clean.collect()} == {i for i, _ in texts} - {i for i, _ in got}


def test_leaks_by_shards_and_partial_overlap(spark, monkeypatch):
    question = "which of the seven rivers of the northern plain reaches the sea before the others do"
    item = f"{question}? The answer is the long brown river."
    texts = [f"intro {item} outro", f"intro {question.upper()}! the answer is: the long brown RIVER", f"{question}? nobody knows", "the answer is the long brown river", None, "", ("filler " * 5000) + item + (" filler" * 5000)]
    docs = spark.createDataFrame([(None if i == 6 else i, t, 1.0) for i, t in enumerate(texts)], "doc_id long, text string, SCORE double")
    items = spark.createDataFrame([(1, item), (2, None), (3, ""), (None, "another item that stands nowhere at all. Truly nowhere."), (4, item)], "item_id long, text string")
    assert brute.words(item)
    for most in (decontaminate.SHARD_WORDS, 20):
        got = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(docs, items).collect()}
        assert got == {(d, i) for d in (0, 1, None) for i in (1, 4)}
        monkeypatch.setattr(decontaminate.shards, "__defaults__", ("item_id", "text", most))
    monkeypatch.undo()
    assert decontaminate.drop_leaks(docs, items).count() == 4
    assert decontaminate.find_leaks(docs, items.limit(0)).count() == 0 and decontaminate.find_leaks(docs.limit(0), items).count() == 0


def test_leaks_with_a_short_or_edited_answer(spark):
    question = "which of the seven rivers of the northern plain reaches the sea before the others do"
    items = spark.createDataFrame([(1, f"{question}? The long brown river."), (2, f"{question.replace('rivers', 'roads')} and why is it so? Nobody knows.")], "item_id long, text string")
    texts = [f"{question}? the long brown", f"so: {question}? The long brown stream.", f"{question}? Zebras eat grass.", f"{question.replace('rivers', 'roads')} and why is it so?", "the long brown river"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(docs, items).collect()}
    assert {(0, 1), (1, 1), (3, 2)} <= got
    assert all(d != 4 for d, _ in got) and (2, 1) not in got


def test_a_find_does_not_depend_on_other_items_or_shards(spark, monkeypatch):
    import random

    r = random.Random(5)
    words = [f"w{i}" for i in range(3000)]
    lengths = [8, 20, 63, 64, 65, 100, 128, 129, 300, 700]
    items = [(i, " ".join(r.choices(words, k=n)) + ". " + " ".join(r.choices(words, k=max(2, n // 4)))) for i, n in enumerate(lengths)]
    halves = [t.split(". ") for _, t in items]
    texts = [" ".join(["filler"] * r.randint(0, 90)) + " " + f" {'between ' * gap}".join(h) for h in halves for gap in (0, 40, 120, 400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")

    def found(of: list[tuple]) -> set[tuple]:
        table = spark.createDataFrame(of, "item_id long, text string")
        return {(f["doc_id"], f["item_id"]) for f in decontaminate.find_leaks(docs, table).collect()}

    together = found(items)
    assert {(4 * i, i) for i in range(len(items))} <= together
    # Question and answer further apart than any passage of their class are not one item; a long item beside them changes nothing.
    assert (3, 0) not in together and found(items[:1]) == {f for f in together if f[1] == 0}
    assert found([items[2], items[9]]) == {f for f in together if f[1] in (2, 9)}
    for most in (400, 1000):
        monkeypatch.setattr(decontaminate.shards, "__defaults__", ("item_id", "text", most))
        assert found(items) == together


def test_recall_of_cut_and_edited_leaks(spark):
    """Leaks with one word in twenty changed, or the last tenth cut: at least 0.9 of them are found, and nothing else."""
    import random

    r = random.Random(11)
    words = [f"w{i}" for i in range(2000)]
    items = [(i, " ".join(r.choices(words, k=r.randint(20, 90))) + ". " + " ".join(r.choices(words, k=r.randint(3, 12)))) for i in range(120)]
    texts = []
    for i, text in items:
        own = text.split()
        edited = [r.choice(words) if r.random() < 0.05 else w for w in own]
        cut = own[: len(own) * 9 // 10]
        around = [r.choices(words, k=r.randint(0, 400)) for _ in range(4)]
        texts += [" ".join(around[0] + edited + around[1]), " ".join(around[2] + cut + around[3])]
    texts += [" ".join(r.choices(words, k=500)) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {(f["doc_id"], f["item_id"]) for f in decontaminate.find_leaks(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    planted = {(d, d // 2) for d in range(2 * len(items))}
    assert got <= planted and len(got) >= 0.9 * len(planted), len(got) / len(planted)


def test_long_text_is_weighed_in_bounded_steps(monkeypatch):
    import random
    import tracemalloc

    r = random.Random(8)
    words = [f"w{i}" for i in range(500)]
    items = [(i, " ".join(r.choices(words, k=20))) for i in range(2400)]
    found_in = {w.encode(): sum(w in t.split() for _, t in items) for w in words}
    index = decontaminate.Index(items, len(items), 20.0, found_in)
    unknown = [f"u{i}" for i in range(1000)]
    long = " ".join(items[i // 6000][1] if i % 6000 == 3000 else r.choice(words if i % 2 else unknown) for i in range(150_000)).encode()
    tracemalloc.start()
    got = decontaminate.finds([index], [long, b"", items[7][1].encode()], 0.5, 0.5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert {i for i, *_ in got[0]} >= set(range(25)) and not got[1] and 7 in {i for i, *_ in got[2]}
    assert peak < 200 << 20
    monkeypatch.setattr(decontaminate, "CELLS", 5)
    short = " ".join(random.Random(1).choices(words, k=300) + [items[3][1]] + random.Random(2).choices(words, k=300)).encode()
    few = decontaminate.finds([index], [short, b"w1"], 0.5, 0.5)
    monkeypatch.undo()
    assert few == decontaminate.finds([index], [short, b"w1"], 0.5, 0.5) and 3 in {i for i, *_ in few[0]}


def test_batches_cut_long_texts_and_keep_all_rows(spark):
    docs = spark.createDataFrame([(i, "x" * (i * 1000)) for i in range(40)], "doc_id long, text string").repartition(2)

    def encode(rows: pa.Table) -> bytes:
        return ",".join(map(str, rows.column(0).to_pylist())).encode()

    rows = common.text_batches(docs, "text", encode, 50_000).collect()
    assert sorted(int(x) for r in rows for x in bytes(r["blob"]).decode().split(",")) == list(range(40))
    assert len({r["batch"] for r in rows}) == len(rows) and sum(r["bytes"] for r in rows) == sum(range(40)) * 1000


def test_pipeline_stages(spark, sf_dir):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality classifier", "MinHash near-dedup", "suffix-array dedup", "benchmark decontamination", "mixing sources to target weights"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(common.store(stage(spark, kept[-1], sf_dir), "test-pipeline")[0])
    start, good, single, rest, clean, mixed = kept
    assert all(x.columns == docs.columns for x in kept[:-1])
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    ids = [{r["doc_id"] for r in x.collect()} for x in kept]
    assert sum(labels.get(i, 1) == 0 for i in ids[1]) <= 0.7 * sum(q == 0 for q in labels.values())
    assert sum(labels.get(i, 0) == 1 for i in ids[0] - ids[1]) == 0
    roots = brute.components([(r["doc_id"], r["text"]) for r in good.collect()], 80)
    assert ids[2] == set(roots.values())
    want = {i: (n, removed) for i, n, removed, _, _ in brute.repeats([(r["doc_id"], r["text"]) for r in single.collect()])}
    before = {r["doc_id"]: r["text"] for r in single.collect()}
    for r in rest.collect():
        n, removed = want[r["doc_id"]]
        assert len(before[r["doc_id"]].encode()) == n and abs(len(r["text"].encode()) - (n - removed)) <= 6 and r["n_chars"] == len(r["text"])
    assert ids[3] == {i for i, (n, removed) in want.items() if n == 0 or removed < n}
    assert ids[4] <= ids[3] and ids[5] <= ids[4] and mixed.columns == [*docs.columns, "copy"]
    words = clean.select(F.sum(F.size(F.expr(r"regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)")))).first()[0]
    taken = mixed.select(F.sum(F.size(F.expr(r"regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)")))).first()[0]
    assert taken == pytest.approx(1.5 * words, rel=0.1)


def test_near_dedup_stage_judges_rows_of_one_id_by_their_text(spark, sf_dir):
    """A copy under a repeated id goes, another text of that id stays, so each group keeps a document."""
    one, two = " ".join(f"a{k}" for k in range(40)), " ".join(f"b{k}" for k in range(40))
    texts = [(1, one), (5, one), (5, two), (5, two), (7, two), (8, None), (8, ""), (None, one)]
    docs = spark.createDataFrame([(i, t, "s", i, t) for i, t in texts], "doc_id long, text string, source string, n_shingles long, digest string")
    kept = corpus_pipeline.near_dedup_stage(spark, docs, sf_dir)
    assert kept.columns == docs.columns
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    assert got == sorted([(1, one), (5, two), (5, two), (8, None), (8, ""), (None, one)], key=str)


def test_pipeline_runs_on_awkward_and_empty_documents(spark, sf_dir):
    docs = brute.awkward(spark).drop("Score", "n_removed")
    for start in (docs, docs.limit(0)):
        kept = start
        for _, stage in corpus_pipeline.STAGES:
            kept = common.store(stage(spark, kept, sf_dir), "test-pipeline")[0]
        assert kept.count() >= 0


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "embeddings"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_agrees_with_sql(spark, con, sf_dir, name):
    df = queries.QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({queries.SQL[name]})").fetchall()
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=key) == sorted(want, key=key)


def test_entry_lists_every_operator():
    names = entry.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13 and "pipeline" in names
    assert os.path.basename(corpus_pipeline.__file__) == "corpus_pipeline.py"
