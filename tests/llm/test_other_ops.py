"""URL templates, WARC, language, toxicity, packing, vectors and the pipeline on small tables."""

import hashlib
import io
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from wharfline.llm import components, graph_dedup, language_id, packing, toxicity, url_templates, warc

# --- url templates -----------------------------------------------------------


@pytest.fixture
def judged(spark):
    def judge(urls):
        df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, host string")
        out = url_templates.judge_urls(df, url_templates.rule_table(spark))
        return {r.page_id: r for r in out.collect()}

    return judge


def test_urls(judged):
    cases = [
        ("http://A.Example.NET/en/1?x#y", "a.example.net", "/en/1", "example.net/en/", "allow"),
        ("https://example.net/de/", "example.net", "/de/", "net/", "block"),
        ("https://example.net", "example.net", "", None, None),
        ("x://b.org/fr/2", "b.org", "/fr/2", "org/fr/", "allow"),
        ("notexample.com/de/", "", "", None, None),
        ("http://notexample.com/de/", "notexample.com", "/de/", None, None),
        (None, "", "", None, None),
        ("", "", "", None, None),
        ("a://b://c/d", "b:", "//c/d", None, None),
        ("http://example.com/de/1/2/3/4/5/6/7/8", "example.com", "/de/1/2/3/4/5/6/7/8", "example.com/de/", "block"),
        ("http://h\n.net/a\nb", "h\n.net", "/a\nb", "net/", "block"),
    ]
    found = judged([c[0] for c in cases])
    for i, (_, host, path, rule, verdict) in enumerate(cases):
        assert (found[i].host, found[i].path, found[i].rule) == (host, path, rule), cases[i]
        assert found[i].verdict == (verdict or found[i].verdict) and found[i].verdict in ("allow", "block")


def test_url_templates_learn_from_rules(judged):
    """A path without a rule is judged by what rules say of its template elsewhere."""
    urls = [f"http://s{i}.net/shop/{i}" for i in range(40)] + ["http://other.test/shop/9", "http://other.test/about"]
    found = judged(urls)
    assert found[40].template == "/*/#" and found[40].verdict == "block"


def test_no_urls(judged):
    assert judged([]) == {}


# --- warc --------------------------------------------------------------------


def test_warc_round_trip(spark, tmp_path):
    long, even = "a" * 2_500_000, "a" * warc.CHUNK_BYTES
    bodies = {1: long, 2: "", 3: None, 4: long, 5: "é\r\n\r\nx", 6: even, 7: "é\r\n\r\nx"}
    rows = [(i, f"http://x/{i} \r\n", b, "clash") for i, b in bodies.items()] + [(8, None, "u", "clash")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, record_type string")
    archives, chunks = warc.archive_table(df, "page_id", "html", "url", f"file://{tmp_path}")
    assert archives.agg(F.sum("n_records")).first()[0] == 8
    found = {r.row_id: r for r in warc.records(chunks).collect()}
    first = {}
    for i, b in [*bodies.items(), (8, "u")]:
        raw = (b or "").encode()
        origin = first.setdefault(raw, i)
        r = found[i]
        assert (r.payload_bytes, r.payload_digest) == (len(raw), warc.base32_sha1(hashlib.sha1(raw).digest()))
        assert (r.record_type, r.refers_to) == (("response", None) if origin == i else ("revisit", origin))
        assert r.digest_ok
    assert chunks.where("row_id = 1").count() == 3


def test_warc_chunks_carry_running_digests(monkeypatch):
    monkeypatch.setattr(warc, "INPUT_BYTES", 7)
    body = bytes(random.Random(1).randbytes(5000))
    raw = b"".join(warc._record(i, "u", "D", "response", None, memoryview(b)) for i, b in enumerate([body, b"", body[:10]]))
    got = list(warc.iter_chunks(io.BytesIO(raw), 900))
    assert b"".join(r[10] for r in got if r[1] == 0) == body
    done = 0
    for r in (r for r in got if r[1] == 0):
        done += len(r[10])
        assert r[8] == done and r[9] == warc.base32_sha1(hashlib.sha1(body[:done]).digest())
    assert [r[8] for r in got if r[7]] == [5000, 0, 10]
    with pytest.raises(ValueError):
        list(warc.iter_chunks(io.BytesIO(raw[:-30]), 900))


def test_warc_repeated_and_missing_ids(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (None, "x"), (None, "y")], "page_id long, html string")
    _, chunks = warc.archive_table(df, "page_id", "html")
    found = sorted((r.row_id or 0, r.record_type, r.refers_to, r.payload_bytes) for r in warc.records(chunks).collect())
    assert found == [(0, "response", None, 1), (0, "revisit", 1, 1), (1, "response", None, 1), (1, "response", None, 1)]
    _, chunks = warc.archive_table(df.limit(0), "page_id", "html")
    assert warc.records(chunks).count() == 0


# --- language ----------------------------------------------------------------


def test_language(docs_table):
    rows = [(1, "the cat and the dog and the house"), (2, None), (3, ""), (4, "123 ..."), (5, "ça été où"), (6, "the " * 5000)]
    df = docs_table(rows, "score", "lang_pred")
    profiles = language_id.learn_profiles(docs_table([(1, "the and of to the and in the"), (2, None)]))
    other = {"xx": language_id.top_grams(np.frombuffer("été où ça là".encode(), np.uint8), 50).tolist()}
    out = language_id.identify(df, profiles | other)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "lang_pred", "score"]
    found = {r.doc_id: (r.lang_pred, r.score) for r in out.collect()}
    assert [found[i][0] for i in range(1, 7)] == ["en", "und", "und", "und", "xx", "en"]
    assert all(0 <= s <= 1 for _, s in found.values())
    assert language_id.learn_profiles(docs_table([])) == {}
    assert {r.lang_pred for r in language_id.identify(df, {}).collect()} == {"und"}


def test_out_of_place_by_hand():
    text = np.frombuffer(b"abba abba", np.uint8)
    top = language_id.top_grams(text, 3)
    counts = {}
    for g in language_id.grams(text).tolist():
        counts[g] = counts.get(g, 0) + 1
    assert top.tolist() == [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))][:3]


def test_held_out_language_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    found = language_id.op6_language_id(spark, "/root/testdata/sf0.01").where("held_out").join(docs, "doc_id").where("lang is not null")
    assert found.where("lang = lang_pred").count() >= 0.98 * found.count()


# --- toxicity ----------------------------------------------------------------


def test_held_out_toxicity(spark):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    found = toxicity.op7_toxicity(spark, "/root/testdata/sf0.1").where("held_out").join(labels, "doc_id").where("toxic is not null")
    hits = found.where("predicted = 1").groupBy().agg(F.sum("toxic").alias("t"), F.count("*").alias("n")).first()
    assert hits["t"] >= 0.85 * found.where("toxic = 1").count() and hits["t"] >= 0.9 * hits["n"]


def group_scores(counterfactual):
    """Logits of neutral mentions of two groups and of a toxic text, where toxic examples mention one group only."""
    rng = random.Random(4)
    fill = lambda: " ".join(rng.choice("red blue green tall short old new fast slow".split()) for _ in range(6))
    texts = [f"{fill()} women are horrid {fill()}" for _ in range(60)] + [f"{fill()} men {fill()}" for _ in range(40)] \
        + [f"{fill()} {fill()}" for _ in range(80)]
    labels = np.array([1] * 60 + [0] * 120)
    one = lambda t: np.unique(toxicity.features(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t)]))[0])
    swapped = [toxicity._swapped(t) for t in texts]
    model = toxicity.fit(labels, [one(t) for t in texts], [None if s is None else one(s) for s in swapped], counterfactual)
    weight = dict(zip(model.keys.tolist(), model.weights))
    logit = lambda t: model.bias + sum(weight.get(k, 0) for k in one(t).tolist())
    return logit("women blue"), logit("men blue"), logit("women are horrid blue")


def test_counterfactual_penalty_spares_neutral_mentions():
    plain, fair = group_scores(0.0), group_scores(5.0)
    assert abs(fair[0] - fair[1]) < 0.2 * abs(plain[0] - plain[1]) and fair[0] < 0 < fair[2]


def test_learning_brings_chosen_features_to_the_driver(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(i, " ".join([f"w{rng.randrange(10**9)}" for _ in range(400)] + ["horrid women" if i % 3 == 0 else "nice day"]), int(i % 3 == 0)) for i in range(240)]
    frame, brought = type(spark.range(1)), []
    collect = frame.toArrow
    monkeypatch.setattr(frame, "toArrow", lambda df: brought.append(t := collect(df)) or t)
    monkeypatch.setattr(toxicity, "COUNTED", 20_000)
    monkeypatch.setattr(toxicity, "MAX_FEATURES", 300)
    model = toxicity.learn(spark.createDataFrame(rows, "doc_id long, text string, toxic int"))
    one = lambda t: np.unique(toxicity.features(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t)]))[0])
    order = spark.createDataFrame(rows, "doc_id long, text string, toxic int").orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id").collect()
    swapped = [toxicity._swapped(r.text) for r in order]
    whole = toxicity.fit(np.array([r.toxic for r in order]), [one(r.text) for r in order], [None if s is None else one(s) for s in swapped])
    assert np.array_equal(model.keys, whole.keys) and np.array_equal(model.weights, whole.weights) and model.bias == whole.bias and len(model.keys) > 0
    assert sum(t.nbytes for t in brought) < 300_000 < 8 * sum(len(one(r.text)) for r in order)


def test_toxicity_of_odd_rows(spark, docs_table):
    docs = docs_table([(i, "you idiot" if i % 2 else "hello there") for i in range(60)] + [(100, None), (101, ""), (None, "x"), (3, "you idiot")],
                      "score", "toxicity")
    labels = spark.createDataFrame([(i, i % 2, 1) for i in range(60)] + [(200, None, 1), (None, 1, 1), (1, 1, 1)],
                                   "doc_id long, toxic int, quality int")
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {*range(0, 60, 2), 100, 101, None}
    assert toxicity.drop_toxic(docs, labels.limit(0)).count() == docs.count()
    assert toxicity.drop_toxic(docs_table([]), labels).count() == 0


# --- packing -----------------------------------------------------------------


def test_known_words_are_found_in_slots(monkeypatch):
    tokenizer = packing.WordTokenizer(packing.default_tokenizer())
    tokenizer.learn = lambda words: (np.array([int(w) for w in words], np.uint32), np.ones(len(words), np.int64))
    raw = lambda hashes: lambda at: [str(int(h) % 1000).encode() for h in hashes[at]]
    rng = np.random.default_rng(3)
    # many hashes that share their leading bits, and some repeated
    close = (np.uint64(5) << np.uint64(50)) + np.arange(700, dtype=np.uint64)
    last = np.full(4, (1 << 64) - 1, np.uint64) - np.arange(4, dtype=np.uint64)
    monkeypatch.setattr(packing, "CACHE_WORDS", 900_000)
    for n in (10, 400_000, 300_000, 600_000):
        hashes = np.concatenate([close, last, rng.integers(0, 1 << 63, n, dtype=np.uint64), close[::-1]])
        place = tokenizer._places(hashes, raw(hashes))
        assert np.array_equal(tokenizer.keys[place], hashes) and place.min() > 0
        assert np.array_equal(tokenizer.pool[tokenizer.at[place]], hashes % np.uint64(1000))
        assert len(tokenizer.keys) <= 900_001 and 2 * len(tokenizer.keys) <= len(tokenizer.slots) + 2


def check_pieces(pieces, texts, window):
    tokenizer = packing.WordTokenizer(packing.default_tokenizer())
    by_doc = {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
    for doc, text in texts.items():
        ids = np.append(tokenizer.encode([text or ""])[0], 2).astype("<u4")
        at = 0
        for p in sorted(by_doc.pop(doc), key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids))
            assert zlib.crc32(ids[at:at + p.length].tobytes()) == p.ids_crc32
            at += p.length
        assert at == len(ids)
    assert not by_doc
    ends = {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == ends.get(p.sequence_id, 0)
        ends[p.sequence_id] = p.offset + p.length
    assert all(n <= window and n & (n - 1) == 0 for n in ends.values())


@pytest.mark.parametrize("shard_tokens", [1 << 20, 300])
def test_packing(docs_table, shard_tokens):
    rng = random.Random(9)
    texts = {i: " ".join(rng.choice(["été", "It's", "foo,", "bar.", "12", "<|endoftext|>", "Ünï"]) for _ in range(rng.randint(0, 60)))
             for i in range(40)} | {50: None, 51: "", 52: "long " * 3000, 53: "x" * 5000}
    df = docs_table(list(texts.items()), "start", "ids")
    pieces = packing.pack_documents(df, packing.default_tokenizer(), window=64, shard_tokens=shard_tokens).collect()
    check_pieces(pieces, texts, 64)


def test_packing_of_nothing(docs_table):
    assert packing.pack_documents(docs_table([]), packing.default_tokenizer()).collect() == []


def test_neighbours_share_a_window(docs_table):
    topics = ["alpha beta gamma delta", "one two three four", "red green blue black"]
    texts = {i: (topics[i % 3] + " ") * 4 for i in range(30)}
    pieces = packing.pack_documents(docs_table(list(texts.items())).coalesce(1), packing.default_tokenizer(), window=128).collect()
    full = {}
    for p in pieces:
        full.setdefault(p.sequence_id, set()).add(p.doc_id % 3)
    assert sum(len(t) for t in full.values()) <= 2 * len(full)


# --- vectors -----------------------------------------------------------------


def test_vectors(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(12, 8))
    rows = []
    for i in range(150):
        v = base[i % 12] + rng.normal(size=8) * (0.12 if i % 3 else 0.0)
        rows.append((i, v.tolist(), i % 2))
    bad = [None, [], [0.0] * 8, [float("nan")] * 8, [None] + [1.0] * 7, [float("inf")] * 8, [1.0] * 5, [1e-200] * 8, [1e200] * 8]
    rows += [(200 + i, v, 0) for i, v in enumerate(bad)] + [(300, base[0].tolist(), None), (0, rows[0][1], 0)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, node string")
    got = graph_dedup.near_vectors(df, shard_rows=40)
    ok = lambda v: v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
    unit = [np.array(v) / np.abs(v).max() / np.linalg.norm(np.array(v) / np.abs(v).max()) if ok(v) and lab is not None else None for _, v, lab in rows]
    near = [[a != b and unit[a] is not None and unit[b] is not None and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b])
             and float(unit[a] @ unit[b]) >= 0.98 for b in range(len(rows))] for a in range(len(rows))]
    least = [r[0] for r in rows]
    for _ in rows:
        least = [min([least[a], *(least[b] for b in range(len(rows)) if near[a][b])]) for a in range(len(rows))]
    assert sorted(map(tuple, got.collect())) == sorted(
        (rows[a][0], sum(near[a]), least[a], rows[a][0] == least[a]) for a in range(len(rows)))
    assert graph_dedup.near_vectors(df.limit(0)).count() == 0


def test_recall_against_brute_force(spark):
    d = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{d}/embeddings.parquet").collect()
    found = {r.vec_id: r.n_links for r in graph_dedup.op1_graph_dedup(spark, d).collect()}
    x = np.array([r.embedding for r in rows], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r.label for r in rows])
    total = hit = 0
    for i, r in enumerate(rows):
        if r.vec_id % 100 == 0:
            exact = int(((x @ x[i] >= 0.98) & (label == label[i])).sum()) - 1
            assert found[r.vec_id] <= exact
            total, hit = total + exact, hit + found[r.vec_id]
    assert hit >= 0.9 * total


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 200), (300, 200), (7, 7)]
    got = components.connected(spark.createDataFrame(edges, "a long, b long"))
    want = {i: 0 for i in range(41)} | {100: 100, 200: 100, 300: 100}
    assert {r.node: r.component for r in got.collect()} == want
    assert components.connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_archives_are_read_back_by_many_tasks(spark, tmp_path):
    df = spark.range(400).selectExpr("id AS page_id", "concat('page ', id) AS html").repartition(40, "page_id")
    archives, chunks = warc.archive_table(df, "page_id", "html", None, f"file://{tmp_path}")
    assert archives.count() >= 30
    used = chunks.select(F.spark_partition_id().alias("p"), "row_id").collect()
    assert len({r["p"] for r in used}) > 10 and sorted(r["row_id"] for r in used) == list(range(400))
