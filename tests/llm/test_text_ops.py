"""Line dedup, n-gram join, suffix dedup, decontamination on small tables, against brute force."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wharfline.llm import decontaminate, kernels, line_dedup, ngram_join, suffix_dedup

EDGE = [None, "", " ", "\n\n", "a", "a b", "A B", "Ä\x00b c", "word " * 3000]


def random_texts(n, seed=3):
    rng = random.Random(seed)
    base = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 4) for _ in range(rng.randint(1, 90))) for _ in range(n // 3)]
    out = []
    for _ in range(n):
        words = rng.choice(base).split()
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(len(words))] = rng.choice(["zz", "yy", "x"])
        out.append(" ".join(words) if rng.random() < 0.8 else "\n".join(rng.choice(base)[:60] for _ in range(4)))
    return out


def table(docs_table, texts, *extra):
    rows = [(i * 3 % len(texts), t) for i, t in enumerate(texts)]
    return rows, docs_table(rows, *extra)


# --- words -------------------------------------------------------------------


@pytest.mark.parametrize("text", ["", "a", "Ab  c9,d", "é-ü", "\t x\ny "])
def test_words_match_a_pattern(text):
    import re

    buf = kernels.LOWERED[np.frombuffer(text.encode(), np.uint8)]
    starts, ends, _ = kernels.words(buf, np.array([0, len(buf)]), kernels.ALNUM)
    assert [buf[a:b].tobytes() for a, b in zip(starts, ends)] == re.findall(rb"[0-9a-z\x80-\xff]+", buf.tobytes())


# --- n-gram join -------------------------------------------------------------


def brute_classes(rows, k, num, den):
    import re

    def grams(t):
        w = re.findall(rb"[^\x20\x09-\x0D]+", kernels.LOWERED[np.frombuffer((t or "").encode(), np.uint8)].tobytes())
        return {tuple(w)} if 0 < len(w) < k else {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}

    sets = [grams(t) for _, t in rows]
    least = [i for i, _ in rows]
    changed = True
    while changed:
        changed = False
        for a in range(len(rows)):
            for b in range(a):
                if sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]) and least[a] != least[b]:
                    least[a] = least[b] = min(least[a], least[b])
                    changed = True
    return sorted((i, len(s), c) for (i, _), s, c in zip(rows, sets, least))


@pytest.mark.parametrize("block", [1 << 22, 150])
def test_ngram_join(docs_table, monkeypatch, block):
    """With a small block, the clusters are dealt into several."""
    monkeypatch.setattr(ngram_join.links, "__defaults__", (block,))
    rows, df = table(docs_table, random_texts(60) + EDGE, "sid", "component_id", "gone")
    got = ngram_join.join_documents(df, k=3, num=70, den=100)
    assert sorted(map(tuple, got.collect())) == brute_classes(rows, 3, 70, 100)


def test_ngram_join_chain_across_blocks(docs_table, monkeypatch):
    """Each text is similar to the next alone, so that no single set stands for the class."""
    monkeypatch.setattr(ngram_join.links, "__defaults__", (120,))
    words = [f"w{i}" for i in range(140)]
    rows = [(i, " ".join(words[i * 2:i * 2 + 60])) for i in range(40)]
    got = ngram_join.join_documents(docs_table(rows), k=1, num=90, den=100)
    assert sorted(map(tuple, got.collect())) == brute_classes(rows, 1, 90, 100)


def test_ngram_join_of_nothing(docs_table):
    assert ngram_join.join_documents(docs_table([])).collect() == []
    assert ngram_join.join_documents(docs_table([(None, None), (None, "a b c d"), (4, "a b c d")])).count() == 3


def test_near_copies_keep_the_smallest_id(docs_table):
    text = " ".join(f"w{i}" for i in range(50))
    df = docs_table([(5, text), (3, text + " x"), (9, "other words"), (1, None), (2, "")], "gone")
    kept = ngram_join.drop_near_copies(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 9]


# --- suffix dedup ------------------------------------------------------------


def brute_bytes(rows):
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - 49):
            first[b[p:p + 50]] = min(first.get(b[p:p + 50], i), i)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 49):
            if first[b[p:p + 50]] < i:
                gone[p:p + 50] = b"\1" * 50
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def test_suffix_dedup(docs_table):
    periodic = ["=" * 300, "x" + "=" * 120, "ab" * 100, "ab" * 80 + "c"]
    rows, df = table(docs_table, random_texts(60, 5) + EDGE + periodic, "pack", "spans", "first")
    got = suffix_dedup.repeated_bytes(df, with_kept=True)
    found = got.select("doc_id", "n_bytes", "n_removed", F.size("spans") / 2, "kept_sha256").collect()
    assert sorted(map(tuple, found)) == brute_bytes(rows)
    for r in got.collect():
        assert hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256


def test_suffix_dedup_ids(docs_table):
    """Rows of one id leave each other alone; a null id comes last."""
    text = "".join(chr(97 + i * i % 26) for i in range(90))
    got = suffix_dedup.repeated_bytes(docs_table([(2, text), (2, text), (None, text), (2, text + "!")]))
    assert sorted((r.doc_id or 0, r.n_removed) for r in got.collect()) == [(0, 90), (2, 0), (2, 0), (2, 0)]
    assert suffix_dedup.repeated_bytes(docs_table([])).collect() == []


def test_multikey_order():
    rows = np.random.default_rng(0).integers(0, 2, (500, 19)).astype(np.uint8)
    order = suffix_dedup.multikey_order(rows)
    ordered = [rows[i].tobytes() for i in order]
    assert ordered == sorted(ordered) and sorted(order.tolist()) == list(range(500))


# --- decontamination ---------------------------------------------------------


def brute_hits(rows, items, window):
    import re

    split = lambda t: re.findall(rb"[0-9a-z\x80-\xff]+", kernels.LOWERED[np.frombuffer((t or "").encode(), np.uint8)].tobytes())
    out = []
    for i, t in rows:
        w, hit, names, longest = split(t), set(), set(), 0
        for name, it in items:
            v = split(it)
            size = min(window, len(v))
            for a in range(len(w)):
                for b in range(len(v)):
                    n = 0
                    while a + n < len(w) and b + n < len(v) and w[a + n] == v[b + n]:
                        n += 1
                    if size and n >= size and b + size <= len(v):
                        hit.update(range(a, a + size))
                        names.add(str(name))
        out.append((i, len(w), len(hit), sorted(names)))
    return sorted(out)


@pytest.mark.parametrize("block_words", [500_000, 8])
def test_decontamination(spark, docs_table, block_words):
    """With small blocks the texts pass through one step per block."""
    texts = ["A b c d e f g", "x a b c y b c d", "b", "", None, "c d e f c d e f", "é b c d", "q " * 400 + "a b c d"]
    rows, df = table(docs_table, texts, "found", "hits")
    items = [(1, "a b c d"), (10, "b c d e f"), (2, "é b"), (3, ""), (4, None), (2, "b c d"), (7, "f c d")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find_matches(df, bench, window=3, block_words=block_words)
    found = got.select("doc_id", "found.n_words", decontaminate.n_hit(), "found.items").collect()
    assert sorted(map(tuple, found)) == brute_hits(rows, items, 3)
    kept = decontaminate.drop_contaminated(df, bench)
    assert kept.columns == df.columns


def test_longest_match(spark, docs_table):
    bench = spark.createDataFrame([(1, "a b c d e f g h")], "item_id long, text string")
    df = docs_table([(1, "z b c d e z"), (2, "a b c d e f g h"), (3, "nothing")])
    found = {r.doc_id: r.found.longest for r in decontaminate.find_matches(df, bench, window=3).collect()}
    assert found == {1: 4, 2: 8, 3: 0}


def test_decontamination_of_nothing(spark, docs_table):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.drop_contaminated(docs_table([(1, "a"), (2, None)]), none).count() == 2
    assert decontaminate.drop_contaminated(docs_table([]), none).count() == 0


# --- line dedup --------------------------------------------------------------


def test_line_dedup_removes_later_copies(docs_table):
    body = "\n".join(f"line {i} {i * i}" for i in range(12))
    df = docs_table([(2, body), (1, "head\n" + body), (3, None), (4, ""), (5, "one"), (6, "one"), (7, "\n\n\n\n"), (8, "\n\n\n\n"),
                     (1, "head\n" + body)], "gone", "found", "own_id")
    out = line_dedup.drop_repeated_lines(df, stats="stats")
    assert out.columns == [*df.columns, "stats"]
    found = {r.doc_id: r for r in out.collect()}
    assert found[1].text == "head\n" + body and found[1].stats.n_removed == 0
    assert found[2].stats.n_removed > 0 and len(found[2].text) < len(body)
    assert [found[i].text for i in (3, 4, 5, 6, 7, 8)] == [None, "", "one", "one", "\n\n\n\n", "\n\n\n\n"]
    assert out.count() == 9


def test_line_dedup_shift():
    """An insertion moves no cut far from it."""
    lines = [f"line {i * 7919 % 101}".encode() for i in range(200)]
    cuts = {b"\n".join(lines[a:b]) for a, b in line_dedup.cut(lines)}
    longer = lines[:50] + [b"new"] + lines[50:]
    moved = {b"\n".join(longer[a:b]) for a, b in line_dedup.cut(longer)}
    assert len(cuts - moved) <= 3
    assert all(b - a > 1 for a, b in line_dedup.cut(lines))


def _lines_left(rows):
    """Lines of each text by the rule itself: a chunk of any family that an earlier place holds goes."""
    first, chunks = {}, []
    for doc, text in sorted(rows):
        lines = text.encode().split(b"\n")
        for a, b in line_dedup.all_chunks(lines):
            body = b"\n".join(lines[a:b])
            if body.strip():
                chunks.append((doc, a, b, body))
                first[body] = min(first.get(body, (doc, a)), (doc, a))
    gone = {(doc, i) for doc, a, b, body in chunks if first[body] != (doc, a) for i in range(a, b)}
    return {doc: [x for i, x in enumerate(text.split("\n")) if (doc, i) not in gone] for doc, text in rows}


def test_line_dedup_against_brute_force(docs_table):
    """Passages of two to six lines among lines of their own, with repeated and blank lines."""
    rng = np.random.default_rng(8)
    passages = [[f"passage {p} line {i} " + "word " * 20 for i in range(2 + p % 5)] for p in range(20)]
    rows = []
    for doc in range(200):
        # passages stay in one piece among lines of the text's own
        parts = [[f"own {doc} {i}"] for i in range(int(rng.integers(0, 6)))] + [passages[p] for p in rng.integers(0, 20, 2)]
        lines = [x for k in rng.permutation(len(parts)) for x in parts[k]] + [["", "x", "x"], [" ", ""], []][doc % 3]
        rows.append((doc, "\n".join(lines)))
    df = docs_table(rows)
    got = {r.doc_id: r.text.split("\n") for r in line_dedup.drop_repeated_lines(df).collect()}
    want = {doc: lines or [""] for doc, lines in _lines_left(rows).items()}
    assert got == want
    # every line is left somewhere, and once where a neighbour in its passage differs in the families' bits
    left = [x for lines in got.values() for x in lines]
    assert {x for _, t in rows for x in t.split("\n")} - {"", " "} <= set(left)
    held = {x for _, t in rows for x in t.split("\n")}
    found = 0
    for lines in passages:
        for i, x in enumerate(lines):
            bits = [line_dedup.line_hash(lines[k].encode()) % 64 for k in (i - 1, i + 1) if 0 <= k < len(lines)]
            if x in held and any(b != line_dedup.line_hash(x.encode()) % 64 for b in bits):
                assert left.count(x) == 1, x
                found += 1
    assert found > 0.9 * sum(map(len, passages))


def test_line_dedup_long_texts_and_lines(docs_table):
    long_line = "y" * 3_000_000
    body = "\n".join(f"row {i}" for i in range(60_000))
    df = docs_table([(1, f"a\n{long_line}\nb"), (2, f"c\n{long_line}\nb"), (3, body), (4, "new\n" + body)])
    got = {r.doc_id: r.text for r in line_dedup.drop_repeated_lines(df).collect()}
    assert got[1] == f"a\n{long_line}\nb" and got[2] == "c" and got[3] == body
    assert got[4].startswith("new") and len(got[4]) < 30


def test_cover_holds_all_lines_of_its_chunks():
    rng = np.random.default_rng(9)
    for _ in range(200):
        chunks = sorted({(int(a), int(a + n)) for a, n in zip(rng.integers(0, 30, 12), rng.integers(2, 7, 12), strict=True)})
        picked = [chunks[i] for i in line_dedup.cover(chunks)]
        lines = lambda cs: {i for a, b in cs for i in range(a, b)}
        assert lines(picked) == lines(chunks)
    assert line_dedup.cover([]) == []


def test_clean_documents_drops_what_is_emptied(docs_table):
    body = "\n".join(f"line {i} {i * i}" for i in range(6))
    df = docs_table([(1, body), (2, body), (3, ""), (4, None), (5, "single")])
    out = line_dedup.clean_documents(df)
    assert out.columns == df.columns
    assert sorted(r.doc_id for r in out.collect()) == [1, 3, 4, 5]
    assert line_dedup.clean_documents(docs_table([])).count() == 0
