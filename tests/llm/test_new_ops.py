"""Hard negatives, byte-level BPE and the Merkle manifest against brute force."""

import hashlib
import math
import random
import zlib
from itertools import groupby

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from wharfline.llm import byte_bpe, hard_negatives, merkle

# --- byte-level BPE ----------------------------------------------------------

RANKS = byte_bpe.read_ranks(public_tokenizers.path(byte_bpe.VOCABULARY))
TIKTOKEN = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})

TEXTS = [
    (1, "the quick brown fox, it's 12345 o'clock\n\n  and   more"), (2, None), (3, ""), (4, " "), (5, "\r\n\t   x\u0085"),
    (6, "Übergröße naïve España niño"), (7, "日本語テキスト ,,,,, ???"), (8, "😀👍🏽 é ​"), (9, "a" * 700), (10, "aaa aaaa aaaaa aaaaaa"),
    (11, "xq9Zk" * 150), (12, "<|endoftext|> \x00\x01"), (1, "the quick brown fox, it's 12345 o'clock\n\n  and   more"),
    (1, "another text of the same id"), (None, "a row without an id"), (13, "word " * 3000), (14, "'s't're've'm'll'd 'S ſ"),
]


def coded(docs):
    return byte_bpe.decode_documents(byte_bpe.encode_documents(docs)).collect()


def check_encoded(rows, texts):
    expected = []
    for i, text in texts:
        ids = TIKTOKEN.encode_ordinary(text or "")
        expected.append((i, len(ids), np.array(ids, "<u4").tobytes(), (text or "").encode()))
    key = lambda r: (r[0] is None, r[0], r[2])
    assert sorted(((r[0], r[1], bytes(r[2]), bytes(r[3])) for r in rows), key=key) == sorted(expected, key=key)


@pytest.mark.parametrize("pack", [40, 1 << 20])
def test_encoding_is_that_of_the_library(docs_table, monkeypatch, pack):
    monkeypatch.setattr(byte_bpe, "PACK_BYTES", pack)
    monkeypatch.setattr(byte_bpe, "BUCKET_BYTES", 300)
    docs = docs_table(TEXTS, "pack", "word", "ids", "decoded").repartition(2)
    check_encoded(coded(docs), TEXTS)


def test_encoding_of_random_texts(docs_table):
    rng = random.Random(5)
    alphabet = "aeinrst" * 4 + " " * 6 + "\n,.'9éß—ñ字"
    texts = [(i, "".join(rng.choice(alphabet) for _ in range(rng.randrange(300)))) for i in range(200)]
    check_encoded(byte_bpe.encode_documents(docs_table(texts), decoded=True).collect(), texts)


def test_encoding_of_nothing(docs_table):
    assert coded(docs_table([])) == []
    check_encoded(coded(docs_table([(1, None), (2, "")])), [(1, None), (2, "")])


def test_decoding_of_any_ids(spark):
    rows = [(1, np.array([0, 50255, 7], "<u4").tobytes()), (2, b""), (3, None)]
    got = byte_bpe.decode_documents(spark.createDataFrame(rows, "doc_id long, ids binary")).collect()
    by_rank = {rank: token for token, rank in RANKS.items()}
    assert [r["decoded"] and bytes(r["decoded"]) for r in got] == [by_rank[0] + by_rank[50255] + by_rank[7], b"", None]


# --- Merkle manifest -----------------------------------------------------------


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def cell(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree_paths(hashes):
    """(root, for each leaf its list of (left, right) siblings)."""
    at, paths, level = list(range(len(hashes))), [[] for _ in hashes], hashes
    while len(level) > 1:
        runs = [level[i:i + 3] for i in range(0, len(level), 3)]
        for leaf, p in enumerate(at):
            run, slot = runs[p // 3], p % 3
            paths[leaf].append(("".join(run[:slot]), "".join(run[slot + 1:])))
            at[leaf] = p // 3
        level = [sha("".join(run)) for run in runs]
    return level[0], paths


def brute_manifest(rows):
    """rows: (doc_id, source, lang, n_chars, text) -> bag of result rows."""
    leaves = []
    for r in rows:
        text = r[4]
        if text is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
            text = text.replace("\n", "")
        leaves.append((r[1], r[0], sha("".join(map(cell, r))), sha("".join(map(cell, (*r[:4], text))))))
    by = lambda x: (x[0] is not None, (x[0] or "").encode(), x[1] is not None, x[1] or 0, x[2], x[3])
    groups = [list(g) for _, g in groupby(sorted(leaves, key=by), key=lambda x: x[0])]
    inner = [tree_paths([x[2] for x in g]) for g in groups]
    root, outer = tree_paths([r for r, _ in inner]) if inner else (None, [])
    out = []
    for g, (subroot, paths), above in zip(groups, inner, outer, strict=True):
        for x, path in zip(g, paths, strict=True):
            h = x[3]
            for left, right in path + above:
                h = sha(left + h + right)
            out.append((x[1], x[2], subroot, root, sha("".join(a + b for a, b in path + above)), h, h == root))
    return out


def manifest_rows(spark, rows, tmp_path):
    spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").withColumns(
        {"leaf": F.lit(1), "g": F.lit("x"), "pos": F.lit(2), "root": F.lit("r")}).write.parquet(f"{tmp_path}/documents.parquet")
    return [tuple(r) for r in merkle.op13_merkle_manifest(spark, str(tmp_path)).collect()]


def some_documents(n, sources, seed):
    rng = random.Random(seed)
    return [(i, rng.choice(sources), rng.choice(["en", None]), rng.choice([None, 7]), rng.choice([None, "", "a\nb\n", "é\n" * 50, "plain"])) for i in range(n)]


KEY = lambda r: (r[0] is None, r[0] or 0, r[1:])


@pytest.mark.parametrize(("n", "sources"), [
    (120, ["a", "b", None, "", "ä", "Z", "z"]), (82, ["one"]), (1, ["one"]), (2, ["a"]), (3, [None]), (4, ["x"]), (30, [f"s{i}" for i in range(40)])])
def test_manifest(spark, tmp_path, n, sources):
    rows = some_documents(n, sources, n)
    assert sorted(manifest_rows(spark, rows, tmp_path), key=KEY) == sorted(brute_manifest(rows), key=KEY)


def test_manifest_of_repeated_rows_and_null_ids(spark, tmp_path):
    rows = [(1, "a", "en", 2, "x\n")] * 4 + [(1, "a", "en", 2, "other")] + [(None, None, None, None, None)] * 2 + [(None, "a", None, 1, "q\n")]
    assert sorted(manifest_rows(spark, rows, tmp_path), key=KEY) == sorted(brute_manifest(rows), key=KEY)


def test_manifest_of_nothing(spark, tmp_path):
    assert manifest_rows(spark, [], tmp_path) == []


# --- hard negatives --------------------------------------------------------------


def brute_negatives(rows):
    one = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        got = (label, [math.floor(256 * float(np.float32(x))) for x in v])
        one[i] = min(one.get(i, got), got)
    out = []
    for a, (label, v) in one.items():
        if a % 100:
            continue
        scored = sorted(((-sum(x * y for x, y in zip(v, w)), b, other) for b, (other, w) in one.items() if b != a and len(w) == len(v)))
        for ps, p, _ in [s for s in scored if s[2] == label][:5]:
            fits = [(s, b) for s, b, other in scored if other != label and 30 * -ps <= 100 * -s <= 90 * -ps][:10]
            out += [(a, p, rank, b, -ps, -s) for rank, (s, b) in enumerate(fits, 1)]
    return sorted(out)


def mined(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumns(
        {"shard": F.lit(1), "cell": F.lit(2), "windows": F.lit("w"), "score": F.lit(0.5)})
    return sorted(tuple(r) for r in hard_negatives.mine(df).collect())


def clouds(n, dim, seed, spread=0.1, step=1):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(12, dim))
    pick = rng.integers(0, 12, n)
    x = middle[pick] + spread * rng.normal(size=(n, dim))
    return [(int(i) * step, [float(c) for c in np.float32(v)], int(rng.integers(0, 4))) for i, v in enumerate(x)]


@pytest.mark.parametrize(("shard", "block"), [(2048, 128), (40, 2)])
def test_negatives_of_clouds(spark, monkeypatch, shard, block):
    for name, value in (("SHARD_ROWS", shard), ("BLOCK_ROWS", block), ("GROUP_BLOCKS", 2), ("GROUP_TREES", 3), ("GROUP_ROOTS", 7), ("LEAF_ROWS", 4), ("SPLIT", 2)):
        monkeypatch.setattr(hard_negatives, name, value)
    rows = clouds(900, 6, 1, step=10)
    assert mined(spark, rows) == brute_negatives(rows) != []


def test_negatives_of_odd_rows(spark):
    rows = clouds(150, 3, 2, step=4)
    rows += [(1000 + i, [0.5, 0.25, 0.125], 1) for i in range(60)]            # one vector many times, ties
    rows += [(2000 + i, [0.5, 0.25, 0.125], 2) for i in range(60)]
    rows += [(3000, None, 1), (3100, [1.0, None, 1.0], 1), (3200, [float("nan"), 1.0, 1.0], 1), (3300, [float("inf"), 0.0, 0.0], 2),
             (3400, [1.0, 1.0, 1.0], None), (None, [1.0, 1.0, 1.0], 1), (3500, [], 1), (3600, [], 1), (3601, [], 2), (3700, [1.0, 2.0], 1),
             (3701, [1.0, 2.0], 1), (3702, [0.5, 0.5], 3), (100, [9.0, 9.0, 9.0], 3), (100, [9.0, 9.0, 9.0], 3), (3800, [1e4, -1e4, 3.0], 5),
             (3801, [1e4, -1e4, 3.0], 5), (3802, [5e3, -5e3, 1.0], 6)]
    assert mined(spark, rows) == brute_negatives(rows) != []


def test_negatives_of_nothing(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(100, [1.0], 1), (101, [1.0], 2)]) == []


def test_a_tree_holds_every_row_within_its_radii():
    x = np.array([r[1] for r in clouds(700, 5, 3)]).round(2) * 100 // 1
    tree = hard_negatives.CoverTree(x)
    assert sorted(tree.order) == list(range(len(x)))

    def below(node):
        center, child, n, at, size = tree.nodes[node]
        rows = tree.order[at:at + size] if not n else [r for c in range(child, child + n) for r in below(c)]
        assert tree._distances(center, np.array(rows)).max() <= tree.radii[node] + 1e-9
        return rows

    assert len(below(0)) == len(x)
    assert len(tree.nodes) > 12
