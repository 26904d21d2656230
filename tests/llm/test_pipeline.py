"""The pipeline on planted cases."""

import random

import corpus_pipeline
from wharfline.llm import packing


def planted(rng):
    words = [a + b for a in "ba ce di fo gu ha ki lo mu".split() for b in "lan rem sot vik zun per".split()]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    clean = {i: text(80) for i in range(40)}
    toxic = {100 + i: text(30) + " idiot scum " + text(30) for i in range(40)}
    item = text(15)
    leaked = {200: text(40) + " " + item + " " + text(40)}
    near = {300: clean[3] + " extra", 301: clean[4]}
    lines = "\n".join(text(9) for _ in range(8))
    return clean, toxic, item, leaked, near, {400: lines, 401: lines}


def test_stages(spark, tmp_path):
    clean, toxic, item, leaked, near, lines = planted(random.Random(1))
    docs = clean | toxic | leaked | near | lines | {500: None, 501: ""}
    d = str(tmp_path)
    spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in docs.items()],
                          "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, int(100 <= i < 200), 1) for i in docs if i < 200], "doc_id long, toxic int, quality int") \
        .write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    df = spark.read.parquet(f"{d}/documents.parquet")
    left = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, df, d)
        assert out.columns == df.columns
        out.write.parquet(f"{d}/{k}")
        df = spark.read.parquet(f"{d}/{k}")
        left[name] = {r.doc_id for r in df.collect()}
    assert left["toxicity"] == docs.keys() - toxic.keys()
    assert left["line_dedup"] == left["toxicity"] - {401}
    assert left["near_duplicates"] == left["line_dedup"] - near.keys()
    assert left["decontamination"] == left["near_duplicates"] - leaked.keys()
    pieces = corpus_pipeline.run(spark, d).collect()
    texts = {r.doc_id: r.text for r in df.collect()}
    tokenizer = packing.WordTokenizer(packing.default_tokenizer())
    assert {p.doc_id for p in pieces} == texts.keys()
    assert sum(p.length for p in pieces) == sum(len(tokenizer.encode([t or ""])[0]) + 1 for t in texts.values())
