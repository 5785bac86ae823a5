import random

import pyarrow as pa

import corpus_pipeline
from lodestar.llm import sentencepiece_codec

VOCAB = {"aa": [f"{x}{y}" for x in "ther sen wat hou gre".split() for y in "ing ed s ly er".split()],
         "bb": [f"{x}{y}" for x in "gesch ver auf üb unt".split() for y in "ung keit lich en ß".split()]}


def corpus():
    rnd = random.Random(12)
    text = lambda lang, n: " ".join(rnd.choice(VOCAB[lang]) for _ in range(n))
    item = text("aa", 30)
    docs, kind = [], {}

    def add(words, what):
        kind[len(docs)] = what
        docs.append(words)

    for i in range(300):
        lang = rnd.choice(sorted(VOCAB))
        words = text(lang, rnd.choice([20, 60, 200]))
        if i % 4 == 0:
            add(words + " vileword" + "".join(rnd.choice("aeiou") for _ in range(3)) + " " + text(lang, 3), "toxic")
        else:
            add(words, "clean")
    base = text("bb", 120)
    add(base, "clean")
    for _ in range(5):
        w = base.split()
        w[rnd.randrange(len(w))] = "changed"
        add(" ".join(w), "copy")
    add(base, "copy")
    add(text("aa", 40) + " " + " ".join(item.split()[5:20]) + " " + text("aa", 40), "leak")
    for x in (None, "", "12 34 %%"):
        add(x, "no language")
    return docs, kind, item


def test_every_decision_takes_effect_and_clean_documents_stay(spark, small):
    docs, kind, item = corpus()
    ids = list(range(len(docs)))
    path = small(
        documents=pa.table({"doc_id": pa.array(ids, pa.int64()), "text": pa.array(docs), "key": ["k"] * len(docs),
                            "lang": ["aa" if i % 7 else None for i in ids], "score": [0.5] * len(docs),
                            "label": pa.array([None] * len(docs), pa.string()), "gone_id": ids, "gone_key": ["g"] * len(docs),
                            "lodestar text key": ids, "text_key": ids, "batch": ids}),
        labels=pa.table({"doc_id": pa.array(ids[:300], pa.int64()),
                         "toxic": pa.array([int(kind[i] == "toxic") for i in ids[:300]], pa.int32())}),
        benchmark=pa.table({"item_id": pa.array([1, 2], pa.int64()), "text": pa.array([item, None])}))
    docs_df = spark.read.parquet(path + "/documents.parquet")
    columns = docs_df.columns
    seen = [set(ids)]
    frame = docs_df
    for name, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, path)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert frame.columns == columns
        seen.append({r["doc_id"] for r in frame.select("doc_id").collect()})
    gone = [a - b for a, b in zip(seen, seen[1:], strict=False)]
    assert gone[0] == {i for i in ids if kind[i] == "toxic"}
    assert gone[1] == {i for i in ids if kind[i] == "no language"}
    assert gone[2] == {i for i in ids if kind[i] == "copy"}
    assert gone[3] == {i for i in ids if kind[i] == "leak"}
    assert seen[-1] == {i for i in ids if kind[i] == "clean"}
    rows = corpus_pipeline.run(spark, path).collect()
    own = sentencepiece_codec.codec(sentencepiece_codec.default_model_path())
    assert sorted((r["doc_id"], r["ids"]) for r in rows) == sorted((i, own.encode(docs[i])) for i in seen[-1])


def test_empty_tables(spark, small):
    none = lambda **c: pa.table({k: pa.array([], t) for k, t in c.items()})
    path = small(documents=none(doc_id=pa.int64(), text=pa.string(), lang=pa.string()),
                 labels=none(doc_id=pa.int64(), toxic=pa.int32()), benchmark=none(item_id=pa.int64(), text=pa.string()))
    assert corpus_pipeline.run(spark, path).collect() == []
