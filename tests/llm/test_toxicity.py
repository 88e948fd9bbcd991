"""Toxicity: features against a plain form, held-out accuracy on planted words, what a score may depend on, edge cases."""

import random
import zlib

import numpy as np

from statuta.llm import registry, toxicity


def _plain(text):
    c = " " + text.lower() + " "
    c = "".join(" " if ord(x) < 128 and not x.isalnum() else x for x in c)
    while "  " in c:
        c = c.replace("  ", " ")
    return {c[i : i + n] for n in (3, 4, 5) for i in range(len(c) - n + 1) if " " not in c[i + 1 : i + n - 1]}


def test_features():
    for text in ["Ab cd, efgh", "x", "", "ÄÖ über!!straße", "a-b_c 12"]:
        got = set(np.concatenate([*toxicity.grams(text), np.zeros(0, np.int64)]).tolist())
        want = _plain(text) if text else set()
        assert len(got) == len(want)
    one = set(np.concatenate(list(toxicity.grams("Ab cd"))).tolist())
    assert one == set(np.concatenate(list(toxicity.grams("aB  \n(CD)"))).tolist())


def test_long_texts_are_read_whole():
    word = " ".join(f"w{k}x" for k in range(40000))
    assert len(word) > 3 * toxicity.WINDOW
    head = set(np.concatenate(list(toxicity.grams(word))).tolist())
    tail = set(np.concatenate(list(toxicity.grams("w39990x w39991x"))).tolist())
    assert tail <= head


def _corpus(n=900, seed=3):
    rng = random.Random(seed)
    syllables = ["ba", "do", "ki", "lu", "me", "no", "pra", "sti", "tor", "ul", "ven", "wex"]
    bad = ["grumph", "zarkon", "fleeb", "snorgle"]
    rows, labels = [], []
    for k in range(n):
        words = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(5, 200))]
        toxic = int(rng.random() < 0.2)
        for _ in range(2 * toxic + len(words) // 40 * toxic):
            words.insert(rng.randint(0, len(words)), rng.choice(bad) + rng.choice(["", "s", "ing"]))
        rows.append((k, " ".join(words), "en", "s"))
        labels.append((k, toxic))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = _corpus()
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.score(docs, marks).collect()}
    of = dict(labels)
    assert all(got[k]["held_out"] == (zlib.crc32(str(k).encode()) % 3 == 1) for k in got) and set(got) == set(of)
    unseen = [k for k in got if got[k]["held_out"]]
    assert len(unseen) > 200
    assert np.mean([got[k]["predicted"] for k in unseen if of[k]]) >= 0.9
    assert np.mean([got[k]["predicted"] for k in unseen if not of[k]]) <= 0.02
    assert all(r["predicted"] == (r["score"] >= 0.7) and 0 <= r["score"] <= 1 for r in got.values())


def test_held_out_labels_and_other_columns_do_not_matter(spark):
    rows, labels = _corpus(300)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").coalesce(1)
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    turned = spark.createDataFrame([(k, 1 - t if zlib.crc32(str(k).encode()) % 3 == 1 else t) for k, t in labels], "doc_id long, toxic int")
    other = docs.select("doc_id", "text", docs.lang.alias("score"), docs.source.alias("predicted"))
    want = sorted(map(tuple, toxicity.score(docs, marks).collect()))
    assert want == sorted(map(tuple, toxicity.score(other, turned).collect()))


def test_edges(spark):
    rows, labels = _corpus(200)
    rows += [(None, "grumph", "en", "s"), (7, None, "en", "s"), (7, "", "en", "s"), (9000, "word " * 100000 + "grumph", "en", "s")]
    labels += [(None, 1), (5, 1), (5, 0), (12345, 1), (8, None), (9, 7)]
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = toxicity.score(docs, marks).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got) and not next(r for r in got if r["doc_id"] is None)["held_out"]
    assert toxicity.score(docs.limit(0), marks).count() == 0
    assert {r["score"] for r in toxicity.score(docs, marks.limit(0)).collect()} == {0.0}
    assert {r["score"] for r in toxicity.score(docs, marks.where("toxic = 0")).collect()} == {0.0}


def test_sample_goes_by_row(spark):
    """One id for every row does not take all rows or none into the sample."""
    rows, _ = _corpus(400)
    docs = spark.createDataFrame([(7, t) for _, t, *_ in rows], "doc_id long, text string").repartition(4)
    labelled = toxicity.labelled(docs, spark.createDataFrame([(7, 1)], "doc_id long, toxic int"))
    drawn = toxicity._seen(labelled, [0.0, 0.25]).where("held is not null").count()
    assert 60 <= drawn <= 140


def test_given_table(spark):
    data = "/root/testdata/sf0.1"
    got = registry.op12_toxicity(spark, data).join(spark.read.parquet(f"{data}/labels.parquet"), "doc_id").where("held_out").collect()
    assert np.mean([r["predicted"] for r in got if r["toxic"] == 1]) >= 0.75 and np.mean([r["predicted"] for r in got if r["toxic"] == 0]) <= 0.03
