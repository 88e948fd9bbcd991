"""Findings of the review: rows that share an id in mixing and quality, secrets of letters only, account numbers by country."""

import random

import numpy as np

from statuta.llm import mixing, pii, quality


def test_mixing_of_rows_without_ids_of_their_own(spark):
    """A source is not taken all or not at all where its rows share a doc_id or have none."""
    rng = random.Random(1)
    for ids in ([None], [7], [1, 2, 3], [None, 5]):
        rows = [(rng.choice(ids), " ".join(["x"] * rng.randint(1, 9)), s) for s in "abc" for _ in range(1000)]
        docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4).cache()
        got = mixing.mix(docs).groupBy("source").count().collect()
        plan = mixing.plan(docs).groupBy("target").sum("taken").collect()
        assert len(got) == 3 and all(abs(r["sum(taken)"] - r["target"]) <= 0.08 * r["target"] for r in plan), ids
        again = sorted(map(tuple, mixing.plan(docs).select("size", "taken").collect()))
        assert again == sorted(map(tuple, mixing.plan(docs).select("size", "taken").collect()))


def test_quality_of_rows_with_one_id(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").selectExpr("cast(5 as long) as doc_id", "text", "n_chars")
    for sample in (30, 60, 8192):
        got = quality.classify(docs, sample=sample).collect()
        assert len({r["score"] for r in got}) > 20 and 0.3 < np.mean([r["kept"] for r in got]) < 1


def _spans(spark, texts):
    got = pii.detect(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    return {r["doc_id"]: [s for s in r["spans"].split(",") if s] for r in got}


def test_secrets_of_letters(spark):
    rng = random.Random(3)
    letters = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ") for _ in range(n))
    texts, want = [], []
    for i in range(300):
        lead, tail = ("Some words. ", " and more.") if i % 2 else ("In 2019 we wrote 35 lines. ", " Then 7 more.")
        hit = f"{rng.choice(['password', 'token', 'API_KEY', 'secret'])}{rng.choice([': ', '=', ' = '])}{letters(rng.choice([10, 20, 40]))}"
        texts.append(lead + hit + tail)
        want.append(f"secret:{len(lead)}:{len(lead) + len(hit)}")
    got = _spans(spark, texts + ["No secret is here, and no password either. The token of thanks was small."] * 100)
    assert sum(w in got[i] for i, w in enumerate(want)) >= 0.9 * len(want) and not any(got[i] for i in range(300, 400))
    assert _spans(spark, ["password: CorrectHorseBattery", "y"]) == {0: ["secret:0:29"], 1: []}


def _iban(country, body):
    number = "".join(str(int(c, 36)) for c in body + country + "00")
    return f"{country}{98 - int(number) % 97:02d}{body}"


def test_account_numbers_end_with_their_country(spark):
    digits = lambda n, k: "".join(random.Random(k * 100 + n).choice("0123456789") for _ in range(n))
    group = lambda s: " ".join(s[i : i + 4] for i in range(0, len(s), 4))
    texts, want = ["pay BE68 5390 0754 7034 PAID"], ["iban:4:23"]
    for k, (country, n) in enumerate((("NO", 11), ("BE", 12), ("DE", 18), ("PL", 24), ("FR", 23), ("NL", 14)) * 4):
        said = _iban(country, digits(n, k))
        said = group(said) if k % 2 else said
        texts.append(f"to {said} {('WORD', 'paid', 'OK THEN', 'IBAN')[k % 4]} now")
        want.append(f"iban:3:{3 + len(said)}")
    got = _spans(spark, texts)
    assert [s for i, w in enumerate(want) if w not in got[i] for s in (texts[i], w, str(got[i]))] == []
