"""Operator 4: licence scan with a positional index of rare template words. DataFrame functions only.

One pass over the text keeps, for each document, the places of licence words (template words that are not function words) with the
words around them. Document frequencies of those words over the whole corpus give their IDF. Each place then votes, through the
template postings, for (template, start); the votes of a template meet by relative position, the highest-IDF words of the template
must all be among them, and the mandatory key phrase is compared word by word.

Edge cases: a null text counts as empty; a text without words has n_words 0, no labels, score 0.0 and null first_word and last_word;
rows that repeat a doc_id each get a row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch, let, lower_ascii

LICENCE_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Fixed values: (label, template words, mandatory key phrase). The base phrases are templates whose key phrase is the whole.
BASE = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)
TEMPLATES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", "permission is hereby granted free of charge"),
    ("apache-2", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("cc-by-nc", "creative commons attribution noncommercial", "attribution noncommercial"),
    ("cc-by-sa", "creative commons attribution sharealike", "attribution sharealike"),
    ("cc-by-sa", "cc by sa", "cc by sa"),
    ("cc0", "cc0 1 0 universal", "cc0 1 0"),
    ("gpl-2", "licensed under the gnu general public license version 2", "gnu general public license version 2"),
    ("gpl-3", "licensed under the gnu general public license version 3", "gnu general public license version 3"),
    ("lgpl", "gnu lesser general public license", "gnu lesser general public license"),
    ("agpl", "gnu affero general public license", "gnu affero general public license"),
    ("mpl-2", "mozilla public license version 2 0", "mozilla public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose", "permission to use copy modify and or distribute"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
)
FUNCTION_WORDS = frozenset("a and any are as by for in into is of or the this to use with without 0 1 2 3".split())
#: How many of a template's highest-IDF words must vote for a place.
RAREST = 3


def templates() -> list[tuple]:
    """(number, label, words, key phrase words, offset of the key phrase, base) of every template."""
    out = []
    for n, (label, words, key, base) in enumerate([(a, b, b, True) for a, b in BASE] + [(*t, False) for t in TEMPLATES]):
        w, k = words.split(), key.split()
        at = next(i for i in range(len(w)) if w[i : i + len(k)] == k)
        out.append((n, label, w, k, at, base))
    return out


def vocabulary() -> list[str]:
    return sorted({w for _, _, words, *_ in templates() for w in words} - FUNCTION_WORDS)


def word_places(docs: DataFrame, reach: int) -> DataFrame:
    """(doc_id, uid, n_words, hits): hits are (pos, word, from, around), around being the words from place `from` up to reach words on."""
    vocab = vocabulary()

    def around(words):
        places = F.array_compact(F.transform(words, lambda w, i: F.when(w.isin(vocab), i)))
        hit = lambda i: F.struct(
            i.alias("pos"), F.element_at(words, i + 1).alias("word"), F.greatest(i - reach, F.lit(0)).alias("from"),
            F.slice(words, F.greatest(i - reach, F.lit(0)) + 1, F.lit(2 * reach + 1)).alias("around"),
        )
        return F.struct(F.size(words).cast("long").alias("n_words"), F.transform(places, hit).alias("hits"))

    words = F.regexp_extract_all(lower_ascii(F.coalesce("text", F.lit(""))), F.lit(LICENCE_WORD), F.lit(0))
    return docs.select("doc_id", F.monotonically_increasing_id().alias("uid"), let(words, around).alias("x")).select("doc_id", "uid", "x.*")


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    spark, known = docs.sparkSession, templates()
    scratch = Scratch(spark)
    table = scratch.write(word_places(docs.select("doc_id", "text"), max(len(t[2]) for t in known)))
    hits = table.select("uid", F.explode("hits").alias("h")).select("uid", "h.*")
    # bounded: one row for each word of the vocabulary, which is a constant of this module
    total = table.count()
    df = {r["word"]: r["n"] for r in hits.groupBy("uid", "word").agg(F.lit(1)).groupBy("word").agg(F.count("*").alias("n")).collect()}
    idf = {w: math.log((1 + total) / (1 + df.get(w, 0))) + 1 for w in vocabulary()}

    postings, facts = [], []
    for n, label, words, key, at, base in known:
        weighty = sorted({w for w in words if w in idf}, key=lambda w: (-idf[w], w))
        rare = set(weighty[:RAREST]) & set(key) or {w for w in weighty if w in key}
        postings += [(w, n, rel, idf[w], w in rare) for rel, w in enumerate(words) if w in idf]
        facts.append((n, label, key, at, base, sum(idf[w] for w in words if w in idf), sum(w in rare for w in words)))
    # both are constants of this module in size
    post = F.broadcast(spark.createDataFrame(postings, "word string, template int, rel int, idf double, rare boolean"))
    fact = F.broadcast(spark.createDataFrame(facts, "template int, label string, key array<string>, at int, base boolean, mass double, rare_words int"))
    votes = (
        hits.join(post, "word")
        .groupBy("uid", "template", (F.col("pos") - F.col("rel")).alias("start"))
        .agg(F.sum("idf").alias("got"), F.count_if("rare").alias("rare"), F.min(F.struct("pos", "from", "around")).alias("w"))
    )
    found = votes.join(fact, "template").where("rare >= rare_words and start + at >= 0")
    begin = F.col("start") + F.col("at") - F.col("w.from")
    found = found.where(begin >= 0).where(F.slice("w.around", (begin + 1).cast("int"), F.size("key")) == F.col("key"))
    place = F.when(F.col("base"), F.col("start"))
    per = found.groupBy("uid").agg(
        F.count(place).alias("n_base"), F.min(place).alias("first_word"), F.max(place).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("base"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max(F.least(F.lit(1.0), F.round(F.col("got") / F.col("mass"), 6))).alias("score"),
    )
    return table.select("doc_id", "uid", "n_words").join(per, "uid", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"), F.col("first_word").cast("long"), F.col("last_word").cast("long"),
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"),
    )
