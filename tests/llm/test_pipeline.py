"""The pipeline's stages: each against a plain form on everything that the one before kept, and columns, effects and order."""

import hashlib
import re
from collections import defaultdict

import pytest

import corpus_pipeline
from statuta.llm import quality
from tests.llm.test_document_operators import LOWER, WORD, _find, _line_decisions

DATA = "/root/testdata/sf0.001"


def _after_quality(spark, docs):
    """The scorer's own judgement of each document, whose parts have tests of their own."""
    kept = {r["doc_id"] for r in quality.classify(docs).collect() if r["kept"]}
    return [r for r in docs.collect() if r["doc_id"] in kept]


def _after_lines(rows):
    kept = defaultdict(list)
    for i, n, _, _, stays in _line_decisions(sorted((r["doc_id"], r["text"]) for r in rows)):
        kept[i].append((n, stays))
    out = {}
    for r in rows:
        lines, said = (r["text"] or "").split("\n"), [n for n, stays in kept[r["doc_id"]] if stays]
        text = "\n".join(lines[n] for n in sorted(said))
        if len(said) == len(lines) or re.search(r"\S", text):
            out[r["doc_id"]] = text
    return out


def _after_near_duplicates(texts):
    sets = {}
    for i, t in texts.items():
        w = WORD.findall(t.translate(LOWER))
        sets[i] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}
    parent = {i: i for i in sets}
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = _find(parent, a), _find(parent, b)
                parent[max(x, y)] = min(x, y)
    return {i for i in sets if _find(parent, i) == i}


def _after_mix(rows):
    """{doc_id: copies}, by filling up to the caps source by source."""
    size = {r["doc_id"]: len(WORD.findall(r["text"] or "")) for r in rows}
    total = defaultdict(int)
    for r in rows:
        total[r["source"]] += size[r["doc_id"]]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(total, key=lambda s: (s is None, s or "")))}
    target, left, free = {}, 1.5 * sum(total.values()), set(total)
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if level * weight[s] > 2 * total[s]}
        for s in full or free:
            target[s] = 2.0 * total[s] if full else level * weight[s]
        left -= sum(target[s] for s in full)
        free = free - full if full else set()
    out = {}
    for r in rows:
        rate = target[r["source"]] / total[r["source"]] if total[r["source"]] else 0.0
        u = int(hashlib.md5(f"mix:{r['doc_id']}".encode()).hexdigest()[:13], 16) / 2**52
        out[r["doc_id"]] = int(rate) + (u < rate - int(rate))
    return out


@pytest.fixture(scope="module")
def stages(spark):
    """{name: rows after it}, and '' for the documents."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    out = {"": docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, DATA)
        out[name] = made.collect()
        if name != "pack":
            assert made.columns == docs.columns, name
            docs = spark.createDataFrame(out[name], docs.schema)
    return out


def test_quality(spark, stages):
    assert sorted(stages["quality"]) == sorted(_after_quality(spark, spark.read.parquet(f"{DATA}/documents.parquet")))
    assert 0 < len(stages["quality"]) < len(stages[""])


def test_line_dedup(stages):
    want = _after_lines(stages["quality"])
    assert {r["doc_id"]: r["text"] for r in stages["line_dedup"]} == want and len(stages["line_dedup"]) == len(want)


def test_near_duplicates(stages):
    want = _after_near_duplicates({r["doc_id"]: r["text"] for r in stages["line_dedup"]})
    assert sorted(r["doc_id"] for r in stages["near_duplicates"]) == sorted(want)
    assert set(stages["near_duplicates"]) <= set(stages["line_dedup"])


def test_mix(stages):
    got = defaultdict(int)
    for r in stages["mix"]:
        got[r["doc_id"]] += 1
    want = {i: n for i, n in _after_mix(stages["near_duplicates"]).items() if n}
    assert dict(got) == want and set(stages["mix"]) <= set(stages["near_duplicates"])


def test_pack(stages):
    filled, pieces = defaultdict(list), defaultdict(int)
    for r in stages["pack"]:
        filled[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]] += r["length"]
    for parts in filled.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))] and sum(n for _, n in parts) <= 4096
    assert set(pieces) == {r["doc_id"] for r in stages["mix"]}
    assert len(filled) <= 1.1 * sum(pieces.values()) / 4096 + 1


def test_run(spark, stages):
    got = sorted(map(tuple, corpus_pipeline.run(spark, DATA).select("doc_id", "piece", "start", "length", "ids_crc32").collect()))
    assert got == sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in stages["pack"])
