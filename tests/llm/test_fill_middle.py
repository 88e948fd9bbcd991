"""Fill in the middle: the Elias-Fano list, the query against its SQL, edge cases, and texts rebuilt from outputs."""

import hashlib
import random
import re

import duckdb
import numpy as np
import pytest

from statuta.llm import fill_middle, registry


@pytest.mark.parametrize("values", [[], [1], [5], [1, 2, 3], [1000000], [7, 8, 900, 100000, 100001], list(range(1, 400, 3))])
def test_list(values):
    low, high = fill_middle.encode(np.array(values, np.int64))
    assert [fill_middle.select(low, high, len(values), values[-1], k) for k in range(len(values))] == values


def test_list_is_small():
    rng = random.Random(1)
    ends = np.cumsum([rng.randint(1, 120) for _ in range(5000)])
    low, high = fill_middle.encode(ends)
    assert 8 * (len(low) + len(high)) < 5000 * (2 + np.log2(ends[-1] / 5000) + 1)
    assert all(fill_middle.select(low, high, 5000, int(ends[-1]), k) == ends[k] for k in range(0, 5000, 37))


def _want(doc_id, text):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    i, j = sorted((h[0] % (len(lines) + 1), h[1] % (len(lines) + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")):
        return doc_id, len(lines), "plain", None, None, text
    p, m, s = "".join(lines[:i]), "".join(lines[i:j]), "".join(lines[j:])
    if h[3] % 100 < 50:
        return doc_id, len(lines), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(lines), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_against_plain_form(spark):
    rng = random.Random(5)
    texts = [None, "", "\n", "\n\n\n", "a", "a\n", "ä\n€\n𝄞x\ny", "x<P>y", "<", "<S\n>", "P>\n<", "line\r\nline\r\n", "long\n" * 30000 + "end", "€" * 70000]
    texts += ["".join(rng.choice("aä\n𝄞 <PSM>") for _ in range(rng.randint(0, 60))) for _ in range(300)]
    rows = [(k, t, "z", "z") for k, t in enumerate(texts)] + [(None, "no id\nat all\n", "z", "z"), (3, "again\nand\nagain", "z", "z")] + [(1000 + k, "a copy\nof many\nlines\n", "z", "z") for k in range(700)]
    table = spark.createDataFrame(rows, "doc_id long, text string, form string, key string").repartition(5)
    key = lambda r: tuple(repr(v) for v in r)
    want = sorted([_want(d, t) for d, t, *_ in rows], key=key)
    assert sorted((tuple(r) for r in fill_middle.transform(table).collect()), key=key) == want
    assert sorted((tuple(r) for r in fill_middle.transform(table, group=50).collect()), key=key) == want
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    texts = {sha(t or "") for _, t, *_ in rows}
    for r in fill_middle.digests(table).collect():
        assert r["restored_sha256"] in texts
    assert sorted(r["restored_sha256"] for r in fill_middle.digests(table).collect()) == sorted(sha(t or "") for _, t, *_ in rows)


def test_rates_and_empty_table(spark):
    table = spark.createDataFrame([(k, f"{k}\n" * 5) for k in range(400)], "doc_id long, text string")
    assert {r["form"] for r in fill_middle.transform(table, rate=0).collect()} == {"plain"}
    assert {r["form"] for r in fill_middle.transform(table, spm=100).collect()} == {"spm"}
    assert 50 < fill_middle.transform(table, rate=50).where("form = 'plain'").count() < 350
    assert fill_middle.digests(table.limit(0)).count() == 0


def test_texts_are_shuffled_once(spark):
    made = registry.op11_fill_middle(spark, "/root/testdata/sf0.001")
    made.collect()
    plan = made._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ReusedExchange" in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_sql(spark):
    data = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{data}/documents.parquet'")
    got = registry.op11_fill_middle(spark, data)
    want = con.execute(registry.oracle_sql()["op11_fill_middle"])
    assert [d[0] for d in want.description] == got.columns
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want.fetchall()))
