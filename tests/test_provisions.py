"""What amending acts and rulings say: quotation depth, lists and ranges, points of rulings, the order of units, currency."""

import random

import pytest
from pyspark.sql import functions as F

from statuta.functions import identifiers
from statuta.operators import provisions


def _one(spark, column, *texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r["c"] for r in rows.select("i", column(F.col("t")).alias("c")).orderBy("i").collect()]


def test_quotations(spark):
    got = _one(spark, provisions.quotations, "a „b „c” d” e", "x „y\nz", "”a„b”“", None, "", "„a” i „b”")
    assert [g["masked"] for g in got] == ["a" + " " * 11 + "e", "x   \n ", "”a   “", "", "", " " * 3 + " i " + " " * 3]
    assert [g["quoted"] for g in got][:2] == ["  „b „c” d”  ", "  „y\nz"]
    assert [[(u["s"], u["e"]) for u in g["unsure"]] for g in got] == [[], [(2, 6)], [], [], [], []]
    assert [g["depth"] for g in got] == [0, 1, 0, 0, 0, 0]


def test_a_long_quotation_has_lost_its_end(spark):
    (got,) = _one(spark, lambda c: provisions.quotations(c, 5), "„aaaaaaaaaa art. 7 ”b„c” art. 8 „dddddddddd")
    assert got["masked"] == "      aaaaa art. 7 ”b    art. 8       ddddd" and len(got["unsure"]) == 2 and got["depth"] == 0


def test_masks_against_a_walk_by_character():
    rng = random.Random(8)
    for _ in range(300):
        text = "".join(rng.choice("ab\n„„”“") for _ in range(rng.randint(0, 40)))
        depth, want = 0, []
        for c in text:
            if c == "„":
                depth += 1
                want.append(" ")
            elif depth:
                depth -= c in "”“"
                want.append("\n" if c == "\n" else " ")
            else:
                want.append(c)
        masked, quoted, unsure, left = provisions._mask(text, 10**6)
        assert masked == "".join(want) and left == depth and bool(unsure) == bool(depth)
        assert all((m == q) if t == "\n" else (m == t) != (q == t) or t == " " for m, q, t in zip(masked, quoted, text, strict=True))


@pytest.mark.parametrize(
    "text, keys, ranges",
    [
        ("w art. 5 i 6 skreśla się", ["5", "6"], []), ("art. 8–10 otrzymują brzmienie", ["10", "8", "9"], []), ("w art. 4¹ zdanie drugie", ["4^1"], []),
        ("uchyla się art. 12a i 12b", ["12a", "12b"], []), ("po art. 12 dodaje się art. 12a", ["12a"], []), ("art. 130(1a) i art. 4^2", ["130^1a", "4^2"], []),
        ("art. 479 88a–479 88j", ["479^88a", "479^88j"], ["479^88a..479^88j"]), ("w art. 1 po wyrazach „art. 99 i art. 98” dodaje się", ["1"], []),
        ("po art. 3 dodaje się:\n„Art. 3a. Nowy „art. 77”.\nArt. 3b. Drugi.”", ["3a", "3b"], []), ("w art. 5, 7 oraz 9 uchyla się", ["5", "7", "9"], []), ("nic", [], []), (None, [], []),
    ],
)
def test_changed_units(spark, text, keys, ranges):
    (got,) = _one(spark, provisions.changed_units, text)
    assert (got["keys"], got["ranges"], got["unsure"]) == (keys, ranges, False)


def test_whole_act_and_lost_marks(spark):
    got = _one(spark, provisions.changed_units, "w całej ustawie wyraz", "uchyla się rozdział 3", "w art. 2 „bez końca art. 3", "w art. 2")
    assert [(g["whole"], g["unsure"]) for g in got] == [(True, False), (True, False), (False, True), (False, False)]


def _points(spark, text):
    (got,) = _one(spark, provisions.operative_part, text)
    return [(p["point"], p["mark"], p["keys"], p["act"], p["verdict"], p["limited"], p["partly"]) for p in got]


def test_negated_verdicts_and_patterns_of_review(spark):
    assert _points(spark, "orzeka: Art. 7 nie jest niezgodny z art. 32 i art. 2 Konstytucji.") == [(1, "Art.", ["7"], None, "valid", False, False)]
    assert _points(spark, "orzeka: Art. 7 jest niezgodny z art. 2; Art. 8 i 9 są zgodne z art. 32. Uzasadnienie Art. 5 jest niezgodny") == [
        (1, "Art.", ["7"], None, "void", False, False), (2, "Art.", ["8", "9"], None, "valid", False, False),
    ]
    assert _points(spark, "orzeka: Art. 7 jest nie zgodny z art. 2")[0][4] == "void" and _points(spark, "orzeka: Art. 7 traci moc")[0][4] == "void"
    assert _points(spark, "orzeka: umorzyć postępowanie") == [] and _points(spark, None) == []


def test_acts_named_before(spark):
    text = (
        "Wyrok z dnia 1 marca 2001 r. orzeka: I. Art. 12 ust. 3 ustawy z dnia 5 maja 1999 r. o drogach (Dz. U. Nr 1, poz. 2): a) jest zgodny z art. 16 Konstytucji, "
        "b) jest niezgodny z art. 2 Konstytucji. II. § 4 rozporządzenia Ministra w zakresie, w jakim pomija art. 9, nie jest niezgodny z art. 92 Konstytucji. "
        "III. Art. 14 ustawy powołanej w punkcie I jest zgodny z art. 7 Konstytucji. IV. Przepis wymieniony w części I traci moc z dniem 1 lipca. Ponadto postanawia: Art. 99 jest niezgodny"
    )
    act = "ustawy z dnia 5 maja 1999 r. o drogach"
    assert _points(spark, text) == [
        (1, "Art.", ["12"], act, "void", False, True), (2, "§", ["4"], "rozporządzenia Ministra", "valid", True, False),
        (3, "Art.", ["14"], act, "valid", False, False), (4, "Art.", ["12"], act, "void", False, True),
    ]


def test_scope_and_unexpanded_ranges(spark):
    (got,) = _one(spark, provisions.operative_part, "orzeka: Art. 459–478 ustawy - Kodeks spółek handlowych, rozumiane w ten sposób, są niezgodne z art. 2. 2. Art. 4¹–4⁹ są zgodne")
    assert [(len(p["keys"]), p["ranges"], p["limited"], p["verdict"]) for p in got] == [(20, [], True, "void"), (2, ["4^1..4^9"], False, "valid")]


def test_order_of_units(spark):
    keys = ["4", "4^1", "4^1a", "4^2", "4^10", "4a", "4a^1", "4b", "4za", "5", "40", "479^88a", "479^88b", "480", "1000"]
    rows = spark.createDataFrame([(k,) for k in random.Random(1).sample(keys, len(keys))], "k string")
    assert [r["k"] for r in rows.orderBy(provisions.unit_order(F.col("k"))).collect()] == keys
    assert _one(spark, provisions.unit_order, "x", "", None, "4-5") == [None] * 4


def test_ranges_against_all_pairs(spark):
    rng = random.Random(2)
    key = lambda: f"{rng.randint(1, 60)}{rng.choice(['', '', 'a', 'b'])}{rng.choice(['', '', '^1', '^2a'])}"
    asked = [(rng.randint(1, 3), key()) for _ in range(200)]
    ranges = [(rng.randint(1, 3), key(), key()) for _ in range(100)]
    a, r = spark.createDataFrame(asked, "act int, article string"), spark.createDataFrame(ranges, "act int, low string, high string")
    made = provisions.within_ranges(a, r, ["act"], cell=8)
    order = {k: o for k, o in a.select("article").unionByName(r.select(F.col("low").alias("article"))).unionByName(r.select(F.col("high").alias("article"))).select("article", provisions.unit_order(F.col("article"))).collect()}
    want = sorted((x, k, lo, hi) for x, k in asked for y, lo, hi in ranges if x == y and order[lo] <= order[k] <= order[hi])
    assert sorted(tuple(x) for x in made.select("act", "article", "low", "high").collect()) == want
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_currency(spark):
    day = F.lit("2024-01-01").cast("date")
    schema = "act int, amendment int, article string, low string, high string, whole boolean, unsure boolean, entry string"
    changes = [
        (1, 1, "5", None, None, False, False, "2023-01-01"), (1, 2, "6", None, None, False, False, "2025-01-01"), (1, 3, None, "479^88a", "479^88j", False, False, None),
        (1, 4, "7", None, None, False, False, "2023-01-01"), (2, 5, None, None, None, True, False, "2023-01-01"), (3, 6, None, None, None, False, True, "2025-01-01"),
    ]
    changes = spark.createDataFrame(changes, schema).withColumn("entry", F.col("entry").cast("date"))
    asked = spark.createDataFrame([(1, a) for a in ("5", "6", "7", "8", "479^88c", "479^88k", "479")] + [(2, "1"), (3, "1"), (4, "1")], "act int, article string")
    got = provisions.currency(asked, changes, spark.createDataFrame([(1, 4)], "act int, amendment int"), spark.createDataFrame([(1,), (2,), (3,)], "act int"), day)
    assert {(r["act"], r["article"]): r["verdict"] for r in got.collect()} == {
        (1, "5"): "CHANGED", (1, "6"): "PENDING", (1, "7"): "CURRENT", (1, "8"): "CURRENT", (1, "479^88c"): "CHANGED", (1, "479^88k"): "CURRENT", (1, "479"): "CURRENT",
        (2, "1"): "UNSURE", (3, "1"): "PENDING", (4, "1"): "UNSURE",
    }


def test_currency_against_all_pairs(spark):
    rng = random.Random(5)
    key = lambda: f"{rng.randint(1, 40)}{rng.choice(['', '', '', 'a'])}{rng.choice(['', '', '', '^1', '^2a'])}"
    some = lambda v, none=0.1: None if rng.random() < none else v
    changes = []
    for _ in range(400):
        article, low, high = rng.choice([(key(), None, None), (None, key(), key()), (key(), key(), key()), (None, key(), None), (None, None, None), ("x", None, None)])
        changes.append((some(rng.randint(1, 12), 0.03), some(rng.randint(1, 9)), article, low, high, rng.random() < 0.04, some(rng.random() < 0.04), some(rng.randint(1, 9))))
    asked = [(some(rng.randint(1, 14), 0.03), some(key(), 0.05)) for _ in range(300)] + [(1, "x"), (2, "x"), (3, "1^x")]
    contained, checked = [(rng.randint(1, 12), rng.randint(1, 9)) for _ in range(15)], [(a,) for a in range(1, 14, 2)] + [(1,), (None,)]
    made = spark.createDataFrame(changes, "act int, amendment int, article string, low string, high string, whole boolean, unsure boolean, entry int")
    given = spark.createDataFrame(asked, "act int, article string"), made, spark.createDataFrame(contained, "act int, amendment int"), spark.createDataFrame(checked, "act int"), F.lit(5)
    keys = sorted({k for c in changes for k in c[2:5] if k} | {k for _, k in asked if k})
    order = dict(zip(keys, _one(spark, provisions.unit_order, *keys), strict=True))
    want = set()
    for act, article in set(asked):
        now, later, vague = set(), set(), set()
        for a, amendment, named, low, high, whole, unsure, entry in changes:
            if a is None or a != act or (a, amendment) in contained:
                continue
            ahead = entry is not None and entry > 5
            between = None not in (low, high, article) and order[article] is not None and order[low] <= order[article] <= order[high]
            if amendment is not None and (named == article if named is not None else between):
                (later if ahead else now).add(amendment)
            if whole or unsure:
                vague.add(ahead)
        known = (act,) in checked and act is not None
        verdict = "CHANGED" if now else "UNSURE" if False in vague or not known else "PENDING" if later or vague else "CURRENT"
        want.add((act, article, verdict, len(now), len(later)))
    for cell in (3, 16):
        got = [tuple(r) for r in provisions.currency(*given, cell=cell).select("act", "article", "verdict", "now", "later").collect()]
        assert len(got) == len(want) and set(got) == want


def test_currency_reads_texts_once(spark):
    acts = spark.createDataFrame([(1, 2, "w art. 3", 1)], "act int, amendment int, t string, entry int")
    asked, none = spark.createDataFrame([(1, "3")], "act int, article string"), spark.createDataFrame([], "act int, amendment int")
    made = provisions.currency(asked, provisions.change_rows(acts, F.col("t")), none, asked.select("act"), F.lit(5))
    assert [tuple(r) for r in made.collect()] == [(1, "3", "CHANGED", 1, 0)]
    plan = made._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert plan.count("ArrowEvalPython") == 1 and "NestedLoop" not in plan


def test_rows_of_changes(spark):
    acts = spark.createDataFrame([(1, "w art. 3 i art. 5¹–5³"), (2, "w całej ustawie"), (3, "nic"), (4, None)], "act int, t string")
    got = sorted((r["act"], r["article"] or "", r["low"] or "", r["whole"], r["unsure"]) for r in provisions.change_rows(acts, F.col("t")).collect())
    assert got == [(1, "", "5^1", False, False), (1, "3", "", False, False), (1, "5^1", "", False, False), (1, "5^3", "", False, False), (2, "", "", True, False), (3, "", "", False, True), (4, "", "", False, True)]


def test_what_an_act_is_about_is_not_its_part(spark):
    got = _one(spark, identifiers.voided_units, "nieważność uchwały dotyczącej zmiany § 7 statutu", "nieważność uchwały nr X w części dotyczącej § 3 pkt 2", "nieważność § 3 ust. 1 oraz § 9 załącznika do uchwały", None)
    assert got == [[], ["§ 3"], ["§ 3", "§ 9"], []]


def test_lists_in_folds_are_those_of_columns(spark):
    said = ["5, 6 i 8", "art. 459–478", "4 1–4 9b", "479 88a - 479 88j ORAZ Art. 3", "007–9", "9–7", "1–402", "99999999999", "", "x", "12A i 12 B c"]
    rows = spark.createDataFrame([(s,) for s in said], "s string").select(identifiers.unit_list(F.regexp_replace("s", r"(?i)art\.\s*", "")).alias("u")).collect()
    assert [(sorted(k), r) for k, r in map(identifiers.units_of, said)] == [(list(r["u"]["keys"]), list(r["u"]["ranges"])) for r in rows]
    texts = ["art. 4¹ i a²b", "Art. 4(1a), art.5^2", "(3) ^4 ⁵ 7⁸9", "ART. 130(1A)"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(identifiers.plain_numbers(F.col("t")).alias("p")).collect()
    assert [identifiers.plain_numbers_of(t) for t in texts] == [r["p"] for r in rows]


def test_texts_of_changes_are_read_once_for_rows(spark):
    acts = spark.createDataFrame([(1, "w art. 3 i 5")], "act int, t string")
    plan = provisions.change_rows(acts, F.col("t"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
