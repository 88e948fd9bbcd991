"""Operator 6: personal data by candidate generation and boosted trees. DataFrame functions only.

High-recall generators propose spans of several kinds, which may overlap; a small gradient-boosted model over format and context
features scores the proposals of the method's own kinds, and a threshold for each kind, calibrated on a held-out half, selects
the spans to redact. The base kinds (email, ip, card, phone) have exact definitions and always stay.

The model is fitted on all candidates: they are first counted by feature vector, a table bounded by the product of the feature
cardinalities (see FEATURES), and the trees are compiled to a Column of CASE expressions. Weak labels come from checks that are no
features (check digits, number plans, mixed alphabets). A kind whose held-out half is empty or never reaches the wished precision has
the threshold of an even chance, and a number with right check digits (iban) is always selected.

Edge cases: a null text counts as empty; a text without spans has counts 0, the digest of the empty string and spans ''; rows that
repeat a doc_id each get a row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import Scratch, let

# The patterns match the same text as the contract's, and are written so that no text makes Java's matcher recurse or go back far:
# runs are taken once from their first character, and \G lets a match begin where the last one ended.
_LOCAL = r"[A-Za-z0-9._%+-]"
EMAIL = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
NATIONAL = r"(?<![0-9+.-])(?<!\+[0-9]{1,3}[\x20.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.\x20-])[0-9]{3}[.\x20-][0-9]{4}(?![0-9])"
SOCIAL = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
# Characters of an international account number by country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC", 32: "LC", 33: "RU",
}
SECRET = r"(?i)(?<![a-z0-9])(?:token|secret|password|passwd|pwd|api[_-]?key|access[_-]?key)\x20{0,3}[:=]\x20{0,3}[\"']?[a-z0-9_/+=-]{8,}+"

#: kind, pattern, what every match has (a cheap test before the pattern runs: a character, or a pattern of one), base kind
KINDS = (
    ("email", EMAIL, "@", True),
    ("ip", IP, ".", True),
    ("card", CARD, "[0-9]", True),
    ("phone", PHONE, "+", True),
    ("national_phone", NATIONAL, "[0-9]", False),
    ("social_number", SOCIAL, "-", False),
    ("iban", IBAN, "[0-9]", False),
    ("secret", SECRET, "[:=]", False),
)
ORDER = {k: i for i, (k, *_) in enumerate(KINDS)}
#: Cardinalities of the features; their product bounds the table that reaches the driver (5184 rows for each label and half).
FEATURES = {"kind": len(KINDS), "digits": 6, "length": 4, "cue": 3, "before": 3, "after": 3}
ROUNDS, RATE, PRECISION = 12, 0.4, 0.9
#: The log odds that select a span where calibration has nothing to go by.
EVEN = 0.0


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """True if a string of digits passes the Luhn check."""
    number = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise((c.cast("int") * 2) % 10 + F.floor(c.cast("int") * 2 / 10).cast("int")))
    return F.aggregate(F.filter(number, lambda x: x.isNotNull()), F.lit(0), lambda a, x: a + x) % 10 == 0


def _found(text: Column, pattern: str, char: str) -> Column:
    """Matches in order: array of (gap, hit, before, after); gap is the number of code points since the last match."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    out = let(F.split(text, pattern, -1), lambda gaps: F.transform(hits, lambda h, i: F.struct(
        F.char_length(gaps[i]).cast("long").alias("gap"), h.alias("hit"),
        F.right(gaps[i], F.lit(24)).alias("before"), F.left(gaps[i + 1], F.lit(8)).alias("after"))))
    test = F.contains(text, F.lit(char)) if len(char) == 1 else text.rlike(char)
    return F.when(test, out).otherwise(F.array().cast("array<struct<gap:bigint,hit:string,before:string,after:string>>"))


def candidates(docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(uid, doc_id) of every document, and its candidate spans (uid, kind, k, start, end, hit, before, after, ok)."""
    text = docs.select("doc_id", F.monotonically_increasing_id().alias("uid"), F.coalesce("text", F.lit("")).alias("text"))
    lists = scratch.write(text.select("doc_id", "uid", *[_found(F.col("text"), p, c).alias(k) for k, p, c, _ in KINDS]))
    per = None
    for kind, *_ in KINDS:
        one = lists.where(F.size(kind) > 0).select("uid", F.posexplode(kind).alias("i", "x")).select("uid", F.lit(kind).alias("kind"), "i", "x.*")
        per = one if per is None else per.unionByName(one)
    so_far = Window.partitionBy("uid", "kind").orderBy("i")
    n = F.char_length("hit").cast("long")
    per = per.withColumn("end", F.sum(F.col("gap") + n).over(so_far)).withColumn("start", F.col("end") - n)
    # what follows an account number and looks like a part of it is not
    per = per.withColumn("hit", F.when(F.col("kind") == "iban", _cut_iban(F.col("hit"))).otherwise(F.col("hit"))).withColumn("end", F.col("start") + n)
    d = _digits(F.col("hit"))
    groups = F.split("hit", r"\.")
    ok = (
        F.when(F.col("kind") == "email", F.lit(True))
        .when(F.col("kind") == "ip", F.forall(groups, lambda g: F.char_length(F.regexp_replace(g, "^0+(?=[0-9])", "")) <= 3) & F.forall(groups, lambda g: F.coalesce(F.right(g, F.lit(9)).try_cast("int"), F.lit(999)) <= 255))
        .when(F.col("kind") == "card", F.char_length(d).between(12, 19) & luhn(d))
        .when(F.col("kind") == "phone", F.char_length(d).between(9, 15))
        .when(F.col("kind") == "national_phone", ~F.substring(d, 1, 1).isin("0", "1") & (F.char_length(d) == 10))
        .when(F.col("kind") == "social_number", ~F.substring(d, 1, 3).isin("000", "666") & (F.substring(d, 1, 1) != "9") & (F.substring(d, 4, 2) != "00") & (F.substring(d, 6, 4) != "0000"))
        .when(F.col("kind") == "iban", _iban(F.col("hit")))
        .otherwise(_random(F.regexp_extract("hit", r"[:=]\x20{0,3}[\"']?(.*)$", 1)))
    )
    return lists.select("uid", "doc_id"), scratch.write(per.select("uid", "kind", "start", "end", "hit", "before", "after", ok.alias("ok")))


def _random(value: Column) -> Column:
    """Weak label of a secret: letters and digits mixed, capitals inside, or many different characters for a word."""
    kinds = sum((value.rlike(p).cast("int") for p in ("[a-z]", "[A-Z]", "[0-9]", "[_/+=-]")), F.lit(0))
    return value.rlike("[A-Za-z]") & ((kinds > 1) | (F.size(F.array_distinct(F.split(value, ""))) >= 7))


def _cut_iban(hit: Column) -> Column:
    """The first characters of hit, as many as its country's numbers have; all of it for an unknown country or if it has fewer."""
    length = {n: F.substring(hit, 1, 2).isin(*countries.split()) for n, countries in IBAN_LENGTHS.items()}
    cut = F.coalesce(*[F.when(c, F.regexp_extract(hit, rf"^[A-Z0-9](?:\x20?[A-Z0-9]){{{n - 1}}}", 0)) for n, c in length.items()], F.lit(""))
    return F.when(cut == "", hit).otherwise(cut)


def _iban(hit: Column) -> Column:
    """ISO 13616 check: the rearranged number is 1 modulo 97."""
    s = F.regexp_replace(hit, " ", "")
    s = F.concat(F.substring(s, 5, 64), F.substring(s, 1, 4))
    value = lambda c: F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55)
    chars = F.filter(F.split(s, ""), lambda c: c != "")
    return F.aggregate(chars, F.lit(0), lambda a, c: F.when(value(c) > 9, a * 100 + value(c)).otherwise(a * 10 + value(c)) % 97) == 1


def _features() -> dict[str, Column]:
    """Format and context of a candidate, each a small integer."""
    n, size = F.char_length(_digits(F.col("hit"))), F.char_length("hit")
    bucket = lambda x, *cuts: sum(((x >= c).cast("int") for c in cuts), F.lit(0))
    cue = F.lower("before")
    side = lambda s: F.when(s == "", 0).when(s.rlike(r"^[\x20\n,;:()\"]$"), 1).otherwise(2)
    return {
        "kind": F.coalesce(*[F.when(F.col("kind") == k, i) for k, i in ORDER.items()]),
        "digits": bucket(n, 1, 9, 10, 12, 16),
        "length": bucket(size, 12, 16, 40),
        "cue": F.when(cue.rlike(r"(?:tel|phone|call|fax|mobile|ssn|social|iban|account|card|mail|contact)"), 1).when(cue.rlike(r"(?:no|nr|id|ref|order|version|isbn)[.:#\x20]*$"), 2).otherwise(0),
        "before": side(F.right("before", F.lit(1))),
        "after": side(F.left("after", F.lit(1))),
    }


def _boost(rows: list[tuple]) -> tuple[float, list]:
    """Gradient boosting of depth-two trees on (feature values, positives, negatives); counts are weights."""
    names = list(FEATURES)
    total, pos = sum(p + q for _, p, q in rows), sum(p for _, p, _ in rows)
    base = math.log((pos + 1) / (total - pos + 1))
    score, trees = [base] * len(rows), []

    def leaf(items):
        g = h = 0.0
        for i in items:
            p, q = rows[i][1], rows[i][2]
            y = 1 / (1 + math.exp(-score[i]))
            g, h = g + p - (p + q) * y, h + (p + q) * y * (1 - y)
        return g, h

    def best(items):
        g0, h0 = leaf(items)
        top = (0.0, None, None)
        for f, name in enumerate(names):
            for v in range(FEATURES[name]):
                inside = [i for i in items if rows[i][0][f] == v]
                if 0 < len(inside) < len(items):
                    g, h = leaf(inside)
                    gain = g * g / (h + 1) + (g0 - g) ** 2 / (h0 - h + 1) - g0 * g0 / (h0 + 1)
                    if gain > top[0] + 1e-9:
                        top = (gain, f, v)
        return top[1:]

    def step(items):
        g, h = leaf(items)
        return RATE * g / (h + 1)

    for _ in range(ROUNDS):
        everything = list(range(len(rows)))
        f, v = best(everything)
        if f is None:
            break
        tree = []
        for yes in (True, False):
            part = [i for i in everything if (rows[i][0][f] == v) == yes]
            g, w = best(part)
            if g is None:
                tree.append((None, None, step(part), 0.0))
            else:
                tree.append((g, w, step([i for i in part if rows[i][0][g] == w]), step([i for i in part if rows[i][0][g] != w])))
        trees.append((f, v, tree))
        for i in everything:
            score[i] += _tree(trees[-1], rows[i][0])
    return base, trees


def _tree(tree, x) -> float:
    f, v, (yes, no) = tree
    g, w, a, b = yes if x[f] == v else no
    return a if g is None or x[g] == w else b


def _compiled(base: float, trees: list, cols: list[Column]) -> Column:
    out = F.lit(float(base))
    for f, v, sides in trees:
        yes, no = (F.lit(a) if g is None else F.when(cols[g] == w, a).otherwise(b) for g, w, a, b in sides)
        out = out + F.when(cols[f] == v, yes).otherwise(no)
    return out


def select_spans(found: DataFrame) -> DataFrame:
    """found plus keep: base kinds by their checks, the method's kinds by the boosted score and their threshold."""
    feats = _features()
    table = found.select(*[c.alias(n) for n, c in feats.items()], (F.abs(F.xxhash64("uid", "start")) % 2).alias("half"), "ok")
    counts = table.groupBy(*feats, "half").agg(F.count_if("ok").alias("p"), F.count_if(~F.col("ok")).alias("q")).collect()  # bounded: see FEATURES
    rows = [(tuple(r[n] for n in feats), r["p"], r["q"]) for r in sorted(counts) if r["half"] == 0]
    base, trees = _boost(rows) if rows else (0.0, [])
    cuts = {}
    for kind, i in ORDER.items():
        held = sorted(((base + sum(_tree(t, x) for t in trees), r["p"], r["q"]) for r in counts if r["half"] == 1 and r["kind"] == i for x in [tuple(r[n] for n in feats)]), reverse=True)
        good = bad = 0
        cuts[kind] = EVEN
        for s, p, q in held:
            good, bad = good + p, bad + q
            if good >= PRECISION * (good + bad):
                cuts[kind] = s
    score = _compiled(base, trees, list(feats.values()))
    own = F.lit(False)
    for kind, _, _, is_base in KINDS:
        if not is_base:
            own = own | ((F.col("kind") == kind) & (score >= cuts[kind] - 1e-9))
    own = own | ((F.col("kind") == "iban") & F.col("ok"))
    is_base = F.col("kind").isin([k for k, _, _, b in KINDS if b])
    return found.withColumn("keep", F.when(is_base, F.col("ok")).otherwise(own))


def detect(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_spans (how many)."""
    scratch = Scratch(docs.sparkSession)
    everyone, found = candidates(docs.select("doc_id", "text"), scratch)
    rank = F.coalesce(*[F.when(F.col("kind") == k, i) for k, i in ORDER.items()])
    kept = select_spans(found).where("keep")
    item = F.struct("start", rank.alias("rank"), F.concat_ws(":", "kind", "start", "end").alias("said"))
    join = lambda arr: F.array_join(F.transform(F.array_sort(arr), lambda s: s["said"]), ",")
    base = [k for k, _, _, b in KINDS if b]
    per = kept.groupBy("uid").agg(
        *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in base],
        join(F.collect_list(F.when(rank < len(base), item))).alias("base"), join(F.collect_list(item)).alias("spans"), F.count("*").alias("n_spans"),
    )
    return everyone.join(per, "uid", "left").select(
        "doc_id", *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"), F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
    )


def redact(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """docs with each span of detect()'s spans replaced by [KIND]; overlapping spans become one.

    Rows are matched by doc_id, null to null. Of rows that repeat a doc_id each must have the same text; if they have several, redact them apart.
    """
    parts = F.transform(F.filter(F.split("spans", ","), lambda s: s != ""), lambda s: F.split(s, ":"))
    step = lambda acc, s: F.struct(
        F.when(s[1].cast("long") >= acc["at"], F.concat(acc["out"], F.substring(acc["text"], acc["at"].cast("int") + 1, (s[1].cast("long") - acc["at"]).cast("int")), F.lit("["), F.upper(s[0]), F.lit("]"))).otherwise(acc["out"]).alias("out"),
        F.greatest(acc["at"], s[2].cast("long")).alias("at"), acc["text"].alias("text"))
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"), F.col("row.text").alias("text"))
    done = F.aggregate(parts, start, step, lambda acc: F.concat(acc["out"], F.substring(acc["text"], acc["at"].cast("int") + 1, 2**31 - 1)))
    found = spans.where("spans != ''").groupBy(F.col("doc_id").alias("id")).agg(F.first("spans").alias("spans"))
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    both = packed.join(found, F.col("row.doc_id").eqNullSafe(F.col("id")), "left")
    text = F.when(F.col("spans").isNull(), F.col("row.text")).otherwise(done)
    return both.select(*[text.alias("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])
