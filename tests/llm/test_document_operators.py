"""Operators on documents, each held against a plain form on awkward rows: nulls, empty and long texts, ties, copies, odd columns."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from statuta.llm import buckets, exact_dedup, licenses, line_dedup, mixing, packing, pii, quality, registry, similar

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile("[^\x20\x09-\x0d]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, kept string, node int"


def _texts():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8)))
    base = [" ".join(word() for _ in range(n)) for n in (3, 5, 7, 12, 30, 60, 60, 200, 900)]
    out = [None, "", " \n\t", "a", "A  b", "a b", "\x0b", "é ÉÉ ünder", *base, *base[:5]]
    for text in base[4:]:
        for share in (0.01, 0.03, 0.05):
            out.append(" ".join(word() if rng.random() < share else w for w in text.split()).upper())
    common = " ".join(word() for _ in range(70))
    out += [f"{common}\n{' '.join(word() for _ in range(n))}" for n in (5, 10, 80, 300)]
    out += ["x " * 40_000, "Under the MIT License. under the mit license", "Apache License, Version 2.0 CC BY-NC", "GNU General Public License, version 3"]
    out += ["a@b.c%d@e.f x.@y.z", "1.2.3.4.5.6.7.8 999.1.1.1 01.002.3.4", "4111 1111 1111 1111, 4111-1111-1111-1112", "+1 (310) 555-4510) +12 +1-2-3", "é 4111 1111 1111 1111\U0001f600 a@b.co", "call 212-555-1234"]
    out += ["It's DON'T we'll a1b2 <|startoftext|> x", "<|STARTOFTEXT|> İstanbul ΣΑΣ", "\x1ca\x1d b\x7f c!!'s \x85 d e"]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", (None, "b", "a", "\U0001f600", "Z")[i % 5], 1, 7, "x", 3) for i, t in enumerate(_texts())]
    rows += [rows[9], rows[12]]  # repeated rows
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def _rows(docs):
    return [(r["doc_id"], r["text"]) for r in docs.collect()]


def _find(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


def test_exact_dedup(docs):
    groups = defaultdict(list)
    for i, t in _rows(docs):
        groups[re.sub("[\x20\x09-\x0d]+", " ", t or "")].append(i)
    want = sorted((i, min(g), len(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for i in g)
    got = exact_dedup.exact_dedup(docs, block=64).collect()
    assert sorted((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == want
    assert sum(r["kept"] for r in got) == len(groups)


def test_ngram_join(docs):
    sets = {}
    for i, t in _rows(docs):
        w = WORD.findall((t or "").translate(LOWER))
        sets[i] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}
    parent = {i: i for i in sets}
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = _find(parent, a), _find(parent, b)
                parent[max(x, y)] = min(x, y)
    want = sorted((i, len(sets[i]), _find(parent, i)) for i, _ in _rows(docs))
    assert sorted(tuple(r) for r in similar.linked_components(docs).collect()) == want


def test_ngram_join_of_a_hot_group(spark):
    """Many near copies of one text and of its neighbours: one component, and no pair of unlike texts."""
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    text = [word() for _ in range(120)]
    near = [" ".join([*text[:j], word(), *text[j + 1 :]]) for j in range(100)]
    other = [" ".join(text[:60] + [word() for _ in range(60)]) for _ in range(60)]
    got = similar.linked_components(spark.createDataFrame(list(enumerate(near + other)), "doc_id long, text string")).collect()
    named = {r["doc_id"]: r["component_id"] for r in got}
    assert {named[i] for i in range(100)} == {0}
    assert all(named[i] == i for i in range(100, 160))


def test_sketches_lose_no_link():
    """Whatever two linked sets are, they emit a common key."""
    rng = np.random.default_rng(3)
    for _ in range(1500):
        n = int(rng.integers(1, 120))
        a = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        drop, add = rng.integers(0, 1 + n // 8, 2)
        b = np.unique(np.concatenate([a[drop:], rng.integers(0, 2**64, add, dtype=np.uint64)]))
        both = len(np.intersect1d(a, b))
        if 100 * both >= 80 * (len(a) + len(b) - both):
            keys = [set(np.concatenate([similar.sketch(x, s, d) for s, d in similar.bands(len(x))]).tolist()) for x in (a, b)]
            assert keys[0] & keys[1]


def test_mixing(docs):
    plan = mixing.plan(docs).collect()
    size = Counter()
    sources = {r["doc_id"]: r["source"] for r in docs.collect()}
    for i, t in _rows(docs):
        size[sources[i]] += len(WORD.findall(t or ""))
    order = [s for s in sorted(size, key=lambda s: (s is None, s or ""))]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    goal, left, free = {}, 1.5 * sum(size.values()), set(order)
    while True:
        level = left / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > 2 * size[s]]
        if not over:
            break
        for s in over:
            goal[s] = 2.0 * size[s]
            left -= goal[s]
            free.remove(s)
    goal |= {s: level * weight[s] for s in free}
    for r in plan:
        s = sources[r["doc_id"]]
        assert r["source_size"] == size[s] and abs(r["target"] - goal[s]) < 1e-6 * max(1, goal[s])
        assert r["taken"] in (0, r["size"], 2 * r["size"])
    assert sorted(map(tuple, mixing.plan(docs.repartition(5)).collect())) == sorted(map(tuple, plan))
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and mixed.agg(F.sum(mixing.word_count(F.col("text")))).first()[0] == sum(r["taken"] for r in plan)


def test_licences(docs):
    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    want = []
    for i, t in _rows(docs):
        w = word.findall((t or "").translate(LOWER))
        places = sorted((j, label) for label, phrase in licenses.BASE for j in range(len(w)) if w[j : j + len(phrase.split())] == phrase.split())
        at = [j for j, _ in places]
        want.append((i, len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))))
    rows = licenses.scan(docs).collect()
    key = lambda r: tuple((x is None, x if x is not None else 0) for x in r)
    assert sorted((tuple(r[:6]) for r in rows), key=key) == sorted(want, key=key)
    assert all(set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1 for r in rows)
    assert "gpl-3" in {r["labels"] for r in rows}


def _luhn(digits):
    return sum(int(c) if i % 2 == 0 else (2 * int(c)) % 10 + (2 * int(c)) // 10 for i, c in enumerate(reversed(digits))) % 10 == 0


def test_personal_data(docs, spark):
    digits = lambda s: re.sub("[^0-9]", "", s)
    kinds = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(x) <= 255 for x in s.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 12 <= len(digits(s)) <= 19 and _luhn(digits(s))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15),
    )
    rng = random.Random(2)
    noise = ["".join(rng.choice("0123456789+-. ()@a.%") for _ in range(300)) for _ in range(60)]
    all_docs = docs.select("doc_id", "text").union(spark.createDataFrame([(1000 + i, t) for i, t in enumerate([*noise, "1" * 30_000, "1 " * 30_000, "a" * 100_000 + "@"])], "doc_id long, text string"))
    want = []
    for i, t in _rows(all_docs):
        found = [[(m.start(), k, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(p, t or "") if ok(m.group())] for k, (kind, p, ok) in enumerate(kinds) if not (t or "").startswith("aaaa")] or [[]] * 4
        said = ",".join(s for *_, s in sorted(sum(found, [])))
        want.append((i, *map(len, found), hashlib.sha256(said.encode()).hexdigest()))
    rows = pii.detect(all_docs).collect()
    assert sorted(tuple(r[:6]) for r in rows) == sorted(want)
    unique = all_docs.dropDuplicates(["doc_id"])
    clean = pii.redact(unique, pii.detect(unique)).where("text like '%[CARD]%'").count()
    assert clean == len({w[0] for w in want if w[3]})


def test_packing(docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(registry.tokenizer_path())
    want = []
    for i, t in _rows(docs):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        for n, at in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[at : at + 4096], "<u4")
            want.append((i, n, at, len(part), zlib.crc32(part.tobytes())))
    rows = packing.pack(docs, registry.tokenizer_path()).collect()
    assert sorted(tuple(r[:5]) for r in rows) == sorted(want)
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for b in bins.values():
        assert [o for o, _ in sorted(b)] == [sum(n for _, n in sorted(b)[:k]) for k in range(len(b))] and sum(n for _, n in b) <= 4096
    assert len(bins) == _best_fit([r["length"] for r in rows], 4096)


def _best_fit(lengths, capacity):
    """Number of sequences of best-fit decreasing, by search through a list."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        fit = min((r for r in rooms if r >= n), default=None)
        if fit is None:
            rooms.append(capacity - n)
        else:
            rooms[rooms.index(fit)] -= n
    return len(rooms)


@pytest.mark.parametrize("seed, capacity, most, pieces", [(0, 4096, 4096, 3000), (1, 4096, 300, 3000), (2, 64, 64, 4000), (3, 100, 40, 1), (4, 7, 7, 500), (5, 4096, 1500, 4000)])
def test_best_fit_decreasing_is_tight(seed, capacity, most, pieces):
    """As many sequences as best fit piece by piece, gapless and disjoint, with a plan within its bound."""
    lengths = np.random.default_rng(seed).integers(1, most + 1, pieces)
    counts = Counter(lengths.tolist())
    plan = packing.best_fit_decreasing(counts, capacity)
    ranks = np.empty(pieces, np.int64)
    for n in counts:
        ranks[lengths == n] = np.arange(counts[n])
    sequence, offset = packing.placed(plan, lengths, ranks)
    assert len(set(sequence.tolist())) == _best_fit(lengths.tolist(), capacity)
    assert len(plan) <= 13 * 4 * capacity
    filled = defaultdict(list)
    for q, o, n in zip(sequence.tolist(), offset.tolist(), lengths.tolist(), strict=True):
        filled[q].append((o, n))
    for b in filled.values():
        b.sort()
        assert [o for o, _ in b] == [sum(n for _, n in b[:k]) for k in range(len(b))] and sum(n for _, n in b) <= capacity


def test_packing_keeps_ids(spark):
    """Ids of 60 bits beside a null one, and repeated rows."""
    ids = [2**60 + 1, None, 2**60 + 3, 2**60 + 3, -5]
    docs = spark.createDataFrame([(i, f"text {k % 3}") for k, i in enumerate(ids)], "doc_id long, text string")
    rows = packing.pack(docs, registry.tokenizer_path()).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(ids) and len({(r["sequence_id"], r["offset"]) for r in rows}) == 5


def test_exact_dedup_of_long_texts(spark):
    """Many levels of names; texts that differ in one block only stay apart, whatever the order of rows."""
    blocks = ["".join(random.Random(k).choices("ab", k=4)) for k in range(12)]
    texts = ["".join(blocks[(i * i + j) % 12] for j in range(37 + i % 2)) for i in range(60)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts + texts[::3])], "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in exact_dedup.exact_dedup(docs, block=4).collect()}
    every = texts + texts[::3]
    assert got == {i: (every.index(t), every.count(t)) for i, t in enumerate(every)}


def test_keep_first_of_rows_without_a_doc_id_of_their_own(spark):
    rows = [(1, "a  b", 5), (1, "a b", 5), (1, "other", 6), (None, "a b", 7), (None, "none", 8), (None, "none", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `a.b` int").coalesce(1)
    out = exact_dedup.keep_first(docs)
    assert out.columns == docs.columns
    assert sorted((r[0] or 0, r[1], r[2]) for r in out.collect()) == [(0, "none", 8), (1, "a  b", 5), (1, "other", 6)]


def _check_digits(country, body):
    number = "".join(str(int(c, 36)) for c in body + country + "00")
    return f"{country}{98 - int(number) % 97:02d}{body}"


def test_own_spans_of_personal_data(spark):
    """Planted spans of the method's kinds: 0.9 or more are found in each kind, whole, and numbers that only look alike mostly stay."""
    rng = random.Random(11)
    digits = lambda n, first="123456789": rng.choice(first) + "".join(rng.choice("0123456789") for _ in range(n - 1))
    key = lambda n: "a1" + "".join(rng.choice("abcdefghijkABCDEFGHIJK0123456789") for _ in range(n - 2))
    cues = ["token", "API_KEY", "Password", "secret", "PASSWD", "api-key"]
    make = {
        "national_phone": lambda: f"call {{}}{digits(3, '23456789')}-{digits(3, '23456789')}-{digits(4)}",
        "social_number": lambda: f"ssn {{}}{rng.randint(100, 665)}-{rng.randint(10, 99)}-{rng.randint(1000, 9999)}",
        "iban": lambda: f"account {{}}{_check_digits('DE', digits(18))}",
        "secret": lambda: f"set {{}}{rng.choice(cues)}{rng.choice([' = ', '=', ': '])}{key(rng.choice([12, 40, 700]))}",
    }
    rows, planted = [], defaultdict(set)
    for i in range(400):
        text = f"Some words before é {i}. "
        for kind in rng.sample(sorted(make), 2):
            lead, hit = make[kind]().split("{}")
            text += lead
            planted[kind].add((i, f"{kind}:{len(text)}:{len(text) + len(hit)}"))
            text += hit + " and more. "
        rows.append((i, text))
    false = [(1000 + i, f"Order no. 000-{digits(2)}-{digits(4)}, ref 012-{digits(3)}-{digits(4)}, DE{digits(20)} and total 12.50") for i in range(200)]
    got = pii.detect(spark.createDataFrame(rows + false, "doc_id long, text string")).collect()
    found = {(r["doc_id"], s) for r in got for s in r["spans"].split(",") if s}
    assert all(r["n_spans"] == len([s for s in r["spans"].split(",") if s]) for r in got)
    for kind, wanted in planted.items():
        assert len(wanted & found) >= 0.9 * len(wanted), kind
    assert sum(i >= 1000 and not s.startswith(("card", "phone")) for i, s in found) <= 0.1 * 3 * len(false)


def test_few_documents_with_own_spans(spark):
    """Nothing to calibrate on: an even chance is enough."""
    texts = ["API_KEY=abcdefgh12345678", "x", "call 212-555-1234 now", "pay DE89370400440532013000", None]
    got = {r["doc_id"]: r["spans"].split(":")[0] for r in pii.detect(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got == {0: "secret", 1: "", 2: "national_phone", 3: "iban", 4: ""}


def test_redaction_of_rows_without_a_doc_id(spark):
    docs = spark.createDataFrame([(None, "mail a@b.co", 1), (3, "mail a@b.co, a@c.de", 2), (4, None, 3), (5, "none", 4)], "doc_id long, text string, spans int")
    out = pii.redact(docs, pii.detect(docs))
    assert out.columns == docs.columns
    assert {r["spans"]: r["text"] for r in out.collect()} == {1: "mail [EMAIL]", 2: "mail [EMAIL], [EMAIL]", 3: None, 4: "none"}


def _shingles(line):
    """Nine characters from each start: a word's first, its ninth where it has nine to sixteen, every one of a longer word up to the last eight, and each other character."""
    out, at, word = set(), 0, lambda c: "!" <= c <= "\u0dff"
    while at < len(line):
        out.add(line[at : at + 9])
        end = at
        while end < len(line) and word(line[end]):
            end += 1
        left = end - at
        if left > 8:
            left = 8 if left <= 16 and (at == 0 or not word(line[at - 1])) else 1
        at += max(1, left)
        at += line[at : at + 1] == " "
    return out


def _line_decisions(rows):
    """(doc_id, line_no, keep_doc_id, keep_line_no, kept) of rows in order, all pairs of different lines compared."""
    lines = [(i, k, line.lower().strip(" ")) for i, t in rows for k, line in enumerate((t or "").split("\n"))]
    sets = {x: _shingles(x) for _, _, x in lines if not re.fullmatch(r"\s*", x)}
    parent = {x: x for x in sets}
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 5 * both >= 4 * (len(sets[a]) + len(sets[b]) - both):
                parent[_find(parent, b)] = _find(parent, a)
    seen, out = {}, []
    for n, (i, k, x) in enumerate(lines):
        first = seen.setdefault(_find(parent, x), (i, k, n)) if x in sets else (i, k, n)
        out.append((i, k, *first[:2], first[2] == n))
    return out


def test_line_dedup(docs):
    rows = sorted(_rows(docs), key=lambda r: r[0])
    assert len(rows) > len(set(rows))
    want = _line_decisions(rows)
    assert sorted(tuple(r[1:]) for r in line_dedup.decisions(docs).collect()) == sorted(want)
    left = Counter(r["doc_id"] for r in line_dedup.dedup_lines(docs).collect())
    assert left[0] == left[1] == 1 and set(left) == {w[0] for w in want if w[4]} and max(left.values()) == 1


def test_line_dedup_of_a_frequent_line_and_its_variants(spark):
    """Near copies with changed, added and missing words; a third of all lines are copies of one."""
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 11)))
    lines = []
    for n in (1, 2, 4, 12, 25, 25, 60):
        base = [word() for _ in range(n)]
        lines += [" ".join(base)] * 3
        for _ in range(6):
            lines.append(" ".join(w if rng.random() > 0.02 else word() for w in base))
    lines += [lines[40]] * 40
    rng.shuffle(lines)
    rows = [(i, "\n".join(lines[i::12])) for i in range(12)]
    got = sorted(tuple(r[1:]) for r in line_dedup.decisions(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect())
    assert got == sorted(_line_decisions(rows))


def test_line_dedup_of_tables_with_odd_columns(spark):
    """Columns named like the operator's own, and a name with a dot."""
    a, b = (" ".join(f"{k}{i}" for i in range(12)) for k in "ab")
    names = ["doc_id", "text", "_gone", "uid", "gone", "rest", "place", "a.b", "line_no"]
    docs = spark.createDataFrame([(1, f"{a}\n{b}", *[5] * 7), (2, f"{b}\nown line", *[6] * 7)], names)
    out = line_dedup.dedup_lines(docs)
    assert out.columns == names and sorted(tuple(r) for r in out.collect()) == [(1, f"{a}\n{b}", *[5] * 7), (2, "own line", *[6] * 7)]


def test_quality(spark):
    data = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{data}/documents.parquet"), spark.read.parquet(f"{data}/labels.parquet")
    got = quality.classify(docs).join(labels, "doc_id").select("kept", "quality").collect()
    assert sum(r["kept"] for r in got if r["quality"] == 1) >= 0.99 * sum(r["quality"] == 1 for r in got)
    assert sum(not r["kept"] for r in got if r["quality"] == 0) >= 0.9 * sum(r["quality"] == 0 for r in got)


def test_quality_of_awkward_rows(docs):
    rows = quality.classify(docs).collect()
    assert len(rows) == docs.count() and all(r["score"] == 0 and not r["kept"] for r in rows if not r["n_words"])
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r["kept"] for r in rows)


def test_measures_of_texts(monkeypatch):
    """Counts by bytes equal those of plain patterns, also where windows cut a text."""
    monkeypatch.setattr(quality, "WINDOW", 7)
    rng = random.Random(9)
    texts = ["", "One. Two words.\nThree | four || five. ", "| | |", "wow!! a!?b #$%& no! ", "End.", "x. y. Z", "Ab. Éa. b. Ça."]
    texts += ["".join(rng.choice("ab AZ.|!#\n$é") for _ in range(rng.randint(1, 60))) for _ in range(200)]
    for t in texts:
        m = quality.measure(np.frombuffer(t.encode(), np.uint8))
        assert m["chars"] == len(t) and m["upper"] == len(re.findall("[A-Z]", t)) and m["lower"] == len(re.findall("[a-z\x80-\uffff]", t))
        assert m["symbols"] == len(re.findall(r"[#$%&*|!<>{}=~^\\]", t)) and m["columns"] == len(re.findall(r"(?=(?:^|(?<=\x20))[|](?:\x20|$))", t))
        assert m["shouts"] == len(re.findall(r"[!?*#$%&]{2,}", t))
        assert m["stops"] == len(re.findall(r"[a-z\x80-\uffff][.](?=\x20[A-Z\x80-\uffff]|\n|$)", t))


def test_scorer_on_soft_labels():
    """The sparse fit separates documents like a dense fit by plain gradient steps."""
    rng = np.random.default_rng(1)
    truth = rng.random(400) < 0.6
    rows = [quality.features(*next(quality._texts(quality.pa.array([t])))) for t in ("Plain words and more. " * int(n) if g else "#$ |! 12 ## " * int(n) for g, n in zip(truth, rng.integers(3, 30, 400), strict=True))]
    goal = np.where(truth, 0.95, 0.1)
    w = quality.train(np.concatenate([i for i, _ in rows]), np.concatenate([x for _, x in rows]), np.array([len(i) for i, _ in rows]), goal)
    dense = np.zeros((400, quality.WIDTH))
    for k, (i, x) in enumerate(rows):
        dense[k, i] = x
    plain = np.zeros(quality.WIDTH)
    for _ in range(2000):
        plain -= 0.5 * dense.T @ (1 / (1 + np.exp(-dense @ plain)) - goal) / 400
    assert ((dense @ w > 0) == truth).all() and ((dense @ plain > 0) == truth).all()
    assert np.abs(1 / (1 + np.exp(-dense @ w)) - goal).max() < 0.1


def test_quality_keeps_odd_columns(spark):
    docs = spark.createDataFrame([(1, "Plain words make a sentence here. And this is another one of them.", 3, "x"), (None, None, 4, "y")], ["doc_id", "text", "a.b", "score"])
    out = quality.keep_good(docs)
    assert out.columns == docs.columns and [tuple(r)[2:] for r in out.collect()] == [(3, "x")]


def test_em_recovers_accuracies():
    rng = np.random.default_rng(0)
    truth = rng.random(20_000) < 0.7
    accuracy = np.array([0.95, 0.85, 0.75, 0.9])
    votes = np.where(rng.random((20_000, 4)) < accuracy, 1, -1) * np.where(truth, 1, -1)[:, None] * (rng.random((20_000, 4)) < 0.8)
    patterns, inverse, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    share, found, _ = quality.expectation_maximisation(patterns, counts.astype(float))
    assert np.abs(found - accuracy).max() < 0.05 and ((share[inverse.ravel()] > 0.5) == truth).mean() > 0.93


@pytest.mark.parametrize("operator", [exact_dedup.exact_dedup, similar.linked_components, similar.keep_one, mixing.plan, mixing.mix, licenses.scan, pii.detect, line_dedup.decisions, line_dedup.dedup_lines, quality.classify, quality.keep_good, lambda d: packing.pack(d, registry.tokenizer_path())])
def test_empty_table(nothing, operator):
    assert operator(nothing).count() == 0


def test_null_doc_id(spark):
    docs = spark.createDataFrame([(None, "one two three four five six", "s"), (4, "one two three four five six", "s")], "doc_id long, text string, source string")
    assert {(r["doc_id"], r["keep_id"], r["kept"]) for r in exact_dedup.exact_dedup(docs).collect()} == {(None, 4, False), (4, 4, True)}
    assert {(r["doc_id"], r["component_id"]) for r in similar.linked_components(docs).collect()} == {(None, 4), (4, 4)}
    assert mixing.plan(docs).count() == licenses.scan(docs).count() == pii.detect(docs).count() == packing.pack(docs, registry.tokenizer_path()).count() == 2


def test_ngram_join_of_families(spark):
    """A large family of near copies, most linked to the center, some only to each other, some to none; and a passage that many share."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghijklm") for _ in range(7))
    text = [word() for _ in range(150)]
    edits = lambda t, k: " ".join(word() if i in set(rng.sample(range(len(t)), k)) else w for i, w in enumerate(t))
    texts = [" ".join(text)] + [edits(text, rng.choice([1, 1, 2, 3])) for _ in range(120)]
    for _ in range(6):  # small groups far from the center, close to each other
        far = edits(text, 9).split()
        texts += [edits(far, 1) for _ in range(4)]
    passage = " ".join(text[20:80])
    texts += [f"{passage} {' '.join(word() for _ in range(200))}" for _ in range(80)]
    rng.shuffle(texts)
    sets = []
    for t in texts:
        w = t.split()
        sets.append({tuple(w[j : j + 5]) for j in range(len(w) - 4)})
    parent = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = _find(parent, a), _find(parent, b)
                parent[max(x, y)] = min(x, y)
    got = similar.linked_components(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in got) == [(i, _find(parent, i)) for i in range(len(sets))]


def test_members_that_share_only_a_few_edits_make_no_pairs(spark, monkeypatch):
    """Members of a family meet on an edit that a small vocabulary gives to several; only those close enough by their sketches become pairs."""
    rng = random.Random(9)
    base, few = [f"w{i}" for i in range(150)], ["red", "green"]
    texts = [" ".join(rng.choice(few) if i in set(at) else w for i, w in enumerate(base)) for _ in range(60) for at in [rng.sample(range(150), 9)]]
    texts += [" ".join(base), *[f"{t} and a few more" for t in texts[:5]]]
    made, plain = [], buckets._families

    def counted(*args):
        out = plain(*args)
        made.append(out.count())
        return out

    monkeypatch.setattr(buckets, "_families", counted)
    got = similar.linked_components(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in got) == list(enumerate(_components_by_pairs(texts)))
    assert len(made) == 1 and made[0] <= len(texts) // 2


def _components_by_pairs(texts):
    sets = []
    for t in texts:
        w = t.split()
        sets.append({tuple(w[j : j + 5]) for j in range(len(w) - 4)})
    parent = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = _find(parent, a), _find(parent, b)
                parent[max(x, y)] = min(x, y)
    return [_find(parent, i) for i in range(len(sets))]


@pytest.mark.parametrize("least, most", [(15, 30), (100, 115)])
def test_ngram_join_of_families_near_a_band_border(spark, least, most):
    """Families whose members emit all segments beside members that emit few: hot segments are left out of neither for the other's slack."""
    rng = random.Random(least)
    word = lambda: "".join(rng.choice("abcdefghijklm") for _ in range(7))
    texts = []
    for _ in range(30):
        text = [word() for _ in range(rng.randint(least, most))]
        for _ in range(14):
            more, less = rng.randint(0, len(text) // 9), rng.randint(0, len(text) // 9)
            texts.append(" ".join([word() for _ in range(rng.randint(0, more))] + text[rng.randint(0, less) :] + [word() for _ in range(rng.randint(0, more))]))
    rng.shuffle(texts)
    got = similar.linked_components(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in got) == list(enumerate(_components_by_pairs(texts)))


def test_sketches_share_a_key_without_those_left_out():
    """Whatever two linked sets are, and whichever hot keys the one leaves out within its slack, they share another."""
    rng = np.random.default_rng(4)
    for n in [*range(8, 40), *range(76, 130)] * 40:
        a = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        drop, add = rng.integers(0, 1 + n // 8, 2)
        b = np.unique(np.concatenate([rng.permutation(a)[drop:], rng.integers(0, 2**64, add, dtype=np.uint64)]))
        both = len(np.intersect1d(a, b))
        if 100 * both >= 80 * (len(a) + len(b) - both):
            x, y = ([similar.sketch_and_slack(z, s, d) for s, d in similar.bands(len(z))] for z in (a, b))
            shared = set(np.concatenate([k for k, _ in x]).tolist()) & set(np.concatenate([k for k, _ in y]).tolist())
            assert len(shared) > max(min(slack for _, slack in z) for z in (x, y))


def test_line_dedup_of_short_lines(spark):
    """op1 takes every line that is not blank; unlike short lines stay, also with a common start."""
    texts = ["Les.\nintroduction\n\n \t\r", "les. \nintroductory\n\n \t\r", "LES.\nintroduction\n \na b"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r["doc_id"], r["line_no"]) for r in line_dedup.decisions(docs).collect() if not r["kept"]}
    assert got == {(1, 0), (2, 0), (2, 1)}


def test_op1_takes_short_lines(spark, tmp_path):
    spark.createDataFrame([(1, "les."), (2, "les.")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted(tuple(r) for r in registry.op1_line_dedup(spark, str(tmp_path)).collect()) == [(1, 0, 1, 0, True), (2, 0, 1, 0, False)]


def test_line_dedup_of_lines_without_spaces(spark):
    """Scripts without spaces, tabs and no-break spaces: long copies are found whatever min_words is."""
    passage = "".join(chr(0x4E00 + i * 37 % 5000) for i in range(400))
    lines = [passage, "\t".join(f"cell{i}" for i in range(30)), " ".join(f"word{i}" for i in range(30))]
    docs = spark.createDataFrame([(i, "\n".join(lines)) for i in range(2)] + [(2, passage[:390])], "doc_id long, text string")
    for least in (line_dedup.ALL, 8):
        got = {(r["doc_id"], r["line_no"]) for r in line_dedup.decisions(docs, min_words=least).collect() if not r["kept"]}
        assert got == {(1, 0), (1, 1), (1, 2), (2, 0)}


def test_line_dedup_of_rows_without_a_doc_id_of_their_own(spark):
    """Repeated and null ids: each row loses its own lines, and the first of equal rows keeps them."""
    a, b, c = (" ".join(f"{k}{i}" for i in range(12)) for k in "abc")
    rows = [(1, a), (1, a), (2, f"{a}\n{b}"), (2, f"{c}\n{b}"), (None, f"{c}\nown"), (None, b)]
    docs = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "doc_id long, text string, n int").coalesce(1)
    assert sorted((r["n"], r["text"]) for r in line_dedup.dedup_lines(docs).collect()) == [(0, a), (2, b), (3, c), (4, "own")]


def test_near_duplicates_of_rows_without_a_doc_id_of_their_own(spark):
    """Null and repeated ids: each row is judged by its own text, and one row of each group stays."""
    rng = random.Random(3)
    text = lambda: [f"w{rng.randrange(10**6)}" for _ in range(60)]
    a, b, c, d = text(), text(), text(), text()
    rows = [(None, a), (None, [*a, "more"]), (None, b), (7, c), (7, c), (8, d), (8, ["first", *c]), (9, [*d, "last"]), (None, [])]
    docs = spark.createDataFrame([(i, " ".join(t), k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, n int").coalesce(1)
    assert sorted(r["n"] for r in similar.keep_one(docs).collect()) == [0, 2, 3, 5, 8]
    got = [tuple(r) for r in similar.linked_components(docs).select("doc_id", "component_id").collect()]
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(got, key=key) == sorted([*[(None, None)] * 4, (7, 7), (7, 7), (8, 8), (8, 7), (9, 8)], key=key)


def test_near_duplicates_of_tables_with_odd_columns(spark):
    """Columns named like the operator's own, and a name with a dot."""
    a = " ".join(f"w{i}" for i in range(60))
    names = ["doc_id", "text", "_uid", "uid", "row", "a.b", "c"]
    docs = spark.createDataFrame([(1, a, *[5] * 5), (2, f"{a} more", *[6] * 5), (3, "another text", *[7] * 5)], names)
    out = similar.keep_one(docs)
    assert out.columns == names and sorted(tuple(r) for r in out.collect()) == [(1, a, *[5] * 5), (3, "another text", *[7] * 5)]
