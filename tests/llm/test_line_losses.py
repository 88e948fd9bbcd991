"""Lines that line dedup must not miss: pairs of few shingles, and long words that one character moves, against plain character shingles."""

import random

from statuta.llm import line_dedup


def _linked(spark, pairs):
    """For each pair of lines whether the second goes for the first."""
    rows = [(2 * i, a) for i, (a, _) in enumerate(pairs)] + [(2 * i + 1, b) for i, (_, b) in enumerate(pairs)]
    got = line_dedup.decisions(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    keep = {r["doc_id"]: r["keep_doc_id"] for r in got}
    return [keep[2 * i + 1] == 2 * i for i in range(len(pairs))]


def _jaccard(a, b, n=9):
    x, y = ({t[i : i + n] for i in range(max(1, len(t) - n + 1))} for t in (a, b))
    return len(x & y) / len(x | y)


def test_a_word_before_short_lines(spark):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(5, 8)))
    for words in range(4, 9):
        pairs = [(line := " ".join(word() for _ in range(words)), f"{word()} {line}") for _ in range(150)]
        assert sum(_linked(spark, pairs)) >= 0.95 * len(pairs), words


def test_a_character_more_in_a_long_word(spark):
    rng = random.Random(12)
    letters = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(n))
    pairs = []
    for n in (120, 200, 400, 400, 400, 3000):
        for _ in range(20):
            a, at = letters(n), rng.randint(0, n)
            pairs.append((a, a[:at] + "x" + a[at:]))
            url = f"https://example.org/{letters(n)}?q={letters(20)}"
            pairs.append((f"see {url} here", f"see {url[:at]}y{url[at:]} here"))
    assert all(_jaccard(a, b) >= 0.85 for a, b in pairs)
    assert all(_linked(spark, pairs))


def test_unlike_long_words_stay(spark):
    rng = random.Random(13)
    pairs = [tuple("".join(rng.choice("abcdefgh") for _ in range(300)) for _ in range(2)) for _ in range(30)]
    assert not any(_linked(spark, pairs))
