"""Quality rules against plain Python; the whole table is compared with SQL in test_line_dedup."""

import math
import re
from collections import Counter

from tagloom.llm.quality import judge, js_distance


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i: i + 5]) for i in range(len(words) - 4)]
    n = Counter(grams)
    repeated = {i + k for i, g in enumerate(grams) if n[g] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    base = len(words) < 10 or 100 * len(repeated) > 20 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated), base)


PLAIN = " ".join(f"the quick fox{i} of Spain is in town{i}," for i in range(40))
ROWS = [
    (1, PLAIN, "en"), (2, PLAIN.replace("a", "b"), "en"), (3, None, "en"), (4, "", None), (5, " \t\r\n\x0b\x0c ", "en"), (6, "a b c d", "en"),
    (7, "one two three four five " * 3, "en"), (8, "x " * 30000, "de"), (9, "é\xa0ü ß | $$ <b>\nline\n\nline\n \nline", "fr"),
    (10, "a a a a a a b c d e f g h i j k l m n o p q r s t u v w x y z 1 2 3 4 5 6 7 8 9", "en"), (None, PLAIN, None),
    (11, "###*** " * 3 + PLAIN, "en"), (12, " ".join(f"{w}###***$$$" for w in PLAIN.split()), "en"), (13, PLAIN, "en"), (13, PLAIN, "en"),
    (14, "p q r s t u v p q r s t u", "xx"), (15, "w " * 10 + " ".join(f"n{i}" for i in range(3000)), "en"),
]


def run(spark, rows):
    frame = spark.createDataFrame([(*r, True) for r in rows], "doc_id long, text string, lang string, kept boolean").repartition(3)
    return judge(frame).collect()


def test_counts(spark):
    rows = run(spark, ROWS)
    got = sorted((tuple(r)[:7] for r in rows), key=str)
    assert got == sorted(((doc, *brute(text)) for doc, text, _ in ROWS), key=str)
    kept = {r["doc_id"]: r["kept"] for r in rows}
    assert kept[1] and kept[13] and not kept[12] and not kept[3]


def test_texts_without_common_words(spark):
    """Keyword lists and lower-case gibberish go at any length from 50 words; a language of other words is not judged by words."""
    prose = [(i, " ".join(f"the river of stone{i}x{k} is and was town{k} to that in hill{k}" for k in range(12)), "en") for i in range(30)]
    listed = lambda n: " ".join(f"market{i}x stone river green hill town"[: 7 + i % 29] for i in range(n))
    bare = [(100 + n, listed(n), "en") for n in (50, 60, 400)] + [(99, " ".join(f"short{i}x" for i in range(49)), "en")]
    other = [(200 + i, " ".join(f"kota{i}x{k} besar hijau bukit" for k in range(40)), "id") for i in range(30)]
    kept = {r["doc_id"]: r["kept"] for r in run(spark, prose + bare + other)}
    assert not any(kept[doc] for doc, _, _ in bare if doc >= 150)
    assert kept[99] and all(kept[doc] for doc, _, _ in prose + other)


def test_empty(spark):
    assert run(spark, []) == []


def test_distance(spark):
    def plain(p, q):
        p, q = [x / sum(p) for x in p], [x / sum(q) for x in q]
        m = [(a + b) / 2 for a, b in zip(p, q)]
        gain = lambda x: sum(a * math.log2(a / b) for a, b in zip(x, m) if a)
        return math.sqrt((gain(p) + gain(q)) / 2)

    frame = spark.createDataFrame([([1, 2, 3], [3, 2, 1]), ([1, 0], [0, 5]), ([4, 4], [1, 1])], "p array<long>, q array<long>")
    for p, q, d in frame.select("p", "q", js_distance(frame.p, frame.q)).collect():
        assert math.isclose(d, plain(p, q), abs_tol=1e-7)
