"""Ranked lexical search against a plain scorer, whatever the blocks, bundles and owners."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest
from docsift.llm import ranked
from test_text_operators import HOSTILE, docs


def brute(rows, items, k):
    terms = lambda t: re.findall(ranked.TERM, re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
    bags = [Counter(terms(t)) for _, t in rows]
    n_docs, words = sum(1 for b in bags if b), sum(sum(b.values()) for b in bags)
    df = Counter(t for b in bags for t in b)
    out = defaultdict(list)
    for item, text in items:
        scored = []
        for (i, _), b in zip(rows, bags):
            score = 0
            for t in set(terms(text)):
                if b[t]:
                    m = 100 - 90 + (90 * sum(b.values()) * n_docs) // words
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((1000000000 * b[t]) // (1000 * b[t] + 8 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out[item].append([(r + 1, None if missing else i, -s) for r, (s, missing, i) in enumerate(sorted(scored)[:k])])
    return {i: sorted(x) for i, x in out.items() if any(x)}


def corpus(n=160):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(60)] + ["The", "THE", "naïve", "漢字", "x1", "a_b", "c-d", "ÄÖ", "äö"]
    pick = lambda k: " ".join(rng.choices(words, [1 / (i + 1) for i in range(len(words))], k=k))
    rows = [(i, pick(rng.randint(1, 60))) for i in range(n)]
    rows += [(1000 + i, rows[i % 5][1]) for i in range(20)] + [(None, rows[3][1]), (None, rows[3][1]), (3, rows[3][1])]
    items = [(i, pick(rng.randint(1, 12))) for i in range(25)] + [(90, None), (91, ""), (92, "nowhere"), (93, rows[3][1]), (94, "the the THE"), (None, "w1 w2")]
    return rows, items


@pytest.mark.parametrize("options", [{}, {"block_docs": 7, "bundle": 4}, {"block_chars": 200, "bundle": 1, "shares": (0.02, 0.05, 0.1, 0.3, 1.0), "k": 3},
                                     {"shares": (1.0,), "block_docs": 30}])
def test_search_equals_brute_force(spark, options):
    rows, items = corpus()
    rows = [r for r in HOSTILE if r[0] not in (7, 8)] + rows
    queries = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, rank string")
    got = defaultdict(list)
    for r in ranked.search(docs(spark, rows), queries, **options).collect():
        got[r.item_id].append((r["rank"], r.doc_id, r.score))
    assert {i: [sorted(x)] for i, x in got.items()} == brute(rows, items, options.get("k", 10))


def test_repeated_items_and_empty_tables(spark):
    rows, _ = corpus(20)
    twice = spark.createDataFrame([(1, "w1 w2"), (1, "w1 w2"), (1, "w3")], "item_id long, text string")
    got = ranked.search(docs(spark, rows), twice, k=2).collect()
    assert sorted(r["rank"] for r in got) == [1, 1, 1, 2, 2, 2]
    assert ranked.search(docs(spark, []), twice).count() == 0
    assert ranked.search(docs(spark, rows), twice.where("item_id = 9")).count() == 0
