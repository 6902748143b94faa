"""Collocations against plain counting, whatever the blocks, tries and thresholds."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from docsift.llm import collocations as C
from test_text_operators import HOSTILE, docs


def brute(rows, least, top):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\x0A-\x0D]", low):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3, 4):
                for i in range(len(w) - k + 1):
                    f[lang][tuple(w[i:i + k])] += 1
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in candidates.items():
            score, _, left, right = min((2000000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            inside = any(len(q) > len(p) and 100 * b >= 80 * a and any(q[i:i + len(p)] == p for i in range(len(q))) for q, b in candidates.items())
            if not inside:
                kept.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(kept)[:top])]
    return sorted(out)


def corpus(n=120):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(25)] + ["The", "the", "é", "漢字", "a-b", "x\x00y", " ", "=", "Ä", "ä"]
    sep = [" ", " ", " ", "  ", "\t", ". ", ", ", "\n", "!?", ":"]
    text = lambda: "".join(rng.choices(words, [1 / (i + 1) for i in range(len(words))])[0] + rng.choice(sep) for _ in range(rng.randint(0, 50)))
    rows = [(i, text() + rng.choice(["", "new york city hall ", "The of the ", "a b c d e "]) * rng.randint(0, 3), rng.choice(["en", "fr", None, "und"])) for i in range(n)]
    return rows + [(1, "p q r s t " * 40, "de"), (2, "z " * 100, "de"), (2, "z " * 100, "de")]


@pytest.mark.parametrize("options", [{}, {"least": 4, "top": 50}, {"least": 3, "shard": 7, "block_chars": 300, "pairs": 50}, {"least": 2, "shard": 100}])
def test_collocations_equal_brute_force(spark, options, monkeypatch):
    if options.get("shard"):  # several levels of sums
        monkeypatch.setattr(C, "FAN_IN", 2)
        monkeypatch.setattr(C, "SPAN", 3)
    rows = corpus() + [(i, t, "en") for i, t in HOSTILE if i != 7]
    got = C.collocations(docs(spark, rows), **options).collect()
    expected = brute(rows, options.get("least", 30), options.get("top", 2000))
    assert sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in got) == expected and expected


def test_no_phrases_and_empty_tables(spark):
    assert C.collocations(docs(spark, [])).count() == 0
    assert C.collocations(docs(spark, HOSTILE), least=10**6).count() == 0
    assert C.collocations(docs(spark, [(1, "one " * 40, "en"), (2, None, None)] + [(3, "a.b", "en")] * 40)).select("phrase").collect()[0].phrase in (
        "one one", "one one one one", "one one one")


def test_trie_finds_exactly_its_phrases():
    rng = random.Random(3)
    for top in (3, 40, 5000, 70000):
        phrases = {tuple(rng.randint(1, top) for _ in range(rng.randint(2, 4))) for _ in range(3000)}
        phrases |= {(1, i) for i in range(1, min(top, 2000))}  # a state with many children
        rows = sorted(phrases)
        rng.shuffle(rows)
        table = np.array([p + (0,) * (4 - len(p)) for p in rows], np.int64)
        trie = C.Trie(table)
        text = np.array([x for p in rng.choices(rows, k=2000) for x in (*p, rng.choice([0, 1, top, 10 * top]))], np.int64)
        got, expected = Counter(), Counter()
        for _, _, state in trie.walk(text, slice_=rng.choice([1 << 19, 7, 100])):
            ends = trie.value[state]
            got.update(rows[i] for i in ends[ends >= 0].tolist())
        for k in (2, 3, 4):
            expected.update(p for p in (tuple(text[i:i + k].tolist()) for i in range(len(text) - k + 1)) if p in phrases)
        assert got == expected


def test_wide_pairs_are_counted():
    a, b = np.array([5, 5, 1 << 40, 5, 1 << 40]), np.array([1 << 40, 7, 1 << 40, 7, 1 << 40])
    assert [x.tolist() for x in C._distinct_pairs(a, b, np.array([1, 1, 1, 2, 1]))] == [[5, 5, 1 << 40], [7, 1 << 40, 1 << 40], [3, 1, 2]]
