"""Text analysis as Column expressions (JVM side, no Python UDF).

The analyzer is ours (the reference delegates it to a server): lower-case the
text, then take maximal runs of Unicode letters and digits as tokens.  The same
regular expression runs in DuckDB, which is what the oracle SQL uses.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The token pattern and the BM25 constants (k1, b) of the
# published Okapi BM25 defaults.
TOKEN_PATTERN = r"[\p{L}\p{N}]+"
BM25_K1 = 1.2
BM25_B = 0.75

_PY_TOKEN = re.compile(r"[^\W_]+", re.UNICODE)


def tokens(c: Column) -> Column:
    """array<string> of the analyzed tokens of a text column."""
    return F.regexp_extract_all(F.lower(c), F.lit(TOKEN_PATTERN), 0)


def _simple(text: str) -> list[str]:
    return re.findall(r"[^\W\d_]+", text.lower())


# The common words that the "stop" analyzer leaves out.
STOP_WORDS = frozenset(("a an and are as at be but by for if in into is it no not of on or such that the their then there these they "
                        "this to was will with").split())
# Analyzers of query strings by name; ``register_analyzer`` adds to them.
ANALYZERS = {
    "standard": lambda text: _PY_TOKEN.findall(text.lower()),
    "simple": _simple,
    "stop": lambda text: [w for w in _simple(text) if w not in STOP_WORDS],
    "whitespace": lambda text: text.split(),
    "keyword": lambda text: [text] if text else [],
}


def register_analyzer(name: str, analyzer) -> None:
    """``analyzer``: query string -> terms."""
    ANALYZERS[name] = analyzer


def analyze(text: str, analyzer: str | None = None) -> list[str]:
    """Driver-side analysis of a *query string* (never of documents, whose tokens ``tokens`` makes)."""
    if analyzer is not None and analyzer not in ANALYZERS:
        raise ValueError(f"unknown analyzer {analyzer}")
    return list(ANALYZERS[analyzer or "standard"](text))


def is_token(term: str) -> bool:
    """Whether documents can hold the term: an analyzer of queries may make terms that they cannot."""
    return _PY_TOKEN.fullmatch(term) is not None and term == term.lower()


def term_freq(toks: Column, term: str) -> Column:
    """Occurrences of ``term`` in a token array."""
    return F.size(F.filter(toks, lambda x: x == F.lit(term)))


def bm25_idf(n_docs: Column, doc_freq: Column) -> Column:
    return F.log(F.lit(1.0) + (n_docs - doc_freq + F.lit(0.5)) / (doc_freq + F.lit(0.5)))


def bm25_tf(tf: Column, doc_len: Column, avg_len: Column, k1: float = BM25_K1, b: float = BM25_B) -> Column:
    """Saturated term frequency tf / (tf + k1 * (1 - b + b * dl / avgdl)) (no (k1 + 1) factor)."""
    tf = tf.cast("double")
    return tf / (tf + F.lit(k1) * (F.lit(1.0 - b) + F.lit(b) * doc_len.cast("double") / avg_len))


def any_token_regex(terms: list[str]) -> str:
    """Regex finding any of ``terms`` as a whole token in lower-cased text.

    Tokens are maximal runs of letters/digits, so "whole token" means not
    preceded or followed by a letter or digit.  A regex find needs no token
    array, so filters stay cheap; tokens are only built for matching rows.
    Query terms come from ``analyze`` and hold letters and digits only.
    """
    alt = "|".join(terms)
    return r"(?<![\p{L}\p{N}])(?:" + alt + r")(?![\p{L}\p{N}])"


def has_token(text: Column, term: str) -> Column:
    """``term`` is a token of a lower-cased text.  The plain search in front of the pattern rejects most texts at little cost."""
    if not is_token(term):
        return F.lit(False)
    return text.contains(term) & text.rlike(any_token_regex([term]))


def phrase_regex(terms: list[str], prefix_last: bool = False) -> str:
    """Regex for the terms as consecutive tokens (the last one may be a prefix)."""
    body = r"[^\p{L}\p{N}]+".join(terms)
    tail = "" if prefix_last else r"(?![\p{L}\p{N}])"
    return r"(?<![\p{L}\p{N}])" + body + tail


def _meet(sets: list[Column]) -> Column:
    """The values that all the arrays share."""
    out = sets[0]
    for x in sets[1:]:
        out = F.array_intersect(out, x)
    return out


def phrase_at(at: list[Column], terms: list[str], slop: int, prefix_last: bool = False) -> Column:
    """True when the ``terms``, whose positions are the arrays ``at``, make the phrase: take a position for each term, less
    the term's place in the phrase; the largest and the smallest may differ by ``slop``.  One position serves one term.

    Each position allows the smallest ones from ``slop`` below it up to itself; a smallest one that all terms allow is looked
    for by hashing, so work is linear in the positions.  Only terms that may claim one position twice are tried out.
    """
    less = lambda p, k: F.transform(p, lambda x: x - F.lit(k))
    shifted = [less(p, k) for k, p in enumerate(at)]
    if not slop:
        return F.size(_meet(shifted)) > 0
    lows = _meet([F.flatten(F.transform(p, lambda x: F.sequence(x - F.lit(slop), x))) for p in shifted])
    last = len(terms) - 1
    shares = lambda j, k: terms[j] == terms[k] or (prefix_last and k == last and terms[j].startswith(terms[k]))
    if not any(shares(j, k) for k in range(len(terms)) for j in range(k)):
        return F.size(lows) > 0

    def placed(low: Column, k: int, chosen: list[Column]) -> Column:
        if k == len(terms):
            return F.lit(True)

        def fits(p: Column) -> Column:
            e = (p >= low) & (p <= low + F.lit(slop))
            for j, q in enumerate(chosen):
                if shares(j, k):
                    e = e & (p + F.lit(k) != q + F.lit(j))
            return e & placed(low, k + 1, [*chosen, p])

        return F.exists(shifted[k], fits)

    return F.exists(lows, lambda low: placed(low, 0, []))


def sloppy_phrase(texts: Column, terms: list[str], slop: int, prefix_last: bool) -> Column:
    """True when one element of an array of lower-cased texts holds the terms with a spread of at most ``slop``
    (``phrase_at``).  The last term may be a prefix."""
    n = len(terms)

    def positions(toks: Column, k: int) -> Column:
        here = lambda t: t.startswith(F.lit(terms[k])) if prefix_last and k == n - 1 else t == F.lit(terms[k])
        marked = F.transform(toks, lambda t, i: F.when(here(t), i))
        return F.filter(marked, lambda p: p.isNotNull())

    placed = F.transform(F.transform(texts, tokens), lambda t: F.struct(*[positions(t, k).alias(f"p{k}") for k in range(n)]))
    return F.coalesce(F.exists(placed, lambda at: phrase_at([at[f"p{k}"] for k in range(n)], terms, slop, prefix_last)), F.lit(False))


def collection_stats(df, field: str):
    """Statistics table of a text field: one row per term with its document
    frequency ``df``, plus one row with ``term = NULL`` carrying the document
    count ``n`` and the token total ``tokens``.

    Built once (a token explode with map-side combine, so frequent terms are
    pre-aggregated before the shuffle) and stored, e.g. as Parquet in the
    shared folder; searches then read only their own terms from it
    (``term IN (...)`` reaches the scan) instead of tokenizing the collection
    for every query.
    """
    toks = tokens(F.col(field))
    docs = df.filter(F.col(field).isNotNull()).select(F.array_distinct(toks).alias("u"), F.size(toks).alias("dl"))
    vocab = docs.select(F.explode("u").alias("term")).groupBy("term").agg(F.count(F.lit(1)).cast("double").alias("df"))
    vocab = vocab.select("term", "df", F.lit(None).cast("double").alias("n"), F.lit(None).cast("double").alias("tokens"))
    totals = docs.agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum("dl").cast("double").alias("tokens"))
    totals = totals.select(F.lit(None).cast("string").alias("term"), F.lit(None).cast("double").alias("df"), "n", "tokens")
    return vocab.unionByName(totals)


def stats_from_table(table, terms: list[str]) -> Column:
    """struct(n, avgdl, df0..dfk) for ``terms`` from a ``collection_stats`` table (scalar subquery)."""
    t = table.filter(F.col("term").isNull() | F.col("term").isin(list(terms)))
    parts = [F.max("n").alias("n"), (F.max("tokens") / F.max("n")).alias("avgdl")]
    parts += [F.coalesce(F.max(F.when(F.col("term") == F.lit(w), F.col("df"))), F.lit(0.0)).alias(f"df{i}") for i, w in enumerate(terms)]
    return t.select(F.struct(*parts)).scalar()
