"""Secret scans: pattern kinds and sliding-window entropy, as Column expressions.

``secret_spans`` gives every span of a text, ``redact`` masks them.  Nothing is
exploded or shuffled: a scan is one projection over the documents.

Pattern kinds (leftmost, non-overlapping per kind; a match that is too short is
dropped and still consumed): ``assign``, ``access``, ``hex``.

The ``entropy`` kind looks at candidate strings, maximal runs of token
characters.  A candidate belongs to the narrowest character class that holds it
(hex, alphanumeric, base64), and each class has its own threshold.  A window
slides over the candidate; the counts of its characters and the sum of
c * log2(c) are updated for the character that enters and the one that leaves,
and the windows whose Shannon entropy reaches the threshold are merged to
spans.  Candidates that match the allow-list (plain words, plain numbers, UUIDs,
paths of words, alphabet runs, placeholders) are suppressed; the pattern kinds
are not.

A candidate joins names and values (``sha1_...``, ``sample-key=...``).  With
``values``, what stands between the separators of a candidate, and what follows
an equals sign, is also a candidate of its own, with its own class and its own
look at the allow-list; the spans are those of both, and may overlap.

Edge cases: a null text is an empty text and has no spans; positions are code
points, end exclusive; equal texts give equal spans; an empty table gives an
empty result.  As the operators are Columns, other columns cannot clash.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# The kinds in their order, and their patterns.
KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = (r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"""
          r"""|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}"
CANDIDATE = r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/=_-]{20,}"
# Parts of a candidate: between two of = _ - /, and behind an equals sign.
PIECE = r"(?<=[=_/-])[A-Za-z0-9+]{20,}+|(?<![A-Za-z0-9+=_/-])[A-Za-z0-9+]{20,}+(?=[=_/-])"
ASSIGNED = r"(?<==)[A-Za-z0-9+]*+[/_-][A-Za-z0-9+/_-]*+=*+"

WINDOW = 20
# Entropy in bits from which a window counts, by character class.
THRESHOLDS = {r"^[0-9a-fA-F]+$": 3.0, r"^[A-Za-z0-9]+$": 3.6, r"": 3.8}
ALLOW = (
    r"^[A-Za-z+/=_-]+$",  # no digit: words, joined words, rules
    r"^[0-9+/=_-]+$",  # no letter: numbers, dates, rules
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",  # UUID
    r"^/?([A-Za-z]+[0-9]{0,4}[/_-])+[A-Za-z]*[0-9]{0,4}$",  # path or joined words with numbers
    r"(?i)abcdefghij|0123456789|example|sample|dummy|placeholder|changeme|xxxxxx",
)


def _found(text: Column, pattern: str) -> Column:
    """array<struct<start, end, value>> of the matches of ``pattern``."""
    steps = F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
                       lambda gap, value: F.struct(F.length(gap).alias("gap"), value.alias("value")))
    none = F.lit(None).cast("array<struct<start:int,end:int,value:string>>")
    init = F.struct(F.lit(0).alias("pos"), F.array().cast("array<struct<start:int,end:int,value:string>>").alias("out"))

    def step(acc, x):
        start = acc["pos"] + x["gap"]
        end = start + F.length(x["value"])
        item = F.struct(start.alias("start"), end.alias("end"), x["value"].alias("value"))
        return F.struct(F.coalesce(end, start).alias("pos"),
                        F.when(x["value"].isNull(), acc["out"]).otherwise(F.concat(acc["out"], F.array(item))).alias("out"))

    return F.when(text.rlike(pattern), F.aggregate(steps, init, step, lambda acc: acc["out"])).otherwise(none)


def _kind(found: Column, kind: int, keep=None) -> Column:
    if keep is not None:
        found = F.filter(found, keep)
    return F.transform(found, lambda x: F.struct(x["start"].alias("start"), F.lit(kind).alias("kind"), x["end"].alias("end")))


def _entropy_spans(value: Column, threshold: Column, window: int) -> Column:
    """array<struct<a, b>>: merged windows of ``value`` that reach the threshold."""
    table = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(window + 2)])
    codes = F.transform(F.split(value, ""), lambda c: F.ascii(c))
    pairs = F.zip_with(codes, F.concat(F.array_repeat(F.lit(-1), window), codes),
                       lambda i, o: F.struct(i.alias("i"), o.alias("o")))
    pairs = F.filter(pairs, lambda x: x["i"].isNotNull())
    init = F.struct(F.lit(0).alias("n"), F.lit(0.0).alias("s"), F.array_repeat(F.lit(0), 128).alias("counts"),
                    F.lit(-1).alias("a"), F.lit(-1).alias("b"), F.array().cast("array<struct<a:int,b:int>>").alias("out"))

    def step(acc, x):
        same = x["i"] == x["o"]
        c_in = F.get(acc["counts"], x["i"])
        c_out = F.get(acc["counts"], x["o"])
        gain = F.get(table, c_in + 1) - F.get(table, c_in)
        loss = F.when(x["o"] >= 0, F.get(table, c_out) - F.get(table, c_out - 1)).otherwise(0.0)
        s = F.when(same, acc["s"]).otherwise(acc["s"] + gain - loss)
        counts = F.when(same, acc["counts"]).otherwise(
            F.transform(acc["counts"], lambda c, k: c + (k == x["i"]).cast("int") - (k == x["o"]).cast("int")))
        end = acc["n"] + 1
        hit = (end >= window) & (F.lit(math.log2(window)) - s / window >= threshold)
        apart = hit & (acc["b"] < end - window)  # a new span begins
        closed = F.struct(acc["a"].alias("a"), acc["b"].alias("b"))
        return F.struct(end.alias("n"), s.alias("s"), counts.alias("counts"),
                        F.when(apart, end - window).otherwise(acc["a"]).alias("a"),
                        F.when(hit, end).otherwise(acc["b"]).alias("b"),
                        F.when(apart & (acc["b"] >= 0), F.concat(acc["out"], F.array(closed))).otherwise(acc["out"]).alias("out"))

    return F.aggregate(pairs, init, step, lambda acc: F.when(
        acc["b"] >= 0, F.concat(acc["out"], F.array(F.struct(acc["a"].alias("a"), acc["b"].alias("b"))))).otherwise(acc["out"]))


def secret_spans(text: Column, window: int = WINDOW, thresholds: dict | None = None, allow: tuple = ALLOW,
                 values: bool = False) -> Column:
    """array<struct<start, kind, end>>, sorted by start, then kind (an index into KINDS)."""
    text = F.coalesce(text, F.lit(""))
    long_enough = lambda x: F.length(F.regexp_extract(x["value"], ASSIGN, 2)) >= 8
    def limit(value):
        out = F.lit(None).cast("double")
        for pattern, bits in reversed(list((thresholds or THRESHOLDS).items())):
            out = F.when(value.rlike(pattern), F.lit(float(bits))).otherwise(out)
        return out

    def unlisted(x):
        out = F.lit(True)
        for pattern in allow:
            out = out & ~x["value"].rlike(pattern)
        return out

    def entropy(pattern):
        found = F.filter(_found(text, pattern), lambda x: (F.length(x["value"]) >= window) & unlisted(x))
        candidates = F.transform(found, lambda x: F.struct(x["start"].alias("start"), x["value"].alias("value"), limit(x["value"]).alias("limit")))
        return F.flatten(F.transform(candidates, lambda x: F.transform(
            _entropy_spans(x["value"], x["limit"], window),
            lambda y: F.struct((x["start"] + y["a"]).alias("start"), F.lit(3).alias("kind"), (x["start"] + y["b"]).alias("end")))))

    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    parts = [_kind(_found(text, ASSIGN), 0, long_enough), _kind(_found(text, ACCESS), 1), _kind(_found(text, HEX), 2)]
    parts += [entropy(p) for p in ((CANDIDATE, PIECE, ASSIGNED) if values else (CANDIDATE,))]
    spans = F.concat(*[F.coalesce(p, none) for p in parts])
    return F.sort_array(F.array_distinct(spans) if values else spans)


def redact(text: Column, spans: Column, mask: str = "[SECRET]") -> Column:
    """``text`` with each covered stretch replaced by ``mask`` (overlapping spans share one mask)."""
    init = F.struct(F.lit(0).alias("pos"), F.lit("").alias("out"))

    def step(acc, x):
        fresh = F.concat(acc["out"], F.substring(text, acc["pos"] + 1, x["start"] - acc["pos"]), F.lit(mask))
        apart = (x["start"] > acc["pos"]) | ((acc["pos"] == 0) & (acc["out"] == ""))
        return F.struct(F.greatest(acc["pos"], x["end"]).alias("pos"), F.when(apart, fresh).otherwise(acc["out"]).alias("out"))

    done = F.aggregate(spans, init, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["pos"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)


def span_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def op6(spark, sf_dir):
    from docsift.llm.common import read

    found = read(spark, sf_dir, "documents").select("doc_id", secret_spans(F.col("text")).alias("found"))
    count = lambda k: F.size(F.filter("found", lambda x: x["kind"] == k)).cast("long")
    base = F.filter("found", lambda x: x["kind"] < 3)
    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                        F.sha2(span_text(base).cast("binary"), 256).alias("base_sha256"), span_text(F.col("found")).alias("spans"))


def _sql_spans(name: str, kind: int, value: str) -> str:
    """SQL: numbered matches of a pattern with their positions, found by unnesting gaps and matches."""
    return f"""
{name}_m AS (SELECT rid, text, regexp_extract_all(text, '{value}') AS ms FROM d WHERE regexp_matches(text, '{value}')),
{name}_u AS (SELECT rid, unnest(ms) AS m, unnest(range(len(ms))) AS i,
                    unnest(string_split_regex(text, '{value}')[1:len(ms)]) AS gap FROM {name}_m),
{name} AS (SELECT rid, {kind} AS kind, m, (sum(length(gap) + length(m)) OVER (PARTITION BY rid ORDER BY i) - length(m))::BIGINT AS a,
                  sum(length(gap) + length(m)) OVER (PARTITION BY rid ORDER BY i)::BIGINT AS b FROM {name}_u)"""


def _sql() -> str:
    q = lambda s: s.replace("'", "''")
    run = "[A-Za-z0-9+/=_-]+"
    limit = "CASE " + " ".join(f"WHEN regexp_matches(m, '{p}') THEN {b}" for p, b in THRESHOLDS.items()) + " END"
    allow = " AND ".join(f"NOT regexp_matches(m, '{p}')" for p in ALLOW)
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
{_sql_spans('s0', 0, q(ASSIGN))},
{_sql_spans('s1', 1, ACCESS)},
{_sql_spans('s2', 2, '[0-9a-f]{32,}')},
{_sql_spans('s3', 3, run)},
c AS (SELECT rid, m, a, {limit} AS bits FROM s3 WHERE length(m) >= 20 AND {allow}),
w AS (SELECT rid, a + i AS a, bits, list_aggregate(string_split(substr(m, i + 1, {WINDOW}), ''), 'entropy') AS h
      FROM (SELECT *, unnest(range(length(m) - {WINDOW} + 1)) AS i FROM c)),
f AS (SELECT rid, a, lag(a) OVER (PARTITION BY rid ORDER BY a) AS p FROM w WHERE h >= bits),
g AS (SELECT rid, a, sum(CASE WHEN p IS NULL OR p + {WINDOW} < a THEN 1 ELSE 0 END) OVER (PARTITION BY rid ORDER BY a) AS part FROM f),
e AS (SELECT rid, 3 AS kind, min(a)::BIGINT AS a, (max(a) + {WINDOW})::BIGINT AS b FROM g GROUP BY rid, part),
al AS (SELECT rid, kind, a, b FROM s0 WHERE length(regexp_extract(m, '{q(ASSIGN)}', 2)) >= 8
       UNION ALL SELECT rid, kind, a, b FROM s1 UNION ALL SELECT rid, kind, a, b FROM s2 UNION ALL SELECT rid, kind, a, b FROM e),
t AS (SELECT *, {list(KINDS)}[kind + 1] || ':' || a || ':' || b AS one FROM al),
r AS (SELECT rid, count(*) FILTER (kind = 0) AS n0, count(*) FILTER (kind = 1) AS n1, count(*) FILTER (kind = 2) AS n2,
             string_agg(one, ',' ORDER BY a, kind, b) FILTER (kind < 3) AS base, string_agg(one, ',' ORDER BY a, kind, b) AS spans
      FROM t GROUP BY rid)
SELECT doc_id, coalesce(n0, 0) AS n_assign, coalesce(n1, 0) AS n_access, coalesce(n2, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN r USING (rid)
"""


OP6_SQL = _sql()
