"""Operators without a SQL oracle, checked against brute force on small inputs,
and partition-count invariance."""

import random
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from docsift.functions.text import analyze
from docsift.operators import aggs as A
from docsift.operators import query as Q
from docsift.operators import writes as WR
from docsift.operators.scan import prefix_max
from docsift.operators.scoring import FunctionScore, RandomScore
from docsift.plans.search import Search
from docsift.sources import tables as TB


def test_prefix_max_matches_python(spark):
    rnd = random.Random(7)
    rows = [(rnd.randint(0, 3), s, rnd.choice([None, rnd.randint(0, 50)])) for s in range(300)]
    df = spark.createDataFrame(rows, "k int, seq long, v int")
    for chunk in (1, 7, 1 << 20):
        got = {r.seq: r.p for r in prefix_max(df, ["k"], "seq", {"p": F.col("v")}, chunk=chunk).collect()}
        for k, s, _ in rows:
            prev = [v for kk, ss, v in rows if kk == k and ss < s and v is not None]
            assert got[s] == (max(prev) if prev else None)


def _fold(base: dict, actions: list[dict], scripts: dict | None = None):
    """Sequential reference semantics of a bulk request: (documents, outcomes by seq); ``_states`` has the rest."""
    states, statuses = _states(base, actions, scripts or {})
    return {i: s["doc"] for i, s in states.items() if s["live"]}, {k: status for k, (status, _) in statuses.items()}


def _states(base: dict, actions: list[dict], scripts: dict):
    """``base``: id -> document with optional _version, _seq_no, _primary_term; ``scripts``: name -> f(document, params) -> (document, op)."""
    meta = ("_version", "_seq_no", "_primary_term")
    states = {i: {"live": True, "version": d.get("_version"), "seq_no": d.get("_seq_no"), "term": d.get("_primary_term"), "writes": 0,
                  "doc": {k: v for k, v in d.items() if k not in meta}} for i, d in base.items()}
    out = {}
    for a in sorted(actions, key=lambda a: a["seq"]):
        s = states.setdefault(a["id"], {"live": False, "version": None, "seq_no": None, "term": None, "writes": 0, "doc": None})
        kind, v, doc = a.get("version_type"), a.get("version"), a.get("doc")
        ok = kind is None or s["version"] is None or (v > s["version"] if kind == "external" else v >= s["version"])
        if a.get("if_seq_no") is not None:
            ok = ok and s["live"] and not s["writes"] and (a["if_seq_no"], a.get("if_primary_term")) == (s["seq_no"], s["term"])
        status, reason, made = "conflict", None, None
        if not ok:
            reason = "version_conflict"
        elif a["op"] == "index":
            status, made = "updated" if s["live"] else "created", doc
        elif a["op"] == "create":
            status, reason, made = ("conflict", "document_exists", None) if s["live"] else ("created", None, doc)
        elif a["op"] == "delete":
            status, reason = ("deleted", None) if s["live"] else ("not_found", "document_missing")
        elif a["op"] != "update":
            reason = "unknown_op"
        elif a.get("script") is not None and a["script"] not in scripts:
            reason = "unknown_script"
        elif a.get("script") is not None and (s["live"] or a.get("scripted_upsert")):
            old = s["doc"] if s["live"] else a.get("upsert") or {k: None for k in ("name", "score")}
            made, op = scripts[a["script"]](old, a.get("params"))
            status = ("deleted" if s["live"] else "noop") if op == "delete" else "noop" if op == "none" else "updated" if s["live"] else "created"
        elif s["live"]:
            made = s["doc"] | {k: x for k, x in doc.items() if x is not None}
            status = "noop" if a.get("detect_noop", True) and made == s["doc"] else "updated"
        elif a.get("doc_as_upsert"):  # wins over an upsert document
            status, made = "created", doc
        elif a.get("upsert") is not None:
            status, made = "created", a["upsert"]
        else:
            status, reason = "not_found", "document_missing"
        if status in ("created", "updated", "deleted"):
            s["live"], s["doc"] = status != "deleted", made if status != "deleted" else None
            s["version"] = v if kind is not None else (s["version"] or 0) + 1
            s["seq_no"], s["term"], s["writes"] = a["seq"], 1 if s["term"] is None else s["term"], s["writes"] + 1
        out[a["seq"]] = (status, reason)
    return states, out


@pytest.mark.parametrize("seed,versioned", [(1, False), (2, False), (3, True), (4, True)])
def test_bulk_matches_sequential_fold(spark, seed, versioned):
    rnd = random.Random(seed)
    base = {i: {"name": f"n{i}", "score": i * 1.0} for i in range(6)}
    actions = []
    for s in range(60):
        op = rnd.choice(["index", "create", "update", "update", "delete"])
        doc = {"name": rnd.choice([None, f"x{s}", "same"]) if op == "update" else f"x{s}", "score": rnd.choice([None, float(s)]) if op == "update" else float(s)}
        a = {"seq": s * 3 + rnd.randint(0, 2), "op": op, "id": rnd.randint(0, 9), "doc": doc,
             "upsert": {"name": "up", "score": -1.0} if op == "update" and rnd.random() < 0.3 else None,
             "doc_as_upsert": op == "update" and rnd.random() < 0.3}
        if versioned:
            a["version"] = rnd.randint(0, 20)
            a["version_type"] = rnd.choice(["external", "external_gte"])
        actions.append(a)
    exp_table, exp_status = _fold(base, actions)
    bdf = spark.createDataFrame([(k, v["name"], v["score"]) for k, v in base.items()], "id int, name string, score double")
    schema = ("seq long, op string, id int, doc struct<name string, score double>, upsert struct<name string, score double>, "
              "doc_as_upsert boolean" + (", version long, version_type string" if versioned else ""))
    arows = [(a["seq"], a["op"], a["id"], (a["doc"]["name"], a["doc"]["score"]),
              None if a["upsert"] is None else (a["upsert"]["name"], a["upsert"]["score"]), a["doc_as_upsert"])
             + ((a["version"], a["version_type"]) if versioned else ()) for a in actions]
    adf = spark.createDataFrame(arows, schema)
    for chunk in (None, 5):
        res = WR.bulk(bdf, adf, "id", chunk=chunk)
        got_table = {r.id: {"name": r.name, "score": r.score} for r in res.table.collect()}
        got_status = {r.seq: r.status for r in res.items.collect()}
        assert got_status == exp_status
        assert got_table == exp_table


SCRIPTS = {
    "add": {"score": "coalesce(score, 0) + params.n"},
    "rename": {"name": "concat(coalesce(name, '?'), '+')", "_op": "CASE WHEN length(name) > 6 THEN 'none' WHEN params.n = 3 THEN 'delete' ELSE 'index' END"},
    "swap score": {"name": "CAST(score AS STRING)", "score": "CAST(length(name) AS DOUBLE)"},
}


def _add(doc, params):
    return doc | {"score": (doc["score"] or 0) + params}, "index"


def _rename(doc, params):
    op = "none" if doc["name"] is not None and len(doc["name"]) > 6 else "delete" if params == 3 else "index"
    return doc | {"name": (doc["name"] or "?") + "+"}, op


def _swap(doc, params):
    return {"name": None if doc["score"] is None else repr(float(doc["score"])), "score": None if doc["name"] is None else float(len(doc["name"]))}, "index"


@pytest.mark.parametrize("seed", range(4))
def test_bulk_with_versions_and_scripts_matches_sequential_fold(spark, seed):
    rnd = random.Random(seed)
    base = {i: {"name": f"n{i}", "score": i * 1.0, "_version": rnd.choice([None, 1, 10]), "_seq_no": 1000 + i, "_primary_term": 1} for i in range(6)}
    actions = []
    for s in range(150):
        op = rnd.choice(["index", "create", "update", "update", "update", "update", "delete", "what"] if rnd.random() < 0.2 else ["update", "update", "index"])
        part = op == "update"
        a = {"seq": s * 3 + rnd.randint(0, 2), "op": op, "id": rnd.choice([0, 0, 0, *range(10)]),
             "doc": {"name": rnd.choice([None, "same", f"x{s}"]) if part else f"x{s}", "score": rnd.choice([None, 1.0]) if part else float(s)},
             "upsert": {"name": "up", "score": -1.0} if part and rnd.random() < 0.3 else None, "doc_as_upsert": part and rnd.random() < 0.2,
             "detect_noop": rnd.random() < 0.8, "params": rnd.randint(0, 3), "scripted_upsert": rnd.random() < 0.4,
             "script": rnd.choice([None, "add", "rename", "swap score", "missing"]) if part else None}
        if not part and rnd.random() < 0.5:
            a |= {"version": rnd.randint(0, 30), "version_type": rnd.choice(["external", "external_gte"])}
        elif rnd.random() < 0.2:
            a |= {"if_seq_no": 1000 + rnd.randint(0, 6), "if_primary_term": rnd.choice([1, 1, 2])}
        actions.append(a)
    states, expected = _states(base, actions, {"add": _add, "rename": _rename, "swap score": _swap})
    pair = lambda d: None if d is None else (d["name"], d["score"])
    bdf = spark.createDataFrame([(k, v["name"], v["score"], v["_version"], v["_seq_no"], v["_primary_term"]) for k, v in base.items()],
                                "id int, name string, score double, _version long, _seq_no long, _primary_term long")
    adf = spark.createDataFrame(
        [(a["seq"], a["op"], a["id"], pair(a["doc"]), pair(a["upsert"]), a["doc_as_upsert"], a["detect_noop"], a["script"], (a["params"],), a["scripted_upsert"],
          a.get("version"), a.get("version_type"), a.get("if_seq_no"), a.get("if_primary_term")) for a in actions],
        "seq long, op string, id int, doc struct<name string, score double>, upsert struct<name string, score double>, doc_as_upsert boolean, detect_noop boolean, "
        "script string, params struct<n int>, scripted_upsert boolean, version long, version_type string, if_seq_no long, if_primary_term long")
    for chunk in (None, 7):
        res = WR.bulk(bdf, adf, "id", chunk=chunk, scripts=SCRIPTS)
        assert {r.seq: (r.status, r.reason) for r in res.items.collect()} == expected
        got = {r.id: (r.name, r.score, r._version, r._seq_no, r._primary_term) for r in res.table.collect()}
        assert got == {i: (s["doc"]["name"], s["doc"]["score"], s["version"], s["seq_no"], s["term"]) for i, s in states.items() if s["live"]}
    assert {s for s, _ in expected.values()} >= {"created", "updated", "deleted", "conflict"}


def test_failed_actions_leave_the_version(spark):
    base = spark.createDataFrame([(1, "a", 100)], "id int, name string, _version long")

    def statuses(*acts):
        rows = [(s, op, 1, ("x",), v, "external" if v else None) for s, (op, v) in enumerate(acts)]
        res = WR.bulk(base, spark.createDataFrame(rows, "seq long, op string, id int, doc struct<name string>, version long, version_type string"), "id")
        return [r.status for r in res.items.orderBy("seq").collect()]

    assert statuses(("create", 900), ("index", 500)) == ["conflict", "updated"]
    assert statuses(("index", None), ("index", 101)) == ["updated", "conflict"]
    assert statuses(("delete", None), ("create", 101), ("create", 102), ("delete", 102)) == ["deleted", "conflict", "created", "conflict"]


def test_actions_without_an_id_are_one_document_in_every_round(spark):
    base = spark.createDataFrame([(1, "a")], "id int, name string")
    acts = spark.createDataFrame([(s, "create" if s == 0 else "update", None, (f"n{s}",)) for s in range(7)] + [(9, "update", 1, ("b",))],
                                 "seq long, op string, id int, doc struct<name string>")
    for chunk in (None, 2):
        res = WR.bulk(base, acts, "id", chunk=chunk)
        assert [r.status for r in res.items.orderBy("seq").collect()] == ["created"] + ["updated"] * 7
        assert sorted(map(tuple, res.table.collect()), key=str) == [(1, "b"), (None, "n6")]


def test_partial_updates_merge_structs_field_by_field(spark):
    base = spark.createDataFrame([(1, ((1, "x"), 5))], "id int, d struct<in struct<a int, b string>, c int>")
    acts = spark.createDataFrame([(1, "update", 1, (((None, "y"), None),)), (2, "update", 1, (((1, None), 5),))],
                                 "seq long, op string, id int, doc struct<d struct<in struct<a int, b string>, c int>>")
    res = WR.bulk(base, acts, "id")
    assert [r.status for r in res.items.orderBy("seq").collect()] == ["updated", "noop"]
    assert res.table.first().d.asDict(True) == {"in": {"a": 1, "b": "y"}, "c": 5}
    with pytest.raises(ValueError):
        WR.bulk(base, acts, "id", scripts={"bad": {"nothing": "1"}})


def _slop_match(tokens, terms, slop):
    n = len(tokens)
    for i in range(n):
        if tokens[i] != terms[0]:
            continue
        ok = True
        for k in range(1, len(terms)):
            lo, hi = max(i + k - slop, 0), min(i + k + slop, n - 1)
            if not any(tokens[j] == terms[k] for j in range(lo, hi + 1)):
                ok = False
                break
        if ok:
            return True
    return False


@pytest.mark.parametrize("phrase,slop", [("the and", 2), ("of the", 1), ("und der", 3), ("the of", 0)])
def test_phrase_slop_matches_python(spark, phrase, slop):
    docs = TB.read(spark, SF_SMALL, "documents").select("doc_id", "text")
    got = {r.doc_id for r in Search(docs, "doc_id").query(Q.MatchPhrase("text", phrase, slop=slop)).matched().collect()}
    terms = analyze(phrase)
    exp = set()
    for r in docs.collect():
        toks = re.findall(r"[^\W_]+", (r.text or "").lower())
        if _slop_match(toks, terms, slop):
            exp.add(r.doc_id)
    assert got == exp


def test_random_score_independent_of_partitioning(spark):
    part = TB.read(spark, SF_SMALL, "part")
    fs = FunctionScore(Q.MatchAll(), [RandomScore(seed=3, field="p_partkey")], boost_mode="replace")
    a = {r.p_partkey: r._score for r in Search(part.repartition(1), "p_partkey").query(fs).matched().collect()}
    b = {r.p_partkey: r._score for r in Search(part.repartition(8), "p_partkey").query(fs).matched().collect()}
    assert a == b and all(0 <= v < 1 for v in a.values())


def test_terms_partition_include_covers_all_terms_once(spark):
    part = TB.read(spark, SF_SMALL, "part")
    seen = []
    for i in range(4):
        a = Search(part, "p_partkey").aggs(b=A.TermsAgg("p_brand", size=None, include={"partition": i, "num_partitions": 4})).aggregations()["b"]
        seen += [r.b for r in a.collect()]
    assert sorted(seen) == sorted(r[0] for r in part.select("p_brand").distinct().collect())


@pytest.mark.parametrize("name", ["e14_e19_nested_buckets", "f3_f4_facet_union", "f9_f10_attr_facet", "j2_has_child_score_modes",
                                  "e11_median_absolute_deviation", "w6_bulk_items", "r11_rescore"])
def test_partition_count_invariance(spark, name):
    import __spark_entry__ as E
    fn = E.queries()[name]
    prev = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        one = sorted(map(tuple, fn(spark, SF_SMALL).collect()), key=repr)
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        eight = sorted(map(tuple, fn(spark, SF_SMALL).collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", prev)
    assert one == eight


def test_stored_text_statistics_give_identical_scores(spark):
    from docsift.functions.text import collection_stats
    docs = TB.read(spark, SF_SMALL, "documents").select("doc_id", "text")
    stats = collection_stats(docs, "text").cache()
    for q in (Q.Match("text", "the und zzz"), Q.MatchPhrase("text", "of the"), Q.Bool(should=[Q.Match("text", "la"), Q.Match("text", "der")])):
        a = {r.doc_id: r._score for r in Search(docs, "doc_id").query(q).matched().collect()}
        b = {r.doc_id: r._score for r in Search(docs, "doc_id").with_text_stats("text", stats).query(q).matched().collect()}
        assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-9 for k in a)
    stats.unpersist()
