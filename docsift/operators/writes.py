"""Keyed writes: bulk actions merged into a table, update and delete by query.

Tables are DataFrames with an id column, document columns and optional
``_version`` / ``_seq_no`` / ``_primary_term`` metadata.  Nothing is modified
in place: every operation returns the new table (and a report) as DataFrames;
the caller writes them (e.g. Parquet into a new folder).

Bulk actions (one row each):

=================== ===========================================================
``seq``              bigint, unique; the order of the request
``op``               ``index`` | ``create`` | ``update`` | ``delete``
``id``               document id
``doc``              struct of document fields (update: partial, null = unset;
                     structs inside are merged field by field)
``upsert``           struct, update only: document to create when missing
``doc_as_upsert``    boolean, update only: create from ``doc`` when missing
``detect_noop``      boolean (default true): an update by ``doc`` that changes
                     nothing is a noop
``script``           update only: name of one of the request's ``scripts``,
                     applied to the document instead of ``doc``
``params``           struct, read by the script as ``params.<field>``
``scripted_upsert``  boolean: the script also runs when the document is missing,
                     on ``upsert`` (or a document of nulls)
``version``          bigint, with ``version_type`` ``external`` (>) / ``external_gte`` (>=)
``if_seq_no``        bigint, with ``if_primary_term``: write only if the stored
                     document has these and the request has not written it yet
=================== ===========================================================

Actions apply in order per id; each sees the effect of the earlier ones.  An
action is a transition of the id's state (live, version, document): a failed one
(``conflict``, ``not_found``) and a ``noop`` change nothing, a plain write adds
one to the version, a versioned one sets it, and a deleted document's version
stays behind for the actions after it.

The transition is one expression, folded over an id's actions in the JVM
(``aggregate``).  An id's actions are shuffled once; the base table is only read
where an id matches.  At most ``chunk`` actions of an id meet in a row: a hotter
id takes several rounds, each of which folds the next ``chunk`` actions of all such
ids in parallel and writes their states.  Scripts may do anything with a
document, so an id's actions have no shorter way than one after the other.

Statuses: ``created``, ``updated``, ``deleted``, ``noop``, ``not_found``,
``conflict``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsift.functions.scripts import Script, as_script
from docsift.operators.query import Ctx, Query
from docsift.session import stored

__all__ = ["BulkResult", "VersionConflict", "bulk", "update_by_query", "delete_by_query", "ACTION_COLUMNS"]

ACTION_COLUMNS = ("seq", "op", "id", "doc", "upsert", "doc_as_upsert", "detect_noop", "script", "params", "scripted_upsert", "version",
                  "version_type", "if_seq_no", "if_primary_term")
CHUNK = 4096
_META = ("_version", "_seq_no", "_primary_term")
_RUN = 64  # actions of an id whose items are gathered together
_BLOCK = 1 << 20  # consecutive values of seq in which an id's actions are numbered


@dataclass
class BulkResult:
    table: DataFrame   # new table (same columns as the base)
    items: DataFrame   # seq, id, op, status, reason
    changes: DataFrame | None = None  # the written ids: id, document columns, _version, _seq_no, _primary_term and _live (false: deleted)


def _normalize_actions(actions: DataFrame, doc_type: T.StructType) -> DataFrame:
    cols = set(actions.columns)

    def opt(name: str, t) -> Column:
        return (F.col(name) if name in cols else F.lit(None)).cast(t)

    return actions.select(
        "id", F.struct(
            F.col("seq").cast("long").alias("seq"), F.lower(F.col("op")).alias("op"), opt("doc", doc_type).alias("doc"), opt("upsert", doc_type).alias("upsert"),
            F.coalesce(opt("doc_as_upsert", "boolean"), F.lit(False)).alias("doc_as_upsert"),
            F.coalesce(opt("detect_noop", "boolean"), F.lit(True)).alias("detect_noop"),
            opt("script", "string").alias("script"), (F.col("params") if "params" in cols else F.lit(None).cast("string")).alias("params"),
            F.coalesce(opt("scripted_upsert", "boolean"), F.lit(False)).alias("scripted_upsert"),
            opt("version", "long").alias("version"), opt("version_type", "string").alias("version_type"),
            opt("if_seq_no", "long").alias("if_seq_no"), opt("if_primary_term", "long").alias("if_primary_term")).alias("a"))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _struct(fields: list[tuple[str, str]]) -> str:
    return "named_struct(" + ", ".join(f"{_text(n)}, {v}" for n, v in fields) + ")"


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``."""
    return f"transform(array({value}), {_quoted(name)} -> {body})[0]"


def _merged(old: str, patch: str, kind: T.DataType) -> str:
    """SQL of the old value with what the patch sets; structs field by field."""
    if not isinstance(kind, T.StructType):
        return f"coalesce({patch}, {old})"
    both = _struct([(f.name, _merged(f"{old}.{_quoted(f.name)}", f"{patch}.{_quoted(f.name)}", f.dataType)) for f in kind.fields])
    return f"CASE WHEN {patch} IS NULL THEN {old} WHEN {old} IS NULL THEN {patch} ELSE {both} END"


def _scripted(script: dict, doc: str, doc_type: T.StructType) -> str:
    """SQL of (doc, op) after a script: expressions for fields, and ``_op`` (``index`` | ``none`` | ``delete``)."""
    unknown = set(script) - {f.name for f in doc_type.fields} - {"_op"}
    if unknown:
        raise ValueError(f"a script sets unknown fields: {sorted(unknown)}")
    sql = {k: v.sql() if isinstance(v, Script) else v for k, v in script.items()}
    own = _struct([(f.name, f"CAST(({sql[f.name]}) AS {f.dataType.simpleString()})" if f.name in sql else f"{doc}.{_quoted(f.name)}") for f in doc_type.fields])
    body = _struct([("doc", own), ("op", f"CAST(({sql['_op']}) AS STRING)" if "_op" in sql else "'index'")])
    used = " ".join(sql.values())
    for f in doc_type.fields:  # the fields that the script names stand for the document's
        if re.search(rf"(?<!\w){re.escape(f.name)}(?!\w)", used):
            body = _let(f.name, f"{doc}.{_quoted(f.name)}", body)
    return _let("params", "a.params", body) if re.search(r"(?<!\w)params(?!\w)", used) else body


def _transition(doc_type: T.StructType, scripts: dict[str, dict]) -> str:
    """SQL of the state after action ``a`` in state ``s``."""
    external = ("a.version_type IS NULL OR s.version IS NULL AND a.version IS NOT NULL OR (a.version_type = 'external' AND a.version > s.version)"
                " OR (a.version_type = 'external_gte' AND a.version >= s.version)")
    numbered = "a.if_seq_no IS NULL OR (s.live AND s.writes = 0 AND a.if_seq_no = s.seq_no AND a.if_primary_term <=> s.term)"
    nothing = f"CAST(NULL AS {doc_type.simpleString()})"
    start = f"CASE WHEN s.live THEN s.doc WHEN a.upsert IS NOT NULL THEN a.upsert ELSE {_struct([(f.name, f'CAST(NULL AS {f.dataType.simpleString()})') for f in doc_type.fields])} END"
    none = _struct([("doc", nothing), ("op", "CAST(NULL AS STRING)")])
    if scripts:
        cases = " ".join(f"WHEN a.script = {_text(name)} THEN {_scripted(script, 'old', doc_type)}" for name, script in scripts.items())
        run = _let("old", start, f"CASE {cases} ELSE {none} END")
        run = f"CASE WHEN a.op = 'update' AND a.script IS NOT NULL AND (s.live OR a.scripted_upsert) THEN {run} ELSE {none} END"
    else:
        run = none
    known = "a.script IN (" + ", ".join(map(_text, scripts)) + ")" if scripts else "false"
    names = {f.name for f in doc_type.fields}
    merged = _merged("s.doc", "a.doc", doc_type) if names else "s.doc"
    made = (f"CASE WHEN a.op IN ('index', 'create') THEN a.doc WHEN a.op <> 'update' THEN {nothing} WHEN a.script IS NOT NULL AND (s.live OR a.scripted_upsert)"
            f" THEN run.doc WHEN s.live THEN {merged} WHEN a.doc_as_upsert THEN a.doc ELSE a.upsert END")
    status = ("CASE WHEN NOT ok THEN 'conflict' WHEN a.op = 'index' THEN IF(s.live, 'updated', 'created') WHEN a.op = 'create' THEN IF(s.live, 'conflict', 'created')"
              " WHEN a.op = 'delete' THEN IF(s.live, 'deleted', 'not_found') WHEN a.op = 'update' THEN"
              f" CASE WHEN a.script IS NOT NULL AND NOT {known} THEN 'conflict'"
              "  WHEN a.script IS NOT NULL AND (s.live OR a.scripted_upsert) THEN CASE WHEN run.op = 'delete' THEN IF(s.live, 'deleted', 'noop')"
              "   WHEN run.op IN ('none', 'noop') THEN 'noop' ELSE IF(s.live, 'updated', 'created') END"
              "  WHEN s.live THEN IF(a.detect_noop AND made <=> s.doc, 'noop', 'updated')"
              "  WHEN a.upsert IS NOT NULL OR a.doc_as_upsert THEN 'created' ELSE 'not_found' END ELSE 'conflict' END")
    reason = ("CASE WHEN NOT ok THEN 'version_conflict' WHEN a.op IS NULL OR a.op NOT IN ('index', 'create', 'update', 'delete') THEN 'unknown_op'"
              f" WHEN a.op = 'update' AND a.script IS NOT NULL AND NOT {known} THEN 'unknown_script'"
              " WHEN status = 'conflict' THEN 'document_exists' WHEN status = 'not_found' THEN 'document_missing' END")
    wrote = "status IN ('created', 'updated', 'deleted')"
    after = _struct([
        ("live", f"CASE WHEN status IN ('created', 'updated') THEN true WHEN status = 'deleted' THEN false ELSE s.live END"),
        ("version", f"CASE WHEN NOT {wrote} THEN s.version WHEN a.version_type IS NOT NULL THEN a.version ELSE coalesce(s.version, 0) + 1 END"),
        ("seq_no", f"IF({wrote}, a.seq, s.seq_no)"), ("term", f"IF({wrote}, coalesce(s.term, 1L), s.term)"),
        ("writes", f"s.writes + IF({wrote}, 1L, 0L)"),
        ("doc", f"CASE WHEN status IN ('created', 'updated') THEN made WHEN status = 'deleted' THEN {nothing} ELSE s.doc END"),
        ("item", _struct([("seq", "a.seq"), ("op", "a.op"), ("status", "status"), ("reason", reason)]))])
    return _let("ok", f"coalesce({external}, false) AND coalesce({numbered}, false)", _let("run", run, _let("made", made, _let("status", status, after))))


def _folded(actions: DataFrame, states: DataFrame, kind: T.StructType, step: str, later: bool = False) -> DataFrame:
    """(id, state, items): each id's state after its actions (id, a), from ``states`` (id, state) where it has one, and their items.

    Every step of an ``aggregate`` copies what it has gathered.  So a run of
    actions gathers its own items only, and the id's actions its runs: no step
    copies all items of an id.  A step takes up the item that the step before
    left in the state.
    """
    acts = actions.groupBy("id").agg(F.collect_list("a").alias("acts"))
    begin = {"live": F.lit(False), "writes": F.lit(0)}
    fresh = F.struct(*[begin.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in kind.fields])
    known = states.select(F.col("id").alias("of"), "state")
    # stored ids match as keys do; actions without an id are one document of the request, also from round to round
    both = acts.join(known, F.col("id").eqNullSafe(F.col("of")) if later else F.col("id") == F.col("of"), "left").withColumn("state", F.coalesce(F.col("state"), fresh).cast(kind))
    ordered = "array_sort(acts, (l, r) -> CASE WHEN l.seq < r.seq THEN -1 WHEN l.seq > r.seq THEN 1 ELSE 0 END)"
    item = kind["item"].dataType.simpleString()
    last = "concat(y.items, array(y.s.item))"
    one = (f"aggregate(run, {_struct([('s', 'z.done.s'), ('items', f'CAST(array() AS array<{item}>)')])},"
           f" (y, a) -> {_struct([('s', _let('s', 'y.s', step)), ('items', last)])}, y -> {_struct([('s', 'y.s'), ('items', f'slice({last}, 2, {_RUN})')])})")
    none = _struct([("s", "state"), ("items", f"CAST(array() AS array<{item}>)")])
    start = _struct([("done", none), ("runs", f"CAST(array() AS array<array<{item}>>)")])
    runs = f"transform(sequence(0, (size(acts) - 1) div {_RUN}), i -> slice(ordered, CAST(i * {_RUN} + 1 AS INT), {_RUN}))"
    all_runs = "concat(z.runs, array(z.done.items))"
    fold = f"aggregate({runs}, {start}, (z, run) -> {_struct([('done', one), ('runs', all_runs)])}, z -> {_struct([('state', 'z.done.s'), ('items', f'flatten({all_runs})')])})"
    done = both.select("id", F.expr(_let("ordered", ordered, fold)).alias("done"))
    return done.select("id", F.col("done.state").cast(kind).alias("state"), "done.items")


def _rounds(actions: DataFrame, chunk: int) -> DataFrame:
    """``actions`` with ``round``: the how-manieth ``chunk`` of its id's actions one belongs to.

    Numbered inside blocks of consecutive ``seq`` values, then by a running sum
    over the blocks' counts, so a hot id is spread over its blocks.
    """
    a = actions.withColumn("block", F.floor(F.col("a.seq") / F.lit(_BLOCK)))
    inside = F.row_number().over(Window.partitionBy("id", "block").orderBy(F.col("a.seq")))
    earlier = Window.partitionBy("id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = a.groupBy("id", "block").agg(F.count(F.lit(1)).alias("n")).select(
        F.col("id").alias("of"), F.col("block").alias("at"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    a = a.withColumn("inside", inside).join(sizes, F.col("id").eqNullSafe(F.col("of")) & (F.col("block") == F.col("at")))
    return a.select("id", "a", F.floor((F.col("before") + F.col("inside") - 1) / F.lit(chunk)).alias("round"))


def bulk(base: DataFrame, actions: DataFrame, id_col: str, chunk: int | None = None, scripts: dict[str, dict] | None = None,
         tombstones: DataFrame | None = None) -> BulkResult:
    """Apply ``actions`` to ``base``.

    ``tombstones``: deleted documents (id, _version, _seq_no, _primary_term) whose
    versions still count.

    ``scripts``: name -> {field: SQL expression over the document's fields and
    ``params``, or Script}; the key ``_op`` may give ``index``, ``none`` (noop) or
    ``delete``.  ``chunk``: actions of an id that are folded in one row.
    """
    doc_fields = [f for f in base.schema.fields if f.name != id_col and f.name not in _META]
    doc_type = T.StructType([T.StructField(f.name, f.dataType) for f in doc_fields])
    names = [f.name for f in doc_fields]
    chunk = chunk or CHUNK
    item = T.StructType([T.StructField("seq", T.LongType())] + [T.StructField(n, T.StringType()) for n in ("op", "status", "reason")])
    kind = T.StructType([T.StructField("live", T.BooleanType()), *(T.StructField(n, T.LongType()) for n in ("version", "seq_no", "term", "writes")),
                         T.StructField("doc", doc_type), T.StructField("item", item)])
    step = _transition(doc_type, scripts or {})
    a = _normalize_actions(actions, doc_type)
    meta = {m: (F.col(m) if m in base.columns else F.lit(None)).cast("long") for m in _META}
    state = F.struct(F.lit(True).alias("live"), meta["_version"].alias("version"), meta["_seq_no"].alias("seq_no"), meta["_primary_term"].alias("term"),
                     F.lit(0).cast("long").alias("writes"), F.struct(*names).cast(doc_type).alias("doc"), F.lit(None).cast(item).alias("item"))
    # only rows that an action names are folded; few ids are broadcast, by Spark's own size check
    named = base.withColumn("id", F.col(id_col)).join(a.select("id").distinct(), "id", "left_semi").select("id", state.cast(kind).alias("state"))
    if tombstones is not None:
        gone = F.struct(F.lit(False).alias("live"), *(F.col(m).cast("long").alias(n) for m, n in zip(_META, ("version", "seq_no", "term"))),
                        F.lit(0).cast("long").alias("writes"), F.lit(None).cast(doc_type).alias("doc"), F.lit(None).cast(item).alias("item"))
        named = named.unionByName(tombstones.withColumn("id", F.col(id_col)).select("id", gone.cast(kind).alias("state")))
    most = a.groupBy("id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    if most <= chunk:
        done = _folded(a, named, kind, step)
        items = done
    else:
        a, rounds, parts, states = stored(_rounds(a, chunk), "bulk-actions"), -(-most // chunk), [], named
        again = a.groupBy("id").agg(F.max("round").alias("last"))
        for r in range(rounds):
            part = stored(_folded(a.where(F.col("round") == r).select("id", "a"), states, kind, step, r > 0), "bulk-states")
            parts.append(part)
            states = part.select("id", "state")
        items = parts[0].withColumn("round", F.lit(0))
        for r, part in enumerate(parts[1:], 1):
            items = items.unionByName(part.withColumn("round", F.lit(r)))
        done = items.join(again.select(F.col("id").alias("of"), "last"), F.col("id").eqNullSafe(F.col("of")) & (F.col("round") == F.col("last"))).select("id", "state")
    items = items.select("id", F.explode_outer("items").alias("i")).select("i.seq", "id", "i.op", "i.status", "i.reason")
    changed = done.where(F.col("state.writes") > 0)
    kept_meta = {"_version": F.col("state.version"), "_seq_no": F.col("state.seq_no"), "_primary_term": F.col("state.term")}
    changes = changed.select(F.col("id").cast(base.schema[id_col].dataType).alias(id_col), *(F.col("state.doc")[n].alias(n) for n in names),
                             *(c.alias(m) for m, c in kept_meta.items()), F.col("state.live").alias("_live"))
    untouched = base.join(changed.select(F.col("id").alias(id_col)), id_col, "left_anti")
    table = untouched.select(*base.columns).unionByName(changes.where("_live").select(*base.columns))
    return BulkResult(table=table, items=items, changes=changes)


def _assignments(assign: Any) -> dict[str, Column]:
    if isinstance(assign, dict):
        return {k: (as_script(v).column() if isinstance(v, str) else v) for k, v in assign.items()}
    raise TypeError("assignments must be a dict of column -> SQL expression or Column")


class VersionConflict(RuntimeError):
    """Documents changed between being read and being written."""


def _stamp(df: DataFrame) -> Column:
    """What tells whether a row is as it was read: its version numbers, or else all its columns."""
    meta = [m for m in _META if m in df.columns]
    return F.struct(*meta) if meta else F.xxhash64(*sorted(df.columns))


def update_by_query(df: DataFrame, id_col: str, query: Query, assign: dict, max_docs: int | None = None,
                    conflicts: str = "abort", current: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Apply ``assign`` (column -> SQL expression / Column) to rows matching
    ``query`` (and to at most ``max_docs`` of them, lowest ids first).

    Returns (new table, report with total, updated, noops).  Rows whose assigned
    values do not change are noops.  A changed row's ``_version``, where it has one,
    grows by one.

    ``current``: the table as it is at write time, where writers may have come
    between.  A row is written only if it is still as it was read (its versions,
    or all columns without any); others, and rows that are gone, are version
    conflicts.  ``conflicts="abort"`` raises ``VersionConflict`` if there is one and
    writes nothing; ``"proceed"`` leaves them and reports ``version_conflicts``.
    """
    if conflicts not in ("abort", "proceed"):
        raise ValueError(f"conflicts must be abort or proceed, not {conflicts}")
    ctx = Ctx(df, id_col)
    match = query.predicate(ctx)
    d = ctx.apply(df).withColumn("__m", match)
    if max_docs is not None:
        first = d.filter("__m").select(id_col).orderBy(id_col).limit(max_docs).withColumn("__sel", F.lit(True))
        d = d.join(first, id_col, "left").withColumn("__m", F.coalesce(F.col("__sel"), F.lit(False))).drop("__sel")
    lost = None
    if current is not None:
        read = d.where("__m").select(F.col(id_col).alias("__id"), _stamp(df).alias("__read"))
        now = current.withColumn("__now", _stamp(current))
        d = now.join(read, F.col(id_col) == F.col("__id"), "left").withColumn("__m", F.col("__id").isNotNull() & F.col("__read").eqNullSafe(F.col("__now")))
        asked = read.select(F.count(F.lit(1))).scalar()
        lost = (asked - d.select(F.count_if("__m")).scalar()).cast("bigint")
        if conflicts == "abort":
            n = df.sparkSession.range(1).select(lost.alias("n")).first().n
            if n:
                raise VersionConflict(f"{n} documents changed since they were read")
    assigns = _assignments(assign)
    changed = F.lit(False)
    for k, v in assigns.items():
        changed = changed | ~v.cast(df.schema[k].dataType).eqNullSafe(F.col(k))
    new_vals = {k: F.when(F.col("__m"), v.cast(df.schema[k].dataType)).otherwise(F.col(k)) for k, v in assigns.items()}
    d = d.withColumn("__chg", F.col("__m") & changed)
    report = d.agg(F.count_if("__m").cast("bigint").alias("total"), F.count_if("__chg").cast("bigint").alias("updated"),
                   F.count_if(F.col("__m") & ~F.col("__chg")).cast("bigint").alias("noops"))
    if lost is not None:
        report = report.withColumn("version_conflicts", lost).withColumn("total", F.col("total") + F.col("version_conflicts"))
    if "_version" in df.columns and "_version" not in assigns:
        new_vals["_version"] = F.when(F.col("__chg"), F.coalesce("_version", F.lit(0)) + 1).otherwise(F.col("_version")).cast(df.schema["_version"].dataType)
    out = d.withColumns(new_vals).select(*df.columns)
    return out, report


def delete_by_query(df: DataFrame, id_col: str, query: Query, max_docs: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Remove rows matching ``query`` (at most ``max_docs``, lowest ids first).
    Returns (new table, report with ``deleted``)."""
    ctx = Ctx(df, id_col)
    match = query.predicate(ctx)
    d = ctx.apply(df).withColumn("__m", match)
    if max_docs is not None:
        first = d.filter("__m").select(id_col).orderBy(id_col).limit(max_docs)
        out = df.join(first, id_col, "left_anti")
        report = first.agg(F.count(F.lit(1)).cast("bigint").alias("deleted"))
        return out.select(*df.columns), report
    report = d.agg(F.count_if("__m").cast("bigint").alias("deleted"))
    return d.filter(~F.col("__m")).select(*df.columns), report
