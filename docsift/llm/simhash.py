"""SimHash near-duplicates: segment-popcount embedding and a grid range join.

``fingerprints`` hashes a document's word shingles to one 64-bit SimHash.

Two fingerprints link if they differ in at most ``max_bits`` bits.  A fingerprint
is cut into segments, and its embedding is the vector of the segments' bit
counts; the Manhattan distance of two embeddings is a lower bound of the Hamming
distance, so links are only looked for between embeddings within ``max_bits`` of
each other.  That is a range join on a unit grid: every point is put into the
cells within half the radius, so two points within the radius meet in a cell
between them, and the pairs of a cell are verified exactly.

Copies share a fingerprint, and only distinct fingerprints are joined.  A cell
with many points (a large group of near copies) is not expanded into pairs: its
points are embedded anew with one-bit segments, where Manhattan and Hamming
distance are the same, so meeting in a cell is the verification and each point
needs one link to its cell's smallest point.  Work therefore grows with the
number of points, however large a group is.  Cells are counted by grouping, which
combines map-side, and the counts are joined back, so a hot cell is no one task's.

A point has 33 or 65 cells, but Spark takes a table for about as large after an
explode as before, and packed files for as large as their rows.  So cells are
merged, never broadcast, and other tables are broadcast only up to
``BROADCAST_ROWS`` rows (and Spark's own threshold).

Components come from min-label propagation with pointer jumping over the links,
checkpointed each round; a round's table is deleted once the next one stands.

Edge cases: a null or empty text has no words and fingerprint zero, and is
linked like any other; fewer words than the shingle length make one shingle;
repeated rows share fingerprint and component; rows with a null doc_id take part
(the component is the smallest non-null doc_id, null if there is none); an empty
table gives an empty result; other columns are ignored, or kept by
``deduplicate``, which keeps one row of each component whatever its ids are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsift.llm.common import discard, written

SEGMENTS = 16
DENSE = 24  # points of a cell from which it is refined instead of paired
BROADCAST_ROWS = 100_000  # of a table of fingerprints; some 65 bytes each in the driver
_LOWER = bytes(i + 32 if 65 <= i <= 90 else i for i in range(256))
_BLANKS = bytes(32 if 9 <= i <= 13 else i for i in range(256))
_CHUNK = 1 << 16
_ROWS = 1000  # of an Arrow batch handled at once


def _hashes(text: str | None, shingle: int) -> Iterator[np.ndarray]:
    """XXH64 (seed 42) of the word shingles of the lower-cased (A-Z) text, some at a time."""
    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).translate(_BLANKS).split(b" ") if text else []
    words = [w for w in words if w]
    n = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    for lo in range(0, n if words else 0, _CHUNK):  # bounded memory for very long texts
        part = words[lo:lo + _CHUNK + shingle - 1] if n > 1 else words
        joined = map(b" ".join, zip(*[part[i:] for i in range(shingle)])) if n > 1 else [b" ".join(part)]
        yield np.fromiter((digest(s, 42) for s in joined), dtype=np.uint64)


def _majority(parts: list[np.ndarray]) -> int:
    ones, n = np.zeros(64, dtype=np.int64), 0
    for h in parts:
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(h)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def simhash(text: str | None, shingle: int = 3) -> int:
    """Signed 64-bit SimHash of the text's word shingles; 0 without words."""
    return _majority(list(_hashes(text, shingle)))


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """fp (signed 64-bit SimHash of the whole text) and the other columns, without the text, of every row."""
    kept = [f for f in docs.schema.fields if f.name not in ("text", "fp")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, _ROWS):
                part = b.slice(lo, _ROWS)
                fp = pa.array([simhash(t.as_py(), shingle) for t in part.column("text")], pa.int64())
                yield pa.RecordBatch.from_arrays([*(part.column(f.name) for f in kept), fp], names=[*(f.name for f in kept), "fp"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return docs.select(*(f.name for f in kept), "text").mapInArrow(run, schema + ", fp bigint")


def _cells(points: DataFrame, segments: int) -> DataFrame:
    """(fp, cell): the cells within Manhattan distance 1 of each point's embedding.

    With one-bit segments the embedding is the fingerprint itself, and a cell is
    exact.  Otherwise a cell is the xor of one hash per (segment, count), so a
    neighbour is two xors away; cells that collide only add candidates.
    """
    fp = F.col("fp")
    if segments == 64:
        flipped = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: fp.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i)))
        return points.select("fp", F.explode(F.concat(F.array(fp), flipped)).alias("cell"))
    width = 64 // segments
    mask = F.lit((1 << width) - 1).cast("long")
    count = lambda i: F.bit_count(F.call_function("shiftrightunsigned", fp, i * width).bitwiseAND(mask))
    code = lambda i, c: F.xxhash64(i, c)
    points = points.select("fp", F.transform(F.sequence(F.lit(0), F.lit(segments - 1)), count).alias("counts"))
    codes = F.transform("counts", lambda c, i: code(i, c))
    points = points.select("fp", "counts", F.aggregate(codes, F.lit(0).cast("long"), lambda h, x: h.bitwiseXOR(x)).alias("home"))
    step = lambda ok, to: F.transform("counts", lambda c, i: F.when(
        ok(c), F.col("home").bitwiseXOR(code(i, c)).bitwiseXOR(code(i, to(c)))))
    cells = F.concat(F.array("home"), step(lambda c: c < width, lambda c: c + 1), step(lambda c: c > 0, lambda c: c - 1))
    return points.select("fp", F.explode(cells).alias("cell")).where("cell IS NOT NULL")


def _merged(table: DataFrame, large: bool = True) -> DataFrame:
    """``table``, not to be broadcast (nor what it is joined to) if ``large``."""
    return table.hint("merge") if large else table


def links(points: DataFrame, segments: int = SEGMENTS, dense: int = DENSE) -> DataFrame:
    """(a, b): links between distinct fingerprints ``points.fp`` at two or fewer
    differing bits.  Every such pair is linked directly, or, in a dense cell,
    through the cell's smallest point."""
    cells = _cells(points, segments)
    shared = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = written(cells.join(_merged(shared), "cell"), "simhash-cells")
    small = met.where(F.col("n") <= dense).groupBy("cell").agg(F.collect_list("fp").alias("fps"))
    small = small.select(F.explode("fps").alias("a"), "fps")
    near = F.filter("fps", lambda x: (x > F.col("a")) & (F.bit_count(x.bitwiseXOR(F.col("a"))) <= 2))
    small = small.select("a", F.explode(near).alias("b"))
    again = _cells(met.where(F.col("n") > dense).select("fp").distinct(), 64)
    least = again.groupBy("cell").agg(F.min("fp").alias("a"))
    star = again.join(_merged(least), "cell").where("a < fp").select("a", F.col("fp").alias("b"))
    return small.union(star).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(fp, root): the smallest fingerprint reachable over ``edges`` (a, b), for every linked one."""
    both = written(edges.union(edges.select("b", "a")), "simhash-links")
    label = written(both.groupBy(F.col("a").alias("fp")).agg(F.min(F.least("a", "b")).alias("root")), "simhash-label")
    large = label.count() > BROADCAST_ROWS  # as many in each round
    while True:
        seen = both.join(_merged(label, large), both["b"] == label["fp"]).groupBy(F.col("a").alias("fp")).agg(F.min("root").alias("near"))
        step = label.join(_merged(seen, large), "fp").select("fp", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        up = step.select(F.col("fp").alias("root"), F.col("root").alias("up"))
        before, label = label, written(step.join(_merged(up, large), "root").select(
            "fp", F.col("up").alias("root"), (F.col("old") != F.col("up")).alias("moved")), "simhash-label")
        discard(before)
        if label.where("moved").isEmpty():
            discard(both)
            return label.select("fp", "root")


def _classes(points: DataFrame, found: DataFrame) -> DataFrame:
    """(fp, least): the smallest ``first`` reachable from each of ``points`` (fp, first) over the links ``found``."""
    roots = components(found)
    rooted = points.join(_merged(roots, roots.count() > BROADCAST_ROWS), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("first").alias("least"))
    return written(rooted.join(lowest, "root").select("fp", "least"), "simhash-classes")


def near_duplicates(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """doc_id, fp, component_id of every row: the smallest doc_id reachable over links."""
    fps = written(fingerprints(docs.select("doc_id", "text"), shingle), "simhash-fps")
    points = written(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-points")
    classes = _classes(points, links(points.select("fp")))
    return fps.join(_merged(classes, classes.count() > BROADCAST_ROWS), "fp").select("doc_id", "fp", F.col("least").alias("component_id"))


def _text_key(text: Column) -> Column:
    return F.coalesce(F.md5(text.cast("binary")), F.lit("null"))


def deduplicate(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """One row of ``docs``, with all its columns, of each component: the one of smallest doc_id, null last.

    A row goes by its doc_id and a digest of its text, so texts that share an id
    or have none are told apart; of rows equal in both one stays.
    """
    keyed = docs.select("doc_id", "text", _text_key(F.col("text")).alias("key"))
    fps = written(fingerprints(keyed, shingle), "simhash-fps")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "key")).alias("first")
    points = written(fps.groupBy("fp").agg(first), "simhash-points")
    stays = _classes(points, links(points.select("fp"))).select(F.col("least.doc_id").alias("__stays"), F.col("least.key").alias("__key")).distinct()
    stays = written(stays, "simhash-stays")
    repeated = fps.join(stays, fps["doc_id"].eqNullSafe(stays["__stays"]) & (fps["key"] == stays["__key"]))
    repeated = repeated.groupBy("doc_id", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    kept = docs.join(stays, docs["doc_id"].eqNullSafe(stays["__stays"]) & (_text_key(docs["text"]) == stays["__key"]), "left_semi")
    return kept if repeated.isEmpty() else kept.dropDuplicates(["doc_id", "text"])


def op10(spark, sf_dir):
    from docsift.llm.common import read

    out = near_duplicates(read(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
