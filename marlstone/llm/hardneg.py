"""Hard-negative mining by distributed radix selection over integer scores.

Vectors become integers, so a score is an exact integer and has digits. For each anchor a window of scores is searched for
its k best rows, and the same selection serves twice: for the nearest rows of the anchor's label (the positives), and, for
each of them, for the best rows of other labels whose score lies in a share of the positive's. Anchors and rows are packed
into blocks in the order of their labels; a task holds one block of each and computes their products. A round counts, for
each window, the rows by the leading digit of their distance from its upper end, finds the digit in which the k-th row lies,
and goes on within it. Where one score holds more rows than are wanted, digits of the id follow. Only the rows that qualify
in the end, k for a window at most, are gathered. A block's histogram is sent up to the digit in which the block alone has
k rows: the k-th of all rows can't lie beyond.

The anchors are a stated query set against all rows, in blocks; no task or driver holds more than blocks.

Defined results: rows with a null id, label or vector, with an empty vector or with null or non-finite components take no
part; of rows that share an id the one with the smallest label, then vector, takes part; vectors of different length are
not compared; components beyond 64 bits, and scores beyond 2^61, are held at these ends; ties go to the smaller id; an
anchor without positives, or a positive without negatives, gives no row; an empty table gives an empty result. Other
columns are not read. Labels and ids are integers, ids within 2^61.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shipping import ship, written

#: Rows and anchors of a block; windows whose scores a task holds at a time; bits of a digit.
BLOCK_ROWS = 4096
BLOCK_ANCHORS = 2048
WINDOWS_AT_ONCE = 128
DIGIT_BITS = 10
FAR = 1 << 61
SCALE = 256
BLOCK = "dim int, n int, ids binary, labels binary, x binary"


def usable_vectors(rows: DataFrame, id_col: str, label: Column, vector_col: str, scale: int = SCALE) -> DataFrame:
    """(id, label, v) of the rows that take part, v being floor(scale * x) of each component."""
    v = F.col(vector_col).cast("array<double>")
    sound = (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    there = rows.select(F.col(id_col).cast("bigint").alias("id"), label.cast("bigint").alias("label"), v.alias("v")).filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.coalesce(sound, F.lit(False)))
    of = F.transform("v", lambda x: F.floor(F.greatest(F.least(x * scale, F.lit(2.0**62)), F.lit(-(2.0**62)))))
    one = there.select("id", F.struct("label", of.alias("v")).alias("row")).groupBy("id").agg(F.min("row").alias("row"))
    return one.select("id", "row.label", "row.v")


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """(block, dim, n, ids, labels, x) of ``rows`` in the order of dim, label and id; blocks are numbered from 0."""
    tasks = max(1, -(-rows.count() // size))

    def pack(batches):
        kept: list[pa.RecordBatch] = []
        for batch in batches:
            begin = 0
            dims = batch.column(0).to_numpy()
            while begin < len(dims):
                held = sum(map(len, kept))
                if held and (held == size or kept[0].column(0)[0].as_py() != dims[begin]):
                    yield _block(kept)
                    kept, held = [], 0
                same = int(np.argmax(np.append(dims[begin:] != dims[begin], True)))
                take = min(same, size - held)
                kept.append(batch.slice(begin, take))
                begin += take
        if kept:
            yield _block(kept)

    ordered = rows.select(F.size("v").alias("dim"), "label", "id", "v").repartitionByRange(tasks, "dim", "label", "id").sortWithinPartitions("dim", "label", "id").coalesce(tasks)
    made = written(ordered.mapInArrow(pack, BLOCK).withColumn("at", F.monotonically_increasing_id()))
    # number of a block: blocks of the parts before its own, and its place there; one row a part is put in order
    part = F.shiftright("at", 33)
    before = made.groupBy(part.alias("part")).agg(F.count("*").alias("c")).withColumn("before", F.sum("c").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)))
    numbered = made.withColumn("part", part).join(before, "part").withColumn("block", F.coalesce("before", F.lit(0)) + F.col("at") - F.shiftleft("part", 33))
    return written(numbered.select("block", "dim", "n", "ids", "labels", "x"))


def _block(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    table = pa.Table.from_batches(batches).combine_chunks()
    dim, n = table.column("dim")[0].as_py(), len(table)
    x = np.concatenate([b.column(3).flatten().to_numpy() for b in batches])
    most = int(np.abs(x).max())
    x = x.astype("<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8")
    raw = [table.column(c).to_numpy().astype("<i8").tobytes() for c in ("id", "label")]
    return pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([n], pa.int32()), *(pa.array([b], pa.binary()) for b in raw), pa.array([x.tobytes()], pa.binary())], names=["dim", "n", "ids", "labels", "x"])


def _opened(block: pa.Table, side: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    one = {c: block.column(f"{side}_{c}")[0].as_py() for c in ("dim", "n", "ids", "labels", "x")}
    x = np.frombuffer(one["x"], f"<i{len(one['x']) // (one['n'] * one['dim'])}").reshape(one["n"], one["dim"])
    return np.frombuffer(one["ids"], "<i8"), np.frombuffer(one["labels"], "<i8"), x


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows: in doubles where no sum can reach 2^53, else as Python integers."""
    most = int(np.abs(a.astype(object)).max()) * int(np.abs(b.astype(object)).max()) * a.shape[1] if a.dtype.itemsize == 8 or b.dtype.itemsize == 8 else (1 << 31 if a.dtype.itemsize == 4 else 1 << 15) * (1 << 31 if b.dtype.itemsize == 4 else 1 << 15) * a.shape[1]
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    exact = a.astype(object) @ b.astype(object).T
    return np.clip(exact, -FAR, FAR).astype(np.int64)


def _met(same: bool, gather: bool, bits: int, left: pa.Table, right: pa.Table) -> pa.Table:
    """What the windows of one block of anchors find in one block of rows: (wid, bucket, n) of the head of each histogram,
    or, at the end, (wid, id, score) of the rows that qualify."""
    names = ["wid", "id", "score"] if gather else ["wid", "bucket", "n"]
    found: list[tuple[np.ndarray, ...]] = []
    if len(left) and len(right) and left.column("a_dim")[0] == right.column("r_dim")[0]:
        a_ids, a_labels, a = _opened(left, "a")
        ids, labels, x = _opened(right, "r")
        asked = left.column("windows").combine_chunks().flatten()
        w = {f: asked.field(f).to_numpy(zero_copy_only=False) for f in ("wid", "slot", "low", "high", "lo", "hi", "ilo", "ihi", "by_id", "shift", "need")}
        order = np.argsort(w["slot"], kind="stable")
        for begin in range(0, len(order), WINDOWS_AT_ONCE):
            v = {f: c[order[begin : begin + WINDOWS_AT_ONCE], None] for f, c in w.items()}
            slots, of = np.unique(v["slot"][:, 0], return_inverse=True)
            score = products(a[slots], x)[of]
            other = a_labels[v["slot"]] != labels[None]
            fits = ((~other & (a_ids[v["slot"]] != ids[None])) if same else other) & (score >= v["low"]) & (score <= v["high"])
            if gather:
                fits &= (score > v["lo"]) | ((score == v["lo"]) & (ids[None] <= v["ihi"]))
                r, c = np.nonzero(fits)
                found.append((v["wid"][r, 0], ids[c], score[r, c]))
                continue
            fits &= (score >= v["lo"]) & (score <= v["hi"]) & (~v["by_id"] | ((ids[None] >= v["ilo"]) & (ids[None] <= v["ihi"])))
            r, c = np.nonzero(fits)
            distance = np.where(v["by_id"][r, 0], ids[c] - v["ilo"][r, 0], v["hi"][r, 0] - score[r, c])
            counts = np.bincount((r << bits) + (distance >> v["shift"][r, 0]), minlength=len(of) << bits).reshape(len(of), -1)
            r, c = np.nonzero((counts > 0) & (np.cumsum(counts, axis=1) - counts < v["need"]))
            found.append((v["wid"][r, 0], c, counts[r, c]))
    columns = [np.concatenate(c) if found else np.zeros(0) for c in (zip(*found) if found else [()] * 3)]
    return pa.table({n: pa.array(c.astype(np.int64)) for n, c in zip(names, columns)})


def _pairs(anchors: DataFrame, rows: DataFrame, same: bool) -> DataFrame:
    """(i, j) of the blocks that are compared: for equal labels those that share one, else all of them."""
    if same:
        def listed(batches):
            for batch in batches:
                for k, d, raw in zip(*(batch.column(i).to_pylist() for i in range(3))):
                    some = np.unique(np.frombuffer(raw, "<i8"))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), k)), pa.array(np.full(len(some), d), pa.int32()), pa.array(some)], names=["block", "dim", "label"])

        of = lambda df, name: df.select("block", "dim", "labels").mapInArrow(listed, "block bigint, dim int, label bigint").withColumnRenamed("block", name)
        return written(of(anchors, "i").join(of(rows, "j"), ["dim", "label"]).select("i", "j").distinct())
    last = F.lit(max(0, rows.count() - 1)).cast("bigint")
    return written(anchors.select(F.col("block").alias("i"), F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("j")))


def _meet(anchors: DataFrame, rows: DataFrame, pairs: DataFrame, windows: DataFrame, same: bool, gather: bool, bits: int) -> DataFrame:
    side = lambda df, s: df.select("block", *(F.col(c).alias(f"{s}_{c}") for c in ("dim", "n", "ids", "labels", "x")))
    fields = ("wid", "slot", "low", "high", "lo", "hi", "ilo", "ihi", "by_id", "shift", "need")
    asked = windows.groupBy("block").agg(F.collect_list(F.struct(*fields)).alias("windows"))  # a block's anchors, k each: bounded
    left = side(anchors, "a").join(asked, "block").join(pairs.withColumnRenamed("i", "block"), "block").withColumnRenamed("block", "i")
    wanted = pairs.join(asked.select(F.col("block").alias("i")), "i", "left_semi")
    right = side(rows, "r").join(wanted.withColumnRenamed("j", "block"), "block").withColumnRenamed("block", "j")
    schema = "wid bigint, id bigint, score bigint" if gather else "wid bigint, bucket bigint, n bigint"
    return left.groupBy("i", "j").cogroup(right.groupBy("i", "j")).applyInArrow(partial(_met, same, gather, bits), schema)


def _shift(bits: int) -> Column:
    """Bits below the leading digit of what is left of a window."""
    return F.greatest(F.length(F.bin(F.when(F.col("by_id"), F.col("ihi") - F.col("ilo")).otherwise(F.col("hi") - F.col("lo")))) - bits, F.lit(0)).cast("int")


def select_top(anchors: DataFrame, rows: DataFrame, windows: DataFrame, same: bool, ids: tuple[int, int], bits: int = DIGIT_BITS) -> DataFrame:
    """(wid, id, score) of the ``need`` best rows of each window (wid, block, slot, low, high, need): of rows of the anchor's
    label (``same``), else of the others. ``ids`` are the least and the greatest id."""
    pairs = _pairs(anchors, rows, same)
    start = windows.select("wid", "block", "slot", "low", "high", "need", F.col("low").alias("lo"), F.col("high").alias("hi"), F.lit(ids[0]).cast("bigint").alias("ilo"), F.lit(ids[1]).cast("bigint").alias("ihi"), F.lit(False).alias("by_id"), F.lit(False).alias("done"))
    state = written(start.withColumn("shift", _shift(bits)))
    while not (open_ := state.filter("NOT done")).isEmpty():
        counted = _meet(anchors, rows, pairs, open_, same, False, bits).groupBy("wid", "bucket").agg(F.sum("n").alias("n"))
        passed = counted.withColumn("upto", F.sum("n").over(Window.partitionBy("wid").orderBy("bucket")))
        hit = passed.join(open_.select("wid", "need"), "wid").filter("upto >= need AND upto - n < need").drop("need")
        step = state.join(hit, "wid", "left").withColumns({"here": F.expr("shiftleft(bucket, shift)"), "last": F.expr("shiftleft(bucket + 1, shift) - 1")})
        held, by_id, exact = F.col("bucket").isNotNull(), F.col("by_id"), F.col("upto") == F.col("need")
        tied = held & ~by_id & ~exact & (F.col("shift") == 0)
        after = {
            "lo": F.when(held & ~by_id, F.greatest("lo", F.col("hi") - F.col("last"))).otherwise(F.col("lo")),
            "hi": F.when(held & ~by_id, F.col("hi") - F.col("here")).otherwise(F.col("hi")),
            "ilo": F.when(held & by_id, F.col("ilo") + F.col("here")).otherwise(F.col("ilo")),
            "ihi": F.when(held & by_id, F.least("ihi", F.col("ilo") + F.col("last"))).otherwise(F.col("ihi")),
            "need": F.when(held & ~exact, F.col("need") - F.col("upto") + F.col("n")).otherwise(F.col("need")),
            "by_id": by_id | tied,
            "done": F.col("done") | ~held | exact,  # a window with too few rows keeps them all
        }
        state = written(step.select("wid", "block", "slot", "low", "high", *(c.alias(n) for n, c in after.items())).withColumn("shift", _shift(bits)))
    return written(_meet(anchors, rows, pairs, state, same, True, bits))


def hard_negatives(vectors: DataFrame, anchors: Column, id_col: str = "vec_id", label: Column | None = None, vector_col: str = "embedding", n_positives: int = 5, n_negatives: int = 3, low: int = 50, high: int = 95, scale: int = SCALE, block_rows: int = BLOCK_ROWS, block_anchors: int = BLOCK_ANCHORS, digit_bits: int = DIGIT_BITS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each anchor (rows where ``anchors``, a
    condition on ``id``, holds) its ``n_positives`` nearest other rows of the label, and for each of them the ``n_negatives``
    best rows of other labels whose score is ``low`` to ``high`` hundredths of the positive's."""
    ship(vectors.sparkSession)
    rows = written(usable_vectors(vectors, id_col, F.col("label") if label is None else label, vector_col, scale))
    edge = rows.agg(F.min("id").alias("a"), F.max("id").alias("b"), F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))).alias("square")).first()
    row_blocks = _blocks(rows, block_rows)
    anchor_blocks = _blocks(rows.filter(anchors), block_anchors)

    def opened(batches):
        for batch in batches:
            for k, d, n, raw, x in zip(*(batch.column(i).to_pylist() for i in range(5))):
                v = np.frombuffer(x, f"<i{len(x) // (n * d)}").reshape(n, d).astype(np.float64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, k)), pa.array(np.arange(n)), pa.array(np.frombuffer(raw, "<i8")), pa.array(np.linalg.norm(v, axis=1))], names=["block", "slot", "anchor_id", "size"])

    slots = anchor_blocks.select("block", "dim", "n", "ids", "x").mapInArrow(opened, "block bigint, slot bigint, anchor_id bigint, size double")
    # no score is beyond the product of the lengths
    reach = (F.ceil(F.least(F.col("size") * float(np.sqrt(edge["square"] or 0.0)) * (1 + 1e-9), F.lit(float(FAR)))) + 1).cast("bigint")
    near = slots.select((F.col("block") * block_anchors + F.col("slot")).alias("wid"), "block", "slot", "anchor_id", (-reach).alias("low"), reach.alias("high"), F.lit(n_positives).cast("bigint").alias("need"))
    ids = (edge["a"] or 0, edge["b"] or 0)
    positives = select_top(anchor_blocks, row_blocks, near, True, ids, digit_bits).withColumnRenamed("id", "positive_id").withColumnRenamed("score", "p")
    found = positives.join(near.select("wid", "block", "slot", "anchor_id"), "wid")
    place = F.row_number().over(Window.partitionBy("wid").orderBy(F.desc("p"), "positive_id"))
    share = lambda percent, more: F.expr(f"p div 100 * {percent} + (p % 100 * {percent} + {more}) div 100")
    spans = found.select((F.col("wid") * n_positives + place - 1).alias("wid"), "block", "slot", "anchor_id", "positive_id", "p", share(low, 99).alias("low"), share(high, 0).alias("high"), F.lit(n_negatives).cast("bigint").alias("need"))
    spans = written(spans.filter("p >= 0 AND low <= high"))  # of a negative score the larger share is the smaller number
    negatives = select_top(anchor_blocks, row_blocks, spans, False, ids, digit_bits)
    rank = F.row_number().over(Window.partitionBy("wid").orderBy(F.desc("score"), "id"))
    return negatives.join(spans.select("wid", "anchor_id", "positive_id", "p"), "wid").select("anchor_id", "positive_id", rank.cast("int").alias("rank"), F.col("id").alias("negative_id"), F.col("p").alias("positive_score"), F.col("score").alias("negative_score"))


ORACLE = f"""
WITH v AS (SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.id AS anchor_id, b.id AS id, a.label = b.label AS alike, list_dot_product(a.e, b.e)::BIGINT AS score FROM v a JOIN v b ON a.id % 50 = 0 AND a.id <> b.id AND len(a.e) = len(b.e)),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE alike QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT alike AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.id) QUALIFY row_number() OVER w <= 3
"""
