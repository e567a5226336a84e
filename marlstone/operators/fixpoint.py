"""Declared relationships settled by delta iteration.

Sources are taken in an order in which targets come first. The first time every relationship of a source is judged against
targets that are settled already, all of them in one union. What fails later goes on as a frontier: only rows that point at
newly failed rows are looked at, because every other active row still has the one target that it had. An edge from a source
to itself is followed by pointer doubling, so a chain of n rows takes log2(n) rounds; no number of rounds is set."""

from __future__ import annotations

from collections.abc import Callable
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.files import shared_table
from .joins import covers
from .quality import DISPOSITIONS, Relationship, _day, active, relationship_failures, with_issues

Keep = Callable[[DataFrame], DataFrame]


def settling_order(specs: list[Relationship]) -> list[str]:
    """Identities with targets before the sources that point at them. A circle through several identities is an error."""
    graph: dict[str, set[str]] = {}
    for s in specs:
        graph.setdefault(s.source, set()).update({s.target} - {s.source})
        graph.setdefault(s.target, set())
    return list(TopologicalSorter({k: sorted(v) for k, v in sorted(graph.items())}).static_order())


def pointing(rows: DataFrame, targets: DataFrame, spec: Relationship) -> DataFrame:
    """(row_id, to) of active ``rows`` and the rows of ``targets`` that they point at, whatever became of these."""
    source = active(rows)
    if spec.members:
        source = source.withColumn("_member", F.explode(F.filter(F.split(spec.members, r"\|"), lambda x: x != "")))
    keys = [F.col("_member" if s == spec.members else s) for s, _ in spec.keys]
    narrow = source.select("row_id", *(k.alias(f"_k{i}") for i, k in enumerate(keys)), (_day(spec.as_of) if spec.as_of else F.lit(None).cast("date")).alias("_on"))
    for i in range(len(keys)):
        narrow = narrow.filter(F.col(f"_k{i}").cast("string") != "")
    wanted = targets.select(F.col("row_id").alias("to"), *(F.col(t).alias(f"_t{i}") for i, (_, t) in enumerate(spec.keys)), *((_day(spec.start).alias("_from"), _day(spec.end).alias("_to")) if spec.as_of else ()))
    on = covers(F.col("_on"), F.col("_from"), F.col("_to")) if spec.as_of else F.lit(True)
    for i in range(len(keys)):
        on = (F.col(f"_k{i}") == F.col(f"_t{i}")) & on
    return narrow.join(wanted, on).select("row_id", "to")


def _found(failed: DataFrame, spec: Relationship, place: int) -> DataFrame:
    says = {"rule_id": spec.rule_id, "disposition": "quarantined", "field": spec.name, "reason": "unresolved"}
    return failed.select("row_id", *(F.lit(v).alias(k) for k, v in says.items()), F.lit(place).alias("place"))


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def behind(failed: DataFrame, edges: DataFrame) -> DataFrame:
    """(row_id) of the rows that reach a failed one by ``edges`` (row_id, to), each row with one edge at most, without the
    failed rows themselves. Every round doubles the distance that is seen; a row drops out when it has failed or has come
    to an end. Circles in which nothing fails end after as many rounds as doubling needs to pass all rows."""
    bad = failed.select(F.col("row_id").alias("to"), F.lit(True).alias("hit"))
    walk = shared_table(edges.filter("row_id <> to").join(bad, "to", "left").select("row_id", "to", F.coalesce("hit", F.lit(False)).alias("fails")))
    open_, seen, most = walk.filter("NOT fails").count(), 1, max(2, walk.count())
    while open_ and seen < most:
        step = walk.filter("NOT fails").alias("a").join(walk.select(F.col("row_id").alias("to"), F.col("to").alias("next"), F.col("fails").alias("hit")), "to", "left")
        moved = step.select("row_id", F.when(~F.coalesce("hit", F.lit(False)), F.col("next")).alias("to"), F.coalesce("hit", F.lit(False)).alias("fails"))
        walk = shared_table(walk.filter("fails").unionByName(moved.filter("fails OR to IS NOT NULL")))
        open_, seen = walk.filter("NOT fails").count(), 2 * seen
    return walk.filter("fails").select("row_id").join(failed.select("row_id"), "row_id", "left_anti")


def _chain(rows: DataFrame, edge: Relationship, frontier: DataFrame, keep: Keep) -> DataFrame:
    """Rows of one source that hang on its failed rows ``frontier`` (row_id) by the edge to itself, directly or not. Rows that
    were no target before the frontier failed are left out, so each row has the one target that it was judged by."""
    there = active(rows).unionByName(rows.join(frontier, "row_id", "left_semi").filter(~F.col("disposition").isin(*DISPOSITIONS[:2])))
    return behind(frontier, keep(pointing(rows, there, edge)))


def settle(frames: dict[str, DataFrame], specs: list[Relationship], keep: Keep, failed: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """``frames`` with every row quarantined whose relationships do not each resolve to one active row. With ``failed``, the
    rows (row_id) by identity that were deactivated since the frames were last settled, only what hangs on them is judged."""
    out, gone = dict(frames), dict(failed or {})
    for identity in settling_order(specs):
        own = [(i, s) for i, s in enumerate(specs) if s.source == identity and s.source in out and s.target in out]
        outward, selves = [x for x in own if x[1].target != identity], [s for _, s in own if s.target == identity]
        if failed is None:
            found = [_found(relationship_failures(out[identity], out[s.target], s), s, i) for i, s in own]
        else:
            found = [_found(_lost(out[identity], out[s.target], gone[s.target], s), s, i) for i, s in outward if s.target in gone]
        if found:
            new = keep(_union(found))
            if not new.isEmpty():
                out[identity] = keep(with_issues(out[identity], new))
                gone[identity] = new.select("row_id").unionByName(gone[identity]).distinct() if identity in gone else new.select("row_id").distinct()
        for edge in selves:
            if identity not in gone:
                continue
            more = keep(_found(_chain(out[identity], edge, gone[identity], keep), edge, len(specs)))
            if not more.isEmpty():
                out[identity] = keep(with_issues(out[identity], more))
                gone[identity] = more.select("row_id").unionByName(gone[identity]).distinct() if identity in gone else more.select("row_id")
    return out


def _lost(rows: DataFrame, targets: DataFrame, gone: DataFrame, spec: Relationship) -> DataFrame:
    """Active rows whose target went. Each had one active target before, so a hit is a miss now."""
    return pointing(rows, targets.join(gone.select("row_id"), "row_id", "left_semi"), spec).select("row_id").distinct()
