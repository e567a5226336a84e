"""Versioned publication: fingerprints, inventories, membership by replay of deltas, and a guarded pointer.

The relational parts are DataFrames; the pointer is one small file, changed by compare-and-swap under a lock of the
driver's host. The pointer's folder must be reached by one driver at a time or by a file system with atomic rename.
"""

from __future__ import annotations

import contextlib
import fcntl
import hashlib
import json
import os
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.files import write_json
from .aggregates import inventory_digest
from .windows import latest

#: What the fingerprints' texts begin with, and the gates that a candidate must have passed.
SELECTION, BUILD = "validated-staging-v1\n", "candidate-build-v1\n"
REQUIRED_GATES = ("staging", "dimensions", "facts", "reconciliation", "publication")
MAX_CHAIN = 8
_ID = re.compile(r"[a-z][a-z0-9_]{2,47}")


def selection_fingerprint(validation_ids: list[str]) -> str:
    ids = sorted(set(validation_ids))
    if not ids:
        raise ValueError("no validations selected")
    return hashlib.md5((SELECTION + "\n".join(ids)).encode()).hexdigest()


def build_fingerprint(publication: str, selection: str, commit: str) -> str:
    if not _ID.fullmatch(publication):
        raise ValueError(f"not a publication id: {publication!r}")
    return hashlib.md5((BUILD + "\n".join((publication, selection, commit))).encode()).hexdigest()


def inventory_commitment(rows: DataFrame, relation: str = "relation", key: str = "key", content: str = "content") -> DataFrame:
    """Row count and digest of each relation's (key, content) inventory."""
    return rows.groupBy(relation).agg(F.count("*").alias("row_count"), inventory_digest(F.col(key), F.col(content)).alias("inventory_sha256"))


def active_membership(deltas: DataFrame, chain: DataFrame) -> DataFrame:
    """Deltas (publication_id, relation, key, sequence, content; null content is a tombstone) replayed along the chain
    (publication_id, chain_position): the last word on each key, without those that were removed."""
    placed = deltas.join(chain, "publication_id")
    now = latest(placed, ["relation", "key"], F.desc("chain_position"), F.desc("sequence"))
    return now.filter("content IS NOT NULL").drop("chain_position", "sequence")


def chain_defects(manifests: DataFrame) -> DataFrame:
    """(publication_id, defect) of manifests (publication_id, parent_id, mode, chain_position): missing or late
    parents, broken positions, bases with a parent, and chains longer than MAX_CHAIN."""
    m = manifests.alias("m")
    p = manifests.select(F.col("publication_id").alias("up"), F.col("chain_position").alias("up_position")).alias("p")
    joined = m.join(p, F.col("m.parent_id") == F.col("p.up"), "left")
    base = F.col("mode") == "base"
    checks = {
        "base with parent": base & F.col("parent_id").isNotNull(),
        "delta without parent": ~base & F.col("up").isNull(),
        "base not first": base & (F.col("chain_position") != 0),
        "position not next": ~base & F.col("up").isNotNull() & (F.col("chain_position") != F.col("up_position") + 1),
        "chain too long": F.col("chain_position") > MAX_CHAIN,
    }
    return joined.select("publication_id", F.explode(F.array_compact(F.array(*(F.when(broken, name) for name, broken in checks.items())))).alias("defect"))


def delta_defects(before: DataFrame, after: DataFrame, delta: DataFrame) -> DataFrame:
    """(relation, key, defect): the delta must hold exactly the keys whose content changed, with the new content."""
    keys = ["relation", "key"]
    b, a, d = before.select(*keys, F.col("content").alias("b")), after.select(*keys, F.col("content").alias("a")), delta.select(*keys, F.col("content").alias("d"), F.lit(True).alias("there"))
    joined = b.join(a, keys, "full").join(d, keys, "full")
    changed = ~F.col("b").eqNullSafe(F.col("a"))
    checks = {
        "missing": changed & F.col("there").isNull(),
        "superfluous": ~changed & F.col("there").isNotNull(),
        "wrong content": changed & F.col("there").isNotNull() & ~F.col("d").eqNullSafe(F.col("a")),
    }
    return joined.select(*keys, F.explode(F.array_compact(F.array(*(F.when(broken, name) for name, broken in checks.items())))).alias("defect"))


class Conflict(RuntimeError):
    """The pointer is not where the caller expected it."""


class Pointer:
    """The active publication of an environment, its revision, and what was active before."""

    def __init__(self, folder: str):
        self.folder = folder
        os.makedirs(folder, exist_ok=True)

    @contextlib.contextmanager
    def _locked(self):
        with open(f"{self.folder}/lock", "w") as f:
            fcntl.flock(f, fcntl.LOCK_EX)
            yield

    def read(self) -> dict:
        try:
            with open(f"{self.folder}/active.json", encoding="utf-8") as f:
                return json.load(f)
        except FileNotFoundError:
            return {"publication": None, "revision": 0, "history": []}

    def append_candidate(self, publication: str, fingerprint: str, gates: dict[str, bool]) -> str:
        """'appended', or 'no_op' for the same fingerprint; another fingerprint is a conflict."""
        with self._locked():
            path = f"{self.folder}/{publication}.json"
            if os.path.exists(path):
                with open(path, encoding="utf-8") as f:
                    if json.load(f)["fingerprint"] != fingerprint:
                        raise Conflict(f"{publication} was built differently before")
                return "no_op"
            write_json(path, {"fingerprint": fingerprint, "gates": gates})
            return "appended"

    def activate(self, publication: str, expected: tuple[str | None, int]) -> str:
        """'active', or 'blocked' if a required gate is missing or failed; the pointer must be where it is expected."""
        with self._locked():
            now = self.read()
            with open(f"{self.folder}/{publication}.json", encoding="utf-8") as f:
                gates = json.load(f)["gates"]
            if not all(gates.get(g) for g in REQUIRED_GATES):
                return "blocked"
            if (now["publication"], now["revision"]) != tuple(expected):
                raise Conflict(f"pointer is at {now['publication']}, revision {now['revision']}")
            write_json(f"{self.folder}/active.json", {"publication": publication, "revision": now["revision"] + 1, "history": [*now["history"], publication]})
            return "active"

    def rollback(self, publication: str, expected: tuple[str | None, int]) -> None:
        """Back to a publication that was active before; only the pointer moves."""
        if publication not in self.read()["history"]:
            raise Conflict(f"{publication} was never active")
        if self.activate(publication, expected) != "active":
            raise Conflict(f"{publication} has lost a gate")
