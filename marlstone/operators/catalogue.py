"""Rule catalogue compiled to a plan.

A catalogue is text, a rule a line: source, id, disposition, kind, field, arguments. Compiling binds every line to one
expression and fuses the row rules of a source to one projection, so that a source is read once for all of them; rules over
keys and relationships become an aggregate or a join. What can't be bound is fatal before anything is read: an unknown source,
kind, field or target, a pair named twice, a relationship that the policy doesn't name or a policy line that no rule uses."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import quality as Q

#: Classes in which rules are executed.
CLASSES = ("row", "key", "relationship", "batch", "boundary", "not_applicable")


class CatalogueError(ValueError):
    """A catalogue that doesn't describe what would be executed."""


@dataclass(frozen=True)
class Entry:
    source: str
    rule_id: str
    disposition: str
    kind: str
    field: str
    args: tuple[str, ...]

    @property
    def pair(self) -> tuple[str, str]:
        return self.source, self.rule_id


def _text(e: Entry) -> Column:
    return F.coalesce(F.col(e.field).cast("string"), F.lit(""))


def _number(x: str) -> Column:
    return F.lit(x).cast("decimal(38,6)")


def _exact(field: str) -> Column:
    return F.col(field).cast("decimal(38,6)")


#: What breaks a row rule, by kind. An unknown condition (null) is not broken.
ROW_KINDS: dict[str, Callable[[Entry], Column]] = {
    "required": lambda e: _text(e) == "",
    "allowed": lambda e: (_text(e) != "") & ~_text(e).isin(*e.args),
    "like": lambda e: (_text(e) != "") & ~_text(e).rlike(f"^(?:{' '.join(e.args)})$"),
    "from": lambda e: _exact(e.field) < _number(e.args[0]),
    "above": lambda e: _exact(e.field) <= _number(e.args[0]),
    "to": lambda e: _exact(e.field) > _number(e.args[0]),
    "not_before": lambda e: F.col(e.field) < F.col(e.args[0]),
    "balances": lambda e: _exact(e.field) != reduce(lambda a, b: a + b, map(_exact, e.args)),
    "whole_pointer": lambda e: Q.half_pointer([e.field, *e.args]),
}
#: Class of the other kinds; row kinds are of class row.
OTHER_KINDS = {"unique": "key", "refers": "relationship", "may_refer": "relationship", "present": "batch", "absent": "boundary", "not_applicable": "not_applicable"}
#: Kinds whose arguments are fields of the source.
OF_FIELDS = {"not_before", "balances", "whole_pointer", "unique"}


def class_of(e: Entry) -> str:
    return "row" if e.kind in ROW_KINDS else OTHER_KINDS[e.kind]


def read_catalogue(text: str) -> list[Entry]:
    """Entries in their order. Blank lines and those that begin with # say nothing."""
    found = []
    for n, line in enumerate(text.splitlines(), 1):
        words = line.split()
        if not words or words[0].startswith("#"):
            continue
        if len(words) < 5:
            raise CatalogueError(f"line {n}: source, id, disposition, kind and field are needed")
        source, rule_id, disposition, kind, field, *args = words
        found.append(Entry(source, rule_id, disposition, kind, field, tuple(args)))
    return found


@dataclass(frozen=True)
class Compiled:
    entries: tuple[Entry, ...]

    def of(self, source: str, *classes: str) -> list[Entry]:
        return [e for e in self.entries if e.source == source and class_of(e) in classes]

    @property
    def sources(self) -> list[str]:
        return list(dict.fromkeys(e.source for e in self.entries))

    def inventory(self) -> dict[str, list[tuple[str, str]]]:
        """(source, rule) pairs by class of execution."""
        return {c: sorted(e.pair for e in self.entries if class_of(e) == c) for c in CLASSES}

    def judged(self, source: str, rows: DataFrame) -> DataFrame:
        """``rows`` with issues and disposition by the row rules, one projection."""
        rules = [Q.Rule(e.rule_id, e.disposition, e.field, e.kind, ROW_KINDS[e.kind](e)) for e in self.of(source, "row")]
        return Q.classified(rows, [r.issue for r in rules])

    def failures(self, tables: Mapping[str, DataFrame]) -> DataFrame:
        """(source, rule_id, class, failures) of every entry, also of those that nothing breaks."""
        parts = [self._scan(s, tables[s]) for s in self.sources if s in tables and self.of(s, "row", "batch")]
        parts += [self._repeated(e, tables[e.source]) for e in self.entries if e.kind == "unique"]
        parts += [self._unresolved(e, tables) for e in self.entries if class_of(e) == "relationship"]
        spark = next(iter(tables.values())).sparkSession
        still = [(*e.pair, class_of(e), 1 if e.kind == "present" else 0) for e in self.entries if class_of(e) in ("boundary", "not_applicable") or e.kind == "present" and e.source not in tables]
        parts.append(spark.createDataFrame(still, "source string, rule_id string, class string, failures bigint"))
        return reduce(DataFrame.unionByName, parts)

    def _scan(self, source: str, rows: DataFrame) -> DataFrame:
        """All row rules of a source in one scan and one row of counts, turned into a row for each rule."""
        entries = self.of(source, "row", "batch")
        counted = [F.count_if(ROW_KINDS[e.kind](e)) if e.kind in ROW_KINDS else F.when(F.count("*") == 0, 1).otherwise(0).cast("bigint") for e in entries]
        each = [F.struct(F.lit(source).alias("source"), F.lit(e.rule_id).alias("rule_id"), F.lit(class_of(e)).alias("class"), c.alias("failures")) for e, c in zip(entries, counted)]
        return rows.agg(F.array(*each).alias("of")).select(F.inline("of"))

    def _repeated(self, e: Entry, rows: DataFrame) -> DataFrame:
        """Rows beyond the first of each key; copies are counted before they meet."""
        return _one(e, rows.groupBy(e.field, *e.args).agg((F.count("*") - 1).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")))

    def _unresolved(self, e: Entry, tables: Mapping[str, DataFrame]) -> DataFrame:
        """Rows whose pointer doesn't meet exactly one target. Both sides are counted by key first, so a hot key is one row."""
        target, field = e.args[0].split(".")
        here = tables[e.source].groupBy(F.col(e.field).alias("k")).agg(F.count("*").alias("n"))
        there = tables[target].groupBy(F.col(field).alias("k")).agg(F.count("*").alias("hits"))
        fails = F.coalesce("hits", F.lit(0)) != 1
        if e.kind == "may_refer":
            fails = fails & F.col("k").isNotNull()
        return _one(e, here.join(there, "k", "left").filter(fails).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")))


def _one(e: Entry, counted: DataFrame) -> DataFrame:
    return counted.select(F.lit(e.source).alias("source"), F.lit(e.rule_id).alias("rule_id"), F.lit(class_of(e)).alias("class"), F.col("n").cast("bigint").alias("failures"))


def compile_catalogue(entries: Iterable[Entry], columns: Mapping[str, Iterable[str]], policy: Mapping[tuple[str, str], str] | None = None) -> Compiled:
    """Binds every entry or raises. ``columns`` has the fields of each source, ``policy`` the rule of each (source, target)."""
    entries, wrong, used = tuple(entries), [], set()
    fields = {s: set(c) for s, c in columns.items()}
    pairs: set[tuple[str, str]] = set()
    for e in entries:
        if e.pair in pairs:
            wrong.append(f"{e.pair} is named twice")
        pairs.add(e.pair)
        if e.kind not in ROW_KINDS and e.kind not in OTHER_KINDS:
            wrong.append(f"{e.pair}: unknown kind {e.kind}")
            continue
        if e.disposition not in (*Q.DISPOSITIONS, "block_batch"):
            wrong.append(f"{e.pair}: unknown disposition {e.disposition}")
        if e.source not in fields:
            wrong.append(f"{e.pair}: unknown source")
            continue
        if e.kind == "absent":
            if e.field in fields[e.source]:
                wrong.append(f"{e.pair}: {e.field} must not be there")
        elif e.kind not in ("present", "not_applicable"):
            needed = {e.field, *(e.args if e.kind in OF_FIELDS else ())}
            wrong += [f"{e.pair}: unknown field {f}" for f in sorted(needed - fields[e.source])]
        if class_of(e) == "relationship":
            target, _, field = (e.args[0] if e.args else "").partition(".")
            if field not in fields.get(target, ()):
                wrong.append(f"{e.pair}: unknown target {target}.{field}")
            if policy is not None and policy.get((e.source, target)) != e.rule_id:
                wrong.append(f"{e.pair}: the policy has {policy.get((e.source, target))} for {target}")
            used.add((e.source, target))
        if e.kind in ("allowed", "like", "from", "above", "to", "not_before", "balances", "whole_pointer") and not e.args:
            wrong.append(f"{e.pair}: {e.kind} needs an argument")
    wrong += [f"policy {p} is used by no rule" for p in sorted(set(policy or ()) - used)]
    wrong += [f"{s}: no rule is declared" for s in sorted(fields.keys() - {e.source for e in entries} - {e.args[0].partition('.')[0] for e in entries if e.args})]
    if wrong:
        raise CatalogueError("; ".join(wrong))
    return Compiled(entries)
