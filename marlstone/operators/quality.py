"""Contract rules as column expressions, dispositions, relationships and the batch gate."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import covers

#: Dispositions from the mildest to the gravest.
DISPOSITIONS = ("accepted", "accepted_with_warning", "quarantined", "rejected")
ISSUE = "struct<rule_id:string,disposition:string,field:string,reason:string>"


@dataclass(frozen=True)
class Rule:
    """A condition under its id, known before any row is read."""

    rule_id: str
    disposition: str
    field: str
    reason: str
    broken: Column

    @property
    def issue(self) -> Column:
        return issue(self.rule_id, self.disposition, self.field, self.reason, self.broken)


def issue(rule_id: str, disposition: str, field: str, reason: str, broken: Column) -> Column:
    """An issue where ``broken`` is true, else null (an unknown condition is not broken)."""
    return F.when(broken, F.struct(F.lit(rule_id).alias("rule_id"), F.lit(disposition).alias("disposition"), F.lit(field).alias("field"), F.lit(reason).alias("reason")))


def required(rule_id: str, field: str, disposition: str = "rejected") -> Column:
    return issue(rule_id, disposition, field, "required", F.coalesce(F.col(field).cast("string"), F.lit("")) == "")


def allowed(rule_id: str, field: str, values: list[str], disposition: str = "quarantined") -> Column:
    return issue(rule_id, disposition, field, "not allowed", ~F.col(field).isin(*values))


def pattern(rule_id: str, field: str, expression: str, disposition: str = "quarantined") -> Column:
    return issue(rule_id, disposition, field, "pattern", ~F.col(field).rlike(expression))


def bounds(rule_id: str, field: str, low=None, high=None, exclusive: bool = False, disposition: str = "quarantined") -> Column:
    c, broken = F.col(field), F.lit(False)
    if low is not None:
        broken = broken | (c <= low if exclusive else c < low)
    if high is not None:
        broken = broken | (c > high)
    return issue(rule_id, disposition, field, "out of bounds", broken)


def in_order(rule_id: str, first: str, then: str, disposition: str = "quarantined") -> Column:
    return issue(rule_id, disposition, then, "out of order", F.col(then) < F.col(first))


def whole_pointer(rule_id: str, fields: list[str], disposition: str = "quarantined") -> Column:
    """All parts of a pointer, or none."""
    return issue(rule_id, disposition, fields[0], "half pointer", half_pointer(fields))


def half_pointer(fields: list[str]) -> Column:
    there = sum(F.when(F.coalesce(F.col(f).cast("string"), F.lit("")) != "", 1).otherwise(0) for f in fields)
    return (there > 0) & (there < len(fields))


def balances(rule_id: str, whole: str, parts: list[str], disposition: str = "quarantined") -> Column:
    return issue(rule_id, disposition, whole, "does not add up", F.col(whole) != sum((F.col(p) for p in parts[1:]), F.col(parts[0])))


def classified(rows: DataFrame, issues: list[Column]) -> DataFrame:
    """``rows`` with their distinct issues and the gravest disposition among them; one narrow pass."""
    found = F.array_distinct(F.array_compact(F.array(*issues)).cast(f"array<{ISSUE}>"))
    return rows.withColumn("issues", found).withColumn("disposition", gravest(F.col("issues")))


def gravest(issues: Column) -> Column:
    ranks = F.transform(issues, lambda x: F.array_position(F.array(*map(F.lit, DISPOSITIONS)), x["disposition"]))
    return F.element_at(F.array(*map(F.lit, DISPOSITIONS)), F.coalesce(F.array_max(ranks), F.lit(1)).cast("int"))


@dataclass(frozen=True)
class Relationship:
    """Rows of ``source`` point at exactly one active row of ``target``: equal keys and, with a date, in its interval.
    ``members`` names a delimited source key of which every member is checked."""

    name: str
    source: str
    target: str
    keys: tuple[tuple[str, str], ...]
    rule_id: str
    optional: bool = False
    as_of: str | None = None
    start: str = "valid_from"
    end: str = "valid_to"
    members: str | None = None


def active(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("disposition").isin(*DISPOSITIONS[:2]))


def _day(name: str) -> Column:
    """The date of a date, timestamp or text column; text that is none counts as missing."""
    return F.to_date(F.col(name).try_cast("timestamp"))


def relationship_failures(rows: DataFrame, targets: DataFrame, spec: Relationship, row_id: str = "row_id") -> DataFrame:
    """(row id) of active rows whose relationship does not resolve to exactly one active target."""
    source = active(rows)
    if spec.members:
        source = source.withColumn("_member", F.explode(F.filter(F.split(spec.members, r"\|"), lambda x: x != "")))
    key = lambda name: F.col("_member" if name == spec.members else name)
    whole = F.lit(True)
    for name, _ in spec.keys:
        whole = whole & (F.coalesce(key(name).cast("string"), F.lit("")) != "")
    pointing = source.select(row_id, *(key(s).alias(f"_k{i}") for i, (s, _) in enumerate(spec.keys)), (_day(spec.as_of) if spec.as_of else F.lit(None).cast("date")).alias("_day"), whole.alias("_whole"))
    wanted = active(targets).select(*(F.col(t).alias(f"_t{i}") for i, (_, t) in enumerate(spec.keys)), *((_day(spec.start).alias("_from"), _day(spec.end).alias("_to")) if spec.as_of else ()), F.lit(1).alias("_hit"))
    on = F.col("_whole")
    for i in range(len(spec.keys)):
        on = (F.col(f"_k{i}") == F.col(f"_t{i}")) & on
    if spec.as_of:
        on = on & covers(F.col("_day"), F.col("_from"), F.col("_to"))
    asked = [row_id, *(f"_k{i}" for i in range(len(spec.keys))), "_day", "_whole"]
    counted = pointing.distinct().join(wanted, on, "left").groupBy(*asked).agg(F.count("_hit").alias("n"))
    fails = (F.col("n") != 1) if not spec.optional else (F.col("n") != 1) & F.col("_whole")
    return counted.filter(fails).select(row_id).distinct()


def with_issue(rows: DataFrame, failed: DataFrame, rule_id: str, field: str, reason: str, disposition: str = "quarantined") -> DataFrame:
    """``rows`` with one more issue on those whose row_id is in ``failed``."""
    added = F.struct(F.lit(rule_id).alias("rule_id"), F.lit(disposition).alias("disposition"), F.lit(field).alias("field"), F.lit(reason).alias("reason"))
    hit = rows.join(failed.select("row_id").distinct().withColumn("_failed", F.lit(True)), "row_id", "left")
    issues = F.when(F.col("_failed"), F.array_append("issues", added)).otherwise(F.col("issues"))
    return hit.withColumn("issues", issues).withColumn("disposition", gravest(F.col("issues"))).drop("_failed")


def with_issues(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``rows`` with all issues of ``found`` (row_id, rule_id, disposition, field, reason, place) in the order of ``place``, by
    one join however many rules there are."""
    new = F.struct("rule_id", "disposition", "field", "reason").alias("issue")
    listed = found.groupBy("row_id").agg(F.array_sort(F.collect_set(F.struct("place", new))).alias("_new"))
    added = F.transform(F.coalesce("_new", F.array().cast(f"array<struct<place:int,issue:{ISSUE}>>")), lambda x: x["issue"])
    hit = rows.join(listed, "row_id", "left").withColumn("issues", F.concat("issues", added))
    return hit.withColumn("disposition", gravest(F.col("issues"))).drop("_new")


def disposition_counts(rows: DataFrame, by: str) -> DataFrame:
    return rows.groupBy(by).agg(*(F.count_if(F.col("disposition") == d).alias(d) for d in DISPOSITIONS), F.count("*").alias("raw"))


def issue_distribution(rows: DataFrame) -> DataFrame:
    return rows.select(F.explode("issues").alias("x")).groupBy(F.col("x.rule_id").alias("rule_id")).agg(F.count("*").alias("failures"))


def freshness(rows: DataFrame, by: str, event: str, evaluated_at: Column, max_age_seconds: int, default: Column | None = None) -> DataFrame:
    """Age of the latest event of each source; late only if older than allowed. Rows without an event fall back to ``default``."""
    newest = F.max(event)
    age = F.greatest(F.unix_timestamp(evaluated_at) - F.unix_timestamp(F.coalesce(newest, default) if default is not None else newest), F.lit(0))
    return rows.groupBy(by).agg(age.alias("age_seconds")).withColumn("late", F.col("age_seconds") > max_age_seconds)


def gate(counts: DataFrame, findings: DataFrame) -> dict:
    """Publication is allowed if every source's dispositions add up to its rows and there is no batch finding. A row for each source is read."""
    reconciled = counts.filter(F.col("raw") != sum((F.col(d) for d in DISPOSITIONS[1:]), F.col(DISPOSITIONS[0]))).isEmpty()
    blocked = not findings.isEmpty()
    return {"reconciled": reconciled, "blocked": blocked, "publication_allowed": reconciled and not blocked}
