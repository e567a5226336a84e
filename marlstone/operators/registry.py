"""Registry of batches and receipts: envelopes, look-ups, approved runs, candidates and their controls.

Tables are DataFrames; what is fetched to the driver is a row of a look-up, never a relation."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

DISPOSITIONS = ("accepted", "accepted_with_warning", "quarantined", "rejected")


class RegistryError(ValueError):
    """Evidence that contradicts what is registered."""


def payload_checksum(payload: Column) -> Column:
    """sha256 of a string map as canonical JSON: keys in order, no spaces, all but printable ASCII escaped in lower-case hex."""
    ordered = F.map_from_entries(F.array_sort(F.map_entries(payload)))
    escaped = F.replace(F.to_json(ordered, {"writeNonAsciiCharacterAsCodePoint": "true"}), F.lit("\x7f"), F.lit("\\u007f"))
    parts = F.regexp_extract_all(escaped, F.lit(r"\\u[0-9A-Fa-f]{4}|\\.|[^\\]+"), F.lit(0))
    return F.sha2(F.array_join(F.transform(parts, lambda x: F.when(x.startswith("\\u"), F.lower(x)).otherwise(x)), ""), 256)


def records_of(envelopes: DataFrame, identity: str, batch_id: str) -> DataFrame:
    """Records of raw envelopes (columns as in the result, with ``lineage`` and ``synthetic_only``). An envelope that is not
    of this batch and identity, lacks evidence or has another checksum stops the read where it is met."""
    lineage = F.col("lineage")
    sound = F.col("synthetic_only") & (lineage["batch_id"] == batch_id) & (lineage["source_identity"] == identity) & lineage["source_system"].isNotNull()
    for c in ("source_record_id", "natural_key", "raw_payload", "normalized_payload", "issues"):
        sound = sound & F.col(c).isNotNull()
    sound = sound & F.col("disposition").isin(*DISPOSITIONS) & (F.col("payload_sha256") == payload_checksum(F.col("raw_payload")))
    checked = F.when(F.coalesce(sound, F.lit(False)), F.col("payload_sha256")).otherwise(F.raise_error(F.concat(F.lit("envelope contradicts its evidence: "), F.coalesce("source_record_id", F.lit("no id")))))
    return envelopes.select(F.lit(identity).alias("source_identity"), lineage["source_system"].alias("source_system"), "source_record_id", "natural_key", checked.alias("payload_sha256"), "raw_payload", "normalized_payload", "disposition", "issues", "lineage")


def look_up(table: DataFrame, **key: object) -> Row | None:
    """The one row with this key, or none; more than one is an error."""
    found = table
    for c, value in key.items():
        found = found.filter(F.col(c).eqNullSafe(F.lit(value)))
    rows = found.take(2)
    if len(rows) > 1:
        raise RegistryError(f"more than one row for {key}")
    return rows[0] if rows else None


def first_delivery(deliveries: DataFrame, identity: str, system: str, checksum: str, order: str) -> Row | None:
    """The oldest delivery of the same content."""
    same = deliveries.filter((F.col("source_identity") == identity) & (F.col("source_system") == system) & (F.col("sha256") == checksum))
    rows = same.orderBy(order).limit(1).collect()
    return rows[0] if rows else None


def register_receipt(known: DataFrame, receipt: DataFrame, key: str) -> DataFrame:
    """The rows to add for a receipt: none if an equal one is registered; another under its key is an error."""
    content = [c for c in receipt.columns if c != key]
    before = known.select(F.col(key), F.struct(*content).alias("_known"))
    joined = receipt.join(before, key, "left")
    if not joined.filter(F.col("_known").isNotNull() & ~F.col("_known").eqNullSafe(F.struct(*content))).isEmpty():
        raise RegistryError(f"another receipt is registered under the same {key}")
    return joined.filter("_known IS NULL").select(receipt.columns)


def append_event(event: DataFrame, target: str, at: str = "occurred_at") -> None:
    """Appends audit rows under the day of their event."""
    event.withColumn("event_date", F.to_date(at)).write.mode("append").partitionBy("event_date").parquet(target)


def approved_runs(runs: DataFrame, validation_ids: list[str] | None = None) -> DataFrame:
    """Quality runs that may be published, with the count that their validated records must have."""
    ok = F.col("synthetic_only") & F.col("publication_allowed") & F.col("reconciled") & (F.col("decision") == "approved")
    picked = runs.filter(ok) if validation_ids is None else runs.filter(ok & F.col("validation_id").isin(validation_ids))
    return picked.withColumn("expected_validated_record_count", F.col("accepted") + F.col("warned"))


def as_candidate(rows: DataFrame, publication_id: str, fingerprint: str) -> DataFrame:
    return rows.withColumns({"publication_id": F.lit(publication_id), "publication_selection_fingerprint": F.lit(fingerprint)})


def candidate_name(base: str, publication_id: str, selection: str, build: str, scoped: bool = True) -> str:
    return "__".join((base, publication_id, selection, build)) if scoped else base


def materialise(rows: DataFrame, name: str, how: str) -> DataFrame:
    """'table' writes it, 'view' names it, 'ephemeral' leaves it a plan."""
    if how == "table":
        rows.write.mode("errorifexists").saveAsTable(name)
        return rows.sparkSession.table(name)
    if how == "view":
        rows.createOrReplaceTempView(name)
    elif how != "ephemeral":
        raise ValueError(how)
    return rows


def control_vector(rows: DataFrame, relation: str, amounts: list[str]) -> DataFrame:
    """(relation, row_count, amounts as JSON of exact sums), one row, also for no rows."""
    sums = F.to_json(F.struct(*(F.coalesce(F.sum(F.col(a).cast("decimal(18,2)")), F.lit(0)).cast("decimal(38,2)").cast("string").alias(a) for a in amounts)))
    return rows.agg(F.count("*").alias("row_count"), sums.alias("amounts")).select(F.lit(relation).alias("relation"), "row_count", "amounts")


def closure_gaps(resolved: DataFrame, inventory: DataFrame, counts: DataFrame) -> DataFrame:
    """(relation, key or null, gap): resolved keys that the inventory lacks and the reverse, and relations whose counts differ."""
    r, i = resolved.select("relation", "key").distinct().withColumn("_r", F.lit(1)), inventory.select("relation", "key").distinct().withColumn("_i", F.lit(1))
    keys = r.join(i, ["relation", "key"], "full").filter("_r IS NULL OR _i IS NULL").select("relation", "key", F.when(F.col("_i").isNull(), "not in inventory").otherwise("not resolved").alias("gap"))
    have = r.groupBy("relation").agg(F.count("*").alias("_n"))
    wrong = have.join(counts.select("relation", "row_count"), "relation", "full").filter("NOT _n <=> row_count")
    return keys.unionByName(wrong.select("relation", F.lit(None).cast("string").alias("key"), F.lit("count differs").alias("gap")))


def out_of_order(inventory: DataFrame, sequence: str) -> DataFrame:
    """Rows of an inventory that do not come after the row before them by (relation, key). One ordered read of each relation
    and one comparison of the relations' first rows."""
    from pyspark.sql import Window

    inside = Window.partitionBy("relation").orderBy(sequence)
    within = inventory.withColumn("_before", F.lag("key").over(inside)).filter(F.col("_before") >= F.col("key")).select("relation", "key", sequence)
    spans = inventory.groupBy("relation").agg(F.min(sequence).alias("_from"), F.max(sequence).alias("_to"), F.min_by("key", sequence).alias("key"))
    across = Window.partitionBy(F.lit(0)).orderBy("relation")  # a row for each relation
    apart = spans.withColumn("_before", F.lag("_to").over(across)).filter(F.col("_before") >= F.col("_from")).select("relation", "key", F.col("_from").alias(sequence))
    return within.unionByName(apart)


def duplicate_records(records: DataFrame) -> DataFrame:
    """Records that share a key with another one (``duplicate_kinds`` names which): natural key, record id, line id of claim
    lines, control and trace number of remittances that are not reversed. Keys are counted before they are joined back."""
    payload = lambda c: F.nullif(F.col("normalized_payload")[c], F.lit(""))
    live = (F.col("source_identity") == "remittances") & ~F.coalesce(payload("remittance_status") == "reversed", F.lit(False))
    kinds = {
        "natural_key": F.struct("source_identity", F.lit("").alias("system"), F.col("natural_key").alias("value")),
        "record_id": F.struct("source_identity", F.col("source_system").alias("system"), F.col("source_record_id").alias("value")),
    }
    for kind, field, when in (("claim_line_id", "claim_line_id", F.col("source_identity") == "claim-lines"), ("control_number", "source_control_number", live), ("trace_number", "payment_trace_number", live)):
        kinds[kind] = F.when(when & payload(field).isNotNull(), F.struct("source_identity", F.col("source_system").alias("system"), payload(field).alias("value")))
    keyed = records.select("source_identity", "source_system", "source_record_id", "natural_key", F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), v.alias("of")) for k, v in kinds.items()))).alias("x")).filter("x.of IS NOT NULL")
    keyed = keyed.select("source_identity", "source_system", "source_record_id", "natural_key", F.col("x.kind").alias("kind"), "x.of")
    twice = keyed.groupBy("kind", "of").agg(F.count("*").alias("_n")).filter("_n > 1").drop("_n")
    hit = keyed.join(twice, ["kind", "of"], "left_semi")
    return hit.groupBy("source_identity", "source_system", "source_record_id", "natural_key").agg(F.array_sort(F.collect_set("kind")).alias("duplicate_kinds"))


def configuration_sha256(parts: dict[str, bytes]) -> str:
    """Binds a run to its policy, contracts and code: sha256 over names and the sha256 of their content, in order."""
    listed = {name: hashlib.sha256(content).hexdigest() for name, content in parts.items()}
    return hashlib.sha256(json.dumps(listed, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def rule_coverage(governed: set[tuple[str, str]], classes: dict[str, set[tuple[str, str]]]) -> dict[str, list[tuple[str, str]]]:
    """Each governed (identity, rule) under the first class that executes it; a rule without a class, or one that is not
    governed, is an error."""
    left, out = set(governed), {}
    strange = set().union(*classes.values()) - governed if classes else set()
    for name, pairs in classes.items():
        out[name] = sorted(pairs & left)
        left -= pairs
    if left or strange:
        raise RegistryError(f"rules without execution: {sorted(left)}, not governed: {sorted(strange)}")
    return out


def replay(registered: Row | None, recomputed: dict[str, object]) -> str:
    """'new' without a receipt, 'duplicate_no_op' if every field is as registered, else an error."""
    if registered is None:
        return "new"
    differing = sorted(k for k, v in recomputed.items() if registered[k] != v)
    if differing:
        raise RegistryError(f"a replay gave other results: {differing}")
    return "duplicate_no_op"
