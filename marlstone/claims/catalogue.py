"""Which rule of the claims pack is executed where: every governed (source, rule) pair is bound to what judges it, or the pack
does not run."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.catalogue import CatalogueError
from ..operators.quality import Relationship
from ..operators.registry import RegistryError, rule_coverage
from .contracts import KEYS, PREFIX, contracts
from .cross_rules import ACROSS

#: How many rules, numbered from 001, each family governs.
GOVERNED = {"CLM": 14, "CLN": 10, "ELG": 8, "REM": 9, "PAY": 12, "DEN": 10, "APL": 12, "REF": 8}
#: The rule that a relationship from a source to a target breaks.
POLICY = """
reference-data.plans reference-data.payers REF-006
eligibility reference-data.payers ELG-003
eligibility reference-data.plans ELG-003
claims claims CLM-010
claims eligibility CLM-011
claims reference-data.providers CLM-004
claims reference-data.facilities CLM-004
claims reference-data.payers CLM-004
claims reference-data.plans CLM-004
claims reference-data.diagnoses CLM-008
claim-lines claims CLN-003
claim-lines reference-data.procedures CLN-005
claim-lines reference-data.diagnoses CLN-005
claim-lines reference-data.denial-reasons CLN-005
remittances reference-data.payers REM-003
remittances remittances REM-008
payments payments PAY-008
payments claims PAY-003
payments claim-lines PAY-003
payments remittances PAY-003
payments reference-data.payers PAY-003
denials claims DEN-003
denials claim-lines DEN-003
denials reference-data.payers DEN-003
denials reference-data.denial-reasons DEN-004
appeals denials APL-003
appeals claims APL-003
"""
#: Rules that the read of a delivery judges already, besides required fields and duplicate keys.
AT_INGESTION = ("CLM-005", "CLM-006", "CLM-007", "CLM-012", "CLN-006", "CLN-007", "CLN-009", "CLN-010", "ELG-005", "ELG-007", "PAY-004", "PAY-011", "REF-003", "REM-004", "REM-007")
#: Rules over whole batches, over sums of payments, and the one that a closed schema meets by itself.
BATCH, SUMS, BOUNDARY = ("REF-008",), ("REM-006", "PAY-008", "PAY-009"), ("APL-010",)


def policy() -> dict[tuple[str, str], str]:
    lines = [line.split() for line in POLICY.strip().splitlines()]
    out = {(source, target): rule for source, target, rule in lines}
    if len(out) != len(lines):
        raise CatalogueError("the policy names a relationship twice")
    return out


def governed() -> set[tuple[str, str]]:
    return {(i, f"{PREFIX.get(i, 'REF')}-{n:03d}") for i in KEYS for n in range(1, GOVERNED[PREFIX.get(i, "REF")] + 1)}


def checked_relationships(declared: list[Relationship]) -> list[Relationship]:
    """``declared`` if each one breaks the rule that the policy has for it, its fields are in the contracts, and no line of
    the policy is left over."""
    rules, fields = policy(), {i: {"source_system", *c.columns} for i, c in contracts().items()}
    wrong = [f"{s.name}: the policy has {rules.get((s.source, s.target))}, not {s.rule_id}" for s in declared if rules.get((s.source, s.target)) != s.rule_id]
    wrong += [f"policy {p} is used by no relationship" for p in sorted(rules.keys() - {(s.source, s.target) for s in declared})]
    for s in declared:
        asked = {a for a, _ in s.keys} | ({s.as_of} if s.as_of else set())
        wrong += [f"{s.name}: unknown field {f}" for f in sorted((asked - fields[s.source]) | ({b for _, b in s.keys} - fields[s.target]))]
    if wrong:
        raise CatalogueError("; ".join(wrong))
    return declared


def execution_inventory(declared: list[Relationship] | None = None) -> dict[str, list[tuple[str, str]]]:
    """All governed pairs, each under the one class that executes it, taken from the rules that are really built: reverified
    (judged at ingestion too), relationship, semantic, batch, boundary, not_applicable. A pair that nothing executes, or a
    rule that nothing governs, is an error."""
    from .rules import RELATIONSHIPS, row_rules

    declared = checked_relationships(RELATIONSHIPS if declared is None else declared)
    now = F.current_timestamp()
    prefix = {i: PREFIX.get(i, "REF") for i in KEYS}
    built = {(i, r.rule_id) for i, c in contracts().items() for r in (*c.row_rules(), *row_rules(i, now)) if not r.rule_id.startswith("CMN-")}
    across = {(i, r) for i in KEYS for r in (*ACROSS, *SUMS) if r.startswith(prefix[i])}
    keys = {(i, f"{prefix[i]}-002") for i in KEYS}
    # a relationship that compares more than the target's key judges what the rows say, not only that they are there
    saying = {(s.source, s.rule_id) for s in declared if not {b for _, b in s.keys} <= set(KEYS[s.target])}
    plain = {(s.source, s.rule_id) for s in declared}
    early = {(i, r) for i, r in built | keys if r in AT_INGESTION or r.endswith(("-001", "-002"))}
    left_out = {(i, r) for i in KEYS if prefix[i] == "REF" for r in ("REF-006", "REF-007") if (i, r) not in built | plain}
    try:
        return rule_coverage(governed(), {
            "not_applicable": left_out, "reverified": early, "semantic": ((built | across | saying) - early - left_out), "relationship": plain - built - across - saying,
            "batch": {(i, r) for i in KEYS for r in BATCH if r.startswith(prefix[i])}, "boundary": {(i, r) for i in KEYS for r in BOUNDARY if r.startswith(prefix[i])},
        })
    except RegistryError as e:
        raise CatalogueError(str(e)) from e
