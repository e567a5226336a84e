"""The fourteen source contracts as text, and what follows from them: read schemas, typed views and row rules."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import quality as Q

#: Field, type (! for required) and bounds of each source, in file order.
FIELDS = r"""
[claims]
claim_id STRING!
submission_sequence INTEGER! from 1
original_claim_source_system STRING
original_claim_id STRING
original_submission_sequence INTEGER from 1
patient_id STRING!
eligibility_source_system STRING!
eligibility_id STRING!
provider_id STRING!
facility_id STRING!
payer_id STRING!
plan_id STRING!
claim_type STRING! in professional,institutional
claim_status STRING! in submitted,accepted,rejected,denied,partially_paid,paid,voided
submission_type STRING! in original,replacement,void
service_from_date DATE!
service_to_date DATE!
submitted_at TIMESTAMP!
first_response_at TIMESTAMP
first_response_disposition STRING in accepted,rejected
adjudicated_at TIMESTAMP
primary_diagnosis_code STRING!
primary_diagnosis_code_system STRING! in ICD-10-CM,SYNTHETIC
billed_amount NUMERIC(18,2)! from 0.00
allowed_amount NUMERIC(18,2) from 0.00
payer_paid_amount NUMERIC(18,2)! from 0.00
patient_paid_amount NUMERIC(18,2)! from 0.00
patient_responsibility_amount NUMERIC(18,2)! from 0.00
adjustment_amount NUMERIC(18,2)! from 0.00
outstanding_balance NUMERIC(18,2)! from 0.00
currency_code STRING! in USD
clean_claim_flag BOOLEAN!
first_pass_accepted_flag BOOLEAN!
filing_deadline_date DATE
source_updated_at TIMESTAMP!
[claim-lines]
claim_id STRING!
submission_sequence INTEGER! from 1
line_number INTEGER! from 1
claim_line_id STRING!
service_from_date DATE!
service_to_date DATE!
procedure_code STRING!
procedure_code_system STRING! in CPT,HCPCS,SYNTHETIC
procedure_modifiers STRING_LIST
diagnosis_codes STRING_LIST!
diagnosis_code_system STRING! in ICD-10-CM,SYNTHETIC
place_of_service_code STRING! like ^[0-9]{2}$
revenue_code STRING like ^[0-9]{4}$
units NUMERIC(9,4)! above 0
line_status STRING! in submitted,accepted,rejected,denied,partially_paid,paid,voided
denial_reason_code STRING
billed_amount NUMERIC(18,2)! from 0.00
allowed_amount NUMERIC(18,2) from 0.00
payer_paid_amount NUMERIC(18,2)! from 0.00
patient_paid_amount NUMERIC(18,2)! from 0.00
patient_responsibility_amount NUMERIC(18,2)! from 0.00
adjustment_amount NUMERIC(18,2)! from 0.00
outstanding_balance NUMERIC(18,2)! from 0.00
currency_code STRING! in USD
source_updated_at TIMESTAMP!
[eligibility]
eligibility_id STRING!
patient_id STRING!
payer_id STRING!
plan_id STRING!
member_reference STRING!
verification_at TIMESTAMP!
response_status STRING! in confirmed,inactive,unknown,failed
coverage_status STRING! in active,inactive,pending,unknown
coverage_type STRING! in commercial,medicare,medicaid,self_pay,other
coverage_start_date DATE
coverage_end_date DATE
primary_coverage_flag BOOLEAN!
deductible_remaining NUMERIC(18,2) from 0.00
out_of_pocket_remaining NUMERIC(18,2) from 0.00
copay_amount NUMERIC(18,2) from 0.00
currency_code STRING! in USD
source_updated_at TIMESTAMP!
[remittances]
remittance_id STRING!
reverses_remittance_source_system STRING
reverses_remittance_id STRING
payer_id STRING!
source_control_number STRING!
payment_trace_number STRING!
payment_method STRING! in eft,check,virtual_card,none
direction STRING! in credit,debit
remittance_date DATE!
received_at TIMESTAMP!
total_payment_amount NUMERIC(18,2)! from 0.00
claim_transaction_count INTEGER! from 0
currency_code STRING! in USD
remittance_status STRING! in received,posted,reversed
source_updated_at TIMESTAMP!
[payments]
payment_id STRING!
remittance_source_system STRING
remittance_id STRING
claim_source_system STRING!
claim_id STRING!
claim_submission_sequence INTEGER! from 1
claim_line_number INTEGER from 1
claim_line_id STRING
payer_id STRING
transaction_type STRING! in payer_payment,patient_payment,contractual_adjustment,write_off,refund,reversal
direction STRING! in credit,debit
amount NUMERIC(18,2)! above 0.00
currency_code STRING! in USD
payment_date DATE!
posted_at TIMESTAMP!
adjustment_reason_code STRING
reverses_payment_source_system STRING
reverses_payment_id STRING
posting_status STRING! in posted,reversed
source_updated_at TIMESTAMP!
[denials]
denial_id STRING!
claim_source_system STRING!
claim_id STRING!
claim_submission_sequence INTEGER! from 1
claim_line_number INTEGER from 1
claim_line_id STRING
payer_id STRING!
denial_reason_code STRING!
denial_category STRING!
denial_date DATE!
received_at TIMESTAMP!
denied_amount NUMERIC(18,2)! above 0.00
currency_code STRING! in USD
filing_deadline_date DATE!
appeal_deadline_date DATE!
denial_status STRING! in open,under_review,appealed,overturned,upheld,expired,withdrawn
preventable_flag BOOLEAN!
documentation_ready_flag BOOLEAN!
missing_document_codes STRING_LIST
source_updated_at TIMESTAMP!
[appeals]
appeal_id STRING!
denial_source_system STRING!
denial_id STRING!
claim_source_system STRING!
claim_id STRING!
claim_submission_sequence INTEGER! from 1
appeal_level INTEGER! from 1 to 3
appeal_status STRING! in draft,ready_for_human_review,filed,pending,overturned,partially_overturned,upheld,withdrawn,expired
created_at TIMESTAMP!
filed_at TIMESTAMP
appeal_deadline_date DATE!
decision_date DATE
outcome STRING in overturned,partially_overturned,upheld,withdrawn
requested_amount NUMERIC(18,2)! above 0.00
recovered_amount NUMERIC(18,2) from 0.00
currency_code STRING! in USD
documentation_ready_flag BOOLEAN!
owner_queue STRING!
source_updated_at TIMESTAMP!
[reference-data.payers]
payer_id STRING!
payer_name STRING!
payer_type STRING! in commercial,medicare,medicaid,self_pay,other
timely_filing_days INTEGER! from 1
appeal_window_days INTEGER! from 1
expected_response_days INTEGER! from 1
historical_resolution_rate NUMERIC(9,4)! from 0.0000 to 1.0000
valid_from DATE!
valid_to DATE
active_flag BOOLEAN!
[reference-data.plans]
plan_id STRING!
payer_id STRING!
plan_name STRING!
coverage_type STRING! in commercial,medicare,medicaid,self_pay,other
valid_from DATE!
valid_to DATE
active_flag BOOLEAN!
[reference-data.providers]
provider_id STRING!
provider_name STRING!
specialty_code STRING!
valid_from DATE!
valid_to DATE
active_flag BOOLEAN!
[reference-data.facilities]
facility_id STRING!
facility_name STRING!
clinic_number INTEGER! from 1 to 20
region STRING!
valid_from DATE!
valid_to DATE
active_flag BOOLEAN!
[reference-data.diagnoses]
diagnosis_code STRING!
code_system STRING! in ICD-10-CM,SYNTHETIC
diagnosis_description STRING!
valid_from DATE!
valid_to DATE
active_flag BOOLEAN!
[reference-data.procedures]
procedure_code STRING!
code_system STRING! in CPT,HCPCS,SYNTHETIC
procedure_description STRING!
valid_from DATE!
valid_to DATE
active_flag BOOLEAN!
[reference-data.denial-reasons]
denial_reason_code STRING!
denial_category STRING!
denial_reason_description STRING!
preventable_default_flag BOOLEAN!
required_document_codes STRING_LIST
historical_resolution_rate NUMERIC(9,4)! from 0.0000 to 1.0000
valid_from DATE!
valid_to DATE
active_flag BOOLEAN!
"""
#: Natural key of each source. Transactions are keyed within their source system, references by version.
KEYS = {
    "claims": ("source_system", "claim_id", "submission_sequence"),
    "claim-lines": ("source_system", "claim_id", "submission_sequence", "line_number"),
    "eligibility": ("source_system", "eligibility_id"),
    "remittances": ("source_system", "remittance_id"),
    "payments": ("source_system", "payment_id"),
    "denials": ("source_system", "denial_id"),
    "appeals": ("source_system", "appeal_id"),
    "reference-data.payers": ("payer_id", "valid_from"),
    "reference-data.plans": ("plan_id", "valid_from"),
    "reference-data.providers": ("provider_id", "valid_from"),
    "reference-data.facilities": ("facility_id", "valid_from"),
    "reference-data.diagnoses": ("diagnosis_code", "code_system", "valid_from"),
    "reference-data.procedures": ("procedure_code", "code_system", "valid_from"),
    "reference-data.denial-reasons": ("denial_reason_code", "valid_from"),
}
#: Event column and largest age in seconds of each source; references have no event column.
FRESHNESS = {"claims": ("source_updated_at", 5400), "claim-lines": ("source_updated_at", 5400), "eligibility": ("verification_at", 108000), "remittances": ("received_at", 129600), "payments": ("posted_at", 7200), "denials": ("received_at", 7200), "appeals": ("source_updated_at", 7200)}
#: Letters that the rule ids of a source begin with.
PREFIX = {"claims": "CLM", "claim-lines": "CLN", "eligibility": "ELG", "remittances": "REM", "payments": "PAY", "denials": "DEN", "appeals": "APL"}

#: Rules that a value outside its list or bounds breaks, by source and field; CMN-014 elsewhere.
VALUE_RULES = {
    ("CLM", "currency_code"): "CLM-005", ("CLN", "currency_code"): "CLN-006", ("ELG", "currency_code"): "ELG-007", ("REM", "currency_code"): "REM-004", ("REM", "total_payment_amount"): "REM-004",
    ("PAY", "currency_code"): "PAY-004", ("PAY", "amount"): "PAY-004", ("DEN", "currency_code"): "DEN-006", ("DEN", "denied_amount"): "DEN-006",
}


@dataclass(frozen=True)
class Field:
    name: str
    kind: str
    required: bool
    words: tuple[str, ...]

    def bound(self, word: str) -> str | None:
        return self.words[self.words.index(word) + 1] if word in self.words else None


@dataclass(frozen=True)
class Contract:
    identity: str
    fields: tuple[Field, ...]
    key: tuple[str, ...]

    @property
    def prefix(self) -> str:
        return PREFIX.get(self.identity, "REF")

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    def typed(self, rows: DataFrame, *keep: str) -> DataFrame:
        """Text columns as their contract types; blank text is null. Columns outside the contract stay if named."""
        return rows.select(*keep, *(S.typed(F.col(f.name), f.kind).alias(f.name) for f in self.fields))

    def normalised(self, rows: DataFrame) -> DataFrame:
        """Trimmed text, enumerations in their declared case, booleans as true and false."""
        out = {}
        for f in self.fields:
            c = F.trim(F.translate(F.coalesce(F.col(f.name), F.lit("")), "\t\r\n", "   "))
            if f.kind == "BOOLEAN":
                c = F.coalesce(S.boolean_text(c).cast("string"), c)
            elif values := f.bound("in"):
                same = F.lit(None).cast("string")
                for v in values.split(","):
                    same = F.when(F.lower(c) == v.lower(), v).otherwise(same)
                c = F.coalesce(same, c)
            out[f.name] = c
        return rows.withColumns(out)

    def row_rules(self) -> list[Q.Rule]:
        """Rules that need the row alone: required fields, types, enumerations, patterns and bounds."""
        rules = []
        for f in self.fields:
            text = F.col(f.name)
            governed = self.prefix == "REF" and f.name.endswith(("_rate", "_days"))
            rule = "REF-007" if governed else VALUE_RULES.get((self.prefix, f.name), "CMN-014")
            value, blank = S.typed(text, f.kind), F.coalesce(text, F.lit("")) == ""
            if f.required:
                rules.append(Q.Rule(f"{self.prefix}-001", "rejected", f.name, "required", blank))
            if f.kind not in ("STRING", "STRING_LIST"):
                rules.append(Q.Rule("CMN-013", "rejected", f.name, "unparsable", ~blank & value.isNull()))
            if values := f.bound("in"):
                rules.append(Q.Rule(rule, "quarantined", f.name, "not allowed", ~blank & ~text.isin(*values.split(","))))
            if shape := f.bound("like"):
                rules.append(Q.Rule("CLN-005" if self.prefix == "CLN" else "CMN-014", "quarantined", f.name, "pattern", ~blank & ~text.rlike(shape)))
            for word, broken in (("from", lambda x: value < x), ("above", lambda x: value <= x), ("to", lambda x: value > x)):
                if limit := f.bound(word):
                    rules.append(Q.Rule(rule, "quarantined", f.name, f"not {word} {limit}", broken(F.lit(limit).cast("decimal(18,4)"))))
        return rules


@cache
def contracts() -> dict[str, Contract]:
    found: dict[str, list[Field]] = {}
    identity = ""
    for line in FIELDS.strip().splitlines():
        if line.startswith("["):
            identity = line[1:-1]
            found[identity] = []
            continue
        name, kind, *words = line.split(" ")
        found[identity].append(Field(name, kind.rstrip("!"), kind.endswith("!"), tuple(words)))
    return {i: Contract(i, tuple(fields), KEYS[i]) for i, fields in found.items()}
