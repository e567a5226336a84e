"""Fill-in-the-middle transformation: texts are cut at two unit boundaries and put together in another order.

An Arrow-batched pandas UDF runs through a text once with the regex library's ``finditer`` and keeps the end offset of
every unit in a compact array; the two cuts are look-ups in it and the parts are slices. Seeds are drawn from the sha256 of
the id, so a row has the same result in any partition and on any retry. No row depends on another: one narrow pass.

Defined results: a null text counts as an empty one; an empty text, and one that holds a marker, stays plain; a null id
draws the seeds of an empty id; repeated rows are transformed alike; texts of any length are cut whole; an empty table stays
empty. Columns whose names the result uses (any case) are replaced, all others are kept as they are.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shipping import ship

#: Markers of the parts, the units of a text, and how many of a hundred stay plain or lead with the suffix.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
UNIT = regex.compile(r"[A-Za-z]+|[^A-Za-z]")
PLAIN_FROM, SUFFIX_FIRST_BELOW = 90, 20
CUT = "n long, form string, prefix_chars long, middle_chars long, output string"
DIGESTS = "output_sha256 string, restored_sha256 string"


def seeds(doc_id: str) -> tuple[int, ...]:
    """The first four groups of eight hex digits of sha256("1:" and the id)."""
    drawn = hashlib.sha256(b"1:" + doc_id.encode()).hexdigest()
    return tuple(int(drawn[i : i + 8], 16) for i in range(0, 32, 8))


def transform(doc_id: str, text: str) -> tuple[int, str, int | None, int | None, str]:
    """(units, form, prefix characters, middle characters, output) of one text."""
    ends = array("I", [0])
    ends.extend(m.end() for m in UNIT.finditer(text))
    n = len(ends) - 1
    h1, h2, h3, h4 = seeds(doc_id)
    if not text or h3 % 100 >= PLAIN_FROM or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    first, second = sorted((ends[h1 % (n + 1)], ends[h2 % (n + 1)]))
    prefix, middle, suffix = text[:first], text[first:second], text[second:]
    if h4 % 100 < SUFFIX_FIRST_BELOW:
        return n, "spm", first, second - first, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", first, second - first, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def restore(output: str, form: str) -> str:
    """The text that ``transform`` was given. The parts hold no marker and none can begin in one, so the first is the one."""
    if form == "plain":
        return output
    lead, then = (SUFFIX, PREFIX) if form == "spm" else (PREFIX, SUFFIX)
    head, _, rest = output.removeprefix(lead).partition(then)
    tail, _, middle = rest.partition(MIDDLE)
    return tail + middle + head if form == "spm" else head + middle + tail


def _cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for ids, texts in batches:
        cut = pd.DataFrame([transform(i, t) for i, t in zip(ids, texts)], columns=["n", "form", "prefix_chars", "middle_chars", "output"])
        yield cut.astype({"prefix_chars": "Int64", "middle_chars": "Int64"})


def _digests(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    for outputs, forms in batches:
        yield pd.DataFrame({"output_sha256": [digest(o) for o in outputs], "restored_sha256": [digest(restore(o, f)) for o, f in zip(outputs, forms)]}, dtype="object")


def _restored(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for outputs, forms in batches:
        yield pd.Series([restore(o, f) for o, f in zip(outputs, forms)], dtype="object")


def _replaced(rows: DataFrame, made: F.Column, names: list[str]) -> DataFrame:
    """``rows`` with the fields of a struct as columns, in place of columns of these names."""
    kept = [F.col("`" + c.replace("`", "``") + "`") for c in rows.columns if c.lower() not in names]
    return rows.select(F.struct(*kept).alias("kept"), made.alias("made")).select("kept.*", *(f"made.{n}" for n in names))


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with n (units), form (plain, psm or spm), prefix_chars, middle_chars (null if plain) and output, the text as it
    is to be trained on."""
    ship(docs.sparkSession)
    made = F.pandas_udf(_cut, CUT)(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    return _replaced(docs, made, ["n", "form", "prefix_chars", "middle_chars", "output"])


def restore_texts(rows: DataFrame, name: str = "restored") -> DataFrame:
    """``rows`` (with output and form) with the texts rebuilt from them, under ``name``."""
    ship(rows.sparkSession)
    return rows.withColumn(name, F.pandas_udf(_restored, "string")("output", "form"))


def fill_in_middle_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256); the text itself is rebuilt and hashed again."""
    cut = fill_in_middle(docs.select(F.col(id_col), F.col(text_col).alias("text")), id_col)
    hashed = cut.select(id_col, "n", "form", "prefix_chars", "middle_chars", F.pandas_udf(_digests, DIGESTS)("output", "form").alias("made"))
    return hashed.select(id_col, "n", "form", "prefix_chars", "middle_chars", "made.output_sha256", "made.restored_sha256")


ORACLE = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || doc_id::VARCHAR) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS units, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM d),
c AS (SELECT *, len(units) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
  CASE WHEN t = '' OR contains(t, '{PREFIX}') OR contains(t, '{SUFFIX}') OR contains(t, '{MIDDLE}') OR h3 % 100 >= {PLAIN_FROM} THEN 'plain' WHEN h4 % 100 < {SUFFIX_FIRST_BELOW} THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, array_to_string(units[1:a], '') AS x, array_to_string(units[a + 1:b], '') AS y, array_to_string(units[b + 1:], '') AS z FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(x) END::BIGINT AS prefix_chars, CASE WHEN form <> 'plain' THEN length(y) END::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'spm' THEN '{SUFFIX}' || z || '{PREFIX}' || x || '{MIDDLE}' || y ELSE '{PREFIX}' || x || '{SUFFIX}' || z || '{MIDDLE}' || y END) AS output_sha256, sha256(t) AS restored_sha256
FROM p
"""
