"""Benchmark decontamination by winnowing; DataFrame operations only.

Words are runs of ASCII letters (A-Z lowered), digits and non-ASCII characters. A
window is WINDOW consecutive words of a benchmark item; an item with fewer words,
but some, is one window. Words of a document that lie inside an occurrence of a
window are hit.

1. Documents and items are winnowed alike: of each SPAN consecutive GRAM-word hashes
   the smallest, the last of equal ones, is a fingerprint. SPAN + GRAM - 1 = WINDOW,
   so every shared window holds a fingerprint at the same place on both sides.
2. The documents' fingerprints are joined to the items'. A short item is found by its
   longest word instead.
3. A hit is extended both ways over the words around it, to the windows that hold it,
   and these are joined to the items' windows by their words.

The texts are read once, in one narrow pass, while the items' fingerprints (fixed
width) are few enough to be sent to every executor; beyond BROADCAST_GRAMS they are
joined by a shuffle of the documents' fingerprints, and the documents with hits are
read again.

Defined results: a null or empty text has no words and no hits; texts of any length
are compared whole, in linear time; repeated documents get the same row each;
repeated items with one id count once, items without an id or without words are not
compared; an empty benchmark leaves all documents clean; no other columns are read,
and their names do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shipping import checkpointed

WINDOW, GRAM = 10, 5
SPAN = WINDOW - GRAM + 1
#: The items' fingerprints are broadcast up to this many, of some 40 bytes each.
BROADCAST_GRAMS = 1_000_000
#: Keys of contaminated documents are broadcast up to this many, of two longs or a short id each.
BROADCAST_KEYS = 500_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """The words in their own case."""
    return F.regexp_extract_all(text, F.lit(r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"), F.lit(0))


def _key(words: Column) -> Column:
    """A run of words as one string; no word holds a space."""
    return F.translate(F.array_join(words, " "), _UPPER, _LOWER)


def _hashes(words: Column) -> Column:
    """A hash of each word; words of the same lower-case form share one, which finds more than is asked for, never less."""
    return F.transform(words, lambda w: F.xxhash64(F.lower(w)))


def _fingerprints(texts: DataFrame, keep: Column) -> DataFrame:
    """The columns of ``texts`` (one of them ``w``: words), p and g: place and hash of each fingerprint; rows for which ``keep`` holds as well.

    A gram is the least of some window if those on both sides of it that are not less make up a window with it."""
    h = F.col("h")
    grams = F.transform(h, lambda x, i: F.xxhash64(x, *(F.get(h, i + k) for k in range(1, GRAM))))
    hashed = texts.withColumn("h", _hashes(F.col("w"))).withColumn("grams", F.slice(grams, 1, F.greatest(F.size("w") - GRAM + 1, F.lit(0)))).drop("h")
    placed = hashed.select("*", F.posexplode_outer("grams").alias("p", "g"))

    def run(step: int, goes_on) -> Column:
        """Consecutive grams on one side that allow this one to be the least of a window, up to SPAN - 1."""
        stops = lambda k: ~F.coalesce(goes_on(F.get("grams", F.col("p") + step * k)), F.lit(False))
        out = F.when(stops(1), 0)
        for k in range(2, SPAN):
            out = out.when(stops(k), k - 1)
        return out.otherwise(SPAN - 1)

    # one filter only, and a short one: a longer method would not be compiled by the JVM
    return placed.filter(keep | (run(-1, lambda other: other >= F.col("g")) + run(1, lambda other: other > F.col("g")) >= SPAN - 1)).drop("grams")


def _around(first: Column, last: Column, size: Column) -> Column:
    """The windows of ``size`` words that start from first to last: array of struct(start, size, key)."""
    starts = F.when(last >= first, F.sequence(first, F.greatest(first, last))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.struct(i.alias("start"), size.alias("size"), _key(F.slice("w", i + 1, size)).alias("key")))


def _wanted(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    return items.select(F.col(item_col).cast("string").alias("item"), words_of(F.col(text_col)).alias("w")).filter("item IS NOT NULL AND size(w) > 0").distinct()


def _candidates(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, counted: bool) -> DataFrame:
    """(doc, body, n_words, windows): the windows around hits; with ``counted`` also a row for each document, the one with n_words."""
    texts = docs.select(F.col(id_col).alias("doc"), F.xxhash64(F.col(text_col)).alias("body"), words_of(F.col(text_col)).alias("w"))
    of_items = _fingerprints(wanted.filter(F.size("w") >= WINDOW), F.lit(False)).select(F.col("g").alias("wanted")).distinct()
    small = of_items.limit(BROADCAST_GRAMS + 1).count() <= BROADCAST_GRAMS
    number = F.coalesce(F.greatest(F.size("w"), F.lit(0)), F.lit(0))
    windows = _around(F.greatest(F.col("p") - (WINDOW - GRAM), F.lit(0)), F.least(F.col("p"), F.size("w") - WINDOW), F.lit(WINDOW))
    first = F.coalesce(F.col("p"), F.lit(0)) == 0
    if small:
        probed = _fingerprints(texts, first if counted else F.lit(False)).join(F.broadcast(of_items), F.col("g") == F.col("wanted"), "left" if counted else "inner")
        found = F.col("wanted").isNotNull()
        out = probed.filter(found | first).select("doc", "body", F.when(first & F.lit(counted), number).alias("n_words"), F.when(found, windows).alias("windows"))
    else:
        hits = _fingerprints(texts, F.lit(False)).select("doc", "body", "p", "g").join(of_items, F.col("g") == F.col("wanted")).groupBy(F.col("doc").alias("hit_doc"), F.col("body").alias("hit_body")).agg(F.collect_set("p").alias("places"))
        again = texts.join(hits, F.col("doc").eqNullSafe(F.col("hit_doc")) & (F.col("body") == F.col("hit_body"))).dropDuplicates(["doc", "body"])
        out = again.select("doc", "body", "w", F.explode_outer("places").alias("p")).select("doc", "body", F.lit(None).cast("int").alias("n_words"), windows.alias("windows"))
        if counted:
            out = out.unionByName(texts.select("doc", "body", number.alias("n_words"), F.lit(None).cast(out.schema["windows"].dataType).alias("windows")))
    out = checkpointed(out)

    short = wanted.filter(F.size("w") < WINDOW)
    if short.isEmpty():
        return out
    # a short item is looked for where its longest word stands
    longest = F.array_max(F.transform("w", lambda w, i: F.struct(F.length(w).alias("length"), F.xxhash64(F.lower(w)).alias("hash"), i.alias("at"))))
    anchors = short.select(longest.alias("x"), F.size("w").alias("size")).select(F.col("x.hash").alias("wanted"), F.col("x.at").alias("at"), "size").distinct()
    anchors = F.broadcast(anchors) if anchors.limit(BROADCAST_GRAMS + 1).count() <= BROADCAST_GRAMS else anchors
    start = F.col("p") - F.col("at")
    fits = (start >= 0) & (start + F.col("size") <= F.col("of"))
    words = texts.withColumn("h", _hashes(F.col("w"))).select("doc", "body", "w", F.size("w").alias("of"), F.posexplode_outer("h").alias("p", "g"))
    near = words.join(anchors, F.col("g") == F.col("wanted")).filter(fits).select("doc", "body", F.lit(None).cast("int").alias("n_words"), _around(start, start, F.col("size")).alias("windows"))
    return out.unionByName(checkpointed(near))


def _occurring(candidates: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc, body, start, size, item) of the windows that occur in a document, once each."""
    size = F.least(F.size("w"), F.lit(WINDOW))
    of_items = wanted.select("item", F.explode(_around(F.lit(0), F.size("w") - size, size)).alias("x")).select("item", F.col("x.size").alias("size"), F.col("x.key").alias("key")).distinct()
    windows = candidates.filter("windows IS NOT NULL").select("doc", "body", F.explode_outer("windows").alias("x")).select("doc", "body", "x.start", "x.size", "x.key").distinct()
    return windows.join(of_items, ["size", "key"]).select("doc", "body", "start", "size", "item")


def find_contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc: id, body: hash of the text, start, size, item) of every window of an item in a document, in words."""
    wanted = _wanted(items, item_col, item_text_col)
    return _occurring(_candidates(docs, wanted, id_col, text_col, False), wanted)


def contamination_report(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Per document: words, words hit, items with occurring windows and a digest of their ids."""
    wanted = _wanted(items, item_col, item_text_col)
    candidates = _candidates(docs, wanted, id_col, text_col, True)
    of_doc = _occurring(candidates, wanted).groupBy("doc", "body").agg(F.sort_array(F.collect_set(F.struct("start", "size"))).alias("xs"), F.sort_array(F.collect_set("item")).alias("items"))
    none = F.struct(F.lit(0).alias("reach"), F.lit(0).alias("hit"))
    covered = lambda acc, x: F.struct(F.greatest(acc["reach"], x["start"] + x["size"]).alias("reach"), (acc["hit"] + F.greatest(x["start"] + x["size"] - F.greatest(acc["reach"], x["start"]), F.lit(0))).alias("hit"))
    of_doc = of_doc.select(F.col("doc").alias("hit_doc"), F.col("body").alias("hit_body"), F.aggregate("xs", none, covered, lambda acc: acc["hit"]).cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"))
    rows = candidates.filter("n_words IS NOT NULL").select("doc", "body", "n_words")
    joined = rows.join(of_doc, F.col("doc").eqNullSafe(F.col("hit_doc")) & (F.col("body") == F.col("hit_body")), "left")
    nothing = F.lit(0).cast("long")
    return joined.select(F.col("doc").alias(id_col), F.col("n_words").cast("long").alias("n_words"), F.coalesce("n_hit", nothing).alias("n_hit"), F.coalesce("n_items", nothing).alias("n_items"), F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"), F.col("n_hit").isNotNull().alias("contaminated"))


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **columns: str) -> DataFrame:
    """``docs`` without the documents in which a window of an item occurs."""
    found = checkpointed(find_contamination(docs, items, id_col, text_col, **columns).select("doc", "body").distinct())
    found = F.broadcast(found) if found.count() <= BROADCAST_KEYS else found
    same = F.col(f"d.{id_col}").eqNullSafe(F.col("x.doc")) & (F.xxhash64(F.col(f"d.{text_col}")) == F.col("x.body"))
    return docs.alias("d").join(found.alias("x"), same, "left_anti")


_WORDS_SQL = rf"regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
ORACLE = rf"""
WITH d AS (SELECT doc_id, coalesce({_WORDS_SQL}, []) AS w FROM documents),
b AS (SELECT item_id::VARCHAR AS item, {_WORDS_SQL} AS w FROM benchmark),
size AS (SELECT DISTINCT least(len(w), {WINDOW}) AS n FROM b WHERE len(w) > 0),
item_windows AS (SELECT DISTINCT item, n, array_to_string(w[i + 1 : i + n], ' ') AS key FROM (SELECT item, w, least(len(w), {WINDOW}) AS n, unnest(range(len(w) - least(len(w), {WINDOW}) + 1)) AS i FROM b WHERE len(w) > 0)),
doc_windows AS (SELECT doc_id, n, i, array_to_string(w[i + 1 : i + n], ' ') AS key FROM (SELECT doc_id, w, n, unnest(range(len(w) - n + 1)) AS i FROM d CROSS JOIN size WHERE len(w) >= n)),
found AS (SELECT x.doc_id, x.i, x.n, y.item FROM doc_windows x JOIN item_windows y USING (n, key)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY 1),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY 1)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit, coalesce(n.n_items, 0)::BIGINT AS n_items, sha256(coalesce(n.names, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit h USING (doc_id) LEFT JOIN named n USING (doc_id)
"""
