"""Line dedup by winnowing over line hashes; DataFrame operations only.

A run of consecutive lines that holds RUN_WORDS words or more and has occurred
before (in a document with a smaller id, or earlier in the same one) is deleted;
shorter repeats stay. Blank lines are passed over in matching.

1. A line gram is the shortest run of lines from a line on that holds GRAM_WORDS
   words. Among the grams that start within WINDOW_WORDS words, the one with the
   smallest hash is a fingerprint. GRAM_WORDS + WINDOW_WORDS - 1 <= RUN_WORDS, so
   every run of RUN_WORDS words holds a fingerprint, the same one wherever it occurs.
2. Fingerprints are joined by hash; those that occur at two positions or more are hits.
3. Matches are extended both ways: for every line of a document with hits, the
   shortest runs of RUN_WORDS words that start and that end there. One that holds a
   hit and has an earlier occurrence is deleted. Their union is exactly the lines of
   all repeated runs. Runs are the same if two 64-bit hashes of all their lines are.

Defined results: a null text stays null, with 0 lines; an empty text stays empty; a
text of any length is treated whole; a text whose lines all go becomes empty; rows
with the same id and text are one document and are treated alike, and a null id
comes first; an empty table gives an empty result; other columns stay as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shipping import checkpointed, quoted

GRAM_WORDS, WINDOW_WORDS, RUN_WORDS = 20, 20, 50
#: White space besides the space and the end of a line, which counts as a space.
WHITE = "\t\x0b\x0c\r"
#: Parts that the places of a run are dealt to, so that one run in a third of all documents is not one task's.
PARTS = 32


def numbered_lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, body, pos, line hash in two parts, words, words before) of every line that is not blank, dealt by document."""
    texts = docs.select(F.col(quoted(id_col)).alias("doc"), F.xxhash64(quoted(text_col)).alias("body"), F.col(quoted(text_col)).alias("text"))
    lines = texts.select("doc", "body", F.posexplode(F.split(F.translate("text", WHITE, " " * len(WHITE)), "\n")).alias("pos", "line"))
    lines = lines.select("doc", "body", "pos", F.trim("line").alias("line")).filter("line <> ''")
    lines = lines.select("doc", "body", "pos", F.struct(F.xxhash64("line").alias("x"), F.xxhash64(F.lit(PARTS), "line").alias("y")).alias("h"), F.size(F.split("line", " +")).alias("n"))
    lines = lines.repartition("doc", "body").dropDuplicates(["doc", "body", "pos"])
    before = Window.partitionBy("doc", "body").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    return lines.withColumn("s", F.coalesce(F.sum("n").over(before), F.lit(0)))


def repeated_ranges(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, body, ranges: array of struct(first, last)) of line positions to delete; disjoint, for documents that have some."""
    by_doc = Window.partitionBy("doc", "body").orderBy("s")
    ahead = lambda words: by_doc.rangeBetween(0, words - 1)  # noqa: E731  lines that begin within so many words
    total = F.max(F.col("s") + F.col("n")).over(Window.partitionBy("doc", "body"))
    lines = numbered_lines(docs, id_col, text_col).withColumn("total", total).withColumn("e", F.col("s") + F.col("n"))
    grams = lines.withColumn("g", F.when(F.col("total") - F.col("s") >= GRAM_WORDS, F.xxhash64(F.collect_list("h").over(ahead(GRAM_WORDS))))).withColumn("least", F.min("g").over(ahead(WINDOW_WORDS)))
    # a gram is a fingerprint if it is the least of some window: of those it is in, the one with the largest least gram
    marked = grams.withColumn("largest", F.max("least").over(by_doc.rangeBetween(-(WINDOW_WORDS - 1), 0)))
    prints = marked.filter("g = largest").select("doc", "body", "pos", "g")
    seen = prints.groupBy("g").agg(F.count("*").alias("times")).filter("times > 1").select("g")
    hits = prints.join(seen, "g", "left_semi").select("doc", "body", "pos", F.lit(True).alias("hit"))

    # documents with hits: the shortest runs of RUN_WORDS words from each line on and up to each line
    hits = hits.select(F.col("doc").alias("hit_doc"), F.col("body").alias("hit_body"), F.col("pos").alias("hit_pos"), "hit")
    of_doc = F.col("doc").eqNullSafe(F.col("hit_doc")) & (F.col("body") == F.col("hit_body"))
    near = lines.join(hits.select("hit_doc", "hit_body").distinct(), of_doc, "left_semi")
    flagged = near.join(hits, of_doc & (F.col("pos") == F.col("hit_pos")), "left")
    run = lambda w: F.struct(F.sort_array(F.collect_list(F.struct("pos", "h")).over(w)).alias("lines"), F.coalesce(F.bool_or("hit").over(w), F.lit(False)).alias("hit"))
    by_end = Window.partitionBy("doc", "body").orderBy("e").rangeBetween(-(RUN_WORDS - 1), 0)
    both = flagged.select("doc", "body", F.when(F.col("total") - F.col("s") >= RUN_WORDS, run(ahead(RUN_WORDS))).alias("on"), F.when(F.col("e") >= RUN_WORDS, run(by_end)).alias("up"))
    runs = both.select("doc", "body", F.explode(F.array("on", "up")).alias("run")).filter("run.hit").select("doc", "body", F.xxhash64("run.lines.h").alias("key"), F.xxhash64(F.lit(PARTS), "run.lines.h").alias("key2"), F.pmod(F.xxhash64("doc", "body"), F.lit(PARTS)).alias("part"), F.col("run.lines.pos")[0].alias("first"), F.element_at("run.lines.pos", -1).alias("last"))
    runs = checkpointed(runs)  # few rows, read twice below
    place = F.struct("doc", "body", "first")
    # the first place of each part, then of all parts, handed back to the parts
    parts = runs.groupBy("key", "key2", "part").agg(F.min(place).alias("least"), F.count("*").alias("n"))
    whole = Window.partitionBy("key", "key2")
    first = parts.select("key", "key2", "part", F.min("least").over(whole).alias("origin"), F.sum("n").over(whole).alias("times")).filter("times > 1").drop("times")
    again = runs.join(first, ["key", "key2", "part"]).filter(place != F.col("origin")).select("doc", "body", "first", "last")

    # overlapping and touching ranges of a document become one
    order = Window.partitionBy("doc", "body").orderBy("first", "last")
    reach = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    steps = again.distinct().withColumn("opens", F.when(reach >= F.col("first") - 1, 0).otherwise(1))
    spans = steps.withColumn("k", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0))).groupBy("doc", "body", "k").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return spans.groupBy("doc", "body").agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("ranges"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counts: bool = False, names: tuple[str, str] = ("n_lines", "n_deleted")) -> DataFrame:
    """``docs`` with the later repeated runs deleted from the text; with ``counts`` also the lines and the deleted lines, as ``names``.

    Other columns may have any names; with ``counts`` they may not be ``names``."""
    clash = {c.lower() for c in docs.columns} & {n.lower() for n in names}
    if counts and clash:
        raise ValueError(f"columns named {sorted(clash)} are there already")
    ranges = repeated_ranges(docs, id_col, text_col)
    joined = docs.alias("d").join(ranges.alias("r"), F.col(f"d.{quoted(id_col)}").eqNullSafe(F.col("r.doc")) & (F.xxhash64(F.col(f"d.{quoted(text_col)}")) == F.col("r.body")), "left")
    text, found = F.col(f"d.{quoted(text_col)}"), F.col("r.ranges")
    lines = F.split(text, "\n")
    kept = F.filter(lines, lambda line, i: ~F.exists(found, lambda x: (i >= x["first"]) & (i <= x["last"])))
    deleted = F.aggregate(found, F.lit(0), lambda n, x: n + x["last"] - x["first"] + 1)
    new = F.when(found.isNull(), text).otherwise(F.array_join(kept, "\n"))
    columns = [new.alias(c) if c == text_col else F.col(f"d.{quoted(c)}") for c in docs.columns]
    if counts:
        columns += [F.when(text.isNull(), 0).otherwise(F.size(lines)).cast("long").alias(names[0]), F.coalesce(deleted, F.lit(0)).cast("long").alias(names[1])]
    return joined.select(*columns)


#: The same result by the plain definition: compare all shortest runs of RUN_WORDS words, by their text.
ORACLE = f"""
WITH raw AS (SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents),
spaced AS (SELECT doc_id, pos, trim(translate(line, chr(9) || chr(11) || chr(12) || chr(13), '    ')) AS line FROM raw),
lines AS (SELECT *, len(string_split_regex(line, ' +')) AS n FROM spaced WHERE line <> ''),
placed AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS s, sum(n) OVER (PARTITION BY doc_id) AS total FROM lines),
runs AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) OVER w AS key, min(pos) OVER w AS first_pos, max(pos) OVER w AS last_pos, total - s AS held FROM placed
  WINDOW w AS (PARTITION BY doc_id ORDER BY s RANGE BETWEEN CURRENT ROW AND {RUN_WORDS - 1} FOLLOWING)
  UNION ALL
  SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) OVER w, min(pos) OVER w, max(pos) OVER w, s + n FROM placed
  WINDOW w AS (PARTITION BY doc_id ORDER BY s + n RANGE BETWEEN {RUN_WORDS - 1} PRECEDING AND CURRENT ROW)),
again AS (SELECT * FROM (SELECT *, min((doc_id, first_pos)) OVER (PARTITION BY key) AS origin FROM runs WHERE held >= {RUN_WORDS}) WHERE (doc_id, first_pos) <> origin),
gone AS (SELECT DISTINCT r.doc_id, r.pos FROM raw r JOIN again a ON r.doc_id = a.doc_id AND r.pos BETWEEN a.first_pos AND a.last_pos),
kept AS (SELECT r.doc_id, string_agg(r.line, chr(10) ORDER BY r.pos) AS text FROM raw r ANTI JOIN gone g ON r.doc_id = g.doc_id AND r.pos = g.pos GROUP BY 1)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text, coalesce(len(string_split(d.text, chr(10))), 0)::BIGINT AS n_lines, coalesce(g.n, 0)::BIGINT AS n_deleted
FROM documents d LEFT JOIN kept k USING (doc_id) LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY 1) g USING (doc_id)
"""
