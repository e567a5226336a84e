"""Line dedup, decontamination, Jaccard join, embeddings, licences, components and the pipeline against brute force."""

import collections
import hashlib
import itertools
import random
import re
import textwrap

import numpy as np
import pytest
from pyspark.sql import functions as F

from marlstone.llm import components, decontam, embed, jaccard, licenses, linededup

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id bigint, text string, doc string, n int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], SCHEMA)


def roots_of(nodes, pairs):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randint(-60, 60), rng.randint(-60, 60)) for _ in range(70)] + [(k, k + 1) for k in range(1000, 1040)] + [(5000, k) for k in range(5001, 5080)]
    got = {r.node: r.root for r in components.connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    want = roots_of({x for e in edges for x in e}, edges)
    assert got == {n: r for n, r in want.items() if any(n in e and e[0] != e[1] for e in edges)}
    assert components.connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def lines(rng, n, words=(1, 30)):
    return [" ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(rng.randint(*words))) for _ in range(n)]


def deleted(rows):
    """Lines in a run of RUN_WORDS words that occurred before, straight from the definition."""
    docs = [(i, [(p, line.strip(" ")) for p, line in enumerate(t.split("\n")) if line.strip(" ")]) for i, t in sorted(rows)]
    seen: dict = {}
    runs = []
    for i, ls in docs:
        for a in range(len(ls)):
            total = 0
            for b in range(a, len(ls)):
                total += len(re.split(" +", ls[b][1]))
                if total >= linededup.RUN_WORDS:
                    runs.append((tuple(x for _, x in ls[a : b + 1]), i, ls[a][0], ls[b][0]))
    for key, i, a, _ in runs:
        seen[key] = min(seen.get(key, (i, a)), (i, a))
    gone = collections.defaultdict(set)
    for key, i, a, b in runs:
        if seen[key] != (i, a):
            gone[i].update(range(a, b + 1))
    return gone


@pytest.mark.parametrize("seed", range(3))
def test_line_dedup_matches_its_definition(spark, seed):
    rng = random.Random(seed)
    pool = lines(rng, 30)
    rows = []
    for i in range(25):
        start = rng.randint(0, 20)
        rows.append((i, "\n".join(lines(rng, 3) + pool[start : start + rng.randint(0, 8)] + ["", "  "] + lines(rng, 2) + ([pool[3]] * 9 if i % 9 == 0 else []))))
    rows += [(100, ""), (101, "\n\n"), (102, rows[0][1])]
    got = {r.doc_id: (r.text, r.n_deleted) for r in linededup.dedup_lines(frame(spark, [*rows, (103, None), (102, rows[0][1])]), counts=True).collect()}
    gone = deleted(rows)
    for i, t in rows:
        kept = [line for p, line in enumerate(t.split("\n")) if p not in gone[i]]
        assert got[i] == ("\n".join(kept), len(gone[i])), i
    assert got[103] == (None, 0)
    assert sum(map(len, gone.values())) > 20


def test_line_dedup_edges(spark):
    long = " ".join(f"w{k}" for k in range(51))
    df = frame(spark, [(2, f"a\n{long}\nb"), (1, f"x\n{long}"), (None, f"{long}\nz"), (3, long)])
    got = {r.doc_id: r.text for r in linededup.dedup_lines(df).collect()}
    assert got == {None: f"{long}\nz", 1: "x", 2: "a\nb", 3: ""}
    assert linededup.dedup_lines(df.filter("false")).count() == 0 and linededup.dedup_lines(df).columns == df.columns


def test_white_space_of_any_kind_parts_words(spark):
    words = [f"w{k}" for k in range(60)]
    texts = [" ".join(words), "\t".join(words), " ".join(words) + " \r", "\x0b" + "\x0c".join(words), " ".join(words[:30]) + "\t" + " ".join(words[30:])]
    got = {r.doc_id: r.text for r in linededup.dedup_lines(frame(spark, [(i, f"own {i}\n{t}\nend {i}") for i, t in enumerate(texts)])).collect()}
    assert got == {0: f"own 0\n{texts[0]}\nend 0", **{i: f"own {i}\nend {i}" for i in range(1, 5)}}


def test_names_with_dots_and_ticks(spark):
    long = " ".join(f"w{k}" for k in range(60))
    df = frame(spark, [(1, long), (2, f"x\n{long}"), (3, "other")]).withColumns({"a.b": F.lit("k"), "c`d": F.lit(1), "doc": F.lit("clash")})
    got = linededup.dedup_lines(df)
    assert got.columns == df.columns and {(r.doc_id, r.text, r["a.b"], r["c`d"], r.doc) for r in got.collect()} == {(1, long, "k", 1, "clash"), (2, "x", "k", 1, "clash"), (3, "other", "k", 1, "clash")}
    one = jaccard.keep_one(df)
    assert one.columns == df.columns and {(r.doc_id, r["a.b"]) for r in one.collect()} == {(1, "k"), (3, "k")}
    import corpus_pipeline

    assert corpus_pipeline.line_dedup(spark, df.withColumn("n_chars", F.lit(0).cast("long")), "").filter("doc_id = 2").first()["a.b"] == "k"


def windows_of(words):
    n = min(len(words), decontam.WINDOW)
    return {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if n else set()


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


@pytest.mark.parametrize("seed", range(2))
def test_contamination_matches_brute_force(spark, seed):
    rng = random.Random(seed)
    some = lambda n: [rng.choice(["The", "ab", "é", "x1", "Zz", "the"]) for _ in range(n)]
    items = [(k, " ".join(some(rng.choice([3, 9, 10, 12, 30])))) for k in range(8)] + [(8, ""), (9, None), (None, " ".join(some(12))), (3, "q r s t u v w x y z"), (10, "the the the the the the the the the the the")]
    docs = []
    for i in range(40):
        w = some(rng.randint(0, 30))
        source = (rng.choice(items)[1] or "").split()
        at = rng.randint(0, max(0, len(source) - 11))
        docs.append((i, "-".join(w + [x.lower() for x in source[at : at + rng.randint(0, 14)]] + some(3))))
    docs += [(50, None), (51, ""), (52, "the " * 300), (0, docs[0][1])]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = {r.doc_id: r for r in decontam.contamination_report(frame(spark, docs), bench).collect()}
    for i, t in docs:
        w, hit, names = words_of(t), set(), set()
        for k, s in items:
            for win in windows_of(words_of(s)) if k is not None else ():
                for a in range(len(w) - len(win) + 1):
                    if tuple(w[a : a + len(win)]) == win:
                        hit.update(range(a, a + len(win)))
                        names.add(str(k))
        want = (len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit))
        r = got[i]
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == want, i
    kept = {r.doc_id for r in decontam.drop_contaminated(frame(spark, docs), bench).collect()}
    assert kept == {i for i, r in got.items() if not r.contaminated}
    assert not any(r.contaminated for r in decontam.contamination_report(frame(spark, docs), bench.filter("false")).collect())
    assert decontam.contamination_report(frame(spark, docs).filter("false"), bench).count() == 0


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    return frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[k : k + 5]) for k in range(len(w) - 4)])


def jaccard_truth(rows):
    sets = {i: shingles(t) for i, t in rows}
    ids = sorted(i for i in sets if sets[i])
    links = [(a, b) for a, b in itertools.combinations(ids, 2) if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    return sets, roots_of(sets, links)


def edited(rng, words, rate):
    return [rng.choice("uvwxyz") + str(rng.randint(0, 999)) if rng.random() < rate else w for w in words]


@pytest.mark.parametrize("seed", range(2))
def test_jaccard_components_match_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(jaccard, "FREQUENT_ROWS", 5)
    monkeypatch.setattr(jaccard, "CONFRONT_ROWS", 7)
    rng = random.Random(seed)
    rows, common = [], [f"c{k}" for k in range(12)]
    for family in range(8):
        base = [f"b{family}_{rng.randint(0, 500)}" for _ in range(rng.choice([6, 40, 120, 300]))]
        now = base
        for _ in range(14):  # near copies of the base, and chains in which each is near the one before
            now = edited(rng, now if family % 2 else base, rng.choice([0.0, 0.01, 0.02, 0.04]))
            rows.append((len(rows), " ".join(now + (common if rng.random() < 0.5 else []))))
    rows += [(900, None), (901, ""), (902, "One two"), (903, "one TWO"), (904, "two one"), (905, "a b c d e"), (906, "a  b\tc\nd e")]
    sets, roots = jaccard_truth(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(frame(spark, [*rows, rows[3]])).collect()}
    assert got == {i: (len(sets[i]), roots[i]) for i, _ in rows}
    assert len(set(roots.values())) < len(rows) - 40


def test_a_group_too_far_from_its_common_lead_has_one_of_its_own(spark, monkeypatch):
    """Shortened near copies, each further than RADIUS from the long ones that lead their keys: they do not all meet."""
    monkeypatch.setattr(jaccard, "LEADS", 1)
    rng = random.Random(8)
    base = [f"w{k}" for k in range(150)]

    def copy(n, edits):
        words = base[:n]
        for k in rng.sample(range(n), edits):
            words[k] = f"x{rng.random()}"
        return " ".join(words)

    rows = [(k, copy(150, 1)) for k in range(130)] + [(200 + k, copy(88, 2)) for k in range(50)]
    met, plain = [], jaccard._Join._met
    monkeypatch.setattr(jaccard._Join, "_met", lambda *a: met.append(plain(*a).checkpoint()) or met[-1])
    sets, roots = jaccard_truth(rows)
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_components(frame(spark, rows)).collect()}
    assert got == {i: roots[i] for i, _ in rows} and met[0].count() < 50 * 49 // 8


def test_jaccard_edges(spark):
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_components(frame(spark, [(None, "p q"), (4, "P q"), (7, "p Q"), (8, None)])).collect()}
    assert got == {None: 4, 4: 4, 7: 4, 8: 8}
    assert jaccard.jaccard_components(frame(spark, [(1, "a")]).filter("false")).count() == 0


def test_bounds_never_exceed_the_distance():
    rng = np.random.default_rng(1)
    for _ in range(200):
        pool = rng.integers(0, 1 << 63, 400).astype(np.uint64)
        a, b = np.unique(rng.choice(pool, rng.integers(1, 300))), np.unique(rng.choice(pool, rng.integers(1, 300)))
        apart = len(np.setxor1d(a, b))
        assert jaccard._bits_apart(jaccard._bitmap(a), jaccard._bitmap(b)) <= apart


@pytest.mark.parametrize("block", [3, 1500])
def test_embedding_links_match_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(embed, "BLOCK_ROWS", block)
    rng = np.random.default_rng(block)
    rows = []
    for _ in range(20):
        base = rng.normal(size=8)
        for _ in range(rng.integers(1, 8)):
            v = (base + rng.normal(size=8) * rng.choice([0, 0.05, 0.15])).astype(np.float32)
            rows.append((len(rows), v.tolist(), int(rng.integers(0, 2))))
    rows += [(500, rows[0][1], rows[0][2]), (501, [x * 2 for x in rows[0][1]], rows[0][2]), (502, None, 0), (503, [0.0] * 8, 0), (504, [float("nan")] * 8, 0), (505, [None] * 8, 0), (506, [1.0] * 3, 0), (507, [], 0), (508, rows[0][1], None), (509, [float("inf")] * 8, 0)]
    schema = "vec_id bigint, embedding array<float>, label int, cid string"
    df = spark.createDataFrame([(*r, "clash") for r in rows], schema)
    usable = [(i, np.array(v, np.float64), y) for i, v, y in rows if y is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    pairs = [(a[0], b[0]) for a, b in itertools.combinations(usable, 2) if a[2] == b[2] and len(a[1]) == len(b[1]) and a[1] @ b[1] / (np.linalg.norm(a[1]) * np.linalg.norm(b[1])) >= 0.98]
    roots = roots_of([r[0] for r in rows], pairs)
    links = collections.Counter(x for p in pairs for x in p)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embed.near_duplicates(df, cells=5).collect()}
    assert got == {i: (links[i], roots[i], roots[i] == i) for i, _, _ in rows} and len(pairs) > 20
    assert embed.near_duplicates(df.filter("false")).count() == 0


def test_licences_and_inheritance(spark):
    rows = [
        (1, "a/LICENSE", "Released under the MIT License.\nAll of it."), (2, "a/b/x.py", "code here\nnothing"), (3, "a/b/y.py", "# Licensed under the Apache License, Version 2.0.\nimport os\nprint(os.getcwd(), os.getpid(), os.name)\nprint(os.sep)"), (4, "c/z.py", "code"),
        (5, "a/b/d/COPYING", "This work is licensed under the GNU General Public License, version 3."), (6, "a/b/d/e/w", ""), (7, "a/v", None), (8, None, "x"), (9, "ab/q", "x"), (1, "a/LICENSE", "Released under the MIT License.\nAll of it."),
    ]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id bigint, path string, text string, license string")
    got = {r.doc_id: (r.license, r.origin) for r in licenses.scan_licenses(df, ["doc_id"]).collect()}
    assert got == {1: ("MIT", "file"), 2: ("MIT", "inherited"), 3: ("Apache-2.0", "header"), 4: (None, None), 5: ("GPL-3.0", "file"), 6: ("GPL-3.0", "inherited"), 7: ("MIT", "inherited"), 8: (None, None), 9: (None, None)}
    assert licenses.scan_licenses(df.filter("false"), ["doc_id"]).count() == 0


def test_licence_cosine_is_the_dense_one():
    t = licenses.Templates(1000, {w: 10 + k for k, w in enumerate(licenses.VOCABULARY)})
    words = licenses.words_of("Licensed under the Apache License version 2.0 or later, see elsewhere")
    every = sorted(set(words) | set(licenses.VOCABULARY))
    vector = lambda ws: np.array([ws.count(w) * t.idf.get(w, t.rare) for w in every])
    cosine = [vector(words) @ vector(licenses.words_of(x)) / np.linalg.norm(vector(words)) / np.linalg.norm(vector(licenses.words_of(x))) for _, x in licenses.TEMPLATES]
    score, best = t.best(words)
    assert best == int(np.argmax(cosine)) and abs(score - max(cosine)) < 1e-9


@pytest.mark.parametrize("copies", [1, 100])
def test_licence_weights_count_all_words_at_every_size(spark, copies):
    line = "Released under the MIT License; see each file for more details."
    # every word has the same share of the lines at both sizes
    rows = [(0, "a/0", line)] * copies + [(k, f"f{k}/x", "see each file for more details and so on\nother things") for k in range(1, 200 * copies)]
    df = spark.createDataFrame(rows, "doc_id bigint, path string, text string")
    got = licenses.scan_licenses(df, ["doc_id"]).filter("doc_id = 0").distinct().collect()
    assert [(r.license, r.n_statements) for r in got] == [("MIT", 1)]
    ls = [licenses.words_of(x) for _, _, text in rows for x in text.split("\n")]
    df_of = collections.Counter(w for words in ls for w in set(words))
    weigh = lambda ws: {w: ws.count(w) * (np.log((len(ls) + 1) / (df_of[w] + 1)) + 1) for w in ws}
    norm = lambda v: sum(x * x for x in v.values()) ** 0.5
    a, b = weigh(licenses.words_of(line)), weigh(licenses.words_of("Released under the MIT License."))
    assert abs(got[0].score - sum(x * b.get(w, 0) for w, x in a.items()) / norm(a) / norm(b)) < 1e-9


def license_truth(rows):
    """{row number: (license, score, origin)} by dense vectors of every unit and by a walk up the folders."""
    lines = [ws for _, _, t in rows for x in (t or "").split("\n") if (ws := licenses.words_of(x))]
    df_of = collections.Counter(w for ws in lines for w in set(ws))
    vector = lambda ws: {w: n * (np.log((len(lines) + 1) / (df_of[w] + 1)) + 1) for w, n in collections.Counter(ws).items()}
    norm = lambda v: sum(x * x for x in v.values()) ** 0.5
    templates = [(name, vector(licenses.words_of(text))) for name, text in licenses.TEMPLATES]
    own, speaks = {}, {}
    for k, (_, path, text) in enumerate(rows):
        found = [(licenses.LINE, x, len(licenses.words_of(m[0])), 1.0, m[1]) for x, line in enumerate((text or "").split("\n")) for m in licenses._TAG.finditer(line)]
        tagged = {x[1] for x in found}
        for level, line, words in licenses.units(text or ""):
            v = vector(words)
            cosine = [sum(x * y.get(w, 0.0) for w, x in v.items()) / norm(v) / norm(y) for _, y in templates]
            i = max(range(len(cosine)), key=lambda i: (round(cosine[i], 9), -i))
            if cosine[i] >= licenses.SIMILAR and not (level == licenses.LINE and line in tagged):
                found.append((level, line, len(words), cosine[i], templates[i][0]))
        best = max(found, key=lambda x: (x[0] if x[3] >= licenses.CLEAR else -1, round(x[3], 9), -x[1], x[4]), default=None)
        inside = collections.Counter()
        for level, _, n, _, _ in found:
            inside[level] += n
        speaks_up = best and (bool(re.search(licenses.FILE_NAME, path or "")) or max(inside.values()) >= licenses.LICENCE_SHARE * len(licenses.words_of(text or "")))
        own[k] = (best[4], best[3], "file" if speaks_up else "header") if best else (None, None, None)
        if speaks_up and path is not None:
            folder = path.rpartition("/")[0]
            speaks[folder] = min(speaks.get(folder, (0.0, "")), (-round(best[3], 9), best[4]))
    for k, (_, path, _) in enumerate(rows):
        folder = path.rpartition("/")[0] if path is not None and own[k][0] is None else None
        while folder is not None and folder not in speaks:
            folder = folder.rpartition("/")[0] if folder else None
        if folder is not None:
            own[k] = (speaks[folder][1], -speaks[folder][0], "inherited")
    return own


def wrapped(text, width, mark=""):
    return "\n".join(mark + x for part in text.split("\n") for x in textwrap.wrap(part, width))


BODY = {name: text for name, text in reversed(licenses.BODIES)}


def test_licence_scan_and_inheritance_by_brute_force(spark):
    rng = random.Random(8)
    code = ["import os", "x = the_value(of, it)", "# see the file for the rest.", "", "return a and b or c", "All rights reserved.", "/* Copyright (c) 2020 A. Author */"]
    rows = []
    for k in range(150):
        folder = "/".join(rng.choice("abc") for _ in range(rng.randint(0, 4)))
        name = rng.choice(["LICENSE", "x.py", "y.c", "COPYING.txt", "z"])
        lines = [rng.choice(code) for _ in range(rng.randint(0, 8))]
        if rng.random() < 0.35:
            text = rng.choice(licenses.TEMPLATES)[1]
            cut = text.split()
            text = text if rng.random() < 0.6 else " ".join(w for w in cut if rng.random() < 0.8)
            lines.insert(0, wrapped(text, rng.choice([40, 76, 5000]), rng.choice(["", "# ", " * "])))
        if rng.random() < 0.1:
            lines.append("// SPDX-License-Identifier: " + rng.choice(["Apache-2.0", "(MIT OR Apache-2.0)", "GPL-2.0-only WITH Classpath-exception-2.0"]))
        rows.append((k, None if rng.random() < 0.05 else f"{folder}/{name}".lstrip("/"), None if rng.random() < 0.05 else "\n".join(lines)))
    want = license_truth(rows)
    got = {r.doc_id: (r.license, r.score, r.origin) for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id bigint, path string, text string"), ["doc_id"]).collect()}
    assert {k: (x[0], x[2]) for k, x in got.items()} == {k: (x[0], x[2]) for k, x in want.items()}
    assert all(abs((got[k][1] or 0) - (want[k][1] or 0)) < 1e-6 for k in want)
    assert {x[2] for x in want.values()} == {"file", "header", "inherited", None}


def test_whole_wrapped_licences_and_tags(spark):
    rows = [(name, wrapped(text, 70, mark)) for name, text in BODY.items() for mark in ("", "# ", " * ")]
    rows = [(name, f"The title\n\nCopyright (c) 2024 A. Author\n{text}\n") for name, text in rows if len(text) > 300]
    rows += [("Apache-2.0 OR MIT", "// SPDX-License-Identifier: Apache-2.0 OR MIT\nint main() {}"), ("MIT", "/* SPDX-License-Identifier: MIT */"), (None, "word of the licence and as is " * 20_000), (None, "the and of\n" * 5_000)]
    df = spark.createDataFrame([(k, None, text) for k, (_, text) in enumerate(rows)], "doc_id bigint, path string, text string")
    got = {r.doc_id: r.license for r in licenses.scan_licenses(df, ["doc_id"]).collect()}
    assert got == {k: name for k, (name, _) in enumerate(rows)}


def test_pipeline_stages(spark):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names, now = docs.columns, docs
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, now, folder).cache()
        kept[name] = out
        if name == corpus_pipeline.STAGES[-1][0]:
            assert out.count() == now.count() and {"doc_id", "n_tokens", "ids"} <= set(out.columns)
        else:
            assert out.columns == names
            now = out
    before = {r.doc_id: r.text for r in kept["line dedup"].collect()}
    _, roots = jaccard_truth(list(before.items()))
    assert {r.doc_id for r in kept["n-gram Jaccard join"].collect()} == {i for i in before if roots[i] == i}
    low = {r.doc_id for r in spark.read.parquet(f"{folder}/labels.parquet").filter("quality = 0").collect()}
    good = {r.doc_id for r in spark.read.parquet(f"{folder}/labels.parquet").filter("quality = 1").collect()}
    passed = {r.doc_id for r in kept["quality classifier"].collect()}
    assert len(good - passed) <= 0.02 * len(good) and len(low & passed) <= 0.2 * len(low)
    assert {r.doc_id for r in corpus_pipeline.run(spark, folder).collect()} == {r.doc_id for r in kept["SentencePiece encoding"].collect()}


def test_clashing_names_long_texts_and_repeated_rows(spark):
    item = " ".join(f"i{k}" for k in range(12))
    long = " ".join(f"w{k % 977}" for k in range(20_000))
    rows = [(1, f"a {item} b"), (2, long), (3, "clean words"), (3, "clean words"), (4, None)]
    df = spark.createDataFrame([(i, t, "x", 1, 2, 3) for i, t in rows], "doc_id bigint, text string, hits string, doc int, body int, n_words int")
    bench = spark.createDataFrame([(7, item)], "item_id bigint, text string")
    kept = decontam.drop_contaminated(df, bench)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3, 3, 4]
    report = {(r.doc_id, r.n_words, r.n_hit) for r in decontam.contamination_report(df, bench).collect()}
    assert report == {(1, 14, 12), (2, 20_000, 0), (3, 2, 0), (4, 0, 0)}


def test_keep_one_of_each_group(spark):
    near = [f"n{k}" for k in range(60)]
    rows = [(5, " ".join(near)), (5, " ".join(near)), (9, " ".join([*near, "z"])), (2, "other words here"), (2, "apart from it"), (7, None), (7, None)]
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id bigint, text string, kept_id string, row_key string")
    out = jaccard.keep_one(df)
    assert out.columns == df.columns and sorted((r.doc_id, (r.text or "")[:5]) for r in out.collect()) == [(2, "apart"), (2, "other"), (5, "n0 n1"), (7, "")]
