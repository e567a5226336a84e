"""Exact Jaccard self-join of word-shingle sets, as links between class representatives and connected components.

Set-relation skipping. Documents with equal sets form a class; one set stands for
it. Only the leading block of a set, its rarest shingles in one global order, is ever
listed, and two linked sets always meet in it, several times if they are large.
Entries of a list carry set sizes, and those whose sizes rule a link out are skipped;
lists are not blocked by position, as an entry stands for many sets. Answers are
derived from a highly similar set: sets near an anchor set are listed under it, and the
distance between two anchors, with the triangle inequality of the Jaccard distance,
settles most pairs of their followers without comparing them. Pairs that remain open
are compared set by set, so no link between different components is lost.

1. One pass over the texts: class key, set size, min-hash keys, a parity bitmap of
   the set, and the shingles that are frequent within the part at hand.
2. A set is compared with the sets that lead most of its min-hash keys. It follows the
   nearest of those that have no near lead themselves, linked with it or not, if that is
   within RADIUS; what is left has a second round among itself. Classes under one anchor that are not in one
   component are confronted in blocks.
3. Second pass, over the representatives only: the leading block of each class in the
   order (frequent shingles last, hash). Shingle lists are dealt in buckets; sets under
   one anchor are one entry, equal lists are kept once with their number.
4. Pairs of anchors that meet often enough get a least distance from sizes and bitmaps;
   those that may be linked are compared, and those whose followers may be linked are
   taken apart follower by follower, by the same bounds, until the components are settled.
5. Components over all links found.

Defined results: a null or wordless text has an empty set, links with nothing and
is its own component; fewer words than a shingle make one shingle; texts of any
length count whole; rows with a null id take part, but never name a component
unless all its ids are null; repeated rows are one class; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components, merged_components
from .merging import parts, space_words
from .shipping import checkpointed, compact, quoted, ship, unused

SHINGLE = 5
#: Links: 100 * intersection >= PERCENT * union.
PERCENT = 75
BANDS = 16
#: Parity bitmaps have the next power of two from so many bits an element on.
BITMAP_RATE = 4
#: Shingles are counted so many together; those that occur in COUNT_LEAST sets among them are reported. A shingle is
#: frequent from FREQUENT_ROWS reported sets on; of frequent ones the FREQUENT_MAX most reported are put last. The order
#: changes the cost, never the result.
COUNT_SHINGLES, COUNT_LEAST, FREQUENT_ROWS, FREQUENT_MAX = 1_000_000, 2, 20, 1_000_000
#: Text cut into words at a time, and listed shingles held before they are dealt.
TEXT_BYTES, DEAL_SHINGLES = 4_000_000, 400_000
#: Listed shingles of one bucket, about.
BUCKET_ROWS = 300_000
#: Classes of a block in the comparison of followers, about.
CONFRONT_ROWS = 500
#: Leads that a class is compared with, and the distance up to which it follows one.
LEADS, RADIUS = 4, 0.5
#: Rounds in which classes look for a lead.
ROUNDS = 2
#: Ids of wanted texts are broadcast up to this many (some 30 MB); beyond it they are joined by a shuffle.
BROADCAST_IDS = 500_000
_SEEDS = [np.uint64((0x9E3779B97F4A7C15 * (2 * i + 1)) % (1 << 64)) for i in range(BANDS)]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingle_sets(texts: pa.Array):
    """Yields the sorted 64-bit shingle hashes of each text. Sets of equal hashes count as equal."""
    import xxhash

    for _, part in parts(texts, TEXT_BYTES):
        part = pc.replace_substring_regex(pc.ascii_lower(part), "[\t-\r]", " ")
        distinct, index, offsets = space_words(part)
        word = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in distinct), np.uint64, len(distinct))
        there = np.array([w != "" for w in distinct], bool)[index]
        ends = np.concatenate([[0], np.cumsum(there)])[offsets]
        word = word[index[there]]
        n = len(word) - SHINGLE + 1
        rolled = np.zeros(max(n, 0), np.uint64)
        for k in range(SHINGLE):
            rolled = _mix(rolled + word[k : n + k]) if n > 0 else rolled
        for begin, end in zip(ends[:-1].tolist(), ends[1:].tolist()):
            if end - begin >= SHINGLE:
                yield np.unique(rolled[begin : end - SHINGLE + 1])
            elif end > begin:
                h = np.array([end - begin], np.uint64)
                for k in range(begin, end):
                    h = _mix(h * _SEEDS[0] + word[k : k + 1])
                yield h
            else:
                yield np.zeros(0, np.uint64)
        del part, word, rolled, index, distinct, there
        pa.default_memory_pool().release_unused()


def _class_key(s: np.ndarray) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)


def _bitmap(s: np.ndarray) -> bytes:
    """Parity bitmap: two sets differ in at least as many elements as their bitmaps, folded to one size, in bits."""
    bits = 64
    while bits < BITMAP_RATE * len(s):
        bits *= 2
    at = (_mix(s) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=bits).astype(np.uint8) & 1, bitorder="little").tobytes()


def _bits_apart(x: bytes, y: bytes) -> int:
    a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    n = min(len(a), len(b))
    a, b = np.bitwise_xor.reduce(a.reshape(-1, n), axis=0), np.bitwise_xor.reduce(b.reshape(-1, n), axis=0)
    return int(np.bitwise_count(a ^ b).sum())


def shared_least(n):
    """Listed shingles that a set of n shares with every linked set that asks for as many."""
    return 1 + n // 16


def prefix_size(n):
    """Leading elements of a set of n of which every linked set has shared_least in its own leading block (or as many
    as it asks for itself, if that is fewer)."""
    return n - (PERCENT * n + 99) // 100 + shared_least(n)


_PROFILE = "id {}, cid bigint, n int, keys array<bigint>, bitmap binary, token bigint, times int"


def _profile(batches):
    """A row for each document, and rows (token, times) for shingles that occur often among COUNT_SHINGLES of them."""
    held: list[np.ndarray] = []
    count = 0

    def frequent(kind):
        token, times = np.unique(np.concatenate(held), return_counts=True)
        token, times = token[times >= COUNT_LEAST], times[times >= COUNT_LEAST]
        nulls = lambda t: pa.nulls(len(token), t)
        return pa.RecordBatch.from_arrays([nulls(kind), nulls(pa.int64()), nulls(pa.int32()), nulls(pa.list_(pa.int64())), nulls(pa.binary()), pa.array(token.view(np.int64)), pa.array(times.astype(np.int32))], names=names)

    names = ["id", "cid", "n", "keys", "bitmap", "token", "times"]
    kind = None
    for batch in batches:
        kind = batch.column(0).type
        cid, n, keys, bitmap = [], [], [], []
        for s in shingle_sets(batch.column(1)):
            cid.append(_class_key(s) if len(s) else None)
            n.append(len(s))
            keys.append([int((s * seed).min().view(np.int64)) for seed in _SEEDS] if len(s) else None)
            bitmap.append(_bitmap(s) if len(s) else None)
            held.append(s)
            count += len(s)
        nulls = lambda t: pa.nulls(len(n), t)  # noqa: E731, B023
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cid, pa.int64()), pa.array(n, pa.int32()), pa.array(keys, pa.list_(pa.int64())), pa.array(bitmap, pa.binary()), nulls(pa.int64()), nulls(pa.int32())], names=names)
        if count >= COUNT_SHINGLES:
            yield frequent(kind)
            held, count = [], 0
    if count:
        yield frequent(kind)


def _leading(s: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The leading block of a set: its rarest elements, those listed as frequent last."""
    at = np.minimum(np.searchsorted(frequent, s), max(len(frequent) - 1, 0))
    late = frequent[at] == s if len(frequent) else np.zeros(len(s), bool)
    return np.concatenate([s[~late], s[late]])[: prefix_size(len(s))]


def _sets(batches):
    for batch in batches:
        cid, sets = [], []
        for s in shingle_sets(batch.column(1)):
            cid.append(_class_key(s) if len(s) else None)
            sets.append(s.tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(cid, pa.int64()), pa.array(sets, pa.binary())], names=["cid", "tokens"])


def _rank(n) -> np.ndarray:
    """Sizes on a scale of 5 %, rounded down."""
    return np.minimum(np.log(np.asarray(n, np.float64)) / np.log(1.05) + 1e-9, 65535).astype(np.uint16)


#: Two sets are not linked if their ranks are so many apart: 1.05 ** (RANKS - 1) is more than 100 / PERCENT.
RANKS = 2 + int(np.log(100 / PERCENT) / np.log(1.05))
_ENTRY = np.dtype([("anchor", np.int64), ("low", np.uint16), ("high", np.uint16)])


def _deal(frequent: np.ndarray, buckets: int):
    """(text, class key, anchor, least and greatest size under it) to (bucket, shingles, entries): each (shingle, anchor) of the leading blocks once per flush."""

    def flush(tokens, entries):
        token, entry = np.concatenate(tokens), np.concatenate(entries)
        bucket = (_mix(token) % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((entry["anchor"], token, bucket))
        token, entry, bucket = token[order], entry[order], bucket[order]
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (entry["anchor"][1:] != entry["anchor"][:-1])
        token, entry, bucket = token[new], entry[new], bucket[new]
        cut = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]])
        each = list(zip(cut[:-1].tolist(), cut[1:].tolist()))
        return pa.RecordBatch.from_arrays([pa.array(bucket[cut[:-1]]), pa.array([token[a:b].tobytes() for a, b in each], pa.binary()), pa.array([entry[a:b].tobytes() for a, b in each], pa.binary())], names=["bucket", "tokens", "entries"])

    def deal(batches):
        tokens, entries, held = [], [], 0
        for batch in batches:
            stands = np.zeros(batch.num_rows, _ENTRY)
            stands["anchor"], stands["low"], stands["high"] = batch.column(2).to_numpy(), _rank(batch.column(3).to_numpy()), _rank(batch.column(4).to_numpy())
            for k, (s, key) in enumerate(zip(shingle_sets(batch.column(0)), batch.column(1).to_pylist())):
                if not len(s) or _class_key(s) != key:  # another text with the same id
                    continue
                one = _leading(s, frequent)
                tokens.append(one), entries.append(np.repeat(stands[k : k + 1], len(one)))
                held += len(one)
                if held >= DEAL_SHINGLES:
                    yield flush(tokens, entries)
                    tokens, entries, held = [], [], 0
        if held:
            yield flush(tokens, entries)

    return deal


def _lists(buckets: int):
    """The lists of a bucket that hold two anchors or more, equal ones once with their number, dealt anew by their first anchor."""

    def lists(table: pa.Table) -> pa.Table:
        token = np.concatenate([np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("tokens")])
        entry = np.concatenate([np.frombuffer(x.as_buffer(), _ENTRY) for x in table.column("entries")])
        order = np.argsort(token, kind="stable")
        token, entry = token[order], entry[order]
        start = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        several = np.repeat(np.diff(np.concatenate([start, [len(token)]])) > 1, np.diff(np.concatenate([start, [len(token)]])))
        token, entry = token[several], entry[several]
        order = np.lexsort((entry["anchor"], token))
        token, entry = token[order], entry[order]
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (entry["anchor"][1:] != entry["anchor"][:-1])
        token, entry = token[new], entry[new]
        cut = np.concatenate([np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]])), [len(token)]]) if len(token) else np.zeros(1, np.int64)
        times: dict[bytes, int] = {}
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
            if b - a > 1:
                key = entry[a:b].tobytes()
                times[key] = times.get(key, 0) + 1
        dealt: dict[int, list[bytes]] = {}
        for key in times:
            first = np.frombuffer(key[:8], np.uint64)
            dealt.setdefault(int(_mix(first)[0] % np.uint64(buckets)), []).append(key)
        size = _ENTRY.itemsize
        rows = [(bucket, b"".join(keys), np.array([(len(k) // size, times[k]) for k in keys], np.int64).tobytes()) for bucket, keys in dealt.items()]
        return pa.table({"bucket": pa.array([x[0] for x in rows], pa.int64()), "entries": pa.array([x[1] for x in rows], pa.binary()), "sizes": pa.array([x[2] for x in rows], pa.binary())})

    return lists


def _meet(table: pa.Table) -> pa.Table:
    """Pairs of anchors that share lists of this bucket and whose sizes allow a link, and how many lists they share."""
    entry = np.concatenate([np.frombuffer(x.as_buffer(), _ENTRY) for x in table.column("entries")])
    sizes = np.concatenate([np.frombuffer(x.as_buffer(), np.int64).reshape(-1, 2) for x in table.column("sizes")])
    size, weight = sizes[:, 0], sizes[:, 1]
    start = np.cumsum(size) - size
    dtype = np.dtype([("a", np.int64), ("b", np.int64)])
    found, times = np.zeros(0, dtype), np.zeros(0, np.int64)
    waiting: list[np.ndarray] = []
    weights: list[np.ndarray] = []
    held = 0

    def merged():
        every, place = np.unique(np.concatenate([found, *waiting]), return_inverse=True)
        return every, np.bincount(place, weights=np.concatenate([times, *weights]), minlength=len(every)).astype(np.int64)

    for m in np.unique(size).tolist():
        some = np.flatnonzero(size == m)
        lists = entry[start[some][:, None] + np.arange(m)]
        low, high = lists["low"].astype(np.int64), lists["high"].astype(np.int64)
        for i in range(m - 1):  # anchors are sorted within a list, so a < b
            fits = (low[:, i : i + 1] - high[:, i + 1 :] < RANKS) & (low[:, i + 1 :] - high[:, i : i + 1] < RANKS)
            row, at = np.nonzero(fits)
            pairs = np.empty(len(row), dtype)
            pairs["a"], pairs["b"] = lists["anchor"][row, i], lists["anchor"][row, i + 1 + at]
            waiting.append(pairs), weights.append(weight[some][row])
            held += len(pairs)
            if held > 1_000_000:
                found, times = merged()
                waiting, weights, held = [], [], 0
    found, times = merged()
    return pa.table({"a": pa.array(found["a"].copy()), "b": pa.array(found["b"].copy()), "times": pa.array(times)})


def _bounded(batches):
    """Pairs with the least distance that their sizes and bitmaps allow, where it is no more than ``reach``."""
    for batch in batches:
        x = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        n, m, reach = (x[k].to_numpy(zero_copy_only=False).astype(np.float64) for k in ("n_a", "n_b", "reach"))
        bits = np.array([_bits_apart(p, q) for p, q in zip(x["bitmap_a"].to_pylist(), x["bitmap_b"].to_pylist())], np.float64)
        apart = np.maximum(bits, np.abs(n - m))  # least size of the symmetric difference; the union is (n + m + apart) / 2
        low = 2 * apart / (n + m + apart)
        yield pa.RecordBatch.from_arrays([x["a"], x["b"], pa.array(low)], names=["a", "b", "low"]).filter(pa.array(low <= reach + 1e-9))


def _folded(bitmaps: list[bytes], words: int) -> np.ndarray:
    return np.stack([np.bitwise_xor.reduce(np.frombuffer(x, np.uint64).reshape(-1, words), axis=0) for x in bitmaps])


def _confronted(nearest: bool):
    def confronted(table: pa.Table) -> pa.Table:
        """Pairs of a left and a right class of one block, in different components, that may be linked; of each left class the nearest only, if so asked."""
        side, cid, n, root = (table.column(c).to_numpy() for c in ("side", "cid", "n", "root"))
        bitmap = table.column("bitmap").to_pylist()
        words = np.array([len(x) // 8 for x in bitmap])
        out: list[tuple[np.ndarray, ...]] = []
        for u in np.unique(words[side == 0]).tolist():
            for v in np.unique(words[side == 1]).tolist():
                left, right = np.flatnonzero((side == 0) & (words == u)), np.flatnonzero((side == 1) & (words == v))
                x, y = _folded([bitmap[k] for k in left], min(u, v)), _folded([bitmap[k] for k in right], min(u, v))
                step = max(1, 1_000_000 // (len(right) * min(u, v)))
                for begin in range(0, len(left), step):
                    some = left[begin : begin + step]
                    bits = np.bitwise_count(x[begin : begin + step, None] ^ y[None]).sum(axis=2, dtype=np.int64)
                    both = n[some][:, None].astype(np.float64) + n[right][None]
                    apart = np.maximum(bits, np.abs(n[some][:, None].astype(np.int64) - n[right][None]))
                    low = np.where(root[some][:, None] != root[right][None], 2 * apart / (both + apart), 2.0)
                    if nearest:
                        i, j = np.arange(len(some)), low.argmin(axis=1)
                        i, j = i[low[i, j] <= EDGE + 1e-9], j[low[i, j] <= EDGE + 1e-9]
                    else:
                        i, j = np.nonzero(low <= EDGE + 1e-9)
                    out.append((cid[some[i]], cid[right[j]]))
        p, q = (np.concatenate(c) for c in zip(*out)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        return pa.table({"a": pa.array(np.minimum(p, q)), "b": pa.array(np.maximum(p, q))})

    return confronted


def _compared(batches):
    for batch in batches:
        shared = []
        for s, t in zip(batch.column(2), batch.column(3)):
            both = np.concatenate([np.frombuffer(s.as_buffer(), np.uint64), np.frombuffer(t.as_buffer(), np.uint64)])
            both.sort()
            shared.append((int((both[1:] == both[:-1]).sum()), len(both)))
        inter = np.array([x[0] for x in shared], np.int64)
        union = np.array([x[1] for x in shared], np.int64) - inter
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(inter), pa.array(union)], names=["a", "b", "inter", "uni"])


_LINKED = f"100 * inter >= {PERCENT} * uni"


#: Distance of linked sets, at most.
EDGE = 1 - PERCENT / 100


class _Join:
    def __init__(self, docs: DataFrame, id_col: str, text_col: str):
        ship(docs.sparkSession)
        self.texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
        self.kind = docs.schema[id_col].dataType.simpleString()
        self.spark = docs.sparkSession

    def run(self) -> tuple[DataFrame, DataFrame]:
        """(profile of every row, links between classes)."""
        profile = checkpointed(self.texts.mapInArrow(_profile, _PROFILE.format(self.kind)))
        rows = profile.filter("token IS NULL").select("id", "cid", "n")
        classes = profile.filter("cid IS NOT NULL").groupBy("cid").agg(F.min("id").alias("id"), F.min("n").alias("n"), F.first("keys").alias("keys"), F.first("bitmap").alias("bitmap"))
        self.classes = checkpointed(classes)
        self.few = self.classes.count() <= BROADCAST_IDS
        counted = profile.filter("token IS NOT NULL").groupBy("token").agg(F.sum("times").alias("times")).filter(F.col("times") >= FREQUENT_ROWS)
        often = counted.orderBy(F.desc("times"), "token").limit(FREQUENT_MAX).select("token").toArrow()  # 8 MB at most
        frequent = np.sort(often.column(0).to_numpy().astype(np.int64).view(np.uint64)) if often.num_rows else np.zeros(0, np.uint64)

        near, follows = self._anchored()
        links = near.filter("linked").select("a", "b")
        # classes under one anchor: the nearest candidates first, as what they link need not be compared any more
        first = self._within(follows, None)
        roots = compact(connected_components(links.unionByName(first)))
        roots = merged_components(roots, self._within(follows, roots))
        radius = follows.groupBy("anchor").agg(F.max("far").alias("radius"))
        sides = [radius.select(F.col("anchor").alias(s), F.col("radius").alias(f"r_{s}")) for s in ("a", "b")]
        met = self._met(self.classes.join(follows, "cid", "left").select("cid", "id", "n", F.coalesce("anchor", "cid").alias("anchor")), frequent)
        met = met.join(sides[0], "a", "left").join(sides[1], "b", "left").select("a", "b", (F.lit(EDGE) + F.coalesce("r_a", F.lit(0.0)) + F.coalesce("r_b", F.lit(0.0))).alias("reach"))
        near = self.bounded(met)
        roots = merged_components(roots, self.linked(near.filter(F.col("low") <= EDGE + 1e-9)))
        # pairs with followers on either side
        open_pairs = near.join(sides[0], "a", "left").join(sides[1], "b", "left").filter("r_a IS NOT NULL OR r_b IS NOT NULL").fillna(0.0, ["r_a", "r_b"])
        return rows, self._followers(compact(open_pairs), follows, roots)

    def _near(self, pairs: DataFrame) -> DataFrame:
        """(a, b, far, linked) of the pairs (a, b, reach) that are within RADIUS."""
        compared = self.compare(self.bounded(pairs))
        return compact(compared.select("a", "b", (1 - F.col("inter") / F.col("uni")).alias("far"), F.expr(_LINKED).alias("linked")).filter(F.col("far") <= RADIUS))

    def _anchored(self) -> tuple[DataFrame, DataFrame]:
        """(a: lead, b, far, linked) of the classes and their leads that are within RADIUS, and (cid, anchor, far): each class
        with the nearest of its leads that has no near lead itself. Those that share keys with a lead, but follow none and
        lead none, have another round among themselves: else each of a large group that its common lead is just too far
        from would be an anchor, and would meet all others of the group."""
        among, near, follows = self.classes, None, None
        for k in range(ROUNDS):
            pairs = compact(self._leads(among))
            found = self._near(pairs)
            free = found.join(found.select(F.col("b").alias("a")).distinct(), "a", "left_anti")
            new = compact(free.groupBy(F.col("b").alias("cid")).agg(F.min(F.struct("far", "a")).alias("x")).select("cid", F.col("x.a").alias("anchor"), F.col("x.far").alias("far")))
            near, follows = (found, new) if near is None else (compact(near.unionByName(found)), compact(follows.unionByName(new)))
            if k + 1 < ROUNDS:
                taken = new.select("cid").unionByName(new.select(F.col("anchor").alias("cid"))).distinct()
                shared = pairs.select(F.col("b").alias("cid")).distinct()
                among = checkpointed(among.select("cid", "keys").join(shared, "cid", "left_semi").join(taken, "cid", "left_anti"))
        return near, follows

    def _within(self, follows: DataFrame, roots: DataFrame | None) -> DataFrame:
        """Links between classes under one anchor that have different roots; without ``roots`` only to the nearest ones that are not linked to the anchor."""
        members = follows.select(F.col("anchor").alias("key"), "cid", F.when(F.col("far") <= EDGE, F.col("anchor")).otherwise(F.col("cid")).alias("root"))
        members = members.unionByName(follows.select(F.col("anchor").alias("key"), F.col("anchor").alias("cid"), F.col("anchor").alias("root")).distinct())
        placed = members if roots is None else self._rooted(members.select("key", "cid"), roots)
        parted = placed.groupBy("key").agg(F.min("root").alias("least"), F.max("root").alias("most")).filter("least < most").select("key")
        placed = compact(placed.join(parted, "key"))
        return self._confront(placed, placed, same=True, nearest=roots is None)

    def _rooted(self, members: DataFrame, roots: DataFrame) -> DataFrame:
        return members.join(roots.withColumnRenamed("node", "cid"), "cid", "left").select("key", "cid", F.coalesce("root", "cid").alias("root"))

    def _leads(self, among: DataFrame) -> DataFrame:
        """Each class with the LEADS that lead the most of its keys. A key is led by the class, among those with it, whose own keys are the most common."""
        keyed = among.select("cid", F.posexplode("keys").alias("band", "key"))
        common = keyed.groupBy("band", "key").agg(F.count("*").alias("times")).filter("times > 1")
        shared = checkpointed(keyed.join(common, ["band", "key"]))
        score = shared.groupBy("cid").agg(F.sum("times").alias("score"))
        scored = shared.join(score, "cid")
        lead = scored.groupBy("band", "key").agg(F.max(F.struct("score", "cid")).alias("lead"))
        votes = shared.select("cid", "band", "key").join(lead, ["band", "key"]).groupBy("cid", "lead").agg(F.count("*").alias("votes"))
        best = votes.filter("lead.cid <> cid").groupBy("cid").agg(F.slice(F.sort_array(F.collect_list(F.struct("votes", "lead")), asc=False), 1, LEADS).alias("best"))  # one for each key at most
        return best.select(F.col("cid").alias("b"), F.explode("best").alias("best")).select(F.col("best.lead.cid").alias("a"), "b", F.lit(RADIUS).alias("reach"))

    def _met(self, listed: DataFrame, frequent: np.ndarray) -> DataFrame:
        entries = self.classes.agg(F.sum(F.expr(f"n - ({PERCENT} * n + 99) div 100 + 1 + n div 16"))).first()[0] or 0
        # an anchor stands for its followers: for all sizes among them, and it asks for as few shared shingles as any of them
        stands = checkpointed(listed.groupBy("anchor").agg(F.min("n").alias("low"), F.max("n").alias("high")))
        own = listed.join(stands, "anchor").select(F.col("id").alias("rep"), F.col("cid").alias("key"), "anchor", "low", "high")
        own = F.broadcast(own) if self.few else own
        texts = self.texts.join(own, self.texts["id"].eqNullSafe(own["rep"])).select("text", "key", "anchor", "low", "high")
        buckets = max(int(entries // BUCKET_ROWS) + 1, 24)
        dealt = texts.mapInArrow(_deal(frequent, buckets), "bucket bigint, tokens binary, entries binary")
        lists = checkpointed(dealt.groupBy("bucket").applyInArrow(_lists(buckets), "bucket bigint, entries binary, sizes binary"))
        shared = lists.groupBy("bucket").applyInArrow(_meet, "a bigint, b bigint, times bigint").groupBy("a", "b").agg(F.sum("times").alias("times"))
        for side in ("a", "b"):
            shared = shared.join(stands.select(F.col("anchor").alias(side), F.expr("1 + low div 16").alias(f"asked_{side}")), side)
        return shared.filter(F.col("times") >= F.least("asked_a", "asked_b")).select("a", "b")

    def bounded(self, pairs: DataFrame) -> DataFrame:
        """(a, b, low): pairs (a, b, reach) whose least distance is within reach."""
        of = lambda side: self.classes.select(F.col("cid").alias(side), F.col("n").alias(f"n_{side}"), F.col("bitmap").alias(f"bitmap_{side}"))
        joined = pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "n_a", "n_b", "bitmap_a", "bitmap_b", "reach")
        return compact(joined.mapInArrow(_bounded, "a bigint, b bigint, low double"))

    def linked(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that are linked."""
        return compact(self.compare(pairs).filter(_LINKED).select("a", "b"))

    def compare(self, pairs: DataFrame) -> DataFrame:
        """(a, b, inter, uni) of checkpointed pairs (a, b). The sets are made again from the texts of the classes in question."""
        if pairs.isEmpty():
            return pairs.select("a", "b", F.lit(0).cast("long").alias("inter"), F.lit(1).cast("long").alias("uni"))
        wanted = pairs.select(F.col("a").alias("cid")).unionByName(pairs.select(F.col("b").alias("cid"))).distinct()
        ids = compact(wanted.join(self.classes, "cid").select(F.col("id").alias("rep")).distinct())
        ids = F.broadcast(ids) if self.few or ids.count() <= BROADCAST_IDS else ids
        texts = self.texts.join(ids, self.texts["id"].eqNullSafe(ids["rep"]), "left_semi")
        sets = checkpointed(texts.select("id", "text").mapInArrow(_sets, "cid bigint, tokens binary").filter("cid IS NOT NULL"))
        of = lambda side: sets.select(F.col("cid").alias(side), F.col("tokens").alias(f"tokens_{side}"))
        joined = pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "tokens_a", "tokens_b")
        return compact(joined.mapInArrow(_compared, "a bigint, b bigint, inter bigint, uni bigint"))

    def _followers(self, open_pairs: DataFrame, follows: DataFrame, roots: DataFrame) -> DataFrame:
        """``roots`` with the links between followers of two anchors (a, b, low, r_a, r_b) that are too near to rule it out."""
        apart = self._apart(open_pairs, follows, roots)
        if apart.isEmpty():
            return roots
        of = follows.select(F.col("anchor").alias("key"), F.col("cid"))
        # followers of one side and the other anchor
        both = apart.select(F.col("a").alias("key"), F.col("b").alias("cid"), "r_a", "r_b").unionByName(apart.select(F.col("b").alias("key"), F.col("a").alias("cid"), F.col("r_b").alias("r_a"), F.col("r_a").alias("r_b")))
        roots = merged_components(roots, self._confront(self._rooted(of, roots), self._rooted(both.filter("r_a > 0").select("key", "cid"), roots)))
        apart = self._apart(apart.filter("r_a > 0 AND r_b > 0"), follows, roots)
        if apart.isEmpty():
            return roots
        # followers and followers
        pair = apart.select(F.xxhash64("a", "b").alias("pair"), "a", "b")
        left = pair.join(of, F.col("a") == F.col("key")).select(F.col("pair").alias("key"), "cid")
        right = pair.join(of, F.col("b") == F.col("key")).select(F.col("pair").alias("key"), "cid")
        return merged_components(roots, self._confront(self._rooted(left, roots), self._rooted(right, roots)))

    def _confront(self, left: DataFrame, right: DataFrame, same: bool = False, nearest: bool = False) -> DataFrame:
        """Links (a, b) between the left and right classes (key, cid, root) of each key that have different roots. The classes
        of a key are cut into blocks; a task bounds the pairs of two blocks in memory and only returns those that may be
        linked. With ``same``, left and right are the same classes, and two blocks meet once."""
        sketch = self.classes.select("cid", "n", "bitmap")
        sizes = lambda df, name: df.groupBy("key").agg(F.ceil(F.count("*") / CONFRONT_ROWS).cast("int").alias(name))
        blocks = compact(sizes(left, "ni").join(sizes(right, "nj"), "key"))
        hashed = F.xxhash64("cid")
        rows = lambda df, side, own, i, j: df.join(blocks, "key").join(sketch, "cid").withColumn("own", own).select("key", i.alias("i"), j.alias("j"), F.lit(side).alias("side"), "cid", "n", "root", "bitmap")
        up = lambda first, last: F.explode(F.sequence(first, last))
        own, zero = F.col("own"), F.lit(0)
        dealt = rows(left, 0, F.pmod(hashed, F.col("ni")).cast("int"), own, up(own if same else zero, F.col("nj") - 1)).unionByName(rows(right, 1, F.pmod(hashed, F.col("nj")).cast("int"), up(zero, own if same else F.col("ni") - 1), own))
        near = compact(dealt.groupBy("key", "i", "j").applyInArrow(_confronted(nearest), "a bigint, b bigint").distinct())
        return self.linked(near)

    def _apart(self, pairs: DataFrame, follows: DataFrame, roots: DataFrame) -> DataFrame:
        """Pairs of anchors (a, b) that do not stand for one and the same component already, with all their followers."""
        if pairs.isEmpty():
            return pairs
        members = follows.select(F.col("anchor").alias("key"), "cid").unionByName(follows.select(F.col("anchor").alias("key"), F.col("anchor").alias("cid")).distinct())
        spans = self._rooted(members, roots).groupBy("key").agg(F.min("root").alias("least"), F.max("root").alias("most"))
        single = roots.withColumnRenamed("root", "own")
        for side in ("a", "b"):
            pairs = pairs.join(spans.select(F.col("key").alias(side), F.col("least").alias(f"least_{side}"), F.col("most").alias(f"most_{side}")), side, "left")
            pairs = pairs.join(single.select(F.col("node").alias(side), F.col("own").alias(f"own_{side}")), side, "left")
        ends = [F.coalesce(f"{end}_{side}", f"own_{side}", side) for end in ("least", "most") for side in ("a", "b")]
        return compact(pairs.filter(F.least(*ends) < F.greatest(*ends)).select("a", "b", "low", "r_a", "r_b"))


def jaccard_roots(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(id, cid, n of every row; node, root of the class keys that are linked with others)."""
    return _Join(docs, id_col, text_col).run()


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) of every row."""
    rows, roots = jaccard_roots(docs, id_col, text_col)
    placed = rows.join(roots.withColumnRenamed("node", "cid"), "cid", "left").withColumn("group", F.coalesce("root", "cid"))
    placed = checkpointed(placed)
    first = placed.filter("group IS NOT NULL").groupBy("group").agg(F.min("id").alias("component_id"))
    named = placed.join(first, "group", "left")
    return named.select(F.col("id").alias(id_col), F.col("n").cast("long").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest id, and of several texts with that id the
    one with the smallest hash. Rows with the same id and text are one document and become one row; texts without words
    are components of their own; a null id comes first. Other columns stay as they are, whatever their names."""
    key = unused(docs, "row_key")
    keyed = docs.withColumn(key, F.struct(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("body")))
    placed = checkpointed(jaccard_components(keyed.select(key, F.col(text_col).alias("text")), key, "text").select(F.col(key).alias("at"), F.col("component_id").alias("of")))
    gone = placed.filter(~F.col("at").eqNullSafe(F.col("of"))).select("at").distinct()
    kept = keyed.join(F.broadcast(gone) if gone.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS else gone, F.col(key).eqNullSafe(F.col("at")), "left_anti")
    again = checkpointed(placed.filter(F.col("at").eqNullSafe(F.col("of"))).groupBy("at").agg(F.count("*").alias("times")).filter("times > 1").select("at"))
    if not again.isEmpty():  # rows that are repeated are few, so that only they are dealt by key
        repeated = F.col(key).eqNullSafe(F.col("at"))
        kept = kept.join(again, repeated, "left_anti").unionByName(kept.join(again, repeated, "left_semi").dropDuplicates([key]))
    return kept.select(*map(quoted, docs.columns))
