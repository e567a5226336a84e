"""Token counts of whole texts under a byte-level BPE vocabulary.

Rank-synchronous array merging: the distinct pre-tokens of a batch are held as
ragged numpy arrays, every sequence's lowest-rank pair is merged in the same
round, and the symbols that survive are counted. No ids are made.

Defined results: a null text counts as an empty one (0 bytes, 0 tokens); an
empty text has 0 tokens; texts of any length are counted whole; repeated rows and
ties are counted row by row; an empty table gives an empty result; other columns
of the input are not read, so their names do not matter.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .merging import PairTable, merge_words, parts, space_words
from .shipping import ship

#: White space and the contraction endings of the byte-level split.
WHITE = "\t-\r \x85\xa0  -     　"
SPLIT = rf"'(?:s|t|re|ve|m|ll|d)| ?\p{{L}}+| ?\p{{N}}+| ?[^{WHITE}\p{{L}}\p{{N}}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"
_WHITE_CHARS = frozenset(c for c in map(chr, range(0x3001)) if re.match(f"[{WHITE}]", c))
#: Distinct pre-tokens kept with their counts in one Python worker, at most.
MEMO_WORDS = 500_000
_MEMO: dict[str, tuple[dict, dict]] = {}


def load_vocabulary(path: str) -> dict:
    """Merge table and special strings of a tokenizers .json file of kind byte-level BPE."""
    with open(path, encoding="utf-8") as f:
        raw = json.load(f)
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in raw["model"]["merges"]]
    # the printable stand-ins of bytes: visible Latin-1 characters stand for themselves, the others follow from 256 on
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    stand_in = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
    symbol = dict(stand_in)
    left, right, new = [], [], []
    for i, (a, b) in enumerate(merges):
        left.append(symbol[a]), right.append(symbol[b])
        symbol.setdefault(a + b, 256 + i)
        new.append(symbol[a + b])
    # a merged symbol can only enter later merges, unless it is also made by a later merge
    single = [n != 256 + i or max(l, r) >= 256 + i for i, (l, r, n) in enumerate(zip(left, right, new))]
    special = sorted((t["content"] for t in raw.get("added_tokens", [])), key=len, reverse=True)
    return {"key": (len(merges), merges[:1], merges[-1:], tuple(special)), "table": PairTable(left, right, range(len(merges)), new, single), "special": special}


def count_words(words: list[str], table: PairTable) -> np.ndarray:
    """Surviving symbols of each word (not empty)."""
    raw = [w.encode("utf-8") for w in words]
    lengths = np.fromiter(map(len, raw), np.int64, len(raw))
    return merge_words(np.frombuffer(b"".join(raw), np.uint8), lengths, table)[1]


def _split(vocabulary: dict):
    """Pre-tokens of a whole text, and how many special strings it holds."""
    import regex

    split = regex.compile(SPLIT).findall
    special = regex.compile("|".join(map(regex.escape, vocabulary["special"]))) if vocabulary["special"] else None

    def apart(text: str) -> tuple[list[str], int]:
        if special is None or not special.search(text):
            return split(text), 0
        pieces = special.split(text)
        return [w for piece in pieces for w in split(piece)], len(pieces) - 1

    return apart


def _count_lists(lists: list[list[str]], vocabulary: dict, memo: dict) -> list[int]:
    unknown = set().union(*lists) - memo.keys()
    if len(memo) + len(unknown) > MEMO_WORDS:
        memo.clear()
        unknown = set().union(*lists)
    if unknown:
        new = list(unknown)
        memo.update(zip(new, count_words(new, vocabulary["table"]).tolist()))
    get = memo.__getitem__
    return [sum(map(get, words)) for words in lists]


def _count_spaced(words: list[str], vocabulary: dict, memo: dict) -> list[int]:
    """Tokens of each word with a space before it. Words that don't end in white space can be split as one joined text,
    as a space after anything else always begins a pre-token."""
    if tails := [w for w in words if not w or w[-1] in _WHITE_CHARS]:
        apart, plain = _split(vocabulary), [w for w in words if w and w[-1] not in _WHITE_CHARS]
        count = dict(zip(plain, _count_spaced(plain, vocabulary, memo))) if plain else {}
        count.update(zip(tails, _count_lists([apart(" " + w)[0] for w in tails], vocabulary, memo)))
        return [count[w] for w in words]
    tokens = _split(vocabulary)("".join([" " + w for w in words]))[0]
    sizes = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)))
    distinct = list(set(tokens))
    place = dict(zip(distinct, range(len(distinct))))
    count = np.array(_count_lists([[w] for w in distinct], vocabulary, memo), np.int64)
    each = count[np.fromiter(map(place.__getitem__, tokens), np.int64, len(tokens))]
    return np.bincount(np.searchsorted(sizes, ends), weights=each, minlength=len(words)).astype(np.int64).tolist()


def count_texts(texts: pa.Array, vocabulary: dict) -> np.ndarray:
    """Tokens of each text. Texts whose single spaces all begin a pre-token are cut there first, so that the split and
    the merges run once for each distinct word of a part; the others are split as a whole."""
    memo, chunks = _MEMO.setdefault(repr(vocabulary["key"]), ({}, {}))
    apart = _split(vocabulary)
    joined = "|".join([rf"[{WHITE}] ", "^ ", " $", *map(re.escape, vocabulary["special"])])
    out = np.zeros(len(texts), np.int64)
    for begin, part in parts(texts):
        whole = pc.match_substring_regex(part, joined).to_numpy(zero_copy_only=False)
        slow = np.flatnonzero(whole)
        if len(slow):
            lists, special = zip(*(apart(text) for text in part.take(pa.array(slow)).to_pylist()))
            out[begin + slow] = np.array(_count_lists(list(lists), vocabulary, memo)) + np.array(special)
        part = pc.if_else(pa.array(whole), pa.scalar("", pa.large_string()), part)
        distinct, index, offsets = space_words(part)
        if new := [w for w in distinct if w not in chunks]:
            if len(chunks) + len(new) > MEMO_WORDS:
                chunks.clear()
                new = distinct
            chunks.update(zip(new, _count_spaced(new, vocabulary, memo)))
        size = np.fromiter(map(chunks.__getitem__, distinct), np.int64, len(distinct))
        total = np.concatenate([[0], np.cumsum(size[index])])
        first = index[offsets[:-1]]  # the first word of a text has no space before it
        heads, back = np.unique(first, return_inverse=True)
        head_size = np.array(_count_lists([apart(distinct[w])[0] for w in heads.tolist()], vocabulary, memo), np.int64)
        fast = total[offsets[1:]] - total[offsets[:-1]] - size[first] + head_size[back]
        out[begin : begin + len(part)] += np.where(whole, 0, fast)
    return out


def token_counts(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row; one narrow pass, no shuffle.

    The merge table (fixed by the vocabulary file, about 3 MB) is read by the driver and broadcast."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(load_vocabulary(vocabulary_path))

    def count(batches):
        vocabulary = shared.value
        for batch in batches:
            tokens = count_texts(batch.column(1), vocabulary)
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, pa.array(tokens), pa.array(tokens > limit)], names=["id", "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema[id_col].dataType.simpleString()
    got = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(count, f"id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
    return got.withColumnRenamed("id", id_col)
