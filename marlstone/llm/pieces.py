"""SentencePiece BPE encoding and decoding in vectorised merge rounds.

The text, with a dummy space in front and spaces written as U+2581, is cut where
no piece of the vocabulary can reach across; the distinct words of a batch become
one flat symbol array and are merged in rounds (see ``merging``). Characters
outside the vocabulary fall back to byte pieces. Decoding is a table lookup of
the pieces' bytes, joined in one gather.

Defined results: a null text is an empty one; an empty text gives the begin and
end ids alone and decodes to the empty string; texts of any length are encoded
whole; repeated rows are encoded row by row; an empty table gives an empty
result; other columns are not read, so their names do not matter.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .merging import PART_BYTES, PairTable, merge_words, parts, ragged_index, space_words
from .shipping import ship

SPACE = "▁"
#: Distinct words kept with their ids in one Python worker, at most.
MEMO_WORDS = 300_000
_MEMO: dict = {}


def load_model(path: str) -> dict:
    """Tables of a sentencepiece BPE model with byte fallback and identity normalisation."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [sp.id_to_piece(i) for i in range(len(sp))]
    normal = {pieces[i]: i for i in range(len(sp)) if not (sp.is_control(i) or sp.is_byte(i) or sp.is_unknown(i) or sp.is_unused(i))}
    byte_id = np.zeros(256, np.int32)
    for i in range(len(sp)):
        if sp.is_byte(i):
            byte_id[int(pieces[i][1:-1], 16)] = i
    score = {p: sp.get_score(i) for p, i in normal.items()}
    levels = {s: k for k, s in enumerate(sorted(set(score.values()), reverse=True))}
    # single characters that only occur inside longer pieces get symbols past the vocabulary
    symbol = dict(normal)
    for p in normal:
        for c in p:
            symbol.setdefault(c, len(sp) + len(symbol))
    left, right, rank, new, risky = [], [], [], [], {}
    shared = {}
    for p in normal:
        shared[score[p]] = shared.get(score[p], 0) + 1
    for p, i in normal.items():
        for k in range(1, len(p)):
            if p[:k] in symbol and p[k:] in symbol:
                left.append(symbol[p[:k]]), right.append(symbol[p[k:]]), rank.append(levels[score[p]]), new.append(i)
                for half in (p[:k], p[k:]):
                    risky[symbol[half]] = min(risky.get(symbol[half], 1 << 30), levels[score[p]])
    single = [shared[score[pieces[n]]] > 1 or risky.get(n, 1 << 30) <= r for n, r in zip(new, rank)]
    inside = set("".join(p for p in normal if len(p) > 1))
    lone = "".join(chr(c) for c in range(128) if chr(c) not in inside and chr(c) != " ")
    crossing = any(p[k] != SPACE and p[k + 1] == SPACE for p in normal for k in range(len(p) - 1))
    text = [b""] * len(sp)
    for p, i in normal.items():
        text[i] = p.replace(SPACE, " ").encode("utf-8")
    for b in range(256):
        text[byte_id[b]] = bytes([b])
    sizes = np.array([len(t) for t in text], np.int64)
    chars = {ord(c): s for c, s in symbol.items() if len(c) == 1}
    points = np.array(sorted(chars), np.int64)
    return {
        "key": (len(sp), hashlib.sha256("\n".join(pieces).encode()).hexdigest()), "n": len(sp), "table": PairTable(left, right, rank, new, single), "points": points, "point_symbol": np.array([chars[c] for c in points.tolist()], np.int32),
        "normal_char": {s: c for c, s in chars.items() if s >= len(sp)}, "byte_id": byte_id, "lone": lone, "crossing": crossing, "bytes": np.frombuffer(b"".join(text), np.uint8), "sizes": sizes, "begins": np.cumsum(sizes) - sizes, "bos": sp.bos_id(), "eos": sp.eos_id(), "control": np.array([sp.is_control(i) for i in range(len(sp))]),
    }


def splitter(model: dict):
    """Cuts an escaped text into words that no piece reaches across."""
    if model["crossing"]:
        return lambda text: [text] if text else []
    lone = re.escape(model["lone"])
    return re.compile(rf"[{lone}]|{SPACE}*[^{SPACE}{lone}]+|{SPACE}+").findall if lone else re.compile(rf"{SPACE}*[^{SPACE}]+|{SPACE}+").findall


def encode_words(words: list[str], model: dict) -> tuple[np.ndarray, np.ndarray]:
    """(flat ids, ids of each word) of words (not empty)."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    at = np.minimum(np.searchsorted(model["points"], points), len(model["points"]) - 1)
    far = np.int64(1) << 24  # symbols of characters that no piece has
    sym = np.where(model["points"][at] == points, model["point_symbol"][at], far + points)
    flat, n = merge_words(sym, lengths, model["table"])
    if (flat < model["n"]).all():
        return flat, n
    # byte fallback
    known = flat < model["n"]
    spread = np.ones(len(flat), np.int64)
    fallen = [[int(model["byte_id"][b]) for b in chr(s - far if s >= far else model["normal_char"][s]).encode("utf-8")] for s in flat[~known].tolist()]
    spread[~known] = [len(x) for x in fallen]
    ids = np.zeros(int(spread.sum()), np.int32)
    begin = np.cumsum(spread) - spread
    ids[begin[known]] = flat[known]
    ids[ragged_index(begin[~known], spread[~known])] = np.array([i for x in fallen for i in x], np.int32)
    word = np.repeat(np.arange(len(n)), n)
    return ids, np.bincount(word, weights=spread, minlength=len(n)).astype(np.int64)


class _Memo:
    """Ids of the words seen so far, flat; every entry of ``index`` is a place in ``sizes``."""

    def __init__(self):
        self.index: dict[str, int] = {}
        self.flat = np.zeros(0, np.int32)
        self.sizes = np.zeros(0, np.int64)
        self.begins = np.zeros(0, np.int64)

    def places(self, words: list[str], model: dict) -> np.ndarray:
        """The place of each of these distinct words, after encoding the new ones."""
        new = [w for w in words if w not in self.index]
        if new and len(self.index) + len(new) > MEMO_WORDS:
            self.__init__()
            new = list(words)
        if new:
            # all are cut at once: only the lone space, put last, ends in one, so no cut reaches from one word to the next
            new.sort(key=SPACE.__eq__)
            all_cuts = splitter(model)("".join(new)) if not model["crossing"] else new
            cut_ends = np.cumsum(np.fromiter(map(len, all_cuts), np.int64, len(all_cuts)))
            of = np.searchsorted(np.cumsum(np.fromiter(map(len, new), np.int64, len(new))), cut_ends)
            cuts = list(dict.fromkeys(all_cuts))
            ids, sizes = encode_words(cuts, model)
            place = dict(zip(cuts, range(len(cuts))))
            which = np.fromiter(map(place.__getitem__, all_cuts), np.int64, len(all_cuts))
            flat = ids[ragged_index((np.cumsum(sizes) - sizes)[which], sizes[which])]
            self.index.update(zip(new, range(len(self.sizes), len(self.sizes) + len(new))))
            self.flat = np.concatenate([self.flat, flat])
            self.sizes = np.concatenate([self.sizes, np.bincount(of, weights=sizes[which], minlength=len(new)).astype(np.int64)])
            self.begins = np.cumsum(self.sizes) - self.sizes
        return np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))


def encode_texts(texts: pa.Array, model: dict):
    """Yields the ids of each text, without begin and end. Texts are cut at single spaces, so that each distinct word
    of a part is encoded once; texts with touching, leading or final spaces, or U+2581, or a vocabulary with pieces across spaces, are
    split as a whole."""
    memo = _MEMO.setdefault(model["key"], _Memo())
    split = splitter(model)
    for _, part in parts(texts):
        whole = pc.match_substring_regex(part, f"  |^ |{SPACE}| $" if not model["crossing"] else "").to_numpy(zero_copy_only=False)
        distinct, index, offsets = space_words(pc.if_else(pa.array(whole), pa.scalar("", pa.large_string()), part))
        place = memo.places([SPACE + w for w in distinct], model)[index]
        sizes, begins, flat = memo.sizes, memo.begins, memo.flat
        empty = pc.equal(part, "").to_numpy(zero_copy_only=False)
        slow = {i: split(SPACE + part[i].as_py().replace(" ", SPACE)) for i in np.flatnonzero(whole & ~empty).tolist()}
        known = list(dict.fromkeys(w for words in slow.values() for w in words))
        own, n = encode_words(known, model)
        at, own_begins = dict(zip(known, range(len(known)))), np.cumsum(n) - n
        for i in range(len(part)):
            if empty[i]:
                yield np.zeros(0, np.int32)
            elif i in slow:
                which = np.fromiter(map(at.__getitem__, slow[i]), np.int64, len(slow[i]))
                yield own[ragged_index(own_begins[which], n[which])]
            else:
                which = place[offsets[i] : offsets[i + 1]]
                yield flat[ragged_index(begins[which], sizes[which])]


def decode_bytes(ids: np.ndarray, model: dict) -> bytes:
    """UTF-8 of the decoded ids: control pieces are silent, the dummy space goes."""
    kept = ids[~model["control"][ids]]
    raw = model["bytes"][ragged_index(model["begins"][kept], model["sizes"][kept])].tobytes()
    raw = raw.decode("utf-8", "replace").encode("utf-8")
    return raw[1:] if raw[:1] == b" " else raw


def with_ends(ids: np.ndarray, model: dict) -> np.ndarray:
    out = np.empty(len(ids) + 2, np.int32)
    out[0], out[-1], out[1:-1] = model["bos"], model["eos"], ids
    return out


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", full: bool = False) -> DataFrame:
    """Encode, then decode the ids again. Returns (id, n_tokens, ids_sha256, decoded_sha256); with ``full`` also
    ids (array of int) and decoded (string). One narrow pass, no shuffle; the model's tables are broadcast (fixed by
    the model file, about 12 MB)."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(load_model(model_path))

    def packed(ids, rows):
        kinds = [pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.string()]
        columns = [ids, *(pa.array(list(x), kind) for x, kind in zip(zip(*rows), kinds))]
        return pa.RecordBatch.from_arrays(columns, names=["id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"][: len(columns)])

    def encode(batches):
        model = shared.value
        for batch in batches:
            rows: list[tuple] = []
            begin, held = 0, 0
            for plain in encode_texts(batch.column(1), model):
                ids = with_ends(plain, model)
                raw = decode_bytes(ids, model)
                rows.append((len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(), hashlib.sha256(raw).hexdigest(), *((ids, raw.decode("utf-8")) if full else ())))
                held += len(raw) if full else 0
                if held > PART_BYTES:  # so that the ids of few texts are held at a time
                    yield packed(batch.column(0).slice(begin, len(rows)), rows)
                    begin, held, rows = begin + len(rows), 0, []
            if rows:
                yield packed(batch.column(0).slice(begin, len(rows)), rows)

    kind = docs.schema[id_col].dataType.simpleString()
    got = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(encode, f"id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded string" if full else ""))
    return got.withColumnRenamed("id", id_col)
