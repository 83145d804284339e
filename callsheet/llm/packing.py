"""Best-two-fit packing of tokenised documents into fixed-size sequences.

A document becomes its token ids and an end id; longer ones are cut into
whole-sequence pieces. The pieces are dealt by a hash into groups whose size
is a parameter, each group is packed by itself, so the work spreads over the
cluster and no task holds more than a group. Within a group each sequence is
filled greedily, largest fitting piece first; then its smallest piece is taken
back if two unpacked pieces fill the widened gap more tightly, and so on
until none do.

Defined results: null text counts as empty (one piece that holds the end id);
repeated rows and null ids are packed as rows of their own; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from bisect import bisect_right

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, cut_batches, documents, kept_by

SEQUENCE_TOKENS = 4096
END_ID = 1
GROUP_PIECES = 32_768  # pieces that one group is planned to hold
CACHED_PARTS = 250_000  # parts of words in a generation of a worker's memory; there are two
ENCODED_PARTS = 512  # parts given to the tokenizer at once

_CLOSERS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
# letters that lower-case one by one and that NFC leaves as they are
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_PLAIN = re.compile(f"[{_LETTERS}]+")
_WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _gathered(values: np.ndarray, begin: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slices ``which`` of ``values`` in a row, and where each of them begins there (and the last one ends)."""
    lengths = np.diff(begin)[which]
    at = np.zeros(len(which) + 1, np.int64)
    np.cumsum(lengths, out=at[1:])
    return values[np.repeat(begin[which] - at[:-1], lengths) + np.arange(at[-1])], at


class WordTokenizer:
    """Ids of whole texts by ``tokenizers``, remembering the ids of parts of words.

    The tokenizer's rules never join characters across an ASCII blank, and
    letters never join with a run of ASCII punctuation behind them, so a
    text's ids are its words' ids in a row, and a word's those of its letters
    and of the punctuation. Texts come in batches: each different word of a batch is
    cut once, and only parts not met before are given to the tokenizer.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.letters = self._of_letters(path) or self.model
        self.parts: dict[str, bytes] = {}
        self.old_parts: dict[str, bytes] = {}

    @staticmethod
    def _of_letters(path: str):
        """The tokenizer without the steps that leave a word of lower-case Latin letters as it is, if it has just these."""
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = [(spec[k] or {}).get(n, []) for k, n in (("normalizer", "normalizers"), ("pre_tokenizer", "pretokenizers"))]
        if [[x["type"] for x in s] for s in steps] != [["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]] \
                or steps[0][1]["pattern"] != {"Regex": r"\s+"} or steps[1][0]["pattern"] != {"Regex": _WORD_SPLIT} \
                or steps[1][1]["add_prefix_space"]:
            return None
        return Tokenizer.from_str(json.dumps(spec | {"normalizer": None, "pre_tokenizer": steps[1][1]}))

    def ids_of(self, parts: list[str]) -> list[bytes]:
        """The ids of different parts; those not met before are encoded and added to the young generation."""
        if len(self.parts) + len(parts) > CACHED_PARTS:
            self.parts, self.old_parts = {"": b""}, self.parts
        known, old = self.parts, self.old_parts
        new: dict[bool, list[str]] = {True: [], False: []}
        for p in parts:
            if p not in known:
                if (ids := old.get(p)) is None:
                    new[_PLAIN.fullmatch(p) is not None].append(p)
                else:
                    known[p] = ids
        for model, unknown in ((self.letters, new[True]), (self.model, new[False])):
            for i in range(0, len(unknown), ENCODED_PARTS):
                some = unknown[i:i + ENCODED_PARTS]
                for p, e in zip(some, model.encode_batch_fast(some, add_special_tokens=False), strict=True):
                    known[p] = array("I", e.ids).tobytes()
        return [known[p] for p in parts]

    def words(self, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of different words in a row, and where each word's begin (and the last one's end)."""
        odd = pc.invert(pc.match_substring_regex(words, f"^[{_LETTERS}]+$"))
        others = words.filter(odd)
        core, tail = pc.extract_regex(others, f"^(?P<core>[{_LETTERS}]+)(?P<tail>[{re.escape(_CLOSERS)}]+)$").flatten()
        coded = pa.concat_arrays([
            pc.utf8_lower(words.filter(pc.invert(odd))), pc.coalesce(pc.utf8_lower(core), others), pc.fill_null(tail, ""),
            pa.array([""])]).dictionary_encode()
        ids = self.ids_of(coded.dictionary.to_pylist())
        begin = np.zeros(len(ids) + 1, np.int64)
        np.cumsum([len(x) // 4 for x in ids], out=begin[1:])
        at, odd = coded.indices.to_numpy(), odd.to_numpy(zero_copy_only=False)
        n, m = len(words), len(others)
        two = np.full((n, 2), at[-1])  # letters and the punctuation behind them, most often none
        two[~odd, 0], two[odd, 0], two[odd, 1] = at[:n - m], at[n - m:n], at[n:n + m]
        values, ends = _gathered(np.frombuffer(b"".join(ids), "<u4"), begin, two.ravel())
        return values, ends[::2]

    def encode_all(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where each text's begin (and the last one's end)."""
        words = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        coded = words.flatten().dictionary_encode()
        ids, begin = self.words(coded.dictionary)
        values, at = _gathered(ids, begin, coded.indices.to_numpy())
        offsets = words.offsets.to_numpy()
        return values, at[offsets - offsets[0]]

    def encode(self, text: str) -> bytes:
        """A text's ids as little-endian unsigned 32-bit numbers."""
        return self.encode_all(pa.array([text]))[0].tobytes()


def _tokenizer(path: str) -> WordTokenizer:
    models = kept_by("packing")
    if path not in models:
        models[path] = WordTokenizer(path)
    return models[path]


def token_pieces(docs: DataFrame, tokenizer_path: str, sequence_tokens: int = SEQUENCE_TOKENS,
                 end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of every document, with its ids if asked for."""
    cut_batches(docs.sparkSession)
    end, step = np.array([end_id], "<u4").tobytes(), 4 * sequence_tokens

    def run(batches):
        # a reused worker gives back what earlier stages left in it
        pa.default_memory_pool().release_unused()
        model = _tokenizer(tokenizer_path)
        for b in batches:
            cols: list[list] = [[] for _ in range(6)]
            values, at = model.encode_all(b.column("text"))
            for doc_id, lo, hi in zip(b.column("doc_id").to_pylist(), at[:-1].tolist(), at[1:].tolist(), strict=True):
                ids = values[lo:hi].tobytes() + end
                for k, cut_at in enumerate(range(0, len(ids), step)):
                    cut = ids[cut_at:cut_at + step]
                    for c, x in zip(cols, (doc_id, k, cut_at // 4, len(cut) // 4, zlib.crc32(cut),
                                           np.frombuffer(cut, "<u4") if with_ids else None), strict=True):
                        c.append(x)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
            arrays = [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)][:6 if with_ids else 5]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][:len(arrays)])

    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<bigint>" * with_ids
    return documents(docs, "doc_id", "text").mapInArrow(run, schema)


class _Pool:
    """Unpacked pieces of a group by length."""

    def __init__(self, lengths: np.ndarray, size: int):
        self.size = size
        self.rows: list[list[int]] = [[] for _ in range(size + 1)]
        for i in np.argsort(lengths, kind="stable").tolist():
            self.rows[lengths[i]].append(i)
        self.present = [n for n in range(size + 1) if self.rows[n]]
        self.count = np.array([len(x) for x in self.rows])

    def largest(self, gap: int) -> int:
        at = bisect_right(self.present, gap)
        return self.present[at - 1] if at else 0

    def take(self, n: int) -> int:
        i = self.rows[n].pop()
        self.count[n] -= 1
        if not self.rows[n]:
            del self.present[bisect_right(self.present, n) - 1]
        return i

    def give(self, n: int, i: int) -> None:
        if not self.rows[n]:
            self.present.insert(bisect_right(self.present, n), n)
        self.rows[n].append(i)
        self.count[n] += 1

    def best_two(self, gap: int, over: int) -> tuple[int, int] | None:
        """The two lengths with the largest sum up to ``gap``, if it is above ``over``."""
        have = np.array(self.present[:bisect_right(self.present, gap)], dtype=np.int64)
        if not len(have):
            return None
        at = np.searchsorted(have, gap - have, "right") - 1
        lone = (at >= 0) & (have[at] == have) & (self.count[have] < 2)
        at = np.where(lone, at - 1, at)
        total = np.where(at >= 0, have + have[at], -1)
        i = int(total.argmax())
        return (int(have[i]), int(have[at[i]])) if total[i] > over else None


def best_two_fit(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece; lengths are 1 to size."""
    pool = _Pool(lengths, size)
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    number = 0
    while pool.present:
        held: list[tuple[int, int]] = []
        gap = size
        while True:
            while n := pool.largest(gap):
                held.append((n, pool.take(n)))
                gap -= n
            if not gap or len(held) < 2:
                break
            small, row = held[-1]
            two = pool.best_two(gap + small, small)
            if not two:
                break
            held.pop()
            for n in two:
                held.append((n, pool.take(n)))
            pool.give(small, row)
            gap += small - sum(two)
            held.sort(reverse=True)
        at = 0
        for n, i in held:
            sequence[i], offset[i] = number, at
            at += n
        number += 1
    return sequence, offset


def packed(pieces: DataFrame, sequence_tokens: int = SEQUENCE_TOKENS, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """The pieces with their sequence_id and offset. ``pieces`` must be a written table (its rows are numbered)."""
    numbered = pieces.withColumn("row", F.monotonically_increasing_id())
    short = numbered.where(F.col("length") < sequence_tokens)
    groups = max(1, -(-short.count() // group_pieces))
    names = pieces.columns

    def run(table: pa.Table) -> pa.Table:
        lengths = table.column("length").to_numpy()
        order = np.lexsort((table.column("row").to_numpy(), lengths))
        seq, off = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
        seq[order], off[order] = best_two_fit(lengths[order], sequence_tokens)
        group = table.column("group")[0].as_py()
        return table.select(names).append_column("sequence_id", pa.array(seq + (group << 40))) \
            .append_column("offset", pa.array(off))

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    dealt = short.withColumn("group", F.pmod(F.xxhash64("row"), F.lit(groups)))
    filled = dealt.groupBy("group").applyInArrow(run, f"{kinds}, sequence_id bigint, offset bigint")
    whole = numbered.where(F.col("length") == sequence_tokens).select(
        *names, (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    return filled.unionByName(whole)


def pack_documents(docs: DataFrame, tokenizer_path: str, sequence_tokens: int = SEQUENCE_TOKENS,
                   end_id: int = END_ID, group_pieces: int = GROUP_PIECES, with_ids: bool = False) -> DataFrame:
    """Every piece of every document with its place in a sequence."""
    scratch = Scratch(docs.sparkSession, "packing")
    pieces = scratch.keep(token_pieces(docs, tokenizer_path, sequence_tokens, end_id, with_ids))
    return packed(pieces, sequence_tokens, group_pieces)
