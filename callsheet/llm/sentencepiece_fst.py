"""SentencePiece encoding and decoding by weighted finite-state transducers.

Three machines are compiled from a model file, whose pieces and scores are all
that is taken from it:

* the normaliser maps a space to the word mark and puts one before the text;
* the lexicon maps characters to pieces: an arc for each piece that its own
  characters merge into, and byte arcs for characters that no piece has;
* the merge constraint has a state for the last piece and an arc to a next piece
  only where the merge order keeps the two apart; other arcs weigh infinity.

An input is composed with them lazily, position by position, and the tropical
shortest path (fewest pieces among the finite paths) gives the encoding. For a
byte-pair model this path is the merge result: merging never crosses the
border of two neighbours exactly if it does not do so on the two alone, so a
sequence is the model's own if and only if each neighbouring pair is.

Characters that never stand side by side in a piece cut the input, so the
machines run on short spans, and a worker remembers the spans it has met.

Defined results: null and empty texts give no ids and decode to an empty text;
a literal word mark decodes to a space, as the model itself has it; repeated
rows are encoded one by one; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import Memo, documents, ship

MARK = "▁"
CACHED_SPANS = 500_000
CACHED_PAIRS = 2_000_000

_workers: dict[str, "Transducer"] = {}


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a protocol buffer message (numbers of fixed width are passed as bytes)."""
    at = 0

    def number():
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(raw):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(key & 7) or number()
        yield key >> 3, raw[at:at + size]
        at += size


def is_byte_pair(path: str) -> bool:
    """Whether the model file's trainer settings (field 2) name the type (field 3) byte-pair (2); unigram (1) is the default."""
    with open(path, "rb") as f:
        settings = [v for k, v in _fields(f.read()) if k == 2]
    return bool(settings) and next((v for k, v in _fields(settings[-1]) if k == 3), 1) == 2


class Transducer:
    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        if not is_byte_pair(path):
            raise ValueError("only byte-pair models are compiled: a unigram model's scores would be path weights")
        probe = " a  B"
        if "".join(model.encode(probe, out_type=str)) != MARK + probe.replace(" ", MARK):
            raise ValueError("only an identity normaliser with a word mark in front is compiled")
        self.ids: dict[str, int] = {}
        self.score: dict[str, float] = {}
        self.byte_id = [0] * 256
        self.out: list[bytes] = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                byte = int(piece[3:5], 16)
                self.byte_id[byte] = i
                self.out.append(bytes([byte]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.out.append(b"")
            else:
                self.ids[piece], self.score[piece] = i, model.get_score(i)
                self.out.append(piece.encode())
        self.longest = max(map(len, self.ids))
        self.beside = {p[k:k + 2] for p in self.ids for k in range(len(p) - 1)}
        self.own: dict[str, bool] = {}
        self.apart: dict[tuple[str, str], bool] = {}
        self.spans = Memo(CACHED_SPANS)
        self.chunks = Memo(CACHED_SPANS)

    def merged(self, symbols: list[str]) -> list[str]:
        """The model's merge order on a few symbols: highest score first, leftmost of equals."""
        symbols = list(symbols)
        while True:
            best, at = None, -1
            for i in range(len(symbols) - 1):
                s = self.score.get(symbols[i] + symbols[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                return symbols
            symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]

    def arc(self, piece: str) -> bool:
        """Lexicon arc: a piece that its own characters merge into, or a character that no piece has."""
        if (got := self.own.get(piece)) is None:
            got = self.own[piece] = len(piece) == 1 or piece in self.ids and self.merged(list(piece)) == [piece]
        return got

    def keeps_apart(self, a: str, b: str) -> bool:
        """Constraint arc: the two stay as they are side by side."""
        if a[-1] + b[0] not in self.beside:
            return True
        if (got := self.apart.get((a, b))) is None:
            if len(self.apart) > CACHED_PAIRS:
                self.apart = {}
            got = self.apart[a, b] = self.merged(list(a + b)) == [a, b]
        return got

    def shortest_path(self, span: str) -> list[str]:
        """Pieces of the path of least weight through the composition with one span.

        Each position has at most one finite path (the merge result of what
        stands before it), so the first finite path to the end is the
        shortest. It is searched longest piece first; positions from which no
        finite path leads on are not entered twice.
        """
        n, ids, path, at, dead = len(span), self.ids, [], 0, set()
        end = min(n, self.longest)
        while at < n:
            while end > at:
                piece = span[at:end]
                if (end - at == 1 or piece in ids) and end not in dead and self.arc(piece) \
                        and (not path or self.keeps_apart(path[-1], piece)):
                    break
                end -= 1
            if end > at:
                path.append(piece)
                at = end
                end = min(n, at + self.longest)
            else:
                dead.add(at)
                end = at - 1
                at -= len(path.pop())
        return path

    def span_ids(self, span: str) -> bytes:
        """Little-endian ids of a span, byte arcs for characters outside the lexicon."""
        out = []
        for piece in self.shortest_path(span):
            if piece in self.ids:
                out.append(self.ids[piece])
            else:
                out += (self.byte_id[b] for b in piece.encode())
        return array("i", out).tobytes()

    def cut(self, text: str) -> list[str]:
        """Spans of the normalised text that no piece crosses."""
        at = [0, *(i for i in range(1, len(text)) if text[i - 1:i + 1] not in self.beside), len(text)]
        return [text[a:b] for a, b in zip(at, at[1:], strict=False)]

    def chunk_ids(self, chunk: str) -> bytes:
        """Ids of a normalised chunk that starts with word marks."""
        return b"".join([self.spans.get(span, self.span_ids) for span in self.cut(chunk)])

    def encode(self, text: str) -> bytes:
        """Little-endian 32-bit ids of a whole text."""
        if not text:
            return b""
        out, held = [], 0
        for word in text.replace(MARK, " ").split(" "):
            held += 1
            if word:  # else its mark belongs to the next word
                out.append(self.chunks.get(MARK * held + word, self.chunk_ids))
                held = 0
        if held:
            out.append(self.chunk_ids(MARK * held))
        return b"".join(out)

    def decode(self, ids) -> str:
        """The text of ids: the inverse machines, from pieces to characters."""
        raw = b"".join(map(self.out.__getitem__, ids))
        text = raw.decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if text.startswith(" ") else text


def transducer(path: str) -> Transducer:
    if path not in _workers:
        _workers[path] = Transducer(path)
    return _workers[path]


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids, n_ids, ids_crc32 and whether decoding gives the text back."""
    ship(docs.sparkSession)

    def run(batches):
        machine = transducer(path)
        for b in batches:
            texts = [t or "" for t in b.column("text").to_pylist()]
            raw = [machine.encode(t) for t in texts]
            counts = np.array([len(r) // 4 for r in raw], np.int64)
            flat = np.frombuffer(b"".join(raw), "<i4")
            ids = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)], pa.int32()), pa.array(flat, pa.int32()))
            back = [machine.decode(np.frombuffer(r, "<i4").tolist()) == t for r, t in zip(raw, texts, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), ids, pa.array(counts), pa.array([zlib.crc32(r) for r in raw], pa.int64()), pa.array(back)],
                ["doc_id", "ids", "n_ids", "ids_crc32", "round_trip"])

    return documents(docs, "doc_id", "text").mapInArrow(
        run, "doc_id bigint, ids array<int>, n_ids bigint, ids_crc32 bigint, round_trip boolean")


def decoded(coded: DataFrame, path: str) -> DataFrame:
    """doc_id and the text of each row's ids."""
    ship(coded.sparkSession)

    def run(batches):
        machine = transducer(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([machine.decode(x or []) for x in b.column("ids").to_pylist()], pa.string())],
                ["doc_id", "text"])

    return coded.selectExpr("cast(doc_id as bigint) as doc_id", "ids").mapInArrow(run, "doc_id bigint, text string")
