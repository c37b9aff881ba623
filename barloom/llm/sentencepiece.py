"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces.

Of all ways to write a text in pieces, the one of the highest sum of piece scores is taken;
of equal ones, the one whose last differing piece is longer. A character that no piece covers
costs the lowest score less 10 and is written as byte pieces. White space is marked by `▁`.

No piece spans certain pairs of neighbouring characters, above all none goes on from a word
into the next one's marker. A text is cut at such pairs, the distinct parts of a batch are
encoded once, all at the same time: the Viterbi steps of many parts run in lockstep over
numpy columns.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from barloom.llm.common import fields, hand_back, map_arrow, read

#: A public model file; its pieces and scores are used, its training is not repeated.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE, MARK = " ", "▁"
#: What a character outside all pieces costs below the lowest score.
UNKNOWN_PENALTY = 10.0
#: Distinct parts whose ids a task remembers in each of two generations. When the younger one
#: is full, the older one, which holds what was not met since, is forgotten.
REMEMBERED = 100_000

_NORMAL, _UNKNOWN, _BYTE = 1, 2, 6


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 127) << shift
        at, shift = at + 1, shift + 7
        if byte < 128:
            return value, at


def _message(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Fields of a protocol-buffer message: number and value."""
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        if tag & 7 == 0:
            value, at = _varint(data, at)
        else:
            size, at = _varint(data, at) if tag & 7 == 2 else ({1: 8, 5: 4}[tag & 7], at)
            value, at = data[at : at + size], at + size
        yield tag >> 3, value


def read_model(path: str) -> tuple[list[tuple[str, float, int]], bool]:
    """Pieces (text, score, type) of a model file, and whether it puts a space before a text."""
    with open(path, "rb") as file:
        parts = list(_message(file.read()))
    pieces, prefix = [], True
    for number, value in parts:
        if number == 1:
            piece = dict(_message(value))
            pieces.append((piece[1].decode(), float(np.frombuffer(piece.get(2, b"\0" * 4), "<f4")[0]), piece.get(3, _NORMAL)))
        elif number == 3:
            prefix = bool(dict(_message(value)).get(3, 1))
    return pieces, prefix


class DoubleArray:
    """A trie of byte strings in two arrays: state s goes by byte b to base[s] + b if check there is s."""

    def __init__(self, words: dict[bytes, int]):
        children: list[dict[int, int]] = [{}]
        ends: dict[int, int] = {}
        for word, value in words.items():
            node = 0
            for byte in word:
                if byte not in children[node]:
                    children[node][byte] = len(children)
                    children.append({})
                node = children[node][byte]
            ends[node] = value
        size = 2 * len(children) + 1024
        self.base, self.check, self.value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        used = bytearray(size)
        used[0] = 1
        free, hint = 257, 1  # the first hole that any byte reaches, and where several holes at once are sought
        queue = [(0, 0)]
        for node, state in queue:
            self.value[state] = ends.get(node, -1)
            labels = sorted(children[node])
            if not labels:
                continue
            while free < len(used) and used[free]:
                free += 1
            base, tries = (free - labels[0] if len(labels) == 1 else hint), 0
            while True:
                if base + 256 >= len(used):
                    grown = len(used)
                    used += bytes(grown)
                    self.base, self.check, self.value = (np.concatenate((x, np.full(grown, fill, np.int32))) for x, fill in ((self.base, 0), (self.check, -1), (self.value, -1)))
                if not any(used[base + x] for x in labels):
                    break
                base, tries = base + 1, tries + 1
            if tries > 32 and len(labels) > 1:
                hint = base
            self.base[state] = base
            for label in labels:
                used[base + label] = 1
                self.check[base + label] = state
                queue.append((children[node][label], base + label))
        end = max(i for i, x in enumerate(used) if x) + 257
        self.base, self.check, self.value = (np.concatenate((x[:end], np.full(max(0, end - len(x)), fill, np.int32))) for x, fill in ((self.base, 0), (self.check, -1), (self.value, -1)))

    def step(self, state: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The next state of each, -1 where there is none."""
        to = self.base[state] + byte
        return np.where((self.check[to] == state) & (state >= 0), to, -1)


class Model:
    """Encoder and decoder of one set of pieces."""

    def __init__(self, pieces: list[tuple[str, float, int]], prefix: bool = True):
        normal = {text.encode(): i for i, (text, _, kind) in enumerate(pieces) if kind == _NORMAL and text}
        self.prefix = prefix
        self.scores = np.array([score for _, score, _ in pieces])
        self.trie = DoubleArray(normal)
        self.longest = max(map(len, normal))
        self.unknown = self.scores[list(normal.values())].min() - UNKNOWN_PENALTY
        bytes_ = {int(text[3:5], 16): i for i, (text, _, kind) in enumerate(pieces) if kind == _BYTE}
        self.unknown_id = next((i for i, (_, _, kind) in enumerate(pieces) if kind == _UNKNOWN), 0)
        self.byte_ids = np.array([bytes_.get(b, self.unknown_id) for b in range(256)], np.int32)
        raw = [bytes([int(text[3:5], 16)]) if kind == _BYTE else text.replace(MARK, SPACE).encode() if kind == _NORMAL else b"" for text, _, kind in pieces]
        self.raw_bounds = np.concatenate(([0], np.cumsum([len(x) for x in raw])))
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        inner = {a + b for text, _, kind in pieces if kind == _NORMAL for a, b in zip(text, text[1:], strict=False)}
        #: Whether each run of markers and the word after it can be encoded alone.
        self.by_word = not any(a != MARK and b == MARK for a, b in inner)
        self.part = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+") if self.by_word else re.compile(".+", re.DOTALL)
        self.known: dict[str, np.ndarray] = {}
        self.older: dict[str, np.ndarray] = {}

    def forget(self) -> None:
        self.known, self.older = {}, {}

    def normalise(self, text: str) -> str:
        return (SPACE + text if self.prefix and text else text).replace(SPACE, MARK)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the n + 1 bounds of the texts."""
        parts = [self.part.findall(self.normalise(text)) for text in texts]
        if len(self.known) > REMEMBERED:
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        new = []
        for x in {x for own in parts for x in own if x not in known}:
            if x in older:
                known[x] = older[x]
            else:
                new.append(x)
        for lo in range(0, len(new), 20_000):
            known.update(zip(new[lo : lo + 20_000], self._viterbi(new[lo : lo + 20_000]), strict=True))
        found = [[known[x] for x in own] for own in parts]
        bounds = np.concatenate(([0], np.cumsum([sum(map(len, own)) for own in found]))).astype(np.int64)
        flat = [ids for own in found for ids in own]
        return np.concatenate(flat) if flat else np.zeros(0, np.int32), bounds

    def _viterbi(self, parts: list[str]) -> list[np.ndarray]:
        """Best ids of each part; parts of like length go together."""
        raw = [x.encode("utf-8", "replace") for x in parts]
        order = sorted(range(len(raw)), key=lambda i: len(raw[i]))
        out: list[np.ndarray] = [None] * len(raw)
        lo = 0
        while lo < len(order):
            hi, limit = lo, max(len(raw[order[lo]]) * 5 // 4, 16)
            while hi < len(order) and len(raw[order[hi]]) <= limit:
                hi += 1
            for i, ids in zip(order[lo:hi], self._lockstep([raw[i] for i in order[lo:hi]]), strict=True):
                out[i] = ids
            lo = hi
        return out

    def _lockstep(self, raw: list[bytes]) -> list[np.ndarray]:
        n, sizes = len(raw), np.array([len(x) for x in raw])
        width = int(sizes.max())
        text = np.zeros((width + 1, n), np.int32)
        flat = np.frombuffer(b"".join(raw), np.uint8)
        col = np.repeat(np.arange(n), sizes)
        row = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        text[row, col] = flat
        best = np.full((width + 1, n), -np.inf)
        best[0] = 0.0
        piece = np.full((width + 1, n), -1, np.int32)
        back = np.zeros((width + 1, n), np.int32)
        # bytes of the character that starts at a byte; 0 within one
        lead = np.where(text < 0x80, 1, np.where(text < 0xC0, 0, np.where(text < 0xE0, 2, np.where(text < 0xF0, 3, 4))))
        for start in range(width):
            at = np.flatnonzero((start < sizes) & (best[start] > -np.inf))
            if not len(at):
                continue
            size = lead[start, at]
            single = np.zeros(len(at), bool)
            state, who = np.zeros(len(at), np.int32), np.arange(len(at))
            for end in range(start + 1, min(start + self.longest, width) + 1):
                live = end <= sizes[at[who]]
                who, state = who[live], state[live]
                state = self.trie.step(state, text[end - 1, at[who]])
                who, state = who[state >= 0], state[state >= 0]
                if not len(who):
                    break
                ids = self.trie.value[state]
                done = ids >= 0
                if done.any():
                    w, ids = who[done], ids[done]
                    single[w] |= size[w] == end - start
                    self._offer(best, piece, back, start, end, at[w], ids, self.scores[ids])
            for k in range(1, 5):
                w = np.flatnonzero(~single & (size == k))
                if len(w):
                    self._offer(best, piece, back, start, start + k, at[w], np.full(len(w), -1, np.int32), self.unknown)
        # back along the best paths, all at once
        steps, place, live = [], sizes.copy(), np.flatnonzero(sizes)
        unknown = np.zeros(n, bool)
        while len(live):
            ids = np.full(n, -2, np.int32)
            ids[live] = piece[place[live], live]
            unknown |= ids == -1
            steps.append(ids)
            place[live] = back[place[live], live]
            live = live[place[live] > 0]
        paths = np.array(steps[::-1], np.int32).reshape(-1, n).T
        taken = paths != -2
        flat, ends = paths[taken], np.cumsum(taken.sum(axis=1)).tolist()
        out = [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)]
        for i in np.flatnonzero(unknown).tolist():
            out[i] = self._trace(raw[i], piece[:, i], back[:, i])
        return out

    @staticmethod
    def _offer(best, piece, back, start, end, at, ids, score) -> None:
        total = best[start, at] + score
        better = total > best[end, at]
        at = at[better]
        best[end, at], piece[end, at], back[end, at] = total[better], ids[better], start

    def _trace(self, raw: bytes, piece: np.ndarray, back: np.ndarray) -> np.ndarray:
        ids, end = [], len(raw)
        while end > 0:
            start = int(back[end])
            if piece[end] >= 0:
                ids.append(int(piece[end]))
            else:
                ids += self.byte_ids[list(raw[start:end])][::-1].tolist()
            end = start
        return np.array(ids[::-1], np.int32)

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """Texts of the ids; bytes that are no UTF-8 become U+FFFD."""
        starts, sizes = self.raw_bounds[ids], self.raw_bounds[ids + 1] - self.raw_bounds[ids]
        ends = np.concatenate(([0], np.cumsum(sizes)))
        at = np.repeat(starts - ends[:-1], sizes) + np.arange(ends[-1])
        raw = self.raw[at].tobytes()
        place = ends[bounds].tolist()
        texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(place[:-1], place[1:], strict=True)]
        return [x[1:] if self.prefix and x[:1] == SPACE else x for x in texts]


_models: dict[str, Model] = {}


def _held(broadcast) -> Model:
    """The model of this worker process, built once."""
    pieces, prefix, key = broadcast.value
    if key not in _models:
        _models.clear()
        _models[key] = Model(pieces, prefix)
    return _models[key]


#: Text that is encoded at once.
_CHARS = 2_000_000


def encode_documents(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """``docs`` with ``token_ids`` (array), ``n_tokens`` and ``decoded``, the text of the ids.

    A null or empty text has no ids and decodes to an empty text. ``decoded`` equals the text
    but for a literal `▁`, which decodes to a space. Every row is encoded by its own text
    alone; columns of these names are replaced. The model file is read on the driver and sent
    to the tasks.
    """
    docs = docs.drop("token_ids", "n_tokens", "decoded")
    pieces, prefix = read_model(model)
    key = hashlib.sha256(repr((pieces, prefix)).encode()).hexdigest()
    held = docs.sparkSession.sparkContext.broadcast((pieces, prefix, key))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model_ = _held(held)
        try:
            yield from encoded(model_, batches)
        finally:  # the worker goes on to other tasks
            model_.forget()
            hand_back()

    def encoded(model_: Model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x or "" for x in batch.column("text").to_pylist()]
            lo = 0
            while lo < len(texts):
                hi, chars = lo + 1, len(texts[lo])
                while hi < len(texts) and chars + len(texts[hi]) <= _CHARS:
                    chars += len(texts[hi])
                    hi += 1
                ids, bounds = model_.encode(texts[lo:hi])
                decoded = model_.decode(ids, bounds)
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids, pa.int32()))
                added = [lists, pa.array(np.diff(bounds)), pa.array(decoded, pa.string())]
                yield pa.RecordBatch.from_arrays([*batch.slice(lo, hi - lo).columns, *added], names=[*batch.schema.names, "token_ids", "n_tokens", "decoded"])
                lo = hi

    return map_arrow(docs, run, ", ".join([*fields(docs), "token_ids array<int>, n_tokens long, decoded string"]))


def op2_unigram_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, and whether they decode to its text."""
    rows = encode_documents(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.selectExpr("doc_id", "n_tokens", "token_ids", "decoded = coalesce(text, '') AS round_trip")
