"""SentencePiece encoding and decoding by weighted finite-state transducers.

Compiled once per process from the model file:

* the normaliser: a blank becomes the meta sign, and an arc without input puts
  one meta sign before a text that isn't empty.  Models that also fold
  characters or trim blanks are refused;
* the pieces: a trie of arcs, one per character; where a piece ends, its id
  comes out with weight -score and the walk is back at the root;
* byte fallback: from the root, on a character that is no piece, the ids of
  its bytes at a weight beyond all pieces.

The normaliser has one state beyond its first arc, so its composition with the
pieces relabels their arcs, once, when both are compiled.  The result is
composed with inputs, all of a batch at a time: walks from every position at
once give the lattice's arcs, and positions from left to right give the
tropical semiring's shortest paths.

For models trained with BPE the path must also be one that merging would
leave: two neighbours are joined by an arc only if no merge across their
border comes before the merges that form them.  That is a property of the two
pieces alone, so it makes the piece transducer a bigram acceptor.  A prefix of
a text has one encoding, so one state a position is enough.

Texts are cut where no piece can lie across; a bounded cache, keyed by the
bytes themselves, keeps the ids of cuttings.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .packing import tokenizer_path
from .shared import BASES, SpanCache, edges, mix, slices, string_buffers, prepared_tasks, trimmed

META = "▁"
#: Cuttings of more characters are composed one by one, all others together.
LONG = 128
SLICE = 1 << 20
#: Fixed values of the model file's format: kinds of pieces, model types.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
_compiled: dict[str, PieceTransducer] = {}


def fields(raw: bytes) -> Iterator[tuple[int, object]]:
    """Number and value of each field of a protocol buffer message."""
    at, n = 0, len(raw)

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < n:
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(key & 7) or varint()
        yield key >> 3, raw[at : at + size]
        at += size


class PieceTransducer:
    """The composition of normaliser, pieces and byte fallback of one model."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            message = list(fields(file.read()))
        trainer = dict(fields(next((v for k, v in message if k == 2), b"")))
        normaliser = dict(fields(next((v for k, v in message if k == 3), b"")))
        kind = trainer.get(3, UNIGRAM)
        if kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models are covered")
        if normaliser.get(2) or normaliser.get(4, 1) or not normaliser.get(5, 1):
            raise ValueError("the model's normaliser folds characters or trims blanks, which is not covered")
        self.bpe = kind == BPE
        self.prefix = bool(normaliser.get(3, 1))
        self.pieces, scores, kinds = [], [], []
        for number, raw in message:
            if number == 1:
                piece = dict(fields(raw))
                self.pieces.append(piece.get(1, b"").decode())
                scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                kinds.append(piece.get(3, NORMAL))
        if USER_DEFINED in kinds:
            raise ValueError("models with user-defined pieces are not covered")
        if kinds.count(BYTE) != 256:
            raise ValueError("models without byte fallback are not covered")
        normal = [i for i, k in enumerate(kinds) if k == NORMAL]
        self.scores = np.array(scores)
        self.id_of = {self.pieces[i]: i for i in normal}
        self.byte_ids = np.zeros(256, np.uint32)
        for i, k in enumerate(kinds):
            if k == BYTE:
                self.byte_ids[int(self.pieces[i][3:5], 16)] = i
        self.worst = 10.0 - min((scores[i] for i in normal), default=0.0)
        self.halve(normal)
        self.build([i for i in normal if not self.bpe or self.formed[i]])
        out = {BYTE: lambda p: bytes([int(p[3:5], 16)]), CONTROL: lambda p: b"", UNKNOWN: lambda p: " ⁇ ".encode()}
        self.bytes_of = [out.get(k, lambda p: p.replace(META, " ").encode())(p) for p, k in zip(self.pieces, kinds)]
        self.cache = SpanCache(self.encode)

    def halve(self, normal: list[int]) -> None:
        """The two pieces that merging joins last to form each piece, and the piece that each pair of pieces joins to."""
        n = len(self.pieces)
        self.left, self.right = np.full(n, -1), np.full(n, -1)
        self.formed = np.zeros(n, bool)
        score, id_of, pairs = self.scores, self.id_of, []
        for i in normal if self.bpe else []:
            piece = self.pieces[i]
            pairs += [(id_of[a] * n + id_of[b], i) for a, b in ((piece[:k], piece[k:]) for k in range(1, len(piece))) if a in id_of and b in id_of]
            parts, last = list(piece), (None, None)
            while len(parts) > 1:
                joined = [score[id_of[x + y]] if x + y in id_of else -np.inf for x, y in zip(parts, parts[1:])]
                k = int(np.argmax(joined))
                if joined[k] == -np.inf:
                    break
                last = id_of.get(parts[k]), id_of.get(parts[k + 1])
                parts[k : k + 2] = [parts[k] + parts[k + 1]]
            self.formed[i] = len(piece) == 1 or len(parts) == 1 and None not in last
            if self.formed[i] and len(piece) > 1:
                self.left[i], self.right[i] = last
        pairs.sort()
        self.pair_keys = np.array([k for k, _ in pairs] or [-1])
        self.pair_joined = np.array([i for _, i in pairs] or [-1])
        self.known_keys, self.known = np.full(1 << 20, -1), np.zeros(1 << 20, bool)

    def build(self, pieces: list[int]) -> None:
        """Arcs of the trie as sorted numbers (state, character); the normaliser's arcs are composed in."""
        nodes: dict[str, int] = {"": 0}
        self.final = [-1]
        arcs = []
        for i in pieces:
            piece = self.pieces[i]
            for k in range(1, len(piece) + 1):
                if piece[:k] not in nodes:
                    nodes[piece[:k]] = len(nodes)
                    self.final.append(-1)
                    # the normaliser reads a blank or a meta sign where the pieces read a meta sign
                    for c in (" ", META) if piece[k - 1] == META else (piece[k - 1],) if piece[k - 1] != " " else ():
                        arcs.append((nodes[piece[: k - 1]] << 21 | ord(c), nodes[piece[:k]]))
            self.final[nodes[piece]] = i
        arcs.sort()
        self.final = np.array(self.final)
        self.arc_keys, self.arc_to = np.array([k for k, _ in arcs] or [-1]), np.array([t for _, t in arcs] or [0])
        self.root = np.zeros(0x110000, np.int32)
        first = self.arc_keys < 1 << 21
        self.root[self.arc_keys[first & (self.arc_keys >= 0)]] = self.arc_to[first & (self.arc_keys >= 0)]
        # whether some piece holds two neighbouring bytes; 128 stands for all that are not ASCII
        self.joint = np.zeros((129, 129), bool)
        for i in pieces:
            codes = [min(ord(" " if c == META else c), 128) for c in self.pieces[i]]
            self.joint[codes[:-1], codes[1:]] = True
        self.joint[128, 128] = True
        # the meta sign itself may stand for a blank in a text
        self.joint[128] |= self.joint[32]
        self.joint[:, 128] |= self.joint[:, 32]

    def step(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The state behind each arc, 0 where there is none."""
        key = state << 21 | code
        at = np.minimum(np.searchsorted(self.arc_keys, key), len(self.arc_keys) - 1)
        return np.where(self.arc_keys[at] == key, self.arc_to[at], 0)

    def open_border(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging leaves the border between a and b open.

        Goes back in time from the finished pieces: of the two, the one formed
        later is halved.  A merge across the border counts against the pair if
        it would have come before the step just undone; of equal merges the
        left one comes first.
        """
        n, score = len(self.pieces), self.scores
        good = np.ones(len(a), bool)
        which, left, right = np.arange(len(a)), a, b
        limit, strict = np.full(len(a), -np.inf), np.ones(len(a), bool)
        while len(which):
            key = left * n + right
            at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            joined = score[self.pair_joined[at]]
            bad = (self.pair_keys[at] == key) & ((joined > limit) | (joined == limit) & ~strict)
            good[which[bad]] = False
            cut_left, cut_right = self.left[left] >= 0, self.left[right] >= 0
            go = np.flatnonzero(~bad & (cut_left | cut_right))
            which, left, right, cut_left, cut_right = which[go], left[go], right[go], cut_left[go], cut_right[go]
            # if the left piece was formed last, an equal merge to its right would have come after it
            strict = cut_left & (~cut_right | (score[left] < score[right]))
            limit = np.where(strict, score[left], score[right])
            left, right = np.where(strict, self.right[left], left), np.where(strict, right, self.left[right])
        return good

    def neighbours(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``open_border``, kept for pairs seen before."""
        key = a * len(self.pieces) + b
        slot = (mix(key.astype(np.uint64) * np.uint64(BASES[0])) >> np.uint64(44)).astype(np.int64)
        good = self.known[slot]
        new = np.flatnonzero(self.known_keys[slot] != key)
        if len(new):
            kinds, back = np.unique(key[new], return_inverse=True)
            fresh = self.open_border(kinds // len(self.pieces), kinds % len(self.pieces))
            good[new] = fresh[back]
            self.known_keys[slot[new]], self.known[slot[new]] = key[new], good[new]
        return good

    def lattice(self, codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Arcs of the composition with texts: position, characters and piece (-1 for byte fallback). ``ends``: where the text of a position ends."""
        at = np.arange(len(codes))
        state = self.root[codes].astype(np.int64)
        single = self.final[state]
        single[state == 0] = -1
        starts, sizes, pieces = [at], [np.ones(len(at), np.int64)], [single]
        size = 1
        while True:
            on = np.flatnonzero((state > 0) & (at + size < ends))
            if not len(on):
                break
            at, ends = at[on], ends[on]
            state = self.step(state[on], codes[at + size])
            size += 1
            out = (state > 0) & (self.final[state] >= 0)
            starts.append(at[out]), sizes.append(np.full(int(out.sum()), size)), pieces.append(self.final[state[out]])
        return np.concatenate(starts), np.concatenate(sizes), np.concatenate(pieces)

    def paths(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Shortest paths of many texts at once: text, position and piece of each arc, in order."""
        length = np.fromiter(map(len, texts), np.int64, len(texts))
        codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.int64)
        own = np.repeat(np.arange(len(texts)), length)
        begin = np.cumsum(length) - length
        start, size, piece = self.lattice(codes, (begin + length)[own])
        weight = np.where(piece >= 0, -self.scores[piece], self.worst)
        # a text of n characters has n + 1 positions
        source = start + own[start]
        order = np.argsort(start - begin[own[start]], kind="stable")
        start, size, piece, weight, source = start[order], size[order], piece[order], weight[order], source[order]
        groups = np.searchsorted(start - begin[own[start]], np.arange(int(length.max(initial=0)) + 1))
        cost = np.full(len(codes) + len(texts), np.inf)
        cost[begin + np.arange(len(texts))] = 0.0
        arc = np.full(len(cost), -1)
        for a, b in zip(groups[:-1].tolist(), groups[1:].tolist()):
            k = a + np.flatnonzero(cost[source[a:b]] < np.inf)
            if self.bpe:
                last = arc[source[k]]
                before = np.where(last >= 0, piece[last], -1)
                asked = np.flatnonzero((before >= 0) & (piece[k] >= 0))
                good = np.ones(len(k), bool)
                good[asked] = self.neighbours(before[asked], piece[k[asked]])
                k = k[good]
            # arcs of one position lead to different ones
            target, new = source[k] + size[k], cost[source[k]] + weight[k]
            better = new < cost[target]
            cost[target[better]], arc[target[better]] = new[better], k[better]
        found, where = [], (begin + length + np.arange(len(texts)))[length > 0]
        while len(where):
            found.append(arc[where])
            where = source[found[-1]]
            where = where[arc[where] >= 0]
        path = np.concatenate(found) if found else np.zeros(0, np.int64)
        path = path[np.argsort(start[path])]
        return own[start[path]], codes[start[path]], piece[path]

    def encode(self, texts: list[str]) -> list[list[int]]:
        """The ids of each text, which is a part of a normalised one: blanks stand for meta signs."""
        out: list[list[int]] = [[]] * len(texts)
        few = [i for i, t in enumerate(texts) if len(t) <= LONG]
        for own in [few] * bool(few) + [[i] for i in range(len(texts)) if len(texts[i]) > LONG]:
            if len(texts[own[0]]) > LONG:
                out[own[0]] = self.shortest(texts[own[0]])
                continue
            text, code, piece = self.paths([texts[i] for i in own])
            back = piece < 0
            size = np.ones(len(piece), np.int64)
            size[back] += (code[back] > 0x7F).astype(np.int64) + (code[back] > 0x7FF) + (code[back] > 0xFFFF)
            ids = np.repeat(piece, size)
            if back.any():
                raw = "".join(map(chr, code[back].tolist())).encode()
                ids[np.repeat(back, size)] = self.byte_ids[np.frombuffer(raw, np.uint8)]
            edge = np.append(0, np.cumsum(size))[np.searchsorted(text, np.arange(len(own) + 1))].tolist()
            ids = ids.tolist()
            for i, a, b in zip(own, edge, edge[1:]):
                out[i] = ids[a:b]
        return out

    def shortest(self, text: str) -> list[int]:
        """The same for one long text: one arc after the other, states by position (weight, last piece, position before)."""
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
        n = len(codes)
        start, size, piece = self.lattice(codes, np.full(n, n))
        order = np.argsort(start, kind="stable")
        start, size, piece = start[order].tolist(), size[order].tolist(), piece[order].tolist()
        score, worst, known = self.scores.tolist(), self.worst, {}
        states: list[tuple | None] = [(0.0, -1, -1)] + [None] * n
        for i, k, p in zip(start, size, piece):
            here = states[i]
            if here is None:
                continue
            last = here[1]
            if self.bpe and last >= 0 and p >= 0:
                good = known.get((last, p))
                if good is None:
                    good = known[last, p] = bool(self.neighbours(np.array([last]), np.array([p]))[0])
                if not good:
                    continue
            weight = here[0] + (worst if p < 0 else -score[p])
            there = states[i + k]
            if there is None or weight < there[0]:
                states[i + k] = (weight, p, i)
        out: list[int] = []
        at = n
        while at > 0:
            _, p, i = states[at]
            out += [p] if p >= 0 else self.byte_ids[np.frombuffer(text[i:at].encode(), np.uint8)].tolist()[::-1]
            at = i
        return out[::-1]

    def cuttings(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Spans that no piece crosses, and their rows."""
        if not len(data):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        kind = np.minimum(data, 128).astype(np.int32)
        cut = np.ones(len(data), bool)
        cut[1:] = ~self.joint.ravel()[kind[:-1] * 129 + kind[1:]]
        cut[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
        starts = np.flatnonzero(cut)
        return starts, np.append(starts[1:], len(data)), np.searchsorted(offsets, starts, "right") - 1


def compiled(path: str) -> PieceTransducer:
    if path not in _compiled:
        _compiled[path] = PieceTransducer(path)
    return _compiled[path]


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """One row per row of ``docs``: id_col, n_tokens, ids (little-endian unsigned 32-bit).

    Null and empty texts have no ids.  Repeated rows are encoded each; other
    columns are ignored; an empty table gives an empty result.  A very long
    text costs time in proportion to its length.  A model that the transducers
    don't cover is an error.  No shuffle.
    """
    prepared_tasks(docs.sparkSession)
    path = path or tokenizer_path("piece_bpe_32k.model")
    kind = docs.schema[id_col].dataType.simpleString()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = compiled(path)
        for batch in batches:
            texts = batch.column(1).fill_null("").cast(pa.large_string())
            if model.prefix:  # the normaliser's arc without input
                texts = pc.if_else(pc.equal(pc.binary_length(texts), 0), texts, pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), texts, pa.scalar("", pa.large_string())))
            data, offsets = string_buffers(texts)
            for lo, hi in slices(offsets, SLICE):
                a, b = int(offsets[lo]), int(offsets[hi])
                starts, ends, rows = model.cuttings(data[a:b], offsets[lo : hi + 1] - a)
                ids, many = model.cache.ids(np.append(data[a:b], np.zeros(16, np.uint8)), starts, ends)
                edge = edges(rows, many, 0, hi - lo)
                raw = pa.Array.from_buffers(pa.large_binary(), hi - lo, [None, pa.py_buffer(edge * 4), pa.py_buffer(ids)])
                yield pa.record_batch([batch.column(0).slice(lo, hi - lo), pa.array(np.diff(edge)), raw.cast(pa.binary())], [id_col, "n_tokens", "ids"])

    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(lambda batches: trimmed(encoded(batches)), f"`{id_col}` {kind}, n_tokens long, ids binary")


def decode(encoded: DataFrame, path: str | None = None, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``: the text that the ids stand for; null ids give null, unknown ones U+FFFD.

    The pieces' transducer from output to input: it reads ids only, so each id
    emits its piece's characters, a byte its byte, a meta sign a blank; the
    normaliser's first blank goes.
    """
    prepared_tasks(encoded.sparkSession)
    path = path or tokenizer_path("piece_bpe_32k.model")

    @F.pandas_udf("string")
    def text_of(column):
        model = compiled(path)
        table, most = model.bytes_of, len(model.bytes_of)

        def one(raw):
            if raw is None:
                return None
            text = b"".join([table[i] if i < most else b"\xef\xbf\xbd" for i in np.frombuffer(raw, np.uint32).tolist()]).decode("utf-8", "replace")
            return text[1:] if model.prefix and text.startswith(" ") else text

        return column.map(one, na_action="ignore")

    return encoded.withColumn("decoded", text_of(F.col(ids_col)))
