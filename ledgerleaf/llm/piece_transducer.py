"""SentencePiece encoding and decoding by a weighted finite-state transducer.

The tokenizer is a composition of four machines over the tropical semiring (min, +):

* the normaliser N: a space becomes U+2581, and one is put before the text;
* the pieces P: one arc for each piece of the vocabulary, its characters in, its id out;
* the byte fallback B: a character that no piece spells goes out as the ids of its UTF-8 bytes;
* the merge constraint C: the state is the last piece; the arc to a next piece weighs 0 if merging the two pieces'
  characters by the model's scores gives just these two, and infinity if not.

Every P and B arc weighs 1 an id. A sequence of pieces is what byte-pair merging gives exactly when each neighbouring
pair is, so only one path through N o P o B o C is finite, and the shortest path of the composition with an input is the
encoding. C is far too large to be written out; its arcs are computed when the composition first needs them, and kept.

No piece has U+2581 after another character, so no finite path has an arc over the place before a run of U+2581, and the
composition is done for the stretches between such places, once for each different stretch of a block.

Decoding inverts P and B and drops the leading space; bytes that are no UTF-8 become U+FFFD.

Defined cases: null text is the empty text; the empty text has no ids; U+2581 in a text is read as a space, so decoding
gives a space; repeated rows are encoded each; a very long text is encoded stretch by stretch, one without spaces as one
stretch; an empty table gives an empty table; other columns stay, a column named like an output is replaced.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerleaf.llm.common import collector_paused, tidy

SPACE = "▁"
#: Stretches that a worker remembers before those not used since are forgotten, and arcs before it starts anew.
REMEMBERED = 120_000
ARCS_REMEMBERED = 300_000
LONGEST_REMEMBERED = 64
_STRETCH = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_AFTER_LETTERS = re.compile(r"(?<=[^\W\d_])(?=[\W\d_])")
INFINITY = float("inf")


class PieceTransducer:
    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.text = [model.id_to_piece(i) for i in range(n)]
        self.byte_of = {i: int(self.text[i][1:-1], 16) for i in range(n) if model.is_byte(i)}
        self.of_byte = {b: i for i, b in self.byte_of.items()}
        silent = {i for i in range(n) if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)}
        self.silent = silent - set(self.byte_of)
        self.unknown = model.unk_id()
        self.piece = {self.text[i]: i for i in range(n) if i not in silent}
        self.score = {s: model.get_score(i) for s, i in self.piece.items()}
        if any(SPACE in s.lstrip(SPACE) for s in self.piece):
            raise ValueError("a piece has a space after another character; stretches between spaces would not be independent")
        # every end of a piece, -1 for those that are no piece: looking back, where there is none no piece goes on
        self.ended = {s[k:]: -1 for s in self.piece for k in range(1, len(s))} | self.piece
        self.together = {s[k : k + 2] for s in self.piece for k in range(len(s) - 1)}
        self.arcs: dict[int, float] = {}
        self.sides: dict[int, tuple] = {}
        self.longest = max(map(len, self.piece), default=1)
        # ids as the bytes of 32-bit integers, which the collector of cycles does not follow
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.spelled: pa.Array | None = None  # the bytes of each piece, once something is decoded

    def merged(self, text: str) -> tuple[list[str], list[tuple[str, str]]]:
        """What merging neighbours, best score first and leftmost of equals, makes of a short text, and the merges in order."""
        parts, merges = list(text), []
        while True:
            best, at = -INFINITY, -1
            for k in range(len(parts) - 1):
                s = self.score.get(parts[k] + parts[k + 1])
                if s is not None and s > best:
                    best, at = s, k
            if at < 0:
                return parts, merges
            merges.append((parts[at], parts[at + 1]))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def of_sides(self, piece: int) -> tuple:
        """(whether merging makes this piece of its characters, whether scores fall from merge to merge, the symbols
        that stand at its left end one after the other with the score of the merge that ends each, and at its right)."""
        got = self.sides.get(piece)
        if got is None:
            text = self.text[piece]
            parts, merges = self.merged(text)
            made = {a + b: (a, b) for a, b in merges}
            falling = all(self.score[a + b] < self.score.get(x, INFINITY) for a, b in merges for x in (a, b) if len(x) > 1)
            ends = []
            for side in (0, 1):
                at, end = [(text, -INFINITY)], text
                while end in made:
                    at.append((made[end][side], self.score[end]))
                    end = made[end][side]
                ends.append(at[::-1])
            got = self.sides[piece] = (len(parts) == 1, falling, *ends)
        return got

    def apart(self, last: int, piece: int) -> bool:
        """Whether merging the two pieces' characters gives just these two.

        Where scores fall from merge to merge, merges come in the order of their scores, and only those over the border
        need to be looked at: at any time the symbols at the border are one of the left piece's right end and one of
        the right piece's left end. Of equal scores the merge further left comes first.
        """
        _, falling_a, _, left = self.of_sides(last)
        _, falling_b, right, _ = self.of_sides(piece)
        if not (falling_a and falling_b):
            return self.merged(self.text[last] + self.text[piece])[0] == [self.text[last], self.text[piece]]
        score, i, j = self.score, 0, 0
        while True:
            (a, ends_a), (b, ends_b) = left[i], right[j]
            over = score.get(a + b)
            if over is not None and (over > ends_a and over >= ends_b):
                return False
            if ends_a == ends_b == -INFINITY:
                return True
            if ends_a >= ends_b:
                i += 1
            else:
                j += 1

    def constraint(self, last: int, piece: int) -> float:
        """The weight of C's arc from one piece to the next; -1 stands for the start, and for bytes, which never merge."""
        key = last * len(self.text) + piece
        arc = self.arcs.get(key)
        if arc is None:
            if len(self.arcs) > ARCS_REMEMBERED:
                self.arcs.clear()
            fits = self.of_sides(piece)[0] if last < 0 else self.apart(last, piece)
            arc = self.arcs[key] = 0.0 if fits else INFINITY
        return arc

    def shortest_path(self, stretch: str) -> tuple[int, ...]:
        """The ids on the lightest path of the composition with a stretch of normalised text."""
        # states[i]: last piece -> (weight, position before, last piece before, ids of the arc)
        size, pieces, longest, arcs, n_pieces = len(stretch), self.piece, self.longest, self.arcs, len(self.text)
        states: list[dict[int, tuple]] = [{} for _ in range(size + 1)]
        states[0][-1] = (0.0, -1, -1, ())
        for i in range(size):
            here = states[i]
            if not here:
                continue
            for j in range(i + 1, min(size, i + longest) + 1):
                piece = pieces.get(stretch[i:j])
                if piece is None:
                    continue
                there = states[j]
                for last, (weight, *_) in here.items():
                    arc = arcs.get(last * n_pieces + piece)
                    if arc is None:
                        arc = self.constraint(last, piece)
                    total = weight + 1 + arc
                    if total < INFINITY and (piece not in there or total < there[piece][0]):
                        there[piece] = (total, i, last, (piece,))
            if stretch[i] not in pieces:
                ids = tuple(self.of_byte.get(b, self.unknown) for b in stretch[i].encode()) if self.of_byte else (self.unknown,)
                there = states[i + 1]
                for last, (weight, *_) in here.items():
                    if -1 not in there or weight + len(ids) < there[-1][0]:
                        there[-1] = (weight + len(ids), i, last, ids)
        last = min(states[-1], key=lambda k: states[-1][k][0])
        out, i = [], size
        while i:
            _, before, last_before, ids = states[i][last]
            out.append(ids)
            i, last = before, last_before
        return tuple(x for ids in reversed(out) for x in ids)

    def only_paths(self, stretches: list[str]) -> list[tuple[int, ...] | None]:
        """As shortest_path for each of ascending stretches; None where no path over pieces and bytes is finite.

        Merging reaches every place of a stretch in one state, so the search keeps one, found by looking back from the
        place; what a stretch has in common with the one before it is not searched again.
        """
        ended, n_pieces = self.ended, len(self.text)
        piece_of, arc_of = ended.get, self.arcs.get
        out: list[tuple[int, ...] | None] = []
        last: list[int | None] = [-1]
        before = [0]
        previous = ""
        for s in stretches:
            k, n = 0, min(len(previous), len(s))
            while k < n and previous[k] == s[k]:
                k += 1
            del last[k + 1 :], before[k + 1 :]
            previous = s
            for j in range(k + 1, len(s) + 1):
                for i in range(j - 1, -1, -1):
                    piece = piece_of(s[i:j])
                    if piece is None:
                        piece = -1
                        break
                    if piece >= 0:
                        at = last[i]
                        if at is not None:
                            arc = arc_of(at * n_pieces + piece)
                            if arc is None:
                                arc = self.constraint(at, piece)
                            if not arc:
                                break
                            piece = -1
                if piece >= 0:
                    last.append(piece)
                    before.append(i)
                else:
                    # no piece ends the path here: a character that is none goes out as bytes
                    last.append(-1 if last[j - 1] is not None and ended.get(s[j - 1], -1) < 0 else None)
                    before.append(j - 1)
            ids: list[int] | None = []
            j = len(s)
            while j:
                if last[j] is None:
                    ids = None
                    break
                i = before[j]
                ids += [last[j]] if last[j] >= 0 else [self.of_byte.get(b, self.unknown) for b in reversed(s[i].encode())] if self.of_byte else [self.unknown]
                j = i
            out.append(None if ids is None else tuple(reversed(ids)))
        return out

    def divided(self, stretch: str) -> list[str]:
        """The stretch cut after letters where no piece has the two characters together: no arc, so no merge, goes over such a place."""
        parts = _AFTER_LETTERS.split(stretch)
        if len(parts) == 1:
            return parts
        out = parts[:1]
        for x in parts[1:]:
            if out[-1][-1:] + x[:1] in self.together:
                out[-1] += x
            else:
                out.append(x)
        return out

    def stretches(self, text: str) -> list[str]:
        return _STRETCH.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def of_stretches(self, stretches: list[str]) -> list[bytes]:
        """The ids of different stretches, each as the bytes of 32-bit integers."""
        if len(self.known) > REMEMBERED:
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        unknown = [s for s in stretches if s not in known]
        if older:  # what is still in use comes over
            known.update((s, older[s]) for s in unknown if s in older)
            unknown = [s for s in unknown if s not in known]
        divided = {s: self.divided(s) for s in unknown}
        new = sorted({p for parts in divided.values() for p in parts if p not in known})
        found = {}
        for p, ids in zip(new, self.only_paths(new), strict=True):
            found[p] = array("i", self.shortest_path(p) if ids is None else ids).tobytes()
        get = lambda p: known[p] if p in known else found[p]
        made = {s: get(s) if len(parts) == 1 else b"".join(map(get, parts)) for s, parts in divided.items()}
        out = [made[s] if s in made else known[s] for s in stretches]
        known.update((s, ids) for s, ids in (found | made).items() if len(s) <= LONGEST_REMEMBERED)
        return out

    def encode_many(self, texts: list[str]) -> list[np.ndarray]:
        with collector_paused():
            return self._encode_many(texts)

    def _encode_many(self, texts: list[str]) -> list[np.ndarray]:
        # words between single spaces are cut out by the column library, other texts by `stretches`
        plain = [bool(t) and t[0] != " " and t[-1] != " " and "  " not in t and SPACE not in t for t in texts]
        words = pc.split_pattern(pa.array([t for t, p in zip(texts, plain, strict=True) if p], pa.large_string()), " ")
        parts = [self.stretches(t) for t, p in zip(texts, plain, strict=True) if not p]
        cut = words.flatten().dictionary_encode(), pa.array([s for p in parts for s in p], pa.large_string()).dictionary_encode()
        n_words = len(cut[0].dictionary)
        ids = self.of_stretches([*map(SPACE.__add__, cut[0].dictionary.to_pylist()), *cut[1].dictionary.to_pylist()])
        if not ids:
            return [np.zeros(0, np.int32) for _ in texts]
        length = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat = np.frombuffer(b"".join(ids), np.int32)
        begin = np.cumsum(length) - length
        rows = []
        for at, sizes in ((cut[0].indices.to_numpy(), np.diff(words.offsets.to_numpy())), (cut[1].indices.to_numpy() + n_words, [len(p) for p in parts])):
            n = length[at]
            after = np.concatenate([[0], np.cumsum(n)])
            out = flat[np.repeat(begin[at] - after[:-1], n) + np.arange(int(after[-1]))]
            rows.append(iter(np.split(out, after[np.cumsum(sizes, dtype=np.int64)][:-1])))
        return [next(rows[not p]) for p in plain]

    def encode(self, text: str) -> list[int]:
        return self.encode_many([text])[0].tolist()

    def decode(self, ids: list[int]) -> str:
        out = bytearray()
        for i in ids:
            out += bytes([self.byte_of[i]]) if i in self.byte_of else b"" if i in self.silent else self.text[i].encode()
        text = out.decode("utf-8", "replace").replace(SPACE, " ")
        return text[1:] if text[:1] == " " else text

    def decode_many(self, rows: list[np.ndarray]) -> list[str]:
        """As decode, the pieces of many rows looked up at once."""
        if self.spelled is None:
            self.spelled = pa.array([bytes([self.byte_of[i]]) if i in self.byte_of else b"" if i in self.silent else s.encode() for i, s in enumerate(self.text)], pa.large_binary())
        if not rows:
            return []
        taken = self.spelled.take(pa.array(np.concatenate(rows)))
        _, offsets, data = taken.buffers()
        raw = data.to_pybytes() if data else b""
        ends = np.frombuffer(offsets, np.int64)[np.cumsum([len(row) for row in rows])].tolist() if len(taken) else [0] * len(rows)
        out = []
        for begin, end in zip([0, *ends[:-1]], ends, strict=True):
            text = raw[begin:end].decode("utf-8", "replace").replace(SPACE, " ")
            out.append(text[1:] if text[:1] == " " else text)
        return out


_machines: dict[str, PieceTransducer] = {}


def machine(path: str) -> PieceTransducer:
    if path not in _machines:
        _machines.clear()
        _machines[path] = PieceTransducer(path)
    return _machines[path]


def _slices(batches: Iterator[pa.RecordBatch], column: int, size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of batches with about the size of text, one row at least."""
    for batch in batches:
        a = held = 0
        for i in range(batch.num_rows):
            value = batch.column(column)[i]
            held += len(value.as_buffer()) if value.is_valid else 0
            if held >= size:
                yield batch.slice(a, i + 1 - a)
                a, held = i + 1, 0
        if a < batch.num_rows:
            yield batch.slice(a)
    tidy()


def encode(docs: DataFrame, path: str, output: str = "input_ids", decoded: str | None = None) -> DataFrame:
    """docs with the ids of each text, and, where a name for it is given, the text that they decode to."""
    names = [output, *([decoded] if decoded else [])]
    rest = docs.drop(*names)
    at = rest.columns.index("text")
    kinds = [T.ArrayType(T.IntegerType()), T.StringType()]
    schema = T.StructType([*rest.schema.fields, *[T.StructField(n, k) for n, k in zip(names, kinds, strict=False)]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, at):
            ids = machine(path).encode_many([x or "" for x in batch.column(at).to_pylist()])
            flat = pa.array(np.concatenate(ids).astype(np.int32)) if ids else pa.array([], pa.int32())
            ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            made = [pa.ListArray.from_arrays(pa.array(ends), flat), *([pa.array(machine(path).decode_many(ids), pa.string())] if decoded else [])]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*batch.schema.names, *names])

    return rest.mapInArrow(run, schema)


def decode(rows: DataFrame, path: str, column: str = "input_ids", output: str = "decoded") -> DataFrame:
    """rows with the text of each array of ids."""
    rest = rows.drop(output)
    at = rest.columns.index(column)
    schema = T.StructType([*rest.schema.fields, T.StructField(output, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                texts = machine(path).decode_many([np.array(x or [], np.int32) for x in part.column(at).to_pylist()])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, output])

    return rest.mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_crc32, n_chars_decoded, decoded_sha256, same) of each document: encoded, decoded from the ids and compared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, 1):
            texts = [x or "" for x in batch.column(1).to_pylist()]
            ids = machine(path).encode_many(texts)
            decoded = machine(path).decode_many(ids)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "n_tokens": pa.array([len(x) for x in ids], pa.int64()), "ids_crc32": pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64()), "decoded": pa.array(decoded, pa.string()), "same": pa.array([a == b.replace(SPACE, " ") for a, b in zip(decoded, texts, strict=True)], pa.bool_())})

    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_tokens long, ids_crc32 long, decoded string, same boolean")
    return out.select("doc_id", "n_tokens", "ids_crc32", F.length("decoded").cast("long").alias("n_chars_decoded"), F.sha2(F.encode("decoded", "utf-8"), 256).alias("decoded_sha256"), "same")
