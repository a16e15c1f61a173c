"""N-best segmentation of whole texts over a SentencePiece vocabulary, and its inverse.

The lattice of a text has an arc for every piece that occurs in it, weighted with the
piece's score, and one for each character that no piece covers (its bytes, if the
vocabulary has byte pieces, at a score below all others). The forward pass (Viterbi)
gives the best score of every prefix; a backward A* search from the end uses these as its
heuristic. As they are exact, every state taken from the queue lies on a path at least as good as
all that remain, and complete paths come out in order of their scores.

No piece spans a blank after a non-blank, so a text's lattice is a chain of small ones, one for each
word with its blanks, and the best path is that of the parts. An alternative of the text
changes at least one part; what the cheapest change of a part costs is known from its
forward and backward scores. So the N best paths of a text differ from the best one only in the N - 1
parts with the cheapest changes (a tie goes to the earlier part): A* runs on those. A
vocabulary that has pieces across blanks gets one lattice for each text.

Forward and backward passes run over many parts at a time, as arrays; a task remembers the parts
it has seen in a table of bounded size, and of the texts at hand the numbers of their parts.

Null and empty texts have no pieces, score 0 and one (empty) segmentation. Decoding gives back
the text, except that the blank mark U+2581 in a text becomes a blank, as in the library.
Repeated rows give repeated results; empty tables give empty ones.
"""

from __future__ import annotations

import bisect
import heapq
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
from pyspark.sql import DataFrame, functions as F

from longform.llm.shipping import ship
from longform.llm.workers import enter
from longform.llm.wordhash import BASE, U, mix

BLANK = "▁"
SLOTS = 1 << 18
#: Parts remembered by a task, and characters of a part that still goes through the arrays.
REMEMBERED = 300_000
ARRAY_CHARS = 48
PARTS_AT_ONCE, CHARS_AT_ONCE = 1024, 1 << 14
#: Characters of the texts that are in hand at a time.
TEXT_CHARS = 500_000
LOW = -1e30


class _Numbers(dict):
    """A number for each different key, in order of arrival."""

    def __missing__(self, key: str) -> int:
        self[key] = number = len(self)
        return number


class Lattice:
    """Pieces and scores of a model, and searches over the lattices of texts."""

    def __init__(self, model_file: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        ids = range(model.get_piece_size())
        self.piece = [model.id_to_piece(i) for i in ids]
        plain = [i for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        self.byte_id = {int(self.piece[i][3:5], 16): i for i in ids if model.is_byte(i)}
        self.unknown_id = model.unk_id()
        self.id_of = {self.piece[i]: i for i in plain}
        self.score_of = np.array([model.get_score(i) for i in ids])
        self.unknown_score = float(min((self.score_of[i] for i in plain), default=0.0)) - 10.0
        self.longest = max((len(self.piece[i]) for i in plain), default=1)
        self.splits = not any(re.search(f"[^{BLANK}]{BLANK}", p) or ("\n" in p and len(p) > 1) for p in self.id_of)
        self.raw = [bytes([int(p[3:5], 16)]) if i in set(self.byte_id.values()) else p.encode() for i, p in enumerate(self.piece)]
        self._fill_slots()
        self._known = _Numbers()
        self._forget()

    # -- pieces by hash -------------------------------------------------------------

    def _fill_slots(self) -> None:
        """An open table from the hash of a piece to its id."""
        self._slot_hash, self._slot_id = np.zeros(SLOTS, U), np.full(SLOTS, -1, np.int32)
        self._reach = 1
        for piece, i in self.id_of.items():
            h = int(self._hash_of(piece))
            at, step = h & (SLOTS - 1), 1
            while self._slot_id[at] >= 0:
                at, step = (at + 1) & (SLOTS - 1), step + 1
            self._slot_hash[at], self._slot_id[at] = h, i
            self._reach = max(self._reach, step)

    @staticmethod
    def _hash_of(piece: str) -> np.uint64:
        total = 0
        for k, c in enumerate(mix(np.array([ord(x) for x in piece], U), 5).tolist()):
            total = (total + c * pow(BASE, k, 2**64)) % 2**64
        return mix(np.array([total], U), len(piece))[0]

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        out = np.full(len(hashes), -1, np.int32)
        at = (hashes & U(SLOTS - 1)).astype(np.int64)
        for _ in range(self._reach):
            hit = self._slot_hash[at] == hashes
            out[hit] = self._slot_id[at[hit]]
            at = (at + 1) & (SLOTS - 1)
        return out

    # -- one part at a time ---------------------------------------------------------

    def arcs(self, part: str) -> list[list[tuple[int, float, int]]]:
        """For every end place: (start, score, id) of the arcs that end there; id -1 for a character without a piece."""
        out: list[list[tuple[int, float, int]]] = [[] for _ in range(len(part) + 1)]
        for start in range(len(part)):
            for stop in range(start + 1, min(start + self.longest, len(part)) + 1):
                i = self.id_of.get(part[start:stop])
                if i is not None:
                    out[stop].append((start, float(self.score_of[i]), i))
            if part[start] not in self.id_of:
                out[start + 1].append((start, self.unknown_score, -1))
        return out

    def forward(self, arcs: list) -> list[float]:
        best = [0.0] + [LOW] * (len(arcs) - 1)
        for stop in range(1, len(arcs)):
            best[stop] = max((best[start] + score for start, score, _ in arcs[stop]), default=LOW)
        return best

    def search(self, part: str, n: int) -> list[tuple[float, list[int]]]:
        """The n best segmentations of a part, best first, by backward A*; of equal states the one nearer to the start goes first."""
        if not part:
            return [(0.0, [])]
        arcs = self.arcs(part)
        ahead = self.forward(arcs)
        queue, found, tick = [(-ahead[-1], len(part), 0, 0.0, None)], [], 0
        while queue and len(found) < n:
            _, place, _, behind, path = heapq.heappop(queue)
            if place == 0:
                pieces: list[int] = []
                while path is not None:
                    (start, stop, i), path = path
                    pieces += [i] if i >= 0 else self.bytes_of(part[start:stop])
                found.append((behind, pieces))
                continue
            for start, score, i in arcs[place]:
                tick += 1
                heapq.heappush(queue, (-(ahead[start] + behind + score), start, tick, behind + score, ((start, place, i), path)))
        return found

    def bytes_of(self, char: str) -> list[int]:
        return [self.byte_id[b] for b in char.encode("utf-8", "replace")] if self.byte_id else [self.unknown_id]

    # -- many parts at a time ---------------------------------------------------------

    def _forget(self) -> None:
        self._known.clear()
        self._names: list[str] = []
        self._best, self._gap = np.zeros(0), np.zeros(0)
        self._size, self._at, self._ids = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def _solve(self, parts: list[str]):
        """Best score, cost of the cheapest change, and ids of parts of at most ARRAY_CHARS characters."""
        n, width, reach = len(parts), max(map(len, parts)), min(self.longest, max(map(len, parts)))
        codes = np.zeros((n, width), np.uint32)
        sizes = np.fromiter(map(len, parts), np.int64, n)
        codes[np.arange(width) < sizes[:, None]] = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), "<u4")
        power = np.array([pow(BASE, k, 2**64) for k in range(width)], U)
        inverse = np.array([pow(BASE, -k, 2**64) for k in range(width)], U)
        total = np.zeros((n, width + 1), U)
        np.cumsum(mix(codes.astype(U), 5) * power, axis=1, out=total[:, 1:])
        score = np.full((n, width, reach + 1), LOW)
        piece = np.full((n, width, reach + 1), -1, np.int32)
        for k in range(1, reach + 1):
            inside = np.arange(width - k + 1) + k <= sizes[:, None]
            rows, starts = np.nonzero(inside)
            ids = self._find(mix((total[rows, starts + k] - total[rows, starts]) * inverse[starts], k))
            hit = ids >= 0
            rows, starts, ids = rows[hit], starts[hit], ids[hit]
            score[rows, starts, k], piece[rows, starts, k] = self.score_of[ids], ids
        rows, starts = np.nonzero((piece[:, :, 1] < 0) & (np.arange(width) < sizes[:, None]))
        score[rows, starts, 1] = self.unknown_score

        ahead, came = np.full((n, width + 1), LOW), np.zeros((n, width + 1), np.int64)
        ahead[:, 0] = 0
        for stop in range(1, width + 1):
            k = np.arange(1, min(reach, stop) + 1)
            options = ahead[:, stop - k] + score[:, stop - k, k]
            pick = options.argmax(1)
            ahead[:, stop], came[:, stop] = options[np.arange(n), pick], k[pick]
        behind = np.full((n, width + 1), LOW)
        behind[np.arange(n), sizes] = 0
        for start in range(width - 1, -1, -1):
            k = np.arange(1, min(reach, width - start) + 1)
            behind[:, start] = np.maximum(behind[:, start], (behind[:, start + k] + score[:, start, k]).max(1))
        best = ahead[np.arange(n), sizes]

        # the best path, from the end; then the best path that uses another arc somewhere
        place, alive, steps = sizes.copy(), np.arange(n), []
        through = np.full((n, width, reach + 1), LOW)
        for k in range(1, reach + 1):
            through[:, : width - k + 1, k] = ahead[:, : width - k + 1] + score[:, : width - k + 1, k] + behind[:, k:]
        while len(alive):
            k = came[alive, place[alive]]
            start = place[alive] - k
            steps.append((alive, start, k))
            through[alive, start, k] = LOW
            place[alive] = start
            alive = alive[start > 0]
        second = through.reshape(n, -1).max(1)
        gap = np.where(second > LOW / 2, best - second, np.inf)
        row = np.concatenate([s[0] for s in steps])
        start = np.concatenate([s[1] for s in steps])
        k = np.concatenate([s[2] for s in steps])
        order = np.lexsort((start, row))
        row, start, k = row[order], start[order], k[order]
        ids = piece[row, start, k]
        if (ids < 0).any():
            spread = [[int(i)] if i >= 0 else self.bytes_of(parts[r][s]) for r, s, i in zip(row, start, ids, strict=True)]
            row, ids = np.repeat(row, [len(x) for x in spread]), np.array([i for x in spread for i in x], np.int32)
        return best, gap, np.bincount(row, minlength=n), ids

    def _learn(self) -> None:
        """Solve the parts that have a number and no entry yet."""
        start = len(self._names)
        self._names += islice(self._known, start, None)
        new = len(self._names) - start
        if not new:
            return
        order = sorted(range(start, start + new), key=lambda i: len(self._names[i]))
        parts = [self._names[i] for i in order]
        done = []
        short = bisect.bisect_right(parts, ARRAY_CHARS, key=len)
        a = 0
        while a < short:
            stop = min(a + PARTS_AT_ONCE, short)
            stop = min(stop, a + CHARS_AT_ONCE // len(parts[stop - 1]))
            done.append(self._solve(parts[a:stop]))
            a = stop
        for part in parts[short:]:
            two = self.search(part, 2)
            gap = two[0][0] - two[1][0] if len(two) > 1 else np.inf
            done.append(([two[0][0]], [gap], [len(two[0][1])], np.array(two[0][1], np.int32)))
        place = np.empty(new, np.int64)
        place[np.array(order) - start] = np.arange(new)
        size = np.concatenate([d[2] for d in done]).astype(np.int32)
        at = len(self._ids) + np.cumsum(size, dtype=np.int64) - size
        self._best = np.concatenate([self._best, np.concatenate([d[0] for d in done])[place]])
        self._gap = np.concatenate([self._gap, np.concatenate([d[1] for d in done])[place]])
        self._size = np.concatenate([self._size, size[place]])
        self._at = np.concatenate([self._at, at[place]])
        self._ids = np.concatenate([self._ids, *[d[3] for d in done]])

    def _number(self, texts: list) -> list[np.ndarray]:
        """The numbers of each text's parts, all of them solved. The parts themselves are let go text by text."""
        for again in (False, True):
            out, number = [], self._known.__getitem__
            for text in texts:
                parts = self.parts(text) if isinstance(text, str) else ()
                out.append(np.fromiter(map(number, parts), np.int32, len(parts)))
                if not again and len(self._known) > REMEMBERED:
                    break
            else:
                break
            self._forget()
        self._learn()
        return out

    def parts(self, text: str) -> list[str]:
        if not text:
            return []
        marked = BLANK + text.replace(" ", BLANK)
        return re.findall(f"{BLANK}*[^{BLANK}\n]+|{BLANK}+|\n", marked) if self.splits else [marked]

    def segment(self, texts: list, n: int) -> Iterator[list[tuple[float, np.ndarray]]]:
        """For each text its n best segmentations (score, ids), best first; fewer if there are not so many."""
        searched: dict[int, list] = {}
        for where in self._number(texts):
            size = self._size[where]
            upto = np.cumsum(size)
            ids = self._ids[np.arange(int(upto[-1]) if len(upto) else 0) + np.repeat(self._at[where] - (upto - size), size)]
            score, gap = float(self._best[where].sum()), self._gap[where]
            out = [(score, ids)]
            if n > 1:
                cheap = np.argsort(gap, kind="stable")[: n - 1] if len(gap) < 64 else self._cheapest(gap, n - 1)
                paths: list[tuple[float, tuple]] = [(0.0, ())]
                for c in cheap[np.isfinite(gap[cheap])].tolist():
                    k = int(where[c])
                    if k not in searched:
                        own = ids[upto[c] - size[c] : upto[c]].tolist()
                        found = self.search(self._names[k], n)
                        # paths of equal score: the one already taken comes first
                        searched[k] = [(found[0][0], own), *[x for x in found if x[1] != own][: n - 1]]
                    other = searched[k]
                    paths = heapq.nsmallest(
                        n, [(cost + other[0][0] - s, (*path, (c, r)) if r else path) for cost, path in paths for r, (s, _) in enumerate(other)]
                    )
                for cost, path in paths[1:]:
                    cut, last = [], 0
                    for c, r in sorted(path):
                        cut += [ids[last : upto[c] - size[c]], np.array(searched[int(where[c])][r][1], np.int32)]
                        last = upto[c]
                    out.append((score - cost, np.concatenate([*cut, ids[last:]])))
            yield out

    @staticmethod
    def _cheapest(gap: np.ndarray, n: int) -> np.ndarray:
        bound = np.partition(gap, n - 1)[n - 1]
        close = np.flatnonzero(gap <= bound)
        return close[np.argsort(gap[close], kind="stable")[:n]]

    def decode(self, ids) -> str:
        raw = self.raw
        text = b"".join([raw[i] for i in ids]).decode("utf-8", "replace").replace(BLANK, " ")
        return text[1:]


@lru_cache(maxsize=2)
def lattice(model_file: str) -> Lattice:
    """One lattice for each Python worker and model."""
    return Lattice(model_file)


def _slices(sizes: list, chars: int = TEXT_CHARS) -> Iterator[slice]:
    start = held = 0
    for i, size in enumerate(sizes):
        held += size or 0
        if held >= chars:
            yield slice(start, i + 1)
            start, held = i + 1, 0
    if start < len(sizes):
        yield slice(start, len(sizes))


def segmentations(docs: DataFrame, model_file: str, n: int = 4, with_ids: bool = False) -> DataFrame:
    """doc_id, n_pieces, score, ids_crc32 and round_trip of the best segmentation; scores and piece counts of the n best.

    ``with_ids`` adds the ids of the best one. Nothing is shuffled. A task holds a batch of rows as it comes from Spark, and
    the texts, parts and results of ``TEXT_CHARS`` characters (or of one longer text) of it.
    """
    ship(docs.sparkSession)
    schema = "doc_id long, n_pieces long, score double, ids_crc32 long, round_trip boolean, nbest_scores array<double>, nbest_pieces array<long>, nbest_crc32 array<long>"

    def encode(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        def lists(values: list, kind) -> pa.ListArray:
            ends = np.cumsum([0, *map(len, values)], dtype=np.int32)
            flat = np.concatenate([np.zeros(0, kind), *values]).astype(kind, copy=False)
            return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))

        model = lattice(model_file)
        enter("nbest", model._forget)
        for batch in batches:
            names, column = batch.column(0), batch.column(1)
            for rows in _slices(pc.utf8_length(column).to_pylist()):
                texts = column.slice(rows.start, rows.stop - rows.start).to_pylist()
                best, trips, scores, pieces, sums = [], [], [], [], []
                for text, found in zip(texts, model.segment(texts, n), strict=True):
                    best.append(found[0][1] if with_ids else None)
                    trips.append(model.decode(found[0][1].tolist()) == (text or "").replace(BLANK, " "))
                    scores.append([s for s, _ in found])
                    pieces.append([len(ids) for _, ids in found])
                    sums.append([zlib.crc32(ids.astype("<u4").tobytes()) for _, ids in found])
                first = lambda values, kind: pa.array([v[0] for v in values], kind)
                columns = [
                    names.slice(rows.start, rows.stop - rows.start), first(pieces, pa.int64()), first(scores, pa.float64()), first(sums, pa.int64()),
                    pa.array(trips, pa.bool_()), lists(scores, np.float64), lists(pieces, np.int64), lists(sums, np.int64),
                    *([lists(best, np.int32)] if with_ids else []),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[*[f.split()[0] for f in schema.split(", ")], *["ids"] * with_ids])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return source.mapInArrow(encode, schema + ", ids array<int>" * with_ids)
