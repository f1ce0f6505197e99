"""SentencePiece encoding, decoding and N-best segmentation.

A text is a lattice of pieces.  Forward Viterbi scores are the exact remaining
cost of a path that is built from the end, so they serve as the heuristic of a
backward A-star search, which gives the best segmentations in order.

Where no piece of the vocabulary holds two characters side by side, every path
is cut between them.  The lattice thus falls into short parts, most of which
recur; a text's segmentations are those of its parts combined, best sums first.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows
from .packing import chunks

#: Parts that a worker remembers; length from which a part is solved by itself.
CACHE_PARTS, LONG = 400_000, 48
SPACE = "▁"
BASE = np.uint64(0x9E3779B97F4A7C15)
SPREAD = [np.uint64(2 * x + 1) for x in (0x2545F4914F6CDD1D, 0x1B873593CC9E2D51, 0x3C79AC492BA7B653, 0x1D8E4E27C47D124F, 0x27D4EB2F165667C5, 0x165667B19E3779F9, 0x0E5D1F3A7B9C4D21, 0x5851F42D4C957F2D)]
SCHEMA = "doc_id long, rank int, score double, n_pieces long, ids_crc32 long"


class Pieces:
    """A model's pieces and scores; characters without a piece fall back to their bytes."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.text = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        plain = [i for i in range(len(self.text)) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.is_byte(i))]
        self.bytes = {int(self.text[i][3:5], 16): i for i in range(len(self.text)) if sp.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.unknown = sp.unk_id()
        self.ids = {self.text[i]: i for i in plain}
        self.scores = {self.text[i]: float(sp.get_score(i)) for i in plain}
        finite = [s for s in self.scores.values() if s > -1e8]
        #: As in the library: a character without a piece costs ten more than the rarest piece.
        self.missing = min(finite) - 10.0
        self.longest = max(map(len, self.ids))
        self._tabulate()
        pairs = {(a, b) for p in self.ids for a, b in zip(p, p[1:], strict=False)}
        chars = sorted({c for ab in pairs for c in ab})
        self.index = np.zeros(0x110000, np.int16)
        for i, c in enumerate(chars):
            self.index[ord(c)] = i + 1
        self.inside = np.zeros((len(chars) + 1, len(chars) + 1), bool)
        for a, b in pairs:
            self.inside[self.index[ord(a)], self.index[ord(b)]] = True

    def _tabulate(self) -> None:
        """Open tables of the pieces' hashes, so that many substrings are looked up at once."""
        with np.errstate(over="ignore"):
            full = []
            for p in self.ids:
                h = np.uint64(0)
                for c in p:
                    h = h * BASE + np.uint64(ord(c) + 1)
                full.append(h)
            self.full = np.array([*full, 0], np.uint64)
            self.piece_id = np.array([*self.ids.values(), -1], np.int64)
            self.piece_score = np.array([*self.scores.values(), -np.inf])
            left, self.tables = np.arange(len(full)), []
            for turn in range(8):
                table = np.full(1 << 20, len(full), np.int32)
                at = ((self.full[left] * SPREAD[turn]) >> np.uint64(44)).astype(np.int64)
                table[at] = left
                self.tables.append(table)
                left = left[table[at] != left]
                if not len(left):
                    break

    def look_up(self, h: np.ndarray) -> np.ndarray:
        """Place of each hash's piece, the last place where there is none."""
        with np.errstate(over="ignore"):
            none = len(self.full) - 1
            got = np.full(len(h), none, np.int32)
            for turn, table in enumerate(self.tables):
                at = table[((h * SPREAD[turn]) >> np.uint64(44)).astype(np.int64)]
                got = np.where(self.full[at] == h, at, got)
            return got

    def emitted(self, piece: str) -> list[int]:
        got = self.ids.get(piece)
        if got is not None:
            return [got]
        return [self.bytes.get(b, self.unknown) for b in piece.encode("utf-8", "surrogatepass")]

    def edge(self, piece: str) -> float | None:
        """Score of an edge over ``piece``, None if there is none."""
        got = self.scores.get(piece)
        return self.missing if got is None and len(piece) == 1 else got

    def decode(self, ids) -> str:
        """The text of a sequence of ids."""
        out, run = [], bytearray()
        for i in ids:
            if i in self.byte_of:
                run.append(self.byte_of[i])
                continue
            if run:
                out.append(run.decode("utf-8", "replace"))
                run.clear()
            out.append(self.text[i])
        if run:
            out.append(run.decode("utf-8", "replace"))
        text = "".join(out).replace(SPACE, " ")
        return text[1:] if text.startswith(" ") else text


def forward(m: Pieces, part: str) -> np.ndarray:
    """Best score from the start to each place."""
    best = np.full(len(part) + 1, -np.inf)
    best[0] = 0.0
    for j in range(1, len(part) + 1):
        for i in range(max(0, j - m.longest), j):
            s = m.edge(part[i:j])
            if s is not None and best[i] + s > best[j]:
                best[j] = best[i] + s
    return best


def nbest(m: Pieces, part: str, n: int) -> list[tuple[float, list[int]]]:
    """Up to ``n`` best segmentations of a part, best first: (score, ids).

    From the end backwards: a partial path's rank is its own score plus the
    forward score of the place it has reached, which is what the best completion
    adds, so the first ``n`` paths to reach the start are the best.
    """
    if not part:
        return [(0.0, [])]
    ahead = forward(m, part).tolist()
    heap: list = [(-ahead[-1], 0, len(part), 0.0, None)]
    out, count = [], 0
    while heap and len(out) < n:
        _, _, at, score, path = heapq.heappop(heap)
        if at == 0:
            ids = []
            while path is not None:
                piece, path = path
                ids += m.emitted(piece)
            out.append((score, ids))
            continue
        for i in range(max(0, at - m.longest), at):
            s = m.edge(part[i:at])
            if s is not None:
                count += 1
                heapq.heappush(heap, (-(score + s + ahead[i]), count, i, score + s, (part[i:at], path)))
    return out


class Segmenter:
    """N-best segmentations of texts, a chunk at a time."""

    def __init__(self, model: Pieces, n: int):
        self.m, self.n = model, n
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.ways: dict[str, list] = {}
        self.flat = np.empty(0, np.uint32)
        self.first, self.size = np.empty(0, np.int64), np.empty(0, np.int64)
        self.score, self.gap = np.empty(0), np.empty(0)

    def _learn(self, parts: list[str]) -> None:
        """Best ids and score of new parts, and how far behind the second best is."""
        m, by_length = self.m, {}
        for p in parts:
            by_length.setdefault(len(p), []).append(p)
        order, ids, score, gap = [], [], [], []
        for length, group in by_length.items():
            if length > LONG:
                for p in group:
                    ways = nbest(m, p, 2)
                    order.append(p)
                    ids.append(ways[0][1])
                    score.append(ways[0][0])
                    gap.append(ways[0][0] - ways[1][0] if len(ways) > 1 else np.inf)
                continue
            n = len(group)
            codes = np.frombuffer("".join(group).encode("utf-32-le"), np.uint32).reshape(n, length).T.astype(np.uint64) + np.uint64(1)
            one, two = np.full((length + 1, n), -np.inf), np.full((length + 1, n), -np.inf)
            back, last = np.zeros((length + 1, n), np.int16), np.full((length + 1, n), -1, np.int64)
            one[0] = 0.0
            for i in range(length):
                h = np.zeros(n, np.uint64)
                for j in range(i + 1, min(length, i + m.longest) + 1):
                    h = h * BASE + codes[j - 1]
                    at = m.look_up(h)
                    s = m.piece_score[at]
                    if j == i + 1:
                        s = np.where(np.isneginf(s), m.missing, s)
                    a, b = one[i] + s, two[i] + s
                    better = a > one[j]
                    two[j] = np.maximum(two[j], np.where(better, np.maximum(one[j], b), a))
                    back[j][better] = i
                    last[j][better] = m.piece_id[at[better]]
                    one[j] = np.maximum(one[j], a)
            order += group
            score += one[length].tolist()
            with np.errstate(invalid="ignore"):
                gap += np.where(np.isneginf(two[length]), np.inf, one[length] - two[length]).tolist()
            # paths from the end, all parts at once
            here, rows, steps = np.full(n, length), np.arange(n), []
            while here.any():
                steps.append(np.where(here > 0, last[here, rows], -2))
                here = np.where(here > 0, back[here, rows], 0)
            paths = np.array(steps[::-1], np.int64).T
            bytewise = (paths == -1).any(1)
            for p, path, odd in zip(group, paths.tolist(), bytewise.tolist(), strict=True):
                ids.append(nbest(m, p, 1)[0][1] if odd else [x for x in path if x != -2])
        at = len(self.size)
        self.known.update(zip(order, range(at, at + len(order)), strict=True))
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        self.first = np.concatenate([self.first, len(self.flat) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.flat = np.concatenate([self.flat, np.array([x for i in ids for x in i], np.uint32)])
        self.score, self.gap = np.concatenate([self.score, score]), np.concatenate([self.gap, gap])

    def parts(self, texts: list[str]) -> tuple[pa.Array, np.ndarray]:
        """All parts of the texts (each begun by a space) one after another, and where each text's parts begin and end."""
        whole = [SPACE + t.replace(" ", SPACE) if t else "" for t in texts]
        lengths = np.array([len(t) for t in whole], np.int64)
        big = "".join(whole)
        points = np.frombuffer(big.encode("utf-32-le"), np.uint32)
        if not len(points):
            return pa.array([], pa.string()), np.zeros(len(texts) + 1, np.int64)
        at = self.m.index[points]
        cut = np.concatenate([[True], ~self.m.inside[at[:-1], at[1:]], [True]])
        ends = np.concatenate([[0], np.cumsum(lengths)])
        cut[ends] = True
        width = 1 + (points >= 0x80) + (points >= 0x800).astype(np.int8) + (points >= 0x10000)
        offsets = np.concatenate([[0], np.cumsum(width)])[cut].astype(np.int32)
        data = pa.py_buffer(big.encode("utf-8"))
        bounds = np.cumsum(cut)[ends] - 1
        return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), data), bounds

    def _ways(self, part: str) -> list:
        got = self.ways.get(part)
        if got is None:
            if len(self.ways) > CACHE_PARTS // 4:
                self.ways.clear()
            got = self.ways[part] = nbest(self.m, part, self.n)
        return got

    def __call__(self, texts: list[str]) -> Iterator[list[tuple[float, np.ndarray]]]:
        """For each text its segmentations, best first: (score, ids)."""
        parts, bounds = self.parts(texts)
        coded = parts.dictionary_encode()
        names = coded.dictionary.to_pylist()
        if len(self.known) > CACHE_PARTS:
            self.clear()
        at = list(map(self.known.get, names))
        if None in at:
            self._learn([p for p, i in zip(names, at, strict=True) if i is None])
            at = list(map(self.known.__getitem__, names))
        which = np.array(at, np.int64)[coded.indices.to_numpy(zero_copy_only=False)] if names else np.zeros(0, np.int64)
        lengths = self.size[which]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        ids = self.flat[np.repeat(self.first[which] - ends[:-1], lengths) + np.arange(ends[-1])]
        gaps, scores = self.gap[which], self.score[which]
        codes = coded.indices.to_numpy(zero_copy_only=False) if names else which
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            own = ids[ends[a] : ends[b]]
            best = float(scores[a:b].sum())
            out = [(best, own)]
            g = gaps[a:b]
            k = min(self.n - 1, b - a)
            if k:
                # a segmentation among the n best changes only parts whose second best is among the n - 1 nearest, ties to earlier parts
                limit = np.partition(g, k - 1)[k - 1]
                near = np.flatnonzero(g < limit)
                near = np.concatenate([near, np.flatnonzero(g == limit)[: k - len(near)]])
                near = near[np.isfinite(g[near])]
                near = near[np.argsort(g[near], kind="stable")].tolist()
                ways = [self._ways(names[codes[a + i]]) for i in near]
                for cost, choice in _cheapest([[w[0][0] - x[0] for x in w] for w in ways], self.n)[1:]:
                    changed = sorted((near[i], ways[i][c][1]) for i, c in enumerate(choice) if c)
                    pieces, last = [], ends[a]
                    for i, new in changed:
                        pieces += [ids[last : ends[a + i]], np.array(new, np.uint32)]
                        last = ends[a + i + 1]
                    out.append((best - cost, np.concatenate([*pieces, ids[last : ends[b]]])))
            yield out


def _cheapest(costs: list[list[float]], n: int) -> list[tuple[float, tuple[int, ...]]]:
    """The ``n`` cheapest ways to choose one of each list (each rising from 0)."""
    start = (0,) * len(costs)
    heap, seen, out = [(0.0, start)], {start}, []
    while heap and len(out) < n:
        cost, choice = heapq.heappop(heap)
        out.append((cost, choice))
        for i, c in enumerate(choice):
            if c + 1 < len(costs[i]):
                new = (*choice[:i], c + 1, *choice[i + 1 :])
                if new not in seen:
                    seen.add(new)
                    heapq.heappush(heap, (cost - costs[i][c] + costs[i][c + 1], new))
    return out


@lru_cache(maxsize=1)
def _segmenter(path: str, n: int) -> Segmenter:
    """One for each worker process, so that its parts last from task to task."""
    return Segmenter(Pieces(path), n)


def segmentations(docs: DataFrame, path: str, n: int = 4, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """The ``n`` best segmentations of every whole text.

    ``path``: the model file, which every worker can read.  One row for each
    document and rank (from 1): doc_id, rank, score (sum of piece scores),
    n_pieces, ids_crc32 (unsigned, little-endian unsigned 32-bit ids), and with
    ``with_ids`` the ids.  Fewer rows where a text has fewer segmentations; a null
    or empty text has one, of no pieces.  Of equal scores those come first that
    change earlier parts.  Repeated rows are segmented each by itself, a null id
    stays null; no rows in: no rows out.  Other columns are not read.
    """
    arrow_rows(docs.sparkSession)
    schema = SCHEMA + (", ids array<int>" if with_ids else "")

    def run(batches):
        solve = _segmenter(path, n)
        names = [f.split()[0] for f in schema.split(", ")]
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for a, part in chunks(batch.column(1)):
                rows: list[list] = [[] for _ in names]
                for i, ways in enumerate(solve([t or "" for t in part.to_pylist()])):
                    for rank, (score, got) in enumerate(ways, 1):
                        values = [ids[a + i], rank, score, len(got), zlib.crc32(np.ascontiguousarray(got, "<u4")), *([got.astype(np.int32)] if with_ids else [])]
                        for column, v in zip(rows, values, strict=True):
                            column.append(v)
                kinds = [pa.int64(), pa.int32(), pa.float64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=False)], names)

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """``encoded`` with the text of its ids; null ids give a null text."""
    schema = encoded.drop(text_col).schema.add(text_col, "string")
    at = encoded.drop(text_col).columns.index(ids_col)

    def run(batches):
        m = Pieces(path)
        for batch in batches:
            texts = [None if x is None else m.decode(x) for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [f.name for f in schema])

    return encoded.drop(text_col).mapInArrow(run, schema)
