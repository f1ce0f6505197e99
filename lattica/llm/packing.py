"""Token sequences packed by Karmarkar-Karp multiway differencing.

Documents are tokenised and cut: whole windows first, what remains into pieces
of at most ``piece`` ids.  The pieces of a block of documents are divided over
as many windows as their ids need; differencing makes the windows near equal,
and the number of windows rises while one exceeds the capacity.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kk
from .common import arrow_rows

#: Bytes of text tokenised at once; words that a worker remembers; windows, and pieces, that fill a block.
CHUNK_BYTES, CACHE_WORDS, BLOCK_WINDOWS, BLOCK_PIECES = 3_000_000, 350_000, 128, 16_384
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class WordTokenizer:
    """Ids of a tokenizer whose pre-tokens never reach over white space, a word at a time.

    Texts are lowered (A-Z) and cut at white space and behind each ASCII letter
    that ASCII punctuation follows, where the tokenizer cuts too.  A word of
    ASCII letters goes to the tokenizer's model, other printable ASCII through
    its pattern first, every other word through the whole tokenizer.  Words are
    remembered, up to a bound.  A text that may hold a special token's string
    goes through the whole tokenizer as it is.
    """

    #: The tokenizer's own pre-token pattern, for ASCII text.
    PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+", re.ASCII)
    PLAIN = re.compile(r"[!-~]+")
    CUT = r"([a-z])([!-/:-@\[-`{-~])"

    def __init__(self, path: str, end: int):
        from tokenizers import Tokenizer

        self.end = end
        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        # word 0 is the end of a text
        self.flat = np.array([self.end], np.uint32)
        self.first = np.zeros(1, np.int32)
        self.size = np.ones(1, np.int32)

    def _learn(self, words: list[str]) -> None:
        tokenize, parts, plain = self.model.tokenize, self.PARTS.findall, self.PLAIN.fullmatch
        letters = [w for w in words if w.isascii() and w.isalpha()]
        others = [w for w in words if not (w.isascii() and w.isalpha())]
        printed = [w for w in others if w.isascii() and plain(w)]
        rest = [w for w in others if not (w.isascii() and plain(w))]
        ids = [[t.id for t in tokenize(w)] for w in letters]
        ids += [[t.id for p in parts(w) for t in tokenize(p)] for w in printed]
        ids += [e.ids for e in self.whole.encode_batch_fast(rest, add_special_tokens=False)]
        at = len(self.size)
        self.known.update(zip(letters + printed + rest, range(at, at + len(ids)), strict=True))
        size = np.fromiter(map(len, ids), np.int32, len(ids))
        self.first = np.concatenate([self.first, len(self.flat) + np.cumsum(size, dtype=np.int32) - size])
        self.size = np.concatenate([self.size, size])
        self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(ids), np.uint32, int(size.sum()))])

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, the end id behind each, one after another; and where each text's ids begin and end (n + 1 places)."""
        texts = pc.fill_null(texts, "")
        special = pc.match_substring(texts, "<|").to_numpy(zero_copy_only=False)
        if special.any():
            return self._mixed(texts, special)
        split = pc.ascii_split_whitespace(pc.replace_substring_regex(pc.ascii_lower(texts), self.CUT, r"\1 \2"))
        words = split.flatten().dictionary_encode()
        if len(self.known) > CACHE_WORDS:
            self.clear()
        names = words.dictionary.to_pylist()
        at = list(map(self.known.get, names))
        if None in at:
            self._learn([w for w, i in zip(names, at, strict=True) if i is None])
            at = list(map(self.known.__getitem__, names))
        which = np.array(at, np.int32)[words.indices.to_numpy(zero_copy_only=False)]
        counts = pc.list_value_length(split).to_numpy(zero_copy_only=False)
        which = np.insert(which, np.cumsum(counts), 0)
        lengths = self.size[which]
        ends = np.cumsum(lengths, dtype=np.int32)
        ids = self.flat[np.repeat(self.first[which] - ends + lengths, lengths) + np.arange(ends[-1], dtype=np.int32)]
        return ids, np.concatenate([[0], ends[np.cumsum(counts + 1) - 1]])

    def _mixed(self, texts: pa.Array, special: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        parts = []
        for i, whole in enumerate(special.tolist()):
            one = texts.slice(i, 1)
            parts.append(np.array([*self.whole.encode(one[0].as_py(), add_special_tokens=False).ids, self.end], np.uint32) if whole else self(one)[0])
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])


def chunks(texts: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """Slices of about ``size`` bytes, each with its first place."""
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(lengths) // size
    cuts = np.flatnonzero(np.diff(part)) + 1
    for a, b in zip([0, *cuts], [*cuts, len(texts)], strict=True):
        if b > a:
            yield int(a), texts.slice(a, b - a)


class Packer:
    """Gathers pieces and gives back rows of packed windows."""

    def __init__(self, capacity: int, piece: int, base: int):
        self.capacity, self.piece, self.next = capacity, piece, base
        self.out: list[tuple] = []
        self.pieces: list[tuple] = []
        self.ids = 0

    def add(self, doc_id, ids: np.ndarray) -> None:
        total, at = len(ids), 0
        while total - at >= self.capacity:
            self.out.append((doc_id, at, self.capacity, zlib.crc32(ids[at : at + self.capacity]), total, self.next, 0))
            self.next += 1
            at += self.capacity
        while at < total:
            n = min(self.piece, total - at)
            self.pieces.append((doc_id, at, n, zlib.crc32(ids[at : at + n]), total))
            self.ids += n
            at += n
        if self.ids >= BLOCK_WINDOWS * self.capacity or len(self.pieces) >= BLOCK_PIECES:
            self.flush()

    def flush(self) -> None:
        if not self.pieces:
            return
        sizes = np.array([p[2] for p in self.pieces], np.int64)
        windows = -(-self.ids // self.capacity)
        while True:
            place, loads = kk.items(sizes, windows)
            if loads[0] <= self.capacity:
                break
            windows += 1
        filled = np.zeros(windows, np.int64)
        for p, w in zip(self.pieces, place.tolist(), strict=True):
            self.out.append((*p, self.next + w, int(filled[w])))
            filled[w] += p[2]
        self.next += windows
        self.pieces, self.ids = [], 0

    def take(self) -> pa.RecordBatch:
        columns = list(zip(*self.out, strict=True)) or [()] * 7
        self.out = []
        names = [f.split()[0] for f in SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)


def pack(docs: DataFrame, encoder: Callable[[], Callable], capacity: int = 2048, piece: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack every document's ids, with an end id behind them, into windows of ``capacity`` ids.

    ``encoder`` is called once in each worker and gives a function from an
    Arrow array of texts to (ids with end ids, bounds).  One row a piece: doc_id, start,
    length, ids_crc32, doc_tokens, sequence_id, offset.  A null or empty text
    is the one end id.  A null id stays null; rows that repeat an id are
    packed each by itself.  No rows in: no rows out.  Other columns are not read.
    No shuffle: a block is part of an input partition, so a task that is run
    again over the same partition gives the same rows.
    """
    arrow_rows(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = encoder()
        packer = Packer(capacity, piece, (TaskContext.get().partitionId() if TaskContext.get() else 0) << 36)
        for batch in batches:
            names, texts = batch.column(0).to_pylist(), batch.column(1)
            for a, part in chunks(texts):
                ids, bounds = encode(part)
                for i in range(len(part)):
                    packer.add(names[a + i], ids[bounds[i] : bounds[i + 1]])
            if len(packer.out) >= 5000:
                yield packer.take()
        packer.flush()
        yield packer.take()

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, SCHEMA)


@lru_cache(maxsize=1)
def _tokenizer(path: str, end: int) -> WordTokenizer:
    """One for each worker process, so that its words last from task to task."""
    return WordTokenizer(path, end)


def word_bpe(path: str, end: int = 1) -> Callable[[], WordTokenizer]:
    """An encoder for ``pack``: the tokenizer file at ``path``, which every worker can read, and the end id."""
    return lambda: _tokenizer(path, end)
