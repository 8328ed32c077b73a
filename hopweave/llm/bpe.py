"""Problem 8: the token ids of a public byte-level BPE tokenizer for a whole corpus.

Method: the vocabulary's byte strings, read as Latin-1, form one Aho-Corasick
automaton.  A piece of text takes at each place the longest token that starts there;
a token may follow another only if merging the two tokens' bytes gives just these two
tokens (memoised), else the next shorter token is tried, else the last token is taken
back.  A sequence whose neighbours all fit is the one that the merges produce, and
every place is given up at most once, so the time is linear in the piece.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from pathlib import Path

import ahocorasick
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed value: how the tokenizer cuts text into pieces before merging.
PIECES = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Where the vocabulary lies unless the caller names another place.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: A vocabulary file is broadcast; a larger one is refused.
MAX_VOCABULARY_BYTES = 64 << 20
#: Pieces that a worker remembers, and the longest that it does; older ones are encoded again.
CACHED_PIECES, CACHED_LENGTH = 400_000, 48
#: Pairs of tokens of which a worker remembers whether they stay apart.
CACHED_PAIRS = 1_000_000
#: Ids in one batch of results.
BATCH_IDS = 2_000_000


class Coder:
    """Encodes text by ranks in the format of one base64 byte string and one rank a line."""

    def __init__(self, ranks: bytes):
        pairs = (line.split() for line in ranks.splitlines() if line.strip())
        self.rank = {base64.b64decode(token).decode("latin-1"): int(r) for token, r in pairs}
        self.text = {r: t for t, r in self.rank.items()}
        self.cut = regex.compile(PIECES)
        self.machine = ahocorasick.Automaton()
        for t, r in self.rank.items():
            self.machine.add_word(t, (r, len(t)))
        self.machine.make_automaton()
        self._fits: dict[tuple[int, int], bool] = {}
        self._shorter: dict[int, int | None] = {}
        self._pieces: dict[str, list[int]] = {}

    def merged(self, data: str) -> list[int]:
        """What the merges make of ``data``, by their definition; for short strings."""
        parts = list(data)
        rank = self.rank
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: rank.get(parts[i] + parts[i + 1], 1 << 40))
            if parts[best] + parts[best + 1] not in rank:
                break
            both = parts[best] + parts[best + 1]
            # All occurrences of the pair merge before any pair of higher rank.
            out, i, left, right = [], 0, parts[best], parts[best + 1]
            while i < len(parts):
                if i + 1 < len(parts) and parts[i] == left and parts[i + 1] == right:
                    out.append(both)
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        return [rank[p] for p in parts]

    def fits(self, left: int, right: int) -> bool:
        """Whether the two tokens stay apart where their bytes meet."""
        known = self._fits.get((left, right))
        if known is None:
            if len(self._fits) >= CACHED_PAIRS:
                self._fits.clear()
            known = self._fits[left, right] = self.merged(self.text[left] + self.text[right]) == [left, right]
        return known

    def shorter(self, token: int) -> int | None:
        """The longest token that is a proper prefix of ``token``."""
        if token not in self._shorter:
            t = self.text[token]
            self._shorter[token] = next((self.rank[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in self.rank), None)
        return self._shorter[token]

    def piece(self, piece: str) -> list[int]:
        data = piece.encode("utf-8").decode("latin-1")
        size = len(data)
        longest = [0] * size
        for end, (token, length) in self.machine.iter(data):
            longest[end - length + 1] = token
        dead = bytearray(size + 1)
        taken: list[int] = []
        at, token = 0, longest[0]
        while at < size:
            end = at + len(self.text[token])
            if not dead[end] and (not taken or self.fits(taken[-1], token)):
                taken.append(token)
                at = end
                token = longest[at] if at < size else 0
                continue
            less = self.shorter(token)
            while less is None:
                dead[at] = 1
                token = taken.pop()
                at -= len(self.text[token])
                less = self.shorter(token)
            token = less
        return taken

    def encode(self, text: str) -> list[int]:
        ids: list[int] = []
        known = self._pieces
        for p in self.cut.findall(text):
            got = known.get(p)
            if got is None:
                got = self.piece(p)
                if len(p) <= CACHED_LENGTH:
                    if len(known) >= CACHED_PIECES:
                        known.clear()
                    known[p] = got
            ids += got
        return ids

    def decode(self, ids: list[int]) -> str:
        return "".join(self.text[i] for i in ids).encode("latin-1").decode("utf-8")


_coders: dict[int, Coder] = {}


class SharedRanks:
    """A vocabulary file, broadcast; each worker builds its coder once."""

    def __init__(self, spark: SparkSession, path: str):
        if Path(path).stat().st_size > MAX_VOCABULARY_BYTES:
            raise ValueError(f"{path} is too large to be a vocabulary")
        data = Path(path).read_bytes()
        self.broadcast = spark.sparkContext.broadcast(data)
        self.digest = xxhash.xxh64_intdigest(data)

    def coder(self) -> Coder:
        if self.digest not in _coders:
            _coders.clear()
            _coders[self.digest] = Coder(self.broadcast.value)
        return _coders[self.digest]


def encode_corpus(documents: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """``key`` and ``ids``: the token ids of every row's text, without special tokens.

    Strings that spell special tokens are ordinary text.  A null and an empty text give
    an empty list; further columns are not read.  One row comes out for every row.
    """
    shared = SharedRanks(documents.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = shared.coder()

        def made(keys: list, ids: list[int], ends: list[int]) -> pa.RecordBatch:
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
            return pa.RecordBatch.from_arrays([pa.array(keys, kind), lists], names=[key, "ids"])

        for batch in batches:
            kind = batch.schema.field(0).type
            keys, ids, ends = [], [], [0]
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if t:
                    ids += coder.encode(t)
                keys.append(k)
                ends.append(len(ids))
                if len(ids) > BATCH_IDS:
                    yield made(keys, ids, ends)
                    keys, ids, ends = [], [], [0]
            if keys:
                yield made(keys, ids, ends)

    return documents.select(key, text).mapInArrow(run, f"`{key}` {documents.schema[key].dataType.simpleString()}, ids array<int>")


def count_tokens(documents: DataFrame, keep: list[str], text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """The columns of ``keep`` and ``tokens``, the number of token ids of each row's text; 0 for null."""
    shared = SharedRanks(documents.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = shared.coder()
        for batch in batches:
            sizes = [len(coder.encode(t)) if t else 0 for t in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sizes, pa.int64())], names=[*batch.schema.names[:-1], "tokens"])

    kinds = ", ".join(f"`{c}` {documents.schema[c].dataType.simpleString()}" for c in keep)
    return documents.select(*keep, F.col(text).alias("__text")).mapInArrow(run, f"{kinds}, tokens bigint")
