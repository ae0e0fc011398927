"""Packing of token sequences as vector bins.

Every text becomes token ids and one end id. Full sequences are cut off long texts; what remains are items
with three sizes: tokens, segments (1) and loss-bearing tokens. A sequence has a limit on each. Sequences
are filled one at a time by the dot-product heuristic: among the items that fit, the one whose sizes, each
as a share of its limit, have the largest dot product with what is left of the sequence. If none fits
whole, the beginning of the best one is cut off to fill it. The last, partly filled sequence of a partition
is cut into sequences whose lengths are powers of two, which need no padding.

Packing runs within the partitions of the input and holds ``POOL`` items at a time; no rows are moved.

Defined cases: a null or empty text is its end id; a null key is a key; repeated rows are packed each; an
empty table gives no rows; a prompt length beyond the text, or null, means no loss there, or loss everywhere.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.frames import slices

POOL, CACHE = 2048, 400_000
WIDTH = 4  # bytes of an id


class WordTokenizer:
    """Ids of a tokenizer whose words don't depend on each other, with a memory of words.

    Texts of ASCII and Latin letters are split here, by the same rule as the tokenizer's own (lower case, then
    contractions, runs of letters, single digits, runs of signs); each word's ids come from the tokenizer once.
    Any other text, and one with the string of a control token, goes to the tokenizer as a whole.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        # A control token's string in a text is that token, to the tokenizer; the split below doesn't know it.
        control = [re.escape(t.content) for t in self.whole.get_added_tokens_decoder().values()]
        self.control = re.compile("|".join(control) or r"(?!)", re.I)
        span = [chr(c) for c in range(0xA1, 0x130)]
        letters = "a-z" + "".join(re.escape(c) for c in span if unicodedata.category(c)[0] == "L")
        digits = "0-9" + "".join(re.escape(c) for c in span if unicodedata.category(c)[0] == "N")
        self.plain = re.compile(r"[\t\n\r\x20-\x7e¡-į]*\Z")
        self.word = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{digits}]|[^\s{letters}{digits}]+")
        self.known: dict[str, bytes] = {}
        ends = [k for token, k in self.whole.get_vocab().items() if token.endswith("</w>")]
        self.last = np.zeros(self.whole.get_vocab_size(), bool)
        self.last[ends] = True

    def _ask(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.whole.encode_batch_fast(texts, add_special_tokens=False)]

    def _ask_words(self, words: list[str]) -> list[bytes]:
        """All at once: a word's last id says so."""
        ids = np.array(self.whole.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(words):
            return self._ask(words)
        data = ids.tobytes()
        return [data[a * WIDTH : b * WIDTH] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]

    def ids(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit numbers."""
        split = [self.word.findall(t.lower()) if self.plain.match(t) and not self.control.search(t) else None for t in texts]
        seen: set[str] = set()
        for words in split:
            seen.update(words or ())
        new = list(seen.difference(self.known))
        if len(self.known) + len(new) > CACHE:
            self.known, new = {}, list(seen)
        self.known.update(zip(new, self._ask_words(new) if new else [], strict=True))
        out = [b"" if words is None else b"".join(map(self.known.__getitem__, words)) for words in split]
        other = [k for k, words in enumerate(split) if words is None]
        for k, found in zip(other, self._ask([texts[k] for k in other]), strict=True):
            out[k] = found
        return out


@dataclass(frozen=True)
class Limits:
    """Of a sequence."""

    tokens: int = 2048
    segments: int = 512
    loss: int = 2048


@dataclass
class Item:
    """Part of a text: its first ``free`` tokens bear no loss."""

    key: object
    start: int
    data: bytes
    free: int
    of: int

    @property
    def tokens(self) -> int:
        return len(self.data) // WIDTH

    @property
    def loss(self) -> int:
        return max(0, self.tokens - self.free)

    def cut(self, n: int) -> tuple[Item, Item]:
        head = Item(self.key, self.start, self.data[: n * WIDTH], min(self.free, n), self.of)
        return head, Item(self.key, self.start + n, self.data[n * WIDTH :], max(0, self.free - n), self.of)


class Packer:
    """Takes texts' ids, gives full sequences (lists of items)."""

    def __init__(self, limits: Limits) -> None:
        self.limits = limits
        self.pool: list[Item] = []

    def add(self, item: Item) -> Iterator[list[Item]]:
        while item.tokens >= self.limits.tokens or item.loss > self.limits.loss:
            n = min(item.tokens, self.limits.tokens, item.free + self.limits.loss)
            head, item = item.cut(n)
            if n < self.limits.tokens:
                self.pool.append(head)
            else:
                yield [head]
        if item.tokens:
            self.pool.append(item)
        if len(self.pool) >= POOL:
            yield from self._fill()

    def _fill(self) -> Iterator[list[Item]]:
        """All sequences that the pool fills; what begins one more stays in it."""
        caps = np.array([self.limits.tokens, self.limits.segments, self.limits.loss], float)
        items = self.pool
        sizes = np.array([(x.tokens, 1, x.loss) for x in items], float).reshape(-1, 3)
        shares = sizes / caps
        left, chosen, waiting = caps.copy(), [], np.ones(len(items), bool)
        while waiting.any():
            gain = shares @ (left / caps)
            gain[~(waiting & (sizes <= left).all(axis=1))] = -1
            best = int(np.argmax(gain))
            if gain[best] >= 0:
                chosen.append(items[best])
                left -= sizes[best]
                waiting[best] = False
            elif left[0] >= 1 and left[1] >= 1:  # none fits whole
                gain = shares @ (left / caps)
                gain[~waiting] = -1
                best = int(np.argmax(gain))
                n = int(min(left[0], items[best].free + left[2], items[best].tokens))
                if n:
                    head, items[best] = items[best].cut(n)
                    sizes[best] = (items[best].tokens, 1, items[best].loss)
                    shares[best] = sizes[best] / caps
                    chosen.append(head)
                left[0] = 0
            if left[0] < 1 or left[1] < 1:
                yield chosen
                left, chosen = caps.copy(), []
        self.pool = chosen

    def end(self) -> Iterator[list[Item]]:
        yield from self._fill()
        rest, self.pool = self.pool, []
        total = sum(x.tokens for x in rest)
        for size in (1 << b for b in range(total.bit_length() - 1, -1, -1) if total >> b & 1):
            chosen = []
            while size:
                head, tail = rest[0].cut(min(size, rest[0].tokens))
                size -= head.tokens
                chosen.append(head)
                rest = ([tail] if tail.tokens else []) + rest[1:]
            yield chosen


def pack(
    df: DataFrame, tokenizer: str, end_id: int, key: str = "doc_id", text: str = "text", prompt: str | None = None,
    limits: Limits = Limits(), ids: bool = False,  # noqa: B008
) -> DataFrame:
    """One row per piece: (key, start, length, ids_crc32, doc_tokens, sequence_id, offset), and with ``ids`` the ids.

    tokenizer: path of a tokenizer file that exists on every machine. prompt: a column with the number of a
    text's first tokens that bear no loss.
    """
    rows = df.select(key, text, F.coalesce(F.col(prompt) if prompt else F.lit(0), F.lit(0)).cast("long").alias("free"))
    kind = rows.schema[0].dataType.simpleString()
    schema = f"`{key}` {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, packer = WordTokenizer(tokenizer), Packer(limits)
        number = TaskContext.get().partitionId() << 40

        def out(sequences: list[list[Item]], kind: pa.DataType) -> pa.RecordBatch:
            nonlocal number
            cells: list[tuple] = []
            for chosen in sequences:
                offset = 0
                for x in chosen:
                    cells.append((x.key, x.start, x.tokens, zlib.crc32(x.data), x.of, number, offset, x.data))
                    offset += x.tokens
                number += 1
            columns = list(zip(*cells, strict=True)) or [()] * 8
            arrays = [pa.array(columns[0], kind), *(pa.array(c, pa.int64()) for c in columns[1:7])]
            names = [key, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if ids:
                arrays.append(pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in columns[7]], pa.list_(pa.int32())))
                names.append("ids")
            return pa.RecordBatch.from_arrays(arrays, names=names)

        kind = pa.int64()
        for part in slices(batches, 1):
            kind = part.column(0).type
            done: list[list[Item]] = []
            found = words.ids([x or "" for x in part.column(1).to_pylist()])
            for name, data, free in zip(part.column(0).to_pylist(), found, part.column(2).to_pylist(), strict=True):
                data += end
                done += packer.add(Item(name, 0, data, max(0, min(free, len(data) // WIDTH)), len(data) // WIDTH))
            if done:
                yield out(done, kind)
        yield out(list(packer.end()), kind)

    return rows.mapInArrow(run, schema + (", ids array<int>" if ids else ""))
