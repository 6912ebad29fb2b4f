"""Packing: token sequences of a fixed size, filled by minimum bin slack.

Documents are tokenised where they are read. A document fills whole windows first; its remainder goes to the pool of
the task. A window is seeded with the largest remainder of the pool; a subset-sum over the other lengths, kept as
one bitset a step, finds the multiset that comes closest to the capacity, and the steps are backtracked into counts. Where the
best window still misses more than ``MOST_SLACK`` tokens, a remainder is cut to fill it. At the end of a task the rest that
fills no window is cut into sequences whose lengths are powers of two, which need no padding.

Memory is bounded by the pool (``POOL`` remainders of less than a window each), the table of ids (``CACHE`` words) and
one document. Null and empty texts are one piece, the end id alone. Repeated rows are packed once for each row. A retried
task makes the same sequences from the same rows; extra columns are not carried.
"""

from __future__ import annotations

import os
import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITY = 4096
END_ID = 2
POOL = 256
CACHE = 1 << 19
#: Bytes of texts that are cut into words at once.
SLICE = 1 << 20
#: Pieces that go through the tokenizer in one call.
TOGETHER = 200
MOST_SLACK = 4
#: Documents encoded together.
GROUP = 256
#: Sequences of a task are numbered within its stretch of ids.
STRETCH = 1 << 36

PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, sequence_length long"


# The tokenizer's own cut of a word into pieces, for ASCII words in lower case.
PIECE = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+")
WHITE = re.compile(rb"[ \t\n\r\x0b\x0c]")
WORD_END = "</w>"
# UTF-8 bytes of the lower-case letters a-z and U+00DF to U+00FF (without the division sign), the marks that may follow
# a word, and the characters that stand for those of the bytes that are not printable in Latin-1.
LETTER_BYTES = b"abcdefghijklmnopqrstuvwxyz\xc3" + bytes(b for b in range(0x9F, 0xC0) if b != 0xB7)
MARK_BYTES = b".,;:!?"
LETTER_CHARACTERS = {"\x9f": "\u0141", "\xa0": "\u0142", "\xad": "\u0143"}
_LETTER, _SECOND, _MARK, _OTHER = 1, 2, 3, 4
_KINDS = np.full(256, _OTHER, np.uint8)
_KINDS[list(LETTER_BYTES[:26])], _KINDS[list(LETTER_BYTES[27:])], _KINDS[list(MARK_BYTES)], _KINDS[list(b" \t\n\r\x0b\x0c")] = _LETTER, _SECOND, _MARK, 0
LETTERS = re.compile(r"([^\W\d_]+)([!-&(-/:-@\[-`{-~]*)")


def cut_word(word: bytes) -> list[bytes]:
    """The pieces of a word in lower case; none where only the tokenizer can tell."""
    if word.isascii():
        return PIECE.findall(word)
    m = LETTERS.fullmatch(word.decode())
    return [x.encode() for x in m.groups() if x] if m and m[1].isalpha() and m[1].lower().isalpha() else []


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def slices(text: bytes) -> Iterator[bytes]:
    """Parts of a text that end before white space, of ``SLICE`` bytes or so much more as a word has."""
    at = 0
    while len(text) - at > SLICE:
        stop = max(text.rfind(c, at + 1, at + SLICE) for c in (b" ", b"\t", b"\n", b"\r", b"\x0b", b"\x0c"))
        if stop < 0:
            further = WHITE.search(text, at + SLICE)
            stop = further.start() if further else len(text)
        yield text[at:stop]
        at = stop
    yield text[at:]


class Hashes:
    """Two 64-bit hashes of stretches of a buffer, by sums from the front."""

    BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)

    def __init__(self):
        self.powers: list[tuple[np.ndarray, np.ndarray]] = []

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
        if not self.powers or len(self.powers[0][0]) < len(data):
            self.powers = [(_powers(b, len(data) + 4096), _powers(pow(b, -1, 1 << 64), len(data) + 4096)) for b in self.BASES]
        wide, out = data.astype(np.uint64) + np.uint64(1), []
        for up, down in self.powers:
            sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(wide * up[: len(data)], out=sums[1:])
            x = (sums[ends] - sums[starts]) * down[starts]
            x ^= x >> np.uint64(29)
            x *= np.uint64(0xBF58476D1CE4E5B9)
            x ^= x >> np.uint64(32)
            out.append(x)
        return out


def words_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a text in lower case; marks behind a letter that end a word are a word of their own.

    The tokenizer cuts there as well: such marks are no part of a piece with letters.
    """
    kind = _KINDS[data]
    dark = np.concatenate(([False], kind > 0, [False]))
    starts, ends = np.flatnonzero(dark[1:] & ~dark[:-1]), np.flatnonzero(dark[:-1] & ~dark[1:])
    places = np.arange(len(data), dtype=np.int32)
    before = np.maximum.accumulate(np.where(kind == _MARK, np.int32(-1), places))[ends - 1]  # the last byte that is no mark
    cut = before[(before >= starts) & (before < ends - 1)]
    letter = (kind[cut] == _LETTER) | ((kind[cut] == _SECOND) & (data[cut - 1] == 0xC3))
    cut = cut[letter] + 1
    return np.sort(np.concatenate((starts, cut))), np.sort(np.concatenate((ends, cut)))


class Encoder:
    """Ids of whole texts as little-endian unsigned 32-bit integers, for a tokenizer that drops white space and case.

    Such a tokenizer never joins across white space. A group of texts is cut into words at once, and words are told apart by
    128 bits of hash. Words that came before are looked up in a table with two slots for each word; the others, each
    once, go through the tokenizer, many in one call, told apart by their word ends. In a full table a word is kept when it comes
    again: most that come once never do. A run of lower-case letters of Latin-1 is one piece to the tokenizer, in composed form and lower case already, so
    these go through its model without its patterns, each byte as the character that stands for it there.
    """

    def __init__(self, tokenizer_json: str, most: int = CACHE):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.letters = Tokenizer.from_str(tokenizer_json), Tokenizer.from_str(tokenizer_json)
        self.letters.normalizer, self.letters.pre_tokenizer = None, pre_tokenizers.WhitespaceSplit()
        for tokenizer in (self.tokenizer, self.letters):
            tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith(WORD_END)]] = True
        self.hashes, self.slots = Hashes(), 1 << (most - 1).bit_length()
        self._afresh()

    def _afresh(self) -> None:
        self.key = [np.zeros(self.slots, np.uint64) for _ in Hashes.BASES]
        self.at, self.size = np.zeros(self.slots, np.int64), np.zeros(self.slots, np.int64)  # a word has an id or more
        self.came = np.zeros(8 * self.slots, bool)
        self.pool, self.filled = np.zeros(8 * self.slots, "<u4"), 0

    def _alone(self, words: list[bytes], into: dict[bytes, bytes]) -> None:
        for first in range(0, len(words), 2000):
            part = words[first : first + 2000]
            for w, e in zip(part, self.tokenizer.encode_batch_fast([w.decode() for w in part], add_special_tokens=False)):
                into[w] = np.array(e.ids, "<u4").tobytes()

    def _together(self, tokenizer, pieces: list[bytes], into: dict[bytes, bytes], characters: dict[str, str] | None = None) -> None:
        for first in range(0, len(pieces), TOGETHER):
            part = pieces[first : first + TOGETHER]
            joined = b" ".join(part)
            text = joined.decode("latin-1" if characters else "utf-8")
            for byte, character in (characters or {}).items():
                text = text.replace(byte, character)
            ids = np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            stops = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            if len(stops) != len(part):  # not one word end a piece
                self._alone(part, into)
                continue
            data = ids.tobytes()
            into.update(zip(part, [data[a:b] for a, b in zip([0, *stops], stops)]))

    def ids_of(self, words: list[bytes]) -> dict[bytes, bytes]:
        """The ids of distinct words."""
        found: dict[bytes, bytes] = {}
        other = [w.translate(None, LETTER_BYTES) for w in words]
        letters = [w for w, o in zip(words, other) if not o]
        odd = {w: cut_word(w) for w, o in zip(words, other) if o}
        pieces = {p for ps in odd.values() for p in ps}.difference(letters)
        spelled = [p for p in pieces if not p.translate(None, LETTER_BYTES)]
        self._together(self.letters, letters + spelled, found, LETTER_CHARACTERS)
        self._together(self.tokenizer, list(pieces.difference(spelled)), found)
        for w, ps in odd.items():
            if ps:
                found[w] = b"".join([found[p] for p in ps])
        self._alone([w for w, ps in odd.items() if not ps], found)
        return found

    def _learn(self, joined: bytes, starts: np.ndarray, ends: np.ndarray, keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Places and numbers of the ids of words that are not in the table. ``joined`` has the text, ``keys`` the hashes."""
        pairs = np.empty(len(starts), "u8,u8")
        pairs["f0"], pairs["f1"] = keys
        order = np.lexsort(keys)
        lead = np.ones(len(order), bool)
        lead[1:] = pairs[order[1:]] != pairs[order[:-1]]
        one, number = order[lead], np.empty(len(order), np.int64)
        number[order] = np.cumsum(lead) - 1
        words = [joined[a:b] for a, b in zip(starts[one].tolist(), ends[one].tolist())]
        found = self.ids_of(words)
        ids = [found[w] for w in words]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        total = int(sizes.sum())
        if self.filled + total > len(self.pool):
            self._afresh()
            if total > len(self.pool):
                self.pool = np.zeros(2 * total, "<u4")
        self.pool[self.filled : self.filled + total] = np.frombuffer(b"".join(ids), "<u4")
        places = self.filled + np.cumsum(sizes) - sizes
        self.filled += total
        # A word takes a free slot of its two; where both are taken, it takes one when it has come before.
        mark = keys[0][one] >> np.uint64(20) & np.uint64(len(self.came) - 1)
        slot = [k[one] & np.uint64(self.slots - 1) for k in keys]
        free = [self.size[s] == 0 for s in slot]
        kept = free[0] | free[1] | self.came[mark]
        self.came[mark] = True
        slot = np.where(free[0], slot[0], slot[1])[kept]
        mine = [k[one][kept] for k in keys]
        self.at[slot], self.size[slot] = places[kept], sizes[kept]
        for table, k in zip(self.key, mine):
            table[slot] = k
        return places[number], sizes[number]

    def encode(self, texts: list[bytes]) -> Iterator[bytes]:
        """The ids of each text. A longer one than ``SLICE`` goes alone and in parts."""
        waiting, held = [], 0
        for text in texts:
            if held + len(text) > SLICE:
                yield from self._group(waiting)
                waiting, held = [], 0
            if len(text) > SLICE:
                yield b"".join([ids for part in slices(text) for ids in self._group([part])])
            else:
                waiting.append(text)
                held += len(text)
        yield from self._group(waiting)

    def _group(self, texts: list[bytes]) -> Iterator[bytes]:
        joined = b" ".join(texts).lower()  # A-Z
        data = np.frombuffer(joined, np.uint8)
        if not joined.strip():
            yield from (b"" for _ in texts)
            return
        starts, ends = words_of(data)
        keys = self.hashes(data, starts, ends)
        places, sizes = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        for k in keys:
            slot = k & np.uint64(self.slots - 1)
            same = (self.key[0][slot] == keys[0]) & (self.key[1][slot] == keys[1]) & (self.size[slot] > 0)
            places[same], sizes[same] = self.at[slot[same]], self.size[slot[same]]
        pool, missed = self.pool, np.flatnonzero(sizes == 0)
        ids = _gather(pool, places, sizes)
        if len(missed):
            # What was found stays as it is read here, also if the table starts afresh.
            more = self._learn(joined, starts[missed], ends[missed], [k[missed] for k in keys])
            all_sizes = sizes.copy()
            all_sizes[missed] = more[1]
            whole = np.empty(int(all_sizes.sum()), "<u4")
            new = np.zeros(len(starts), bool)
            new[missed] = True
            new = np.repeat(new, all_sizes)
            whole[~new], whole[new] = ids, _gather(self.pool, *more)
            ids, sizes = whole, all_sizes
        stops = np.concatenate(([0], np.cumsum(sizes)))
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        begins = np.cumsum(lengths + 1) - lengths - 1
        first, last = np.searchsorted(starts, begins), np.searchsorted(starts, begins + lengths)
        for a, b in zip(stops[first].tolist(), stops[last].tolist()):
            yield ids[a:b].tobytes()


def _gather(pool: np.ndarray, places: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    stops = np.cumsum(sizes)
    return pool[np.repeat(places - stops + sizes, sizes) + np.arange(stops[-1] if len(stops) else 0)]


def encoder_for(tokenizer_json: str) -> Encoder:
    """The worker process's own encoder: its cache serves the tasks that follow."""
    kept = sys.__dict__.setdefault("_word_id_encoders", {})
    if tokenizer_json not in kept:
        kept.clear()
        kept[tokenizer_json] = Encoder(tokenizer_json)
    return kept[tokenizer_json]


def best_subset(lengths: dict[int, int], capacity: int) -> dict[int, int]:
    """Counts of lengths (of those available) whose sum is the largest up to ``capacity``."""
    mask, reach, full = (1 << (capacity + 1)) - 1, 1, 1 << capacity
    steps: list[tuple[int, int]] = []
    for length in sorted((k for k in lengths if k <= capacity), reverse=True):
        for _ in range(min(lengths[length], capacity // length)):
            more = (reach | reach << length) & mask
            if more == reach:
                break
            steps.append((length, reach))
            reach = more
            if reach & full:
                break
        if reach & full:
            break
    total, counts = reach.bit_length() - 1, {}
    for length, before in reversed(steps):
        if not before >> total & 1:
            counts[length] = counts.get(length, 0) + 1
            total -= length
    return counts


class Packer:
    """Windows of one task. A piece is (doc_id, start, ids, doc_tokens)."""

    def __init__(self, part: int, capacity: int = CAPACITY, pool: int = POOL, most_slack: int = MOST_SLACK):
        self.next_id, self.capacity, self.most, self.most_slack = part * STRETCH, capacity, pool, most_slack
        self.pool: dict[int, list[tuple]] = {}
        self.size = 0
        self.rows: list[tuple] = []

    def _put(self, pieces: list[tuple]) -> None:
        total, at = sum(len(p[2]) // 4 for p in pieces), 0
        for doc_id, start, ids, doc_tokens in pieces:
            n = len(ids) // 4
            self.rows.append((doc_id, start, n, ids, doc_tokens, self.next_id, at, total))
            at += n
        self.next_id += 1

    def _hold(self, piece: tuple) -> None:
        if piece[2]:
            self.pool.setdefault(len(piece[2]) // 4, []).append(piece)
            self.size += 1

    def _take(self, length: int) -> tuple:
        pieces = self.pool[length]
        piece = pieces.pop()
        if not pieces:
            del self.pool[length]
        self.size -= 1
        return piece

    def _cut(self, length: int, at: int) -> tuple:
        """The first ``at`` ids of a piece; the rest goes back."""
        doc_id, start, ids, doc_tokens = self._take(length)
        self._hold((doc_id, start + at, ids[4 * at :], doc_tokens))
        return (doc_id, start, ids[: 4 * at], doc_tokens)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        n, window = len(ids) // 4, 4 * self.capacity
        whole = len(ids) - len(ids) % window
        for first in range(0, whole, window):
            self._put([(doc_id, first // 4, ids[first : first + window], n)])
        self._hold((doc_id, whole // 4, ids[whole:], n))
        if self.size >= self.most:
            self._window()

    def _window(self) -> None:
        pieces = [self._take(max(self.pool))]
        free = self.capacity - len(pieces[0][2]) // 4
        for length, count in best_subset({k: len(v) for k, v in self.pool.items()}, free).items():
            for _ in range(count):
                pieces.append(self._take(length))
                free -= length
        if free > self.most_slack and self.pool and max(self.pool) > free:
            pieces.append(self._cut(max(self.pool), free))
        self._put(pieces)

    def finish(self) -> None:
        while sum(k * len(v) for k, v in self.pool.items()) >= self.capacity:
            self._window()
        left = sum(k * len(v) for k, v in self.pool.items())
        while left:
            free = 1 << (left.bit_length() - 1)
            left -= free
            pieces = []
            while free:
                length = max((k for k in self.pool if k <= free), default=None)
                piece = self._take(length) if length else self._cut(min(self.pool), free)
                pieces.append(piece)
                free -= len(piece[2]) // 4
            self._put(pieces)

    def drain(self) -> list[tuple]:
        rows, self.rows = self.rows, []
        return rows


def _pack_part(tokenizer_json: str, end_id: int, capacity: int):
    schema = pa.schema(
        [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64())]
        + [("sequence_id", pa.int64()), ("offset", pa.int64()), ("sequence_length", pa.int64())]
    )
    end = end_id.to_bytes(4, "little")

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = encoder_for(tokenizer_json), Packer(TaskContext.get().partitionId(), capacity)
        for batch in batches:
            for first in range(0, batch.num_rows, GROUP):
                part = batch.slice(first, GROUP)
                ids = part.column(0).to_pylist()
                texts = [b"" if t is None else t for t in part.column(1).to_pylist()]
                for doc_id, encoded in zip(ids, encoder.encode(texts)):
                    packer.add(doc_id, encoded + end)
                if rows := packer.drain():
                    yield batch_of(rows)
        packer.finish()
        if rows := packer.drain():
            yield batch_of(rows)

    return run


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The pieces of all documents: where they start, their ids, and their place in a sequence."""
    with open(tokenizer_path, encoding="utf-8") as f:  # a vocabulary of bounded size, sent with the function
        tokenizer_json = f.read()
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(_pack_part(tokenizer_json, end_id, capacity), PIECES)
