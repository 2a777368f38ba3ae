"""SentencePiece encoding and decoding with seeded merge-dropout.

Pieces merge by an agenda of candidate pairs (best score first, then leftmost), as the BPE model of a public vocabulary
prescribes. Each candidate taken from the agenda is skipped if a keyed hash of (seed, variant, pair, place) falls below the
dropout rate, so a seed always gives the same segmentation and another seed another one; all of them decode to the text.

No merge crosses the start of a word (checked on the vocabulary), so words are encoded one by one and remembered. Words
of a text take turns among ``variants`` keys, from a place set by the whole text, so repeated words vary within a text and
from text to text. Cutting a slice of texts into words, telling their distinct ones and laying ids end to end is done on
whole Arrow buffers; Python meets each distinct word of a slice once. Slices and remembered words are bounded in bytes.
"""

from __future__ import annotations

import functools
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import xxhash
from pyspark.sql import DataFrame

from cellquant.llm.common import with_fields

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: bytes of text that are encoded together (a longer text by itself)
SLICE = 4_000_000
#: bytes that one generation of remembered words may take, all variants together
REMEMBERED = 24_000_000
#: words up to this length are merged in blocks
SHORT = 48
_NONE = np.int32(2**31 - 1)
_U64 = (1 << 64) - 1
_FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)


class Dropout:
    """Skips a candidate (left piece, right piece, place in the word) if its keyed hash falls below the rate."""

    def __init__(self, rate: float, key: int):
        self.limit, self.key = min(int(rate * 2**64), _U64), key

    def of_one(self, left: int, right: int, place: int) -> bool:
        a, b, c, d, e = _FACTORS
        x = (left * a ^ right * b ^ place * c ^ self.key) & _U64
        x = (x ^ x >> 32) * d & _U64
        x = (x ^ x >> 29) * e & _U64
        return (x ^ x >> 32) < self.limit

    def of_many(self, left: np.ndarray, right: np.ndarray, place: np.ndarray) -> np.ndarray:
        a, b, c, d, e = map(np.uint64, _FACTORS)
        x = left.astype(np.uint64) * a ^ right.astype(np.uint64) * b ^ place.astype(np.uint64) * c ^ np.uint64(self.key)
        x = (x ^ x >> np.uint64(32)) * d
        x = (x ^ x >> np.uint64(29)) * e
        return (x ^ x >> np.uint64(32)) < np.uint64(self.limit)


class Pieces:
    """A vocabulary's pieces, which pairs of them merge and in what order, and the bytes of each id."""

    def __init__(self, model_file: str):
        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        ids = range(sp.get_piece_size())
        byte = {int(sp.id_to_piece(i)[3:5], 16): i for i in ids if sp.is_byte(i)}
        plain = [i for i in ids if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        id_of = {sp.id_to_piece(i): i for i in plain}
        self.byte_id = [byte[b] for b in range(256)]
        self.bytes_of = [b""] * len(ids)
        for p, i in id_of.items():
            self.bytes_of[i] = p.replace(SPACE, " ").encode()
        for b, i in byte.items():
            self.bytes_of[i] = bytes([b])
        #: whether merges stay inside " *[^ ]+"
        self.by_word = not any(SPACE in p.lstrip(SPACE) for p in id_of)
        #: piece of each character; -1 goes by bytes, as a literal U+2581 does, so that it never decodes to a space
        self.piece_of = np.full(0x110000, -1, np.int32)
        for p, i in id_of.items():
            if len(p) == 1 and p != SPACE:
                self.piece_of[ord(p)] = i
        self.piece_of[ord(" ")] = id_of.get(SPACE, -1)
        merges = {(id_of[p[:k]] << 32) + id_of[p[k:]]: i for p, i in id_of.items() for k in range(1, len(p)) if p[:k] in id_of and p[k:] in id_of}
        #: order of merges: 0 is the best score; equal scores share a rank
        self.rank = np.full(len(ids), _NONE, np.int32)
        self.rank[plain] = np.unique([-sp.get_score(i) for i in plain], return_inverse=True)[1]
        self.merge_of = merges
        self.spelling = pa.array(self.bytes_of, pa.binary())
        #: pairs by hash, to look up many at once; those whose slot is taken go to the next, smaller table
        self.tables: list[tuple[int, int, np.ndarray, np.ndarray]] = []
        left = np.array(sorted(merges), np.int64)
        bits = max(8, len(left).bit_length() + 3)
        for factor in _FACTORS:
            slot = self._slots(left, factor, bits)
            _, first = np.unique(slot, return_index=True)
            keys, value = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int32)
            keys[slot[first]] = left[first]
            value[slot[first]] = [merges[k] for k in left[first].tolist()]
            self.tables.append((factor, bits, keys, value))
            left, bits = np.delete(left, first), max(8, bits - 3)
        assert not len(left), "pairs without a slot"

    @staticmethod
    def _slots(key: np.ndarray, factor: int, bits: int) -> np.ndarray:
        return (key.view(np.uint64) * np.uint64(factor | 1) >> np.uint64(64 - bits)).view(np.int64)

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(merged piece, rank) of pairs; the rank of what does not merge is above all others."""
        key = ((left.astype(np.int64) << 32) + right).ravel()
        key[((left | right) < 0).ravel()] = -2  # characters without a piece merge with nothing
        piece = np.full(len(key), -1, np.int32)
        at, asked = None, key
        for factor, bits, keys, value in self.tables:
            slot = self._slots(asked, factor, bits)
            held = keys[slot]
            hit = held == asked
            if at is None:
                piece[hit] = value[slot[hit]]
                at = np.flatnonzero(~hit & (held >= 0))
            else:
                piece[at[hit]] = value[slot[hit]]
                at = at[~hit & (held >= 0)]
            asked = key[at]
            if not len(at):
                break
        return piece.reshape(left.shape), np.where(piece >= 0, self.rank[piece], _NONE).reshape(left.shape)

    def encode_words(self, words: list[str], dropout: Dropout) -> list[list[int]]:
        return [np.frombuffer(x, np.int32).tolist() for x in self.pack_words(words, dropout)]

    def pack_words(self, words: list[str], dropout: Dropout) -> list[bytes]:
        """Ids of chunks of text, as bytes. Words of one length form blocks whose agendas advance together, longer ones have a heap."""
        out = [b""] * len(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(sizes, kind="stable")
        edges = np.flatnonzero(np.diff(sizes[order])) + 1
        for same in np.split(order, edges):
            if not len(same):
                continue
            n = int(sizes[same[0]])
            for lo in range(0, len(same), 8192 if n <= SHORT else 1):
                at = same[lo : lo + (8192 if n <= SHORT else 1)].tolist()
                chars = np.frombuffer("".join([words[i] for i in at]).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(at), n)
                symbols = self.piece_of[chars]
                alive = self._merge_block(symbols, dropout) if n <= SHORT else self._merge_long(symbols, dropout)
                rough = ((symbols < 0) & alive).any(axis=1)
                ends = np.cumsum(alive.sum(axis=1)).tolist()
                flat = symbols[alive].tobytes()
                for i, a, b in zip(at, [0, *ends], ends, strict=False):
                    out[i] = flat[4 * a : 4 * b]
                for r in np.flatnonzero(rough).tolist():
                    i = at[r]
                    places = np.flatnonzero(alive[r]).tolist()
                    ids = [x for k, s in zip(places, np.frombuffer(out[i], np.int32).tolist(), strict=True) for x in ([s] if s >= 0 else [self.byte_id[y] for y in words[i][k].encode()])]
                    out[i] = np.array(ids, np.int32).tobytes()
        return out

    def _merge_block(self, symbols: np.ndarray, dropout: Dropout) -> np.ndarray:
        """Merge each row of ``symbols`` in place; returns which places still begin a piece. Each round takes the next
        candidate of every row's agenda, the leftmost of its best rank."""
        n, width = symbols.shape
        alive = np.ones((n, width), bool)
        if width < 2:
            return alive
        after = np.tile(np.arange(1, width + 1, dtype=np.int32), (n, 1))
        before = after - 2
        piece, rank = self._look_up(symbols[:, :-1], symbols[:, 1:])
        rows = np.arange(n)
        while len(rows):
            i = rank[rows].argmin(axis=1)
            more = rank[rows, i] != _NONE
            rows, i = rows[more], i[more]
            j = after[rows, i]
            if dropout.limit:
                skip = dropout.of_many(symbols[rows, i], symbols[rows, j], i)
                rank[rows[skip], i[skip]] = _NONE
                go = ~skip
                r, i, j = rows[go], i[go], j[go]
            else:
                r = rows
            symbols[r, i] = piece[r, i]
            alive[r, j] = False
            k = after[r, j]
            after[r, i] = k
            inside = k < width
            before[r[inside], k[inside]] = i[inside]
            rank[r, i] = _NONE
            last = j < width - 1
            rank[r[last], j[last]] = _NONE
            h = before[r, i]
            left = h >= 0
            for r2, a, b in ((r[inside], i[inside], k[inside]), (r[left], h[left], i[left])):
                piece[r2, a], rank[r2, a] = self._look_up(symbols[r2, a], symbols[r2, b])
        return alive

    def _merge_long(self, symbols: np.ndarray, dropout: Dropout) -> np.ndarray:
        """The same for one row of any length, with its agenda in a heap: n log n."""
        row, n, rank, merge_of = symbols[0].tolist(), symbols.shape[1], self.rank, self.merge_of
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        agenda: list[tuple[int, int, int, int, int, int]] = []

        def offer(a: int, b: int) -> None:
            if a >= 0 and b >= 0 and row[a] >= 0 and row[b] >= 0 and (both := merge_of.get((row[a] << 32) + row[b])) is not None:
                heapq.heappush(agenda, (int(rank[both]), a, b, row[a], row[b], both))

        for i in range(n - 1):
            offer(i, i + 1)
        alive = [True] * n
        while agenda:
            _, a, b, left, right, both = heapq.heappop(agenda)
            if not alive[a] or not alive[b] or after[a] != b or row[a] != left or row[b] != right:
                continue
            if dropout.limit and dropout.of_one(left, right, a):
                continue
            row[a], alive[b] = both, False
            after[a] = after[b]
            if after[b] >= 0:
                before[after[b]] = a
            offer(before[a], a)
            offer(a, after[a])
        symbols[0] = row
        return np.array([alive])

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


@functools.lru_cache(2)
def pieces(model_file: str) -> Pieces:
    return Pieces(model_file)


class _Words:
    """Words (as bytes) to ids (as bytes) under ``variants`` keys. Two generations are remembered, so that frequent words
    stay; each is bounded by what its entries take."""

    def __init__(self, model: Pieces, dropout: float, seed: int, variants: int):
        self.model, self.keys = model, [Dropout(dropout, xxhash.xxh64_intdigest(f"{seed}:{v}")) for v in range(variants)]
        self.young: list[dict[bytes, bytes]] = [{} for _ in self.keys]
        self.old: list[dict[bytes, bytes]] = [{} for _ in self.keys]
        self.taken = 0

    def ids(self, words: list[bytes], variant: int) -> list[bytes]:
        young, old = self.young[variant], self.old[variant]
        out = list(map(young.get, words))
        missing = [i for i, x in enumerate(out) if x is None]
        if missing:
            aged = [old.get(words[i]) for i in missing]
            new = [i for i, x in zip(missing, aged, strict=True) if x is None]
            packed = iter(self.model.pack_words([words[i].decode() for i in new], self.keys[variant]))
            for i, x in zip(missing, aged, strict=True):
                out[i] = young[words[i]] = x if x is not None else next(packed)
                self.taken += 190 + len(words[i]) + len(out[i])  # two objects and a place in the dict
        return out

    def rest(self) -> None:
        """Between slices: the generation that is full becomes the old one."""
        if self.taken > REMEMBERED:
            self.old, self.young, self.taken = self.young, [{} for _ in self.keys], 0


@functools.lru_cache(1)
def _caches(model_file: str, dropout: float, seed: int, variants: int) -> _Words:
    """Kept by a worker from task to task."""
    return _Words(pieces(model_file), dropout, seed, variants)


def _words(texts: pa.StringArray, by_word: bool) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words (blanks, then what follows up to the next blank) of all texts end to end, and how many each text has."""
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int32)
    lo, hi = int(ends[0]), int(ends[-1])
    data = np.frombuffer(texts.buffers()[2], np.uint8)[lo:hi] if hi > lo else np.zeros(0, np.uint8)
    ends = ends - lo
    begins = np.zeros(hi - lo, bool)
    if by_word and hi > lo:
        blank = data == 32
        begins[1:] = blank[1:] & ~blank[:-1]
    begins[ends[:-1][ends[:-1] < ends[1:]]] = True
    at = np.flatnonzero(begins)
    edges = np.append(at, hi - lo).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(edges), pa.py_buffer(data)])
    return words.dictionary_encode(), np.diff(np.searchsorted(at, ends))


def encode_array(texts: pa.StringArray, caches: _Words) -> pa.ListArray:
    """Ids of whole texts (no nulls): the words of a text take turns among the variants."""
    v = len(caches.keys)
    words, sizes = _words(texts, caches.model.by_word)
    starts = np.cumsum(sizes) - sizes
    first = np.fromiter((xxhash.xxh64_intdigest(t) % v if v > 1 else 0 for t in texts.cast(pa.binary()).to_pylist()), np.int64, len(texts))
    turn = (np.arange(len(words)) - np.repeat(starts - first, sizes)) % v
    n = len(words.dictionary)
    slot = words.indices.to_numpy().astype(np.int64) + turn * n
    asked = np.zeros(n * v, bool)
    asked[slot] = True
    ids: list[bytes] = []
    for k in range(v):
        ids += caches.ids(words.dictionary.filter(pa.array(asked[k * n : (k + 1) * n])).to_pylist(), k)
    caches.rest()
    table = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, ids)], dtype=np.int64) // 4, pa.int32()), pa.array(np.frombuffer(b"".join(ids), np.int32)))
    found = table.take(pa.array((np.cumsum(asked) - 1)[slot]))
    ends = np.concatenate(([0], np.cumsum(found.value_lengths().to_numpy())))[np.concatenate(([0], np.cumsum(sizes)))]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), found.flatten())


def encode_texts(texts: list[str], caches: _Words) -> list[list[int]]:
    return encode_array(pa.array(texts, pa.string()), caches).to_pylist()


def encode_text(text: str, caches: _Words) -> list[int]:
    return encode_texts([text], caches)[0]


def decode_array(ids: pa.ListArray, model: Pieces) -> pa.StringArray:
    """The texts that ids stand for (null: none). Ids whose bytes are no UTF-8 give replacement characters."""
    ids = ids if ids.null_count == 0 else pa.array([x or [] for x in ids.to_pylist()], pa.list_(pa.int32()))
    ends = pa.array(np.concatenate(([0], np.cumsum(ids.value_lengths().to_numpy(zero_copy_only=False)))), pa.int32())
    spelled = pc.binary_join(pa.ListArray.from_arrays(ends, model.spelling.take(ids.flatten())), b"")
    try:
        return spelled.cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([x.decode("utf-8", "replace") for x in spelled.to_pylist()], pa.string())


def _slices(b: pa.RecordBatch, place: int) -> Iterator[tuple[pa.RecordBatch, pa.StringArray]]:
    """Rows of a batch with their texts (null: empty), about ``SLICE`` bytes at a time."""
    texts = pc.fill_null(b.column(place), "").cast(pa.string())
    upto = np.cumsum(pc.binary_length(texts).to_numpy())
    lo = 0
    while lo < b.num_rows:
        hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + SLICE, side="right")))
        yield b.slice(lo, hi - lo), texts.slice(lo, hi - lo)
        lo = hi


def encode(documents: DataFrame, *, model_file: str = MODEL, dropout: float = 0.1, seed: int = 1, variants: int = 8, decoded: bool = False) -> DataFrame:
    """Every row with ids (array of int) and, if ``decoded``, the text that they decode to, in the same pass.

    Null and empty texts have no ids and decode to the empty text. Equal texts have equal ids, repeated rows stay, an
    empty table gives an empty result. Columns named ids (or decoded) are replaced, others stay.
    """
    made = ["ids", "decoded"] if decoded else ["ids"]
    kept = [c for c in documents.columns if c not in made]
    place = kept.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        caches = _caches(model_file, dropout, seed, variants)
        for b in batches:
            for part, texts in _slices(b, place):
                ids = encode_array(texts, caches)
                new = [ids, decode_array(ids, caches.model)] if decoded else [ids]
                yield pa.RecordBatch.from_arrays([*part.columns, *new], [*kept, *made])

    rows = documents.select(*kept)
    return rows.mapInArrow(run, with_fields(rows, "ids array<int>, decoded string" if decoded else "ids array<int>"))


def decode(encoded: DataFrame, *, model_file: str = MODEL) -> DataFrame:
    """Every row with decoded, the text that ids stand for; null ids give the empty text, an empty table an empty result.
    A column named decoded is replaced."""
    kept = [c for c in encoded.columns if c != "decoded"]
    place = kept.index("ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(model_file)
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                yield pa.RecordBatch.from_arrays([*part.columns, decode_array(part.column(place), model)], [*kept, "decoded"])

    rows = encoded.select(*kept)
    return rows.mapInArrow(run, with_fields(rows, "decoded string"))
