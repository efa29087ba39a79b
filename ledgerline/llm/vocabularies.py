"""Encoders of the tokenizers library that remember words, one per worker process.

Both encoders give exactly the ids of the library. A text is cut where no token can
cross, each distinct piece goes through the library's BPE model once, and its ids are
remembered, up to a fixed number of pieces.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Regex, Tokenizer, models, pre_tokenizers

from .common import RollingHash, flat_text, give_back_memory

#: What a process remembers at most, in dicts (pieces and whole words) and in flat arrays; what is full starts anew.
PIECES_KEPT = 250_000
WORDS_KEPT = 250_000
FLAT_PIECES_KEPT = 600_000
#: Words whose ids are gathered at once.
WORDS_AT_ONCE = 1 << 18


@lru_cache(1)
def byte_characters() -> tuple[str, ...]:
    """The printable character that byte-level BPE writes for each byte: itself if printable, else the next from U+0100."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return tuple(chr(b if b in printable else next(others)) for b in range(256))


@lru_cache(1)
def _byte_table() -> dict[int, str]:
    return dict(enumerate(byte_characters()))


def to_characters(piece: str) -> str:
    """A piece in byte-level characters."""
    return piece.encode("utf-8", "surrogatepass").decode("latin-1").translate(_byte_table())


def gathered_runs(values: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The runs first ... first+length-1 of values, end to end."""
    stops = np.cumsum(length)
    total = int(stops[-1]) if len(stops) else 0
    return values[np.repeat(first - (stops - length), length) + np.arange(total)]


class Remembered(dict):
    """A dict that computes what is missing."""

    def __init__(self, compute, most: int):
        super().__init__()
        self.compute, self.most = compute, most

    def __missing__(self, key):
        value = self[key] = self.compute(key)
        return value

    def trim(self) -> None:
        if len(self) > self.most:
            self.clear()


class KnownPieces:
    """The ids of pieces that were met before, in flat arrays: a piece is found by its hash and its bytes are compared."""

    def __init__(self):
        # piece 0 is the empty one, which has no ids
        self.hashes, self.numbers = np.zeros(1, np.uint64), np.zeros(1, np.int64)
        self.raw, self.spelled = np.zeros(0, np.uint8), np.zeros(2, np.int64)
        self.ids, self.bounds = np.zeros(0, np.uint32), np.zeros(2, np.int64)

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def find(self, hashes: np.ndarray, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The number of each piece, or -1."""
        out = np.full(len(hashes), -1)
        at = np.searchsorted(self.hashes, hashes)
        hit = np.flatnonzero(at < len(self.hashes))
        hit = hit[self.hashes[at[hit]] == hashes[hit]]
        number, sizes = self.numbers[at[hit]], offsets[hit + 1] - offsets[hit]
        same = self.spelled[number + 1] - self.spelled[number] == sizes
        hit, number, sizes = hit[same], number[same], sizes[same]
        differ = gathered_runs(raw, offsets[hit], sizes) != gathered_runs(self.raw, self.spelled[number], sizes)
        wrong = np.zeros(len(hit), bool)
        wrong[np.repeat(np.arange(len(hit)), sizes)[differ]] = True
        out[hit[~wrong]] = number[~wrong]
        return out

    def add(self, hashes: np.ndarray, raw: np.ndarray, sizes: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Number new pieces: their bytes and ids come end to end."""
        numbers = len(self) + np.arange(len(hashes))
        order = np.argsort(hashes)
        at = np.searchsorted(self.hashes, hashes[order])
        self.hashes, self.numbers = np.insert(self.hashes, at, hashes[order]), np.insert(self.numbers, at, numbers[order])
        self.raw, self.spelled = np.concatenate([self.raw, raw]), np.concatenate([self.spelled, self.spelled[-1] + np.cumsum(sizes)])
        self.ids, self.bounds = np.concatenate([self.ids, ids]), np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(counts)])
        return numbers


class WordEncoder:
    """A BPE of lower-cased words (NFC, white space dropped, word ends marked), read from a tokenizers file.

    A batch of texts is split at white space, its distinct words are cut into pieces, and the pieces that this
    process has not met go through the library in one call. Ids of words and of texts are gathered by offsets.
    """

    #: What the file's pre-tokenizer keeps: fixed values of that format.
    PIECES = r"('s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+)"
    #: Anything but printable ASCII, its white space, and Latin letters that NFC keeps and that lower-case one to one.
    ODD = r"[^\t-\r -~¡-įı-ňŊ-ž]"

    #: Kinds of bytes: spaces, letters (all of UTF-8 beyond ASCII), digits, others.
    KINDS = np.full(256, 3, np.uint8)
    KINDS[0x20] = 0
    KINDS[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1
    KINDS[0x30:0x3A] = 2

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.size = self.tokenizer.get_vocab_size()
        # the same model over pieces that are cut already and parted by spaces
        self.pieces = Tokenizer(self.tokenizer.model)
        self.pieces.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        self.ends = np.zeros(self.size, bool)
        suffix = self.tokenizer.model.end_of_word_suffix
        for token, number in self.tokenizer.get_vocab().items():
            self.ends[number] = token.endswith(suffix)
        self.known = KnownPieces()

    def _tokens_of(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces, end to end, and how many are each piece's."""
        (encoding,) = self.pieces.encode_batch_fast([" ".join(pieces)], add_special_tokens=False)
        ids = np.array(encoding.ids, np.uint32)
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) == len(pieces):
            return ids, np.diff(stops, prepend=0)
        # a token that looks like the end of a word inside one
        each = [np.array([t.id for t in self.tokenizer.model.tokenize(to_characters(p))], np.uint32) for p in pieces]
        return np.concatenate(each), np.array([len(x) for x in each])

    def _numbers(self, pieces: pa.Array) -> np.ndarray:
        """The numbers of distinct pieces; those not known are learned."""
        raw, offsets = flat_text(pieces)
        hashes = RollingHash(raw.astype(np.uint64) + np.uint64(1)).of(offsets[:-1], offsets[1:])
        numbers = self.known.find(hashes, raw, offsets)
        new = np.flatnonzero(numbers < 0)
        if len(new):
            sizes = offsets[new + 1] - offsets[new]
            numbers[new] = self.known.add(hashes[new], gathered_runs(raw, offsets[new], sizes), sizes, *self._tokens_of(pieces.take(pa.array(new)).cast(pa.large_string()).to_pylist()))
        return numbers

    def _cut(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The pieces of words: all bytes, where each piece begins and ends in them, and how many pieces each word has.

        A piece is a run of letters, a run of other characters or one digit. Words with an apostrophe or with rarer
        characters are cut by the format's own pattern, which leaves a space between pieces.
        """
        words = pc.utf8_lower(words)
        raw, offsets = flat_text(words)
        rare = np.concatenate([[0], np.cumsum((raw == 0x27) | (raw == 0xC2) | ((raw == 0xC3) & np.isin(np.append(raw[1:], 0), (0x97, 0xB7))))])
        rare = rare[offsets[1:]] > rare[offsets[:-1]]
        if rare.any():
            mask = pa.array(rare)
            words = pc.replace_with_mask(words, mask, pc.utf8_rtrim(pc.replace_substring_regex(words.filter(mask), self.PIECES, r"\1 "), " "))
            raw, offsets = flat_text(words)
        sizes = np.diff(offsets)
        kind = self.KINDS[raw]
        kind[np.repeat(rare, sizes) & (raw != 0x20)] = 4
        opens = np.ones(len(raw), bool)
        opens[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
        opens[offsets[:-1][sizes > 0]] = True
        first = np.flatnonzero(opens)
        stop = np.append(first[1:], len(raw))
        piece = kind[first] != 0
        before = np.concatenate([[0], np.cumsum(opens & (kind != 0))])
        return raw, first[piece], stop[piece], before[offsets[1:]] - before[offsets[:-1]]

    def _ids_of_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct words, end to end, and the offsets of the words in them."""
        raw, first, stop, counts = self._cut(words)
        sizes = stop - first
        own = np.concatenate([[0], np.cumsum(sizes)])
        pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(own), pa.py_buffer(gathered_runs(raw, first, sizes))])
        distinct = pieces.dictionary_encode()
        number = self._numbers(distinct.dictionary)[distinct.indices.to_numpy()]
        at = self.known.bounds[number]
        length = self.known.bounds[number + 1] - at
        ends = np.concatenate([[0], np.cumsum(length)])
        return gathered_runs(self.known.ids, at, length), ends[np.concatenate([[0], np.cumsum(counts)])]

    def encode_column(self, texts: pa.Array | pa.ChunkedArray, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (null: empty) end to end, each text followed by end_id where that is given, and how many are each text's."""
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        odd = pc.match_substring_regex(texts, self.ODD)
        apart = {i: self.tokenizer.encode(texts[i].as_py(), add_special_tokens=False).ids for i in np.flatnonzero(odd.to_numpy(False)).tolist()}
        split = pc.ascii_split_whitespace(pc.if_else(odd, "", texts) if apart else texts)
        cuts = split.offsets.to_numpy() - split.offsets[0].as_py()
        words = split.flatten().dictionary_encode()
        known, bounds = self._ids_of_words(words.dictionary)
        first, length = bounds[:-1], np.diff(bounds)
        codes = words.indices.to_numpy()
        place = np.zeros(len(codes) + 1, np.int64)
        np.cumsum(length[codes], out=place[1:])
        counts = np.diff(place[cuts])
        for i, ids in apart.items():
            counts[i] = len(ids)
        sizes = counts + (end_id is not None)
        stops = np.cumsum(sizes)
        out = np.empty(stops[-1] if len(stops) else 0, np.uint32)
        if end_id is not None:
            out[stops - 1] = end_id
        at = 0
        while at < len(sizes):  # whole rows, about WORDS_AT_ONCE words at a time
            till = max(at + 1, int(np.searchsorted(cuts, cuts[at] + WORDS_AT_ONCE, "right")) - 1)
            own = codes[cuts[at] : cuts[till]]
            ids = gathered_runs(known, first[own], length[own])
            if end_id is None and not apart:
                out[place[cuts[at]] : place[cuts[till]]] = ids
            else:
                each = np.diff(place[cuts[at : till + 1]])
                ahead = stops[at:till] - sizes[at:till] - (place[cuts[at:till]] - place[cuts[at]])
                out[np.repeat(ahead, each) + np.arange(len(ids))] = ids
            at = till
        for i, ids in apart.items():
            out[stops[i] - sizes[i] : stops[i] - sizes[i] + len(ids)] = ids
        return out, sizes

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        return self.encode_column(pa.array([text], pa.string()))[0].astype("<u4").tobytes()

    def trim(self) -> None:
        if len(self.known) > FLAT_PIECES_KEPT:
            self.known = KnownPieces()


@lru_cache(4)
def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def byte_level_tokenizer(path: str, pattern: str) -> Tokenizer:
    """A tokenizers BPE with the ranks of a rank file: every split of a token into two tokens is a merge of its rank."""
    ranks = read_ranks(path)
    written = byte_characters()
    spell = lambda token: "".join([written[b] for b in token])
    merges = [
        (spell(token[:i]), spell(token[i:]))
        for token, _ in sorted(ranks.items(), key=lambda item: item[1])
        for i in range(1, len(token))
        if token[:i] in ranks and token[i:] in ranks
    ]
    tokenizer = Tokenizer(models.BPE({spell(token): rank for token, rank in ranks.items()}, merges, ignore_merges=True))
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence(
        [pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
    )
    return tokenizer


class ByteEncoder:
    """Byte-level BPE by the ranks of a rank file, and its inverse."""

    #: A space beside other white space; elsewhere no match of the pattern crosses the place before a space.
    RUNS = re.compile(r"\s | \s")

    def __init__(self, path: str, pattern: str):
        self.tokenizer = byte_level_tokenizer(path, pattern)
        self.model = self.tokenizer.model
        self.pattern = regex.compile(pattern)
        self.pieces = Remembered(self._piece, PIECES_KEPT)
        self.words = Remembered(self._word, WORDS_KEPT)
        ranks = read_ranks(path)
        self.size = max(ranks.values()) + 1
        back = {character: byte for byte, character in enumerate(byte_characters())}
        self.token_bytes = [b""] * self.size
        for characters, rank in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.token_bytes[rank] = bytes([back[c] for c in characters])

    def _piece(self, piece: str) -> bytes:
        return np.array([t.id for t in self.model.tokenize(to_characters(piece))], "<u4").tobytes()

    def _word(self, word: str) -> bytes:
        return self.plain(" " + word)

    def plain(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.pattern.findall(text)))

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        if self.RUNS.search(text):
            return self.plain(text)
        first, *words = text.split(" ")
        return self.plain(first) + b"".join(map(self.words.__getitem__, words))

    def encode_with_offsets(self, text: str) -> tuple[list[int], list[tuple[int, int]]]:
        """Ids and the character span of each; tokens inside one character share its span."""
        encoding = self.tokenizer.encode(text, add_special_tokens=False)
        return encoding.ids, encoding.offsets

    def decode_bytes(self, ids: Iterable[int]) -> bytes:
        """The bytes of any run of ids; a run may begin or end inside a character."""
        table = self.token_bytes
        return b"".join([table[i] for i in ids])

    def decode(self, ids: Iterable[int]) -> str:
        """The text of a run of ids; bytes that form no whole character become U+FFFD."""
        return self.decode_bytes(ids).decode("utf-8", "replace")

    def trim(self) -> None:
        self.pieces.trim()
        self.words.trim()


@lru_cache(4)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


@lru_cache(4)
def byte_encoder(path: str, pattern: str) -> ByteEncoder:
    return ByteEncoder(path, pattern)


def forget() -> None:
    """Let go of what this process remembers of vocabularies: a worker that goes on to another operator needs the memory."""
    word_encoder.cache_clear()
    byte_encoder.cache_clear()
    read_ranks.cache_clear()
    give_back_memory()
