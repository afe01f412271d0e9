"""Token ids of public vocabularies, computed once per distinct chunk.

A text is cut into chunks at single spaces that stand between two characters
other than white space. Both kinds of vocabulary used here treat such a space
as the start of a new token whatever stands before it: the byte-level one
splits its input there before any merge, and the piece one has no piece that
holds a space mark after another character (checked on loading). So the ids of
a text are the ids of its chunks, one after the other. Chunks repeat: each
distinct one of a worker goes to its tokenizer once. A block's chunks are found
again by a hash of their bytes, and the bytes themselves are compared.

A space next to a byte that may belong to a wider white-space character is not
cut, which only makes that chunk longer.
"""

from __future__ import annotations

import json
from collections.abc import Callable

import numpy as np
import pyarrow as pa

from tidewatch.llm.textkit import word_hashes

#: Distinct chunks a worker keeps.
KEPT = 1 << 19
_SHIFT = np.uint64(44)
_BUCKETS = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[*range(0x09, 0x0E), *range(0x1C, 0x21)]] = True
# First bytes of the white-space characters beyond ASCII (U+0085, U+00A0, U+1680, U+2000.., U+3000).
_WIDE = np.zeros(256, bool)
_WIDE[[0xE1, 0xE2, 0xE3]] = True
_LEADS = _WIDE.copy()
_LEADS[0xC2] = True


def chunk_starts(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """First byte of every chunk of a block; empty rows have none."""
    n = len(buf)
    if not n:
        return np.zeros(0, np.int64)
    p = np.flatnonzero(buf == 0x20)
    p = p[(p > 0) & (p < n - 1)]
    before, after = buf[p - 1], buf[p + 1]
    wide = ((before == 0x85) | (before == 0xA0)) & (buf[np.maximum(p - 2, 0)] == 0xC2) | _WIDE[buf[np.maximum(p - 3, 0)]] & (before >= 0x80)
    p = p[~(_SPACE[before] | _SPACE[after] | _LEADS[after] | wide)]
    cut = np.zeros(n, bool)
    cut[p] = True
    full = offs[1:] > offs[:-1]
    cut[offs[1:][full] - 1] = False  # a row's last byte is no cut
    cut[offs[:-1][full]] = True
    return np.flatnonzero(cut)


def chunk_codes(buf: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """(code of each chunk, the distinct chunks)."""
    if not len(starts):
        return np.zeros(0, np.int64), []
    ends = np.append(starts, len(buf)).astype(np.int64)
    chunks = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(buf))])
    coded = chunks.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist()


class Lists:
    """Growing integer lists: `first` and `flat` in the usual offset form."""

    def __init__(self, kind=np.int64) -> None:
        self.first, self.flat, self._n, self._m = np.zeros(1024, np.int64), np.zeros(4096, kind), 0, 0

    def _room(self, lists: int, values: int) -> None:
        for name, need in (("first", self._n + lists + 1), ("flat", self._m + values)):
            have = getattr(self, name)
            if need > len(have):
                setattr(self, name, np.concatenate((have, np.zeros(max(need, 2 * len(have)) - len(have), have.dtype))))

    def add_flat(self, flat: np.ndarray, size: np.ndarray) -> None:
        """Lists of the given sizes, one after the other in `flat`."""
        self._room(len(size), len(flat))
        self.first[self._n + 1:self._n + len(size) + 1] = self._m + np.cumsum(size)
        self.flat[self._m:self._m + len(flat)] = flat
        self._n, self._m = self._n + len(size), self._m + len(flat)

    def size(self, codes: np.ndarray) -> np.ndarray:
        return self.first[codes + 1] - self.first[codes]

    def take(self, codes: np.ndarray) -> np.ndarray:
        """The lists of all codes, one after the other."""
        return self.flat[_ranges(self.first[codes], self.size(codes))]


class ChunkMemo:
    """What `make(new chunks)` records, once per distinct chunk; `reset()` is
    called before the first block and whenever `kept` chunks are held."""

    def __init__(self, reset: Callable[[], None], make: Callable[[list[bytes]], None], kept: int = KEPT):
        self._reset, self._make, self._kept = reset, make, kept
        self._clear()

    def _clear(self) -> None:
        self._hash, self._code, self._bytes = np.zeros(0, np.uint64), np.zeros(0, np.int64), Lists(np.uint8)
        self._bucket = np.zeros(_BUCKETS, np.int64)  # first hash of each leading bits
        self._reset()

    def _find(self, h: np.ndarray) -> np.ndarray:
        """Place of each hash, or some other place if it is not held: hashes are
        even, so the first of its leading bits is a few places before it."""
        last = max(len(self._hash) - 1, 0)
        at = np.minimum(self._bucket[h >> _SHIFT], last)
        if not len(self._hash):
            return at
        go = np.flatnonzero(self._hash[at] < h)
        while len(go):
            at[go] += 1
            go = go[at[go] <= last]
            go = go[self._hash[at[go]] < h[go]]
        return np.minimum(at, last)

    def codes(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(memo code of each chunk of the block, first chunk of each row plus the total)."""
        if len(self._hash) > self._kept:
            self._clear()
        start = chunk_starts(buf, offs)
        first = np.searchsorted(start, offs)
        if not len(start):
            return start, first
        end = np.append(start[1:], len(buf))
        h = word_hashes(buf, start, end)
        at = self._find(h)
        new = self._hash[at] != h if len(self._hash) else np.ones(len(h), bool)
        if new.any():
            fresh, one = np.unique(h[new], return_index=True)
            one = np.flatnonzero(new)[one]
            known = len(self._hash)
            raw = buf.tobytes()
            self._make([raw[i:j] for i, j in zip(start[one].tolist(), end[one].tolist())])
            self._bytes.add_flat(buf[_ranges(start[one], end[one] - start[one])], end[one] - start[one])
            both = np.concatenate((self._hash, fresh))
            order = np.argsort(both, kind="stable")
            self._hash, self._code = both[order], np.concatenate((self._code, np.arange(known, known + len(fresh))))[order]
            self._bucket = np.searchsorted(self._hash, np.arange(_BUCKETS, dtype=np.uint64) << _SHIFT)
            at = self._find(h)
        codes = self._code[at]
        size = end - start
        if (self._bytes.size(codes) != size).any() or not np.array_equal(self._bytes.take(codes), buf):
            # Two chunks share a hash: this block by its bytes alone.
            self._clear()
            codes, distinct = chunk_codes(buf, start)
            self._make(distinct)
            self._hash = np.full(self._kept + 1, np.uint64(0))  # cleared before the next block
        return codes, first


def _ranges(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """first[0], .., first[0] + n[0] - 1, first[1], .."""
    return np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


# Fixed value: the published splitting pattern of byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_level(path: str):
    """The rank encoder of a byte-level vocabulary file.

    The file's merges, in order, make the ids from the bytes on (checked), so
    its ids are ranks and the faster rank encoder gives the same ids: compared
    for every code point beside letters, digits, marks and spaces."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    table = byte_level_bytes(path)
    base = 256
    if any(model["vocab"]["".join(_pair(m))] != base + i for i, m in enumerate(model["merges"])):
        raise ValueError(f"{path}: the merges are not in the order of the ids")
    ranks = {table[i]: i for i in range(base + len(model["merges"]))}
    added = {t: i for t, i in ((table[i].decode(), i) for i in range(len(ranks), len(table)))}
    return tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=added)


def byte_level(path: str) -> Callable[[str], np.ndarray]:
    """Encoder of one text; special tokens' strings become their ids."""
    encoding = _byte_level(path)
    return lambda text: encoding.encode_to_numpy(text, allowed_special="all")


def byte_level_lists(path: str) -> Callable[[list[str]], list[list[int]]]:
    """Encoder of many texts; special tokens' strings are ordinary text."""
    encode = _byte_level(path).encode_ordinary
    return lambda texts: [encode(t) for t in texts]


def _pair(merge) -> list[str]:
    return merge if isinstance(merge, list) else merge.split(" ")


def byte_level_bytes(path: str) -> list[bytes]:
    """The bytes of every id of a byte-level vocabulary."""
    from tokenizers import Tokenizer

    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]  # bytes written as themselves
    of = {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))}
    t = Tokenizer.from_file(path)
    added = {i for i in t.get_added_tokens_decoder()}
    return [t.id_to_token(i).encode() if i in added else bytes(of[c] for c in t.id_to_token(i)) for i in range(t.get_vocab_size())]


def pieces(path: str) -> tuple[Callable[[list[str]], list[list[int]]], list[bytes]]:
    """Encoder of a piece vocabulary and the bytes of every id. The encoder
    takes texts without the space that the vocabulary adds."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
    if any("▁" in n.lstrip("▁") for n in names):
        raise ValueError(f"{path} has pieces that cross a space: its texts cannot be encoded by chunks")
    table = [bytes([int(n[3:5], 16)]) if sp.is_byte(i) else b"" if sp.is_control(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)]
    return lambda texts: sp.encode(texts, num_threads=1), table
