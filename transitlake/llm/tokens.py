"""Token ids of whole texts with a public tokenizer file, in Python workers.

White space separates words for this kind of tokenizer (a word-level pattern drops it), so the ids of a
text are those of its words joined, and each distinct word is encoded once per worker. A batch of texts is cut into
words as one array of bytes; Arrow numbers the distinct ones, only these are looked up, and the ids of all words
are gathered at once. Most words are letters, some with trailing ASCII punctuation; the pattern parts the two, so
their ids are looked up apart. Words of Latin-1 letters, lower-cased, need no normaliser and go through the same
model in large batches."""
from __future__ import annotations

import os
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_PUNCTUATION = string.punctuation.encode()
_IS_PUNCTUATION = np.isin(np.arange(256), list(_PUNCTUATION))
_IS_PLAIN = np.array([bytes([b]).isalnum() for b in range(256)])         # ASCII letters and digits
_AT_ONCE = 512
_MOST_CACHED = 1_000_000        # words, without their punctuation, held per worker; beyond it the cache starts anew
_END_OF_WORD = "</w>"
_MOST_CHARS = 1 << 22           # of the texts in a run; a longer text is a run of its own


def runs(texts) -> Iterator[slice]:
    """Slices of some texts that are short enough to be cut into words together."""
    first = held = 0
    for i, text in enumerate(texts):
        size = len(text or "")
        if i > first and held + size > _MOST_CHARS:
            yield slice(first, i)
            first, held = i, 0
        held += size
    if first < len(texts):
        yield slice(first, len(texts))


def _gather(pool: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs of `pool` with these starts and sizes, end to end."""
    ends = np.cumsum(sizes)
    at = np.repeat(starts - (ends - sizes), sizes)
    at += np.arange(len(at))
    return pool[at]


def _grown(array: np.ndarray, used: int, more: np.ndarray) -> np.ndarray:
    """`array` with `more` from place `used` on; its room doubles."""
    if used + len(more) > len(array):
        array = np.concatenate([array[:used], np.zeros(max(used, len(more)) + len(more), array.dtype)])
    array[used:used + len(more)] = more
    return array


class Encoder:
    """Ids as little-endian unsigned 16-bit (or 32-bit, for large vocabularies) integers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer = None
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.ascii = Tokenizer.from_file(path)              # the byte-level step leaves ASCII letters as they are
        self.ascii.normalizer, self.ascii.pre_tokenizer = None, pre_tokenizers.WhitespaceSplit()
        vocab = self.tokenizer.get_vocab()
        self.dtype = np.dtype("<u2" if max(vocab.values()) < 1 << 16 else "<u4")
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith(_END_OF_WORD)]] = True
        self._clear()

    def _clear(self) -> None:
        """No words: number of each word, and where the ids of each number lie in the pool."""
        self.words: dict[bytes, int] = {}
        self.pool, self.used = np.zeros(1 << 16, self.dtype), 0
        self.starts, self.sizes = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int32)

    def ids(self, text: str | None) -> np.ndarray:
        return self.ids_of([text])[0]

    def ids_of(self, texts) -> list[np.ndarray]:
        """Ids of some texts."""
        ids, sizes = self.joined(texts)
        return np.split(ids, np.cumsum(sizes)[:-1])

    def joined(self, texts, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of some texts end to end and the number of each one's; `end` follows each text. New words are encoded together."""
        if len(self.words) > _MOST_CACHED:
            self._clear()
        words, cuts = self._split(texts)
        coded = words.dictionary_encode()
        distinct, known = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), self.words
        at = list(map(known.get, distinct))
        new = [w for w, n in zip(distinct, at) if n is None]
        if new:
            self._learn(new)
            at = [known[w] if n is None else n for w, n in zip(distinct, at)]
        at = np.array(at, np.int64)
        starts, sizes = self.starts[at], self.sizes[at]
        of = coded.indices.to_numpy()
        starts, sizes = starts[of], sizes[of]
        before = np.cumsum(np.append(0, sizes))[cuts]
        ids = _gather(self.pool, starts, sizes)
        if end is not None:
            ids = np.insert(ids, before[1:], end)
        return ids, np.diff(before) + (end is not None)

    @staticmethod
    def _split(texts) -> tuple[pa.Array, np.ndarray]:
        """Words of some texts, punctuation that the pattern parts from its word apart, and how many come before each text.

        Texts are lower-cased (A-Z) unless they may hold a special token, whose case counts and whose words stay whole."""
        raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        special = [b"<|" in r for r in raw]
        raw = [r if s else r.lower() for r, s in zip(raw, special)]
        a = np.frombuffer(b"\n".join([b"", *raw, b""]), np.uint8)
        first = np.cumsum([1] + [len(r) + 1 for r in raw])
        space = (a == 32) | (a - np.uint8(9) < 5)
        turns = np.flatnonzero(space[1:] != space[:-1]) + 1
        starts, ends = turns[::2], turns[1::2]
        cuts = np.searchsorted(starts, first)
        # where each word's trailing punctuation begins
        core, at = ends.copy(), np.flatnonzero(_IS_PUNCTUATION[a[ends - 1]])
        if any(special):
            at = at[~np.array(special)[np.searchsorted(first, starts[at], "right") - 1]]
        marked = at
        while len(at):
            core[at] -= 1
            at = at[_IS_PUNCTUATION[a[core[at] - 1]]]           # a space, if no byte of the word is left
        marked = marked[_IS_PLAIN[a[core[marked] - 1]]]
        offsets = np.concatenate([[0], np.cumsum(ends - starts)])
        offsets = np.insert(offsets, marked + 1, offsets[marked] + core[marked] - starts[marked])
        words = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(a[~space])])
        return words, cuts + np.searchsorted(marked, cuts)

    def _keep(self, words: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> None:
        """Number new words, whose ids lie end to end."""
        n = len(self.words)
        self.starts = _grown(self.starts, n, self.used + np.cumsum(sizes) - sizes)
        self.sizes = _grown(self.sizes, n, sizes)
        self.pool = _grown(self.pool, self.used, ids)
        self.used += len(ids)
        self.words.update(zip(words, range(n, n + len(words))))

    def _learn(self, words: list[bytes]) -> None:
        """Encode new words: core and trailing punctuation apart, or whole if the pattern may join them."""
        known, parts, new = self.words, [], set()
        for word in words:
            core = word.rstrip(_PUNCTUATION)
            if core != word and core and b"<|" not in word and (
                    core[-1:].isalnum() or core[-1] > 127 and core.decode("utf-8", "replace")[-1].isalnum()):
                tail = word[len(core):]
                parts.append((word, core, tail))
                new.add(core)
                new.add(tail)
            else:
                new.add(word)
        self._encode(new.difference(known))
        if parts:
            at = np.array([(known[core], known[tail]) for _, core, tail in parts])
            sizes = self.sizes[at]
            self._keep([word for word, _, _ in parts], _gather(self.pool, self.starts[at].reshape(-1), sizes.reshape(-1)), sizes.sum(axis=1))

    def _encode(self, cores: set[bytes]) -> None:
        letters = [core for core in cores if core.isalpha()]                 # of bytes: ASCII letters only
        others, latin = [], []
        for core in cores.difference(letters):
            text = core.decode("utf-8", "replace")
            (latin if text.isalpha() and max(text) < "Ā" else others).append(core)
        for words, tokenizer in ((letters, self.ascii), (latin, self.plain)):
            groups = [words[i:i + _AT_ONCE] for i in range(0, len(words), _AT_ONCE)]
            done = tokenizer.encode_batch_fast([b" ".join(g).decode("utf-8", "replace").lower() for g in groups], add_special_tokens=False)
            for some, found in zip(groups, done):
                ids = np.array(found.ids, self.dtype)
                sizes = np.diff(np.flatnonzero(self.ends[ids]), prepend=-1)
                if len(sizes) != len(some) or sizes.sum() != len(ids):
                    raise ValueError("a word's ids do not end with it")
                self._keep(some, ids, sizes)
        found = [np.array(x.ids, self.dtype) for x in self.tokenizer.encode_batch_fast(
            [c.decode("utf-8", "replace") for c in others], add_special_tokens=False)]
        if found:
            self._keep(others, np.concatenate(found), np.array([len(x) for x in found]))


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker process and tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
