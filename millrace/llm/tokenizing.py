"""Token ids of many texts from a public tokenizer file, each distinct word encoded once.

The tokenizer never joins characters across white space, so a text's ids are its words' ids
in turn. Words are told apart by a 64-bit hash; a task keeps the ids of the words it has met,
up to a bound, and asks the tokenizer for new words only.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence

import numpy as np

from millrace.llm.chunks import Words, chunked

#: about 25 bytes each
WORDS_KEPT = 1_500_000
_PUNCTUATION = b".,!?:;*&%$#|()[]-"
_SOME = 100
_PROBE = "The quick brown Foxes jumped,\nover  unbelievably lazy\tdogs! And xqzvkj again."


@functools.lru_cache(maxsize=4)
def word_encoder(path: str) -> WordEncoder:
    """One encoder a worker process and file."""
    return WordEncoder(path)


class WordEncoder:
    """Ids for tokenizers that lower-case, split at white space and mark the ends of words."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.bare = Tokenizer(self.whole.model)  # for words of the letters a-z, which pass unchanged
        self.bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocabulary = self.whole.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.special = [t.content.lower().encode() for t in self.whole.get_added_tokens_decoder().values()]
        self._forget()
        self._require()

    def _require(self) -> None:
        """Refuse a tokenizer of another kind, whose ids would come out wrong."""
        ids = lambda encoder, text: encoder.encode(text, add_special_tokens=False).ids
        for word in _PROBE.split():
            stem = word.lower().rstrip(_PUNCTUATION.decode())
            own = np.array(ids(self.bare, stem), dtype=np.int64)
            good = len(own) and self.ends[own].nonzero()[0].tolist() == [len(own) - 1]
            if not good or ids(self.whole, word) != own.tolist() + ids(self.whole, word[len(stem):]):
                raise ValueError("the tokenizer doesn't lower-case words, split at punctuation and mark their ends")
        if ids(self.whole, _PROBE) != [i for word in _PROBE.split() for i in ids(self.whole, word)]:
            raise ValueError("the tokenizer joins characters across white space")

    def _forget(self) -> None:
        self.known = np.zeros(0, dtype=np.uint64)
        self.starts = np.zeros(0, dtype=np.uint32)
        self.sizes = np.zeros(0, dtype=np.uint32)
        self.ids = np.zeros(0, dtype=np.uint16 if len(self.ends) <= 1 << 16 else np.uint32)
        self.tails: dict[bytes, list[int]] = {}

    def _encode(self, words: list[bytes]) -> list[Sequence[int]]:
        out: list[Sequence[int]] = [()] * len(words)
        plain, rest = [], []
        for i, word in enumerate(words):
            stem = word.rstrip(_PUNCTUATION)
            (plain if stem.isalpha() else rest).append((i, word, stem))
        for at in range(0, len(plain), _SOME):
            some = plain[at : at + _SOME]
            ids = np.array(self.bare.encode(b" ".join(x[2] for x in some).decode(), add_special_tokens=False).ids)
            for (i, word, stem), own in zip(some, np.split(ids, np.flatnonzero(self.ends[ids])[:-1] + 1), strict=True):
                tail = word[len(stem) :]
                if tail and tail not in self.tails:
                    if len(self.tails) > 10_000:
                        self.tails.clear()
                    self.tails[tail] = self.whole.encode(tail.decode(), add_special_tokens=False).ids
                out[i] = [*own.tolist(), *self.tails[tail]] if tail else own.tolist()
        encoded = self.whole.encode_batch([x[1].decode() for x in rest], add_special_tokens=False)
        for (i, _, _), own in zip(rest, encoded, strict=True):
            out[i] = own.ids
        return out

    def _learn(self, hashes: np.ndarray, words: list[bytes]) -> None:
        found = self._encode(words)
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        flat = np.fromiter((i for x in found for i in x), dtype=self.ids.dtype, count=int(sizes.sum()))
        starts = len(self.ids) + np.cumsum(sizes) - sizes
        at = np.searchsorted(self.known, hashes)
        self.known = np.insert(self.known, at, hashes)
        self.starts = np.insert(self.starts, at, starts.astype(np.uint32))
        self.sizes = np.insert(self.sizes, at, sizes.astype(np.uint32))
        self.ids = np.concatenate((self.ids, flat))

    def _chunk(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        words = Words(texts)
        distinct, where, back = np.unique(words.hashes(), return_index=True, return_inverse=True)
        if len(self.known) + len(distinct) > WORDS_KEPT:
            self._forget()
        at = np.searchsorted(self.known, distinct)
        new = np.ones(len(distinct), dtype=bool)
        inside = at < len(self.known)
        new[inside] = self.known[at[inside]] != distinct[inside]
        if new.any():
            raw = words.joined.tobytes()
            spans = zip(words.starts[where[new]].tolist(), words.ends[where[new]].tolist(), strict=True)
            self._learn(distinct[new], [raw[a:b] for a, b in spans])
            at = np.searchsorted(self.known, distinct)
        at = at[back]
        sizes = self.sizes[at].astype(np.int64)
        after = np.concatenate(([0], np.cumsum(sizes)))
        take = np.arange(after[-1]) + np.repeat(self.starts[at].astype(np.int64) - after[:-1], sizes)
        return self.ids[take].astype(np.uint32), after[words.first]

    def encode(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        """The ids of each text, in turn."""
        for first, last in chunked(texts):
            some = texts[first:last]
            lowered = [x.lower() for x in some]
            odd = {i for i, x in enumerate(lowered) if b"<|" in x and any(s in x for s in self.special)}
            ids, ends = self._chunk([b"" if i in odd else x for i, x in enumerate(lowered)])
            for i in range(len(some)):
                if i in odd:
                    yield np.array(self.whole.encode(some[i].decode(), add_special_tokens=False).ids, dtype=np.uint32)
                else:
                    yield ids[ends[i] : ends[i + 1]]
