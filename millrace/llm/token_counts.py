"""Token counts of a unigram vocabulary by dynamic programming over a trie.

The distinct pre-tokens of a batch (a blank's mark and a word) are put in order, which makes each
shared prefix one node of their trie. Level by level, all nodes at once, the best forward score
and its number of tokens follow from the nodes above; a pre-token's count is that of its last
node. Documents add up the counts of their words. The
few pre-tokens that are very long are walked one by one, since level after level would be theirs alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm.chunks import Words, chunked, encoded, mix
from millrace.llm.frames import widened, without

BLANK = "▁"
#: below the least score of the vocabulary, for a character that no piece covers
UNKNOWN_BELOW = 10.0
#: bytes of text whose pre-tokens share a trie
TRIE_BYTES = 4 << 20
#: words of more characters are walked alone
LONG_WORD = 64
_BASE = 0xD6E8FEB86659FD93
_VOCABULARIES: dict[str, Vocabulary] = {}


class Vocabulary:
    """Pieces and scores, by length, as sorted hashes."""

    def __init__(self, pieces: dict[str, float]):
        self.pieces = pieces
        self.unknown = min(pieces.values(), default=0.0) - UNKNOWN_BELOW
        self.longest = max(map(len, pieces), default=1)
        self.by_length = {}
        for size in range(1, self.longest + 1):
            own = [p for p in pieces if len(p) == size]
            if own:
                hashes = np.array([piece_hash(p) for p in own], dtype=np.uint64)
                order = np.argsort(hashes)
                self.by_length[size] = hashes[order], np.array([pieces[p] for p in own])[order]

    def scores(self, size: int, hashes: np.ndarray) -> np.ndarray:
        """The score of each hashed piece of `size` characters, minus infinity for none."""
        known, scores = self.by_length[size]
        at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        return np.where(known[at] == hashes, scores[at], -np.inf)


def piece_hash(piece: str) -> int:
    total = 0
    for i, c in enumerate(piece):
        total += int(mix(np.array([ord(c)], dtype=np.uint64))[0]) * pow(_BASE, i, 1 << 64)
    return total & (2**64 - 1)


def sentencepiece_scores(path: str) -> dict[str, float]:
    """The ordinary pieces of a model file with their scores."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return {
        model.id_to_piece(i): model.get_score(i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    }


def vocabulary(path: str) -> Vocabulary:
    if path not in _VOCABULARIES:
        _VOCABULARIES[path] = Vocabulary(sentencepiece_scores(path))
    return _VOCABULARIES[path]


def count_alone(word: str, vocabulary: Vocabulary) -> int:
    """The number of tokens of one word; only as many levels are held as pieces reach back."""
    text, pieces = BLANK + word, vocabulary.pieces
    sizes, ring = list(vocabulary.by_length), vocabulary.longest + 1
    best, used = [0.0] * ring, [0] * ring
    for end in range(1, len(text) + 1):
        char = text[end - 1]
        if char in pieces:
            score, count = -np.inf, 0
        else:
            score, count = best[(end - 1) % ring] + vocabulary.unknown, used[(end - 1) % ring] + len(char.encode())
        for size in sizes:
            if size > end:
                break
            gain = pieces.get(text[end - size : end])
            if gain is None:
                continue
            at = (end - size) % ring
            total = best[at] + gain
            if total > score or (total == score and used[at] + 1 < count):
                score, count = total, used[at] + 1
        best[end % ring], used[end % ring] = score, count
    return used[len(text) % ring]


def count_tokens(words: list[str], vocabulary: Vocabulary) -> np.ndarray:
    """The number of tokens of each distinct word, on the path of the highest score; of equal
    scores the one of fewer tokens. A character outside all pieces is as many tokens as it has
    bytes in UTF-8."""
    long = [len(w) > LONG_WORD for w in words]
    if any(long):
        out = np.empty(len(words), dtype=np.int64)
        alone = np.array(long)
        out[alone] = [count_alone(w, vocabulary) for w, own in zip(words, long, strict=True) if own]
        out[~alone] = count_tokens([w for w, own in zip(words, long, strict=True) if not own], vocabulary)
        return out
    order = sorted(range(len(words)), key=words.__getitem__)
    tokens = [BLANK + words[i] for i in order]
    sizes = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
    flat = np.frombuffer("".join(tokens).encode("utf-32-le"), dtype=np.uint32)
    first = np.cumsum(sizes) - sizes
    values = mix(flat.astype(np.uint64))
    utf8 = 1 + (flat > 0x7F) + (flat > 0x7FF) + (flat > 0xFFFF)
    counts = np.zeros(len(tokens), dtype=np.int64)
    # per level: each word's node (the first word with its prefix), hashes of prefixes, and the
    # nodes' best score and count; the levels that pieces reach back to are kept
    kept = vocabulary.longest + 1
    node = {0: np.zeros(len(tokens), dtype=np.int64)}
    prefix = {0: np.zeros(len(tokens), dtype=np.uint64)}
    best, used = {0: np.zeros(len(tokens))}, {0: np.zeros(len(tokens), dtype=np.int64)}
    alive, fresh = np.arange(len(tokens)), np.zeros(len(tokens), dtype=bool)
    if len(fresh):
        fresh[0] = True
    for depth in range(1, int(sizes.max(initial=0)) + 1):
        alive = alive[sizes[alive] >= depth]
        at = first[alive] + depth - 1
        char = flat[at]
        before = alive - 1
        fresh[alive] |= (before < 0) | (sizes[before] < depth) | (flat[np.maximum(first[before] + depth - 1, 0) % len(flat)] != char)
        head = np.where(fresh[alive], alive, 0)
        own = np.zeros(len(tokens), dtype=np.int64)
        own[alive] = np.maximum.accumulate(head)
        sums = np.zeros(len(tokens), dtype=np.uint64)
        sums[alive] = prefix[depth - 1][alive] + values[at] * np.uint64(pow(_BASE, depth - 1, 1 << 64))
        nodes = alive[fresh[alive]]
        unknown = node[depth - 1][nodes]
        score = best[depth - 1][unknown] + vocabulary.unknown
        count = used[depth - 1][unknown] + utf8[first[nodes] + depth - 1]
        single = np.zeros(len(nodes), dtype=bool)
        for size in vocabulary.by_length:
            if size > depth:
                break
            back = np.uint64(pow(pow(_BASE, depth - size, 1 << 64), -1, 1 << 64))
            gain = vocabulary.scores(size, (sums[nodes] - prefix[depth - size][nodes]) * back)
            above = node[depth - size][nodes]
            try_score, try_count = best[depth - size][above] + gain, used[depth - size][above] + 1
            if size == 1:
                single = gain > -np.inf
                score[single], count[single] = -np.inf, 0
            better = (try_score > score) | ((try_score == score) & (try_count < count) & (gain > -np.inf))
            score[better], count[better] = try_score[better], try_count[better]
        node[depth], prefix[depth] = own, sums
        best[depth], used[depth] = np.zeros(len(tokens)), np.zeros(len(tokens), dtype=np.int64)
        best[depth][nodes], used[depth][nodes] = score, count
        ended = alive[sizes[alive] == depth]
        counts[ended] = used[depth][own[ended]]
        for levels in (node, prefix, best, used):
            levels.pop(depth - kept, None)
    out = np.empty(len(words), dtype=np.int64)
    out[order] = counts
    return out


def add_token_counts(docs: DataFrame, model: str) -> DataFrame:
    """`docs` with n_words and n_tokens (long). Columns that already have these names are replaced.

    Pre-tokens are the words between white space, unchanged. A null text has none. Repeated rows
    get equal counts; of paths with equal scores the one of fewer tokens counts; an empty table gives
    an empty table. Texts and words have any length; a text is held whole by a task.
    """
    docs = without(docs, "n_words", "n_tokens")
    names = [*docs.columns, "n_words", "n_tokens"]
    place = docs.columns.index("text")

    def batches(them: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = vocabulary(model)
        for batch in them:
            texts = encoded(batch.column(place))
            for first, last in chunked(texts, TRIE_BYTES):
                words = Words(texts[first:last])
                distinct, where, back = np.unique(words.hashes(), return_index=True, return_inverse=True)
                raw = words.joined.tobytes()
                spans = zip(words.starts[where].tolist(), words.ends[where].tolist(), strict=True)
                counts = count_tokens([raw[a:b].decode() for a, b in spans], pieces)
                totals = np.concatenate(([0], np.cumsum(counts[back])))
                n_tokens = totals[words.first[1:]] - totals[words.first[:-1]]
                rows = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(words.per_text), pa.array(n_tokens)], names=names)

    return docs.mapInArrow(batches, widened(docs.schema, "n_words long, n_tokens long"))
