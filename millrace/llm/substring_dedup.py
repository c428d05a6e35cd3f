"""Substring deduplication with difference-cover anchors.

The places PERIOD * k + r, with r in a difference cover of the period, are anchors: for any two
places some shift below the period takes both to anchors. So two equal windows of `width` words
share an aligned anchor, and the width - PERIOD + 1 words that begin there are equal. Only these
are hashed at first. Around anchors that are met again the match is extended: there, and only
there, whole windows are hashed, and each is removed if it starts earlier elsewhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.chunks import Words, chunked, covered, encoded, span_hashes, spanned, window_starts
from millrace.llm.frames import text_bytes, widened, without
from millrace.llm.marks import Places, mark, starts_of
from millrace.llm.repeats import one_document_each, with_place
from millrace.session import stage

WIDTH = 20
PERIOD = 13
COVER = (0, 1, 3, 9)


def _hashes(words: Words, starts: np.ndarray, width: int) -> np.ndarray:
    return np.stack([span_hashes(words.hashes(lane), starts, starts + width) for lane in (0, 1)], axis=1)


def anchor_places(width: int):
    size = width - PERIOD + 1

    def places(texts: list[bytes], _: list) -> Iterator[Places]:
        for first, last in chunked(texts):
            words = Words(texts[first:last])
            long = np.where(words.per_text >= width, words.per_text, 0)
            starts = window_starts(words.first, size)
            text = np.searchsorted(words.first, starts, side="right") - 1
            inside = starts - words.first[text]
            chosen = np.isin(inside % PERIOD, COVER) & (long[text] > 0)
            starts, text, inside = starts[chosen], text[chosen], inside[chosen]
            yield first + text, inside, _hashes(words, starts, size)

    return places


def window_places(width: int):
    """Windows that hold an anchor that is met elsewhere."""

    def places(texts: list[bytes], further: list) -> Iterator[Places]:
        for first, last in chunked(texts):
            words = Words(texts[first:last])
            near = []
            for i in range(first, last):
                anchors = starts_of(further[i][0])
                count = int(words.per_text[i - first])
                # a window holds the anchor at one of its first PERIOD words
                hit = spanned(np.maximum(anchors - PERIOD + 1, 0), anchors + 1, count)
                near.append(np.flatnonzero(hit[: max(count - width + 1, 0)]))
            inside = np.concatenate(near)
            text = np.repeat(np.arange(last - first), [len(x) for x in near])
            yield first + text, inside, _hashes(words, words.first[text] + inside, width)

    return places


def dedup_substrings(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """`docs` (doc_id, text, any others) with `text` as the words that stay, joined by blanks, and
    n_words and n_removed (long). Columns that already have these names are replaced.

    A word goes if a window of `width` words that covers it also starts earlier: in a document
    with a smaller doc_id, or before it in its own. Windows are judged on the whole input. A null
    text has no words. Rows without a doc_id take no part. Rows that share a doc_id are one document:
    equal texts are the same places, which aren't earlier than each other, and different texts stand
    one after the other in byte order, without windows across. Texts have any length; one is held
    whole by a task. An empty table gives an empty table. The rows must come in the same order if
    they are read again: from a table.
    """
    docs = without(docs, "n_words", "n_removed", "marks", "_before", "digest")
    texts, places = one_document_each(docs.select("doc_id", "text"))
    if places is not None:
        texts = stage(texts, "substring-texts")
    size = text_bytes(texts)
    anchors = mark(texts, anchor_places(width), later=False, across=False, wide=False, size=size)
    near = texts.join(anchors, "doc_id").select("doc_id", "text", "marks")
    windows = mark(near, window_places(width), later=True, across=False, wide=True, size=size)
    in_front = F.size(F.filter(F.split("before", r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    placed = with_place(docs, places, in_front, "_before")
    joined = placed.join(windows, "doc_id", "left").select(*[f"`{c}`" for c in docs.columns], "_before", "marks")
    names = [*docs.columns, "n_words", "n_removed"]
    place = names.index("text")

    def rewrite(them: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in them:
            texts, total, removed = [], [], []
            front, found = (batch.column(batch.num_columns - k).to_pylist() for k in (2, 1))
            for raw, before, marks in zip(encoded(batch.column(place)), front, found, strict=True):
                words = raw.split()
                total.append(len(words))
                if marks:
                    starts = starts_of(marks) - before
                    gone = covered(starts[(starts >= 0) & (starts < len(words))], width, len(words)).tolist()
                    words = [w for w, g in zip(words, gone, strict=True) if not g]
                removed.append(total[-1] - len(words))
                texts.append(b" ".join(words).decode())
            columns = batch.columns[:-2]
            columns[place] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(total, pa.int64()), pa.array(removed, pa.int64())], names=names)

    return joined.mapInArrow(rewrite, widened(docs.schema, "n_words long, n_removed long"))
