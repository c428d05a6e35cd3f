"""Language identification by compression.

Each language has a zstandard raw-content dictionary made of sample texts. A text is reduced to
its words in lower case and cut into blocks; each block is compressed with every dictionary, and the language whose dictionary makes
the whole text smallest is chosen. A choice with a narrow margin is rejected.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.llm.frames import tidy, widened, without
from millrace.session import stage

#: bounds of the sample that the dictionaries are made of
TEXTS_PER_LANGUAGE = 256
BYTES_PER_TEXT = 1024
DICTIONARY_BYTES = 160 * 1024
LANGUAGES = 1000
#: so many times the wanted rows of a language are ranked
SPARE = 4
BLOCK_BYTES = 2048
LEVEL = 3
MIN_MARGIN = 0.002
_LATIN = re.compile("[A-Za-z]")
_BETWEEN = re.compile(r"[\W\d_]+")
_RESULT = "lang_pred string, score double, accepted boolean"
_COMPRESSORS: dict[int, list[tuple[str, zstandard.ZstdCompressor]]] = {}


def has_letter(text: str) -> bool:
    """Whether some character is alphabetic; numerals and signs aren't."""
    return _LATIN.search(text) is not None or any(map(str.isalpha, text))


def _letters(text: str) -> bytes:
    return _BETWEEN.sub(" ", text.lower()).encode()


def _lowest(rows: DataFrame) -> DataFrame:
    """The TEXTS_PER_LANGUAGE distinct rows (doc_id, lang, _hash) of each language that hash lowest.

    A language's rows are first cut down to those below a hash that leaves about SPARE times as many
    as are wanted, so that no task sees all rows of a language; the lowest are among them if
    enough are left. Languages that have too few left are ranked whole.
    """
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("_hash", "doc_id"))

    def ranked(some: DataFrame) -> DataFrame:
        return some.distinct().withColumn("_rank", rank).filter(F.col("_rank") <= TEXTS_PER_LANGUAGE).select("doc_id", "lang", "_hash")

    sizes = stage(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("_n")), "language-sizes")
    share = F.col("_hash") / F.lit(2.0**64) + 0.5
    below = share < SPARE * TEXTS_PER_LANGUAGE / F.col("_n")
    near = stage(ranked(rows.join(sizes, "lang").filter(below).select("doc_id", "lang", "_hash")), "language-sample")
    held = near.groupBy("lang").agg(F.count(F.lit(1)).alias("_held"))
    short = sizes.join(held, "lang", "left").filter(
        (F.col("_n") > SPARE * TEXTS_PER_LANGUAGE) & (F.coalesce("_held", F.lit(0)) < TEXTS_PER_LANGUAGE)).select("lang")
    short = stage(short, "language-short")
    if short.isEmpty():
        return near
    whole = ranked(rows.join(short, "lang"))
    return stage(near.join(short, "lang", "left_anti").select("doc_id", "lang", "_hash").unionByName(whole), "language-sample")


def fit_dictionaries(labelled: DataFrame) -> list[tuple[str, bytes]]:
    """(language, dictionary) in the order of languages, from rows (doc_id, text, lang).

    Per language at most TEXTS_PER_LANGUAGE texts, the ones whose doc_id hashes lowest, and at
    most BYTES_PER_TEXT bytes of each. Rows with a null or empty value take no part. Samples of more than LANGUAGES *
    TEXTS_PER_LANGUAGE texts, which the driver would have to hold, are refused with a ValueError.
    """
    usable = labelled.filter("doc_id is not null and lang is not null and text is not null and text <> ''")
    most = LANGUAGES * TEXTS_PER_LANGUAGE
    chosen = _lowest(usable.select("doc_id", "lang", F.xxhash64("doc_id").alias("_hash")))
    if chosen.count() > most:
        raise ValueError(f"the languages have more than {most} sample texts ({LANGUAGES} languages of {TEXTS_PER_LANGUAGE})")
    rows = (
        usable.select("doc_id", "lang", F.substring("text", 1, BYTES_PER_TEXT).alias("text"))
        .join(F.broadcast(chosen), ["doc_id", "lang"])
        .distinct()
        .orderBy("lang", "_hash", "doc_id", "text")
        .limit(most + 1)
        .collect()
    )
    if len(rows) > most:
        raise ValueError(f"the languages have more than {most} sample texts ({LANGUAGES} languages of {TEXTS_PER_LANGUAGE})")
    texts: dict[str, list[bytes]] = {}
    for row in rows:
        texts.setdefault(row["lang"], []).append(_letters(row["text"])[:BYTES_PER_TEXT])
    return [(lang, b"\n".join(own)[:DICTIONARY_BYTES]) for lang, own in texts.items()]


def _compressors(name: int, dictionaries: list[tuple[str, bytes]]) -> list[tuple[str, zstandard.ZstdCompressor]]:
    if name not in _COMPRESSORS:
        _COMPRESSORS.clear()
        own = []
        for lang, raw in dictionaries:
            data = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            data.precompute_compress(level=LEVEL)
            own.append((lang, zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_content_size=False)))
        _COMPRESSORS[name] = own
    return _COMPRESSORS[name]


def _choose(text: str | None, compressors: list[tuple[str, zstandard.ZstdCompressor]]) -> tuple[str, float, bool]:
    if not text or not compressors or not has_letter(text):
        return "und", 0.0, False
    raw = _letters(text)
    blocks = [raw[i : i + BLOCK_BYTES] for i in range(0, len(raw), BLOCK_BYTES)]
    sizes = sorted((sum(len(c.compress(b)) for b in blocks), lang) for lang, c in compressors)
    if len(sizes) == 1:
        return sizes[0][1], 1.0, True
    margin = 1 - sizes[0][0] / sizes[1][0]
    return sizes[0][1], margin, margin >= MIN_MARGIN


def identify(docs: DataFrame, dictionaries: list[tuple[str, bytes]]) -> DataFrame:
    """`docs` with lang_pred, score (by how much the best size is under the next, 0 to 1) and
    accepted. Columns that already have these names are replaced.

    A null text, or one without letters, is `und` with score 0 and isn't accepted; so is every
    text if there are no dictionaries. Equal sizes go to the first language by name, with score 0.
    Only the text counts, so repeated rows get equal results. Texts have any length; all of their
    blocks count. An empty table gives an empty table.
    """
    docs = without(docs, "lang_pred", "score", "accepted")
    names = [*docs.columns, "lang_pred", "score", "accepted"]
    place = docs.columns.index("text")
    name = hash(tuple(dictionaries))
    sent = docs.sparkSession.sparkContext.broadcast(dictionaries)

    def batches(them: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = _COMPRESSORS[name] if name in _COMPRESSORS else _compressors(name, sent.value)
        for batch in them:
            rows = [_choose(x, compressors) for x in batch.column(place).to_pylist()]
            own = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *own], names=names)

    return docs.mapInArrow(tidy(batches), widened(docs.schema, _RESULT))


def held_out() -> Column:
    """Rows that the dictionaries never see."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
