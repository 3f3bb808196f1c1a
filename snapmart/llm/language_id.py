"""Language by compression.

For each language some passages of labelled text become the raw content of a zstandard dictionary. A
text is compressed with every dictionary; the one that leaves the fewest bytes names the language. The
margin to the second best is the score; a narrow one is a rejection. Only letters are compressed, in
lower case, with runs of anything else as one space.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from functools import lru_cache

import regex
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.llm.common import map_texts

UNKNOWN = "und"
FOLDS = 5
# The sample a language is learned from is bounded: one passage of so many characters from each of so
# many buckets of documents.
BUCKETS = 64
PASSAGE_CHARS = 1600
LEVEL = 6
NARROW = 0.01

_NO_LETTERS = regex.compile(r"[^\p{L}]+")


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 0 when divided by 5; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS == 0


def letters(text: str | None) -> str:
    """The text's letters in lower case, with a space before, after and for everything between."""
    return " " + _NO_LETTERS.sub(" ", (text or "").lower()).strip(" ") + " "


def learn(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> list[tuple[str, bytes]]:
    """``(language, dictionary content)``, the most frequent first, from documents that are not held out.

    All labelled documents compete by hash; in each of 64 buckets of a language the smallest hash gives
    one passage. At most languages x 64 passages come to the driver. Without labels the list is empty.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.where(F.col(lang).isNotNull() & ~held_out(F.col(doc_id)) & body.rlike(r"\p{L}")).select(
        F.col(lang).alias("lang"), body.alias("text"), F.xxhash64(F.col(doc_id), body).alias("hash"))
    least = rows.groupBy("lang", F.pmod("hash", F.lit(BUCKETS)).alias("bucket")).agg(
        F.min("hash").alias("hash"), F.count(F.lit(1)).alias("rows"))
    best = least.collect()
    chosen, counts = [r.hash for r in best], Counter()
    for r in best:
        counts[r.lang] += r["rows"]
    first = 1 + F.pmod(F.shiftright("hash", 8), F.greatest(F.length("text") - PASSAGE_CHARS + 1, F.lit(1))).cast("int")
    passages = (
        rows.where(F.col("hash").isin(chosen))
        .select("lang", "hash", F.substring(F.col("text"), first, F.lit(PASSAGE_CHARS)).alias("passage"))
        .dropDuplicates(["lang", "hash"]).collect()
    )
    found: dict[str, list[str]] = {}
    for row in sorted(passages, key=lambda r: (r.lang, r.hash)):
        found.setdefault(row.lang, []).append(letters(row.passage))
    return [(name, "".join(found[name]).encode()) for name in sorted(found, key=lambda n: (-counts[n], n))]


@lru_cache(maxsize=2)
def compressors(model: tuple[tuple[str, bytes], ...], level: int) -> list[tuple[str, zstandard.ZstdCompressor]]:
    ready = []
    for name, content in model:
        held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        held.precompute_compress(level=level)
        ready.append((name, zstandard.ZstdCompressor(level=level, dict_data=held, write_content_size=False,
                                                     write_checksum=False, write_dict_id=False)))
    return ready


def classify(text: str | None, ready: Sequence[tuple[str, zstandard.ZstdCompressor]]) -> tuple[str, float]:
    """Language and score of a text: how much smaller than with the second best dictionary it gets."""
    body = letters(text).encode()
    if not ready or body.isspace():
        return UNKNOWN, 0.0
    sizes = sorted((len(c.compress(body)), i) for i, (_, c) in enumerate(ready))
    best, at = sizes[0]
    return ready[at][0], 1.0 if len(sizes) == 1 else (sizes[1][0] - best) / max(sizes[1][0], 1)


def predict(docs: DataFrame, model: Sequence[tuple[str, bytes]], level: int = LEVEL, narrow: float = NARROW,
            doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``<doc_id>, held_out, lang_pred, score, rejected`` for every row, from the whole text alone.

    ``lang_pred`` is the best language, ``und`` for a null text, one without a letter, or if nothing was
    learned; equal sizes go to the more frequent one. ``rejected`` says that the margin is below ``narrow``: a
    caller who wants only sure answers takes ``und`` there. Repeated rows each get a row.
    """
    model = tuple(model)

    def work(texts):
        ready = compressors(model, level)
        return [list(c) for c in zip(*(classify(t, ready) for t in texts))]

    return map_texts(docs, doc_id, text, work, "lang_pred string, score double").select(
        doc_id, held_out(F.col(doc_id)).alias("held_out"), "lang_pred", "score",
        (F.col("score") < narrow).alias("rejected"))
