"""Language identification by compression.

Each language has a zstandard raw-content dictionary: short excerpts of training texts in
that language. A text is cut into blocks, each block is compressed with every dictionary,
and the language whose dictionary leaves the fewest bytes wins. Where the best and the
second best are close, the text is rejected.

Before compression texts are lower-cased, anything but letters becomes one space, and a
word that is repeated at once is kept once. Texts without a letter are ``und``. Ties go to the
language with more training rows.

The fit reads all labelled rows to count languages and their different texts and takes its excerpts from
a bounded, hash-chosen sample: ``sample_rows`` expected different texts and ``dictionary_bytes`` a
language. Every language has a dictionary. Where all of them would take more than ``total_bytes``, each
has its part of that, and as much smaller a sample.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


DICTIONARY_BYTES = 256 << 10
EXCERPT_CHARS = 300
SAMPLE_ROWS = 1500
TOTAL_BYTES = 64 << 20  # of all dictionaries
LEAST_ROWS = 30  # expected of any language, so that none is missed by chance
MIN_MARGIN = 0.003
_BLOCK_BYTES = 2048
_LEVEL = 5
_FRAME_BYTES = 6  # what an empty frame takes

_OTHERS = re.compile(r"[\W\d_]+")
_AGAIN = re.compile(r"\b(\w+)(?: \1\b)+")


def letters(text: str | None) -> str:
    """Lower-cased letters, words separated by one space."""
    found = _OTHERS.sub(" ", (text or "").lower()).strip()
    if found and not found.replace(" ", "").isalpha():  # numerals such as powers and fractions pass for letters
        found = " ".join("".join(c if c.isalpha() else " " for c in found).split())
    return _AGAIN.sub(r"\1", found)


def held_out(doc_id: str, parts: int, part: int) -> Column:
    """Rows whose crc32 of the id as text leaves ``part``; a row without an id is held out."""
    rest = F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts
    return F.coalesce(rest == part, F.lit(True))


def fit_dictionaries(train: DataFrame, dictionary_bytes: int = DICTIONARY_BYTES,
                     sample_rows: int = SAMPLE_ROWS,
                     total_bytes: int = TOTAL_BYTES) -> dict[str, bytes]:
    """Dictionary of each language of ``train`` (text, lang), most frequent language first."""
    known = train.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang")
    counts = (
        known.groupBy("lang", F.xxhash64("text").alias("h")).count()  # copies count once in the sample
        .groupBy("lang").agg(F.sum("count").alias("rows"), F.count("*").alias("texts"))
        .orderBy(F.desc("rows"), "lang").collect()
    )
    if not counts:
        return {}
    own_bytes = max(1, min(dictionary_bytes, total_bytes // len(counts)))
    own_rows = max(1, sample_rows * own_bytes // dictionary_bytes)
    spark = train.sparkSession
    shares = spark.createDataFrame([(r.lang, min(1.0, max(LEAST_ROWS, own_rows) / r.texts)) for r in counts],
                                   "lang string, share double")
    place = F.pmod(F.xxhash64("text"), F.lit(1 << 20))
    room = F.greatest(F.length("text") - EXCERPT_CHARS, F.lit(1))
    sample = (
        known.join(F.broadcast(shares), "lang")
        .filter(place < F.col("share") * (1 << 20))
        .select("lang", F.xxhash64("text", F.lit(1)).alias("h"),
                F.substring("text", (1 + F.pmod(F.xxhash64("text", F.lit(2)), room)).cast("int"),
                            F.lit(EXCERPT_CHARS)).alias("excerpt"))
        .distinct()
        .withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("h")))  # of the sample
        .filter(F.col("n") <= 2 * own_rows)
    )
    held: dict[str, list[bytes]] = {r.lang: [] for r in counts}
    for row in sample.orderBy("lang", "h").collect():
        held[row.lang].append(letters(row.excerpt).encode())
    return {lang: b" ".join(parts)[:own_bytes] for lang, parts in held.items() if any(parts)}


_PREDICTION = "lang_pred string, score double, margin double, rejected boolean"


def predictor(dictionaries, min_margin: float = MIN_MARGIN):
    """Column function text -> lang_pred, score (probability of the best against the others if every
    byte saved doubles the odds), margin (relative, to the second best), rejected."""

    @F.arrow_udf(_PREDICTION)
    def predict(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coders = {}
        for lang, content in dictionaries.value.items():
            own = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            own.precompute_compress(level=_LEVEL)
            coders[lang] = zstandard.ZstdCompressor(
                level=_LEVEL, dict_data=own, write_content_size=False, write_checksum=False,
                write_dict_id=False,
            ).compress
        for batch in texts:
            found = [_best(coders, letters(t).encode(), min_margin) for t in batch.to_pylist()]
            columns = list(zip(*found, strict=True)) or [()] * 4
            yield pa.StructArray.from_arrays(
                [pa.array(c, t) for c, t in
                 zip(columns, (pa.string(), pa.float64(), pa.float64(), pa.bool_()), strict=True)],
                names=["lang_pred", "score", "margin", "rejected"])

    return predict


def _best(coders: dict, text: bytes, min_margin: float) -> tuple[str, float, float, bool]:
    if not text or not coders:
        return "und", 0.0, 0.0, True
    sizes = {
        lang: sum(len(code(text[at : at + _BLOCK_BYTES])) - _FRAME_BYTES
                  for at in range(0, len(text), _BLOCK_BYTES))
        for lang, code in coders.items()
    }
    order = sorted(sizes, key=sizes.get)
    least = sizes[order[0]]
    score = 1 / sum(2.0 ** max(-1000, least - s) for s in sizes.values())
    margin = (sizes[order[1]] - least) / max(1, least) if len(order) > 1 else 1.0
    return order[0], score, margin, margin < min_margin


def identify(docs: DataFrame, train: DataFrame, column: str = "language",
             min_margin: float = MIN_MARGIN) -> DataFrame:
    """All columns of ``docs`` and a struct ``column``: lang_pred, score, margin, rejected.

    ``train`` (text, lang) is what is learned from. Only the text decides a prediction.
    Without a single labelled row every text is ``und`` and rejected. A ``column`` that is there
    already is replaced. Repeated rows are predicted like any other and count once in what is learned.
    """
    fitted = docs.sparkSession.sparkContext.broadcast(fit_dictionaries(train))
    return docs.withColumn(column, predictor(fitted, min_margin)(F.col("text").cast("string")))
