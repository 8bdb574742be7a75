"""Language identification by compression.

Each language has a zstandard raw-content dictionary, a bounded sample of its
labelled texts.  A text is encoded with every dictionary, block by block, and
the language whose dictionary makes it smallest wins.  The difference to the
second smallest is the margin; a text whose margin is narrow, or that holds no
letter, is rejected.

What is narrow is measured, not set: random letters in the shape of a
language's words are encoded with the same dictionaries, and a text must beat
the margin that nearly all of them stay under at its encoded size.  A margin
between two dictionaries is a sum of many small chances, so it grows with the
square root of the size; the bars are kept in that unit.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import ship_package, tidy

LETTER = regex.compile(r"\p{L}")
UNKNOWN = "und"
DICTIONARY_BYTES = 96 * 1024   # of sampled text in a language's dictionary
SAMPLE_ROWS = 400              # labelled rows a language's dictionary is taken from
ROW_CHARS = 512                # code points of one sampled row in a dictionary
MAX_LANGUAGES = 1000           # more labels than this raise: the sample goes through the driver
BLOCK_BYTES = 4096             # a text is encoded in blocks of about this size
LEVEL = 6                      # zstandard level
SHORT_BYTES, SHORT_LEVEL = 512, 12   # short texts are searched harder, so that fewer sizes tie
NARROW = 0.01                  # share of random-letter texts whose margin may count as wide
RANDOM_TEXTS = 120             # random-letter texts of a language and length that set its bar
RANDOM_WORDS = (8, 25, 80, 250, 800)   # their lengths


def held_out(id_col: str) -> Column:
    """crc32 of the id as text leaves the remainder 1 by 3 (false for a null id)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learn_dictionaries(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                       sample_rows: int = SAMPLE_ROWS) -> dict[str, bytes]:
    """Raw-content dictionary per language from a bounded sample of ``df``'s labelled rows.

    The sample: of each language the ``sample_rows`` rows smallest by a hash of
    their id (every row is considered, on two narrow columns; which rows are
    taken doesn't depend on how the table is split); repeated rows of an id count once.  A row gives the
    ``ROW_CHARS`` code points from its first letter on, wherever that is.  Rows without id, text,
    label or letter teach nothing.  No labelled row: no language."""
    order = F.xxhash64(F.col(id_col), F.lit(10))
    head = F.regexp_substr(F.col(text_col), F.lit(rf"\p{{L}}[\s\S]{{0,{ROW_CHARS - 1}}}"))
    known = df.where(F.col(id_col).isNotNull() & F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
    # ids that can teach; twice the sample passes the bound, so an estimate will do
    sizes = {r["_lang"]: r["n"] for r in known.groupBy(F.col(lang_col).alias("_lang")).agg(F.approx_count_distinct(order).alias("n"))
             .limit(MAX_LANGUAGES + 1).collect()}
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not sizes:
        return {}
    # rows under a hash bound that lets about twice the sample of each language through
    bound = F.create_map(*(F.lit(x) for lang, n in sizes.items()
                           for x in (lang, -(2.0 ** 63) + min(1.0, (2.0 * sample_rows + 50) / n) * 2.0 ** 64)))
    texts = (known.where(order <= F.element_at(bound, F.col(lang_col)))
             .select(F.col(lang_col).alias("_lang"), order.alias("_order"), head.alias("_t"))
             .groupBy("_lang", "_order").agg(F.min("_t").alias("_t")).collect())
    parts: dict[str, list[bytes]] = {}
    for r in sorted(texts, key=lambda r: (r["_lang"], r["_order"])):
        own = parts.setdefault(r["_lang"], [])
        if len(own) < sample_rows and LETTER.search(r["_t"]):
            own.append(r["_t"].lower().encode("utf-8", "replace"))
    return {lang: b"\n".join(p)[:DICTIONARY_BYTES] for lang, p in sorted(parts.items()) if p}


@lru_cache(maxsize=4)
def _compressors(dictionaries: tuple[tuple[str, bytes], ...], level: int):
    """``(language, for texts, for short texts)`` per language, made once per worker."""
    def of(content, at):
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=at)
        return zstandard.ZstdCompressor(level=at, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)

    return [(lang, of(content, level), of(content, SHORT_LEVEL)) for lang, content in dictionaries]


def encoded_sizes(text: str, compressors) -> np.ndarray:
    """Bytes of the whole text (lower-cased) under each dictionary, in blocks of near equal size."""
    raw = text.lower().encode("utf-8", "replace")
    if len(raw) <= SHORT_BYTES:
        return np.array([len(short.compress(raw)) for _, _, short in compressors], np.int64)
    n = max(1, -(-len(raw) // BLOCK_BYTES))
    step = -(-len(raw) // n) or 1
    sizes = np.zeros(len(compressors), np.int64)
    for at in range(0, len(raw), step):
        block = raw[at:at + step]
        sizes += [len(c.compress(block)) for _, c, _ in compressors]
    return sizes


def random_texts(content: bytes, words: int, n: int, seed: int) -> list[str]:
    """``n`` texts of ``words`` words as long as ``content``'s, their letters drawn evenly
    from the commonest of ``content`` (those that make up 99 % of it)."""
    text = content.decode("utf-8", "ignore")
    rng = np.random.default_rng(seed)
    letters, counts = np.unique(np.array(LETTER.findall(text)), return_counts=True)
    order = np.argsort(-counts, kind="stable")
    letters = letters[order][:int(np.searchsorted(np.cumsum(counts[order]), 0.99 * counts.sum())) + 1]
    lengths = np.array([len(w) for w in text.split()])
    out = []
    for _ in range(n):
        cut = np.cumsum(rng.choice(lengths, words))
        drawn = "".join(rng.choice(letters, cut[-1]))
        out.append(" ".join(drawn[a:b] for a, b in zip([0, *cut[:-1]], cut)))
    return out


def margin_bars(spark: SparkSession, dictionaries: dict[str, bytes], level: int = LEVEL, narrow: float = NARROW) -> dict[str, list[tuple[float, float]]]:
    """Per language ``(encoded size, bar)`` by rising size: all but ``narrow`` of the random-letter
    texts of that size have a margin under ``bar`` times the root of the size.

    One row a language, so the encoding is spread over the cluster; five pairs of
    numbers a language come back.  Fewer than two languages: no bars."""
    content = tuple(sorted(dictionaries.items()))
    if len(content) < 2:
        return {}

    ship_package(spark)

    def run(batches):
        compressors = _compressors(content, level)
        for b in batches:
            for i in b.column(0).to_pylist():
                points = []
                for words in RANDOM_WORDS:
                    sizes = np.array([np.partition(encoded_sizes(t, compressors), 1)[:2] for t in random_texts(content[i][1], words, RANDOM_TEXTS, i)])
                    root = np.sqrt(sizes[:, 0])
                    points.append((float(np.median(sizes[:, 0])), float(np.quantile((sizes[:, 1] - sizes[:, 0]) / root, 1 - narrow))))
                yield pa.RecordBatch.from_arrays([pa.array([content[i][0]]), pa.array([[p[0] for p in points]]), pa.array([[p[1] for p in points]])], names=["lang", "size", "bar"])

    rows = (spark.range(0, len(content), 1, len(content)).mapInArrow(tidy(run), "lang string, size array<double>, bar array<double>").collect())
    return {r["lang"]: sorted(zip(r["size"], r["bar"])) for r in rows}


def _is_narrow(sizes: np.ndarray, names: list[str], bars: dict[str, list[tuple[float, float]]]) -> bool:
    """Whether the smallest size is too near to the second: at most the bar of its language
    at that size (between measured sizes by the logarithm; beyond the largest a margin
    may grow with the size itself, since one dictionary may suit random letters a little better)."""
    if len(sizes) < 2:
        return False
    best, second = np.partition(sizes, 1)[:2]
    at, bar = zip(*bars[names[int(sizes.argmin())]])
    return bool(second - best <= np.interp(np.log(best), np.log(at), bar) * np.sqrt(best * max(1.0, best / at[-1])))


def identify(df: DataFrame, dictionaries: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text",
             level: int = LEVEL, narrow: float = NARROW) -> DataFrame:
    """``id_col``, ``lang_pred``, ``score``, ``rejected`` per row of ``df``, from the text alone.

    ``lang_pred`` is the language of the smallest encoding (ties: the first
    name), ``und`` for a null text, one without a letter, or when no language
    was learned.  ``score`` (0 to 1): how much of the weight the chosen
    language has when a language weighs 2 to the minus eighth part of the
    bits its encoding is longer; 0 for ``und``.  ``rejected``: ``und``, or the
    margin to the second smallest is one that more than ``narrow`` of random-letter texts
    reach (:func:`margin_bars`; with
    one language there is no second, so no margin to be narrow).  Repeated
    rows and null ids are judged like any other row."""
    id_type = df.schema[id_col].dataType.simpleString()
    content = tuple(sorted(dictionaries.items()))
    bars = margin_bars(df.sparkSession, dictionaries, level, narrow)

    def run(batches):
        compressors = _compressors(content, level)
        names = [lang for lang, _, _ in compressors]
        for b in batches:
            langs, scores, rejected = [], [], []
            for t in b.column(1):
                text = t.as_py()
                if not text or not names or not LETTER.search(text):
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    rejected.append(True)
                    continue
                sizes = encoded_sizes(text, compressors)
                best = int(sizes.argmin())
                langs.append(names[best])
                scores.append(float(1.0 / np.exp2(-np.minimum(sizes - sizes[best], 1000).astype(float)).sum()))
                rejected.append(_is_narrow(sizes, names, bars))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
                                             names=[id_col, "lang_pred", "score", "rejected"])

    return df.select(F.col(id_col), F.col(text_col)).mapInArrow(tidy(run), f"`{id_col}` {id_type}, lang_pred string, score double, rejected boolean")


def accepted(df: DataFrame, dictionaries: dict[str, bytes], text_col: str = "text", level: int = LEVEL, narrow: float = NARROW) -> DataFrame:
    """The rows of ``df`` whose language is told (see :func:`identify`); all columns as they are."""
    content = tuple(sorted(dictionaries.items()))
    bars = margin_bars(df.sparkSession, dictionaries, level, narrow)
    at = df.columns.index(text_col)

    def run(batches):
        compressors = _compressors(content, level)
        names = [lang for lang, _, _ in compressors]
        for b in batches:
            keep = []
            for t in b.column(at):
                text = t.as_py()
                ok = bool(text) and bool(compressors) and bool(LETTER.search(text))
                keep.append(ok and not _is_narrow(encoded_sizes(text, compressors), names, bars))
            yield b.filter(pa.array(keep, pa.bool_()))

    return df.mapInArrow(tidy(run), df.schema)
