"""Language of texts, and of the spans of texts in several languages.

A word is a run of letters. Its script narrows the languages it can be in; its
score in each of them is the log-probability of its letter triples. A Viterbi
path over the words, with a penalty for every change of language, labels spans.

The model is a table of counts per hashed letter triple and language over all
training texts: ``BUCKETS`` rows, whatever the size of the corpus.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexispan.llm.textbytes import SMALL_SLICE_BYTES, letter_runs, mixed, utf8_slices
from lexispan.llm.workers import lean

BUCKETS = 1 << 16
SMOOTHING = 0.05

# What a change of language costs, in nats, and a word in a script its language does not use.
SWITCH = 12.0
FOREIGN = 60.0

# A language uses a script that at least this share of its training letters are in.
SCRIPT_SHARE = 0.001

UNKNOWN = "und"

# Code point ranges of scripts.
SCRIPTS = [
    ("latin", 0x0041, 0x024F), ("latin", 0x1E00, 0x1EFF), ("greek", 0x0370, 0x03FF), ("greek", 0x1F00, 0x1FFF),
    ("cyrillic", 0x0400, 0x052F), ("armenian", 0x0530, 0x058F), ("hebrew", 0x0590, 0x05FF), ("arabic", 0x0600, 0x077F),
    ("devanagari", 0x0900, 0x097F), ("bengali", 0x0980, 0x09FF), ("gurmukhi", 0x0A00, 0x0A7F), ("gujarati", 0x0A80, 0x0AFF),
    ("tamil", 0x0B80, 0x0BFF), ("telugu", 0x0C00, 0x0C7F), ("kannada", 0x0C80, 0x0CFF), ("malayalam", 0x0D00, 0x0D7F),
    ("sinhala", 0x0D80, 0x0DFF), ("thai", 0x0E00, 0x0E7F), ("lao", 0x0E80, 0x0EFF), ("tibetan", 0x0F00, 0x0FFF),
    ("myanmar", 0x1000, 0x109F), ("georgian", 0x10A0, 0x10FF), ("hangul", 0x1100, 0x11FF), ("ethiopic", 0x1200, 0x139F),
    ("khmer", 0x1780, 0x17FF), ("kana", 0x3040, 0x30FF), ("hangul", 0x3130, 0x318F), ("han", 0x3400, 0x4DBF),
    ("han", 0x4E00, 0x9FFF), ("hangul", 0xAC00, 0xD7AF), ("han", 0xF900, 0xFAFF), ("han", 0x20000, 0x2FFFF),
]
SCRIPT_NAMES = ["other", *dict.fromkeys(name for name, _, _ in SCRIPTS)]

ADDED = "lang_pred string, lang_score double, lang_spans array<struct<start:long,stop:long,lang:string>>"


def is_held_out(id_column: str, parts: int, part: int) -> Column:
    """Is the remainder of the id's checksum ``part``? False for a null id."""
    remainder = F.crc32(F.col(id_column).cast("string").cast("binary")) % parts
    return F.coalesce(remainder == part, F.lit(False))


class LanguageModel:
    """Log-probabilities ``[BUCKETS, languages]`` and which scripts each language uses."""

    def __init__(self, languages: list[str], counts: np.ndarray) -> None:
        self.languages = languages
        grams, scripts = counts[:BUCKETS], counts[BUCKETS:]
        totals = grams.sum(axis=0) + SMOOTHING * BUCKETS
        self.log_p = np.log((grams + SMOOTHING) / totals).astype(np.float32)
        self.uses = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(axis=0), 1)
        # By letters seen: decides texts that nothing else decides.
        self.prior = np.log((scripts.sum(axis=0) + 1) / (scripts.sum() + len(languages))) * 1e-3 if languages else None


def fit(docs: DataFrame, text_column: str = "text", lang_column: str = "lang") -> LanguageModel:
    """Counts over all rows that have both a text and a language; only ``BUCKETS`` sums per language reach the driver."""
    known = docs.where(F.col(lang_column).isNotNull() & F.col(text_column).isNotNull())
    languages = sorted(r[0] for r in known.select(F.col(lang_column).cast("string")).distinct().collect())
    number = {lang: i for i, lang in enumerate(languages)}
    width = max(len(languages), 1)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((BUCKETS + len(SCRIPT_NAMES)) * width, np.int64)
        for batch in batches:
            langs = np.array([number[x] for x in batch["lang"].to_pylist()], np.int64)
            for first, data, offsets in utf8_slices(batch["text"], SMALL_SLICE_BYTES):
                runs = letter_runs(data, offsets)
                buckets, _, at = _triples(runs)
                text = np.searchsorted(runs["places"], at, side="right") - 1
                lang = langs[first + text]
                counts += np.bincount(buckets * width + lang, minlength=len(counts))
                counts += np.bincount((_scripts()[runs["chars"][at].astype(np.int64)].astype(np.int64) + BUCKETS) * width + lang, minlength=len(counts))
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], names=["cell", "n"])

    cells = known.select(F.col(text_column).alias("text"), F.col(lang_column).cast("string").alias("lang"))
    sums = cells.mapInArrow(lean(count), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros((BUCKETS + len(SCRIPT_NAMES)) * width, np.float64)
    counts[sums["cell"].to_numpy()] = sums["n"].to_numpy()
    return LanguageModel(languages, counts.reshape(-1, width)[:, : len(languages)])


def identify(docs: DataFrame, model: LanguageModel, text_column: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``lang_score`` (0 to 1) and ``lang_spans`` of code points ``(start, stop, lang)``.

    The prediction is the language of most letters. It is ``und``, with score 0
    and no spans, for a text that is null or has no letter, or if nothing was
    learned. Columns of these names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    added = T.StructType.fromDDL(ADDED)
    rest = docs.drop(*added.names)
    packed = rest.select(F.struct("*").alias("_row"), F.col(text_column).alias("_text"))
    kinds = [pa.string(), pa.float64(), pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("lang", pa.string())]))]

    def label(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in utf8_slices(batch["_text"], SMALL_SLICE_BYTES):
                found = label_texts(shared.value, data, offsets)
                columns = [pa.array([f[i] for f in found], kind) for i, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([batch["_row"].slice(first, len(found)), *columns], names=["_row", *added.names])

    schema = T.StructType([packed.schema["_row"], *added.fields])
    return packed.mapInArrow(lean(label), schema).select("_row.*", *added.names)


@lru_cache(maxsize=1)
def _scripts() -> np.ndarray:
    table = np.zeros(0x110000, np.uint8)
    for name, low, high in SCRIPTS:
        table[low : high + 1] = SCRIPT_NAMES.index(name)
    return table


def _triples(runs: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of every letter with its neighbours (0 outside the word), their word, their place."""
    chars, begin, stop = runs["chars"], runs["begin"], runs["stop"]
    at = np.flatnonzero(chars)
    word = np.searchsorted(begin, at, side="right") - 1
    before = np.where(at > begin[word], chars[at - 1], 0)
    after = np.where(at + 1 < stop[word], chars[np.minimum(at + 1, len(chars) - 1)], 0)
    h = mixed(before << np.uint64(42) | chars[at] << np.uint64(21) | after)
    return (h >> np.uint64(48)).astype(np.int64) & (BUCKETS - 1), word, at


def word_scores(model: LanguageModel, runs: dict[str, np.ndarray]) -> np.ndarray:
    """``[words, languages]``: how well each word fits each language it can be in by its script."""
    n = len(runs["begin"])
    if not n:
        return np.zeros((0, len(model.languages)))
    buckets, word, at = _triples(runs)
    first = np.flatnonzero(np.diff(word, prepend=-1))
    scores = np.add.reduceat(model.log_p[buckets], first, axis=0).astype(np.float64)
    allowed = model.uses[_scripts()[runs["chars"][runs["begin"]].astype(np.int64)]]
    anywhere = allowed.any(axis=1)
    scores[~anywhere] = 0
    scores[anywhere[:, None] & ~allowed] -= FOREIGN
    return scores


def best_path(scores: np.ndarray, penalty: float = SWITCH) -> np.ndarray:
    """The language of every word: the path of most score less ``penalty`` per change."""
    n, k = scores.shape
    single = int(scores.sum(axis=0).argmax())
    if k < 2:
        return np.full(n, single)
    # Leaving the best single language pays only if some stretch of words gains
    # more elsewhere than its changes cost: two, or one at either end.
    others = np.delete(scores, single, axis=1).max(axis=1)
    gain = np.concatenate([[0], np.cumsum(others - scores[:, single])])
    inner = (gain - np.minimum.accumulate(gain)).max()
    if inner <= 2 * penalty and gain.max() <= penalty and (gain[-1] - gain).max() <= penalty:
        return np.full(n, single)
    value = scores[0].copy()
    came = np.empty((n, k), np.int32)
    stay = np.arange(k)
    for i in range(1, n):
        top = int(value.argmax())
        changed = value[top] - penalty
        came[i] = np.where(value >= changed, stay, top)
        value = np.maximum(value, changed) + scores[i]
    path = np.empty(n, np.int64)
    path[-1] = value.argmax()
    for i in range(n - 1, 0, -1):
        path[i - 1] = came[i, path[i]]
    return path


def label_texts(model: LanguageModel, data: np.ndarray, offsets: np.ndarray) -> list[tuple[str, float, list[dict]]]:
    runs = letter_runs(data, offsets)
    scores = word_scores(model, runs) if model.languages else None
    out = []
    for a, b, place in zip(runs["words"][:-1].tolist(), runs["words"][1:].tolist(), runs["places"].tolist()):
        if a == b or scores is None:
            out.append((UNKNOWN, 0.0, []))
            continue
        own = scores[a:b]
        path = best_path(own)
        begin, stop = runs["begin"][a:b], runs["stop"][a:b]
        letters = np.bincount(path, weights=stop - begin, minlength=len(model.languages))
        totals = own.sum(axis=0) + model.prior
        lang = int(np.lexsort((-totals, -letters))[0])
        score = letters[lang] / letters.sum()
        if score == 1:
            # The longer a text, the less its words count as independent witnesses.
            exponents = (totals - totals[lang]) / max(1.0, np.sqrt(b - a))
            score = 1 / np.exp(np.minimum(exponents, 50)).sum()
        ends = np.append(np.flatnonzero(np.diff(path)), b - a - 1)
        starts = np.append(0, ends[:-1] + 1)
        spans = [
            {"start": int(begin[i]) - place, "stop": int(stop[j]) - place, "lang": model.languages[int(path[i])]}
            for i, j in zip(starts, ends)
        ]
        out.append((model.languages[lang], float(min(max(score, 0.0), 1.0)), spans))
    return out
