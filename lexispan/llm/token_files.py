"""Documents as files of token ids, and back.

``write_ids`` tokenises whole texts and writes their ids, in order of document
ids, as blocks of :mod:`lexispan.llm.idcoder`, each with its own model and
checksum. A block holds whole documents; its row names them, with the number of
ids of each. Rows lie in Parquet files, so any store that Spark writes to will do.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain, repeat
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexispan.llm.idcoder import decode_block, encode_block
from lexispan.llm.workers import lean

# Ids per block; a longer document is a block by itself.
BLOCK_IDS = 1 << 20

# Pieces that a task remembers the ids of, how many ids, and how long pieces may be.
REMEMBERED = 500_000
REMEMBERED_IDS = 1 << 23
LONGEST_REMEMBERED = 64

# Pieces are tokenised this many at a time, texts by this many bytes.
TOGETHER = 256
BYTES_TOGETHER = 1 << 22

# Rules by which a text of common characters may be cut into pieces without the library.
KNOWN_NORMALIZER = {
    "type": "Sequence",
    "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}],
}
KNOWN_PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {
            "type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
            "behavior": "Removed", "invert": True,
        },
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
KNOWN_MODEL = {
    "type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "fuse_unk": False, "byte_fallback": False,
    "ignore_merges": False,
}

# Kinds of bytes. Pieces are runs of one kind, single digits, or whole words in which there is any other byte.
SPACE, LETTER, DIGIT, MARK, OTHER = range(5)
LOWER_LATIN = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+")


def _kinds() -> tuple[np.ndarray, dict[int, np.ndarray], np.ndarray]:
    """Kinds of ASCII bytes, those of second bytes after 0xC2 and 0xC3, and ASCII in lower case.

    Other are: apostrophes, as contractions are pieces; "<", as added tokens
    begin with it; control characters; and all code points from 256 on.
    """
    ascii_ = np.full(256, OTHER, np.uint8)
    ascii_[33:127] = MARK
    ascii_[[ord("'"), ord("<")]] = OTHER
    ascii_[[32, *range(9, 14)]] = SPACE
    ascii_[48:58] = DIGIT
    ascii_[65:91] = ascii_[97:123] = LETTER
    after = {0xC2: np.full(256, OTHER, np.uint8), 0xC3: np.full(256, OTHER, np.uint8)}
    after[0xC2][[*range(0xA1, 0xAA), *range(0xAB, 0xB2), 0xB4, 0xB6, 0xB7, 0xB8, 0xBB, 0xBF]] = MARK
    after[0xC3][0x80:0xC0] = LETTER
    after[0xC3][[0x97, 0xB7]] = MARK
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    return ascii_, after, lower


class WordTokenizer:
    """Token ids of whole texts by a tokenizer that joins nothing across spaces.

    Texts are cut into pieces, each distinct piece goes through the tokenizer
    once and its ids are remembered. For the rules above, words of ASCII and
    Latin-1 characters are cut and lower-cased here, as those rules do, and pieces
    of letters go to the same BPE model without them, joined by spaces: each
    ends with its only token that has the end-of-word suffix. Any other word,
    and every word under other rules, is a piece that goes through all of the tokenizer.
    """

    def __init__(self, description: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(description)
        self.letters = self._of_letters(json.loads(description))
        # Pieces are numbered; the ids of number n end at ``stops[n]``, where those of n + 1 begin.
        self.known: dict[str, int] = {}
        self.ids, self.stops = np.zeros(0, "<u4"), np.zeros(0, np.int64)
        self.ascii, self.after, self.lower = _kinds()
        if self.letters is None:
            self.ascii[:] = OTHER
            self.ascii[32] = SPACE
            self.after = {}
            self.lower = np.arange(256, dtype=np.uint8)

    def _of_letters(self, rules: dict):
        """The tokenizer for pieces of letters, or none if the rules are not those known here."""
        from tokenizers import Tokenizer, models, pre_tokenizers

        model, added = rules["model"], [t["content"] for t in rules["added_tokens"]]
        suffix = model.get("end_of_word_suffix")
        if (
            rules["normalizer"] != KNOWN_NORMALIZER or rules["pre_tokenizer"] != KNOWN_PRE_TOKENIZER or rules["post_processor"] is not None
            or not suffix or any(model.get(k) != v for k, v in KNOWN_MODEL.items()) or not all(t.startswith("<") for t in added)
        ):
            return None
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        # Each piece comes once, so the model's own cache would only cost time.
        letters = Tokenizer(models.BPE(vocab=model["vocab"], merges=merges, end_of_word_suffix=suffix, cache_capacity=0))
        letters.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        self.ends = np.zeros(max(model["vocab"].values()) + 1, bool)
        self.ends[[i for token, i in model["vocab"].items() if token.endswith(suffix)]] = True
        return letters

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit numbers."""
        return [x for some in self.encode_column(pa.array(texts, pa.string())) for x in some]

    def encode_column(self, texts: pa.StringArray) -> Iterator[list[bytes]]:
        """The same of the texts of a column, some at a time."""
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int32)
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        at = 0
        while at < len(texts):
            to = max(at + 1, int(np.searchsorted(offsets, int(offsets[at]) + BYTES_TOGETHER, side="right")) - 1)
            yield self._encode(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at])
            at = to

    def _encode(self, data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        pieces, edges = self._pieces(data, offsets)
        coded = pieces.dictionary_encode()
        numbers = self._numbers(coded.dictionary.to_numpy(zero_copy_only=False))
        stops = self.stops[numbers]
        starts = np.where(numbers > 0, self.stops[numbers - 1], 0)
        which = coded.indices.to_numpy()
        # Token ids of every piece in turn: each index runs on from its piece's first id.
        sizes = (stops - starts)[which]
        upto = np.concatenate([[0], np.cumsum(sizes)])
        flat = self.ids[np.repeat(starts[which] - upto[:-1], sizes) + np.arange(upto[-1])]
        at = upto[edges].tolist()
        return [flat[a:b].tobytes() for a, b in zip(at[:-1], at[1:])]

    def _pieces(self, data: np.ndarray, offsets: np.ndarray) -> tuple[pa.StringArray, np.ndarray]:
        """The pieces of texts that lie one after another, and how many pieces are before each text's end."""
        kind = self.ascii[data]
        data = self.lower[data] if not (kind == OTHER).any() else self._lowered(data, kind, offsets)
        filled = kind != SPACE
        begins = np.empty(len(kind), bool)
        begins[:1] = True
        np.not_equal(kind[1:], kind[:-1], out=begins[1:])
        begins |= kind == DIGIT
        begins[offsets[:-1][offsets[:-1] < len(kind)]] = True
        begins &= filled
        edges = np.searchsorted(np.flatnonzero(begins), offsets)
        packed = data[filled]
        starts = np.append(np.flatnonzero(begins[filled]), len(packed)).astype(np.int32)
        return pa.StringArray.from_buffers(len(starts) - 1, pa.py_buffer(starts), pa.py_buffer(packed)), edges

    def _lowered(self, data: np.ndarray, kind: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The bytes with lower-case letters; sets ``kind`` of what is not ASCII, and OTHER for all of a word that holds such a byte."""
        low = self.lower[data]
        for lead, kinds in self.after.items():
            first = np.flatnonzero(data == lead)
            second = data[first + 1]
            kind[first] = kind[first + 1] = kinds[second]
            if lead == 0xC3:
                capital = (second <= 0x9E) & (second != 0x97)
                low[first[capital] + 1] += 32
        odd = np.flatnonzero(kind == OTHER)
        if len(odd):
            # Words end before a space, and with their text.
            stop = np.append(kind == SPACE, True)
            stop[offsets] = True
            stops = np.flatnonzero(stop)
            after = np.searchsorted(stops, odd, side="right")
            words = after[np.append(True, after[1:] != after[:-1])]
            begin, end = stops[words - 1], stops[words]
            begin = begin + (kind[begin] == SPACE)
            sizes = end - begin
            inside = np.repeat(begin - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
            kind[inside] = OTHER
            low[inside] = data[inside]
        return low

    def _numbers(self, pieces: np.ndarray) -> np.ndarray:
        """The numbers of distinct pieces; those not known go through the tokenizer."""
        if len(self.known) > REMEMBERED or len(self.ids) > REMEMBERED_IDS:
            self.known.clear()
            self.ids, self.stops = self.ids[:0], self.stops[:0]
        numbers = np.fromiter(map(self.known.get, pieces, repeat(-1)), np.int64, len(pieces))
        unknown = np.flatnonzero(numbers < 0)
        if len(unknown):
            missing = pieces[unknown].tolist()
            self._learn(missing)
            numbers[unknown] = np.fromiter(map(self.known.get, missing), np.int64, len(missing))
            for piece in missing:
                if len(piece) > LONGEST_REMEMBERED:
                    del self.known[piece]
        return numbers

    def _learn(self, pieces: list[str]) -> None:
        order: list[str] = []
        ids, sizes = [], []
        plain = list(filter(LOWER_LATIN.fullmatch, pieces)) if self.letters is not None else []
        for at in range(0, len(plain), TOGETHER):
            group = plain[at : at + TOGETHER]
            found = np.array(self.letters.encode_batch_fast([" ".join(group)], add_special_tokens=False)[0].ids, "<u4")
            stops = np.flatnonzero(self.ends[found]) + 1
            if len(stops) == len(group):
                order += group
                ids.append(found)
                sizes.append(np.diff(stops, prepend=0))
        other = set(pieces).difference(order)
        other = [w for w in pieces if w in other]
        for at in range(0, len(other), TOGETHER):
            group = other[at : at + TOGETHER]
            found = [e.ids for e in self.tokenizer.encode_batch_fast(group, add_special_tokens=False)]
            order += group
            ids.append(np.fromiter(chain.from_iterable(found), "<u4"))
            sizes.append(np.array([len(x) for x in found], np.int64))
        self.known.update(zip(order, range(len(self.stops), len(self.stops) + len(order))))
        self.stops = np.concatenate([self.stops, len(self.ids) + np.cumsum(np.concatenate(sizes))])
        self.ids = np.concatenate([self.ids, *ids])


_TOKENIZERS: dict[int, WordTokenizer] = {}


def word_tokenizer(description: str) -> WordTokenizer:
    """One per process, so its words stay known from task to task."""
    key = hash(description)
    if key not in _TOKENIZERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _TOKENIZERS[key] = WordTokenizer(description)
    return _TOKENIZERS[key]


def write_ids(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, id_column: str = "doc_id", text_column: str = "text") -> None:
    """Token ids of every row, each document's followed by ``end_id``, in ascending order of ids.

    A null text is empty: its ids are the end id alone. Null ids come first;
    rows of equal ids go by their texts, and each is a document of its own.
    """
    spark = docs.sparkSession
    description = spark.sparkContext.broadcast(Path(tokenizer_path).read_text(encoding="utf-8"))
    plain = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    ordered = plain.repartitionByRange("id", F.xxhash64("text")).sortWithinPartitions("id", F.xxhash64("text"), "text")
    kind = plain.schema["id"].dataType.simpleString()

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        tokenizer = word_tokenizer(description.value)
        end = np.array([end_id], "<u4").tobytes()
        ids: list = []
        held: list[bytes] = []
        size = n_blocks = 0

        def block() -> pa.RecordBatch:
            counts = [len(x) // 4 for x in held]
            coded = encode_block(np.frombuffer(b"".join(held), "<u4"))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()), pa.array([n_blocks], pa.int32()), pa.array([sum(counts)], pa.int64()),
                    pa.array([ids], pa.list_(id_type)), pa.array([counts], pa.list_(pa.int64())), pa.array([coded], pa.binary()),
                ],
                names=["part", "block", "n_ids", "ids", "counts", "coded"],
            )

        for batch in batches:
            id_type = batch["id"].type
            names = iter(batch["id"].to_pylist())
            for some in tokenizer.encode_column(batch["text"].cast(pa.string())):
                for data in some:
                    ids.append(next(names))
                    held.append(data + end)
                    size += len(data) // 4 + 1
                    if size >= BLOCK_IDS:
                        yield block()
                        n_blocks += 1
                        ids, held, size = [], [], 0
        if held:
            yield block()

    schema = f"part int, block int, n_ids long, ids array<{kind}>, counts array<long>, coded binary"
    ordered.mapInArrow(lean(write), schema).write.parquet(folder)


def _decoded(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Every block's row, its ids, and where each document's begin and end among them."""
    for batch in batches:
        for row in range(batch.num_rows):
            one = batch.slice(row, 1)
            ids = decode_block(one["coded"][0].as_py())
            edges = np.concatenate([[0], np.cumsum(one["counts"].flatten().to_numpy())])
            if edges[-1] != len(ids):
                raise ValueError("a block does not hold the ids that its documents have")
            yield one, ids, edges


def _places(block: pa.RecordBatch, edges: np.ndarray) -> list[pa.Array]:
    """Columns ``id``, ``part``, ``block`` and ``at`` of a block's documents."""
    n = len(edges) - 1
    return [block["ids"].flatten(), *(pa.repeat(block[c][0], n) for c in ("part", "block")), pa.array(edges[:-1])]


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """``(id, part, block, place, at, token_ids)`` per document; ``at`` counts the ids before it in its block."""
    blocks = spark.read.parquet(folder)
    kind = blocks.schema["ids"].dataType.elementType.simpleString()

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, ids, edges in _decoded(batches):
            lists = pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(ids))
            *names, at = _places(block, edges)
            yield pa.RecordBatch.from_arrays(
                [*names, pa.array(np.arange(len(edges) - 1, dtype=np.int32)), at, lists],
                names=["id", "part", "block", "place", "at", "token_ids"],
            )

    return blocks.mapInArrow(lean(read), f"id {kind}, part int, block int, place int, at long, token_ids array<long>")


def with_starts(documents: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    """Adds ``start``: how many ids all documents before this one have, by the files' block counts alone."""
    blocks = spark.read.parquet(folder).select("part", "block", "n_ids")
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    # One row per file written.
    upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = parts.select("part", (F.sum("n").over(upto) - F.col("n")).alias("before"))
    in_part = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = blocks.withColumn("in_part", F.sum("n_ids").over(in_part) - F.col("n_ids")).join(parts, "part")
    starts = starts.select("part", "block", (F.col("before") + F.col("in_part")).alias("block_start"))
    return documents.join(starts, ["part", "block"]).withColumn("start", F.col("block_start") + F.col("at")).drop("block_start")


def id_digests(spark: SparkSession, folder: str) -> DataFrame:
    """``(id, start, n_tokens, ids_crc32)`` of every document, from the files."""
    blocks = spark.read.parquet(folder)
    kind = blocks.schema["ids"].dataType.elementType.simpleString()

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, ids, edges in _decoded(batches):
            data = memoryview(ids.astype("<u4").tobytes())
            at = (edges * 4).tolist()
            crcs = [zlib.crc32(data[a:b]) for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays(
                [*_places(block, edges), pa.array(np.diff(edges)), pa.array(crcs, pa.int64())],
                names=["id", "part", "block", "at", "n_tokens", "ids_crc32"],
            )

    sums = blocks.mapInArrow(lean(digest), f"id {kind}, part int, block int, at long, n_tokens long, ids_crc32 long")
    return with_starts(sums, spark, folder).select("id", "start", "n_tokens", "ids_crc32")
