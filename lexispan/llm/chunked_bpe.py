"""Byte-level BPE that encodes passages shared by documents once.

1. A hash of the bytes around each place cuts texts into chunks, so equal
   passages are cut alike wherever they stand. Chunks are counted by digest;
   those that occur again are *shared*.
2. A text without shared chunks is encoded where it is read. Of the others, the
   stretches between shared chunks are encoded there; a shared chunk goes, once
   per task, to where all its copies meet and is encoded once. Which chunks may
   be shared is told by a bit map of bounded size: a chosen one that is not
   shared only takes the longer way. Texts are cut again in each pass, which is
   cheaper than writing down what was cut.
3. The ids of a text's pieces come together again, by a digest of the text, so
   copies of a text are put together once. At each join the ids may be wrong:
   the tokenizer's pattern, or a merge, can reach across. The text around a join
   is encoded again, from the last place before it where the pattern must break
   to the first such place after it, by pieces if need be, until the new ids meet
   the old ones on both sides. The pattern breaks between a letter, digit or mark
   and a character of another kind, wherever that stands (see ``BREAKS``), so the
   ids are those of the whole text.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterable, Iterator
from functools import cached_property, lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexispan.llm.bitmaps import bit_map, may_hold
from lexispan.llm.textbytes import gram_hashes, utf8_slices
from lexispan.llm.workers import lean
from lexispan.sources.workspace import materialized

# Bytes that decide about a cut; how often they cut; the least and greatest size of a chunk.
WINDOW, CUT_BITS, LEAST, MOST = 32, 9, 64, 8192

# Stretches between spaces that a task remembers the ids of, and how long they may be.
REMEMBERED, LONGEST_REMEMBERED = 500_000, 64

# The pattern of byte-level BPE, by the tokenizer library's definition.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Characters whose kind is the same in every version of Unicode. A text with others goes to the library as it is.
SPACES = r" \t\n\r\f\v"
LETTERS = "A-Za-zÀ-ÖØ-öø-ƺА-яЁёα-ρσ-ωぁ-ゔァ-ヺ一-龥가-힣"
DIGITS = "0-9"
MARKS = r"!-&(-/:-@\[-`{-~¡§«¬±¶·»¿×÷‐-‧‹›€、。「」！"
PLAIN = regex.compile(f"[{SPACES}{LETTERS}{DIGITS}{MARKS}']*+")

# What is or once was white space, but for the space and the line feed.
OTHER_SPACE = re.compile("[\\t\\r\\x0b\\x0c\\x1c-\\x1f\\x85\\xa0\\u1680\\u180e\\u2000-\\u200f\\u2028-\\u202f\\u205f-\\u206f\\u3000\\ufeff]")

# Places where the pattern breaks whatever stands before and after the two characters there. It never
# breaks off a space from what follows, and an apostrophe takes some letters.
BREAKS = "|".join(
    [
        f"(?<=[{LETTERS}{DIGITS}{MARKS}'])(?=[{SPACES}])",
        f"(?<=[{LETTERS}])(?=[{DIGITS}{MARKS}'])",
        f"(?<=[{DIGITS}])(?=[{LETTERS}{MARKS}'])",
        f"(?<=[{MARKS}'])(?=[{DIGITS}])",
        f"(?<=[{MARKS}])(?=[{LETTERS}])",
    ]
)
FIRST_BREAK, LAST_BREAK = regex.compile(BREAKS), regex.compile(f"(?r){BREAKS}")


class ByteBpe:
    """A byte-level BPE tokenizer, by the text of its JSON file.

    ``by_rank`` says that merging by ranks of tokens gives its ids (see
    :func:`merges_by_rank`); plain text then goes to the faster library.
    """

    def __init__(self, description: str, by_rank: bool = False) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        config = json.loads(description)
        before = config["pre_tokenizer"] or {}
        added = config.get("added_tokens", [])
        if before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True) or config["normalizer"]:
            raise ValueError("not a byte-level BPE tokenizer of whole texts")
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError("special tokens that take in what stands around them")
        self.tokenizer = Tokenizer.from_str(description)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = {t["content"]: t["id"] for t in added}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.split = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if added else None
        spelled = _byte_of_character()
        self.bytes = [b""] * self.tokenizer.get_vocab_size(with_added_tokens=True)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=True).items():
            known = all(c in spelled for c in token)
            self.bytes[i] = bytes(spelled[c] for c in token) if known else token.encode()
        self.sizes = np.array([len(b) for b in self.bytes], np.int64)
        self.decimal = [str(i) for i in range(len(self.bytes))]
        ranks = {b: i for i, b in enumerate(self.bytes) if i not in self.special.values()} if by_rank else {}
        self.ranked = tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}) if by_rank else None
        # Ids as they are kept and sent.
        self.kind = np.dtype("<u2" if len(self.bytes) <= 1 << 16 else "<u4")
        self.after_space: dict[str, bytes] = {}  # ids of a space with what follows up to the next

    def segments(self, text: str) -> list[tuple[str, int]]:
        """``(text, -1)`` for plain text and ``(text, id)`` for special tokens, in order; nothing empty."""
        if self.split is None or not any(s in text for s in self.special):
            return [(text, -1)] if text else []
        return [(t, self.special.get(t, -1)) for t in self.split.split(text) if t]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts without special tokens.

        The pattern breaks before every space between other characters than white
        space, so such a text is looked up by its stretches between spaces.
        """
        easy = [not (OTHER_SPACE.search(t) or "  " in t or " \n" in t or "\n " in t) for t in texts]
        stretches = [t.split(" ") if e else [t] for t, e in zip(texts, easy)]
        heads = iter(self._direct([x[0] for x in stretches]))
        if len(self.after_space) > REMEMBERED:
            self.after_space.clear()
        get = self.after_space.get
        found = [list(map(get, x[1:])) for x in stretches]
        missing = list({w for x, ids in zip(stretches, found) if None in ids for w, i in zip(x[1:], ids) if i is None})
        fresh = self._after_spaces(missing)
        out = []
        for x, ids in zip(stretches, found):
            rest = b"".join([fresh[w] if i is None else i for w, i in zip(x[1:], ids)] if None in ids else ids)
            out.append(np.frombuffer(next(heads) + rest, self.kind))
        self.after_space.update((w, x) for w, x in fresh.items() if len(w) <= LONGEST_REMEMBERED)
        return out

    def _after_spaces(self, stretches: list[str]) -> dict[str, bytes]:
        """Ids of stretches with a space before each, many at a time: they are broken at the spaces."""
        plain = [w for w in stretches if w and not w[0].isspace()] if self.ranked is not None else []
        fresh: dict[str, bytes] = {}
        for at in range(0, len(plain), 512):
            group = plain[at : at + 512]
            text = " " + " ".join(group)
            if not PLAIN.fullmatch(text):
                group = [w for w in group if PLAIN.fullmatch(w)]
                text = " " + " ".join(group)
            if group:
                ids = np.array(self.ranked.encode_ordinary(text), self.kind)
                stops = np.cumsum(self.sizes[ids])
                bounds = np.searchsorted(stops, np.cumsum([len(w.encode()) + 1 for w in group])) + 1
                data, width = ids.tobytes(), self.kind.itemsize
                edges = [0, *(bounds * width).tolist()]
                fresh.update((w, data[a:b]) for w, a, b in zip(group, edges[:-1], edges[1:]))
        left = [w for w in stretches if w not in fresh]
        return fresh | dict(zip(left, self._direct([" " + w for w in left])))

    def _direct(self, texts: list[str]) -> list[bytes]:
        """Ids by the libraries; a text with characters of doubtful kind goes to the one that defines them."""
        out: list = [None] * len(texts)
        if self.ranked is not None:
            ids = self.ranked.encode_ordinary
            out = [np.array(ids(t), self.kind).tobytes() if PLAIN.fullmatch(t) else None for t in texts]
        left = [i for i, x in enumerate(out) if x is None]
        if left:
            encoded = self.tokenizer.encode_batch_fast([texts[i] for i in left], add_special_tokens=False)
            for i, e in zip(left, encoded):
                out[i] = np.array(e.ids, self.kind).tobytes()
        return out

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts, special tokens included."""
        parts = [self.segments(t) for t in texts]
        plain = iter(self.encode([t for segments in parts for t, i in segments if i < 0]))
        return [self._joined([next(plain) if i < 0 else np.array([i], self.kind) for _, i in segments]) for segments in parts]

    def _joined(self, parts: list[np.ndarray]) -> np.ndarray:
        return np.concatenate(parts) if parts else np.zeros(0, self.kind)

    def decoded(self, ids: np.ndarray) -> str:
        return b"".join(map(self.bytes.__getitem__, ids.tolist())).decode("utf-8", "replace")

    # -- joins ------------------------------------------------------------

    def repaired(self, pieces: list[tuple[np.ndarray, bool]]) -> np.ndarray:
        """Ids of a text from the ids of its consecutive pieces; a special token is a piece marked so."""
        out: list = []  # ids, or the place of a text in ``again``
        again: list[str] = []
        tail_text: list[str] = []  # what stands after the last break so far
        tail_ids: np.ndarray | None = np.zeros(0, self.kind)  # its ids; None if they have to be found anew

        def close() -> None:
            nonlocal tail_text, tail_ids
            if tail_ids is None:
                out.append(len(again))
                again.append("".join(tail_text))
            else:
                out.append(tail_ids)
            tail_text, tail_ids = [], np.zeros(0, self.kind)

        for ids, special in pieces:
            if special:
                close()
                out.append(ids)
                continue
            text = self.decoded(ids)
            edges = np.cumsum(self.sizes[ids])
            if not tail_text or FIRST_BREAK.match(tail_text[-1][-1] + text[0], 1):
                close()
                first = 0
            else:
                first = self._edge(FIRST_BREAK.search(text, 1), text, edges)
                tail_text.append(text if first is None else text[: first[0]])
                tail_ids = None
                if first is None:
                    continue
                close()
                first = first[1]
            last = self._edge(LAST_BREAK.search(text, 1), text, edges)
            if last is None or last[1] < first:
                tail_text, tail_ids = [text], ids
            else:
                out.append(ids[first : last[1]])
                tail_text, tail_ids = [text[last[0] :]], ids[last[1] :]
        close()
        fresh = self.encode(again)
        return self._joined([fresh[x] if isinstance(x, int) else x for x in out])

    @staticmethod
    def _edge(found, text: str, edges: np.ndarray) -> tuple[int, int] | None:
        """``(place in the text, number of ids before it)`` of a break that lies between two ids."""
        if found is None:
            return None
        place = len(text[: found.start()].encode())
        at = int(np.searchsorted(edges, place))
        return (found.start(), at + 1) if at < len(edges) and edges[at] == place else None


def _byte_of_character() -> dict[str, int]:
    """How byte-level tokens spell bytes: printable ones as themselves, the others by characters from 256 on."""
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def merges_by_rank(description: str) -> bool:
    """Whether joining the neighbours whose token has the least id gives what the listed merges give.

    It does if ids ascend with the merges and, for every token, joining its
    bytes by lesser ids leaves the very two parts of its merge. For when two
    neighbours could be joined to a token, nothing has been joined across its
    ends, so its bytes have been joined as if they stood alone: what is left are
    the parts of its merge.
    """
    model = json.loads(description)["model"]
    spelled = _byte_of_character()
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    numbers = {bytes(spelled[c] for c in t): i for t, i in model["vocab"].items() if all(c in spelled for c in t)}
    last = -1
    for left, right in merges:
        left, right = (bytes(spelled[c] for c in part) for part in (left, right))
        number = numbers.get(left + right, -1)
        if number <= last or len(left) + len(right) < 2:
            return False
        last = number
        parts = [bytes([b]) for b in left + right]
        while len(parts) > 2:
            joined = [numbers.get(a + b, number) for a, b in zip(parts, parts[1:])]
            least = min(joined)
            if least >= number:
                return False
            at = joined.index(least)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        if parts != [left, right]:
            return False
    # Every other token is a single byte, or is never made.
    return len(merges) + 256 == len(numbers) and min(len(b) for b in numbers) == 1


_LOADED: dict[str, ByteBpe] = {}


def byte_bpe(described: tuple[str, bool]) -> ByteBpe:
    """One per process, so what it knows stays from task to task."""
    key = hashlib.sha256(repr(described).encode()).hexdigest()
    if key not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _LOADED[key] = ByteBpe(*described)
    return _LOADED[key]


@lru_cache(maxsize=4)
def described(path: str) -> tuple[str, bool]:
    """What workers need to know of a tokenizer file, found out once on the driver."""
    text = Path(path).read_text(encoding="utf-8")
    return text, merges_by_rank(text)


# -- chunks ------------------------------------------------------------------


def chunk_bounds(data: np.ndarray, offsets: np.ndarray, cut_bits: int = CUT_BITS, least: int = LEAST, most: int = MOST) -> list[list[int]]:
    """For each text the places of its cuts in ``data``, its begin and end included.

    A place is a cut if the low bits of the hash of the bytes from it on are all
    0, at a character's first byte, and ``least`` bytes after the cut before;
    without one for ``most`` bytes the next character is cut.
    """
    starts = (data & 0xC0) != 0x80
    if len(data) > WINDOW:
        low = (gram_hashes(data, WINDOW) & np.uint64((1 << cut_bits) - 1)) == 0
        candidates = np.flatnonzero(low & starts[: len(low)])
    else:
        candidates = np.zeros(0, np.int64)
    out = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        # The window must lie in the text: chunks depend on the text alone.
        here = candidates[np.searchsorted(candidates, a) : np.searchsorted(candidates, b - WINDOW, side="right")].tolist()
        cuts = [a]
        for place in [*here, b]:
            while place - cuts[-1] > most:
                forced = cuts[-1] + most
                while forced < place and not starts[forced]:
                    forced += 1
                if forced >= place:
                    break
                cuts.append(forced)
            if place - cuts[-1] >= least or place == b:
                cuts.append(place)
        out.append(cuts)
    return out


def _digest(data: bytes) -> tuple[int, int]:
    digest = hashlib.blake2b(data, digest_size=16).digest()
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def text_chunks(column: pa.Array, bpe: ByteBpe, sizes: tuple[int, int, int]) -> Iterator[tuple[int, str, list[tuple[bytes, int]]]]:
    """``(row, text, [(chunk, -1 or the id of a special token)])`` of each text."""
    for first, data, offsets in utf8_slices(column):
        raw = data.tobytes()
        texts = [raw[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        bounds = chunk_bounds(data, offsets, *sizes)
        for i, text in enumerate(texts):
            decoded = text.decode("utf-8", "replace")
            segments = bpe.segments(decoded)
            if len(segments) == 1 and segments[0][1] < 0:
                chunks = [(raw[a:b], -1) for a, b in zip(bounds[i][:-1], bounds[i][1:])]
            else:
                chunks = []
                for part, special in segments:
                    encoded = part.encode()
                    if special >= 0:
                        chunks.append((encoded, special))
                        continue
                    own = chunk_bounds(np.frombuffer(encoded, np.uint8), np.array([0, len(encoded)]), *sizes)[0]
                    chunks += [(encoded[a:b], -1) for a, b in zip(own[:-1], own[1:])]
            yield first + i, decoded, chunks


# -- encoding ----------------------------------------------------------------

IDS = "array<int>"


def encode(
    docs: DataFrame, tokenizer_json: str, text_column: str = "text", chunk_sizes: tuple[int, int, int] = (CUT_BITS, LEAST, MOST)
) -> DataFrame:
    """``docs`` with ``token_ids``: what the tokenizer gives for each whole text, without adding special tokens.

    A null or empty text has no ids. Special tokens written out in a text are
    taken as such. Repeated rows stay. A column ``token_ids`` is replaced.
    """
    lists = lambda bpe, ids: [pa.array([i.astype(np.int32) for i in ids], pa.list_(pa.int32()))]
    return _encoded(docs, tokenizer_json, text_column, chunk_sizes, f"token_ids {IDS}", lists)


def codec_digest(
    docs: DataFrame, tokenizer_json: str, id_column: str = "doc_id", text_column: str = "text",
    chunk_sizes: tuple[int, int, int] = (CUT_BITS, LEAST, MOST),
) -> DataFrame:
    """``(id, n_tokens, ids_sha256, decoded_sha256)`` per row: digests of the ids as decimals with commas, and of the text they decode to."""

    def digests(bpe: ByteBpe, ids: list[np.ndarray]) -> list[pa.Array]:
        listed = [",".join(map(bpe.decimal.__getitem__, i.tolist())) for i in ids]
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        return [pa.array([len(i) for i in ids], pa.int64()), pa.array(map(sha, listed), pa.string()), pa.array([sha(bpe.decoded(i)) for i in ids], pa.string())]

    plain = docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text"))
    schema = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    found = _encoded(plain, tokenizer_json, "_text", chunk_sizes, schema, digests)
    return found.drop("_text").withColumnRenamed("_id", id_column)


def decode(docs: DataFrame, tokenizer_json: str, ids_column: str = "token_ids") -> DataFrame:
    """``docs`` with ``decoded``: the text of its ids, special tokens included; null ids give an empty text.

    Bytes that are no UTF-8 become replacement characters. A column ``decoded`` is replaced.
    """
    packed = docs.drop(*[c for c in ("decoded",) if c != ids_column]).select(F.struct("*").alias("_row"), F.col(ids_column).alias("_ids"))
    row_type = packed.schema["_row"].dataType.simpleString()
    description = docs.sparkSession.sparkContext.broadcast(described(tokenizer_json))

    def spell(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(description.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [bpe.decoded(np.array(ids or [], np.int64)) for ids in part["_ids"].to_pylist()]
                yield pa.RecordBatch.from_arrays([part["_row"], pa.array(texts, pa.string())], names=["_row", "decoded"])

    found = packed.mapInArrow(lean(spell), f"_row {row_type}, decoded string")
    names = [c for c in docs.columns if c != "decoded" or c == ids_column]
    return found.select(*[F.col(f"_row.`{c}`").alias(c) for c in names if c != "decoded"], "decoded")


NOTE = "t1 bigint, t2 bigint, seq int, h1 bigint, h2 bigint, data binary"
PIECE = "t1 bigint, t2 bigint, seq int, special boolean, ids binary"

# Texts taken together.
TOGETHER = 256


def _encoded(docs: DataFrame, tokenizer_json: str, text_column: str, sizes: tuple[int, int, int], schema: str, finish) -> DataFrame:
    """``docs`` with the columns of ``schema``, which ``finish`` makes of the ids of some texts."""
    spark = docs.sparkSession
    names = [c.split()[0] for c in schema.split(", ")]
    kept = docs.drop(*[c for c in names if c != text_column])
    # Rows travel without their text where it is not to be returned.
    carried = [c for c in kept.columns if not (c == text_column and c.startswith("_"))]
    row = F.struct(*[F.col(f"`{c}`") for c in carried]) if carried else F.struct(F.lit(0).alias("_"))
    packed = kept.select(row.alias("_row"), F.col(text_column).alias("_text"))
    row_type = packed.schema["_row"].dataType.simpleString()
    description = spark.sparkContext.broadcast(described(tokenizer_json))
    shared = _shared_chunks(packed.select("_text"), description, sizes)

    def texts_of(column: pa.Array) -> Iterator[_Text]:
        for at, text, chunks in text_chunks(column, byte_bpe(description.value), sizes):
            yield _Text(at, text, chunks, shared.value)

    def note(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows whose text has shared chunks, and these chunks, with their bytes where the task sees them first."""
        seen_texts: set[tuple[int, int]] = set()
        seen_chunks: set[tuple[int, int]] = set()
        for batch in batches:
            for group in _grouped(texts_of(batch["_text"]), TOGETHER):
                yield _notes([t for t in group if t.has_shared], batch["_row"], seen_texts, seen_chunks)

    def encode_whole(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows whose text has no shared chunk."""
        bpe = byte_bpe(description.value)
        for batch in batches:
            for group in _grouped(texts_of(batch["_text"]), TOGETHER):
                whole = [t for t in group if not t.has_shared]
                rows = batch["_row"].take(pa.array([t.at for t in whole], pa.int64()))
                yield pa.RecordBatch.from_arrays([rows, *finish(bpe, bpe.whole([t.text for t in whole]))], names=["_row", *names])

    def encode_between(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What lies between the shared chunks of a text, once per task and text."""
        bpe = byte_bpe(description.value)
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            for group in _grouped(texts_of(batch["_text"]), TOGETHER):
                fresh = [t for t in group if t.has_shared and not (t.key in seen or seen.add(t.key))]
                pieces = [(*t.key, *piece) for t in fresh for piece in t.between()]
                plain = iter(bpe.encode([p[4] for p in pieces if not p[3]]))
                ids = [np.array([p[4]], bpe.kind) if p[3] else next(plain) for p in pieces]
                columns = [pa.array([p[i] for p in pieces], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.bool_()))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([i.tobytes() for i in ids], pa.binary())], names=["t1", "t2", "seq", "special", "ids"])

    def encode_chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(description.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                ids = bpe.encode([d.decode() for d in part["data"].to_pylist()])
                yield pa.RecordBatch.from_arrays([part["h1"], part["h2"], pa.array([i.tobytes() for i in ids], pa.binary())], names=["h1", "h2", "ids"])

    def put_together(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(description.value)
        for texts in _grouped(_texts_of_pieces(batches, bpe.kind), TOGETHER):
            ids = [bpe.repaired(p) for _, _, p in texts]
            keys = [pa.array([t[i] for t in texts], pa.int64()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*keys, *finish(bpe, ids)], names=["t1", "t2", *names])

    notes = materialized(packed.mapInArrow(lean(note), f"_row {row_type}, {NOTE}"), compression="zstd")
    waiting = notes.where("seq IS NULL").select("_row", "t1", "t2")
    references = notes.where("seq IS NOT NULL")
    chunks = references.where("data IS NOT NULL").groupBy("h1", "h2").agg(F.first("data").alias("data"))
    encoded = chunks.mapInArrow(lean(encode_chunks), "h1 bigint, h2 bigint, ids binary")
    wanted = references.select("t1", "t2", "seq", "h1", "h2").distinct()
    found = wanted.join(encoded, ["h1", "h2"]).select("t1", "t2", "seq", F.lit(False).alias("special"), "ids")
    between = packed.select("_text").mapInArrow(lean(encode_between), PIECE)
    pieces = between.unionByName(found).repartition("t1", "t2").sortWithinPartitions("t1", "t2", "seq")
    together = pieces.mapInArrow(lean(put_together), f"t1 bigint, t2 bigint, {schema}")
    done = packed.mapInArrow(lean(encode_whole), f"_row {row_type}, {schema}")
    both = done.unionByName(waiting.join(together, ["t1", "t2"]).select("_row", *names))
    return both.select(*[F.col(f"_row.`{c}`").alias(c) for c in carried], *names)


class _Text:
    """A text with its chunks, and which of them may be shared."""

    def __init__(self, at: int, text: str, chunks: list[tuple[bytes, int]], shared: tuple[int, np.ndarray]) -> None:
        self.at, self.text, self.chunks = at, text, chunks
        self.digests = [_digest(c) if special < 0 else None for c, special in chunks]
        hits = may_hold(shared, np.array([d[0] if d else 0 for d in self.digests], np.int64))
        self.hits = [bool(hit) and d is not None for hit, d in zip(hits.tolist(), self.digests)]
        self.has_shared = any(self.hits)

    @cached_property
    def key(self) -> tuple[int, int]:
        return _digest(self.text.encode())

    def between(self) -> Iterator[tuple[int, bool, str | int]]:
        """``(place, False, text)`` of stretches without shared chunks, ``(place, True, id)`` of special tokens."""
        stretch: list[bytes] = []
        for seq, ((chunk, special), hit) in enumerate(zip(self.chunks, self.hits)):
            if stretch and (hit or special >= 0):
                yield seq - 1, False, b"".join(stretch).decode()
                stretch = []
            if special >= 0:
                yield seq, True, special
            elif not hit:
                stretch.append(chunk)
        if stretch:
            yield len(self.chunks) - 1, False, b"".join(stretch).decode()


def _notes(texts: list[_Text], rows: pa.Array, seen_texts: set, seen_chunks: set) -> pa.RecordBatch:
    """A row of ``_row`` and key per text, and one per shared chunk of each text that is new to the task."""
    notes: list[tuple] = []
    for t in texts:
        if t.key in seen_texts:
            continue
        seen_texts.add(t.key)
        for seq, ((chunk, _), digest, hit) in enumerate(zip(t.chunks, t.digests, t.hits)):
            if hit:
                notes.append((*t.key, seq, *digest, None if digest in seen_chunks else chunk))
                seen_chunks.add(digest)
    own = rows.take(pa.array([t.at for t in texts], pa.int64()))
    notes = [(*t.key, None, None, None, None) for t in texts] + notes
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
    columns = [pa.array([n[i] for n in notes], kind) for i, kind in enumerate(kinds)]
    own = pa.concat_arrays([own, pa.nulls(len(notes) - len(texts), own.type)])
    return pa.RecordBatch.from_arrays([own, *columns], names=["_row", *[c.split()[0] for c in NOTE.split(", ")]])


def _grouped(items: Iterable, size: int) -> Iterator[list]:
    group: list = []
    for item in items:
        group.append(item)
        if len(group) == size:
            yield group
            group = []
    if group:
        yield group


def _shared_chunks(texts: DataFrame, description, sizes: tuple[int, int, int]):
    """A broadcast bit map of the digests of chunks that occur more than once."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(description.value)
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            numbers: dict[tuple[int, int], int] = {}
            for _, text, chunks in text_chunks(batch["_text"], bpe, sizes):
                key = _digest(text.encode())
                if key in seen:
                    continue
                seen.add(key)
                for chunk, special in chunks:
                    if special < 0:
                        digest = _digest(chunk)
                        numbers[digest] = numbers.get(digest, 0) + 1
            h1, h2 = zip(*numbers) if numbers else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array(numbers.values(), pa.int64())], names=["h1", "h2", "n"])

    counted = texts.mapInArrow(lean(count), "h1 bigint, h2 bigint, n bigint").groupBy("h1", "h2").agg(F.sum("n").alias("n"))
    return bit_map(materialized(counted.where("n > 1").select("h1")), "h1")


def _texts_of_pieces(batches: Iterable[pa.RecordBatch], kind: np.dtype) -> Iterator[tuple[int, int, list[tuple[np.ndarray, bool]]]]:
    """``(t1, t2, pieces)`` of every text, from rows in order of text and place; a place that comes again is the same piece."""
    key, last, pieces = None, -1, []
    for batch in batches:
        columns = [batch[c].to_pylist() for c in ("t1", "t2", "seq", "special", "ids")]
        for t1, t2, seq, special, ids in zip(*columns):
            if (t1, t2) != key:
                if pieces:
                    yield *key, pieces
                key, last, pieces = (t1, t2), -1, []
            if seq != last:
                pieces.append((np.frombuffer(ids, kind), special))
                last = seq
    if pieces:
        yield *key, pieces
