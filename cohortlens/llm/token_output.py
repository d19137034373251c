"""Token ids in binary shards with a shared zstandard dictionary.

A dictionary is trained on the serialized id arrays of a bounded sample of
documents. Every document is compressed by itself with that dictionary, so one
short document can be read without its neighbours; a shard keeps the
dictionary's hash and an index of ids, starts and offsets.

Shard layout (little-endian): 8 bytes magic, 32 bytes SHA-256 of the
dictionary, then the zstandard frames, then the index (count × ``INDEX``), then
a trailer of the index position, the document count and the id width.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import (
    AttemptFile,
    filesystem,
    give_back,
    scratch_path,
    text_of,
    tidy,
    tokenizer,
    written,
)
from cohortlens.llm.words import slabs

MAGIC = b"TOKZDIC1"
TRAILER = "<QQQ"
INDEX = np.dtype([("has_id", "u1"), ("doc_id", "<i8"), ("start", "<i8"), ("n_tokens", "<i8"),
                  ("offset", "<i8"), ("length", "<i8")])
END_ID = 2
#: The dictionary's sample: so many documents, the first bytes of ids of each, its size.
SAMPLE_DOCS = 512
SAMPLE_BYTES = 16_384
DICTIONARY_BYTES = 65_536
LEAST_SAMPLES = 16
LEVEL = 3
#: Pieces whose ids a Python worker remembers, in each of two generations (about 150 bytes of
#: memory each), and their longest.
REMEMBERED = 800_000
PIECE_CHARS = 48
#: Stored ids, of remembered pieces and others, above which all but the remembered are dropped.
STORED = 8_000_000
PIECES = pa.large_list(pa.large_string())
#: Characters of the texts that are cut into pieces together, and so looked up once.
SLAB_CHARS = 4_000_000
#: Texts are cut into pieces where one space stands between two characters that are not white
#: space; in even texts (no other white space than single spaces and line feeds), at each space.
_BREAK = re.compile(r"(?<=\S) (?=\S)")
# White space other than space and line feed, in UTF-8 (and what starts like it).
_OTHER_SPACE = b"\t\r\x0b\x0c\x1c\x1d\x1e\x1f"
_WIDE_SPACE = (b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x80", b"\xe2\x81\x9f",
               b"\xe3\x80\x80")


def is_even(text: str) -> bool:
    data = text.encode("utf-8", "surrogatepass")
    return not (data[:1] in b" \n" or data[-1:] in b" \n" or b"  " in data or b" \n" in data
                or b"\n " in data or len(data.translate(None, _OTHER_SPACE)) != len(data)
                or any(space in data for space in _WIDE_SPACE))


def pieces_of(texts: list[str]) -> pa.LargeListArray:
    """The texts cut at their breaks; joined by spaces again the pieces give the texts."""
    even = np.array([is_even(t) for t in texts], bool)
    if even.all():
        return pc.split_pattern(pa.array(texts, pa.large_string()), " ").cast(PIECES)
    odd = pa.array([_BREAK.split(t) for t, e in zip(texts, even, strict=True) if not e], PIECES)
    cut = pc.split_pattern(pa.array([t for t, e in zip(texts, even, strict=True) if e],
                                    pa.large_string()), " ").cast(PIECES)
    place = np.where(even, np.cumsum(even) - 1, len(cut) + np.cumsum(~even) - 1)
    return pa.concat_arrays([cut, odd]).take(pa.array(place))


class Encoder:
    """Encodes whole texts piece by piece, remembering frequent pieces.

    Byte-level BPE never merges across its pre-tokens, and a pre-token always
    starts at a single space between two characters that are not white space,
    so the ids of the pieces in a row are the ids of the whole text.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        self.remembered = remembered
        self.tokenizer = tokenizer(path)
        wide = self.tokenizer.get_vocab_size() > 1 << 16
        self.dtype = np.dtype("<u4" if wide else "<u2")
        self.starts = np.zeros(self.tokenizer.get_vocab_size(), bool)  # ids that begin with a space
        for token, number in self.tokenizer.get_vocab().items():
            self.starts[number] = token.startswith("\u0120")
        self.known: dict[str, int] = {}
        self.older: dict[str, int] = {}
        self._hold(np.empty(0, self.dtype), np.empty(0, np.int64))

    def _hold(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        """Start the stored ids anew: ``ids`` of pieces numbered from 0, ``sizes`` of each."""
        self.flat, self.used = ids, len(ids)
        self.ends, self.count = np.cumsum(sizes), len(sizes)

    def _store(self, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Add the ids of pieces to the stored ones; gives the pieces' numbers."""
        ends = self.used + np.cumsum(sizes)
        self.flat = _put(self.flat, self.used, ids)
        self.ends = _put(self.ends, self.count, ends)
        self.used, self.count = self.used + len(ids), self.count + len(sizes)
        return np.arange(self.count - len(sizes), self.count)

    def _gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of numbered pieces one after the other, and the pieces' sizes."""
        ends = self.ends[numbers]
        sizes = ends - np.where(numbers > 0, self.ends[numbers - 1], 0)
        upto = np.cumsum(sizes)
        # an id's place: its place in the result less where its piece ends there
        places = np.repeat(ends - upto, sizes) + np.arange(upto[-1] if len(upto) else 0)
        return self.flat[places], sizes

    def _forget(self) -> None:
        """Make the remembered pieces the older ones and drop those, and ids of no piece."""
        kept = np.fromiter(self.known.values(), np.int64, len(self.known))
        self._hold(*self._gather(kept))
        self.known, self.older = {}, dict(zip(self.known, range(len(kept)), strict=True))

    def _encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces one after the other, and how many of each."""
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), self.dtype, sizes.sum()), sizes

    def _encode_following(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same of pieces with a space before them, encoded as one text.

        Without spaces inside the pieces, a piece's first id is the next one that
        begins with a space.
        """
        if any(" " in p for p in pieces) or not pieces:
            return self._encode([" " + p for p in pieces])
        ids = np.array(self.tokenizer.encode_batch_fast(
            [" " + " ".join(pieces)], add_special_tokens=False)[0].ids, dtype=self.dtype)
        first = np.flatnonzero(self.starts[ids])
        if len(first) != len(pieces):
            raise ValueError("a piece is not encoded by itself")
        return ids, np.diff(first, append=len(ids))

    def _known(self, pieces: list[str]) -> np.ndarray:
        """Numbers of different pieces with a space before them, remembered or encoded now."""
        known, older = self.known, self.older
        numbers = np.fromiter(map(known.get, pieces, repeat(-1)), np.int64, len(pieces))
        missing = np.flatnonzero(numbers < 0)
        names = list(map(pieces.__getitem__, missing.tolist()))
        again = np.fromiter(map(older.get, names, repeat(-1)), np.int64, len(names))
        spaced = np.fromiter((" " in p for p in names), bool, len(names))
        for some in ((again < 0) & spaced, (again < 0) & ~spaced):
            places = np.flatnonzero(some)
            again[places] = self._store(*self._encode_following(
                list(map(names.__getitem__, places.tolist()))))
        numbers[missing] = again
        known.update((p, n) for p, n in zip(names, again.tolist(), strict=True)
                     if len(p) <= PIECE_CHARS)
        return numbers

    def ids(self, texts: list[str]) -> Iterator[bytes]:
        """The serialized ids of each text.

        Each different piece is looked up once; the texts' ids are put together from the
        numbers of their pieces. A text's first piece has no space before it.
        """
        if not texts:
            return
        if len(self.known) > self.remembered or self.used > STORED:
            self._forget()
        cut = pieces_of(texts)
        bounds = cut.offsets.to_numpy() - cut.offsets[0].as_py()
        coded = cut.flatten().dictionary_encode()
        number = coded.indices.to_numpy().astype(np.int64)
        different = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        heads, head = np.unique(number[bounds[:-1]], return_inverse=True)
        number[bounds[:-1]] = len(different) + head
        stored = np.concatenate([self._known(different),
                                 self._store(*self._encode([different[h] for h in heads]))])
        flat, sizes = self._gather(stored[number])
        ends = np.append(0, np.cumsum(sizes))[bounds].tolist()
        for a, b in zip(ends[:-1], ends[1:], strict=True):
            yield flat[a:b].tobytes()


def _put(array: np.ndarray, at: int, more: np.ndarray) -> np.ndarray:
    """``array`` with ``more`` from place ``at``, in a larger copy if it has no room."""
    if at + len(more) > len(array):
        larger = np.empty(at + len(more) + len(array) // 2, array.dtype)
        larger[:at] = array[:at]
        array = larger
    array[at:at + len(more)] = more
    return array


@lru_cache(maxsize=2)
def encoder(path: str, remembered: int = REMEMBERED) -> Encoder:
    """One encoder per Python worker, so that what it remembers serves later tasks."""
    return Encoder(path, remembered)


def train_dictionary(docs: DataFrame, tokenizer_path: str, seed: int = 0,
                     remembered: int = REMEMBERED) -> bytes:
    """A dictionary trained on the ids of at most ``SAMPLE_DOCS`` documents.

    The sample (documents of the lowest hashes, at most ``SAMPLE_BYTES`` of each)
    only shapes the compression; with too few documents the dictionary is empty.
    """
    lots = (docs.select("doc_id").filter("doc_id is not null")
            .orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(SAMPLE_DOCS).collect())

    def sample(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(tokenizer_path, remembered)
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "ids": [
                ids[:SAMPLE_BYTES]
                for ids in encode.ids([t[:4 * SAMPLE_BYTES] for t in batch["text"]])]})

    chosen = (docs.filter(F.col("doc_id").isin([r.doc_id for r in lots]))
              .mapInPandas(tidy(sample), "doc_id long, ids binary")
              .dropDuplicates(["doc_id"]).orderBy("doc_id").limit(SAMPLE_DOCS).collect())
    samples = [bytes(r.ids) for r in chosen if len(r.ids) >= 8]
    if len(samples) < LEAST_SAMPLES:
        return b""
    size = min(DICTIONARY_BYTES, sum(map(len, samples)) // 8)
    try:
        return zstandard.train_dictionary(max(size, 256), samples).as_bytes()
    except zstandard.ZstdError:  # too little to learn from
        return b""


def write_tokens(docs: DataFrame, folder: str, tokenizer_path: str, id_col: str = "doc_id",
                 text_col: str = "text", end_id: int = END_ID, remembered: int = REMEMBERED,
                 slab_chars: int = SLAB_CHARS, keep: bool = True) -> DataFrame:
    """Write shards under ``folder``; their manifest ``path, size, shard, docs, tokens, base``.

    Documents are in ascending id order across shards (null ids first; repeated
    ids by text), each encoded whole (null: empty) and closed by ``end_id``.
    ``base`` is the number of ids in earlier shards. Extra columns are ignored;
    an empty table writes no shard. ``remembered``, ``slab_chars`` and ``keep``
    (workers remember pieces beyond a task) trade time for a worker's memory; the ids are
    the same.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       text_of(text_col).alias("text"))
    dictionary = train_dictionary(rows, tokenizer_path, remembered=remembered)
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(dictionary)
    ordered = (rows.withColumn("lot", F.xxhash64("text"))
               .repartitionByRange("doc_id", "lot")
               .sortWithinPartitions("doc_id", "lot", "text").select("doc_id", "text"))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(tokenizer_path, remembered)
        end = np.array([end_id], dtype=encode.dtype).tobytes()
        packer = zstandard.ZstdCompressor(level=LEVEL, **_dictionary(shared.value))
        out, index, tokens = None, [], 0
        for batch in batches:
            doc_ids = iter(batch["doc_id"])
            for _, texts in slabs(batch["text"].tolist(), slab_chars):
                for ids in encode.ids(texts):
                    doc_id, ids = next(doc_ids), ids + end
                    if out is None:
                        out = AttemptFile(folder, ".tokens")
                        out.write(MAGIC + hashlib.sha256(shared.value).digest())
                    frame, n = packer.compress(ids), len(ids) // encode.dtype.itemsize
                    known = not pd.isna(doc_id)
                    index.append((known, int(doc_id) if known else 0, tokens, n, out.size,
                                  len(frame)))
                    out.write(frame)
                    tokens += n
                give_back()
        if not keep:
            encoder.cache_clear()
        done = []
        if out:
            position = out.size
            out.write(np.array(index, dtype=INDEX).tobytes())
            out.write(struct.pack(TRAILER, position, len(index), encode.dtype.itemsize))
            out.close()
            done = [(out.uri, out.size, TaskContext.get().partitionId(), len(index), tokens)]
        yield pd.DataFrame(done, columns=["path", "size", "shard", "docs", "tokens"])

    manifest = written(ordered.mapInPandas(
        write, "path string, size long, shard int, docs long, tokens long"), "token-shards")
    fs, path = filesystem(folder)
    fs.create_dir(path, recursive=True)
    with fs.open_output_stream(f"{path}/dictionary.zdict", compression=None) as out:
        out.write(dictionary)
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)))


def _dictionary(data: bytes) -> dict:
    return {"dict_data": zstandard.ZstdCompressionDict(data)} if data else {}


class Shard:
    """Reads documents of one shard; checks that the dictionary is the one it was written with."""

    def __init__(self, source, dictionary: bytes):
        self.source = source
        if source.read(8) != MAGIC:
            raise ValueError("not a token shard")
        if source.read(32) != hashlib.sha256(dictionary).digest():
            raise ValueError("the shard was written with another dictionary")
        source.seek(source.size() - struct.calcsize(TRAILER))
        position, docs, width = struct.unpack(
            TRAILER, source.read(struct.calcsize(TRAILER)))
        source.seek(position)
        self.index = np.frombuffer(source.read(docs * INDEX.itemsize), dtype=INDEX)
        self.dtype = np.dtype(f"<u{width}")
        self._unpack = zstandard.ZstdDecompressor(**_dictionary(dictionary))

    def ids(self, number: int) -> np.ndarray:
        """Ids of the shard's ``number``-th document."""
        entry = self.index[number]
        self.source.seek(int(entry["offset"]))
        packed = self.source.read(int(entry["length"]))
        return np.frombuffer(self._unpack.decompress(
            packed, max_output_size=int(entry["n_tokens"]) * self.dtype.itemsize), self.dtype)


def read_tokens(manifest: DataFrame, folder: str, ids: bool = True) -> DataFrame:
    """Per document, from the shards: ``doc_id, start, n_tokens, ids_crc32, ids`` (or null ids)."""
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, path = filesystem(folder)
        with fs.open_input_file(f"{path}/dictionary.zdict") as f:
            dictionary = f.read()
        for batch in batches:
            for uri, base in zip(batch["path"], batch["base"], strict=True):
                fs, name = filesystem(uri)
                with fs.open_input_file(name) as source:
                    shard, rows, held = Shard(source, dictionary), [], 0
                    for i, entry in enumerate(shard.index):
                        found = shard.ids(i).astype("<u4")
                        rows.append((int(entry["doc_id"]) if entry["has_id"] else None,
                                     int(base) + int(entry["start"]), len(found),
                                     zlib.crc32(found.tobytes()),
                                     found.astype("i4") if ids else None))
                        held += found.nbytes if ids else 64
                        if held > 16 << 20:
                            yield frame(rows)
                            rows, held = [], 0
                    yield frame(rows)

    def frame(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", "ids_crc32",
                                           "ids"]).astype({"doc_id": "Int64"})

    # a number of its own keeps Spark from merging these few rows, a shard each, into one task
    return (manifest.repartition(max(1, min(manifest.count(), 100_000)), "path")
            .mapInPandas(tidy(read), "doc_id long, start long, n_tokens long, ids_crc32 long, "
                               "ids array<int>"))


def token_round_trip(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id",
                     text_col: str = "text", **memory: int | bool) -> DataFrame:
    """Write ``docs`` as token shards in the shared folder and read the document facts back.

    ``memory``: ``remembered``, ``slab_chars`` and ``keep`` of :func:`write_tokens`.
    """
    folder = scratch_path(docs.sparkSession, "tokens")
    manifest = write_tokens(docs, folder, tokenizer_path, id_col, text_col, **memory)
    return read_tokens(manifest, folder, ids=False).drop("ids")
