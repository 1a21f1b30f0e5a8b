"""Token ids as directly addressable binary files (operator 12).

Documents are range-partitioned by id, tokenised where they lie, and written in ascending order
of doc_id to shard files. A file holds the ids in levels of one byte (directly addressable codes):
level 0 has the low byte of every id, and a bitmap that tells which ids go on; level 1 has the next
byte of those, in the same order, and so on. The place of an id in the next level is the number
of set bits before it. A directory with that number for every 512th bit makes the count a look at
64 bytes at most, so any id is read without decoding the ones before it, and a range of ids is
one slice of every level.

Layout, little-endian: ``MAGIC``; n_docs, n_ids, n_levels, end id (8 bytes each); chunks per level; doc ids
(8 bytes each), a byte per document that is 1 for a null id, the end of each document among the ids;
then per level the directory (4 bytes a value), the bitmap, and the chunks.

A task writes its files under names of their own and reports them in a manifest, which Spark commits.
A repeated or lost attempt leaves files that no manifest names, so nothing is read twice. Files are
closed after ``SHARD_IDS`` ids; a document lies in one file. Rows without doc_id come first. Rows that
repeat an id are documents of their own, in the order of their text's hash. Null and empty texts are the end id alone. The
first id of a file follows from running totals over the manifest, one row per file. Columns other
than doc_id and text are not looked at; an empty table gives no files.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm import common
from tradewind.llm.common import stage
from tradewind.llm.packing import ranges
from tradewind.operators.ordering import running_total
from tradewind.operators.staging import staging_root

MAGIC = b"DACTOKS1"
SHARD_IDS = 1 << 22
# Distinct words a generation of the encoder's memory holds, and how many ids they may have.
KEPT_WORDS, KEPT_IDS = 500_000, 1 << 22
# Words that are encoded as one text.
JOINED = 1000
_BLOCK = 512
# Letters that are lower-cased one by one and that no other letter joins.
_PLAIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordEncoder:
    """Token ids of whole texts, each distinct word encoded once while it is remembered.

    For tokenizers that drop white space, lower-case, and take runs of letters as words of their
    own: no token crosses white space, so a text's ids are those of its words one after another,
    a mark of punctuation behind an ASCII letter and before white space is a word of its own, and
    a word of plain letters needs the vocabulary's merges only. Words are remembered in two
    generations: a full one becomes the older, and words that are met again move on from it.
    """

    def __init__(self, path: str):
        # Spark's tasks share the cores already.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        byte_level = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
        at_blanks = {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, byte_level]}
        rules |= {"normalizer": None, "pre_tokenizer": at_blanks, "added_tokens": [], "post_processor": None}
        self.merges = Tokenizer.from_str(json.dumps(rules))
        vocabulary, mark = rules["model"]["vocab"], rules["model"]["end_of_word_suffix"]
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(mark)]] = True
        self.older: tuple = ({}, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32))
        self._open()

    def _open(self) -> None:
        self.known: dict[str, int] = {}
        self.starts = np.zeros(0, np.int64)
        self.sizes = np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint32)

    def _merged(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of plain letters, many to a text, told apart by the mark of a word's end."""
        texts = [" ".join(words[i : i + JOINED]) for i in range(0, len(words), JOINED)]
        found = self.merges.encode_batch_fast([t.lower() for t in texts], add_special_tokens=False)
        ids = np.concatenate([np.zeros(0, np.uint32), *(np.array(e.ids, np.uint32) for e in found)])
        return ids, np.diff(np.flatnonzero(self.ends[ids]), prepend=-1)

    def _encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of some words and how many each has."""
        plain = np.array([_PLAIN.fullmatch(w) is not None for w in words], bool)
        ids, sizes = self._merged([w for w, p in zip(words, plain.tolist()) if p])
        found = self.whole.encode_batch_fast([w for w, p in zip(words, plain.tolist()) if not p], add_special_tokens=False)
        lists = [e.ids for e in found]
        counts = np.zeros(len(words), np.int64)
        counts[plain], counts[~plain] = sizes, [len(x) for x in lists]
        # Both kinds lie one after the other; a word's start follows from those of its kind.
        order = np.argsort(~plain, kind="stable")
        starts = np.zeros(len(words), np.int64)
        starts[order] = np.cumsum(counts[order]) - counts[order]
        both = np.concatenate([ids, np.fromiter(chain.from_iterable(lists), np.uint32)])
        return both[ranges(starts, counts)], counts

    def _remember(self, words: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        starts = np.cumsum(sizes) - sizes + len(self.pool)
        self.known.update(zip(words, range(len(self.known), len(self.known) + len(words))))
        self.pool = np.concatenate([self.pool, ids])
        self.sizes, self.starts = np.concatenate([self.sizes, sizes]), np.concatenate([self.starts, starts])

    def _places(self, words: list[str]) -> np.ndarray:
        known = self.known
        missing = [w for w in words if w not in known]
        if len(known) + len(missing) > KEPT_WORDS or len(self.pool) > KEPT_IDS:
            self.older = (known, self.starts, self.sizes, self.pool)
            self._open()
            known, missing = self.known, words
        old, starts, sizes, pool = self.older
        if met := [w for w in missing if w in old]:
            at = np.array([old[w] for w in met], np.int64)
            self._remember(met, pool[ranges(starts[at], sizes[at])], sizes[at])
        if new := [w for w in missing if w not in known]:
            self._remember(new, *self._encoded(new))
        return np.array([known[w] for w in words], np.int64)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and the number of each."""
        apart = pc.replace_substring_regex(texts, r"([A-Za-z])([.,;:!?])([ \t\n\r\f]|$)", r"\1 \2\3")
        lists = pc.ascii_split_whitespace(apart)
        if isinstance(lists, pa.ChunkedArray):
            lists = lists.combine_chunks()
        owners = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        coded = lists.flatten().dictionary_encode()
        places = self._places(coded.dictionary.to_pylist())[coded.indices.to_numpy(zero_copy_only=False)]
        sizes = self.sizes[places]
        ids = self.pool[ranges(self.starts[places], sizes)]
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(owners)])]
        return ids, np.diff(ends)


# An encoder outlives the task: Spark uses a Python worker for many tasks.
_encoders: dict[str, WordEncoder] = {}


def encoder_of(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def _pieces(text: str) -> list[str]:
    """A text cut at spaces into pieces of about ``SLICE_BYTES`` letters."""
    out, start = [], 0
    while start < len(text):
        end = start + common.SLICE_BYTES
        if end < len(text):
            end = text.find(" ", end)
            end = len(text) if end < 0 else end
        out.append(text[start:end])
        start = end
    return out


def _ids_of(encoder: WordEncoder, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    texts = pc.fill_null(texts, "")
    if len(texts) == 1 and pc.utf8_length(texts)[0].as_py() > common.SLICE_BYTES:
        parts = [encoder(pa.array([p]))[0] for p in _pieces(texts[0].as_py())]
        return np.concatenate(parts), np.array([sum(map(len, parts))], np.int64)
    return encoder(texts)


def levels(ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(chunks, continuation flags) of each level of some ids; one level at least."""
    out, rest = [], ids.astype(np.uint32)
    while True:
        more = rest > 255
        out.append((rest.astype(np.uint8), more))
        if not more.any():
            return out
        rest = rest[more] >> np.uint32(8)


def image(doc_ids: list[int | None], sizes: np.ndarray, ids: np.ndarray, end_id: int) -> bytes:
    """The bytes of a file."""
    parts = levels(ids)
    out = [
        MAGIC,
        np.array([len(doc_ids), len(ids), len(parts), end_id, *(len(c) for c, _ in parts)], "<u8").tobytes(),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
        np.array([d is None for d in doc_ids], np.uint8).tobytes(),
        np.cumsum(sizes).astype("<u8").tobytes(),
    ]
    for chunks, more in parts:
        bits = np.packbits(more, bitorder="little")
        per_block = np.add.reduceat(more.astype(np.int64), np.arange(0, len(more), _BLOCK)) if len(more) else np.zeros(0, np.int64)
        directory = np.concatenate([[0], np.cumsum(per_block)]).astype("<u4")
        out += [directory.tobytes(), bits.tobytes(), chunks.tobytes()]
    return b"".join(out)


class Shard:
    """A file open for reading. Only the bytes asked for are read."""

    def __init__(self, path: str):
        system, inner = fs.FileSystem.from_uri(path)
        self.file = system.open_input_file(inner)
        if self.file.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError(f"{path} is no file of token ids")
        at = len(MAGIC)
        self.n_docs, self.n_ids, n_levels, self.end_id = map(int, self._read(at, "<u8", 4))
        at += 32
        counts = self._read(at, "<u8", n_levels).astype(np.int64).tolist()
        self._docs = at + 8 * n_levels
        at = self._docs + 17 * self.n_docs
        self.levels = []
        for n in counts:
            bits = at + 4 * (-(-n // _BLOCK) + 1)
            chunks = bits + -(-n // 8)
            self.levels.append((n, at, bits, chunks))
            at = chunks + n

    def _read(self, at: int, kind: str, n: int) -> np.ndarray:
        return np.frombuffer(self.file.read_at(n * np.dtype(kind).itemsize, at), dtype=kind)

    def close(self) -> None:
        self.file.close()

    def documents(self) -> tuple[list[int | None], np.ndarray]:
        """Ids of the documents, and where each begins; the number of ids comes last."""
        ids = self._read(self._docs, "<i8", self.n_docs)
        null = self._read(self._docs + 8 * self.n_docs, "u1", self.n_docs)
        ends = self._read(self._docs + 9 * self.n_docs, "<u8", self.n_docs).astype(np.int64)
        return [None if n else i for i, n in zip(ids.tolist(), null.tolist())], np.concatenate([[0], ends])

    def _goes_on(self, level: int, start: int, n: int) -> np.ndarray:
        """Continuation flags from ``start`` on."""
        _, _, bits, _ = self.levels[level]
        first = start // 8
        raw = self._read(bits + first, "u1", (start + n + 7) // 8 - first)
        return np.unpackbits(raw, bitorder="little")[start - 8 * first :][:n].astype(bool)

    def rank(self, level: int, place: int) -> int:
        """Set flags of a level before ``place``."""
        _, directory, _, _ = self.levels[level]
        block = place // _BLOCK
        known = int(self._read(directory + 4 * block, "<u4", 1)[0])
        return known + int(np.count_nonzero(self._goes_on(level, block * _BLOCK, place - block * _BLOCK)))

    def token(self, place: int) -> int:
        """One id."""
        if not 0 <= place < self.n_ids:
            raise IndexError(place)
        value = 0
        for level, (_, _, _, chunks) in enumerate(self.levels):
            value |= int(self._read(chunks + place, "u1", 1)[0]) << (8 * level)
            if not self._goes_on(level, place, 1)[0]:
                break
            place = self.rank(level, place)
        return value

    def tokens(self, start: int, end: int) -> np.ndarray:
        """Ids from ``start`` to before ``end``."""
        if not 0 <= start <= end <= self.n_ids:
            raise IndexError((start, end))
        out = np.zeros(end - start, np.uint32)
        places, n = np.arange(end - start), end - start
        for level, (_, _, _, chunks) in enumerate(self.levels):
            if not n:
                break
            out[places] |= self._read(chunks + start, "u1", n).astype(np.uint32) << np.uint32(8 * level)
            more = self._goes_on(level, start, n)
            start = self.rank(level, start)
            places = places[more]
            n = len(places)
        return out


_FILE = "part long, seq long, file string, n_docs long, n_ids long"


def _written(folder: str, tokenizer: str, end_id: int, shard_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        system, inner = fs.FileSystem.from_uri(folder)
        encoder = encoder_of(tokenizer)
        docs: list[int | None] = []
        sizes: list[np.ndarray] = []
        ids: list[np.ndarray] = []
        held = 0

        def closed() -> pa.RecordBatch:
            name = f"{part:08d}-{seq:06d}-{uuid.uuid4().hex}.dac"
            all_ids = np.concatenate(ids)
            with system.open_output_stream(f"{inner}/{name}") as out:
                out.write(image(docs, np.concatenate(sizes), all_ids, end_id))
            row = [[part], [seq], [f"{folder}/{name}"], [len(docs)], [len(all_ids)]]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in row], ["part", "seq", "file", "n_docs", "n_ids"])

        for batch in batches:
            for piece in common.slices(batch, "text", limit=min(common.SLICE_BYTES, shard_ids)):
                found, n = _ids_of(encoder, piece.column("text"))
                found = np.insert(found, np.cumsum(n), np.uint32(end_id))
                docs += piece.column("doc_id").to_pylist()
                sizes.append(n + 1)
                ids.append(found)
                held += len(found)
                if held >= shard_ids:
                    yield closed()
                    docs, sizes, ids, held, seq = [], [], [], 0, seq + 1
        if docs:
            yield closed()

    return run


def write_tokens(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int = 1, shard_ids: int = SHARD_IDS
) -> DataFrame:
    """Write the ids of all documents to files below ``folder``, a URI every executor can write to.

    Returns the manifest: file, first (ids in the files before it), n_docs and n_ids of each file.
    """
    order = ["doc_id", "hash", "row"]
    # The running row id parts rows that are equal, so that none of them must share a task.
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .withColumn("hash", F.xxhash64("text"))
        .withColumn("row", F.monotonically_increasing_id())
        .repartitionByRange(*[F.col(c) for c in order])
        .sortWithinPartitions(*order)
        .select("doc_id", "text")
    )
    files = stage(ordered.mapInArrow(_written(folder, tokenizer, end_id, shard_ids), _FILE))
    totals = running_total(files, ["part", "seq"], F.col("n_ids"), "upto")
    return stage(totals.select("file", (F.col("upto") - F.col("n_ids")).alias("first"), "n_docs", "n_ids"))


def _read_documents(with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, first in zip(batch.column("file").to_pylist(), batch.column("first").to_pylist()):
                shard = Shard(path)
                docs, at = shard.documents()
                lo = 0
                while lo < len(docs):
                    # About 1 MB of ids at a time, one document at least.
                    hi = max(lo + 1, int(np.searchsorted(at, at[lo] + (1 << 18), side="right")) - 1)
                    ids = shard.tokens(int(at[lo]), int(at[hi])).astype("<u4")
                    edges = (at[lo : hi + 1] - at[lo]).tolist()
                    columns = [
                        pa.array(docs[lo:hi], pa.int64()),
                        pa.array(at[lo:hi] + first),
                        pa.array(np.diff(at[lo : hi + 1])),
                        pa.array([zlib.crc32(ids[s:e]) for s, e in zip(edges, edges[1:])], pa.int64()),
                    ]
                    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                    if with_ids:
                        columns.append(common.list_column(ids.astype(np.int32), np.array(edges), pa.int32()))
                        names.append("ids")
                    yield pa.RecordBatch.from_arrays(columns, names)
                    lo = hi
                shard.close()

    return run


_DOCUMENT = "doc_id long, start long, n_tokens long, ids_crc32 long"


def read_tokens(manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32 of every document, and
    its ``ids`` if asked for, read from the files of a manifest."""
    spark = manifest.sparkSession
    tasks = max(1, min(manifest.count(), 4 * spark.sparkContext.defaultParallelism))
    schema = _DOCUMENT + (", ids array<int>" if with_ids else "")
    return manifest.select("file", "first").repartition(tasks).mapInArrow(_read_documents(with_ids), schema)


def new_folder(spark: SparkSession) -> str:
    """A folder for files below the shared checkpoint folder, as a URI."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{staging_root(spark)}/tokens-{uuid.uuid4().hex}")
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(path)
    found = system.makeQualified(path).toString()
    return found.replace("file:/", "file:///", 1) if not found.startswith("file://") else found


def token_digest(docs: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, read back from files just written."""
    return read_tokens(write_tokens(docs, new_folder(docs.sparkSession), tokenizer, end_id))
