"""A store of token ids: every document compressed alone, with one zstandard dictionary for all.

Texts are encoded with the tokenizers library, an end id is appended, and the ids are
serialised as little-endian unsigned integers of 2 bytes, or 4 if the vocabulary needs
them.  A zstandard dictionary is trained on such arrays of a sample; it knows the ids that
documents share, so that a short document compresses without its neighbours and can
be read without them.

The format is a folder of Parquet files that Spark writes and commits:

* ``blocks``: a row has a run of documents in ascending id.  ``data`` holds their frames one after another,
  ``ids`` the document ids, ``offsets`` where each frame begins (and the last ends), ``sizes`` the number of token
  ids, ``begin`` how many token ids of the shard come before, ``first`` and ``last`` the ids at the ends, and ``dictionary`` the dictionary's hash.
* ``dictionary``: one row with the dictionary, its hash, the width of an id and the end id.

``shard`` counts the range partitions of the document ids, so shards ascend as ids do.
``fetch`` filters blocks by their first and last id, which reaches the Parquet files' statistics, and
decompresses the wanted frames only.  Every reader checks the dictionary's hash.

Scale: documents are range-partitioned by (id, text hash, spread), so that one id with very many
rows is split too; a task keeps one block of about ``block_bytes`` and one batch of texts.  What grows with the
documents stays in the blocks; the driver sees one count for each shard.  The dictionary's sample is a
random share of the documents, about ``samples`` of them whatever the size of the table, without those of more than
``sample_chars`` characters; with too few to train on, the dictionary is the sample itself.

Defined cases: null text counts as empty and gives the end id alone; null ids come first;
rows of one id are ordered by their text's hash and repeated rows are each stored; a very long text is a
block of its own; an empty table gives a store without blocks; columns besides id and text are not stored.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.bpe import byte_letters
from tidemark.llm.common import small_batches

CACHE = 300_000     # words that a worker remembers
CACHE_BYTES = 64 << 20      # of these words and their ids

OTHER, LETTER, DIGIT, LONGER = range(4)
KINDS = np.full(256, OTHER, np.uint8)       # what a byte is: in ASCII a letter, a digit, another character; or a part of a longer one
KINDS[[b for b in range(128) if chr(b).isalpha()]] = LETTER
KINDS[[b for b in range(128) if chr(b).isdigit()]] = DIGIT
KINDS[128:] = LONGER
SPACE, LINE = 0x20, 0x0A
BLANK = np.isin(np.arange(256), [*range(0x09, 0x0E), *range(0x1C, 0x21)])        # ASCII white space, and what Python takes for it
WHITE = np.array([int.from_bytes(chr(c).encode().ljust(3, b"\0"), "big") for c in
                  (0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200C), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)])


def held(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of large strings or binaries, and where each begins in them; the last number is the end."""
    _, ends, data = values.buffers()
    at = np.frombuffer(ends, np.int64)[values.offset:values.offset + len(values) + 1] if len(values) else np.zeros(1, np.int64)
    return np.frombuffer(data or b"", np.uint8)[at[0]:at[-1]], at - at[0]


def kinds(data: np.ndarray) -> np.ndarray:
    """The kind of each byte of UTF-8; both bytes of a letter from U+00C0 to U+023F are letters, which no Unicode version changes."""
    kind = KINDS[data]
    lead = np.flatnonzero((data >= 0xC3) & (data <= 0xC8))
    lead = lead[(data[lead] != 0xC3) | ~np.isin(data[lead + 1], (0x97, 0xB7))]       # the signs of multiplication and division
    kind[lead] = kind[lead + 1] = LETTER
    return kind


def cuts(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where a byte-level vocabulary's split pattern ends a piece, whatever stands around; not all such places.

    ``data`` holds texts one after another in UTF-8, ``ends`` where each ends.  A single space before a character that is
    not white begins a piece, and so does a line feed, which is then a piece of its own.  A letter before an ASCII
    character that is none ends one, as does a digit.  What stands between two such places gives the same
    ids alone as in its text.
    """
    here = np.zeros(len(data) + 1, bool)
    if not len(data):
        return here
    gap = np.flatnonzero((data == SPACE) | (data == LINE))
    padded = np.append(data, np.full(3, SPACE, np.uint8))
    after = padded[gap + 1]
    solid = ~BLANK[after]
    far = np.flatnonzero((after == 0xC2) | ((after >= 0xE1) & (after <= 0xE3)))     # white space beyond ASCII begins so
    if len(far):
        one, two, three = (padded[gap[far] + k].astype(np.int64) for k in (1, 2, 3))
        code = (one << 16) | (two << 8) | np.where(one == 0xC2, 0, three)
        solid[far[np.isin(code, WHITE)]] = False
    last = np.zeros(len(data) + 1, bool)
    last[ends] = True
    solid &= ~last[gap + 1]
    gap = gap[solid]
    here[gap] = True
    here[gap[data[gap] == LINE] + 1] = True

    kind = kinds(data)
    here[1:-1] |= ((kind[:-1] == LETTER) | (kind[:-1] == DIGIT)) & (kind[1:] != kind[:-1]) & (data[1:] < 128)
    return here


class Encoder:
    """Whole texts to ids with the tokenizers library; equal words are encoded once.

    Texts are cut where a byte-level vocabulary's split pattern ends a piece whatever stands around
    (``cuts``): the ids of what is between do not depend on its neighbours.  Texts with a special token go through
    the library whole, as do all texts if the vocabulary splits in another way.
    """

    def __init__(self, spec: str):
        from tokenizers import Tokenizer, pre_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_str(spec)
        self.library.no_truncation()
        self.library.no_padding()
        rules = json.loads(spec)
        split = rules.get("pre_tokenizer") or {}
        self.by_word = rules.get("normalizer") is None and split.get("type") == "ByteLevel" \
            and not split.get("add_prefix_space", True) and split.get("use_regex", True)
        self.special = [x["content"] for x in rules.get("added_tokens", [])]
        vocab = self.library.get_vocab(with_added_tokens=True)
        self.begins = np.zeros(1 + max(vocab.values(), default=0), bool)     # tokens that begin with a space
        self.begins[[i for t, i in vocab.items() if t.startswith("\u0120")]] = True
        self.letters = {b: c for c, b in byte_letters().items()}
        self.model = Tokenizer(self.library.model)      # for pieces in the model's letters with spaces between
        self.model.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        self.words, self.ids = pa.array([], pa.large_string()), pa.array([], pa.large_binary())
        self.used = np.zeros(0, bool)

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def pieces(self, stems: list[str]) -> pa.Array:
        """The ids of each word of letters with its space: one piece, which the model takes directly."""
        text = (" " + " ".join(stems)).encode().decode("latin-1").translate(self.letters)
        text = text.replace(self.letters[SPACE], " " + self.letters[SPACE])[1:]
        ids = np.array(self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        at = np.flatnonzero(self.begins[ids])
        if len(at) != len(stems):
            raise ValueError("the vocabulary does not keep the space with the word that follows")
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(np.append(at, len(ids)) * 4), pa.py_buffer(ids)])

    def learn(self, new: pa.Array) -> np.ndarray:
        """Asks the library for the ids of words and remembers them: the place of each."""
        data, ends = held(new)
        others = np.r_[0, np.cumsum(kinds(data) != LETTER)]
        plain = (np.diff(ends) > 1) & (np.diff(others[ends]) == 1) & (data[ends[:-1]] == SPACE)
        letters, rest = new.filter(pa.array(plain)), new.filter(pa.array(~plain))
        ids = [self.ids]
        if len(letters):
            ids.append(self.pieces(held(letters)[0].tobytes().decode()[1:].split(" ")))
        if len(rest):
            ids.append(pa.array(self.whole(rest.to_pylist()), pa.large_binary()))
        places = np.empty(len(new), np.int64)
        places[np.r_[np.flatnonzero(plain), np.flatnonzero(~plain)]] = np.arange(len(new)) + len(self.words)
        self.words, self.ids = pa.concat_arrays([self.words, letters, rest]), pa.concat_arrays(ids)
        self.used = np.r_[self.used, np.ones(len(new), bool)]
        return places

    def places(self, keys: pa.Array) -> np.ndarray:
        """Where each of these distinct words stands among those remembered; new ones are learned."""
        if len(self.words) > CACHE or self.words.nbytes + self.ids.nbytes > CACHE_BYTES:     # those met since the last time stay
            kept = pa.array(self.used)
            self.words, self.ids = self.words.filter(kept), self.ids.filter(kept)
            self.used = np.zeros(len(self.words), bool)
        at = pc.index_in(keys, self.words).fill_null(-1).to_numpy().astype(np.int64)
        self.used[at[at >= 0]] = True
        if (at < 0).any():
            at[at < 0] = self.learn(keys.filter(pa.array(at < 0)))
        return at

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """The ids of each text as little-endian unsigned integers of 4 bytes.

        The texts of a batch are cut together; Arrow tells equal words and puts their ids together again, so that
        Python sees each distinct word of the batch once.
        """
        texts = (texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())).cast(pa.large_string())
        out: list[bytes | None] = [None] * len(texts)
        cut = np.full(len(texts), self.by_word)
        for s in self.special:
            cut &= ~pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
        rows = np.flatnonzero(cut)
        if len(rows):
            for k, ids in zip(rows.tolist(), self.by_words(texts if len(rows) == len(texts) else texts.take(pa.array(rows))), strict=True):
                out[k] = ids
        rest = np.flatnonzero(~cut)
        for k, ids in zip(rest.tolist(), self.whole(texts.take(pa.array(rest)).to_pylist()) if len(rest) else [], strict=True):
            out[k] = ids
        return out

    def by_words(self, texts: pa.Array) -> list[bytes]:
        data, ends = held(texts)
        here = cuts(data, ends)
        here[ends] = True
        at = np.flatnonzero(here)
        words = pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(at), pa.py_buffer(data)).dictionary_encode()
        places = self.places(words.dictionary)
        ids, begins = held(self.ids.take(pa.array(places[words.indices.to_numpy()])))
        return [ids[i:j].tobytes() for i, j in pairwise(begins[np.searchsorted(at, ends)].tolist())]


@dataclass
class Vocabulary:
    """A tokenizers file as text; about 2 MB for 50,000 tokens, so it may be broadcast."""

    spec: str
    shared: Encoder | None = None

    def encoder(self) -> Encoder:
        """One encoder for each copy, so that the tasks of a worker share what it remembers."""
        if self.shared is None:
            self.shared = Encoder(self.spec)
        return self.shared


def _serialised(ids: bytes, width: int) -> bytes:
    return ids if width == 4 else np.frombuffer(ids, "<u4").astype("<u2").tobytes()


def train(samples: list[bytes], size: int) -> bytes:
    """A dictionary of at most ``size`` bytes; the samples themselves where there are too few to train on."""
    try:
        return zstandard.train_dictionary(size, samples, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def dictionary_hash(dictionary: bytes) -> str:
    return hashlib.sha256(dictionary).hexdigest()


def _held(dictionary: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(dictionary) if dictionary else None


@dataclass
class Store:
    """An open store: its blocks, the dictionary, and the settings that its files state."""

    blocks: DataFrame
    dictionary: bytes
    width: int
    end_id: int

    @staticmethod
    def open(spark: SparkSession, path: str) -> Store:
        held = spark.read.parquet(f"{path}/dictionary").first()
        if dictionary_hash(bytes(held["data"])) != held["hash"]:
            raise ValueError(f"{path}: the dictionary does not have the hash that it states")
        return Store(spark.read.parquet(f"{path}/blocks"), bytes(held["data"]), held["width"], held["end_id"])


def write(docs: DataFrame, path: str, vocabulary: str, end_id: int = 0, samples: int = 500, sample_chars: int = 16_384,
          dictionary_bytes: int = 65_536, block_bytes: int = 1 << 20, level: int = 3,
          id_col: str = "doc_id", text_col: str = "text") -> Store:
    """Encode ``docs`` with the vocabulary file and write them to ``path``, a folder on any store that Spark reaches."""
    spark = small_batches(docs).sparkSession
    with open(vocabulary, encoding="utf-8") as f:
        spec = f.read()
    encoder = Encoder(spec)
    width = 2 if max(end_id + 1, len(encoder.begins)) <= 1 << 16 else 4
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    share = min(1.0, samples / max(1, docs.select(id_col).count()))
    some = rows.where(F.length("text") <= sample_chars).sample(share, seed=11).select("text")
    end = np.array([end_id], "<u4").tobytes()
    trained = train([_serialised(x + end, width) for x in encoder.encode([r["text"] for r in some.collect()])], dictionary_bytes)
    named = dictionary_hash(trained)
    spark.createDataFrame([(named, trained, width, end_id)], "hash string, data binary, width int, end_id int") \
        .write.parquet(f"{path}/dictionary")

    held = spark.sparkContext.broadcast((Vocabulary(spec), trained))
    kind = docs.schema[id_col].dataType
    schema = T.StructType([
        T.StructField("shard", T.IntegerType()), T.StructField("block", T.IntegerType()), T.StructField("first", kind),
        T.StructField("last", kind), T.StructField("begin", T.LongType()), T.StructField("dictionary", T.StringType()),
        T.StructField("ids", T.ArrayType(kind)), T.StructField("offsets", T.ArrayType(T.IntegerType())),
        T.StructField("sizes", T.ArrayType(T.LongType())), T.StructField("data", T.BinaryType())])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, trained = held.value
        encoder, pack = words.encoder(), zstandard.ZstdCompressor(level=level, dict_data=_held(trained))
        shard, block, begin = TaskContext.get().partitionId(), 0, 0
        ids: list[pa.Array] = []
        frames: list[bytes] = []
        sizes: list[int] = []

        def full() -> pa.RecordBatch:
            keys = pa.concat_arrays(ids)
            offsets = np.cumsum([0, *map(len, frames)]).tolist()
            row = [[shard], [block], keys[:1], keys[-1:], [begin], [named],
                   pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys), [offsets], [sizes], [b"".join(frames)]]
            types = [pa.int32(), pa.int32(), None, None, pa.int64(), pa.string(), None, pa.list_(pa.int32()), pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays([x if t is None else pa.array(x, t) for x, t in zip(row, types, strict=True)],
                                              names=schema.names)

        for batch in batches:
            texts = batch.column("text")
            for j, x in enumerate(encoder.encode(texts)):
                ids.append(batch.column("id").slice(j, 1))
                frames.append(pack.compress(_serialised(x + end, width)))
                sizes.append(len(x) // 4 + 1)
                if sum(map(len, frames[-1:])) >= block_bytes or len(frames) >= 4096 or (
                        len(frames) % 16 == 0 and sum(map(len, frames)) >= block_bytes):
                    yield full()
                    block, begin = block + 1, begin + sum(sizes)
                    ids, frames, sizes = [], [], []
        if frames:
            yield full()

    keys = [F.col("id").asc_nulls_first(), F.col("_key")]
    ordered = rows.withColumn("_key", F.xxhash64("text")).withColumn("_spread", F.monotonically_increasing_id()) \
        .repartitionByRange(*keys, F.col("_spread")).sortWithinPartitions(*keys).select("id", "text")
    ordered.mapInArrow(blocks, schema).write.option("compression", "none").parquet(f"{path}/blocks")
    return Store.open(spark, path)


def read(store: Store, only: list | None = None) -> DataFrame:
    """The documents of the store, or those whose id is in ``only``: id, start, n_tokens, ids.

    ``start`` counts the token ids of all documents before; ``ids`` are unsigned little-endian integers of 4 bytes.
    """
    blocks, spark = small_batches(store.blocks), store.blocks.sparkSession
    sizes = F.aggregate("sizes", F.lit(0).cast("long"), lambda acc, n: acc + n)
    shards = blocks.groupBy("shard").agg(F.sum(sizes).alias("n")).orderBy("shard").collect()   # a row for each range partition
    base = dict(zip([r["shard"] for r in shards], np.cumsum([0, *[r["n"] for r in shards]]).tolist(), strict=False))
    if only is not None:
        wanted = sorted({x for x in only if x is not None})
        if not wanted:
            blocks = blocks.limit(0)
        else:
            blocks = blocks.where(F.col("first").isNull() | (F.col("first") <= F.lit(wanted[-1]))) \
                .where(F.col("last") >= F.lit(wanted[0])) \
                .where(F.arrays_overlap("ids", F.array(*[F.lit(x) for x in wanted])))
    held = spark.sparkContext.broadcast((store.dictionary, dictionary_hash(store.dictionary), base, only))
    width = store.width
    schema = T.StructType([T.StructField("id", store.blocks.schema["first"].dataType), T.StructField("start", T.LongType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trained, named, base, only = held.value
        unpack = zstandard.ZstdDecompressor(dict_data=_held(trained))
        for batch in batches:
            for k in range(len(batch)):
                row = {c: batch.column(c)[k] for c in ("shard", "begin", "dictionary", "ids", "offsets", "sizes", "data")}
                if row["dictionary"].as_py() != named:
                    raise ValueError(f"a block was written with dictionary {row['dictionary']}, the store has {named}")
                keys, data = row["ids"].values, row["data"].as_buffer()
                offsets, sizes = row["offsets"].as_py(), np.array(row["sizes"].as_py(), np.int64)
                start = base[row["shard"].as_py()] + row["begin"].as_py() + np.cumsum(sizes) - sizes
                here = range(len(keys)) if only is None else \
                    np.flatnonzero(pc.is_in(keys, value_set=pa.array(only, keys.type)).to_numpy(zero_copy_only=False)).tolist()
                for part in (here[i:i + 256] for i in range(0, len(here), 256)):
                    raw = [unpack.decompress(data[offsets[j]:offsets[j + 1]]) for j in part]
                    ids = raw if width == 4 else [np.frombuffer(x, "<u2").astype("<u4").tobytes() for x in raw]
                    at = pa.array(list(part), pa.int64())
                    yield pa.RecordBatch.from_arrays([keys.take(at), pa.array(start).take(at), pa.array(sizes).take(at),
                                                      pa.array(ids, pa.binary())], names=schema.names)

    return blocks.select("shard", "begin", "dictionary", "ids", "offsets", "sizes", "data").mapInArrow(documents, schema)


def fetch(store: Store, ids: list) -> DataFrame:
    """The documents with these ids, at most a few thousand; blocks without them are skipped, other frames stay packed."""
    return read(store, only=list(ids))


def integers(ids: Column) -> Column:
    """The token ids of a document as an array of long."""
    @F.arrow_udf("array<long>")
    def unpacked(batch: pa.Array) -> pa.Array:
        return pa.array([None if x is None else np.frombuffer(x, "<u4").astype(np.int64) for x in batch.to_pylist()], pa.list_(pa.int64()))
    return unpacked(ids)
