"""Token ids in binary files of shuffled planes.

Every document is encoded with a fixed tokenizer and closed by an end id. The
ids of a run of documents, in ascending order of the key, form a shard, one
file. A shard cuts its ids into blocks of a fixed size, transposes each block
into byte planes (all lowest bytes, then all second bytes, ...) or bit planes,
compresses each plane by itself with zstandard, and lists place and length of
every plane in a chunk index, so that a reader can decode any range of ids
without touching the other blocks.

Layout of a file (little-endian)::

    magic "NFBP", version, planes per id (4 or 32), block size, part, shard
    documents, ids, ids of the part before this shard, blocks, directory length
    directory: zstandard of the keys (int64), null marks and lengths (int64)
    chunk index: for each block and plane, offset (uint64) and length (uint32)
    planes
    end mark "\\nNFBPEND\\n"

Files are written by Spark's text writer (one row, one file, the end mark as
line separator) and so appear through its commit protocol in any store; a lost
executor leaves no half-written file behind. ``manifest`` beside them holds
the number of ids before each part.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsflow.llm.common import arrow_map, stage

MAGIC = b"NFBP"
END_MARK = "\nNFBPEND\n"
HEADER = struct.Struct("<4sHHIIIQQQIQ")
BLOCK_IDS = 1 << 16
#: Ids of a shard, which a task has in memory: about 70 MB as a file.
SHARD_IDS = 1 << 25
#: Pieces longer than this are encoded every time; the others' ids are kept.
KEPT_WORD = 48
#: Pieces, and ids of them, that are kept.
KEPT_WORDS, KEPT_IDS = 500_000, 1 << 22
#: A letter up to U+024F (but U+0130, whose lower case ends in a mark) and an ASCII mark that is in no
#: contraction or special token's string: the tokenizer parts them, so that a blank between changes no id.
MARK_BEHIND_LETTER = r"([a-zA-Z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{24F}])([!-&(-/:;=?@\[-`{}~])"
#: Bytes of text that are cut into pieces at once.
RUN_BYTES = 8 << 20


def to_planes(ids: np.ndarray, bits: bool) -> list[bytes]:
    """The planes of a block of uint32 ids."""
    by = ids.astype("<u4").view(np.uint8).reshape(-1, 4).T
    if not bits:
        return [np.ascontiguousarray(p).tobytes() for p in by]
    return [np.packbits((p >> k) & 1, bitorder="little").tobytes() for p in by for k in range(8)]


def from_planes(planes: list[bytes], n: int, bits: bool) -> np.ndarray:
    """The inverse of ``to_planes`` for ``n`` ids."""
    if bits:
        up = [np.unpackbits(np.frombuffer(p, np.uint8), count=n, bitorder="little") for p in planes]
        by = [sum((up[8 * b + k] << k for k in range(1, 8)), up[8 * b]) for b in range(4)]
    else:
        by = [np.frombuffer(p, np.uint8) for p in planes]
    return np.ascontiguousarray(np.stack(by, axis=1).astype(np.uint8)).view("<u4").ravel()


def pack_shard(part: int, shard: int, before: int, keys: list, lengths: list[int], data: bytes,
               block_ids: int = BLOCK_IDS, bits: bool = False) -> bytes:
    """One shard file from its documents' keys and lengths and all their ids."""
    z = zstandard.ZstdCompressor(level=3)
    ids = np.frombuffer(data, "<u4")
    nulls = np.array([k is None for k in keys], np.uint8)
    directory = z.compress(np.array([0 if k is None else k for k in keys], "<i8").tobytes()
                           + nulls.tobytes() + np.array(lengths, "<i8").tobytes())
    planes, index, at = [], bytearray(), 0
    for i in range(0, len(ids), block_ids):
        for plane in to_planes(ids[i:i + block_ids], bits):
            plane = z.compress(plane)
            index += struct.pack("<QI", at, len(plane))
            at += len(plane)
            planes.append(plane)
    blocks = -(-len(ids) // block_ids)
    head = HEADER.pack(MAGIC, 1, 32 if bits else 4, block_ids, part, shard, len(keys), len(ids),
                       before, blocks, len(directory))
    return b"".join([head, directory, bytes(index), *planes])


class Shard:
    """A reader of one shard file."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC or not data.endswith(END_MARK.encode()):
            raise ValueError("not a whole shard file")
        (_, _, self.planes, self.block_ids, self.part, self.shard, self.n_docs, self.n_ids,
         self.before, self.blocks, length) = HEADER.unpack_from(data)
        z = self._z = zstandard.ZstdDecompressor()
        at = HEADER.size
        directory = z.decompress(data[at:at + length])
        n = self.n_docs
        keys = np.frombuffer(directory, "<i8", n)
        nulls = np.frombuffer(directory, np.uint8, n, 8 * n)
        self.keys = [None if x else int(k) for k, x in zip(keys, nulls)]
        self.lengths = np.frombuffer(directory, "<i8", n, 9 * n)
        self._index, self._data = at + length, data
        self._payload = self._index + 12 * self.planes * self.blocks

    def block(self, k: int) -> np.ndarray:
        """The ids of block ``k``, found through the chunk index."""
        got = []
        for p in range(self.planes):
            at, length = struct.unpack_from("<QI", self._data, self._index + 12 * (k * self.planes + p))
            got.append(self._z.decompress(self._data[self._payload + at:self._payload + at + length]))
        n = min(self.block_ids, self.n_ids - k * self.block_ids)
        return from_planes(got, n, self.planes == 32)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the shard; only the blocks they lie in are read."""
        if stop <= start:
            return np.empty(0, "<u4")
        first, last = start // self.block_ids, (stop - 1) // self.block_ids
        got = np.concatenate([self.block(k) for k in range(first, last + 1)])
        return got[start - first * self.block_ids:stop - first * self.block_ids]

    def documents(self) -> Iterator[tuple]:
        """(key, first id within the part, ids) of each document; one block is kept."""
        at, kept, block = 0, -1, None
        for key, n in zip(self.keys, self.lengths):
            got, start, stop = [], at, at + int(n)
            while start < stop:
                k = start // self.block_ids
                if k != kept:
                    kept, block = k, self.block(k)
                upto = min(stop, (k + 1) * self.block_ids)
                got.append(block[start - k * self.block_ids:upto - k * self.block_ids])
                start = upto
            yield key, self.before + at, np.concatenate(got) if got else np.empty(0, "<u4")
            at = stop


def splits_at_blanks(spec: dict) -> bool:
    """Whether a tokenizers file encodes a text as its pieces between blanks, one after the
    other, and letters as their lower case: read off its normalizer and pre-tokenizer."""
    norm, pre = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}
    steps = [(n["type"], n.get("pattern", {}).get("Regex"), n.get("content")) for n in norm.get("normalizers", [])]
    cuts = pre.get("pretokenizers", [])
    return (steps == [("NFC", None, None), ("Replace", "\\s+", " "), ("Lowercase", None, None)]
            and [c["type"] for c in cuts] == ["Split", "ByteLevel"]
            and cuts[0]["behavior"] == "Removed" and cuts[0]["invert"]
            and "|[\\p{L}]+|" in cuts[0]["pattern"].get("Regex", "")
            and "[^\\s" in cuts[0]["pattern"]["Regex"] and not cuts[1]["add_prefix_space"]
            and not cuts[1]["use_regex"] and spec["model"].get("end_of_word_suffix") == "</w>")


class _Words:
    """Ids of texts.

    Where the tokenizer drops white space, lower-cases, and always splits
    between a letter and a mark such as a comma, a text's ids are those of its
    pieces between blanks and line ends one after the other, a mark behind a
    letter begins another piece, and letters have the ids of their lower
    case. Other pieces are encoded as they stand. Ids of pieces are kept
    in one array (``flat``, with ``start`` and ``length`` by the piece's
    number), out of which the ids of a batch of texts are gathered. With any
    other tokenizer whole texts are encoded.
    """

    #: Words that are encoded in one call: the ends of words part their ids.
    JOINED = 500

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            self.by_pieces = splits_at_blanks(json.load(f))
        vocabulary = self.tokenizer.get_vocab()
        self.is_end = np.zeros(max(vocabulary.values()) + 1, bool)
        self.is_end[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self._keep([], [])

    def _keep(self, words: list[str], ids: list[bytes]) -> None:
        """Start over with the ids of ``words`` alone."""
        self.number: dict[str, int] = {}
        self.count = 0
        self.flat, self.used = np.empty(1 << 16, "<u4"), 0
        self.start, self.length = np.empty(1 << 12, np.int64), np.empty(1 << 12, np.int64)
        self._add(words, ids)

    def _add(self, words: list[str], ids: list[bytes]) -> None:
        n = self.count
        new = np.frombuffer(b"".join(ids), "<u4")
        while self.used + len(new) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        while n + len(words) > len(self.start):
            self.start = np.concatenate([self.start, np.empty_like(self.start)])
            self.length = np.concatenate([self.length, np.empty_like(self.length)])
        self.flat[self.used:self.used + len(new)] = new
        size = np.array([len(x) // 4 for x in ids], np.int64)
        self.length[n:n + len(words)] = size
        self.start[n:n + len(words)] = self.used + np.cumsum(size) - size
        self.used += len(new)
        self.count += len(words)
        self.number.update(zip(words, range(n, n + len(words))))

    def _encode(self, words: list[str]) -> list[bytes]:
        got = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in got]

    def _encode_letters(self, words: list[str]) -> list[bytes]:
        """Ids of lower-case words of letters, many a call."""
        chunks = [words[i:i + self.JOINED] for i in range(0, len(words), self.JOINED)]
        out: list[bytes] = []
        for chunk, e in zip(chunks, self.tokenizer.encode_batch_fast([" ".join(c) for c in chunks],
                                                                     add_special_tokens=False)):
            ids = np.array(e.ids, "<u4")
            ends = (np.flatnonzero(self.is_end[ids]) + 1) * 4
            raw = ids.tobytes()
            if len(ends) == len(chunk) and (not len(ends) or ends[-1] == len(raw)):
                out += [raw[a:b] for a, b in zip([0, *ends.tolist()], ends.tolist())]
            else:
                out += self._encode(chunk)
        return out

    def _learn(self, new: list[str]) -> None:
        # up to U+024F, without U+0130, lower case is one letter in every library
        letters = [w.isalpha() and (w.isascii() or (max(w) < "\u0250" and "\u0130" not in w)) for w in new]
        simple = [w for w, x in zip(new, letters) if x]
        self._add(simple, self._encode_letters([w.lower() for w in simple]))
        others = [w for w, x in zip(new, letters) if not x]
        self._add(others, self._encode(others))

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all ``texts`` (no nulls) one after the other, and the number of each's."""
        if not self.by_pieces:
            got = self._encode(texts.to_pylist())
            return np.frombuffer(b"".join(got), "<u4"), np.array([len(x) // 4 for x in got], np.int64)
        if not pc.any(pc.match_substring(texts, "<|")).as_py():
            texts = pc.ascii_lower(texts)   # a special token's string must not come about by it
        texts = pc.replace_substring_regex(pc.replace_substring(texts, "\n", " "), MARK_BEHIND_LETTER, r"\1 \2")
        lists = pc.split_pattern(texts, " ")
        coded = lists.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        if self.count > KEPT_WORDS or self.used > KEPT_IDS:
            kept = [w for w in words if w in self.number]
            at = [self.number[w] for w in kept]
            self._keep(kept, [self.flat[a:a + n].tobytes() for a, n in zip(self.start[at], self.length[at])])
        new = [w for w in words if w not in self.number]
        if new:
            self._learn(new)
        places = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))[coded.indices.to_numpy()]
        size = self.length[places]
        upto = np.cumsum(size)
        total = int(upto[-1]) if len(upto) else 0
        out = self.flat[np.repeat(self.start[places] - upto + size, size) + np.arange(total)]
        for w in new:
            if len(w) > KEPT_WORD:
                del self.number[w]
        ends = np.concatenate([[0], upto])[pc.cumulative_sum(pc.list_value_length(lists)).to_numpy()]
        return out, np.diff(ends, prepend=0)


@lru_cache(maxsize=1)
def _words(path: str) -> _Words:
    """Kept for all tasks of a Python worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return _Words(path)


def encode_to_files(docs: DataFrame, path: str, tokenizer: str, key: str = "doc_id",
                    text: str = "text", end_id: int = 1, bits: bool = False,
                    block_ids: int = BLOCK_IDS, shard_ids: int = SHARD_IDS) -> None:
    """Write the token ids of ``docs`` under ``path``.

    ``tokenizer`` is the path of a tokenizers file, as present on every executor. Null texts count as empty and give the end id
    alone; null keys come first; repeated rows are written once each; other
    columns are ignored; an empty table gives no shard. Documents are dealt by
    ranges of (key, hash of the text), so many rows of one key still spread.
    """
    ordered = (docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
               .repartitionByRange("key", F.xxhash64("text")).sortWithinPartitions("key", "text"))
    end = struct.pack("<I", end_id)

    def encode(batches):
        words, part = _words(tokenizer), TaskContext.get().partitionId()
        shard = before = held = 0
        keys, lengths, data = [], [], []

        def packed():
            return pa.record_batch([pa.array([pack_shard(part, shard, before, keys, lengths, b"".join(data),
                                                         block_ids, bits)], pa.binary())], ["file"])

        for batch in batches:
            every, texts = batch.column(0).to_pylist(), pc.fill_null(batch.column(1), "")
            for low, high in _runs(pc.binary_length(texts).to_numpy()):
                ids, counts = words.ids(texts.slice(low, high - low))
                at = 0
                for k, n in zip(every[low:high], counts.tolist()):
                    keys.append(k)
                    lengths.append(n + 1)
                    data += (ids[at:at + n].tobytes(), end)
                    at, held = at + n, held + n + 1
                    if held >= shard_ids:
                        yield packed()
                        shard, before, held = shard + 1, before + held, 0
                        keys, lengths, data = [], [], []
        if keys:
            yield packed()

    (ordered.mapInArrow(encode, "file binary").select(F.col("file").cast("string"))
     .write.option("maxRecordsPerFile", 1).option("lineSep", END_MARK).text(f"{path}/shards"))


def _runs(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``RUN_BYTES`` together; a longer one goes alone."""
    low = held = 0
    for i, n in enumerate(sizes.tolist()):
        if held and held + n > RUN_BYTES:
            yield low, i
            low, held = i, 0
        held += n
    if low < len(sizes):
        yield low, len(sizes)


def read_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """One row per document of the files under ``path``: key, start (ids of all
    documents before it), n_tokens, ids_crc32, part, shard, and ids on request.

    The number of ids before each part is a running sum over parts, a table as
    long as the writing job had tasks; it is kept in ``manifest``.
    """
    # few files a task: a file's bytes and its documents are in memory together
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "part-*")
             .load(f"{path}/shards").select("content"))

    def decode(rows):
        for (content,) in rows:
            shard = Shard(bytes(content))
            for key, at, ids in shard.documents():
                raw = ids.tobytes()
                yield (key, shard.part, shard.shard, at, len(ids), zlib.crc32(raw),
                       *([ids.tolist()] if with_ids else []))

    schema = "key long, part int, shard int, at long, n_tokens long, ids_crc32 long"
    found = arrow_map(files, decode, schema + ", ids array<long>" * with_ids,
                      flush=64 if with_ids else 4096)
    if not with_ids:
        found = stage(found, "token_index")
    parts = found.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    w = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("base"))
    parts.write.mode("overwrite").parquet(f"{path}/manifest")
    # one row per task of the writing job: bounded by the shuffle partitions
    base = F.broadcast(spark.read.schema("part int, base long").parquet(f"{path}/manifest"))
    return found.join(base, "part").select(
        "key", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", "part", "shard",
        *(["ids"] if with_ids else []))

