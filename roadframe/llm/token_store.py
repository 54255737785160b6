"""Token files: each document's ids are one zstandard frame, all frames share one dictionary.

Layout of a shard (little endian):

    "TOKZ" u16 version u16 id bytes, 32 bytes SHA-256 of the dictionary
    frames, one for each document, in ascending key order
    index: for each document i64 key, u8 key is null, u64 offset, u32 frame bytes, u64 ids
    u64 index offset, u64 documents, u64 ids, "ZKOT"

``dictionary.zdict`` lies beside the shards and is trained on the serialized id
arrays of a bounded set of documents (``sample_rows`` rows of smallest hash among
those of up to ``sample_chars`` characters, at most ``sample_bytes`` of ids). Compression alone uses it; ids, counts and the
index cover all documents. A reader checks the dictionary's hash, reads the
index at the end and can fetch one short document by its offset.

Documents are dealt by ranges of (key, text hash, row) so that repeated keys
split too; each task streams its range into one shard under a temporary name,
renames it, and reports it. The driver then writes ``manifest.json`` (one entry
for each shard) under a temporary name and renames it. A task that runs again
writes the same bytes; files that no manifest names are ignored.

Paths are URIs; Python tasks open them with pyarrow's file systems, so the
folder must be one that all executors share.

Defined cases: null and empty texts hold the end id alone; null keys come first;
rows that repeat a key stay, in the order of their texts' hashes; an empty
table gives a manifest without shards; other columns are not stored.
"""

from __future__ import annotations

import functools
import hashlib
import json
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadframe.llm import common, files
from roadframe.llm.bpe import word_bpe
from roadframe.llm.registry import register
from roadframe.session import read_table, scratch_path

HEAD, TAIL, ENTRY = "<4sHH32s", "<QQQ4s", np.dtype([("key", "<i8"), ("null", "u1"), ("offset", "<u8"), ("size", "<u4"), ("ids", "<u8")])
VERSION = 1
LEVEL = 3
#: Words that a worker process remembers, twice.
REMEMBERED_WORDS = 600_000
#: Runs in one call of the library, characters of texts whose new runs are looked up together, bytes of a shard read at once.
RUNS, GROUP_CHARS, READ_BYTES = 20_000, 1 << 20, 4 << 20
_SEPARATORS = "\x1c\x1d\x1e\x1f"


class LibraryEncoder:
    """The tokenizers library over whole texts, calling it once for each new run of characters without white space.

    White space only separates words for this kind of tokenizer file, so a text's ids are its runs' ids in turn.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        step = spec["pre_tokenizer"]["pretokenizers"][0]
        if step.get("behavior") != "Removed" or not step.get("invert"):
            raise ValueError(f"{path}: the words must be the matches of a pattern without white space")
        self.tokenizer = Tokenizer.from_file(path)
        self.lowers = self.tokenizer.normalizer is not None and self.tokenizer.normalizer.normalize_str("A") == "a"
        self.id_bytes = _id_bytes(self.tokenizer, spec["model"].get("end_of_word_suffix") or "")
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known = common.Remembered(REMEMBERED_WORDS, common.own_words(self.tokenizer.pre_tokenizer.pre_tokenize_str))
        self.special = [t.content[:2] for t in self.tokenizer.get_added_tokens_decoder().values()]

    def __call__(self, text: str | None) -> bytes:
        """Packed little-endian unsigned 32-bit ids."""
        return self.many([text])[0]

    def runs(self, text: str | None) -> list[str] | None:
        """The text's runs; None where split() takes characters for white space that the tokenizer does not."""
        if not text:
            return []
        if any(x in text for x in _SEPARATORS):
            return None
        if self.lowers and not any(x in text for x in self.special) and not common.BEYOND_LATIN.search(text):
            text = text.lower()  # fewer different runs; the tokenizer lowers them all the same
        return text.split()

    def many(self, texts: list[str | None]) -> list[bytes]:
        """Packed ids of each text; the library is called once for the runs that are new in all of them."""
        runs = [self.runs(t) for t in texts]
        self.known.prepare([r for r in runs if r], self.run_ids)
        return [np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() if r is None else self.known.joined(r, self.run_ids)
                for t, r in zip(texts, runs, strict=True)]

    def run_ids(self, runs: list[str]) -> list[bytes]:
        """Packed ids of each run, by one call over many.

        Each id is given to the run in which its bytes lie; in runs of far characters, whose bytes the normalizer may
        change, to the run in which the library says that its characters begin (telling that costs it a third more).
        """
        if len(runs) > RUNS:
            return [x for lo in range(0, len(runs), RUNS) for x in self.run_ids(runs[lo : lo + RUNS])]
        far = {i for i, r in enumerate(runs) if common.BEYOND_LATIN.search(r)} if common.BEYOND_LATIN.search("".join(runs)) else ()
        near = [r for i, r in enumerate(runs) if i not in far] if far else runs
        found = self._by_bytes(near) if near else []
        if found is None:
            return self._by_offsets(runs)
        if not far:
            return found
        rest, taken = iter(self._by_offsets([runs[i] for i in sorted(far)])), iter(found)
        return [next(rest if i in far else taken) for i in range(len(runs))]

    def _by_bytes(self, runs: list[str]) -> list[bytes] | None:
        """None unless the ids' bytes end where the runs end."""
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(runs)], add_special_tokens=False)[0].ids, "<u4")
        at = np.cumsum(self.id_bytes[ids])
        ends = np.cumsum(np.fromiter((len(r.encode()) for r in runs), np.int64, len(runs)))
        edges = np.searchsorted(at, ends) + 1
        if not len(at) or edges[-1] != len(at) or (at[edges - 1] != ends).any():
            return None
        return _cut(ids, [0, *edges.tolist()])

    def _by_offsets(self, runs: list[str]) -> list[bytes]:
        found = self.tokenizer.encode(" ".join(runs), add_special_tokens=False)
        first = np.cumsum([0, *(len(r) + 1 for r in runs[:-1])])
        owner = np.searchsorted(first, np.fromiter((a for a, _ in found.offsets), np.int64, len(found.ids)), side="right") - 1
        return _cut(np.array(found.ids, "<u4"), np.searchsorted(owner, np.arange(len(runs) + 1)).tolist())


def _cut(ids: np.ndarray, edges: list[int]) -> list[bytes]:
    raw = ids.tobytes()
    return [raw[4 * a : 4 * z] for a, z in zip(edges[:-1], edges[1:])]


def _id_bytes(tokenizer, suffix: str) -> np.ndarray:
    """Bytes of text behind each id of a byte-level vocabulary (one letter of a token is one byte); -1 where no id is."""
    names = {i: len(token.removesuffix(suffix)) for token, i in tokenizer.get_vocab(with_added_tokens=False).items()}
    names |= {i: len(token.content.encode()) for i, token in tokenizer.get_added_tokens_decoder().items()}
    out = np.full(max(names) + 1, -1, np.int64)
    out[list(names)] = list(names.values())
    return out


@functools.lru_cache(maxsize=4)
def library_encoder(path: str) -> LibraryEncoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks are parallel already
    return LibraryEncoder(path)


def train_dictionary(df: DataFrame, encoder: Callable[[], Callable], text: str, end_id: int, id_bytes: int, size: int, sample_rows: int, sample_chars: int, sample_bytes: int) -> bytes:
    """A zstandard dictionary of at most ``size`` bytes; empty if there is too little to learn from."""
    usable = df.select(F.col(text).alias("text"), F.xxhash64(text).alias("h")).where(F.length(text).between(1, sample_chars))
    # copies share their hash: the window is found over different hashes, so that no copy group fills it
    last = usable.select("h").distinct().orderBy("h").limit(sample_rows).agg(F.max("h")).first()[0]
    rows = usable.where(F.col("h") <= F.lit(last)).distinct().orderBy("h", "text").limit(sample_rows).select("text")
    encode, samples, total = encoder(), [], 0
    for row in rows.toLocalIterator():
        ids = np.append(np.frombuffer(encode(row[0]), "<u4"), np.uint32(end_id))[: sample_bytes // id_bytes]
        samples.append(ids.astype(f"<u{id_bytes}").tobytes())
        total += len(samples[-1])
        if total >= sample_bytes:
            break
    try:
        return zstandard.train_dictionary(min(size, max(256, total // 8)), samples).as_bytes() if len(samples) >= 8 else b""
    except zstandard.ZstdError:
        return b""


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


def _encoded(encode: Callable, texts: pa.Array) -> Iterator[bytes]:
    """Packed ids of each text, of encoders that can in groups of texts of bounded size."""
    many = getattr(encode, "many", None) or (lambda group: [encode(t) for t in group])
    group, size = [], 0
    for t in texts:
        group.append(t.as_py())
        size += len(group[-1] or "")
        if size >= GROUP_CHARS:
            yield from many(group)
            group, size = [], 0
    yield from many(group)


MANIFEST = "shard string, first_key long, last_key long, documents long, ids long, bytes long"


def write(df: DataFrame, folder: str, encoder: Callable[[], Callable], key: str = "doc_id", text: str = "text", end_id: int = 2, id_bytes: int = 2,
          dictionary_size: int = 64 << 10, sample_rows: int = 2000, sample_chars: int = 1 << 16, sample_bytes: int = 4 << 20) -> dict:
    """Encode and store every row of ``df``; returns the manifest. ``encoder()`` gives a task its text -> packed ids function."""
    spark = df.sparkSession
    common.bounded_batches(spark)
    files.make_folder(folder)
    words = train_dictionary(df, encoder, text, end_id, id_bytes, dictionary_size, sample_rows, sample_chars, sample_bytes)
    files.write_bytes(folder, "dictionary.zdict", words)
    digest = hashlib.sha256(words).digest()
    dealt = (df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
             .withColumn("h", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id()))
    dealt = dealt.repartitionByRange(F.col("key").asc_nulls_first(), "h", "row").sortWithinPartitions(F.col("key").asc_nulls_first(), "h", "row").select("key", "text")
    dealt = dealt.withColumn("part", F.spark_partition_id())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = compress = out = None
        index: list[tuple] = []
        at = total = 0
        tail = np.array([end_id], "<u4").tobytes()
        limit = 1 << 8 * id_bytes
        for b in batches:
            keys, texts = b.column(0).to_pylist(), b.column(1)
            if out is None:
                encode, compress = encoder(), zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(words))
                name = f"shard-{b.column(2)[0].as_py():06d}.tokz"
                out = files.Committed(folder, name)
                out.write(struct.pack(HEAD, b"TOKZ", VERSION, id_bytes, digest))
                at = struct.calcsize(HEAD)
            for k, packed in zip(keys, _encoded(encode, texts), strict=True):
                ids = np.frombuffer(packed + tail, "<u4")
                if int(ids.max()) >= limit:
                    raise ValueError(f"id {ids.max()} needs more than {id_bytes} bytes")
                frame = compress.compress(ids.astype(f"<u{id_bytes}").tobytes())
                out.write(frame)
                index.append((k or 0, k is None, at, len(frame), len(ids)))
                at += len(frame)
                total += len(ids)
        if out is not None:
            table = np.array(index, ENTRY)
            out.write(table.tobytes())
            out.write(struct.pack(TAIL, at, len(table), total, b"ZKOT"))
            out.commit()
            known = [int(e["key"]) for e in (table[0], table[-1])]
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in ((name, pa.string()), (known[0], pa.int64()), (known[1], pa.int64()), (len(table), pa.int64()), (total, pa.int64()), (at + table.nbytes + struct.calcsize(TAIL), pa.int64()))], names=[c.split()[0] for c in MANIFEST.split(", ")])

    shards = sorted((r.asDict() for r in dealt.mapInArrow(run, MANIFEST).collect()), key=lambda r: r["shard"])
    start = 0
    for s in shards:
        s["start"] = start
        start += s["ids"]
    manifest = {"version": VERSION, "id_bytes": id_bytes, "end_id": end_id, "dictionary_sha256": digest.hex(), "dictionary_trained": bool(words), "shards": shards}
    files.write_manifest(folder, manifest)
    return manifest


class Shard:
    """Random access to one shard."""

    def __init__(self, folder: str, name: str, dictionary: bytes):
        store, root = files.filesystem(folder)
        self.file = store.open_input_file(f"{root}/{name}")
        magic, version, self.id_bytes, digest = struct.unpack(HEAD, self.file.read_at(struct.calcsize(HEAD), 0))
        if magic != b"TOKZ" or version != VERSION:
            raise ValueError(f"{name}: not a token shard")
        if digest != hashlib.sha256(dictionary).digest():
            raise ValueError(f"{name}: written with another dictionary")
        size = self.file.size()
        where, n, self.ids, end = struct.unpack(TAIL, self.file.read_at(struct.calcsize(TAIL), size - struct.calcsize(TAIL)))
        if end != b"ZKOT":
            raise ValueError(f"{name}: cut off")
        self.index = np.frombuffer(self.file.read_at(n * ENTRY.itemsize, where), ENTRY)
        self.decompress = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary)).decompress

    def __len__(self) -> int:
        return len(self.index)

    def get(self, i: int) -> np.ndarray:
        """Ids of the i-th document of the shard."""
        e = self.index[i]
        return self._ids(e, self.file.read_at(int(e["size"]), int(e["offset"])))

    def some(self, lo: int, hi: int) -> list[np.ndarray]:
        """Ids of the documents lo to hi - 1, whose frames stand one after the other: read in pieces of bounded size."""
        out, index = [], self.index[lo:hi]
        ends = (index["offset"] + index["size"]).astype("i8")
        at = 0
        while at < len(index):
            start = int(index["offset"][at])
            stop = max(at + 1, int(np.searchsorted(ends, start + READ_BYTES, side="right")))
            data = memoryview(self.file.read_at(int(ends[stop - 1]) - start, start))
            out += [self._ids(e, data[int(e["offset"]) - start : int(e["offset"]) - start + int(e["size"])]) for e in index[at:stop]]
            at = stop
        return out

    def _ids(self, e: np.void, frame: bytes) -> np.ndarray:
        raw = self.decompress(frame, max_output_size=int(e["ids"]) * self.id_bytes)
        ids = np.frombuffer(raw, f"<u{self.id_bytes}").astype("<u4")
        if len(ids) != e["ids"]:
            raise ValueError("a frame has another length than its index says")
        return ids


def read(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """Every stored document: key, start (ids of all documents before it), n_tokens, ids_crc32 and, if asked for, ids."""
    manifest = files.read_manifest(folder)
    fields = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    shards = spark.createDataFrame([(s["shard"], s["start"]) for s in manifest["shards"]], "shard string, start long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = None
        for b in batches:
            for name, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                words = files.read_bytes(folder, "dictionary.zdict") if words is None else words
                shard = Shard(folder, name, words)
                starts = start + np.cumsum(shard.index["ids"].astype("i8")) - shard.index["ids"].astype("i8")
                for lo in range(0, len(shard), common.BATCH_ROWS):
                    rows = range(lo, min(lo + common.BATCH_ROWS, len(shard)))
                    ids = shard.some(lo, rows.stop)
                    keys = pa.array(shard.index["key"][lo : rows.stop].astype("i8"), mask=shard.index["null"][lo : rows.stop].astype(bool))
                    out = [keys, pa.array(starts[lo : rows.stop]), pa.array([len(x) for x in ids], pa.int64()), pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64())]
                    if with_ids:
                        out.append(pa.array([x.astype("i8") for x in ids], pa.list_(pa.int64())))
                    yield pa.RecordBatch.from_arrays(out, names=[f.split()[0] for f in fields.split(", ")])

    return shards.repartition(max(1, len(manifest["shards"]))).mapInArrow(run, fields)


@register("op2_token_store")
def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store every whole document's ids and the end id 2, then read the files back."""
    tokenizer, folder = word_bpe(), scratch_path(spark, "tokens")
    write(read_table(spark, sf_dir, "documents"), folder, functools.partial(library_encoder, tokenizer))
    return read(spark, folder, with_ids=False)
