"""BPE encoding and decoding with a segment tree over adjacent pair ranks.

The tree's leaves hold, for every position, the rank of the pair that starts
there (or infinity); every inner node holds its children's minimum. A leaf is
``rank * 2^k + position``, so the root is the leftmost pair of lowest rank. A
merge changes three leaves at most, each in logarithmic time, so one word of n
symbols costs O(n log n) however long it is.

The merge table, the normaliser and the word pattern come from a tokenizer
file (its path is a parameter and must exist on every executor). Words repeat,
so each task keeps a bounded table of words it has already encoded.

Defined cases: a null text is an empty text; an empty text has no ids and
decodes to the empty string; special tokens in a text become their ids, as the
tokenizer file asks; repeated rows, null keys and other columns pass through;
columns named like the outputs are replaced.
"""

from __future__ import annotations

import functools
import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadframe.llm import common
from roadframe.llm.registry import register
from roadframe.session import read_table

INFINITY = 1 << 62
#: Words that a worker process remembers, twice.
REMEMBERED_WORDS = 200_000
#: Texts encoded and decoded at a time: their ids, tokens and decoded texts take several times their own memory.
ROUND_TRIP_ROWS = 100
#: Characters that str.split() takes for white space and the tokenizer does not.
_SEPARATORS = "\x1c\x1d\x1e\x1f"
_WHITE = regex.compile(r"\s+")
_DECODABLE = "decoding needs a tokenizer file without decoder"


def merge(symbols: list[int], pairs: dict[tuple[int, int], tuple[int, int]], by_rank: list[int]) -> list[int]:
    """Merge the leftmost pair of lowest rank until no pair is mergeable.

    ``pairs``: (left, right) -> (rank, merged symbol); ``by_rank``: merged symbol of each rank.
    """
    n = len(symbols)
    if n < 2:
        return symbols
    sym, get = list(symbols), pairs.get
    size = 1 << (n - 2).bit_length()
    bits = n.bit_length()
    mask = (1 << bits) - 1
    tree = [INFINITY] * (2 * size)
    for i, pair in enumerate(zip(sym, sym[1:], strict=False)):
        found = get(pair)
        if found:
            tree[size + i] = found[0] << bits | i
    for i in range(size - 1, 0, -1):
        a, b = tree[2 * i], tree[2 * i + 1]
        tree[i] = a if a < b else b

    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    while (low := tree[1]) != INFINITY:
        i = low & mask
        gone = after[i]
        k = after[gone]
        sym[i] = new = by_rank[low >> bits]
        sym[gone] = -1
        after[i] = k
        x = y = z = size + i  # the leaves that change, left to right
        if k < n:
            before[k] = i
            found = get((new, sym[k]))
            tree[y] = found[0] << bits | i if found else INFINITY
            z = size + gone
            tree[z] = INFINITY
        else:
            tree[y] = INFINITY
        h = before[i]
        if h >= 0:
            x = size + h
            found = get((sym[h], new))
            tree[x] = found[0] << bits | h if found else INFINITY
        x, y, z = x >> 1, y >> 1, z >> 1
        while z:  # their paths to the root, level by level
            a, b = tree[2 * z], tree[2 * z + 1]
            tree[z] = a if a < b else b
            if y != z:
                a, b = tree[2 * y], tree[2 * y + 1]
                tree[y] = a if a < b else b
            if x != y:
                a, b = tree[2 * x], tree[2 * x + 1]
                tree[x] = a if a < b else b
            x, y, z = x >> 1, y >> 1, z >> 1
    return [s for s in sym if s >= 0]


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Codec:
    """Encoder and decoder of one tokenizer file (byte-level BPE with a word end suffix)."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, added = spec["model"], spec["added_tokens"]
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        if model["type"] != "BPE" or model.get("dropout") or model.get("byte_fallback") or model.get("ignore_merges") or model.get("unk_token") or model.get("continuing_subword_prefix"):
            raise ValueError(f"{path}: not a plain BPE model")
        if len(steps) != 2 or steps[0].get("behavior") != "Removed" or not steps[0].get("invert") or steps[1]["type"] != "ByteLevel" or steps[1]["use_regex"] or steps[1]["add_prefix_space"]:
            raise ValueError(f"{path}: the words must be the matches of one pattern, in byte letters")
        if any(a["lstrip"] or a["rstrip"] or a["single_word"] or a["normalized"] for a in added):
            raise ValueError(f"{path}: added tokens must be plain strings")
        if [s["type"] for s in spec["normalizer"]["normalizers"]] != ["NFC", "Replace", "Lowercase"]:
            raise ValueError(f"{path}: the normaliser must be NFC, white space, lower case")
        vocab: dict[str, int] = model["vocab"]
        end = model.get("end_of_word_suffix") or ""
        self.word = regex.compile(steps[0]["pattern"]["Regex"])
        library = Tokenizer.from_file(path)
        self.normalise, self.split = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        letters = byte_letters()
        self.inner = [vocab[x] for x in letters]
        self.last = [vocab[x + end] for x in letters]
        self.byte_of = {x: i for i, x in enumerate(letters)}
        self.pairs, self.by_rank = {}, []
        for rank, (a, b) in enumerate(model["merges"]):
            self.by_rank.append(vocab[a + b])
            self.pairs[vocab[a], vocab[b]] = (rank, vocab[a + b])
        self.special = {a["content"]: a["id"] for a in added}
        self.cut = regex.compile("(" + "|".join(regex.escape(x) for x in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.first = {x[0] for x in self.special}
        self.tokens = [""] * (max([*vocab.values(), *self.special.values()], default=-1) + 1)
        for x, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = x
        self.plain_decoder = spec.get("decoder") is None
        self.known = common.Remembered(REMEMBERED_WORDS, common.own_words(self.split))

    def word_ids(self, word: bytes) -> list[int]:
        """Ids of one word, given as its bytes."""
        if not word:
            return []
        symbols = [self.inner[b] for b in word[:-1]]
        symbols.append(self.last[word[-1]])
        return merge(symbols, self.pairs, self.by_rank)

    def run_ids(self, run: str) -> bytes:
        """Packed ids of a run of characters without white space or special tokens."""
        ids: list[int] = []
        if common.BEYOND_LATIN.search(run):
            for letters, _ in self.split(self.normalise(run)):
                ids += self.word_ids(bytes(self.byte_of[x] for x in letters))
        else:
            for word in self.word.findall(run.lower()):
                ids += self.word_ids(word.encode())
        return np.array(ids, "<i4").tobytes()

    def plain_ids(self, text: str) -> bytes:
        """Packed ids of a text without special tokens."""
        if not common.BEYOND_LATIN.search(text):  # fewer different runs; the normaliser lowers them all the same
            text = text.lower()
        runs = text.split() if not any(x in text for x in _SEPARATORS) else [r for r in _WHITE.split(text) if r]
        return self.known.joined(runs, lambda new: [self.run_ids(r) for r in new])

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text as packed little-endian 32-bit integers."""
        if not text:
            return b""
        if self.cut is None or not any(x in text for x in self.special):
            return self.plain_ids(text)
        parts = self.cut.split(text)
        return b"".join(np.array([self.special[p]], "<i4").tobytes() if i % 2 else self.plain_ids(p) for i, p in enumerate(parts))

    def decode(self, ids: list[int]) -> str:
        return self.decode_all(pa.array([ids], pa.list_(pa.int32())))[0].as_py()

    def decode_all(self, ids: pa.ListArray) -> pa.Array:
        """Of each list, the tokens of its ids, joined by one space (null: empty); ids outside the vocabulary are left out."""
        if not self.plain_decoder:
            raise ValueError(_DECODABLE)
        flat, ends = ids.values, ids.offsets.to_numpy()
        inside = pc.fill_null(pc.and_(pc.greater_equal(flat, 0), pc.less(flat, len(self.tokens))), False)
        known = inside.to_numpy(zero_copy_only=False)
        if not known.all():
            flat, ends = flat.filter(inside), np.concatenate([[0], np.cumsum(known)])[ends].astype(np.int32)
        tokens = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(self.tokens, pa.string()).take(flat))
        return pc.fill_null(pc.if_else(ids.is_valid(), pc.binary_join(tokens, " "), ""), "")


@functools.lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    return Codec(path)


def _packed(c: Codec, texts: pa.Array) -> pa.ListArray:
    """Ids of each text of a batch."""
    packed = [c.encode(t) for t in texts.to_pylist()]
    offsets = np.zeros(len(packed) + 1, np.int32)
    np.cumsum([len(p) // 4 for p in packed], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(packed), "<i4")))


def _ids(name: str) -> T.StructField:
    return T.StructField(name, T.ArrayType(T.IntegerType(), False))


def encode(df: DataFrame, tokenizer: str, text: str = "text", out: str = "ids") -> DataFrame:
    """Append ``out``: array<int> ids of each whole text."""

    def make():
        c = codec(tokenizer)
        return lambda b: [_packed(c, common.column(b, text))]

    return common.add_columns(df, [_ids(out)], make)


def decode(df: DataFrame, tokenizer: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Append ``out``: the text of each id array (null: empty)."""

    def make():
        c = codec(tokenizer)

        def batch(b: pa.RecordBatch) -> list:
            return [c.decode_all(common.column(b, ids))]

        return batch

    return common.add_columns(df, [T.StructField(out, T.StringType())], make)


def encode_decode(df: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """``encode``, then ``decode`` of what it gave, in columns ``ids`` and ``decoded``.

    Both are done in one pass: two passes in a row hold two Python workers with their own tables for each task.
    """

    def make():
        c = codec(tokenizer)

        def batch(b: pa.RecordBatch) -> list:
            ids = _packed(c, common.column(b, text))
            return [ids, c.decode_all(ids)]

        return batch

    return common.add_columns(df, [_ids("ids"), T.StructField("decoded", T.StringType())], make, ROUND_TRIP_ROWS)


def with_digests(df: DataFrame) -> DataFrame:
    """Token count and digests of the columns ``ids`` and ``decoded``."""
    return df.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def word_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@register("op7_bpe")
def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Round trip of every whole document through the segment-tree BPE."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return with_digests(encode_decode(docs, word_bpe()))
