"""Alignment of two tokenizers over the same bytes, and how often their ids stand for each other.

Both vocabularies are decoded to bytes. Offsets where a token of A and a token of B both end cut the
tokens of a document into groups. For nearly all ids of A, B has an id of the same bytes; that map is an
array made once. A group of one A and one B token of the same bytes is then a single id of A: the
documents that hold it are counted in a vector with a cell per A id, one vector per task. Only the pairs
of the other groups enter a shuffle of (A id, B id) keys.

Scoring needs the counts of a document's own pairs. Those of the first kind, the highest count per A id
and the most frequent other pairs, up to `FREQUENT_PAIRS` of them, go to every task: their size is
bounded by the vocabulary and by that parameter. Rarer pairs are joined by key; none of them is frequent
enough to be a hot key. The bound decides which way a pair goes, never the result.

* A null or empty text, and one whose tokens of A or B do not give back space + text, has no tokens:
  zeros, an empty digest, no groups.
* Strings of special tokens inside a text are plain text.
* Rows that repeat a document id or a text are documents of their own, each counted.
* A very long text is one document and held by one task; its groups are worked off in slices.
* Only the two columns named are read, so others cannot clash. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rankmill.llm.blocks import SCHEMA, block_batch, collected, summed_blocks
from rankmill.llm.common import ship_package, stored

TOKENIZERS = "/opt/tokenizers"
A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
FREQUENT_PAIRS = 1_000_000
SLICE_BYTES = 2**20  # texts tokenised and aligned together
WIDE_PAIRS = 4096  # a group of more pairs is reduced to different ids before they are paired
BLOCK_CELLS = 2**13

# How byte-level BPE splits a text before merging (the published pattern), and the sign
# for a space in pieces.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPACE_SIGN = "▁"

ALIGNED = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "same array<int>, same_links array<long>, other array<long>, other_links array<long>"
)


def byte_signs() -> dict[str, int]:
    """The character that stands for each byte in byte-level BPE: itself if printable, else 256 and up."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


def bytes_of_a(model: str) -> list[bytes]:
    """Bytes of every id of a byte-level BPE file; an added token's are those of its string."""
    data = json.loads(model)
    signs = byte_signs()
    added = {t["id"]: t["content"].encode() for t in data["added_tokens"]}
    by_id = {i: bytes(signs[c] for c in word) for word, i in data["model"]["vocab"].items() if i not in added}
    by_id |= added
    return [by_id.get(i, b"") for i in range(max(by_id) + 1)]


def bytes_of_b(pieces: sentencepiece.SentencePieceProcessor) -> list[bytes]:
    """Bytes of every piece; byte pieces stand for their byte."""
    out = []
    for i in range(pieces.get_piece_size()):
        piece = pieces.id_to_piece(i)
        out.append(bytes([int(piece[1:-1], 16)]) if pieces.is_byte(i) else piece.replace(SPACE_SIGN, " ").encode())
    return out


def _encoder_a(model: str):
    """Texts to ids of A.

    Where the merges of the file are in the order of the ids they make, ranks and ids are the same and the
    faster of the two public encoders serves; the tests hold one against the other.
    """
    data = json.loads(model)
    vocab, merges = data["model"]["vocab"], data["model"]["merges"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
    plain = data["pre_tokenizer"] == {
        "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": data["pre_tokenizer"].get("trim_offsets"), "use_regex": True,
    }
    made = [vocab.get("".join(p)) for p in pairs]
    if plain and data["normalizer"] is None and made == list(range(256, 256 + len(made))):
        special = {t["id"] for t in data["added_tokens"]}
        ranks = {word: i for i, word in enumerate(bytes_of_a(model)) if i not in special}
        encoding = tiktoken.Encoding("a", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        return lambda texts: [encoding.encode_ordinary(t) for t in texts]
    tokenizer = Tokenizer.from_str(model)
    tokenizer.encode_special_tokens = True
    return lambda texts: [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


@dataclass
class Vocabularies:
    """Both files as they are; what follows from them is built once per process."""

    a_model: str
    b_model: bytes
    _built: dict = field(default_factory=dict)

    @classmethod
    def read(cls, folder: str = TOKENIZERS, a_file: str = A_FILE, b_file: str = B_FILE) -> Vocabularies:
        with open(f"{folder}/{a_file}", encoding="utf-8") as a, open(f"{folder}/{b_file}", "rb") as b:
            return cls(a.read(), b.read())

    def __getstate__(self) -> dict:
        return {"a_model": self.a_model, "b_model": self.b_model, "_built": {}}

    def aligner(self) -> Aligner:
        if "aligner" not in self._built:
            self._built["aligner"] = Aligner(self.a_model, self.b_model)
        return self._built["aligner"]

    def sizes(self) -> tuple[int, int]:
        pieces = sentencepiece.SentencePieceProcessor(model_proto=self.b_model)
        return len(bytes_of_a(self.a_model)), pieces.get_piece_size()


class Aligner:
    """Tokens of both vocabularies, cut into groups."""

    def __init__(self, a_model: str, b_model: bytes):
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        self.encode_a = _encoder_a(a_model)
        self.a_bytes, self.b_bytes = bytes_of_a(a_model), bytes_of_b(self.pieces)
        self.a_sizes = np.array([len(x) for x in self.a_bytes], dtype=np.int64)
        self.b_sizes = np.array([len(x) for x in self.b_bytes], dtype=np.int64)
        self.n_a, self.n_b = len(self.a_bytes), len(self.b_bytes)
        # a byte piece and a plain piece may have the same bytes; the last, plain one is the one texts use
        by_bytes = {word: i for i, word in enumerate(self.b_bytes)}
        self.same = np.array([by_bytes.get(word, -1) for word in self.a_bytes], dtype=np.int64)
        # each id as text, followed by what comes after it inside a group and at its end
        ids_a, ids_b = [str(i) for i in range(self.n_a)], [str(i) for i in range(self.n_b)]
        self.shown = [s + end for ids, ends in ((ids_a, ",|"), (ids_b, ",;")) for end in ends for s in ids]

    def tokens(self, texts: list[str | None]) -> list[tuple[list[int], list[int]] | None]:
        """Ids of A and B per text; None where a text has no tokens."""
        some = [n for n, t in enumerate(texts) if t]
        spaced = [" " + texts[n] for n in some]
        out: list[tuple[list[int], list[int]] | None] = [None] * len(texts)
        a_ids = self.encode_a(spaced)
        b_ids = self.pieces.encode([texts[n] for n in some], num_threads=1)
        for n, text, a, b in zip(some, spaced, a_ids, b_ids, strict=True):
            plain = text.encode("utf-8")
            if all(b"".join(map(words.__getitem__, ids)) == plain for words, ids in ((self.a_bytes, a), (self.b_bytes, b))):
                out[n] = a, b
        return out

    def groups(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """End positions of each group in the tokens of A and of B."""
        ends_a, ends_b = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        at = np.searchsorted(ends_b, ends_a)
        both = ends_b[np.minimum(at, len(ends_b) - 1)] == ends_a
        return np.flatnonzero(both) + 1, at[both] + 1

    def shown_groups(self, a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> str:
        """`a1,a2|b1;a3|b2,b3`."""
        order = np.empty(len(a) + len(b), dtype=np.int64)
        size_a, size_b = np.diff(cut_a, prepend=0), np.diff(cut_b, prepend=0)
        last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        last_a[cut_a - 1] = last_b[cut_b - 1] = 1
        order[np.arange(len(a)) + np.repeat(cut_b - size_b, size_a)] = a + last_a * self.n_a
        order[np.arange(len(b)) + np.repeat(cut_a, size_b)] = 2 * self.n_a + b + last_b * self.n_b
        return "".join(map(self.shown.__getitem__, order.tolist()))[:-1]

    def links(self, a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> tuple[np.ndarray, ...]:
        """Different pairs, as A id * size of B + B id, and the links of each."""
        size_a, size_b = np.diff(cut_a, prepend=0), np.diff(cut_b, prepend=0)
        first_a, first_b = cut_a - size_a, cut_b - size_b
        pairs = size_a * size_b
        wide = np.flatnonzero(pairs > WIDE_PAIRS)
        some = np.flatnonzero(pairs <= WIDE_PAIRS)
        n = pairs[some]
        inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        width = np.repeat(size_b[some], n)
        codes = a[np.repeat(first_a[some], n) + inner // width] * self.n_b + b[np.repeat(first_b[some], n) + inner % width]
        found, counts = np.unique(codes, return_counts=True)
        for g in wide:
            ids_a, n_a = np.unique(a[first_a[g] : cut_a[g]], return_counts=True)
            ids_b, n_b = np.unique(b[first_b[g] : cut_b[g]], return_counts=True)
            more = (ids_a[:, None] * self.n_b + ids_b).ravel()
            found, at = np.unique(np.concatenate([found, more]), return_inverse=True)
            counts = np.bincount(at, np.concatenate([counts, np.outer(n_a, n_b).ravel()])).astype(np.int64)
        return found, counts

    def aligned(self, tokens: tuple[list[int], list[int]] | None) -> tuple:
        """The digest columns of a document, and its pairs: same-bytes ones by A id, others by code."""
        if tokens is None:
            return 0, 0, 0, 0, "", [], [], [], []
        a, b = (np.array(ids, dtype=np.int64) for ids in tokens)
        cut_a, cut_b = self.groups(a, b)
        digest = hashlib.sha256(self.shown_groups(a, b, cut_a, cut_b).encode()).hexdigest()
        codes, counts = self.links(a, b, cut_a, cut_b)
        ids = codes // self.n_b
        same = self.same[ids] == codes % self.n_b
        return len(a), len(b), len(cut_a), int(counts.sum()), digest, ids[same], counts[same], codes[~same], counts[~same]


def _text_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[str | None]]]:
    """(doc ids, texts) of some rows at a time, by the size of their texts."""
    for batch in batches:
        sizes = np.cumsum(pc.binary_length(batch.column(1)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
        cuts = np.flatnonzero(np.diff(sizes // SLICE_BYTES, prepend=-1))
        for start, end in zip(cuts, [*cuts[1:], batch.num_rows], strict=True):
            yield batch.column(0).slice(start, end - start), batch.column(1).slice(start, end - start).to_pylist()


def aligned_documents(docs: DataFrame, vocabularies: Vocabularies) -> DataFrame:
    """The digest columns and the pairs of every document, see `ALIGNED`."""
    names = [f.split()[0] for f in ALIGNED.split(", ")]
    kinds = [pa.int64()] * 5 + [pa.string(), pa.list_(pa.int32())] + [pa.list_(pa.int64())] * 3
    shared = docs.sparkSession.sparkContext.broadcast(vocabularies)

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = shared.value.aligner()
        for ids, texts in _text_slices(batches):
            rows = [aligner.aligned(tokens) for tokens in aligner.tokens(texts)]
            columns = [ids, *[pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds[1:], strict=True)]]
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(align, ALIGNED)


def token_groups(docs: DataFrame, vocabularies: Vocabularies) -> DataFrame:
    """(doc_id, groups): the ids of A and of B in each group, in order; none for a text without tokens."""
    ship_package(docs.sparkSession)
    ids = pa.list_(pa.int32())
    kind = pa.list_(pa.struct([("a", ids), ("b", ids)]))
    shared = docs.sparkSession.sparkContext.broadcast(vocabularies)

    def grouped(aligner: Aligner, tokens: tuple[list[int], list[int]] | None) -> list[dict]:
        if tokens is None:
            return []
        a, b = tokens
        cuts = [c.tolist() for c in aligner.groups(np.array(a), np.array(b))]
        starts = [[0, *c[:-1]] for c in cuts]
        return [{"a": a[i:j], "b": b[k:m]} for i, j, k, m in zip(starts[0], cuts[0], starts[1], cuts[1], strict=True)]

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = shared.value.aligner()
        for doc_ids, texts in _text_slices(batches):
            rows = [grouped(aligner, tokens) for tokens in aligner.tokens(texts)]
            yield pa.RecordBatch.from_arrays([doc_ids, pa.array(rows, kind)], ["doc_id", "groups"])

    schema = "doc_id long, groups array<struct<a: array<int>, b: array<int>>>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(group, schema)


def same_counts(aligned: DataFrame, n_a: int) -> np.ndarray:
    """Documents that hold each A id linked to the B id of the same bytes."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(n_a, dtype=np.int64)
        for batch in batches:
            # an id stands once in a document's list
            counts += np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False), minlength=n_a)
        yield block_batch(0, counts, BLOCK_CELLS)

    return collected(summed_blocks(aligned.select("same").mapInArrow(counted, SCHEMA)), n_a, BLOCK_CELLS)


def other_counts(aligned: DataFrame) -> DataFrame:
    """(code, n): documents that hold each other pair."""
    return aligned.select(F.explode("other").alias("code")).groupBy("code").agg(F.count(F.lit(1)).alias("n"))


def _least_frequent(counts: DataFrame, pairs: int) -> int:
    """The smallest power of two such that no more than `pairs` pairs have that count."""
    sizes = counts.groupBy(F.floor(F.log2("n")).alias("power")).agg(F.count(F.lit(1)).alias("pairs"))
    total, least = 0, None
    by_power = {r["power"]: r["pairs"] for r in sizes.collect()}
    for power in sorted(by_power, reverse=True):
        total += by_power[power]
        if total > pairs:
            break
        least = 2**power
    return least if least is not None else 2 ** (max(by_power, default=0) + 1)


def align_tokenizers(docs: DataFrame, vocabularies: Vocabularies, frequent_pairs: int = FREQUENT_PAIRS) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row of `docs`."""
    spark = docs.sparkSession
    ship_package(spark)
    n_a, n_b = vocabularies.sizes()
    aligned = stored(aligned_documents(docs, vocabularies), "aligned-documents")
    counts = stored(other_counts(aligned), "aligned-pairs")
    same = same_counts(aligned, n_a)
    best = same.copy()
    # one row per A id at most
    for row in counts.groupBy(F.expr(f"code div {n_b}").alias("a")).agg(F.max("n").alias("n")).toLocalIterator():
        best[row["a"]] = max(best[row["a"]], row["n"])
    least = _least_frequent(counts, frequent_pairs)
    frequent = counts.where(F.col("n") >= least).orderBy("code").toArrow()
    table = spark.sparkContext.broadcast(
        (same, best, *[frequent.column(c).combine_chunks().to_numpy() for c in ("code", "n")])
    )
    digests = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    scored_schema = (
        "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
        "n_best long, count_sum long, rare array<long>, rare_links array<long>"
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        same, best, codes, numbers = table.value

        def sums(row: int, batch: pa.RecordBatch) -> tuple:
            ids, links, other, more = (batch.column(c)[row].values.to_numpy(zero_copy_only=False) for c in range(6, 10))
            at = np.minimum(np.searchsorted(codes, other), max(len(codes) - 1, 0))
            known = codes[at] == other if len(codes) else np.zeros(len(other), bool)
            n = numbers[at[known]] if len(codes) else np.zeros(0, np.int64)
            good = n == best[other[known] // n_b]
            n_best = links[same[ids] == best[ids]].sum() + more[known][good].sum()
            return n_best, (links * same[ids]).sum() + (more[known] * n).sum(), other[~known], more[~known]

        for batch in batches:
            rows = [sums(n, batch) for n in range(batch.num_rows)]
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            scored = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * 4, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:6], *scored], [*digests, "n_best", "count_sum", "rare", "rare_links"]
            )

    known = aligned.mapInArrow(score, scored_schema).withColumn("row", F.monotonically_increasing_id())
    if counts.where(F.col("n") < least).isEmpty():
        return known.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    known = stored(known, "aligned-scores")
    highest = F.broadcast(spark.createDataFrame([(i, int(n)) for i, n in enumerate(best)], "a int, best long"))
    pairs = known.select("row", F.explode(F.arrays_zip("rare", "rare_links")).alias("p")).select(
        "row", F.col("p.rare").alias("code"), F.col("p.rare_links").alias("links")
    )
    rest = (
        pairs.join(counts.where(F.col("n") < least), "code")
        .withColumn("a", F.expr(f"cast(code div {n_b} as int)"))
        .join(highest, "a")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("n") == F.col("best"), F.col("links")).otherwise(0)).alias("rare_best"),
            F.sum(F.col("links") * F.col("n")).alias("rare_sum"),
        )
    )
    return known.join(rest, "row", "left").select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        (F.col("n_best") + F.coalesce("rare_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("rare_sum", F.lit(0))).alias("count_sum"),
        "groups_sha256",
    )
