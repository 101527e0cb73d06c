"""Token shards in training order.

Every document's ids (and a separator) are cut into sequences of ``seq_len``
tokens.  A sequence's address is ``document id x most pieces + piece``; a keyed
Feistel network over the enclosing power of four, walked until it lands inside
the domain, permutes the addresses.  The permuted address orders all sequences;
a sequence's global slot is its place in that order, 0 to n - 1 without gaps.
Equal ranges of permuted addresses are the shards.  So one pass encodes, one
shuffle moves ids, and shards are even whatever the keys of the input are.

A record has a fixed length: a header (document id, piece, tokens), ids of 2
or 4 bytes padded with zeros, and a line feed that the text writer adds.  A
reader that stopped at slot s finds it by division: the manifest gives each
shard's first slot, the record's index in its file gives the rest.

Files are written by Spark's text writer, whose commit protocol makes each
shard appear once, however often a task was tried, on any file system.

Defined cases: a null or empty text is one sequence with the separator; rows
without an id come before the others' addresses as id lowest - 1; rows with
equal ids are ordered by the hash of their text; an empty table writes nothing
and gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigil.llm.encoding import encoder, vocabulary_path
from vigil.llm.spark import scratch_path, table

SEQ_LEN = 512
SHARD_BYTES = 8 << 20
#: Documents or records that a task passes on at a time.
_DOCS, _RECORDS = 128, 2048
KEY = 0x5EED_0F_7261
ROUNDS = 6
SEPARATOR = 0
_HEADER = np.dtype([("doc_id", "<i8"), ("piece", "<i4"), ("n_tokens", "<i4")])


def _round(x: np.ndarray, key: int, number: int) -> np.ndarray:
    """A keyed mix of one half."""
    x = x + np.uint64((key + 0x9E3779B97F4A7C15 * (number + 1)) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _half_bits(domain: int) -> int:
    return max(1, -(-max(1, (domain - 1).bit_length()) // 2))


def permute(address: np.ndarray, domain: int, key: int = KEY) -> np.ndarray:
    """The keyed permutation of 0 .. domain - 1 (at most 2**62)."""
    bits = np.uint64(_half_bits(domain))
    mask = np.uint64((1 << int(bits)) - 1)
    out = address.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):  # cycle-walking: on average at most four steps
        left, right = out[todo] >> bits, out[todo] & mask
        for k in range(ROUNDS):
            left, right = right, left ^ (_round(right, key, k) & mask)
        out[todo] = (left << bits) | right
        todo = todo[out[todo] >= domain]
    return out.astype(np.int64)


def unpermute(slot: np.ndarray, domain: int, key: int = KEY) -> np.ndarray:
    """The inverse of ``permute``."""
    bits = np.uint64(_half_bits(domain))
    mask = np.uint64((1 << int(bits)) - 1)
    out = slot.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> bits, out[todo] & mask
        for k in reversed(range(ROUNDS)):
            left, right = right ^ (_round(left, key, k) & mask), left
        out[todo] = (left << bits) | right
        todo = todo[out[todo] >= domain]
    return out.astype(np.int64)


def permute_pairs(left: np.ndarray, right: np.ndarray, key: int = KEY) -> tuple[np.ndarray, np.ndarray]:
    """The keyed permutation of all pairs of 64-bit numbers: two halves of 64 bits, so nothing to walk."""
    left, right = left.astype(np.uint64), right.astype(np.uint64)
    for k in range(ROUNDS):
        left, right = right, left ^ _round(right, key, k)
    return left, right


@dataclass(frozen=True)
class Layout:
    """What a reader must know: all of it is fixed before encoding starts.

    ``domain`` 0: ids lie more than 2**62 addresses apart; (id, piece) is then permuted as a
    pair of 64-bit numbers and ordered by the pair.
    """

    seq_len: int
    id_bytes: int
    lowest: int
    pieces: int
    domain: int
    shards: int
    key: int

    @property
    def stride(self) -> int:
        return _HEADER.itemsize + self.seq_len * self.id_bytes + 1

    def shard_of(self, order: np.ndarray) -> np.ndarray:
        return (order // -(-(self.domain or 1 << 63) // self.shards)).astype(np.int32)

    def places(self, own: np.ndarray, piece: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where sequences stand: a number, and one that decides between equal ones."""
        if self.domain:
            return permute((own - self.lowest) * self.pieces + piece, self.domain, self.key), np.zeros(len(own), np.int64)
        left, right = permute_pairs(own.view(np.uint64), piece.view(np.uint64), self.key)
        return (left >> np.uint64(1)).astype(np.int64), ((left << np.uint64(63)) | (right >> np.uint64(1))).view(np.int64)


def layout_for(docs: DataFrame, path: str, seq_len: int = SEQ_LEN, shard_bytes: int = SHARD_BYTES, key: int = KEY) -> Layout:
    """From one light pass over ids and byte lengths.  A token has one byte or more, so bytes bound the pieces."""
    size = F.octet_length(F.coalesce("text", F.lit("")))
    r = docs.agg(
        F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.max(size).alias("most"), F.sum(size.cast("double")).alias("sum"), F.count(F.lit(1)).alias("n")
    ).first()
    id_bytes = 2 if encoder(path).tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
    lowest = (r["lo"] if r["lo"] is not None else 0) - 1  # the address of rows without an id
    pieces = -(-((r["most"] or 0) + 1) // seq_len)
    domain = ((r["hi"] if r["hi"] is not None else 0) - lowest + 1) * pieces
    tokens = (r["sum"] or 0.0) / 3 + r["n"]  # only sizes the shards
    shards = max(1, min(domain, round(tokens * id_bytes / shard_bytes)))
    if domain > 1 << 62:
        lowest, domain = 0, 0
    return Layout(seq_len, id_bytes, lowest, pieces, domain, shards, key)


def sequences(docs: DataFrame, path: str, layout: Layout) -> DataFrame:
    """``place`` (permuted address), ``shard``, ``tie`` and ``record`` of every sequence."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in (b.slice(k, _DOCS) for b in batches for k in range(0, b.num_rows, _DOCS)):
            owns, pieces, ties, records = [], [], [], []
            for doc, text, tie in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                ids = np.append(enc.encode(text.as_py()), SEPARATOR).astype(f"<u{layout.id_bytes}")
                own = layout.lowest if doc is None else doc
                for piece, at in enumerate(range(0, len(ids), layout.seq_len)):
                    part = ids[at : at + layout.seq_len]
                    if doc is None and not layout.domain:
                        piece = -1 - piece  # no id is left to stand for none
                    head = np.array([(own, piece, len(part))], _HEADER)
                    owns.append(own)
                    pieces.append(piece)
                    ties.append(tie)
                    records.append(head.tobytes() + part.tobytes())
            order, second = layout.places(np.array(owns, np.int64), np.array(pieces, np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(order), pa.array(second), pa.array(layout.shard_of(order)), pa.array(ties, pa.int64()), pa.array(records, pa.binary())],
                ["place", "second", "shard", "tie", "record"],
            )

    given = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.xxhash64("text").alias("tie"))
    return given.mapInArrow(run, "place long, second long, shard int, tie long, record binary")


def write_shards(docs: DataFrame, path: str, to: str, layout: Layout) -> None:
    """One file per shard under ``to``/shard=<k>, records in order of their slots."""
    rows = sequences(docs.select("doc_id", "text"), path, layout)
    dealt = rows.repartitionById(layout.shards, F.col("shard")).sortWithinPartitions("shard", "place", "second", "tie")
    # ids are padded only here, after the shuffle; a cast keeps bytes as they are
    padded = F.rpad("record", layout.stride - 1, F.lit(b"\x00"))
    dealt.select("shard", padded.cast("string").alias("value")).write.partitionBy("shard").option("lineSep", "\n").text(to)


def manifest(spark: SparkSession, at: str, layout: Layout) -> DataFrame:
    """``shard, path, records, first_slot`` of the written files (their names and sizes only)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(at)
    listed = files.select(
        F.regexp_extract("path", r"shard=(\d+)/", 1).cast("int").alias("shard"),
        "path",
        (F.col("length") / layout.stride).cast("long").alias("records"),
    )
    # one row per shard file
    before = Window.orderBy("shard", "path").rowsBetween(Window.unboundedPreceding, -1)
    return listed.withColumn("first_slot", F.coalesce(F.sum("records").over(before), F.lit(0)))


def read_shards(spark: SparkSession, at: str, layout: Layout, from_slot: int = 0, with_ids: bool = True) -> DataFrame:
    """``slot, shard, doc_id, piece, n_tokens, ids_crc32`` and, ``with_ids``, ``ids``
    from ``from_slot`` on; earlier shards are not opened.  ``ids_crc32`` is over the
    ids as little-endian unsigned 32-bit integers.

    Records are streamed by Hadoop's fixed-length reader (no DataFrame source
    reads such files without holding one whole), which splits files between
    records and gives each one's position.
    """
    schema = "shard int, place long, doc_id long, piece int, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    listed = manifest(spark, at, layout).where(F.col("first_slot") + F.col("records") > from_slot)
    paths = [r["path"] for r in listed.select("path").collect()]  # one per shard
    if not paths:
        return spark.createDataFrame([], schema).select(F.lit(0).cast("long").alias("slot"), "*").drop("place")
    record = np.dtype([("h", _HEADER), ("ids", f"<u{layout.id_bytes}", (layout.seq_len,)), ("end", "u1")])

    def decode(group: list[tuple[int, bytes]]) -> Iterator[tuple]:
        rows = np.frombuffer(b"".join(raw for _, raw in group), record)
        if (rows["end"] != 10).any():
            raise ValueError("a shard is not a whole number of records")
        own, piece = rows["h"]["doc_id"], rows["h"]["piece"].astype(np.int64)
        places, _ = layout.places(np.ascontiguousarray(own), piece)
        none = own == layout.lowest if layout.domain else piece < 0
        columns = (
            layout.shard_of(places).tolist(),
            [p // layout.stride for p, _ in group],
            [None if n else d for d, n in zip(own.tolist(), none.tolist())],
            np.where(piece < 0, -1 - piece, piece).tolist(),
            rows["h"]["n_tokens"].tolist(),
        )
        for row, ids in zip(zip(*columns), rows["ids"].astype("<u4")):
            ids = ids[: row[-1]]
            yield (*row, zlib.crc32(ids.tobytes()), *([ids.tolist()] if with_ids else []))

    def run(records: Iterable[tuple[int, bytes]]) -> Iterator[tuple]:
        records = iter(records)
        while group := list(islice(records, _RECORDS)):
            yield from decode(group)

    found = spark.sparkContext.newAPIHadoopFile(
        ",".join(paths),
        "org.apache.hadoop.mapreduce.lib.input.FixedLengthInputFormat",
        "org.apache.hadoop.io.LongWritable",
        "org.apache.hadoop.io.BytesWritable",
        conf={"fixedlengthinputformat.record.length": str(layout.stride)},
    )
    rows = spark.createDataFrame(found.mapPartitions(run), schema, verifySchema=False)
    slots = rows.join(F.broadcast(listed.select("shard", "first_slot")), "shard")  # one row per shard
    slots = slots.withColumn("slot", F.col("first_slot") + F.col("place")).where(F.col("slot") >= from_slot)
    return slots.select("slot", *[c for c in rows.columns if c != "place"])


def op8_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes all documents as shards and reads every record back from them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = vocabulary_path("byte_bpe_50k.json")
    layout = layout_for(docs, path)
    to = scratch_path(spark, "token-shards")
    write_shards(docs, path, to, layout)
    return read_shards(spark, to, layout, with_ids=False)
