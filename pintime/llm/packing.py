"""Packing by power-of-two decomposition.

Every document's tokens (with the end id) are cut into pieces whose lengths are
powers of two: as many pieces of ``max_length`` as fit, then the binary digits
of the rest, largest first. A piece is a sequence of its own, so no sequence
crosses documents and none needs padding; equal lengths form a bucket, and
batches draw from one bucket. The cut needs only the document's own length, so
nothing is shuffled and a hot source or a very long text changes nothing.

Defined results: null or empty text gives the single end id (one piece of
length 1); null ids are kept; repeated rows are packed once each.
"""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pintime.llm.common import id_text, map_text, table
from pintime.llm.merge_rounds import codec

VOCABULARY = "byte_bpe_50k.json"
END_ID = 1
MAX_LENGTH = 2048


def token_bytes(texts: list[str], path: str) -> list[bytes]:
    """The tokenizer's ids of each whole text, as little-endian unsigned 32-bit integers."""
    return codec(path).encode(texts)


def cut(n: int, max_length: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens; ``max_length`` is a power of two."""
    out = [(at, max_length) for at in range(0, n - max_length + 1, max_length)]
    at, rest = n - n % max_length, n % max_length
    for bit in range(max_length.bit_length() - 2, -1, -1):
        if rest >> bit & 1:
            out.append((at, 1 << bit))
            at += 1 << bit
    return out


def pack(docs: DataFrame, max_length: int = MAX_LENGTH, end_id: int = END_ID,
         tokenizer_path: str | None = None, with_ids: bool = True,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: where it lies in its document, its bucket, its sequence and its ids.

    ``bucket`` is the length's exponent; ``sequence_id`` is unique; ``offset`` is
    the piece's place in its sequence (0: a sequence is one piece).
    """
    if max_length & max_length - 1 or max_length < 1:
        raise ValueError("max_length must be a power of two")
    path = tokenizer_path or public_tokenizers.path(VOCABULARY)
    end = np.asarray([end_id], "<u4").tobytes()

    def work(doc_ids: list, texts: list[str]) -> dict[str, list]:
        out: dict[str, list] = {k: [] for k in ("doc_id", "start", "length", "ids_crc32",
                                               "doc_tokens", "ids")}
        for doc, data in zip(doc_ids, token_bytes(texts, path), strict=True):
            data += end
            n = len(data) // 4
            for at, length in cut(n, max_length):
                piece = data[4 * at:4 * (at + length)]
                out["doc_id"].append(doc)
                out["start"].append(at)
                out["length"].append(length)
                out["ids_crc32"].append(zlib.crc32(piece))
                out["doc_tokens"].append(n)
                if with_ids:
                    out["ids"].append(np.frombuffer(piece, "<u4").astype("i4"))
        return out

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    pieces = map_text(id_text(docs, id_col, text_col),
                      schema + ", ids array<int>" * with_ids, work)
    # A task's rows come from a fixed part of the input, so a task that runs again
    # gives its pieces the same ids.
    return pieces.withColumns({
        "sequence_id": F.monotonically_increasing_id(),
        "offset": F.lit(0).cast("long"),
        "bucket": F.log2("length").cast("int"),
    })


def batches(pieces: DataFrame, batch_tokens: int) -> DataFrame:
    """Group pieces of one bucket into batches of ``batch_tokens`` tokens.

    A batch holds ``batch_tokens / length`` sequences of one length (one at
    least). Sequences are dealt by a hash of their id to cells of a few
    thousand rows and numbered there, so the rows of the commonest length never
    meet in one task; each cell ends with at most one smaller batch.
    """
    counts = pieces.groupBy("bucket").agg(F.count("*").alias("_n"))
    # at most log2(max_length) + 1 rows
    dealt = pieces.join(F.broadcast(counts), "bucket").withColumn(
        "_cell", F.expr("pmod(xxhash64(sequence_id), cast(_n / 4096 + 1 as bigint))"))
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy("bucket", "_cell").orderBy("sequence_id")) - 1
    size = F.greatest(F.lit(1), F.floor(F.lit(batch_tokens) / F.col("length")))
    return (dealt.withColumn("_batch", F.floor(place / size))
            .withColumn("batch_id", F.concat_ws("-", "bucket", "_cell", "_batch"))
            .drop("_n", "_cell", "_batch"))


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), with_ids=False)
