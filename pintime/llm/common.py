"""Helpers shared by the operators: reading tables, bounded text batches, chunk caches.

Defined results that hold for every operator built on these helpers: the id and
text columns are selected under fixed names before anything else, so extra
columns (also ones named like an output column) never clash; a null text counts
as empty; repeated rows each give their own result; an empty table gives an
empty result with the full schema.
"""

from __future__ import annotations

import os
import re
import struct
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Python work happens on groups of rows of about this many characters, so that
#: memory follows this bound (or the longest single text), not the Arrow batch.
GROUP_CHARS = 700_000

#: Unicode White_Space, as the tokenizers' ``\s`` has it (fixed values).
WHITE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
_UNUSUAL = re.compile(f"[{WHITE.replace(chr(10), '').replace(' ', '')}]")
_CHUNK = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+$")


def ship(spark: SparkSession) -> None:
    """Give the executors' Python this package (once a Spark context)."""
    context = spark.sparkContext
    if getattr(context, "_pintime_shipped", None):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    # the driver serves the file to the executors for as long as it runs
    folder = tempfile.TemporaryDirectory()
    path = os.path.join(folder.name, "pintime_llm.zip")
    with zipfile.ZipFile(path, "w") as z:
        for at, _, names in os.walk(package):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(at, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    context.addPyFile(path)
    context._pintime_shipped = folder


def map_arrow(df: DataFrame, run: Callable, schema: str | T.StructType) -> DataFrame:
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the whole text (null: empty), under fixed names."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"),
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def groups(texts: list[str], limit: int = GROUP_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive rows with about ``limit`` characters, one row at least."""
    at = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= limit:
            yield at, i + 1
            at, size = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def map_text(df: DataFrame, schema: str,
             work: Callable[[list, list[str]], dict[str, list]]) -> DataFrame:
    """Apply ``work(ids, texts) -> columns`` to bounded groups of rows of ``id_text``."""
    arrow = _arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column(1)
            at = 0
            while at < batch.num_rows:      # decode a bounded slice at a time
                size, to = 0, at
                while to < batch.num_rows and (to == at or size < GROUP_CHARS):
                    size += len(lengths[to].as_buffer())
                    to += 1
                part = batch.slice(at, to - at)
                out = work(part.column(0).to_pylist(), part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[f.name], f.type) for f in arrow], schema=arrow)
                at = to

    return map_arrow(df, run, schema)


def annotate(df: DataFrame, text_col: str, added: str,
             work: Callable[[list[str]], dict[str, list]]) -> DataFrame:
    """All columns of ``df`` and those that ``work(texts)`` adds (null text: empty).

    ``df`` must not have columns of the added names; ``carried`` puts any columns out of
    their way.
    """
    arrow = _arrow_schema(added)
    schema = T.StructType([*df.schema.fields, *T.DataType.fromDDL(added).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.names.index(text_col))
            at = 0
            while at < batch.num_rows:
                size, to = 0, at
                while to < batch.num_rows and (to == at or size < GROUP_CHARS):
                    size += len(column[to].as_buffer() or b"")
                    to += 1
                part = batch.slice(at, to - at)
                texts = [x or "" for x in column.slice(at, to - at).to_pylist()]
                out = work(texts)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *(pa.array(out[f.name], f.type) for f in arrow)],
                    names=[*part.schema.names, *arrow.names])
                at = to

    return map_arrow(df, run, schema)


def carried(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``doc``, a struct of all columns, and ``text``: no other name can clash with what is
    added. ``select("doc.*")`` gives the columns back."""
    return docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("doc"),
                       docs[f"`{text_col}`"].cast("string").alias("text"))


def _arrow_schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64(),
             "boolean": pa.bool_(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32()),
             "array<long>": pa.list_(pa.int64()), "array<double>": pa.list_(pa.float64()),
             "array<string>": pa.list_(pa.string())}
    fields = [f.strip().split(" ", 1) for f in ddl.split(",")]
    return pa.schema([(n, kinds[k.strip()]) for n, k in fields])


def chunks(text: str) -> tuple[list[str], list[str]]:
    """The text cut where non-space meets white space: (chunks as they are, chunks less a blank).

    Every pre-token of the public byte-level pattern lies inside one chunk, and
    a chunk alone gives the same pre-tokens as inside its text: no class of the
    pattern crosses from a non-space to white space, and its look-ahead only
    looks right, over white space that the chunk holds whole. Texts whose white
    space is single blanks and line ends between words are cut by ``str.split``
    (a line end then stays inside its chunk, which is as safe); all their chunks
    but the first begin with the one blank that the second list leaves out.
    """
    if not text:
        return [], []
    if not single_blanks(text):
        return _CHUNK.findall(text), []
    words = text.split(" ")
    return words[:1], words[1:]


def single_blanks(text: str) -> bool:
    """Whether a text's white space is single blanks and line ends between words."""
    return not ("  " in text or " \n" in text or "\n " in text or text[:1] == " "
                or text[-1:] == " " or _UNUSUAL.search(text))


#: A chunk of one Latin word, with or without marks behind it: what the pattern
#: makes of it needs no general matching.
WORD, MARKS = " ?[A-Za-zÀ-ÖØ-öø-ÿ]+", ".,;:!?|&%$#*"
_WORD = re.compile(f"({WORD})([{MARKS}]*)")


def simple_pre_tokens(chunk: str) -> list[str] | None:
    """The pattern's matches of a chunk, if it is one word with marks; else None."""
    m = _WORD.fullmatch(chunk)
    return None if m is None else [m[1], m[2]] if m[2] else [m[1]]


_FORMATS = [struct.Struct(f"<{n}I") for n in range(64)]


def pack_ids(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return _FORMATS[len(ids)].pack(*ids) if len(ids) < 64 else np.array(ids, "<u4").tobytes()


class _Kept(dict):
    """A dict that notes the keys it lacks and answers None for them."""

    def __init__(self):
        super().__init__()
        self.lacks: list[str] = []

    def __missing__(self, key: str) -> None:
        self.lacks.append(key)


class ChunkCache:
    """Values of chunks; what is new in a group of texts is computed in one call.

    ``compute(chunks) -> values``; ``prefix`` begins the chunks of the second
    list. It keeps two generations of ``limit`` entries each: when the younger is
    full it becomes the older, and entries in use move over again, so that words
    met once don't push out common ones. Chunks longer than ``LONGEST`` are not
    kept. All this bounds memory only.
    """

    LONGEST = 64

    def __init__(self, compute: Callable[[list[str]], list], prefix: str = " ",
                 limit: int = 400_000):
        self.compute, self.prefix, self.limit = compute, prefix, limit
        self.plain, self.cut = _Kept(), _Kept()
        self.old_plain: dict = {}
        self.old_cut: dict = {}

    def _fill(self) -> list[tuple[_Kept, list[str]]]:
        """Give the lacking keys their values; returns those that were computed."""
        new = []
        for kept, old in ((self.plain, self.old_plain), (self.cut, self.old_cut)):
            lacking = set(kept.lacks)
            kept.lacks = []
            known = old.keys() & lacking
            kept.update({c: old.pop(c) for c in known})
            new.append((kept, list(lacking - known)))
        (_, plain), (_, cut) = new
        values = self.compute(plain + [self.prefix + c for c in cut])
        self.plain.update(zip(plain, values, strict=False))
        self.cut.update(zip(cut, values[len(plain):], strict=True))
        return new

    def values(self, parts: list[tuple[list[str], list[str]]]) -> list[list]:
        """For each text's two lists of chunks, the values in order."""
        if len(self.plain) + len(self.cut) > self.limit:
            self.old_plain, self.old_cut = self.plain, self.cut
            self.plain, self.cut = _Kept(), _Kept()
        plain, cut = self.plain.__getitem__, self.cut.__getitem__
        out, again, seen = [], [], 0
        for i, (a, b) in enumerate(parts):
            out.append([*map(plain, a), *map(cut, b)])
            lacks = len(self.plain.lacks) + len(self.cut.lacks)
            if lacks > seen:
                again.append(i)
                seen = lacks
        if again:
            new = self._fill()
            for i in again:
                a, b = parts[i]
                out[i] = [*map(plain, a), *map(cut, b)]
            for kept, chunks_ in new:
                for c in chunks_:
                    if len(c) > self.LONGEST:
                        del kept[c]
        return out


def gathered(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The stretches of ``values`` one after the other."""
    before = np.cumsum(lengths) - lengths
    return values[np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))]


def _with(array: np.ndarray, used: int, more: np.ndarray) -> np.ndarray:
    """``array`` with ``more`` after its first ``used`` entries, in more room if need be."""
    if used + len(more) > len(array):
        array = np.concatenate([array[:used], np.zeros(used + 2 * len(more), array.dtype)])
    array[used:used + len(more)] = more
    return array


class TokenCache:
    """Token ids of chunks; the new ones of a group of texts are computed in one call.

    ``compute(chunks) -> (ids of all chunks in a row, how many each has)``. Texts are cut as
    ``chunks`` cuts them, in Arrow; a group's chunks are numbered, so that only the distinct
    ones are looked up; ids lie in one array, from which whole texts are gathered. Past
    ``limit`` chunks, or eight times as many ids, it starts anew with the next group, which
    bounds memory and changes no result.
    """

    def __init__(self, compute: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]],
                 limit: int = 300_000):
        self.compute, self.limit = compute, limit
        self._forget()

    def _forget(self) -> None:
        # by chunk: as it is, and (True) those that a blank precedes
        self.places: dict[bool, dict[str, int]] = {False: {}, True: {}}
        self.n = self.used = 0
        self.starts, self.lengths = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _held(self, distinct: pa.Array, cut: bool) -> np.ndarray:
        """Where each chunk's entry is; new ones are computed."""
        held = self.places[cut]
        words = distinct.to_numpy(zero_copy_only=False).tolist()
        at = np.fromiter(map(held.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(at < 0)
        if len(new):
            some = distinct.take(pa.array(new))
            ids, lengths = self.compute(pc.binary_join_element_wise(
                pa.scalar("", some.type), some, pa.scalar(" ", some.type)) if cut else some)
            at[new] = np.arange(self.n, self.n + len(new))
            self.starts = _with(self.starts, self.n, self.used + np.cumsum(lengths) - lengths)
            self.lengths = _with(self.lengths, self.n, lengths)
            self.ids = _with(self.ids, self.used, ids)
            held.update(zip([words[i] for i in new.tolist()], at[new].tolist(), strict=True))
            self.n, self.used = self.n + len(new), self.used + len(ids)
        return at

    def encode(self, texts: list[str]) -> list[bytes]:
        """All ids of each text as little-endian 32-bit integers."""
        if self.n > self.limit or self.used > 8 * self.limit:
            self._forget()
        plain = np.array([single_blanks(t) for t in texts], bool)
        split = pc.split_pattern(pa.array([t for t, p in zip(texts, plain, strict=True) if p],
                                          pa.large_string()), " ")
        found = [chunks(t)[0] for t, p in zip(texts, plain, strict=True) if not p]
        counts = np.zeros(len(texts), np.int64)
        counts[plain] = pc.list_value_length(split).to_numpy()
        counts[~plain] = [len(f) for f in found]
        own = np.argsort(~plain, kind="stable")        # split texts, then the others
        starts = np.zeros(len(texts), np.int64)
        starts[own] = np.cumsum(counts[own]) - counts[own]
        words = pa.concat_arrays([split.flatten(), pa.array(
            [c for f in found for c in f], pa.large_string())])
        encoded = words.dictionary_encode()
        number, distinct = encoded.indices.to_numpy(), encoded.dictionary
        first = np.zeros(len(words), bool)      # as they are: first words, and found chunks
        first[starts[plain][counts[plain] > 0]] = True
        first[int(counts[plain].sum()):] = True
        places = np.zeros(len(words), np.int64)
        for cut in (False, True):
            mine = first != cut
            used = np.flatnonzero(np.bincount(number[mine], minlength=len(distinct)))
            where = np.zeros(len(distinct), np.int64)
            where[used] = self._held(distinct.take(pa.array(used)), cut)
            places[mine] = where[number[mine]]
        places = gathered(places, starts, counts)
        lengths = self.lengths[places]
        data = gathered(self.ids, self.starts[places], lengths).astype("<u4").tobytes()
        ends = (4 * np.r_[0, np.cumsum(lengths)][np.cumsum(counts)]).tolist()
        pa.default_memory_pool().release_unused()   # what the group's arrays took
        return [data[a:b] for a, b in zip([0, *ends], ends, strict=False)]
