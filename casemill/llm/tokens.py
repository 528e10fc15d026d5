"""Counts and ids of a public byte-level BPE vocabulary, exact for texts of any length.

A text is worked on in pieces only where cutting provably changes nothing.  The
vocabulary's pre-tokeniser reads left to right and looks ahead only past white space;
white space is never taken into a pre-token that began with something else.  So a
place between a character that isn't white space and a white space character ends a
pre-token whatever stands around it, and both sides can be encoded on their own.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casemill.session import task_slots

TOKENIZERS = "/opt/tokenizers"
#: Fixed value: the pattern that the vocabulary's authors split text by before merging.
PRE_TOKEN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CHUNK_CHARS = 16_384
OVERLAP_CHARS = 512


@functools.lru_cache(maxsize=4)
def encoder(folder: str, name: str = "byte_bpe_50k"):
    """The vocabulary as a tiktoken encoding; one per worker process."""
    import tiktoken

    with open(f"{folder}/{name}.tiktoken", "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(name, pat_str=PRE_TOKEN, mergeable_ranks=ranks, special_tokens={})


def encode(text: str | None, folder: str = TOKENIZERS) -> np.ndarray:
    """Ids without special tokens; none for NULL and for the empty text."""
    if not text:
        return np.zeros(0, np.uint32)
    return encoder(folder).encode_to_numpy(text, disallowed_special=())


def decode(ids: list[int], folder: str = TOKENIZERS) -> str:
    """The text whose ids these are: the tokens' bytes, concatenated."""
    return b"".join(map(encoder(folder).decode_single_token_bytes, ids)).decode("utf-8", "replace")


def independent(text: str, at: int) -> bool:
    """Whether the text may be cut before ``at``: white space after something else."""
    return text[at] in " \n" and not text[at - 1].isspace()


def independent_pieces(text: str, size: int) -> list[str]:
    """The text cut into pieces of about ``size``, at independent places only.

    Where no such place follows, as in a script without spaces, a piece grows until
    one does: the pieces always have the same tokens as the whole.
    """
    out, start = [], 0
    while len(text) - start > size:
        at = start + size
        while at < len(text) and not independent(text, at):
            at += 1
        if at >= len(text):
            break
        out.append(text[start:at])
        start = at
    return [*out, text[start:]]


def _with_counts(batches: Iterator[pa.RecordBatch], column: str, folder: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.schema.get_field_index(column)
        counts = [len(encode(x, folder)) for x in batch.column(at).to_pylist()]
        rest = [k for k in range(batch.num_columns) if k != at]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(k) for k in rest), pa.array(counts, pa.int64())],
            names=[*(batch.schema.names[k] for k in rest), "n_tokens"],
        )


def token_counts(
    records: DataFrame, text: str = "content", chunk_chars: int = CHUNK_CHARS, folder: str = TOKENIZERS
) -> DataFrame:
    """The rows of ``records`` with n_tokens (BIGINT) in the place of the text.

    Rows up to ``chunk_chars`` are counted where they are. Longer ones are cut at
    independent places, the pieces are spread over all workers by row and piece
    number, counted, and summed per row. NULL and empty texts have 0 tokens; rows
    that are repeated stay repeated; an empty table gives an empty one. A column
    n_tokens of ``records`` itself gives way to the count.
    """
    others = [c for c in records.columns if c not in (text, "n_tokens")]
    kinds = dict(records.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in others) + ", n_tokens bigint"
    is_long = F.coalesce(F.length(text) > chunk_chars, F.lit(False))
    short = records.where(~is_long).select(*others, text)
    counted = short.mapInArrow(lambda batches: _with_counts(batches, text, folder), schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                pieces = independent_pieces(batch.column(text)[k].as_py(), chunk_chars)
                same = batch.slice(k, 1).select([*others, "_row_no"]).take(pa.array([0] * len(pieces)))
                yield pa.RecordBatch.from_arrays(
                    [*same.columns, pa.array(range(len(pieces)), pa.int32()), pa.array(pieces, pa.string())],
                    names=[*others, "_row_no", "_piece_no", text],
                )

    with_row = ", ".join(f"`{c}` {kinds[c]}" for c in others) + ", _row_no bigint"
    pieces = (
        records.where(is_long)
        .select(*others, F.xxhash64(*others, text).alias("_row_no"), text)
        .mapInArrow(cut, f"{with_row}, _piece_no int, `{text}` string")
        .repartition(task_slots(records.sparkSession), "_row_no", "_piece_no")
    )
    summed = (
        pieces.mapInArrow(lambda b: _with_counts(b, text, folder), f"{with_row}, _piece_no int, n_tokens bigint")
        .groupBy(*others, "_row_no", "_piece_no")
        # a row that is there k times has k equal pieces for each place
        .agg(F.sum("n_tokens").alias("n"), F.count(F.lit(1)).alias("copies"))
        .groupBy(*others, "_row_no")
        .agg(F.sum("n").alias("n"), F.max("copies").alias("copies"))
        .select(*others, F.explode(F.array_repeat((F.col("n") / F.col("copies")).cast("bigint"), F.col("copies").cast("int"))).alias("n_tokens"))
    )
    return counted.unionByName(summed)


def token_budget(counted: DataFrame, slices: list[str]) -> DataFrame:
    """Totals of each combination of the slices, of each slice alone, and of all.

    Columns: level, the slices (NULL where they are summed over), n_records, n_tokens,
    tokens_per_record. ``level`` names the slices that a row is about, so that a slice
    which is NULL itself isn't taken for a sum. Without records there are no rows.
    """
    totals = counted.groupBy(*slices).agg(F.count(F.lit(1)).alias("n"), F.sum("n_tokens").alias("t"))
    sets = [[F.col(s) for s in kept] for kept in (slices, *([s] for s in slices), [])]
    rolled = totals.groupingSets(sets, *slices).agg(
        F.sum("n").alias("n_records"), F.sum("t").alias("n_tokens"), *(F.grouping(s).alias(f"_over_{k}") for k, s in enumerate(slices))
    )
    named = F.concat_ws(",", *(F.when(F.col(f"_over_{k}") == 0, F.lit(s)) for k, s in enumerate(slices)))
    return rolled.select(
        F.coalesce(F.nullif(named, F.lit("")), F.lit("all")).alias("level"),
        *slices,
        "n_records",
        "n_tokens",
        (F.col("n_tokens") / F.col("n_records")).alias("tokens_per_record"),
    )


def _id_batches(batches: Iterator[pa.RecordBatch], keys: list[str], text: str, folder: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 512):
            part = batch.slice(start, 512)
            ids = [encode(x, folder) for x in part.column(text).to_pylist()]
            places = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            flat = np.concatenate([*ids, np.zeros(0, np.uint32)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*(part.column(k) for k in keys), pa.ListArray.from_arrays(pa.array(places), pa.array(flat))],
                names=[*keys, "ids"],
            )


_PRE = regex.compile(PRE_TOKEN)


def seam_candidates(chunk: str, start: int, low: int, high: int) -> tuple[list[int], list[int]]:
    """Starts of pre-tokens in [low, high) of the text, seen from a chunk that begins at ``start``.

    Only starts after something that isn't white space count, as a piece that ends in
    white space would be read differently. Those of the chunk's last characters don't
    count either: what follows could still change them. The second list has the
    independent ones among them, which hold wherever the chunk began.
    """
    found = [m.start() for m in _PRE.finditer(chunk)]
    common = [
        start + p
        for p in found
        if low <= start + p < high and 0 < p < len(chunk) - 4 and not chunk[p - 1].isspace()
    ]
    return common, [p for p in common if independent(chunk, p - start)]


def long_text_ids(
    documents: DataFrame, key: str, text: str, chunk_chars: int, overlap: int, folder: str
) -> DataFrame:
    """(key, ids) of texts longer than a chunk, each encoded by many workers.

    Overlapping chunks are pre-tokenised apart. Where, inside an overlap, both chunks
    begin a pre-token at the same place, they agree from there on: the text is cut at
    the first such place of every overlap and the pieces are encoded apart. An overlap
    without one isn't cut; after it only independent places count until the end, as
    the chunk to its right may never have fallen into step. Rows are told apart by a
    128-bit digest of key and text; a row that is there k times has k equal pieces for
    each place, and comes out k times.
    """
    spark = documents.sparkSession
    step, kind, slots = chunk_chars - overlap, dict(documents.dtypes)[key], task_slots(spark)
    rows = documents.select(
        F.xxhash64(key, text).alias("_a"), F.xxhash64(F.lit(1), key, text).alias("_b"), F.col(key).alias("_key"), F.col(text).alias("_text")
    )
    own = ["_a", "_b"]

    def numbered(batch: pa.RecordBatch, k: int, names: list[str], column: str, parts: list[str]) -> pa.RecordBatch:
        same = batch.slice(k, 1).select(names).take(pa.array([0] * len(parts), pa.int32()))
        return pa.RecordBatch.from_arrays(
            [*same.columns, pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.string())], names=[*names, "_no", column]
        )

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                whole = batch.column("_text")[k].as_py()
                n = max(1, -(-(len(whole) - overlap) // step))
                yield numbered(batch, k, own, "_chunk", [whole[x * step : x * step + chunk_chars] for x in range(n)])

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for a, b, no, chunk in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                start = no * step
                for side, seam, low in ((0, no, start), (1, no + 1, start + step)):
                    found.append((a, b, seam, side, *seam_candidates(chunk, start, low, low + overlap)))
            columns = list(zip(*found, strict=True)) or [[] for _ in range(6)]
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=[*own, "seam", "side", "common", "proven"]
            )

    agreed = (
        rows.mapInArrow(chunks, "_a bigint, _b bigint, _no int, _chunk string")
        .repartition(slots, *own, "_no")
        .mapInArrow(places, "_a bigint, _b bigint, seam int, side int, common array<int>, proven array<int>")
        .where("seam > 0")
        .groupBy(*own, "seam")
        .agg(
            (F.min("side") < F.max("side")).alias("both"),
            F.array_intersect(F.min("common"), F.max("common")).alias("common"),
            F.array_intersect(F.min("proven"), F.max("proven")).alias("proven"),
        )
        .where("both")
    )
    so_far = Window.partitionBy(*own).orderBy("seam").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seams = (
        agreed.withColumn("in_step", F.min(F.size("common") > 0).over(so_far))
        .withColumn("cut", F.when(F.col("in_step"), F.array_min("common")).otherwise(F.array_min("proven")))
        .groupBy(*own)
        .agg(F.sort_array(F.collect_list("cut")).alias("_cuts"))
    )
    named = [*own, "_key"]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                whole, cuts = batch.column("_text")[k].as_py(), batch.column("_cuts")[k].as_py()
                ends = [0, *(cuts or []), len(whole)]
                yield numbered(batch, k, named, "_piece", [whole[x:y] for x, y in zip(ends, ends[1:], strict=False)])

    kinds = f"_a bigint, _b bigint, _key {kind}, _no int"
    encoded = (
        rows.join(seams, own, "left")
        .select(*named, "_text", "_cuts")
        .mapInArrow(pieces, f"{kinds}, _piece string")
        .repartition(slots, *own, "_no")
        .mapInArrow(lambda b: _id_batches(b, [*named, "_no"], "_piece", folder), f"{kinds}, ids array<int>")
        .groupBy(*named, "_no")
        .agg(F.first("ids").alias("ids"), F.count(F.lit(1)).alias("copies"))
    )
    whole = encoded.groupBy(*named).agg(
        F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("_no", "ids"))), lambda p: p["ids"])).alias("ids"), F.max("copies").alias("copies")
    )
    return whole.select(F.col("_key").alias(key), "ids", F.explode(F.sequence(F.lit(1), "copies")).alias("_copy")).drop("_copy")


def encode_corpus(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    chunk_chars: int = CHUNK_CHARS,
    overlap: int = OVERLAP_CHARS,
    folder: str = TOKENIZERS,
) -> DataFrame:
    """(key, ids ARRAY<INT>): the ids of every text, without special tokens.

    Texts of up to ``chunk_chars`` characters are encoded where they are read, without
    a shuffle; longer ones by long_text_ids. NULL and empty texts have the empty list.
    Keys may repeat or be NULL: every row gives one row, whatever its text's length.
    """
    if chunk_chars <= 2 * overlap:
        raise ValueError("chunk_chars must be more than twice the overlap")
    rows = documents.select(key, text)
    is_long = F.coalesce(F.length(text) > chunk_chars, F.lit(False))
    kind = dict(documents.dtypes)[key]
    short = rows.where(~is_long).mapInArrow(
        lambda b: _id_batches(b, [key], text, folder), f"`{key}` {kind}, ids array<int>"
    )
    return short.unionByName(long_text_ids(rows.where(is_long), key, text, chunk_chars, overlap, folder))
