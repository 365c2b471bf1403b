"""Byte-level BPE encoding and decoding with overlapping chunks.

Texts up to CHUNK characters are one chunk and are encoded where they are read. A
longer text is cut into chunks that overlap; all chunks are pre-tokenised in
parallel, and two neighbours are stitched at the first boundary of pre-tokens that
both find in their overlap: from there on they cannot differ, as a match depends on
nothing before it. The segments between stitches are then encoded in parallel, and
the ids are joined in order. If an overlap holds no common boundary (a run of letters
longer than the overlap), the rest of that text is one segment. Decoding concatenates
the raw bytes of the ids.

Stitches follow a character that is no blank, since only runs of blanks look at what
comes after them; a segment alone then splits as it does within its text.

Defined cases: NULL is the empty text, with no ids; rows that repeat an id are
encoded one by one; no row gives no row.
"""

from __future__ import annotations

import base64
import hashlib
import os

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import stored

CHUNK, OVERLAP = 1 << 16, 1 << 10
LOOKAHEAD = 4  # the longest match that looks at following characters, "'ll", and one more
RANKS = "byte_bpe_50k.tiktoken"

_loaded: dict[str, tiktoken.Encoding] = {}


def encoding(name: str = RANKS) -> tiktoken.Encoding:
    """The encoding of a rank file, once per process. A path is taken as it is."""
    if name not in _loaded:
        path = name if os.path.sep in name else public_tokenizers.path(name)
        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())}
        _loaded[name] = tiktoken.Encoding(
            os.path.basename(name), pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
    return _loaded[name]


def boundaries(body: str) -> list[int]:
    """Ends of the pre-tokens of a chunk that do not depend on what follows the chunk,
    and after which a text may be cut."""
    ends = [m.end() for m in regex.finditer(public_tokenizers.PATTERN, body)]
    return [e for e in ends[:-1] if e <= len(body) - LOOKAHEAD and not body[e - 1].isspace()]


def stitches(heads: dict[int, list[int]], tails: dict[int, list[int]], chunks: int) -> list[int]:
    """Where to cut a text: for each chunk the first boundary that it and the chunk
    before it both have in their overlap. heads and tails count from the chunk's start."""
    cuts = []
    for c in range(1, chunks):
        common = set(heads.get(c, ())) & set(tails.get(c - 1, ()))
        if not common:
            break
        cuts.append(c * CHUNK + min(common))
    return cuts


def _digests(enc: tiktoken.Encoding, ids: list[int]) -> tuple[int, str, str]:
    packed = np.asarray(ids, dtype="<u4").tobytes()
    return len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(enc.decode_bytes(ids)).hexdigest()


DIGESTS = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def _outputs(ranks: str, digests: bool):
    """Columns of the output from the lists of ids."""
    enc = encoding(ranks)

    def columns(lists: list[list[int]]) -> tuple[list[pa.Array], list[str]]:
        if not digests:
            return [pa.array(lists, pa.list_(pa.int32()))], ["ids"]
        made = [_digests(enc, ids) for ids in lists]
        kinds = (pa.int64(), pa.string(), pa.string())
        return [pa.array([row[k] for row in made], kinds[k]) for k in range(3)], ["n_tokens", "ids_sha256", "decoded_sha256"]

    return enc, columns


def _encode_rows(ranks: str, digests: bool):
    def run(batches):
        enc, columns = _outputs(ranks, digests)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                arrays, names = columns([enc.encode_ordinary(t or "") for t in part.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *arrays], names=["doc_id", *names])

    return run


def _cut_chunks(batches):
    for batch in batches:
        for row, text in zip(batch.column("row").to_pylist(), batch.column("text").to_pylist()):
            for c, at in enumerate(range(0, len(text), CHUNK)):
                yield pa.RecordBatch.from_pydict({"row": [row], "chunk": [c], "body": [text[at : at + CHUNK + OVERLAP]]})


def _zones(batches):
    for batch in batches:
        out = {"row": batch.column("row").to_pylist(), "chunk": batch.column("chunk").to_pylist(), "head": [], "tail": []}
        for body in batch.column("body").to_pylist():
            ends = boundaries(body)
            out["head"].append([e for e in ends if e < OVERLAP])
            out["tail"].append([e - CHUNK for e in ends if e >= CHUNK])
        schema = pa.schema([("row", pa.int64()), ("chunk", pa.int64()), ("head", pa.list_(pa.int32())), ("tail", pa.list_(pa.int32()))])
        yield pa.RecordBatch.from_pydict(out, schema=schema)


def _stitch(pdf: pd.DataFrame) -> pd.DataFrame:
    heads = dict(zip(pdf["chunk"], map(list, pdf["head"])))
    tails = dict(zip(pdf["chunk"], map(list, pdf["tail"])))
    return pd.DataFrame({"row": [pdf["row"].iloc[0]], "cuts": [stitches(heads, tails, len(pdf))]})


def _cut_segments(batches):
    for batch in batches:
        for row, text, cuts in zip(*(batch.column(c).to_pylist() for c in ("row", "text", "cuts"))):
            ends = [*cuts, len(text)]
            for s, (a, b) in enumerate(zip([0, *cuts], ends)):
                yield pa.RecordBatch.from_pydict({"row": [row], "segment": [s], "text": [text[a:b]]})


def _encode_segments(ranks: str):
    def run(batches):
        enc = encoding(ranks)
        for batch in batches:
            packed = [np.asarray(enc.encode_ordinary(t), dtype="<u4").tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("segment"), pa.array(packed, pa.binary())], names=["row", "segment", "packed"])

    return run


def _join_segments(ranks: str, digests: bool):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        _, columns = _outputs(ranks, digests)
        ids = np.frombuffer(b"".join(pdf.sort_values("segment")["packed"]), dtype="<u4").tolist()
        arrays, names = columns([ids])
        return pd.DataFrame({"row": [pdf["row"].iloc[0]], **{n: a.to_pylist() for n, a in zip(names, arrays)}})

    return run


def encoded(spark: SparkSession, docs: DataFrame, ranks: str = RANKS, digests: bool = False) -> DataFrame:
    """doc_id with ids (array<int>), or with their count and digests, for each document."""
    out = DIGESTS if digests else "ids array<int>"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    is_long = F.length(F.coalesce("text", F.lit(""))) > CHUNK
    short = rows.where(~is_long).mapInArrow(_encode_rows(ranks, digests), f"doc_id long, {out}")
    # Long texts get a number that holds from here on, as ids may repeat.
    long = stored(spark, rows.where(is_long).withColumn("row", F.monotonically_increasing_id()), "long-texts")
    chunks = long.select("row", "text").mapInArrow(_cut_chunks, "row long, chunk long, body string").repartition("row", "chunk")
    zones = chunks.mapInArrow(_zones, "row long, chunk long, head array<int>, tail array<int>")
    cuts = zones.groupBy("row").applyInPandas(_stitch, "row long, cuts array<long>")
    segments = long.select("row", "text").join(cuts, "row").select("row", "text", "cuts")
    segments = segments.mapInArrow(_cut_segments, "row long, segment long, text string").repartition("row", "segment")
    ids = segments.mapInArrow(_encode_segments(ranks), "row long, segment long, packed binary")
    joined = ids.groupBy("row").applyInPandas(_join_segments(ranks, digests), f"row long, {out}")
    return short.unionByName(long.select("row", "doc_id").join(joined, "row").drop("row"))


def _decode(ranks: str):
    def run(batches):
        enc = encoding(ranks)
        for batch in batches:
            raw = [enc.decode_bytes(ids or []) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(raw, pa.binary())], names=["doc_id", "bytes"])

    return run


def decoded(ids: DataFrame, ranks: str = RANKS) -> DataFrame:
    """doc_id and the raw bytes of the ids; NULL ids are no bytes."""
    return ids.select("doc_id", "ids").mapInArrow(_decode(ranks), "doc_id long, bytes binary")


def op7(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return encoded(spark, docs, digests=True)
