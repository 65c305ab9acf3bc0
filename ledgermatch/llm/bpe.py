"""Byte-level BPE encoding and decoding by overlapping chunks.

Long texts are cut into overlapping chunks that are pre-tokenised in parallel.
Two neighbouring chunks are stitched at the first pre-token boundary that both
have in their overlap: the pattern looks only forward, so two scans that both
start a pre-token at one place agree from there on. The pieces between such
places are encoded in parallel and their ids are put together in order.
Decoding concatenates the ids' raw bytes.

Defined results: a null text is the empty text (no ids). Empty tables give
empty tables. Rows are encoded one by one, so repeated rows and repeated ids
give one output row per input row. A pre-token longer than the overlap leaves
two chunks without a common boundary; such a text is encoded as one piece.
Columns other than the named ones are ignored, so their names cannot clash.
"""

from __future__ import annotations

import base64

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgermatch.llm.arrow import slices

CHUNK_CHARS = 32768   # chunk length; texts up to this length are one piece
OVERLAP = 1024        # characters that two neighbouring chunks share
MARGIN = 8            # a match that ends this close to a cut may still grow


def _encoding(ranks_path: str, pattern: str):
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def _encoder(ranks_path: str, pattern: str, text_col: str):
    """mapInArrow function: ``text_col`` replaced by (n_tokens, ids)."""
    def run(batches):
        enc = _encoding(ranks_path, pattern)
        for b in slices(batches):
            ids = [enc.encode_to_numpy(t or "", disallowed_special=()).astype("<u4", copy=False)
                   for t in b.column(text_col).to_pylist()]
            keep = [i for i, f in enumerate(b.schema.names) if f != text_col]
            yield pa.RecordBatch.from_arrays(
                [b.column(i) for i in keep] + [pa.array([len(x) for x in ids], pa.int64()),
                                               pa.array([x.tobytes() for x in ids], pa.binary())],
                names=[b.schema.names[i] for i in keep] + ["n_tokens", "ids"])
    return run


def _cut(chunk: int, overlap: int):
    """mapInArrow function: one row per overlapping chunk of each text."""
    def run(batches):
        for b in slices(batches):
            for key, doc, text in zip(*(b.column(c).to_pylist() for c in ("key", "id", "text"))):
                starts = range(0, max(1, len(text) - overlap), chunk)
                last = len(starts) - 1
                for k, s in enumerate(starts):
                    yield pa.RecordBatch.from_pylist(
                        [{"key": key, "id": doc, "k": k, "start": s, "last": k == last,
                          "chunk": text[s:] if k == last else text[s:s + chunk + overlap]}], schema=CUT)
    return run


CUT = pa.schema([("key", pa.int64()), ("id", pa.int64()), ("k", pa.int32()), ("start", pa.int64()),
                 ("last", pa.bool_()), ("chunk", pa.string())])


def _boundaries(pattern: str, chunk: int, overlap: int, margin: int):
    """mapInArrow function: the places in the text where a chunk's own scan
    starts a pre-token, in its first ``overlap`` characters and its last."""
    def run(batches):
        import regex

        pat = regex.compile(pattern)
        for b in slices(batches):
            head, tail = [], []
            for text, start, last in zip(*(b.column(c).to_pylist() for c in ("chunk", "start", "last"))):
                size = len(text) if last else len(text) - margin
                begins = [m.start() for m in pat.finditer(text) if last or m.end() <= size]
                head.append([start + p for p in begins if p <= overlap])
                tail.append([] if last else [start + p for p in begins if p >= chunk])
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column("key"), b.column("k"), pa.array(head, kind), pa.array(tail, kind)],
                names=["key", "k", "head", "tail"])
    return run


def _pieces():
    """mapInArrow function: a chunk's text cut to [lo, hi)."""
    def run(batches):
        for b in slices(batches):
            out = [t[lo - s: hi - s if hi is not None else None]
                   for t, s, lo, hi in zip(*(b.column(c).to_pylist() for c in ("chunk", "start", "lo", "hi")))]
            yield pa.RecordBatch.from_arrays([b.column("key"), b.column("id"), b.column("k"), pa.array(out, pa.string())],
                                             names=["key", "id", "k", "piece"])
    return run


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           chunk: int = CHUNK_CHARS, overlap: int = OVERLAP, margin: int = MARGIN) -> DataFrame:
    """(``id_col``, n_tokens long, ids binary: little-endian unsigned 32-bit).

    ``ranks_path`` must be readable on every executor. Texts longer than
    ``chunk`` go through cut, pre-tokenise, stitch, encode and join; the others
    are one piece and need no shuffle.
    """
    if not margin < overlap <= chunk:
        raise ValueError("margin < overlap <= chunk is needed")
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    short = (src.where(F.char_length("text") <= chunk)
             .mapInArrow(_encoder(ranks_path, pattern, "text"), "id long, n_tokens long, ids binary"))
    # A row of a long text gets a key of its own, so that repeated ids stay apart.
    long_docs = src.where(F.char_length("text") > chunk).withColumn("key", F.monotonically_increasing_id())
    chunks = (long_docs.mapInArrow(_cut(chunk, overlap),
                                   "key long, id long, k int, start long, last boolean, chunk string")
              .repartition("key", "k"))
    marks = chunks.mapInArrow(_boundaries(pattern, chunk, overlap, margin), "key long, k int, head array<long>, tail array<long>")
    by_text = Window.partitionBy("key").orderBy("k")
    stitched = (marks.withColumn("next_head", F.lead("head").over(by_text))
                .withColumn("lo_next", F.when(F.col("next_head").isNotNull(),
                                              F.array_min(F.array_intersect("tail", "next_head"))))
                .withColumn("open", F.col("next_head").isNotNull() & F.col("lo_next").isNull())
                .withColumn("whole", F.max("open").over(Window.partitionBy("key")))
                .withColumn("lo", F.coalesce(F.lag("lo_next").over(by_text), F.lit(0).cast("long")))
                .select("key", "k", "lo", F.col("lo_next").alias("hi"), "whole"))
    cut = chunks.join(stitched, ["key", "k"])
    parts = (cut.where(~F.col("whole")).select("key", "id", "k", "chunk", "start", "lo", "hi")
             .mapInArrow(_pieces(), "key long, id long, k int, piece string"))
    whole = (long_docs.join(stitched.where("whole").select("key").distinct(), "key", "left_semi")
             .select("key", "id", F.lit(0).alias("k"), F.col("text").alias("piece")))
    coded = parts.unionByName(whole).mapInArrow(_encoder(ranks_path, pattern, "piece"),
                                                "key long, id long, k int, n_tokens long, ids binary")
    # One group is the pieces of one text, so it is no larger than that text.
    joined = (coded.groupBy("key", "id").agg(
        F.sum("n_tokens").alias("n_tokens"),
        F.array_sort(F.collect_list(F.struct("k", "ids"))).alias("p"))
        .select("id", "n_tokens", F.expr("unhex(array_join(transform(p, x -> hex(x.ids)), ''))").alias("ids")))
    return short.unionByName(joined).withColumnRenamed("id", id_col)


def decode(coded: DataFrame, ranks_path: str, ids_col: str = "ids") -> DataFrame:
    """``coded`` with a binary column ``decoded``: the ids' raw bytes in order.
    A null ids cell decodes to no bytes."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in coded.schema.fields) + ", decoded binary"

    def run(batches):
        import numpy as np

        with open(ranks_path, "rb") as f:
            raw = {int(b): base64.b64decode(a) for a, b in map(bytes.split, f)}
        for b in slices(batches):
            out = [b"".join(map(raw.__getitem__, np.frombuffer(x or b"", "<u4").tolist())) for x in b.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.binary())], names=[*b.schema.names, "decoded"])
    return coded.mapInArrow(run, schema)


def digests(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Round trip as digests: id, n_tokens, ids_sha256, decoded_sha256."""
    back = decode(encode(docs, ranks_path, pattern, id_col, text_col), ranks_path)
    return back.select(id_col, "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
