"""SimHash near-dedup over a Gray-order hierarchical index.

Fingerprints are taken in Arrow batches where the documents lie; only
(document, fingerprint) rows move.  Equal fingerprints are one row before the
search, so thousands of exact copies cost one index entry.

Cases: a null or blank text has fingerprint zero and links like any other; a
document of one or two words has one shingle; repeated rows are separate rows
with the same class; rows with a null id take part in links but never name a
class (a class of null ids only has a null name); an empty table gives no
rows; other columns of the input are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mktpanel.llm.common import byte_texts, materialize, releasing, slices
from mktpanel.llm.components import components
from mktpanel.llm.hamming import HOT_BUCKET, near_links

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
SHINGLES_AT_ONCE = 65_536
TEXTS_AT_ONCE = 2500


def fingerprint(text: bytes | None, width: int = SHINGLE_WORDS) -> bytes:
    """Eight bytes, highest bit first, of one text."""
    ws = (text or b"").lower().split()
    if not ws:
        return bytes(8)
    width = min(width, len(ws))
    digest, join = xxhash.xxh64_digest, b" ".join
    ones, n = np.zeros(64, np.int64), len(ws) - width + 1
    for i in range(0, n, SHINGLES_AT_ONCE):
        some = ws[i:i + SHINGLES_AT_ONCE + width - 1]
        raw = b"".join([digest(join(s), SEED) for s in zip(*(some[k:] for k in range(width)))])
        ones += np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > n).tobytes()


def _column(texts: pa.Array, width: int) -> pa.Array:
    raw = b"".join([fingerprint(t, width) for t in byte_texts(texts)])
    return pa.array(np.frombuffer(raw, ">u8").astype(np.uint64).view(np.int64), pa.int64())


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 width: int = SHINGLE_WORDS) -> DataFrame:
    """One row (id, fp) per document; ``fp`` is the fingerprint as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, TEXTS_AT_ONCE):
            yield pa.RecordBatch.from_arrays([batch.column(0), _column(batch.column(1), width)], ["id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("_t")) \
               .mapInArrow(releasing(run), "id long, fp long")


def classes(fps: DataFrame, max_bits: int = MAX_BITS, hot_bucket: int = HOT_BUCKET) -> DataFrame:
    """(fp, root, rep): for every distinct fingerprint its class and the smallest id in that."""
    distinct = materialize(fps.groupBy("fp").agg(F.min("id").alias("own")), "fingerprints")
    linked = components(near_links(distinct, max_bits, hot_bucket))
    rows = distinct.join(linked, distinct["fp"] == linked["node"], "left") \
                   .select("fp", "own", F.coalesce("root", "fp").alias("root"))
    names = rows.groupBy("root").agg(F.min("own").alias("rep"))
    return rows.join(names, "root").select("fp", "root", "rep")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE_WORDS,
                    max_bits: int = MAX_BITS, hot_bucket: int = HOT_BUCKET) -> DataFrame:
    """One row per document: id column, ``fingerprint`` (16 hex digits), ``component_id``."""
    fps = materialize(fingerprints(docs, id_col, text_col, width), "document-fingerprints")
    found = classes(fps, max_bits, hot_bucket)
    return fps.join(found, "fp").select(F.col("id").alias(id_col),
                                        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                                        F.col("rep").alias("component_id"))


def keep_first(docs: DataFrame, width: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """The documents with one row left of each near-duplicate class: that of the smallest id.

    An id that several rows carry, or null, does not say which row is meant;
    for these few rows the fingerprint is taken again and, of the rows that
    carry the class's name, the one with the smallest text hash stays.
    """
    fps = materialize(fingerprints(docs, width=width), "document-fingerprints")
    found = classes(fps, max_bits)
    unclear = fps.groupBy("id").count().filter("id is null or count > 1").select(F.col("id").alias("__id"))
    names = found.select(F.col("rep").alias("__id")).filter("__id is not null").distinct()
    if unclear.isEmpty():
        return docs.join(names, docs["doc_id"] == F.col("__id"), "left_semi")
    plain = names.join(unclear, "__id", "left_anti")
    kept = docs.join(plain, docs["doc_id"] == F.col("__id"), "left_semi")
    odd = _with_fingerprint(docs.join(unclear, docs["doc_id"].eqNullSafe(F.col("__id")), "left_semi"), width)
    odd = odd.join(found.select(F.col("fp").alias("__fp"), F.col("root").alias("__root"), F.col("rep").alias("__rep")),
                   "__fp").filter(F.col("doc_id").eqNullSafe(F.col("__rep")))
    one = odd.groupBy("__root").agg(F.min_by(F.struct(*docs.columns), F.xxhash64("text")).alias("__row"))
    return kept.unionByName(one.select("__row.*"))


def _with_fingerprint(docs: DataFrame, width: int) -> DataFrame:
    schema = T.StructType([*docs.schema.fields, T.StructField("__fp", T.LongType())])
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, TEXTS_AT_ONCE):
            yield pa.RecordBatch.from_arrays([*batch.columns, _column(batch.column(at), width)],
                                             [*batch.schema.names, "__fp"])

    return docs.mapInArrow(releasing(run), schema)
