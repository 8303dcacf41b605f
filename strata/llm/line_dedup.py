"""Line dedup over overlapping windows of three lines.

Each three consecutive lines of a text are hashed (128 bits). A window that
occurs again, anywhere, is repeated; its first occurrence is the one with the
smallest (id, position). The lines that later occurrences cover are merged and
removed. Hashing is native, windows are counted before the shuffle, and only
repeated ones are joined back, where AQE splits frequent windows. Of the texts
only those that may lose lines are shuffled: a bitmap of bounded size tells them
apart.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import flagged, ship, stored

LINES = 3


def windows(docs: DataFrame, lines: int = LINES) -> DataFrame:
    """(_id, _key, pos, h1, h2) of every window; ``docs`` has _id, _text and the text's hash _key."""
    split = F.split(F.coalesce("_text", F.lit("")), "\n")
    rows = docs.select("_id", "_key", split.alias("l")).where(F.size("l") >= lines)

    def one(i):  # noqa: ANN001, ANN202
        parts = [F.element_at(F.col("l"), (i + 1 + k).cast("int")) for k in range(lines)]
        return F.struct(F.xxhash64(*parts).alias("h1"), F.xxhash64(*parts[::-1], F.lit(1)).alias("h2"))

    each = F.transform(F.sequence(F.lit(0), F.size("l") - lines), one)
    return rows.select("_id", "_key", F.posexplode(each).alias("pos", "h")).select("_id", "_key", "pos", "h.h1", "h.h2")


def line_dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lines: int = LINES, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns of ``docs`` (all but the text by default), ``n_lines``, ``removed`` and the new ``text``.

    ``removed`` are the numbers (from 0) of the removed lines. Lines end at a
    line feed and are compared as they are. Null text counts as empty, one line;
    texts of fewer lines than a window stay as they are, so may become empty
    only texts that are all repeated. A null id comes first. Rows that repeat an
    id and a text are one occurrence: each keeps what the first keeps. Columns
    named like an output are replaced; an empty table gives an empty result.
    """
    ship(docs.sparkSession)
    outputs = ["n_lines", "removed", text_column]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in outputs]
    rows = docs.select(docs[id_column].alias("_id"), docs[text_column].alias("_text"), *[docs[c].alias(f"_k{i}") for i, c in enumerate(keep)]).withColumn("_key", F.xxhash64("_text"))
    found = windows(rows.select("_id", "_text", "_key"), lines)
    at = F.struct("_id", "_key", "pos")
    first = found.groupBy("h1", "h2").agg(F.min(at).alias("first"), F.count("*").alias("n")).where("n > 1")
    first = stored(first.select("h1", "h2", "first"), "line-windows")
    later = found.join(first, ["h1", "h2"]).where(~at.eqNullSafe(F.col("first")))
    starts = stored(later.groupBy("_id", "_key").agg(F.collect_set("pos").alias("starts")), "line-starts")
    rows = flagged(rows.withColumn("_hash", F.xxhash64("_id", "_key")), "_hash", starts.select(F.xxhash64("_id", "_key").alias("_hash")), "_may")
    starts = starts.select(F.col("_id").alias("_i"), F.col("_key").alias("_h"), "starts")
    joined = rows.where("_may").join(starts, F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_key") == F.col("_h")), "left")
    joined = joined.unionByName(rows.where("not _may"), allowMissingColumns=True)
    schema = T.StructType([*[docs.schema[c] for c in keep], T.StructField("n_lines", T.LongType()), T.StructField("removed", T.ArrayType(T.IntegerType(), False)), T.StructField(text_column, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, removed, texts = [], [], []
            for text, begin in zip(b.column("_text"), b.column("starts")):
                parts = (text.as_py() or "").split("\n")
                gone = np.zeros(len(parts) + 1, np.int64)
                for s in begin.as_py() or []:  # windows begin and end: a running sum merges them
                    gone[s] += 1
                    gone[s + lines] -= 1
                gone = np.cumsum(gone)[:-1] > 0
                n.append(len(parts))
                removed.append(np.flatnonzero(gone).tolist())
                texts.append("\n".join([p for p, g in zip(parts, gone.tolist()) if not g]) if gone.any() else text.as_py() or "")
            columns = b.columns[2 : 2 + len(keep)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n, pa.int64()), pa.array(removed, pa.list_(pa.int32())), pa.array(texts, pa.string())], names=[*keep, "n_lines", "removed", text_column])

    return joined.select("_text", "starts", *[f"_k{i}" for i in range(len(keep))]).mapInArrow(run, schema)
