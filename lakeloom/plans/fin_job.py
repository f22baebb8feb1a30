"""M7: the FIN batch job — split → parse → typed + wide tables → write.

Messages are numbered 1..n within their file in byte order (W9) without a
window or a shuffle of messages: a file may span many input splits, so each
(file, split) gets an offset from a prefix sum over the small (file, split)
count table, and a row's number is offset + its position inside its split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeloom.operators import messages as M
from lakeloom.session import written
from lakeloom.sources.files import write_csv


def numbered_messages(spark: SparkSession, path: str) -> DataFrame:
    """Messages of every FIN file under ``path`` with ``message_id`` = 1..n per file.

    ``monotonically_increasing_id`` is (split id << 33) + row index in the split,
    and a split reads its files sequentially, so the rows of one file inside one
    split are contiguous; what is no message stands ahead of the file's first one.
    Per (file, split): count and first id — one row per split, broadcast — then
    offsets by a window over the splits of a file (bounded by the file's split
    count, not its messages)."""
    raw = M.read_fin_batch(spark, path).withColumn("_split", F.shiftright(F.col("_ord"), 33))
    splits = raw.groupBy("file", "_split").agg(F.count(F.lit(1)).alias("_n"), F.min("_ord").alias("_first"))
    w = Window.partitionBy("file").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("file", "_split", "_first", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_offset"))
    return (raw.join(F.broadcast(splits), ["file", "_split"])
            .withColumn("message_id", F.col("_offset") + F.col("_ord") - F.col("_first") + 1).drop("_ord", "_split", "_offset", "_first"))


def run_fin_batch(spark: SparkSession, path: str, out_dir: str, mode: str = "overwrite") -> dict[str, str]:
    """Parse every message once (what the two outputs need is written once to the shared folder) and write
    the typed and wide tables, as compressed CSV. Returns the output folders."""
    parsed = written(M.parse_mt103(numbered_messages(spark, path)).select("message_id", "blocks", "fields"), "fin-parsed")
    typed_out, wide_out = f"{out_dir}/mt103_typed", f"{out_dir}/mt103_wide"
    write_csv(M.typed(parsed), typed_out, mode=mode, compression="gzip")
    write_csv(M.wide(parsed, tags=M.tags_of(parsed)), wide_out, mode=mode, compression="gzip")
    return {"typed": typed_out, "wide": wide_out}
