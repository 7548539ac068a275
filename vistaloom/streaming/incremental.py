"""The same operators over streams of files: first-wins dedup, keyframes per camera, incremental caches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from vistaloom.functions import geometry as g

#: Folders of a cache that streams fill.
BUCKETS = 64


def first_in_voxel(matches: DataFrame, size: float = 0.05, lateness: str | None = None) -> DataFrame:
    """First arrivals per scene, polarity and voxel. With lateness, state is dropped once `ts` is that much behind."""
    keyed = matches.withColumns({f"v{c}": g.voxel(F.col(c), size) for c in "xyz"})
    keys = ["scene_id", "visible", "vx", "vy", "vz"]
    if lateness is None:
        return keyed.dropDuplicates(keys)
    return keyed.withWatermark("ts", lateness).dropDuplicatesWithinWatermark(keys)


def keyframes(frames: DataFrame, least_translation: float = 0.2, least_rotation: float = 15.0) -> DataFrame:
    """(scene_id, ord) of frames that moved or turned enough from their scene's last kept one, as they come in.

    State per scene is one pose. Frames of a batch are taken in order of ord; a frame that comes after later ones was taken
    in is compared with the state as it then is.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        import numpy as np

        rows = pd.concat(list(batches)).sort_values("ord")
        last = np.array(state.get[0]) if state.exists else None
        kept = []
        for o, pose in zip(rows["ord"], rows["pose"], strict=True):
            p = np.asarray(pose, float)
            if not np.isfinite(p).all():
                continue
            seen = p[[3, 7, 11, 2, 6, 10]]
            if last is not None:
                a, b = last[3:], seen[3:]
                cos = float(a @ b / (np.linalg.norm(a) * np.linalg.norm(b)))
                if np.linalg.norm(seen[:3] - last[:3]) < least_translation and np.degrees(np.arccos(max(-1.0, min(1.0, cos)))) < least_rotation:
                    continue
            last = seen
            kept.append(o)
        if last is not None:
            state.update((last.tolist(),))
        yield pd.DataFrame({"scene_id": [key[0]] * len(kept), "ord": kept})

    return frames.groupBy("scene_id").applyInPandasWithState(step, "scene_id string, ord long", "seen array<double>", "append", GroupStateTimeout.NoTimeout)


def top_up(source: DataFrame, cache: str, keys: list[str], compute: Callable[[DataFrame], DataFrame], checkpoint: str) -> StreamingQuery:
    """Fills a Parquet cache with what compute gives for keys that it doesn't hold yet, batch by batch.

    A batch that is run again after a failure finds its keys in the cache and adds nothing. The cache lies in buckets by a
    hash of the keys, and a batch reads the keys of its own buckets only.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")

    def fill(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        new = batch.dropDuplicates(keys).withColumn("bucket", bucket)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(cache)
        if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            touched = [r["bucket"] for r in new.select("bucket").distinct().collect()]  # BUCKETS at most
            held = spark.read.parquet(cache).where(F.col("bucket").isin(*touched)).select("bucket", *keys)
            new = new.join(held, ["bucket", *keys], "left_anti")
        compute(new.drop("bucket")).withColumn("bucket", bucket).write.mode("append").partitionBy("bucket").parquet(cache)

    return source.writeStream.foreachBatch(fill).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


class Progress(StreamingQueryListener):
    """Passes on how many items of each stream are done, as batches come through: (name, batch, items so far)."""

    def __init__(self, tell: Callable[[str, int, int], None]):
        self.tell, self.done = tell, {}

    def onQueryStarted(self, event) -> None:  # noqa: N802  the listener's names
        self.done[str(event.runId)] = 0

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        run = str(p.runId)
        self.done[run] = self.done.get(run, 0) + int(p.numInputRows)
        self.tell(p.name or str(p.id), p.batchId, self.done[run])

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self.done.pop(str(event.runId), None)


def windowed_counts(events: DataFrame, width: str = "1 hour", lateness: str = "2 hours") -> DataFrame:
    """Records per window and kind; windows close when the watermark passes them."""
    return events.withWatermark("ts", lateness).groupBy(F.window("ts", width), "event_type").agg(F.count(F.lit(1)).alias("n"))
