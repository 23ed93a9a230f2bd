"""Extract files that arrive one by one, staged by a file stream with the same reader and insert as the batch run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators.keyed import unknown_keys
from ..plans.stage import clean_attendance, clean_pupil, stage_marks, stage_pupils
from ..schemas import ATTENDANCE_EXTRACT, PUPIL_EXTRACT, RAW_REJECTED, STG_ATTENDANCE, STG_PUPIL
from ..sources.extracts import AUTO, kept_rows, rejected_rows, scan_extract
from ..sources.store import Store

ARRIVALS = {
    STG_PUPIL.name: (PUPIL_EXTRACT, clean_pupil, stage_pupils),
    STG_ATTENDANCE.name: (ATTENDANCE_EXTRACT, clean_attendance, stage_marks),
}
# The stream tells which files are new; their content is not a part of it.
_FILE = "path string, modificationTime timestamp, length long, content binary"
_REJECTED_KEY = ("extract", "text", "reason", "_file")


def stage_arrivals(
    store: Store, name: str, folder: str, checkpoint: str, unreadable: str = "zero",
    files_per_batch: int | None = None, multiline: bool | str = AUTO,
) -> StreamingQuery:
    """Stage all files of ``folder`` not staged before, then stop.

    Rows of one batch rank in file order, batches in order of arrival. A batch that is run again after a
    failure finds its keys in the stage and its rejected rows in their table and adds nothing. The next daily run
    extends the dimensions by the days that got pupils.
    """
    columns, clean, insert = ARRIVALS[name]
    reader = store.spark.readStream.format("binaryFile").schema(_FILE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def land(batch: DataFrame, _batch_id: int) -> None:
        paths = sorted(r["path"] for r in batch.collect())
        if not paths:
            return
        with store.scratch() as scratch:
            # The insert reads its input twice; a stored copy keeps the second reading from parsing the files again.
            rows = scratch.keep(scan_extract(store.spark, paths, columns, multiline), "arrivals")
            rejected = rejected_rows(rows, name)
            if not rejected.isEmpty():
                store.append(RAW_REJECTED.name, unknown_keys(rejected, store.read(RAW_REJECTED.name), _REJECTED_KEY))
            insert(store, clean(kept_rows(rows), unreadable))

    return (
        reader.load(folder).select("path").writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
