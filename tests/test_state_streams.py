"""Streams whose state lies in Spark's state store."""

from datetime import date

from carelattice.schemas import TABLES
from carelattice.sources import landing
from carelattice.sources.snapshots import SnapshotTable
from carelattice.streaming import ingest

AS_OF = "2024-01-01"


def observations(spark, *rows):
    schema = TABLES["observation"].raw_schema
    filled = [(i, "p", "e", "final", "1-1", "ln", "n", day, value, "kg") for i, day, value in rows]
    return spark.createDataFrame(filled, schema)


def test_rows_sent_again_stop_at_the_state_store(spark, tmp_path, rows):
    root = str(tmp_path)
    seen = []

    class Counting(SnapshotTable):
        def merge(self, new, *args, **kwargs):
            seen.append(new.count())
            return super().merge(new, *args, **kwargs)

    first = [(str(i), "2024-01-02", "1") for i in range(20)]
    batches = (first, [*first, ("20", None, "1")], [("3", "2023-12-01", "9"), *first, ("20", None, "1"), ("20", None, "1")])
    for make, name in ((ingest.unique_with_state, "state"), (ingest.unique_available, "merge")):
        snapshot = Counting(spark, f"{root}/{name}", "observation", "effective_date")
        for day, batch in enumerate(batches):
            landing.land(observations(spark, *batch), f"{root}/{name}/landed", "observation", date(2024, 6, 7 + day), fmt="parquet")
            stream = ingest.landed_stream(spark, f"{root}/{name}/landed", "observation", landed_at=make is ingest.unique_with_state)
            make(stream, snapshot, "observation", f"{root}/{name}/checkpoint", AS_OF)
    both = [SnapshotTable(spark, f"{root}/{n}", "observation", "effective_date").read() for n in ("state", "merge")]
    assert rows(both[0]) == rows(both[1]) and both[0].count() == 21
    assert rows(both[0].where("observation_id = '3'"), "value") == [(9.0,)]
    with_state = [n for n in seen if n][:3]
    assert with_state == [20, 1, 1] and max(seen) == 23


