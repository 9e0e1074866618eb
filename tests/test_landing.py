"""Landed traces are reused within a session and written again when an input changes."""

import os
import shutil
import time

from heatwise.sources import star


def test_land_reuses_and_relands(spark, sf_dir, tmp_path):
    src = tmp_path / "star"
    src.mkdir()
    for t in ("lineitem", "orders", "customer"):
        shutil.copy(f"{sf_dir}/{t}.parquet", src / f"{t}.parquet")
    d = str(src)
    first = star.land(spark, d, "tasks")
    again = star.land(spark, d, "tasks")
    assert first.inputFiles() == again.inputFiles()
    assert first.count() == star.tasks_from_star(spark, d).count()
    later = time.time() + 5
    os.utime(src / "lineitem.parquet", (later, later))
    changed = star.land(spark, d, "tasks")
    assert set(changed.inputFiles()).isdisjoint(first.inputFiles())
    assert changed.count() == first.count()
