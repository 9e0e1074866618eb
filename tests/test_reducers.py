"""The reducer suite holds all six reducers: its list, and its scalars over that list."""

from collections import Counter
from statistics import mean

from heatwise.operators import reports as R


def test_reducer_suite_lists_every_duration(spark):
    tasks = [("hot", 0, 60 * (k % 3)) for k in range(300)] + [("one", 5, 2), (None, 0, 7), (None, 0, 7), (None, 1, None), ("none", None, 4)]
    df = spark.createDataFrame([(e, *[None if x is None else str(x) for x in t]) for e, *t in tasks],
                               "event string, start_time string, end_time string")
    durations = {}
    for event, start, end in tasks:
        durations.setdefault(event, []).append(None if None in (start, end) else end - start)
    rows = R.reducer_suite(df).collect()
    for event, values in durations.items():
        mine, known = [r for r in rows if r.event == event], [v for v in values if v is not None]
        assert Counter({r.duration_list: r.occurrences for r in mine}) == Counter(values)
        want = (sum(known) if known else None, len(values), mean(known) if known else 0, max(known, default=None), min(known, default=None))
        assert {(r.duration_sum, r.duration_count, r.duration_avg, r.duration_max, r.duration_min) for r in mine} == {want}
    assert len(rows) == sum(len(set(v)) for v in durations.values())
    assert R.reducer_suite(df.limit(0)).collect() == []
