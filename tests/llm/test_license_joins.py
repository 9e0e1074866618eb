"""The license scan collects no side that grows with the documents for a broadcast."""

from heatwise.llm import licenses as L


def test_windows_are_never_broadcast(spark):
    notices = sorted(L.TEMPLATES.items())
    docs = [(k if k % 9 else None, f"some {k} words and then {notices[k % len(notices)][1]} with more") for k in range(200)]
    found = L.scan_licenses(spark.createDataFrame(docs, "doc_id long, text string"))
    plan = found._jdf.queryExecution().sparkPlan().toString()  # as planned from the sizes of files, which are small here
    joins = [line for line in plan.splitlines() if "Join" in line and "isnull(doc_id" in line]
    assert len(joins) == 1 and "SortMergeJoin" in joins[0]
    assert {(r.doc_id, r.license) for r in found.collect()} >= {(i, notices[k % len(notices)][0]) for k, (i, _) in enumerate(docs)}
