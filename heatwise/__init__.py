"""heatwise: cloud-workload heat analytics on Spark.

    sources/    task table from the star tables, trace forms, file sources (S1-S7)
    functions/  formula, parsing and text-extraction column expressions (§1.4, P4-P8)
    operators/  cleaning, reports, rollup, charts, telemetry, models (§2.3-§2.10)
    sinks/      CSV, text, metric lines, results document, heat log (K1-K6)
    streaming/  live rollup and watermarked heat windows (L1, L2)
    plans/      the registry of named queries and their SQL oracles
    jobs/       batch job writing every report to a folder
"""

__version__ = "0.1.0"
