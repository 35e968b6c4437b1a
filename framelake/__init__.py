"""framelake: frame analytics on Spark DataFrames.

Operators are plain functions ``DataFrame -> DataFrame`` grouped by role:

* ``sources``   – readers/writers (file listings, probe JSON, image files,
                  the partitioned frame store, metrics sinks, test-table adapters)
* ``functions`` – Column-level scalar helpers (fps parsing, names, KPIs, scales)
* ``operators`` – frame-level operators (explode, numbering, gaps, reassembly,
                  media selection, resampling, pixel kernels, detection, blending,
                  aggregates, linear algebra)
* ``plans``     – chunk planning (equal-time, key-frame aligned, sweeps) and the
                  composed logo-replacement job
* ``streaming`` – Structured Streaming variants (resource windows, incremental
                  chunk ingestion with resumable checkpoints)
"""

__version__ = "0.1.0"
