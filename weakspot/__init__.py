"""Mine evaluation logs of code-generating systems with Spark.

``sources``    scans, detection, integrity checks and artifacts
``functions``  column expressions over texts, tags, evidence and contracts
``operators``  DataFrame-to-DataFrame steps
``plans``      the diagnose, aggregate, synthesize and run stages
``streaming``  incremental ingest
"""
