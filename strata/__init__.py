"""strata: layered warehouse pipelines with versioned dimensions on stock Spark.

Quick start::

    from strata.plans.flow import Landing, run_incremental
    from strata.streaming.bronze import SourceSpec

    landing = Landing(SourceSpec("customers", "json", "s3a://lake/landing/customers"),
                      SourceSpec("products", "csv", "s3a://lake/landing/products", {"header": "true"}),
                      SourceSpec("orders", "parquet", "s3a://lake/landing/orders"))
    tables = run_incremental(spark, landing, "s3a://lake/warehouse", as_of="2026-07-01")

or from a shell: ``python -m strata run --customers ... --products ... --root ...``.
"""
