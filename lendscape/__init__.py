"""Credit-data analytics on Spark: DataFrame operators for landing, cleaning,
keyed upsert, type-2 history, star-schema modelling, KPIs and data-quality gates."""
