"""Official-statistics time series on Spark: observations, star schema, marts, KPIs, checks."""
