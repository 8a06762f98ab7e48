"""Compositions of operators: marts, KPIs, report pages, the gap report and the warehouse build."""
