"""Enriched order row, KPI marts, analysis and dashboard queries, ordered refresh."""
