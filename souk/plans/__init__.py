"""Composed plans: cleaning pipelines, marts, KPIs, reports, measures, data sets, profiles."""
