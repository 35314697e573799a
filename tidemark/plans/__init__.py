"""Composed query plans: validators, KPI/report rollups, data-quality and lifecycle audits."""
