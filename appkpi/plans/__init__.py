"""The tables: raw contracts, staging, KPI tables, and how each is stored."""
