"""The models: silver views, intermediate rollups, gold tables, history and data quality."""
