"""Block-chain analytics on Spark: tables, rollups, panels, predictions, audits and feeds."""
