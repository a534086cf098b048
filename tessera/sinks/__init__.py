"""Sinks: publish frames (K1), staging (K2), dead letters (K3), appends (K4),
partitioned loads (K5), merges and upserts (K6-K9, K12, K13), audit (K14)."""
