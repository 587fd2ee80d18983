"""Sinks: warehouse tables (K1-K3, K13, K14), serving views (K4-K8), the
lake archive (K9-K11) and topic publishing (K12)."""
