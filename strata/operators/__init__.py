"""DataFrame -> DataFrame operators (lazy; no actions except quality gates)."""
