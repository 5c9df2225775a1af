"""Set-based operators and the few sequential kernels."""
