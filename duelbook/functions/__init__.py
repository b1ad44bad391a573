"""Part of duelbook."""
