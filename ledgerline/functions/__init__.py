"""Part of ledgerline; see README.md."""
